"""Order-dependent building blocks that never funnel a group into one task.

``running_total`` and ``exact_quantiles`` range-partition the rows, so a group
that holds a third of the data is spread over many tasks. The per-entity
operators either rely on the bound a ``PanelSpec`` states or split every entity
into chunks of periods.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from panelkit.runtime import lookup_side, stored
from panelkit.spec import PanelSpec

#: Periods per chunk. Periods are 32-bit integers, so an entity has at most
#: 2**16 chunks of at most 2**16 rows each: both levels stay bounded.
CHUNK = 1 << 16


def _range_parts(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Write the rows in ranges of ``order``, with the range number as ``_part``."""
    ranged = df.repartitionByRange(*[F.col(c) for c in order])
    return stored(ranged.withColumn("_part", F.spark_partition_id()))


def running_total(
    df: DataFrame, order: Sequence[str], weight: Column | str, out: str
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows before this one.

    ``order`` must be a unique key. Rows are range-partitioned by it, each
    partition is summed on its own, and the few partition totals are added up
    to give every partition its starting value.
    """
    weight = F.col(weight) if isinstance(weight, str) else weight
    fixed = _range_parts(df.withColumn("_w", weight), order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = fixed.groupBy("_part").agg(F.sum("_w").alias("_sum")).select(
        "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base")
    )
    inside = (
        Window.partitionBy("_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        fixed.withColumn("_inside", F.coalesce(F.sum("_w").over(inside), F.lit(0)))
        .join(F.broadcast(starts), "_part")  # one row per range partition
        .select(*df.columns, (F.col("_base") + F.col("_inside")).alias(out))
    )


def rows_at(
    df: DataFrame, order: Sequence[str], places: Callable[[int], Sequence[int]]
) -> tuple[int, list[Row]]:
    """The row count and the keys at some 0-based places of the order.

    ``places`` maps the row count to the places. Only the key columns are moved,
    and only the ranges that hold a wanted place are sorted.
    """
    ranges = _range_parts(df.select(*order), order)
    sizes = sorted(ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    n = sum(r["n"] for r in sizes)
    wanted = []
    for place in places(n):
        base = 0
        for part, size in sizes:
            if base <= place < base + size:
                wanted.append((part, place - base + 1))
            base += size
    if not wanted:
        return n, []
    numbered = ranges.where(F.col("_part").isin(sorted({p for p, _ in wanted}))).withColumn(
        "_row", F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    )
    hit = F.lit(False)
    for part, row in wanted:
        hit = hit | ((F.col("_part") == part) & (F.col("_row") == row))
    return n, numbered.where(hit).orderBy(*order).select(*order).collect()


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """Exact linearly interpolated quantiles per group: (by..., prob, quantile).

    Equal values are counted first, so ties cost one row, and the counts are
    range-partitioned by (group, value). The totals per group and range tell
    which range holds a wanted rank; only those ranges are sorted.
    """
    wanted_by = list(by)
    by = wanted_by or ["_every"]
    base = df if wanted_by else df.withColumn("_every", F.lit(0))
    counts = (
        base.where(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranges = _range_parts(counts, [*by, value])

    group = Window.partitionBy(*by)
    earlier = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("prob") * (F.col("_total") - 1)
    ends = F.col("_base") + F.col("_sum")
    wanted = lookup_side(
        ranges.groupBy(*by, "_part")
        .agg(F.sum("_n").alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_sum").over(group))
        .withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("_low", F.floor(at))
        .withColumn("_high", F.ceil(at))
        .withColumn("_frac", at - F.floor(at))
        .where((F.col("_low") < ends) & (F.col("_high") >= F.col("_base")))
    )
    up_to_here = (
        Window.partitionBy(*by, "_part", "prob")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    last = F.col("_base") + F.col("_run") - 1  # rank of the last copy of this value
    first = last - F.col("_n") + 1
    picked = (
        ranges.join(wanted, [*by, "_part"])
        .withColumn("_run", F.sum("_n").over(up_to_here))
        .where(F.col("_low").between(first, last) | F.col("_high").between(first, last))
        .groupBy(*by, "prob")
        .agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.max("_frac").alias("_frac"))
    )
    quantile = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")
    return picked.select(*wanted_by, "prob", quantile.alias("quantile"))


def quantile_columns(
    df: DataFrame, by: Sequence[str], value: str, named: dict[str, float]
) -> DataFrame:
    """``exact_quantiles`` with one column per entry of ``named``."""
    long = exact_quantiles(df, by, value, sorted(set(named.values())))
    return long.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(name)
            for name, p in named.items()
        ]
    )


def _chunk(spec: PanelSpec, width: int) -> Column:
    return F.floor(F.col(spec.time) / F.lit(width)).cast("int")


def add_previous(
    df: DataFrame, spec: PanelSpec, picks: dict[str, str], n: int = 1, chunk: int = CHUNK
) -> DataFrame:
    """For every output name add the picked column of the n-th previous row.

    Rows are ordered by period within their entity. A panel with declared
    period bounds needs one window. Otherwise entities are cut into chunks;
    only the first and last ``n`` rows of each chunk meet in a second window.
    """

    def shifted(window) -> dict[str, Column]:
        return {out: F.lag(F.col(source), n).over(window) for out, source in picks.items()}

    if spec.period_bounds is not None:
        return df.withColumns(shifted(spec.window()))

    keys = [spec.entity, "_chunk"]
    asc = Window.partitionBy(*keys).orderBy(spec.time)
    desc = Window.partitionBy(*keys).orderBy(F.col(spec.time).desc())
    marked = (
        df.withColumn("_chunk", _chunk(spec, chunk))
        .withColumn("_head", F.row_number().over(asc) <= n)
        .withColumn("_tail", F.row_number().over(desc) <= n)
    )
    body = marked.withColumns(shifted(asc)).where(~F.col("_head"))
    edge = marked.where(F.col("_head") | F.col("_tail"))
    heads = edge.withColumns(shifted(spec.window())).where(F.col("_head"))
    return body.unionByName(heads).drop("_chunk", "_head", "_tail")


def add_last_observed(
    df: DataFrame, spec: PanelSpec, picks: dict[str, str], chunk: int = CHUNK
) -> DataFrame:
    """For every output name add the latest non-null value up to this row."""
    if spec.period_bounds is not None:
        so_far = spec.window().rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns(
            {out: F.last(F.col(src), ignorenulls=True).over(so_far) for out, src in picks.items()}
        )

    keys = [spec.entity, "_chunk"]
    so_far = (
        Window.partitionBy(*keys).orderBy(spec.time).rowsBetween(Window.unboundedPreceding, 0)
    )
    earlier = (
        Window.partitionBy(spec.entity)
        .orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    marked = df.withColumn("_chunk", _chunk(spec, chunk))
    chunk_last = marked.groupBy(*keys).agg(
        *[
            F.max_by(F.col(src), F.when(F.col(src).isNotNull(), F.col(spec.time))).alias(f"_l_{out}")
            for out, src in picks.items()
        ]
    )
    carried = chunk_last.select(
        *keys,
        *[
            F.last(F.col(f"_l_{out}"), ignorenulls=True).over(earlier).alias(f"_c_{out}")
            for out in picks
        ],
    )
    joined = marked.join(carried, keys, "left").withColumns(
        {
            out: F.coalesce(
                F.last(F.col(src), ignorenulls=True).over(so_far), F.col(f"_c_{out}")
            )
            for out, src in picks.items()
        }
    )
    return joined.drop("_chunk", *[f"_c_{out}" for out in picks])


def add_neighbours(
    df: DataFrame, spec: PanelSpec, columns: Sequence[str], radius: int, chunk: int = CHUNK
) -> tuple[DataFrame, dict[int, str]]:
    """Add the rows up to ``radius`` places before and after as struct columns.

    Returns the frame and the column name per offset. Each struct holds the
    period as ``at`` and the columns. As (entity, period) is a key and periods
    are integers, every row within ``radius`` periods is among them. Chunked
    panels copy the rows near a chunk border into the next chunk as well.
    """
    # the columns travel inside one struct, so nothing is shuffled twice
    payload = F.struct(F.col(spec.time).alias("at"), *[F.col(c) for c in columns])
    packed = df.select(*[c for c in df.columns if c not in columns], payload.alias("_row"))
    unpacked = [F.col(f"_row.{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    names = {o: f"_near_{o + radius}" for o in range(-radius, radius + 1) if o}

    def neighbours(window) -> list[Column]:
        return [F.lead("_row", o).over(window).alias(c) for o, c in names.items()]

    if spec.period_bounds is not None:
        return packed.select("*", *neighbours(spec.window())).select(*unpacked, *names.values()), names

    window = Window.partitionBy(spec.entity, "_chunk").orderBy(spec.time)
    first = F.floor((F.col(spec.time) - radius) / F.lit(chunk)).cast("int")
    last = F.floor((F.col(spec.time) + radius) / F.lit(chunk)).cast("int")
    copies = packed.withColumn("_home", _chunk(spec, chunk)).withColumn(
        "_chunk", F.explode(F.sequence(first, last))
    )
    around = copies.select("*", *neighbours(window)).where(F.col("_chunk") == F.col("_home"))
    return around.select(*unpacked, *names.values()), names
