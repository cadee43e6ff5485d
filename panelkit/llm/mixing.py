"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same number of copies on average: its
source's target over its source's size. The whole part of it is fixed; the rest
is a probability. Two documents with probabilities p, q and sizes s, t trade
words: a random side gives, so much that one of the two becomes 0 or 1, with odds
that keep both averages. What they hold together stays the same, so that the words of
a source come out exact but for its last, lone document. A tree of blocks does it:
each block of about ``BLOCK`` documents folds to one residual, and the residuals
of a level are the documents of the next. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import WORD, own_name
from panelkit.runtime import stored

#: Documents of a block; the tree's fan-in.
BLOCK = 48
#: What sources weigh, in turn, in the order of their names.
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = 150, cap: int = 2) -> DataFrame:
    """(source, source_size long, target double) from ``sizes`` (source, size, n rows of that kind).

    The sources, by code point with null last, weigh ``weights`` in turn and share
    ``percent`` of all sizes. No target exceeds ``cap`` times its source's size;
    what is over is shared again by weight. This level is found in one pass over
    the sources in order of cap over weight, a table of one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * cap)
    by_cap = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("place", F.row_number().over(by_cap))
    per = per.withColumn(
        "level",
        (F.lit(percent / 100) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0)))
        / F.sum("weight").over(after),
    )
    per = per.withColumn("capped", F.col("level") * F.col("weight") >= F.col("most"))
    level = F.min_by(F.col("level"), F.when(~F.col("capped"), F.col("place"))).over(every)
    target = F.when(F.col("capped"), F.col("most").cast("double")).otherwise(F.col("shared") * F.col("weight"))
    return per.withColumn("shared", level).select("source", "source_size", target.alias("target"))


def _chance(*parts: Column) -> Column:
    """A fixed draw from [0, 1) for the given values."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _settle(block: Column, seed: int) -> Column:
    """Fold an array of units (h, id, size, n, sure, p) to struct(cur unit, out array of decided units)."""

    def unit(x: Column, p: Column) -> Column:
        return F.struct(*(x[c].alias(c) for c in ("h", "id", "size", "n", "sure")), p.alias("p"))

    def step(acc: Column, new: Column) -> Column:
        a, b = acc["cur"], new
        have_a, have_b = a["p"] * a["size"], b["p"] * b["size"]
        room_a, room_b = (1 - a["p"]) * a["size"], (1 - b["p"]) * b["size"]
        to_a, to_b = F.least(room_a, have_b), F.least(have_a, room_b)
        odds = F.when(to_a + to_b > 0, to_b / (to_a + to_b)).otherwise(a["p"])
        up = _chance(F.lit(seed), a["h"], b["h"]) < odds
        one, zero = F.lit(1.0), F.lit(0.0)
        done = (
            F.when(up & (room_a <= have_b), unit(a, one)).when(up, unit(b, zero))
            .when(have_a <= room_b, unit(a, zero)).otherwise(unit(b, one))
        )
        rest = (
            F.when(up & (room_a <= have_b), unit(b, (have_b - to_a) / b["size"])).when(up, unit(a, (have_a + to_a) / a["size"]))
            .when(have_a <= room_b, unit(b, (have_b + to_b) / b["size"])).otherwise(unit(a, (have_a - to_b) / a["size"]))
        )
        return F.struct(rest.alias("cur"), F.concat(acc["out"], F.array(done)).alias("out"))

    first = F.struct(unit(block[0], block[0]["p"]).alias("cur"), F.slice(block, 1, 0).alias("out"))
    return F.aggregate(F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(0))), first, step)


def copies(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[int, ...] = WEIGHTS,
    percent: int = 150, cap: int = 2, seed: int = 17,
) -> DataFrame:
    """(id, source, size, n, source_size, target, copies): how often a mix takes each document.

    Size is the number of words (runs without white space); null or blank texts
    have none. Rows equal in id, source and size are one row here, with their
    number ``n``, and ``copies`` is what they take together: the mix does not tell
    them apart. Null ids and sources are values like any other. Reruns agree:
    chance comes from hashes of the rows. An empty table gives no rows. Documents
    without words are taken as the whole part of their source's copies says.
    """
    sizes = docs.select(
        F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{id_col}`").alias("id"),
        F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
    )
    sizes = stored(sizes.groupBy("source", "id", "size").agg(F.count("*").alias("n")))
    targets = stored(source_targets(sizes, weights, percent, cap))
    facts = targets.toDF("source_key", "source_size", "target")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sizes.join(facts, F.col("source").eqNullSafe(F.col("source_key"))).withColumn("each", each)
    extra = (F.col("each") - F.floor("each")) * F.col("n")
    rows = rows.select(
        "source", F.xxhash64(F.lit(seed), "id", "size", "source").alias("h"), "id", "size", "n",
        (F.floor("each") * F.col("n") + F.floor(extra)).alias("sure"), (extra - F.floor(extra)).alias("p"),
    )
    rows = stored(rows)
    unit = F.struct("h", "id", "size", "n", "sure", "p")
    open_ = rows.where("p > 0 and size > 0")
    decided = [rows.where("not (p > 0 and size > 0)").select("source", "id", "size", "n", F.col("sure").alias("copies"))]
    counts = stored(open_.groupBy("source").agg(F.count("*").alias("units")))
    most = counts.agg(F.max("units")).first()[0] or 0
    level = 0
    while most > 0:
        level += 1
        blocks = F.ceil(F.col("units") / F.lit(float(BLOCK) ** level)).cast("long")
        block = F.pmod(F.xxhash64(F.lit(seed + level), F.col("h")), blocks)
        sides = counts.select(F.col("source").alias("source_key"), "units")
        placed = open_.join(sides, F.col("source").eqNullSafe(F.col("source_key"))).withColumn("block", block)
        folded = stored(
            placed.groupBy("source", "block").agg(F.sort_array(F.collect_list(unit)).alias("units"))
            .select("source", _settle(F.col("units"), seed).alias("r"))
        )
        out = folded.select("source", F.explode("r.out").alias("u"))
        decided.append(out.select("source", "u.id", "u.size", "u.n", (F.col("u.sure") + F.col("u.p")).cast("long").alias("copies")))
        open_ = folded.select("source", "r.cur.*")
        if most <= float(BLOCK) ** level:
            break
    if most:
        last = (_chance(F.lit(-seed), F.col("h")) < F.col("p")).cast("long")
        decided.append(open_.select("source", "id", "size", "n", (F.col("sure") + last).alias("copies")))
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    return out.join(facts, F.col("source").eqNullSafe(F.col("source_key"))).drop("source_key")


def taken(plan: DataFrame) -> DataFrame:
    """(id, size, source_size, target, taken) with a row for every document of ``copies``'s plan."""
    per = F.floor(F.col("copies") / F.col("n")) + (F.col("i") <= F.col("copies") % F.col("n")).cast("long")
    rows = plan.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select("id", "size", "source_size", "target", (per * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, id_col: str, text_col: str, source_col: str, **how) -> DataFrame:
    """``docs`` with every row as often as the mix takes it; rows that it takes 0 times are left out.

    Rows equal in id, source and size share their copies in the order of their
    texts' hashes.
    """
    names = [own_name(docs, f"mix_{c}") for c in ("id", "source", "size", "n", "copies", "i")]
    id_, source, size, n, number, i = names
    plan = copies(docs, id_col, text_col, source_col, **how).select("id", "source", "size", "n", "copies").toDF(*names[:5])
    sized = docs.withColumn(i, F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("long"))
    rows = sized.join(
        plan,
        F.col(f"`{id_col}`").eqNullSafe(F.col(id_)) & F.col(f"`{source_col}`").cast("string").eqNullSafe(F.col(source)) & (F.col(i) == F.col(size)),
    )
    lone = rows.where(F.col(n) == 1)
    place = F.row_number().over(Window.partitionBy(id_, source, size).orderBy(F.xxhash64(f"`{text_col}`")))
    many = rows.where(F.col(n) > 1).withColumn(i, place.cast("long"))
    many = many.withColumn(number, F.floor(F.col(number) / F.col(n)) + (F.col(i) <= F.col(number) % F.col(n)).cast("long"))
    rows = lone.unionByName(many).where(F.col(number) > 0)
    return rows.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(number)))).select(*[f"`{c}`" for c in docs.columns])
