"""Assign rows to validation folds without a global window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.operators.ordered import rows_at, running_total
from panelkit.spec import PanelSpec


def fold_of(position: Column, n: int, k: int) -> Column:
    """Fold of a 0-based position; the first n % k folds are one row larger."""
    size, larger = divmod(n, k)
    border = larger * (size + 1)
    tail = F.floor((position - border) / max(size, 1)) + larger
    return F.when(position < border, F.floor(position / (size + 1))).otherwise(tail).cast("int")


def fold_bounds(n: int, k: int) -> list[tuple[int, int]]:
    """First and past-the-end position of every fold."""
    size, larger = divmod(n, k)
    starts = [f * size + min(f, larger) for f in range(k + 1)]
    return list(zip(starts, starts[1:]))


def ordered_folds(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """Add ``fold``: k blocks of rows in the order of a unique key.

    The keys where the folds begin are looked up, and every row is compared with
    those k - 1 literals. So the rows themselves are not moved. A row with a null
    key would be in no part and raises.
    """

    def starts(n: int) -> list[int]:
        return [start for start, end in fold_bounds(n, k)[1:] if start < end]

    _, borders = rows_at(df, order, starts)
    types = {f.name: f.dataType for f in df.schema.fields}
    key = F.struct(*[F.col(c) for c in order])
    fold = F.lit(0)
    for border in borders:
        edge = F.struct(*[F.lit(border[c]).cast(types[c]).alias(c) for c in order])
        fold = fold + (key >= edge).cast("int")
    missing = reduce(or_, (F.col(c).isNull() for c in order))
    null_key = F.raise_error(F.lit(f"a fold needs keys that are not null: {', '.join(order)}")).cast("int")
    return df.withColumn("fold", F.when(missing, null_key).otherwise(fold))


def contiguous_folds(df: DataFrame, spec: PanelSpec, k: int = 5) -> DataFrame:
    """Blocks of rows in (entity, period) order."""
    return ordered_folds(df, spec.keys, k)


def mixed_key(spec: PanelSpec, seed: int) -> Column:
    """A digest of seed and keys, which any engine computes alike; null where a key is."""
    text = F.concat(F.lit(str(seed)), *[part for c in spec.keys for part in (F.lit("|"), F.col(c).cast("string"))])
    return F.md5(text.cast("binary"))


def shuffled_folds(df: DataFrame, spec: PanelSpec, k: int = 5, seed: int = 42) -> DataFrame:
    """Equal folds in a seeded pseudo-random order: that of the digests of the keys."""
    mixed = df.withColumn("_mix", mixed_key(spec, seed))
    return ordered_folds(mixed, ["_mix", *spec.keys], k).drop("_mix")


def shuffled_positions(df: DataFrame, spec: PanelSpec, seed: int = 42) -> DataFrame:
    """Add the 0-based ``position`` in a seeded pseudo-random order of the keys."""
    mixed = df.withColumn("_mix", mixed_key(spec, seed))
    return running_total(mixed, ["_mix", *spec.keys], F.lit(1), "position").drop("_mix")


def entity_folds(df: DataFrame, spec: PanelSpec, k: int = 5, seed: int = 42) -> DataFrame:
    """All rows of an entity in one fold, by hash."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), spec.entity), F.lit(k)).cast("int"))


def time_folds(df: DataFrame, spec: PanelSpec, k: int = 5) -> DataFrame:
    """Blocks of consecutive periods; the window runs over distinct periods."""
    periods = df.select(spec.time).distinct()
    folds = periods.withColumn(
        "fold", (F.ntile(k).over(Window.orderBy(spec.time)) - 1).cast("int")
    )
    return df.join(folds, spec.time)
