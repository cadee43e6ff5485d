"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a short span of tokens; it hashes the selected
positions and ignores the others, so that a substitution at an ignored position
does not hide a match. Hashes of the documents meet those of the benchmark in a
join; each hit fixes an alignment of document and item, and the words along
that alignment are then compared one by one. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import own_name
from panelkit.runtime import stored

#: Masks over eight tokens: 1 takes part in the hash, 0 is ignored. All begin with both ``ANCHOR`` positions.
#: One of them lies on equal words in any 13 words or more of which 0.8 are equal (tried for all places of the others).
SEEDS = ("11101101", "10110111", "11100011", "11110100", "10110011")
ANCHOR = (0, 2)
#: An overlap counts with at least so many aligned words, of which at least this share is equal.
LEAST_WORDS, LEAST_SHARE = 13, 0.8
#: Largest table of benchmark hashes, in rows, that is broadcast; beyond that Spark shuffles the join.
BROADCAST_HASHES = 200_000
#: Slots of the map of word pairs that occur in the benchmark: a fixed size, whatever the benchmark's.
SLOTS = 1 << 16


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _pair_slot(a: Column, b: Column) -> Column:
    """Slot of two word hashes; null if there is no second word."""
    return F.pmod(a.bitwiseXOR(F.shiftright(b, 7)), F.lit(SLOTS))


def _slot(hashes: Column, at: Column) -> Column:
    return _pair_slot(*(F.get(hashes, at + i) for i in ANCHOR))


def _pairs(words: Column) -> Column:
    """Slots of all positions."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.zip_with(hashes, F.slice(hashes, ANCHOR[1] + 1, F.size(hashes)), _pair_slot)


def _hits(words: Column, known: Callable[[Column], Column] | None = None) -> Column:
    """Array of struct(at, hash) for each seed and each position, or the positions whose slot is ``known``.

    The word hashes are bound to a lambda's variable, so that they are computed
    once for a text and not at every position.
    """

    def of(hashes: Column) -> Column:
        last = F.size(hashes) - len(SEEDS[0])
        at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        if known is not None:
            at = F.filter(at, lambda p: known(_slot(hashes, p)))
        return F.flatten(F.transform(at, lambda p: F.array(*(
            F.struct(
                p.alias("at"),
                F.xxhash64(F.lit(number), *(F.get(hashes, p + i) for i, c in enumerate(seed) if c == "1")).alias("hash"),
            )
            for number, seed in enumerate(SEEDS)
        ))))

    return F.get(F.transform(F.array(F.transform(words, lambda w: F.xxhash64(w))), of), 0)


def _piece(words: Column, at: Column, length: Column) -> Column:
    return F.struct(at.cast("int").alias("at"), F.xxhash64(length.cast("int"), F.slice(words, at + 1, length)).alias("hash"))


def _pieces(words: Column, share: float) -> Column:
    """Struct(at, hash) of pieces of a short item: one more than words may differ, so that one piece is equal."""
    length = _piece_length(words, share)
    return F.transform(F.sequence(F.lit(0), _differing(words, share)), lambda j: _piece(words, (j * length).cast("int"), length))


def _differing(words: Column, share: float) -> Column:
    return F.floor(F.size(words) * F.lit(1 - share) + F.lit(1e-9)).cast("int")


def _piece_length(words: Column, share: float) -> Column:
    return F.floor(F.size(words) / (_differing(words, share) + 1)).cast("int")


def _map(slots: DataFrame) -> Column:
    """The numbers of a column ``slot`` as a map of ``SLOTS`` bytes."""
    out = bytearray(SLOTS)
    for row in slots.where("slot is not null").distinct().collect():  # SLOTS numbers at most
        out[row.slot] = 1
    return F.lit(bytes(out))


def _marked(slots: Column, slot: Column) -> Column:
    return F.substring(slots, slot.cast("int") + 1, F.lit(1)) == F.lit(b"\x01")


def _segment(same: Column, least: Column, share: float) -> Column:
    """The longest run of an array of booleans with ``least`` elements or more and a ``share`` of true ones.

    As struct(start, length, equal), start from 0, the first of equals; null if there is none.
    False elements at the ends of the run are left out as far as ``least`` elements remain.

    A run has the share if true minus share x length has not fallen from its start to its
    end; the longest run to an end begins where that balance first was as low, which
    is one of the places where it was lower than at all places before.
    """
    tiny = 1e-9
    balance = lambda p: p["equal"] - F.lit(share) * p["at"]
    point = lambda at, equal: F.struct(at.alias("at"), equal.alias("equal"))
    run = lambda start, length, equal: F.struct(start.alias("start"), length.alias("length"), equal.alias("equal"))
    zero = point(F.lit(0), F.lit(0))

    def step(acc: Column, x: Column) -> Column:
        now = point(acc["now"]["at"] + 1, acc["now"]["equal"] + x.cast("int"))
        low = F.get(F.filter(acc["lows"], lambda p: balance(p) <= balance(now) + tiny), F.lit(0))
        length = now["at"] - low["at"]
        better = low.isNotNull() & (length >= least) & (length > acc["best"]["length"])
        best = F.when(better, run(low["at"], length, now["equal"] - low["equal"])).otherwise(acc["best"])
        lows = F.when(low.isNull(), F.concat(acc["lows"], F.array(now))).otherwise(acc["lows"])
        return F.struct(now.alias("now"), lows.alias("lows"), best.alias("best"))

    start = F.struct(zero.alias("now"), F.array(zero).alias("lows"), run(F.lit(0), F.lit(0), F.lit(0)).alias("best"))

    def trimmed(best: Column) -> Column:
        inner = F.slice(same, best["start"] + 1, best["length"])
        first = F.least(F.array_position(inner, F.lit(True)).cast("int") - 1, best["length"] - least)
        last = best["length"] - F.array_position(F.reverse(inner), F.lit(True)).cast("int") + 1
        return run(best["start"] + first, F.greatest(last - first, least), best["equal"])

    # fewer true elements than the shortest run needs: most alignments of a chance hit end here
    enough = (F.size(same) >= least) & (F.size(F.filter(same, lambda x: x)) >= F.lit(share) * least - tiny) & (least > 0)
    best = F.get(F.filter(F.array(F.aggregate(same, start, step, lambda acc: acc["best"])), lambda b: b["length"] > 0), F.lit(0))
    return F.when(enough, F.get(F.transform(F.array(best), lambda b: F.when(b.isNotNull(), trimmed(b))), F.lit(0)))


def overlaps(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str,
    least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """(id_col, item_col, start, words, equal_words) of passages that documents share with benchmark items.

    Words are lower-case runs of letters and digits. An alignment puts item and
    document against each other at a fixed distance; it is tried if a seed hits
    on it. An overlap is any run along it of ``least_words`` words or more (or the whole
    item, if that is shorter) of which ``least_share`` are equal. The longest one
    counts, without the other words at its ends beyond ``least_words``. start is its first
    word in the document, from 0. Of several alignments of an item the one with
    most equal words, then the first, stays.

    Items of fewer than ``least_words`` words are found by equal pieces, one more than
    words may differ. Null ids take part like others; null texts match nothing. Repeated documents or items each give the rows of
    one. Empty tables give no rows. Other columns are not read.
    """
    key = F.xxhash64("doc", "text")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    bench = items.select(F.col(f"`{item_col}`").alias("item"), tokens(F.col(f"`{item_text}`")).alias("words")).distinct()
    bench = stored(bench.withColumn("item_key", F.xxhash64("item", "words")))
    short = bench.where((F.size("words") > 0) & (F.size("words") < least_words))
    pieces = short.select("item_key", F.inline(_pieces(F.col("words"), least_share)))
    index = bench.select("item_key", F.inline(_hits(F.col("words")))).unionByName(pieces)
    index = stored(index.withColumnRenamed("at", "item_at").distinct())
    slots = _map(bench.select(F.explode(_pairs(F.col("words"))).alias("slot")))

    # most word pairs are in no item, and most hashes neither: both go before any shuffle
    hits = _hits(tokens(F.col("text")), lambda slot: _marked(slots, slot))
    lengths = [r.n for r in short.select(_piece_length(F.col("words"), least_share).alias("n")).distinct().collect()]  # below least_words
    if lengths:
        known = _map(pieces.select(F.pmod("hash", F.lit(SLOTS)).alias("slot")))

        def of(words: Column) -> Column:
            def at_all(n: int) -> Column:
                places = F.sequence(F.lit(0), F.size(words) - n)
                return F.when(F.size(words) >= n, F.transform(places, lambda p: _piece(words, p, F.lit(n))))

            every = F.flatten(F.array_compact(F.array(*map(at_all, sorted(lengths)))))
            return F.filter(every, lambda x: _marked(known, F.pmod(x["hash"], F.lit(SLOTS))))

        hits = F.concat(hits, F.get(F.transform(F.array(tokens(F.col("text"))), of), 0))
    found = texts.select(key.alias("key"), F.inline(hits))
    found = found.join(F.broadcast(index) if index.count() <= BROADCAST_HASHES else index, "hash")
    found = stored(found.select("key", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct())

    wanted = found.select(F.col("key").alias("wanted")).distinct()
    some = texts.withColumn("key", key).join(wanted, F.col("key") == F.col("wanted"), "left_semi")
    some = stored(some.dropDuplicates(["key"]).select("key", "doc", tokens(F.col("text")).alias("doc_words")))
    rows = found.join(some, "key").join(bench, "item_key")
    start = F.greatest(F.col("shift"), F.lit(0))
    skip = F.greatest(-F.col("shift"), F.lit(0))
    length = F.least(F.size("doc_words") - start, F.size("words") - skip)
    rows = rows.withColumn("same", F.zip_with(F.slice("doc_words", start + 1, length), F.slice("words", skip + 1, length), lambda x, y: x == y))
    needed = F.least(F.lit(least_words), F.size("words"))
    rows = rows.withColumn("s", _segment(F.col("same"), needed, least_share)).where("s is not null").withColumn("start", start + F.col("s.start"))
    best = F.max_by(F.struct("start", "s.length", "s.equal"), F.struct("s.equal", -F.col("start")))
    rows = rows.groupBy("key", "doc", "item_key", "item").agg(best.alias("b"))
    return rows.select(
        F.col("doc").alias(id_col), F.col("item").alias(item_col), F.col("b.start").cast("long").alias("start"),
        F.col("b.length").cast("long").alias("words"), F.col("b.equal").cast("long").alias("equal_words"),
    ).distinct()


def clean(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, **how) -> DataFrame:
    """``docs`` without the documents that share a passage with an item.

    A repeated id goes if one of its texts has an overlap.
    """
    found = overlaps(docs, items, id_col, text_col, item_col, item_text, **how)
    bad = own_name(docs, "leaked")
    found = stored(found.select(F.col(f"`{id_col}`").alias(bad)).distinct())
    return docs.join(found, F.col(f"`{id_col}`").eqNullSafe(F.col(bad)), "left_anti")
