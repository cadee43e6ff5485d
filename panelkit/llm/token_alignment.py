"""Alignment of the tokens that two vocabularies cut from the same text.

Tokens' lengths in bytes are compared at the current shift between the two index
sequences, from a place where both end. While slices agree the step doubles, so that stretches of
one-to-one tokens are jumped over by a few comparisons; where they do not, the first
difference is the lowest bit set in their exclusive or, the end that lags is moved on until
both meet, and the shift that results holds from there.

Two tokens that end at the same byte of the same text are suffixes of one another. The
pairs of ids that can ever be linked are therefore bounded by the bytes of the two
vocabularies, whatever the corpus, and their counts may be sent to all executors.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import col, in_arrow, settled
from panelkit.llm.token_counts import PATTERN, pieces

#: The two vocabularies: byte-level BPE, and pieces with bytes as a fallback.
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
#: Texts are cut into pieces of about this many characters, where both vocabularies cut as well.
PIECE = 1 << 18
#: Lengths compared at once at first.
PROBE = 32
#: Links held until they are counted, and pairs in a row of counts.
HELD, ROW = 1 << 20, 1 << 16


@dataclass(frozen=True)
class Vocabulary:
    """A function from text to ids, and the bytes of every id.

    A lossless one has an entry for every byte and gives every text back.
    """

    encode: Callable[[str], list[int] | np.ndarray]
    entries: list[bytes]
    lossless: bool = False


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merges_by_rank(path: str) -> bool:
    """True if merging the adjacent pair whose joined entry has the lowest id is the same as following the merge list.

    It is, if the k-th merge makes the k-th entry after the bytes, and the list makes every
    entry out of its own bytes: a pair of tokens is adjacent only where the merges inside the two
    were the ones that their bytes alone would have made, so a pair that is not in the list
    would leave its joined entry in two parts there as well.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    vocab = model["vocab"]
    alphabet = byte_alphabet()
    if any(vocab.get(a + b) != 256 + k for k, (a, b) in enumerate(merges)):
        return False
    if sorted(vocab[c] for c in alphabet) != list(range(256)):
        return False
    whole = Tokenizer.from_file(path).model
    return all(len(whole.tokenize(a + b)) == 1 for a, b in merges)


def byte_level(path: str, by_rank: bool) -> Vocabulary:
    """A byte-level vocabulary; ``by_rank`` as ``merges_by_rank`` says."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    alphabet = byte_alphabet()
    special = {t["id"]: t["content"].encode() for t in made["added_tokens"]}
    entries = [b""] * (max([*made["model"]["vocab"].values(), *special]) + 1)
    for text, k in made["model"]["vocab"].items():
        entries[k] = special.get(k) or bytes(alphabet[c] for c in text)
    if by_rank:
        import tiktoken

        ranks = {entries[k]: k for k in range(256 + len(made["model"]["merges"]))}
        fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return Vocabulary(fast.encode_ordinary, entries, True)
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True
    return Vocabulary(lambda text: whole.encode_batch([text], add_special_tokens=False)[0].ids, entries, True)


def piece_vocabulary(path: str) -> Vocabulary:
    """A vocabulary of pieces, which puts a space before the text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(k) for k in range(model.get_piece_size())]
    entries = [
        bytes([int(name[3:-1], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode() for k, name in enumerate(names)
    ]
    if any("▁" in name.lstrip("▁") for name in names):
        raise ValueError("pieces run over spaces")
    return Vocabulary(lambda text: model.encode(text, num_threads=1), entries)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """Pairs of entries of which one ends with the other."""
    def counts(entries: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for e in entries:
            out[e] = out.get(e, 0) + 1
        return out

    in_a, in_b = counts(a), counts(b)
    ends = sum(in_b.get(e[k:], 0) for e in a for k in range(len(e)))
    return ends + sum(in_a.get(e[k:], 0) for e in b for k in range(1, len(e)))


def common_stops(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """After how many tokens of each sequence both end at the same place, for rising ends with the same last one.

    ``a`` and ``b`` are the ends. Slices of their differences are compared at the shift j - i, with steps that
    double while they are equal.
    """
    n, i, j = len(a), 0, 0
    sizes = [np.diff(x, prepend=0) for x in (a, b)]
    kind = np.min_scalar_type(max(int(x.max(initial=0)) for x in sizes))
    a, b = (memoryview(x.astype(kind)) for x in sizes)
    w, number = kind.itemsize, int.from_bytes
    raw_a, raw_b = a.tobytes() + b"\xff" * w, b.tobytes()  # no slice beyond the end is equal
    stretches = []  # starts and length, one after the other: every token on from the starts is a stop
    start_a = start_b = 0
    while True:
        step = PROBE * w
        at_a, at_b = i * w, j * w
        while not (differ := number(raw_a[at_a : at_a + step], "little") ^ number(raw_b[at_b : at_b + step], "little")):
            at_a, at_b, step = at_a + step, at_b + step, 2 * step
        same = ((differ & -differ).bit_length() - 1) // (8 * w)
        i, j = at_a // w + same, at_b // w + same
        stretches += start_a, start_b, i - start_a
        if i == n:
            break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x += a[i]
            else:
                j += 1
                y += b[j]
        start_a, start_b = i, j  # the group that ends here opens the next stretch
        i, j = i + 1, j + 1
    starts_a, starts_b, total = np.array(stretches, np.int64).reshape(-1, 3).T
    inside = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total) + 1
    return tuple(np.repeat(s, total) + inside for s in (starts_a, starts_b))


@dataclass
class _Text:
    """What is known of a text of which some pieces are aligned."""

    digest: object = field(default_factory=hashlib.sha256)
    counts: list[int] = field(default_factory=lambda: [0, 0, 0])
    links: list[np.ndarray] = field(default_factory=list)
    broken: bool = False

    def row(self) -> tuple[int, int, int, str, np.ndarray]:
        if self.broken or not self.links:
            return 0, 0, 0, "", np.zeros(0, np.int64)
        return (*self.counts, self.digest.hexdigest(), np.concatenate(self.links))


class Aligner:
    """Tokens, groups and links of texts under two vocabularies.

    A group is written as its ids of the first vocabulary, then those of the second,
    ``a1,a2|b1``; groups are joined by semicolons.
    """

    def __init__(self, first: Vocabulary, second: Vocabulary, piece: int = PIECE):
        self.first, self.second, self.piece = first, second, piece
        self.sizes = [np.array([len(e) for e in v.entries]) for v in (first, second)]
        self.bytes = [pa.array(v.entries, pa.large_binary()) for v in (first, second)]
        n, m = len(first.entries), len(second.entries)
        texts = [f"{k}," for k in range(n)] + [f"{k}|" for k in range(n)] + [f"{k}," for k in range(m)] + [f"{k};" for k in range(m)]
        self.texts = pa.array(texts, pa.large_binary())

    def _written(self, a: np.ndarray, b: np.ndarray, stop_a: np.ndarray, stop_b: np.ndarray) -> tuple[bytes, np.ndarray]:
        n, m = len(self.first.entries), len(self.second.entries)
        key = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[stop_a - 1], last_b[stop_b - 1] = 1, 1
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        key[np.arange(len(a)) + np.append(0, stop_b)[group_a]] = a + n * last_a
        key[np.arange(len(b)) + stop_a[group_b]] = 2 * n + b + m * last_b
        return _joined(self.texts, key)

    def _add(self, block: list[tuple[_Text, str]]) -> None:
        """Align the pieces of ``block`` and add what is found to their texts."""
        block = [(of, spaced) for of, spaced in block if not of.broken]
        raw = [spaced.encode() for _, spaced in block]
        ids, cuts = [], []
        for v in (self.first, self.second):
            # the second vocabulary puts the first space itself
            found = [v.encode(spaced if v is self.first else spaced[1:]) for _, spaced in block]
            cuts.append(np.cumsum([0, *map(len, found)]))
            ids.append(np.fromiter(chain.from_iterable(found), np.int64, int(cuts[-1][-1])))
        for v, entries, flat, cut in zip((self.first, self.second), self.bytes, ids, cuts):
            if not v.lossless:
                joined, at = _joined(entries, flat)
                for (of, _), said, low, high in zip(block, raw, at[cut[:-1]].tolist(), at[cut[1:]].tolist()):
                    of.broken = of.broken or joined[low:high] != said
        whole = np.array([not of.broken for of, _ in block], bool)
        if not whole.any():
            return
        if not whole.all():
            block = [x for x, kept in zip(block, whole) if kept]
            ids = [flat[np.repeat(whole, np.diff(cut))] for flat, cut in zip(ids, cuts)]
            cuts = [np.cumsum(np.append(0, np.diff(cut)[whole])) for cut in cuts]
        (a, b), (cut_a, cut_b) = ids, cuts
        stop_a, stop_b = common_stops(*[np.cumsum(size[flat]) for size, flat in zip(self.sizes, ids)])
        written, at = self._written(a, b, stop_a, stop_b)
        links = a[stop_a - 1] * len(self.second.entries) + b[stop_b - 1]
        cut = np.searchsorted(stop_a, cut_a, "right")
        cut_text = at[cut_a + cut_b]
        for k, (of, _) in enumerate(block):
            if of.links:
                of.digest.update(b";")
            of.digest.update(written[cut_text[k] : cut_text[k + 1] - 1])
            of.links.append(links[cut[k] : cut[k + 1]])
            of.counts = [x + int(c[k + 1] - c[k]) for x, c in zip(of.counts, (cut_a, cut_b, cut))]

    def aligned_all(self, texts: Iterable[str | None]) -> Iterator[tuple[int, int, int, str, np.ndarray]]:
        """For every text, in order: tokens of each vocabulary, groups, the digest of the groups, and a code for the ids of each link.

        The code is the first id times the size of the second vocabulary, plus the second id.
        Texts that are null, empty, or not the joined bytes of their tokens have none, and an empty digest.
        Short texts are aligned together, pieces of long ones apart.
        """
        waiting, block, size = [], [], 0
        for text in texts:
            waiting.append(_Text())
            for k, part in enumerate(filter(None, pieces(text or "", self.piece))):
                block.append((waiting[-1], f" {part}" if k == 0 else part))
                size += len(part)
                if size >= self.piece:
                    self._add(block)
                    block, size = [], 0
            if not block:
                yield from (of.row() for of in waiting)
                waiting = []
        if block:
            self._add(block)
        yield from (of.row() for of in waiting)

    def aligned(self, text: str | None) -> tuple[int, int, int, str, np.ndarray]:
        """``aligned_all`` of one text."""
        return next(self.aligned_all([text]))


def _joined(entries: pa.Array, keys: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bytes of the entries at ``keys``, one after the other, and where each starts; the last place is their length."""
    _, at, joined = entries.take(pa.array(keys)).buffers()
    return joined.to_pybytes() if joined else b"", np.frombuffer(at, np.int64)[: len(keys) + 1]


def _counted(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, and the sums of their times."""
    joined = np.concatenate(codes)
    if not len(joined):
        return joined, joined
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    first = np.flatnonzero(np.diff(joined, prepend=-1))
    return joined[first], np.add.reduceat(np.concatenate(times)[order], first)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)])))


def _located(spark: SparkSession, *paths: str) -> list[str]:
    """Ship files to all executors; the names under which ``SparkFiles.get`` finds them."""
    for path in paths:
        spark.sparkContext.addFile(path)
    return [path.rstrip("/").rsplit("/", 1)[-1] for path in paths]


def alignments(docs: DataFrame, id_col: str, text_col: str, first: str = BYTE_LEVEL, second: str = PIECES, piece: int = PIECE) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    n_links counts the pairs of token occurrences that end together, one for each group. The
    count of a pair of ids is how many links of all rows hold it: n_best counts links whose
    count is the highest of their second id, count_sum sums the counts.
    Null and empty texts and texts that either vocabulary does not give back byte by byte
    have zeros and no digest. Rows may repeat, and then count again; null ids stay; an empty
    table gives no rows; other columns are not read. A text is tokenised in pieces cut
    before a space between letters, where both vocabularies cut; the vocabularies'
    files are sent to the executors.
    """
    spark = docs.sparkSession
    names = _located(spark, first, second)
    by_rank = merges_by_rank(SparkFiles.get(names[0]))

    def vocabularies() -> tuple[Vocabulary, Vocabulary]:
        return byte_level(SparkFiles.get(names[0]), by_rank), piece_vocabulary(SparkFiles.get(names[1]))

    flat = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    schema = T.StructType([
        flat.schema["id"], *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups")],
        T.StructField("groups_sha256", T.StringType()), T.StructField("of_row", T.BooleanType()),
        T.StructField("code", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType())),
    ])

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*vocabularies(), piece)
        held, held_times, waiting, kind = [], [], 0, pa.null()
        for batch in batches:
            kind, texts, at = batch.column(0).type, batch.column(1), 0
            rows, codes, times, n = [], [], [], 0
            for k, (*row, links) in enumerate(aligner.aligned_all(text.as_py() for text in texts)):
                code, often = np.unique(links, return_counts=True)
                rows.append(row)
                codes.append(code)
                times.append(often)
                held.append(code)
                held_times.append(often)
                n, waiting = n + len(code), waiting + len(code)
                if waiting > HELD:
                    merged = _counted(held, held_times)
                    held, held_times, waiting = [merged[0]], [merged[1]], 0
                if n > HELD or k + 1 == batch.num_rows:
                    a, b, g, digest = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, len(rows)), *[pa.array(x, pa.int64()) for x in (a, b, g)], pa.array(digest),
                         pa.array([True] * len(rows)), _lists(codes), _lists(times)], schema.names)
                    rows, codes, times, n, at = [], [], [], 0, k + 1
        if held:
            code, often = _counted(held, held_times)
            for start in range(0, len(code), ROW):
                none = [pa.array([None], kind), *[pa.array([None], pa.int64())] * 3, pa.array([None], pa.string()), pa.array([False])]
                yield pa.RecordBatch.from_arrays([*none, _lists([code[start : start + ROW]]), _lists([often[start : start + ROW]])], schema.names)

    found = settled(flat.transform(in_arrow, aligned, schema))
    one = F.explode(F.arrays_zip("code", "times")).alias("pair")
    counts = found.where("not of_row").select(one).groupBy("pair.code").agg(F.sum("pair.times").alias("times"))
    a, b = vocabularies()
    code, count = _bounded(counts, possible_pairs(a.entries, b.entries))
    highest = np.zeros(len(b.entries), np.int64)
    second_id = code % len(b.entries)
    np.maximum.at(highest, second_id, count)
    sent = spark.sparkContext.broadcast((code, count, count == highest[second_id]))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, count, best = sent.value
        for batch in batches:
            place = np.searchsorted(code, batch.column(5).flatten().to_numpy())
            times = batch.column(6).flatten().to_numpy()
            ends = np.cumsum(np.append(0, batch.column(5).value_lengths().to_numpy()))

            def per_row(values: np.ndarray) -> np.ndarray:
                total = np.append(0, np.cumsum(values, dtype=np.int64))
                return total[ends[1:]] - total[ends[:-1]]

            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *[pa.array(per_row(v), pa.int64()) for v in (times, times * best[place], times * count[place])]],
                ["id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"],
            )

    out = T.StructType([*schema.fields[:5], *[T.StructField(c, T.LongType()) for c in ("n_links", "n_best", "count_sum")]])
    rows = found.where("of_row").drop("of_row").transform(in_arrow, scored, out)
    return rows.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def _bounded(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order and their counts; more than ``most`` of them raise."""
    rows = counts.limit(most + 1).toArrow().sort_by("code")
    if rows.num_rows > most:
        raise RuntimeError("more pairs of ids than the vocabularies allow")
    return rows.column("code").to_numpy(), rows.column("times").to_numpy()
