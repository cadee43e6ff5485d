"""Alignment of two vocabularies against the plain definition, on the small tables and on odd rows."""

import collections
import hashlib

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelkit.llm import token_alignment as ta
from panelkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
TEXT = st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab 's\n\t▁<>|0é '\U0001f600")), max_size=60)


@pytest.fixture(scope="module")
def plain():
    """Both tokenisers, called as their libraries document, and the bytes of their ids."""
    a = Tokenizer.from_file(ta.BYTE_LEVEL)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=ta.PIECES)
    alphabet = ta.byte_alphabet()

    def of_a(text):
        ids = a.encode_batch([" " + text], add_special_tokens=False)[0].ids
        return ids, [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids]

    def of_b(text):
        ids = b.encode(text, num_threads=1)
        names = [b.id_to_piece(i) for i in ids]
        return ids, [bytes([int(n[3:-1], 16)]) if b.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(ids, names)]

    return of_a, of_b


def by_definition(plain, text):
    """(n_a, n_b, n_groups, digest, links) with sets of offsets."""
    if not text:
        return 0, 0, 0, "", []
    (a, in_a), (b, in_b) = (of(text) for of in plain)
    if b"".join(in_a) != (" " + text).encode() or b"".join(in_b) != (" " + text).encode():
        return 0, 0, 0, "", []
    ends_a, ends_b = (np.cumsum([len(x) for x in entries]).tolist() for entries in (in_a, in_b))
    both = sorted(set(ends_a) & set(ends_b))
    groups, links, low = [], [], 0
    for high in both:
        groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends) if low < e <= high) for ids, ends in ((a, ends_a), (b, ends_b))))
        links += [(i, j) for i, e in zip(a, ends_a) if e == high for j, f in zip(b, ends_b) if f == high]
        low = high
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def expected(plain, rows):
    """The rows of the operator for (id, text) pairs."""
    per_row = [(key, by_definition(plain, text)) for key, text in rows]
    count = collections.Counter(link for _, found in per_row for link in found[4])
    best = collections.defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [
        (key, *f[:3], len(f[4]), sum(count[x] == best[x[1]] for x in f[4]), sum(count[x] for x in f[4]), f[3]) for key, f in per_row
    ]


def test_query_on_short_documents(spark, plain):
    """The whole table goes through the query; the definition is quadratic in a text, so links are counted by sets here."""
    table = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_run_skipping"](spark, FOLDER).collect()}
    assert len(got) == len(table)
    found = {}
    for key, text in table:
        (a, in_a), (b, in_b) = (of(text) if text else ([], []) for of in plain)
        if b"".join(in_a) != (" " + (text or "")).encode() or b"".join(in_b) != (" " + (text or "")).encode():
            a, in_a, b, in_b = [], [], [], []
        at_a = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in in_a]))}
        at_b = {int(e): k for k, e in enumerate(np.cumsum([len(x) for x in in_b]))}
        stops = [(at_a[e] + 1, at_b[e] + 1) for e in sorted(set(at_a) & set(at_b))]
        parts = [f"{','.join(map(str, a[i:k]))}|{','.join(map(str, b[j:m]))}" for (i, j), (k, m) in zip([(0, 0), *stops], stops)]
        found[key] = (len(a), len(b), len(stops), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "", [(a[i - 1], b[j - 1]) for i, j in stops])
    count = collections.Counter(x for f in found.values() for x in f[4])
    best = collections.defaultdict(int)
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    for key, f in found.items():
        assert got[key] == (key, *f[:3], len(f[4]), sum(count[x] == best[x[1]] for x in f[4]), sum(count[x] for x in f[4]), f[3])


ODD = [
    (1, "one two three"), (2, None), (3, ""), (4, " "), (5, "\t\n x  y"), (6, "Grüße 😀 <|endoftext|> <s> </s> <unk> <0x41>"),
    (7, "a▁b"), (8, "ab" * 3000), (9, "x\u0000y﻿z‍"), (10, "one two three"), (1, "one two three"), (None, "it's o'clock"),
    (11, "wort " * 60_000), (12, "  two  spaces   and more    "), (13, "é é ﬁ ① 中文 한국어 עברית"), (14, " lead"),
]


def test_odd_rows(spark, plain):
    schema = "doc_id long, text string, code string, id long, `times` long, `a.b` long"
    df = spark.createDataFrame([(k, t, "c", 1, None, 2) for k, t in ODD], schema).repartition(3)
    got = sorted((tuple(r) for r in ta.alignments(df, "doc_id", "text").collect()), key=str)
    short = [(k, t) for k, t in ODD if k != 11]
    long_row = next(r for r in got if r[0] == 11)
    (a, _), (b, _) = (of(ODD[12][1]) for of in plain)
    assert long_row[1:3] == (len(a), len(b))
    without = df.where("doc_id is null or doc_id <> 11")
    assert sorted((tuple(r) for r in ta.alignments(without, "doc_id", "text").collect()), key=str) == sorted(expected(plain, short), key=str)


def test_pieces_change_nothing(spark):
    df = spark.createDataFrame(ODD + [(20, "Das ist ein Satz, und noch einer. " * 300)], "doc_id long, text string")
    whole, cut = (sorted(map(str, ta.alignments(df, "doc_id", "text", piece=p).collect())) for p in (1 << 30, 50))
    assert whole == cut


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.alignments(empty, "doc_id", "text").count() == 0
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, ta.alignments(nulls, "doc_id", "text").collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.fixture(scope="module")
def aligner():
    return ta.Aligner(ta.byte_level(ta.BYTE_LEVEL, ta.merges_by_rank(ta.BYTE_LEVEL)), ta.piece_vocabulary(ta.PIECES))


@settings(max_examples=300, deadline=None)
@given(text=TEXT)
def test_any_text(plain, aligner, text):
    n, m = len(aligner.first.entries), len(aligner.second.entries)
    want = by_definition(plain, text)
    *got, links = aligner.aligned(text)
    assert tuple(got) == want[:4] and links.tolist() == [i * m + j for i, j in want[4]] and n == 50257


def test_both_ways_to_encode_agree(aligner):
    slow = ta.byte_level(ta.BYTE_LEVEL, False)
    texts = [t for t, in duckdb.sql(f"select text from '{FOLDER}/documents.parquet' where text is not null order by doc_id limit 200").fetchall()]
    for text in [*texts, *(t for _, t in ODD if t)]:
        assert list(slow.encode(" " + text)) == list(aligner.first.encode(" " + text))


@given(st.sets(st.integers(1, 400)), st.sets(st.integers(1, 400)), st.integers(401, 500))
def test_stops(a, b, last):
    a, b = sorted(a | {last}), sorted(b | {last})
    both = sorted(set(a) & set(b))
    got = ta.common_stops(np.array(a), np.array(b))
    assert [g.tolist() for g in got] == [[x.index(e) + 1 for e in both] for x in (a, b)]


@pytest.mark.parametrize("irregular", [[], [7], [0, 1, 2], [63, 64, 65, 500], list(range(0, 999, 3))])
def test_stops_around_long_stretches(irregular):
    a = np.arange(1, 1001) * 4
    b = np.delete(a, [k for k in irregular if k < 999])
    c = np.sort(np.append(b, [x + 1 for x in irregular]))
    for x, y in ((a, b), (b, a), (a, c), (c, b)):
        both = np.intersect1d(x, y, return_indices=True)
        got = ta.common_stops(x, y)
        assert (got[0] == both[1] + 1).all() and (got[1] == both[2] + 1).all() and len(got[0]) == len(both[0])


def test_links_are_suffixes(aligner):
    a, b = aligner.first.entries, aligner.second.entries
    text = " ".join(t for _, t in ODD if t and len(t) < 100)
    *_, links = aligner.aligned(text.replace("▁", ""))
    for code in links.tolist():
        x, y = a[code // len(b)], b[code % len(b)]
        assert x.endswith(y) or y.endswith(x)
    small_a, small_b = [b"ab", b"b", b"b", b"c"], [b"b", b"xb", b"zab", b"q"]
    brute = sum(x.endswith(y) or y.endswith(x) for x in small_a for y in small_b)
    assert ta.possible_pairs(small_a, small_b) == brute


@pytest.mark.parametrize("long", [200, 255, 256, 70_000])
def test_stops_of_long_tokens(long):
    a = np.cumsum([1, long, 1, 1, *[long] * 100, 2, 3])
    b = np.cumsum([1 + long, 2, *[long] * 100, 4, 1])
    both = np.intersect1d(a, b, return_indices=True)
    got = ta.common_stops(a, b)
    assert (got[0] == both[1] + 1).all() and (got[1] == both[2] + 1).all() and len(got[0]) == 103


@pytest.mark.parametrize("piece", [1, 50, 1000, ta.PIECE])
def test_texts_together(plain, aligner, piece):
    """Texts that are aligned together, among them some that are not given back, give what each gives by the definition."""
    texts = [t for _, t in ODD if t is None or len(t) < 10_000] + ["a ▁ b", "It is a long one. " * 100, "▁", "", "end"]
    cut = ta.Aligner(aligner.first, aligner.second, piece)
    got = list(cut.aligned_all(iter(texts)))
    assert len(got) == len(texts) and len({g[:4] for g in got}) > 10
    m = len(aligner.second.entries)
    for text, (*row, links) in zip(texts, got):
        want = by_definition(plain, text)
        assert tuple(row) == want[:4] and links.tolist() == [i * m + j for i, j in want[4]]


def test_short_texts_share_a_search(aligner, monkeypatch):
    """The cost beside the tokenisers is one of blocks of text, whatever the number of texts."""
    calls, search = [], ta.common_stops
    monkeypatch.setattr(ta, "common_stops", lambda a, b: calls.append(len(a)) or search(a, b))
    rows = list(aligner.aligned_all(f"text number {k}, not a long one" for k in range(500)))
    assert len(rows) == 500 and all(r[0] for r in rows)
    assert calls == [sum(r[0] for r in rows)]
