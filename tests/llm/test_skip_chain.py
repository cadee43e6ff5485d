"""Personal data: base spans against plain regular expressions, the field against enumeration, odd rows."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelkit.llm import skip_chain as sc
from panelkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def checks(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(int(p) <= 255 for p in match.split("."))
    if kind == 2:
        total = sum(d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(map(int, digits[::-1])))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def plainly(text):
    return [
        (kind, m.start(), m.end()) for kind, p in enumerate(PATTERNS) for m in re.finditer(p, text) if checks(kind, m.group())
    ]


def row(key, text):
    spans = plainly(text or "")
    base = ",".join(f"{sc.KINDS[k]}:{a}:{b}" for k, a, b in spans)
    return (key, *[sum(s[0] == k for s in spans) for k in range(4)], hashlib.sha256(base.encode()).hexdigest()), base


def test_query_on_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op13_skip_chain"](spark, FOLDER).collect()}
    table = duckdb.sql(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    assert len(got) == len(table)
    for key, text in table:
        want, base = row(key, text)
        assert tuple(got[key])[:6] == want
        assert set(filter(None, base.split(","))) <= set(got[key].spans.split(","))
        if not re.search("[0-9@]", text or ""):
            assert got[key].spans == ""
        for part in filter(None, got[key].spans.split(",")):
            _, start, end = part.split(":")
            assert re.search("[0-9@]", text[int(start) : int(end)])


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0123456789.@+-() ab_é%\n", max_size=60))
def test_base_spans(text):
    assert sc.base_spans(text) == plainly(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4785380592391139", "4785 3805 9239 1139", "1.2.3.4", "255.256.0.1", ".5", "+1 (743) 555-3824", "a.b@c.de", "@", " ", "-", "x@y", "+", "0", "007.0.0.1"]), max_size=12).map("".join))
def test_base_spans_of_joined_parts(text):
    assert sc.base_spans(text) == plainly(text)
    places = list(sc.tokens(text))
    assert all(a < b and re.search("[0-9@]", text[a:b]) for a, b in places) and all(x[1] <= y[0] for x, y in zip(places, places[1:]))
    covered = {i for a, b in places for i in range(a, b)}
    assert all(i in covered for i, c in enumerate(text) if c in "0123456789@")


@pytest.mark.parametrize("text", ["1" * 300_000, "1." * 100_000, "a" * 300_000 + "1", "a." * 100_000 + "@", "@" * 100_000, "+1" * 100_000, "+1" + "(" * 200_000, "1 " * 100_000])
def test_long_runs_take_linear_time(text):
    spans = sc.base_spans(text)
    sc.patterns(sc.nodes(text, spans))


WEIGHTS = sc.Weights(
    *[np.random.default_rng(4).normal(size=s) for s in ((sc.TRAITS + 1, 7), (8, 8), 5, 5)]
)


def enumerated(n, w):
    """Marginals by the sum over all labellings."""
    size, kind = len(n.start), sc.KIND_OF
    out = np.zeros((size, 7))
    followed = {b for b in n.beside if b >= 0}
    for y in itertools.product(range(7), repeat=size):
        if any(k >= 0 and k != v for k, v in zip(n.known, y)):
            continue
        score = 0.0
        for i, v in enumerate(y):
            score += w.trait[sc.TRAITS, v] + sum(w.trait[t, v] for t in range(sc.TRAITS) if n.form[i] >> t & 1)
            score += w.chain[7, v] if n.beside[i] < 0 else w.chain[y[n.beside[i]], v]
            score += 0 if i in followed else w.chain[v, 7]
            for before, like in ((n.same, w.same), (n.similar, w.similar)):
                if before[i] >= 0 and kind[y[before[i]]] == kind[v]:
                    score += like[kind[v]]
        for i, v in enumerate(y):
            out[i, v] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def field(text, spans=()):
    return sc.nodes(text, list(spans))


@pytest.mark.parametrize("text", ["12 34 5", "7 x 8", "12345678 and 12345678", "1 2 x 55512345678 y 5512345678"])
def test_messages_are_exact_on_trees(text):
    n = field(text)
    assert np.abs(sc.marginals([n], WEIGHTS) - enumerated(n, WEIGHTS)).max() < 1e-3


def test_messages_with_known_labels_and_loops():
    text = "5553824000 x 5553824000 5553824000"
    n = field(text, [(3, 0, 10)])
    assert n.known == [5, -1, -1]
    p, exact = sc.marginals([n], WEIGHTS), enumerated(n, WEIGHTS)
    assert p[0, 5] > 0.999 and np.abs(p - exact).max() < 0.2  # loops: not exact


def test_documents_do_not_touch_each_other():
    docs = [field(t) for t in ("12 34 5", "7", "12345678 and 12345678 5 6 7 12345678", "a@b c@d a@b")]
    together = sc.marginals(docs, WEIGHTS)
    assert np.array_equal(together, np.concatenate([sc.marginals([d], WEIGHTS) for d in docs]))


def test_patterns_hold_neighbours():
    n = field("+1 (743) 555-3824 then 555-3824", [(3, 0, 17)])
    assert n.known == [5, 6, 6, -1] and n.beside == [-1, 0, 1, -1] and n.same == [-1, -1, -1, 2] and n.similar == [-1, -1, -1, 2]
    fields = [[(p >> (3 * k)) & 7 for k in range(7)] for p in sc.patterns(n)]
    assert fields == [[5, 7, 6, 7, 7, 7, 7], [6, 5, 6, 7, 7, 7, 7], [6, 6, 7, 7, 0, 7, 0], [0, 7, 7, 4, 7, 4, 7]]


def test_fit_raises_the_pseudo_likelihood():
    texts = [f"call +1 ({a}) 555-{b} or {c}.{c}.0.1 then {b}" for a, b, c in zip(range(200, 260), range(1000, 1060), range(60))]
    codes = np.array([p for t in texts for p in sc.patterns(sc.nodes(t, sc.base_spans(t)))])
    pattern, count = np.unique(codes, return_counts=True)
    w = sc.fit(pattern, count.astype(float))
    hits = total = 0
    for t in texts:
        n = sc.nodes(t, sc.base_spans(t))
        p = sc.marginals([sc.Nodes(**{**n.__dict__, "known": [-1] * len(n.known)})], w).argmax(axis=1)
        hits, total = hits + sum(int(v) == max(k, 0) for v, k in zip(p, n.known)), total + len(p)
    assert hits / total > 0.97
    again = sc.fit(pattern, count.astype(float))
    assert (w.trait == again.trait).all()


def card(k):
    """A number of 16 digits with the right check sum."""
    return next(n for n in (str(4 * 10**15 + 7919 * k * 10 + d) for d in range(10)) if checks(2, n))


PLAIN = [f"lorem {i} ipsum {card(i)} nec +1 ({200 + i}) 555-{1000 + i} dolor a.b{i}@mail.example.com sit 10.{i}.2.3 amet password=ab{i}cd version {i % 9}.0." for i in range(150)]


def planted(spark, rows):
    schema = "doc_id long, text string, base string, n_email int, id long, `a.b` long, pattern string"
    df = spark.createDataFrame([(k, t, "x", 1, 2, None, "y") for k, t in rows], schema).repartition(3)
    return sorted((tuple(r) for r in sc.personal_data(df, "doc_id", "text").collect()), key=str)


def test_odd_rows_and_what_the_field_adds(spark):
    odd = [
        (1, None), (2, ""), (3, "no data here"), (3, "no data here"), (None, "1.2.3.4"), (4, "@"), (5, "\U0001f600 a@b.c é 1.2.3.4"),
        (6, "Call +1 (743) 555-3824. Later 555-3824 or 743-555-3824."), (7, "an.onea@mail5.example.com, again an.onea@mail5 there"),
        (8, "+1 (269) 555-3296 4524132264652876 en"), (9, "w 1 2 3 " * 20_000), (10, "password=ab77cd version 3.0."),
    ]
    got = planted(spark, odd + [(100 + k, t) for k, t in enumerate(PLAIN)])
    text = dict(odd[5:]) | {100 + k: t for k, t in enumerate(PLAIN)}
    assert sorted(map(str, (g[:6] for g in got))) == sorted(str(row(k, t)[0]) for k, t in odd + [(100 + k, t) for k, t in enumerate(PLAIN)])
    added = {}
    for g in got:
        if g[7]:
            base = set(row(g[0], text[g[0]])[1].split(","))
            more = [p.split(":") for p in g[6].split(",") if p not in base]
            assert len(more) == g[7]
            added[g[0]] = [(kind, text[g[0]][int(a) : int(b)]) for kind, a, b in more]
    assert added.get(6) == [("phone", "555-3824"), ("phone", "743-555-3824")]
    assert added.get(7) == [("email", "an.onea@mail5")]
    assert added.get(8) == [("phone", "+1 (269) 555-3296")]
    assert set(added) == {6, 7, 8}


def test_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sc.personal_data(empty, "doc_id", "text").count() == 0
    clean = spark.createDataFrame([(1, "plain words"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in sc.personal_data(clean, "doc_id", "text").collect()] == ["", ""]
