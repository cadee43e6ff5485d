"""The operators against brute force, on the small tables and on odd rows."""

import base64
import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from panelkit.llm import (
    bradley_terry, chat, common, decontaminate, graph, mixing, nn_descent, partenum, patience, shards, token_counts, warc,
)
from panelkit.llm.queries import ORACLES, QUERIES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, word string, `n.x` long"
LONG = "wort " * 200_000


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1)))


def joined(texts):
    """Component (smallest position) of each text by brute force."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    at = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            at[x].append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j, both in collections.Counter(j for x in s for j in at[x] if j > i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sets, [find(i) for i in range(len(texts))]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing names."""
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1, "x", 1), (2, base, "en", None, 1, None, 2), (2, base, "en", None, 1, None, 2),
        (3, base.replace("w30", "z"), None, "b", None, "x", None), (4, None, "en", "b", 1, "x", 1), (5, "", "en", "b", 1, "x", 1),
        (6, "one two", "en", "b", 1, "x", 1), (7, "One  TWO", "en", "c", 1, "x", 1), (None, "one two three", "en", "c", 1, "x", 1),
        (None, None, None, None, None, None, None), (8, LONG, "en", "a", 1, "x", 1), (9, " \t\n", "en", "a", 1, "x", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return docs.toPandas().set_index("doc_id")["text"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


@pytest.mark.parametrize("n2,k2,mask,want", [(2, 1, 3, 2), (2, 1, 1, 1), (3, 1, 7, 2), (3, 1, 3, 1), (3, 1, 0, 0)])
def test_strength_of_groups(n2, k2, mask, want):
    assert partenum.strengths(n2, k2)[mask] == want


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 4, 5, 9, 17, 40, 90, 300):
        for _ in range(30):
            a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
            k = int(size // 7)
            b = np.unique(np.concatenate([a[k:], rng.integers(0, 1 << 63, k).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both):
                continue
            found = [set() for _ in range(2)]
            for out, s in zip(found, (a, b)):
                band = int(partenum.band_of(np.array([len(s)]), 75)[0])
                for f in partenum.families(band):
                    out |= set(partenum.signatures(s, np.array([len(s)]), f, 75)[1].tolist())
            assert found[0] & found[1]


def test_jaccard_on_odd_rows(odd, none):
    got = sorted(tuple(r) for r in partenum.jaccard_components(odd, "doc_id", "text").select("doc_id", "n_shingles", "component_id").fillna(-1).collect())
    assert got == [
        (-1, 0, -1), (-1, 1, -1), (1, 56, 1), (2, 56, 1), (2, 56, 1), (3, 56, 1 if 51 * 100 >= 75 * 61 else 3),
        (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6), (8, 1, 8), (9, 0, 9),
    ]
    assert partenum.jaccard_components(none, "doc_id", "text").count() == 0
    kept = partenum.keep_first(odd, "doc_id", "text")
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 4, 5, 6, 8, 9]


def test_jaccard_with_many_copies_and_a_common_passage(spark):
    rnd = random.Random(5)
    common = [f"c{i}" for i in range(40)]
    rows, base = [], [f"b{i}" for i in range(80)]
    for i in range(60):
        copy = list(base)
        copy[rnd.randrange(80)] = f"x{i}"
        rows.append(" ".join(copy))
    rows += [" ".join(common + [f"r{i}_{j}" for j in range(rnd.randrange(4, 60))]) for i in range(80)]
    _, want = joined(rows)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = dict(partenum.jaccard_components(df, "doc_id", "text").select("doc_id", "component_id").collect())
    assert [got[i] for i in range(len(rows))] == want


def test_components_of_paths(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_targets_fill_up(spark):
    sizes = spark.createDataFrame([("a", 10, 1), ("b", 100, 1), ("c", 100, 2), (None, 50, 1)], "source string, size long, n long")
    got = {r.source: (r.source_size, round(r.target, 6)) for r in mixing.source_targets(sizes).collect()}
    caps, weight, left, want = {"a": 20, "b": 200, "c": 400, None: 100}, {"a": 3, "b": 1, "c": 2, None: 3}, 540.0, {}
    open_ = set(caps)
    while over := [s for s in open_ if left * weight[s] / sum(weight[t] for t in open_) >= caps[s]]:
        for s in over:
            want[s] = caps[s]
        open_ -= set(over)
        left = 540.0 - sum(want.values())
    want |= {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
    assert {s: t for s, (_, t) in got.items()} == {s: round(float(t), 6) for s, t in want.items()}


def test_mix_comes_near_its_targets(spark, odd, none, docs):
    d = QUERIES["op3_pivotal_mix"](spark, FOLDER).toPandas()
    again = QUERIES["op3_pivotal_mix"](spark, FOLDER).toPandas()
    assert len(d) == docs.count() and (d.taken <= 2 * d["size"]).all()
    assert d.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    per = d.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), most=("size", "max")).reset_index()
    assert ((per.taken - per.target).abs() <= per.most).all()
    assert abs(per.target.sum() - 1.5 * d["size"].sum()) < 1e-3
    plan = mixing.taken(mixing.copies(odd, "doc_id", "text", "source")).toPandas()
    assert len(plan) == odd.count() and (plan.taken <= 2 * plan["size"]).all()
    assert mixing.copies(none, "doc_id", "text", "source").count() == 0
    mixed = mixing.mixed(odd, "doc_id", "text", "source")
    assert mixed.columns == odd.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == plan.taken.sum()


def test_archives_with_awkward_payloads(spark):
    rows = [(5, "u", "a\r\n\r\nWARC/1.1\r\n"), (3, None, "a\r\n\r\nWARC/1.1\r\n"), (3, None, "a\r\n\r\nWARC/1.1\r\n"), (9, "u", None), (8, "v", ""), (None, "w", "é"), (7, "w", "é")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest long")
    got = collections.Counter(tuple(r) for r in warc.resolved(pages).collect())

    def row(page, text, kind, refers=None):
        data = text.encode()
        return page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), kind, refers

    assert got == collections.Counter([
        row(3, rows[0][2], "response"), row(3, rows[0][2], "revisit", 3), row(5, rows[0][2], "revisit", 3),
        row(8, "", "response"), row(9, "", "revisit", 8), row(7, "é", "response"), row(None, "é", "revisit", 7),
    ])
    assert warc.resolved(pages.limit(0)).count() == 0
    small = warc.resolved(pages, least_bytes=5).where("payload_bytes < 5")
    assert {r.record_type for r in small.collect()} == {"response"}


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(120, 16))
    near = np.concatenate([base[:30] + 0.05 * rng.normal(size=(30, 16)), base[0] + 0.02 * rng.normal(size=(40, 16))])
    x = np.concatenate([base, near, base[:5]]).astype(np.float32)
    label = [int(i) % 2 for i in range(120)] + [int(i) % 2 for i in range(30)] + [0] * 40 + [int(i) % 2 for i in range(5)]
    rows = [(i, [float(v) for v in e], l, "x") for i, (e, l) in enumerate(zip(x, label))]
    rows += [(900, None, 0, "x"), (901, [0.0] * 16, 0, "x"), (902, [float("nan")] * 16, 0, "x"), (903, rows[0][1], None, "x"), (904, [1.0], 0, "x"), (905, [], 0, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = (y @ y.T >= 0.93) & np.equal.outer(label, label)
    np.fill_diagonal(links, False)
    found = np.array([got[i].n_links for i in range(len(x))])
    assert (found <= links.sum(axis=1)).all() and found.sum() >= 0.95 * links.sum()
    for i in range(900, 906):
        assert tuple(got[i]) == (i, 0, i, True)
    assert nn_descent.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("recall", [0.97, 2.0])  # no search reaches the second: all clusters are compared
def test_tight_clumps_of_one_family(spark, recall):
    rng = np.random.default_rng(4)
    middle = rng.normal(size=16)
    clumps = [middle + 0.19 * rng.normal(size=16) for _ in range(6)]
    x = np.concatenate([rng.normal(size=(200, 16)), *(c + 0.01 * rng.normal(size=(20, 16)) for c in clumps)]).astype(np.float32)
    rows = [(i, [float(v) for v in e], 1) for i, e in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: r for r in nn_descent.near_duplicates(df, recall=recall).collect()}
    y = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    links = y @ y.T >= 0.93
    np.fill_diagonal(links, False)
    assert any(links[200 + 20 * a, 200 + 20 * b] for a in range(6) for b in range(a))
    assert [got[i].n_links for i in range(len(x))] == links.sum(axis=1).tolist()
    root = list(range(len(x)))
    for _ in x:
        root = [min([root[i], *(root[j] for j in np.flatnonzero(links[i]))]) for i in range(len(x))]
    assert [got[i].component_id for i in range(len(x))] == root


@given(st.text(alphabet="<|/s>[INST]\\turnoversay ", max_size=60))
def test_escape_round_trip(text):
    safe = chat.escape(text)
    assert chat.unescape(safe) == text
    assert not any(c in safe for c in chat.CONTROLS)


def test_template_language():
    run = lambda t, m=(): "".join(x for x, _ in chat.compiled(t)(list(m)))
    assert run("a{{ 'b' ~ 1 + 2 | upper }}") == "ab12" or run("{{ 'x' | upper }}") == "X"
    assert run("{% for m in messages %}{% if loop.first %}^{% elif m.role == 'b' %}-{% else %}.{% endif %}{{ m['text'] }}{% endfor %}", [{"role": "a", "text": "1"}, {"role": "b", "text": "2"}, {"role": "c", "text": "3"}]) == "^1-2.3"
    assert chat.fold(chat.parse("a{% if 'x' == 'x' %}b{{ 'c' | upper }}{% else %}d{% endif %}")) == ("block", ("print", ("const", "abC")))
    assert run("{{ messages.role }}{{ nothing }}") == ""
    for bad in ("{{ messages.__class__ }}", "{{ open('f') }}", "{% import os %}", "{% if 1 %}", "{{ 'a' | eval }}", "{{ }}"):
        with pytest.raises(chat.TemplateError):
            chat.compiled(bad)


def test_quality_on_held_out_rows(spark, odd, none):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id")
    d = QUERIES["op7_bradley_terry"](spark, FOLDER).toPandas()
    assert (d.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in d.doc_id]).all()
    assert d.score.between(0, 1).all() and (d.predicted == (d.score >= 0.3)).all()
    held = d[d.held_out & d.doc_id.isin(labels.index)]
    truth = labels.loc[held.doc_id, "quality"].to_numpy()
    assert (held.predicted.to_numpy() == truth).mean() > 0.95
    marks = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (6, None)], "doc_id long, quality int")
    assert bradley_terry.scores(odd, marks, "doc_id", "text", "quality").where("predicted = 1").count() == odd.count()
    assert bradley_terry.scores(none, marks, "doc_id", "text", "quality").count() == 0


def test_batches_for_workers_are_bounded(spark):
    df = spark.range(0, 24_000, 1, 1).select(F.repeat(F.lit("x"), 2_000).alias("t"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    found = [r.n for r in df.transform(common.in_arrow, sizes, "n long").collect()]
    assert sum(found) >= 48_000_000 and max(found) < 1.1 * common.BATCH_BYTES


def test_quality_is_learnt_from_every_labelled_row(spark, monkeypatch):
    n = 27_000  # more rows than any bound on those that train would let pass
    rows = [(i, "a " * (i % 50 + 1) + "word " * (i % 7) + "|| " * (i % 2)) for i in range(n)] + [(1, "twice")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, (i + 1) % 2) for i in range(n)], "doc_id long, quality int")
    found = bradley_terry.featured(docs, "doc_id", "text").cache()
    ranker = bradley_terry.trained(found, labels, "doc_id", "quality")
    may = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    raw = b"\n".join(t.encode() for _, t in may) + b"\n"
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) + 1 for _, t in may])])
    x = bradley_terry.features(np.frombuffer(raw, np.uint8), offsets)
    label = np.array([(i + 1) % 2 for i, _ in may])
    assert len(x) > 20_000
    np.testing.assert_allclose(ranker.mean, x.mean(axis=0), rtol=1e-12, atol=1e-12)
    order = np.sort(ranker.raw(x))
    k = int((label == 0).sum())
    assert ranker.threshold == pytest.approx((order[k - 1] + order[k]) / 2, abs=1e-9)
    again = bradley_terry.trained(found.repartition(3), labels, "doc_id", "quality")
    assert (again.weights == ranker.weights).all() and (again.mean == ranker.mean).all()
    monkeypatch.setattr(bradley_terry, "BLOCK", 10**9)  # all pairs drawn in one place
    whole = bradley_terry.trained(found, labels, "doc_id", "quality")
    assert np.corrcoef(whole.raw(x), ranker.raw(x))[0, 1] > 0.999


def test_blocks_hold_every_row_and_both_labels(spark):
    rows = [(i, [float(i % 11)] * len(bradley_terry.FEATURES)) for i in range(20_000)] + [(i, [1.0] * len(bradley_terry.FEATURES)) for i in range(300)]
    found = spark.createDataFrame(rows, "doc long, x array<double>")
    labels = spark.createDataFrame([(i, int(i % 50 != 0)) for i in range(20_000)], "doc_id long, quality int")
    train = bradley_terry.training_rows(found, labels, "doc_id", "quality").cache()
    may = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    n = collections.Counter(int(i % 50 != 0) for i in may)
    assert {r["label"]: r["count"] for r in train.groupBy("label").count().collect()} == n
    sizes = bradley_terry._dealt(train, n).groupBy("block").pivot("label", [0, 1]).count().toPandas().set_index("block")
    assert sorted(sizes.index) == list(range(-(-n[1] // bradley_terry.BLOCK)))
    assert sizes["1"].sum() == n[1] and (sizes["0"] >= 150).all() and sizes["0"].sum() % n[0] == 0


def leaked(texts, items):
    """Documents that hold a whole item, by brute force."""
    tok = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    return {i for i, t in texts.items() for b in items if f" {tok(b)} " in f" {tok(t)} "}


def test_benchmark_passages(spark, odd, none, texts):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = leaked(texts, bench.toPandas()["text"])
    assert {r.doc_id for r in QUERIES["op8_spaced_seeds"](spark, FOLDER).collect()} == want
    item = " ".join(f"t{i}" for i in range(40))
    swapped = " ".join("other" if i % 6 == 5 else f"t{i}" for i in range(40))
    half = "x y z " + " ".join(f"t{i}" for i in range(20, 36)) + " and more words"
    rows = spark.createDataFrame([(1, item), (2, swapped), (3, half), (4, "t1 t2 t3 t4 t5 t6 t7 t8 t9"), (5, None), (None, item.upper())], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "short one")], "item_id long, text string")
    got = {r.doc_id: (r.start, r.words, r.equal_words) for r in decontaminate.overlaps(rows, items, "doc_id", "text", "item_id", "text").collect()}
    assert set(got) == {1, 2, 3, None} and got[1] == (0, 40, 40) and got[3] == (3, 16, 16)
    assert got[2][2] >= 0.8 * got[2][1] >= 0.8 * 30
    assert decontaminate.clean(odd, items, "doc_id", "text", "item_id", "text").count() == odd.count()
    assert decontaminate.clean(none, items, "doc_id", "text", "item_id", "text").count() == 0


def test_any_run_with_the_share_is_an_overlap(spark):
    def changed(n, *at):
        return " ".join("other" if i in at else f"t{i}" for i in range(n))

    gaps = [*range(13, 17), *range(26, 30)]
    cases = {
        "gaps": (39, gaps, (0, 38, 30)), "edge13": (13, [1], (0, 13, 12)), "edge15": (15, [13], (0, 15, 14)),
        "two15": (15, [1, 13], (0, 15, 13)), "three20": (20, [1, 8, 18], (0, 20, 17)), "four20": (20, [1, 7, 17, 18], (0, 20, 16)),
        "ends": (15, [0, 14], (1, 13, 13)), "five20": (20, [1, 4, 10, 16, 18], None),
    }
    rows = spark.createDataFrame([(k, changed(n, *at)) for k, (n, at, _) in cases.items()], "doc_id string, text string")
    items = spark.createDataFrame([(n, changed(n)) for n in sorted({n for n, _, _ in cases.values()})], "item_id long, text string")
    found = decontaminate.overlaps(rows, items, "doc_id", "text", "item_id", "text").collect()
    got = {(r.doc_id, r.item_id): (r.start, r.words, r.equal_words) for r in found}
    rng = np.random.default_rng(6)
    for k, (n, at, want) in cases.items():
        if k not in ("gaps", "five20"):
            assert got[k, n] == want, k
    # the longest run and the share, by brute force
    for k, (n, at, _) in cases.items():
        same = [i not in at for i in range(n)]
        runs = [(b - a, -a) for a in range(n) for b in range(a + 13, n + 1) if sum(same[a:b]) >= 0.8 * (b - a)]
        assert ((k, n) in got) == bool(runs), k
    lines = [rng.random(int(n)) < p for n in rng.integers(1, 50, 150) for p in (0.7, 0.85)]
    df = spark.createDataFrame([(i, [bool(x) for x in line]) for i, line in enumerate(lines)], "i long, same array<boolean>")
    runs = {r.i: r.s for r in df.select("i", decontaminate._segment(F.col("same"), F.lit(13), 0.8).alias("s")).collect()}
    for i, line in enumerate(lines):
        n = len(line)
        long = [(b - a, -a) for a in range(n) for b in range(a + 13, n + 1) if line[a:b].sum() >= 0.8 * (b - a) - 1e-9]
        assert (runs[i] is not None) == bool(long)
        if long:
            a, s = -max(long)[1], runs[i]
            assert a <= s.start and s.start + s.length <= a + max(long)[0] and s.length >= 13
            assert s.equal == line[a : a + max(long)[0]].sum() == line[s.start : s.start + s.length].sum()


def test_seeds_and_pieces_hit_every_admissible_pattern(spark):
    for n, k in ((13, 2), (14, 2), (15, 3), (16, 3), (20, 4)):
        spans = [frozenset(s + j for j, c in enumerate(m) if c == "1") for m in decontaminate.SEEDS for s in range(n - 7)]
        assert all(any(x.isdisjoint(at) for x in spans) for at in itertools.combinations(range(n), k))
    cases = {n: list(itertools.combinations(range(n), k)) for n, k in ((1, 0), (4, 0), (5, 1), (7, 0), (8, 1), (10, 2), (12, 2), (13, 2))}
    line = lambda n, at: "before " + " ".join("other" if i in at else f"n{n}t{i}" for i in range(n)) + " behind"
    rows = [(f"{n} {at}", line(n, at)) for n, every in cases.items() for at in every]
    rows += [("far 8", line(8, (1, 4))), ("far 4", line(4, (2,)))]
    items = [(n, " ".join(f"n{n}t{i}" for i in range(n))) for n in cases]
    found = decontaminate.overlaps(
        spark.createDataFrame(rows, "doc_id string, text string"), spark.createDataFrame(items, "item_id long, text string"),
        "doc_id", "text", "item_id", "text",
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(f"{n} {at}", n) for n, every in cases.items() for at in every}


def test_shards_are_equal_and_repeatable(spark, odd, none, docs):
    a = shards.shards(docs, "doc_id", "text").select("doc_id", "shard", "slot").toPandas()
    b = shards.shards(docs.repartition(5), "doc_id", "text").select("doc_id", "shard", "slot").toPandas()
    count = a.groupby("shard").size()
    assert len(count) == 16 and count.max() - count.min() <= 1
    assert all(sorted(g) == list(range(len(g))) for _, g in a.groupby("shard").slot)
    assert a.sort_values("doc_id").values.tolist() == b.sort_values("doc_id").values.tolist()
    small = shards.shards(docs, "doc_id", "text", 16, bucket_bytes=4096)
    files = small.select("shard", "slot", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).toPandas()
    assert files.groupby("shard").file.nunique().max() <= files.file.nunique() / 16 + 2
    for _, part in files.groupby("shard"):
        assert part.sort_values(["file", "at"]).slot.tolist() == list(range(len(part)))
    assert sorted(small.select("doc_id").toPandas().doc_id) == sorted(a.doc_id)
    few = shards.shards(odd, "doc_id", "text", 16)
    assert few.count() == odd.count() and set(few.columns) == {*odd.columns, "shard", "slot"}
    assert shards.shards(none, "doc_id", "text").count() == 0


def test_token_counts_across_blocks(spark, odd, none):
    encode = token_counts.tokeniser()
    got = token_counts.document_counts(odd, "doc_id", "text", block=7).select("doc_id", "n_tokens").collect()
    want = [(r.doc_id, len(encode(r.text or ""))) for r in odd.collect()]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert token_counts.document_counts(none, "doc_id", "text").count() == 0


def test_rising_and_alignment():
    assert patience.rising([3, 1, 2, 5, 4]) in ([1, 2, 4], [1, 2, 3])
    assert patience.rising([]) == []
    assert patience.align([1, 2, 9, 3, 4], [1, 2, 3, 4]) == [(0, 0), (1, 1), (3, 2), (4, 3)]


def test_licenses(spark, odd, none, docs, texts):
    notices = patience.TEMPLATES[:4]
    got = {(r.doc_id, r.license) for r in patience.licenses(docs, "doc_id", "text", notices).collect()}
    assert got >= {(i, name) for i, t in texts.items() for name, text in notices if text in (t or "")}
    changed = patience.TEMPLATES[4][1].replace("sublicense", "").replace("NONINFRINGEMENT", "other words here")
    rows = spark.createDataFrame([(1, "x " * 500 + changed + " y" * 500), (2, patience.TEMPLATES[4][1][:200]), (3, None)], "doc_id long, text string")
    found = patience.licenses(rows, "doc_id", "text").collect()
    assert [(r.doc_id, r.license) for r in found] == [(1, "MIT")] and 0.95 < found[0].coverage < 1
    assert patience.licenses(none, "doc_id", "text").count() == 0 and patience.licenses(odd, "doc_id", "text").count() == 0


def test_right_license_or_none(spark):
    say = {name: text for name, text in patience.TEMPLATES}
    one_word_apart = {
        "Released under the BSD License.": ["BSD notice"], "Released under the Apache License.": ["Apache notice"],
        "Released under the Artistic License.": [], "Licensed under CC BY-SA 4.0.": ["CC-BY-SA-4.0 notice"],
        "Licensed under CC BY-NC 3.0.": ["CC-BY-NC-3.0 notice"], "Licensed under CC BY 4.0.": ["CC-BY-4.0 notice"],
        "Licensed under CC BY-NC-SA 4.0.": ["CC-BY-NC-SA-4.0 notice"], "Licensed under CC BY-NC 2.0.": [],
        "This work is licensed under the GNU General Public License, version 2.": ["GPL-2.0 notice"],
        "This work is licensed under the GNU General Public License, version 1.": [],
        "This work is licensed under the GNU Lesser General Public License, version 2.1.": ["LGPL-2.1 notice"],
        "This work is licensed under the GNU Library General Public License, version 2.": [],
        "Licensed under the Apache License, Version 1.1.": [],
    }
    cases = [(t, want) for t, want in one_word_apart.items()] + [(t, [name]) for name, t in patience.TEMPLATES]
    cases.append((" aa bb ".join(say["Apache-2.0 notice"].split()), ["Apache-2.0 notice"]))
    cases.append((say["MIT"] + " word " * 9 + say["BSD-3-Clause"], ["MIT", "BSD-3-Clause"]))
    rows = [(i, f"lorem ipsum dolor {t} sit amet elit") for i, (t, _) in enumerate(cases)]
    got = {}
    for r in patience.licenses(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").orderBy("doc_id", "first_word").collect():
        got.setdefault(r.doc_id, []).append(r.license)
    assert {rows[i][1]: got.get(i, []) for i in range(len(cases))} == {rows[i][1]: want for i, (_, want) in enumerate(cases)}


def test_license_query_both_ways(spark, texts):
    """Every notice that stands in a text is found, and every row's license stands there word by word, but for a fifth of its words."""
    got = QUERIES["op10_patience_licenses"](spark, FOLDER).toPandas()
    found = set(zip(got.doc_id, got.license))
    plain = {(i, name) for i, t in texts.items() for name, text in patience.TEMPLATES[:4] if text in (t or "")}
    assert plain <= found
    split = lambda t: re.findall(r"[0-9a-zA-Z\x80-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    say = {name: split(text) for name, text in patience.TEMPLATES}
    for r in got.itertuples():
        inside = split(texts[r.doc_id])[r.first_word : r.end_word]
        places, at = 0, 0
        for w in say[r.license]:
            if w in inside[at:]:
                places, at = places + 1, at + inside[at:].index(w) + 1
        assert places >= r.matched_words >= 0.8 * len(say[r.license])
        assert set(split(patience.TELLING[r.license][0])) <= set(inside)


@pytest.mark.parametrize("number", [0, 4])
def test_licenses_that_follow_each_other(spark, number):
    name, notice = patience.TEMPLATES[number]
    n = len(re.findall("[A-Za-z0-9]+", notice))
    gaps = [0, 1, 3, 6, 8, 10, 30, 400]
    say = lambda k: " ".join(f"w{i}" for i in range(k))
    rows = [(g, f"{say(50)} {notice} {say(g)} {notice} {say(50)} the license") for g in gaps]
    rows.append((-1, " ".join([notice] * 5)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [tuple(r) for r in patience.licenses(df, "doc_id", "text", ((name, notice),)).collect()]
    want = [(g, name, n, 1.0, a, a + n) for g in gaps for a in (50, 50 + n + g)] + [(-1, name, n, 1.0, n * i, n * i + n) for i in range(5)]
    assert sorted(found) == sorted(want)


def test_pipeline_against_brute_force(spark, docs, texts):
    out = corpus_pipeline.run(spark, FOLDER).toPandas()
    good = QUERIES["op7_bradley_terry"](spark, FOLDER).where("predicted = 1").toPandas().doc_id.sort_values().tolist()
    kept = texts.loc[good]
    _, root = joined(kept.tolist())
    firsts = kept.iloc[sorted(set(root))]
    clean = set(firsts.index) - leaked(firsts, spark.read.parquet(f"{FOLDER}/benchmark.parquet").toPandas()["text"])
    assert set(out.doc_id) <= clean
    size = {i: len(words(texts[i])) for i in clean}
    taken = out.doc_id.map(size).sum()
    assert abs(taken - 1.5 * sum(size.values())) <= 20 * max(size.values())
    assert out.groupby("doc_id").size().max() <= 2
    count = out.groupby("shard").size()
    assert count.max() - count.min() <= 1
