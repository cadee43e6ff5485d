"""Personal data by patterns and by a skip-chain conditional random field.

Patterns find base spans. The nodes of a document's field are its tokens that hold a
digit or an @; no other token can be personal data of these kinds. Neighbours in the
text share a chain potential; occurrences of one token, however distant, and tokens that
are similar (the last digits, the name before an @) share skip potentials, each
occurrence with the one before it, so that their number is that of the tokens. Loopy
message passing carries labels through the document, from base spans to what the
patterns do not match: a number without its prefix, an address without its ending.

The weights are learnt from the base spans of all rows by pseudo-likelihood: a node
given its neighbours is a multinomial logistic model, so the documents with equal nodes are
counted first and only the counts reach the driver.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import col, in_arrow, settled

KINDS = ("email", "ip", "card", "phone")
#: Labels: no entity, an address, a number with dots, and beginnings and rests of what may have several tokens.
LABELS = ("-", "email", "ip", "card", "card+", "phone", "phone+")
#: The kind of each label, 0 for none.
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
#: Different nodes that are fitted at most, the most frequent first.
FIT_PATTERNS = 50_000
#: What the fit expects before it sees any: log potential of two tokens that are the same or similar having one kind.
LIKE = 8.0
#: Probability from which a token counts as found, and rounds of messages a document gets at most.
SURE, ROUNDS = 0.9, 200

_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_INSIDE = _NAME | frozenset("()@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_REST = re.compile(r"[A-Za-z0-9._%+()@-]*+")
_DIGITS = re.compile(r"[0-9]+")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def _byte(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a name, an @ and a domain with a dot, each character looked at once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _NAME:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        done = found.end() if found else at + 1
        at = text.find("@", done)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots, each at most 255; longer chains are taken by fours."""
    for chain in _DOTTED.finditer(text):
        if chain.group().count(".") < 3:
            continue
        parts, at = chain.group().split("."), chain.start()
        for k in range(0, len(parts) - 3, 4):
            size = sum(map(len, parts[k : k + 4])) + 3
            if all(map(_byte, parts[k : k + 4])):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of what the patterns find, by kind and place; a match that fails its check is dropped."""
    out = [(0, *s) for s in emails(text)] + [(1, *s) for s in addresses(text)]
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = "".join(_DIGITS.findall(found.group()))
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, found.start(), found.end()))
    for found in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(found.group()))) <= 15:
            out.append((3, found.start(), found.end()))
    return out


def tokens(text: str) -> Iterator[tuple[int, int]]:
    """The nodes: runs of the characters of names and numbers that hold a digit or an @, without marks around them."""
    done, mark = 0, _MARK.search(text)
    while mark:
        start = mark.start()
        while start > done and text[start - 1] in _INSIDE:
            start -= 1
        done = end = _REST.match(text, mark.start()).end()
        token = text[start:end]
        for _ in range(2):
            token = token.lstrip("._%-").rstrip("._%-")
            if "(" not in token:
                token = token.rstrip(")")
            if ")" not in token:
                token = token.lstrip("(")
        start = text.find(token, start, end)
        yield start, start + len(token)
        mark = _MARK.search(text, done)


#: Traits of a token's own form; after them come traits of its place.
FORM = 18
TRAITS = FORM + 2


def traits(text: str, start: int, end: int) -> list[int]:
    """The traits a token has."""
    token = text[start:end]
    digits = "".join(_DIGITS.findall(token))
    n = len(digits)
    out = [min(k for k, most in enumerate((0, 2, 3, 6, 7, 9, 12, 19, n)) if n <= most)]
    name, sign, domain = token.partition("@")
    if sign:
        out.append(9 if name and "." in domain else 10)
    elif n == len(token):
        out.append(11)
    elif n and token.strip("0123456789-") == "":
        out.append(12)
    elif token.strip("0123456789()") == "":
        out.append(13)
    elif token[0] == "+" and token[1:].strip("0123456789-().") == "":
        out.append(14)
    elif token.strip("0123456789.") == "":
        out.append(15)
    if 13 <= n <= 19 and n >= len(token) - token.count("-") and luhn(digits):
        out.append(16)
    if token.count(".") == 3 and all(p.isdigit() and p.isascii() and _byte(p) for p in token.split(".")):
        out.append(17)
    if text[max(0, start - 2) : start].strip()[-1:] in (":", "=") and start:
        out.append(FORM)
    if start == 0 or text[start - 1].isspace():
        out.append(FORM + 1)
    return out


def likeness(token: str) -> tuple[str, str | None]:
    """Two keys: tokens with the first are the same, with the second similar."""
    name, sign, _ = token.partition("@")
    digits = "".join(_DIGITS.findall(token))
    similar = f"@{name.lower()}" if sign and name else digits[-7:] if not sign and len(digits) >= 7 else None
    return token.lower(), similar


@dataclass(frozen=True)
class Nodes:
    """The field of a text: places, traits as bits, labels of base spans (-1 for other tokens), neighbours before (-1 for none)."""

    start: list[int]
    end: list[int]
    form: list[int]
    known: list[int]
    beside: list[int]
    same: list[int]
    similar: list[int]


def nodes(text: str, spans: list[tuple[int, int, int]]) -> Nodes:
    """The nodes of a text. A token that base spans of several kinds touch takes the first kind."""
    out = Nodes([], [], [], [], [], [], [])
    last: tuple[dict, dict] = ({}, {})
    label = {}
    places = list(tokens(text))
    starts = np.array([s for s, _ in places])
    ends = np.array([e for _, e in places])
    for kind, start, end in spans:
        at = np.searchsorted(ends, start, "right")
        first = True
        while at < len(places) and starts[at] < end:
            if at not in label:
                label[at] = (1, 2, 3, 5)[kind] + (kind > 1 and not first)
            first, at = False, at + 1
    for k, (start, end) in enumerate(places):
        gap = text[out.end[-1] : start] if k and start - out.end[-1] <= 2 else "-"
        out.start.append(start)
        out.end.append(end)
        out.form.append(sum(1 << t for t in traits(text, start, end)))
        out.known.append(label.get(k, -1))
        out.beside.append(k - 1 if gap.strip(" ") == "" else -1)
        for seen, before, key in zip(last, (out.same, out.similar), likeness(text[start:end])):
            before.append(seen.get(key, -1) if key is not None else -1)
            if key is not None:
                seen[key] = k
    return out


def patterns(n: Nodes) -> list[int]:
    """A number for each node: its label, its traits, and the labels or kinds around it.

    From the lowest bits: label 3, before 3, after 3, kinds of the same token before and
    after 3 each, kinds of similar tokens 3 each, traits; 7 stands for no neighbour.
    """
    label = np.maximum(np.array(n.known, np.int64), 0)
    out = label | (np.array(n.form, np.int64) << 21)
    for place, (before, value) in enumerate(((n.beside, label), (n.same, KIND_OF[label]), (n.similar, KIND_OF[label]))):
        before = np.array(before, np.int64)
        has = np.flatnonzero(before >= 0)
        around = np.full((2, len(label)), 7)
        around[0, has] = value[before[has]]
        around[1, before[has]] = value[has]
        out |= (around[0] << (3 + 6 * place)) | (around[1] << (6 + 6 * place))
    return out.tolist()


@dataclass(frozen=True)
class Weights:
    """Log potentials: of traits, of chains (row 7: before the first, column 7: after the last), of like kinds."""

    trait: np.ndarray
    chain: np.ndarray
    same: np.ndarray
    similar: np.ndarray


def fit(pattern: np.ndarray, count: np.ndarray, rounds: int = 1500, ridge: float = 2e-4, rate: float = 0.1) -> Weights:
    """Maximum pseudo-likelihood by ``rounds`` of gradient steps with moments.

    A ridge draws the potentials of like kinds to ``LIKE`` and all other weights to 0, so that where no
    token of a corpus comes twice, like tokens are still taken to be alike. Half of each pattern's weight goes to a copy without the traits of its own form, so that its
    neighbours alone have to explain it as well.
    """
    size, labels = len(pattern), len(LABELS)
    x = ((pattern[:, None] >> (21 + np.arange(TRAITS))) & 1).astype(float)
    x = np.hstack([x, np.ones((size, 1))])
    bare = x.copy()
    bare[:, :FORM] = 0
    x = np.vstack([x, bare])
    field = [np.tile((pattern >> (3 * k)) & 7, 2) for k in range(7)]
    own = np.eye(labels)[field[0]]
    around = [np.eye(8)[f] for f in field[1:]]
    weight = np.tile(count / max(count.sum(), 1), 2)[:, None] / 2
    kind = np.eye(5)[KIND_OF]
    like = [around[2][:, :5] + around[3][:, :5], around[4][:, :5] + around[5][:, :5]]
    expected = [np.zeros((TRAITS + 1, labels)), np.zeros((8, 8)), *[np.array([0, LIKE, LIKE, LIKE, LIKE])] * 2]
    theta = [e.copy() for e in expected]
    first, second = [[np.zeros_like(t) for t in theta] for _ in range(2)]
    for step in range(1, rounds + 1):
        trait, chain, same, similar = theta
        score = x @ trait + around[0] @ chain[:, :labels] + around[1] @ chain[:labels].T + (like[0] * same + like[1] * similar) @ kind.T
        p = np.exp(score - score.max(axis=1, keepdims=True))
        miss = weight * (own - p / p.sum(axis=1, keepdims=True))
        chained = np.zeros((8, 8))
        chained[:, :labels] += around[0].T @ miss
        chained[:labels] += miss.T @ around[1]
        slope = [x.T @ miss, chained, (like[0] * (miss @ kind)).sum(axis=0), (like[1] * (miss @ kind)).sum(axis=0)]
        for k, (t, g) in enumerate(zip(theta, slope)):
            g = g - ridge * (t - expected[k])
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            theta[k] = t + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Weights(*theta)


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(n: list[Nodes], w: Weights) -> np.ndarray:
    """Probabilities of the labels of all nodes of some documents, one after the other, by loopy sum-product.

    Messages are halfway between old and new ones. A document is done when no message moves by
    more than 1e-4, or after ``ROUNDS``; others do not change its result.
    """
    labels = len(LABELS)
    sizes = np.array([len(d.start) for d in n])
    shift = np.repeat(np.cumsum(sizes) - sizes, sizes)
    doc = np.repeat(np.arange(len(n)), sizes)

    def flat(name: str) -> np.ndarray:
        return np.array([v for d in n for v in getattr(d, name)], np.int64)

    form, known = flat("form"), flat("known")
    alone = w.trait[TRAITS] + ((form[:, None] >> np.arange(TRAITS)) & 1) @ w.trait[:TRAITS]
    beside = flat("beside")
    has_next = np.zeros(len(form), bool)
    has_next[(beside + shift)[beside >= 0]] = True
    alone = alone + np.where(beside[:, None] < 0, w.chain[7, :labels], 0) + np.where(has_next[:, None], 0, w.chain[:labels, 7])
    alone = np.where((known[:, None] < 0) | (known[:, None] == np.arange(labels)), alone, -1e4)
    kind = np.eye(5)[KIND_OF]
    tables = [w.chain[:labels, :labels], (kind * w.same) @ kind.T, (kind * w.similar) @ kind.T]
    ends_a, ends_b, which = [], [], []
    for k, before in enumerate((beside, flat("same"), flat("similar"))):
        to = np.flatnonzero(before >= 0)
        ends_a.append((before + shift)[to])
        ends_b.append(to)
        which.append(np.full(len(to), k))
    a, b, which = (np.concatenate(v) for v in (ends_a, ends_b, which))
    # potentials of the same two nodes are one edge
    pair, edge = np.unique(b * (len(form) + 1) + a, return_inverse=True)
    a, b = pair % (len(form) + 1), pair // (len(form) + 1)
    joint = np.zeros((len(pair), labels, labels))
    np.add.at(joint, edge, np.array(tables)[which])
    # every edge in both directions: a message goes from ``source`` to ``target``
    source, target = np.concatenate([a, b]), np.concatenate([b, a])
    table = np.concatenate([joint, joint.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
    sent, active = np.zeros((len(source), labels)), np.ones(len(n), bool)

    def beliefs() -> np.ndarray:
        total = alone.copy()
        np.add.at(total, target, sent)
        return total

    for _ in range(ROUNDS):
        on = np.flatnonzero(active[doc[source]])
        if not len(on):
            break
        new = _log_sum((beliefs()[source[on]] - sent[back[on]])[:, :, None] + table[on], 1)
        new = new - _log_sum(new, 1)[:, None]
        move = np.abs(new - sent[on]).max(axis=1)
        sent[on] = (sent[on] + new) / 2
        moved = np.zeros(len(n))
        np.maximum.at(moved, doc[source[on]], move)
        active &= moved > 1e-4
    total = beliefs()
    return np.exp(total - _log_sum(total, 1)[:, None])


def plausible(kind: int, text: str) -> bool:
    """Whether a found span can be of its kind at all."""
    digits = sum(map(len, _DIGITS.findall(text)))
    if kind == 0:
        name, sign, domain = text.partition("@")
        return bool(name and sign and domain)
    if kind == 1:
        return text.count(".") == 3
    return 13 <= digits <= 19 if kind == 2 else 7 <= digits <= 15


def found_spans(n: Nodes, p: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, first node, last node) of what the field adds: a beginning and its rests, each token sure and no base span's."""
    kind_of = np.stack([p[:, KIND_OF == k].sum(axis=1) for k in range(5)], axis=1)
    out, k = [], 0
    best = p.argmax(axis=1)
    while k < len(best):
        kind = KIND_OF[best[k]]
        first, k = k, k + 1
        if not kind or n.known[first] >= 0 or kind_of[first, kind] < SURE:
            continue
        while k < len(best) and best[k] in (4, 6) and KIND_OF[best[k]] == kind and n.known[k] < 0 and n.beside[k] == k - 1 and kind_of[k, kind] >= SURE:
            k += 1
        out.append((int(kind) - 1, first, k - 1))
    return out


def written(spans: list[tuple[int, int, int]]) -> str:
    """Spans as kind:start:end, by kind as listed and then by place."""
    return ",".join(f"{KINDS[k]}:{start}:{end}" for k, start, end in sorted(spans))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = list(Nodes.__dataclass_fields__)
    lists = pa.list_(pa.int64())
    for batch in batches:
        base, rows, forms, codes = [], [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            spans = base_spans(text)
            n = nodes(text, spans)
            base.append([v for s in spans for v in s])
            rows.append(n)
            # the outline of a token is all that is needed of its text later
            forms.append([re.sub(r"[^0-9.@]+", "x", text[s:e]) for s, e in zip(n.start, n.end)])
            codes.append(patterns(n))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(base, lists), *[pa.array([getattr(n, c) for n in rows], lists) for c in names],
             pa.array(forms, pa.list_(pa.string())), pa.array(codes, lists)],
            ["id", "base", *names, "outline", "pattern"],
        )


def learnt(read: DataFrame) -> Weights:
    """Weights from all base spans: one shuffle counts the documents with each pattern, the ``FIT_PATTERNS`` most frequent are fitted.

    A document counts once for a pattern, so that a long table of numbers does not outweigh all others.
    A token without a span that is like one with a span is what the field has to decide, and does not teach it.
    """
    counted = read.select(F.explode(F.array_distinct("pattern")).alias("pattern")).groupBy("pattern").count()
    pattern = F.col("pattern")
    alike = [F.shiftright(pattern, 3 * k).bitwiseAND(F.lit(7)).between(1, 4) for k in (3, 4, 5, 6)]
    open_ones = (pattern.bitwiseAND(F.lit(7)) == 0) & (alike[0] | alike[1] | alike[2] | alike[3])
    rows = counted.where(~open_ones).orderBy(F.desc("count"), "pattern").limit(FIT_PATTERNS).toArrow()
    return fit(rows.column(0).to_numpy(), rows.column(1).to_numpy().astype(float))


def personal_data(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) of every row of ``docs``.

    The counts and the digest are those of base spans; spans has these and the n_added ones of the field,
    as kind:start:end in code points. Null and empty texts have no spans and the digest
    of an empty text; rows may repeat, and then count again in the fit; null ids stay; an empty table
    gives no rows; other columns are not read. A text is read once, whole, in one task; only
    its nodes are written and read again.
    """
    flat = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    names = list(Nodes.__dataclass_fields__)
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        flat.schema["id"], T.StructField("base", longs), *[T.StructField(c, longs) for c in names],
        T.StructField("outline", T.ArrayType(T.StringType())), T.StructField("pattern", longs),
    ])
    read = settled(flat.transform(in_arrow, _read, schema))
    weights = learnt(read)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[1:]]
            fields = [Nodes(*row) for row in zip(*columns[1 : 1 + len(names)])]
            # what a document without tokens outside its base spans has is known
            open_ones = [k for k, n in enumerate(fields) if -1 in n.known]
            p = marginals([fields[k] for k in open_ones], weights) if open_ones else np.zeros((0, len(LABELS)))
            added: list[list] = [[] for _ in fields]
            at = 0
            for k in open_ones:
                n = fields[k]
                for kind, first, last in found_spans(n, p[at : at + len(n.start)]):
                    if plausible(kind, " ".join(columns[1 + len(names)][k][first : last + 1])):
                        added[k].append((kind, n.start[first], n.end[last]))
                at += len(n.start)
            base = [[tuple(row[i : i + 3]) for i in range(0, len(row), 3)] for row in columns[0]]
            counts = [[sum(s[0] == kind for s in row) for row in base] for kind in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts],
                 pa.array([hashlib.sha256(written(row).encode()).hexdigest() for row in base], pa.string()),
                 pa.array([written(row + more) for row, more in zip(base, added)], pa.string()),
                 pa.array([len(more) for more in added], pa.int64())],
                out.names,
            )

    out = T.StructType([
        flat.schema["id"], *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("n_added", T.LongType()),
    ])
    return read.drop("pattern").transform(in_arrow, run, out).withColumnRenamed("id", id_col)
