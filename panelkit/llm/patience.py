"""License scans by patience alignment of texts and license templates.

Words that occur once in the template and once in the text are anchors; the
longest increasing subsequence of their places keeps order. The gaps between
kept anchors are aligned in the same way, where words can be unique that were
not so before. Matched words over template words is the coverage.

One word can tell two licenses apart. A template therefore names words that must be
matched, and rival words that must not stand within a match; of templates whose matches
overlap, the one with more matched words counts.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import in_arrow, keys, mix, text_chunks

#: Least coverage of a template that is reported, and the longest stretch of a text that can match one, in its lengths.
COVERAGE, STRETCH = 0.8, 3
_CLASS = np.zeros(256, bool)
_CLASS[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_CLASS[128:] = True

# Notices and license texts as their publishers word them.
TEMPLATES = (
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT notice", "Released under the MIT License."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights "
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
     "whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
     "notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
     "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
     "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES "
     "OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
     "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("Apache-2.0 header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
     "required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
     "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
     "governing permissions and limitations under the License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND "
     "THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
     "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
     "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
     "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. "
     "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
     "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
     "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
     "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
     "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
     "the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY "
     "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
     "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
     "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
     "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
     "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
     "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
     "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
     "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
     "specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
     "THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
     "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
     "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
     "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED "
     "AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY "
     "WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
     "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
     "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
     "an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
     "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any "
     "source distribution."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
     "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
     "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any "
     "and all copyright interest in the software to the public domain."),
    ("MPL-2.0 header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("BSD notice", "Released under the BSD License."),
    ("Apache notice", "Released under the Apache License."),
    ("GPL-2.0 notice", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1 notice", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0 notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0 notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0 notice", "Licensed under CC BY 4.0."),
    ("CC-BY-3.0 notice", "Licensed under CC BY 3.0."),
    ("CC-BY-SA-4.0 notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-3.0 notice", "Licensed under CC BY-SA 3.0."),
    ("CC-BY-NC-3.0 notice", "Licensed under CC BY-NC 3.0."),
    ("CC-BY-NC-SA-4.0 notice", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0 notice", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-ND-4.0 notice", "Licensed under CC BY-NC-ND 4.0."),
)

# For each template the words that a match must hold, and the words that it must not.
TELLING = {
    "Apache-2.0 notice": ("apache 2 0", "1 1"),
    "MIT notice": ("mit", "apache bsd isc gnu"),
    "GPL-3.0 notice": ("gnu general 3", "lesser library affero 1 2"),
    "CC-BY-NC-4.0 notice": ("cc by nc 4 0", "sa nd 1 2 3"),
    "MIT": ("obtaining furnished", ""),
    "Apache-2.0 header": ("apache 2 0", ""),
    "ISC": ("provided above notice appear copies", ""),
    "0BSD": ("fee disclaims", "appear"),
    "BSD-2-Clause": ("redistributions retain reproduce", "endorse neither"),
    "BSD-3-Clause": ("redistributions retain reproduce neither endorse", ""),
    "Zlib": ("misrepresented altered", ""),
    "Unlicense": ("unencumbered domain", ""),
    "MPL-2.0 header": ("mozilla mpl 2 0", "1"),
    "BSD notice": ("bsd", "apache mit isc gnu"),
    "Apache notice": ("released apache", "bsd mit isc gnu"),
    "GPL-2.0 notice": ("gnu general 2", "lesser library affero 1 3"),
    "LGPL-2.1 notice": ("gnu lesser 2 1", "affero 3"),
    "LGPL-3.0 notice": ("gnu lesser 3", "affero 1 2"),
    "AGPL-3.0 notice": ("gnu affero 3", "lesser 1 2"),
    "CC-BY-4.0 notice": ("cc by 4 0", "nc sa nd 1 2 3"),
    "CC-BY-3.0 notice": ("cc by 3 0", "nc sa nd 1 2 4"),
    "CC-BY-SA-4.0 notice": ("cc by sa 4 0", "nc nd 1 2 3"),
    "CC-BY-SA-3.0 notice": ("cc by sa 3 0", "nc nd 1 2 4"),
    "CC-BY-NC-3.0 notice": ("cc by nc 3 0", "sa nd 1 2 4"),
    "CC-BY-NC-SA-4.0 notice": ("cc by nc sa 4 0", "nd 1 2 3"),
    "CC-BY-ND-4.0 notice": ("cc by nd 4 0", "nc sa 1 2 3"),
    "CC-BY-NC-ND-4.0 notice": ("cc by nc nd 4 0", "sa 1 2 3"),
}


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each run of letters and digits (bytes over 127 count as such), A-Z in lower case."""
    inside = np.flatnonzero(_CLASS[data])
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(inside, prepend=-2) > 1)
    length = np.diff(first, append=len(inside))
    place = np.arange(len(inside)) - np.repeat(first, length)
    byte = data[inside].astype(np.uint64)
    byte[(byte >= 65) & (byte <= 90)] += np.uint64(32)
    factor = keys(max(4096, 1 << int(length.max()).bit_length()), 7)
    value = (byte + np.uint64(1)) * factor[place]
    return mix(np.add.reduceat(value, first) + length.astype(np.uint64)), inside[first]


def rising(places: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tops, p)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(p)
            piles.append(i)
        else:
            tops[k], piles[k] = p, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Matched (text, template) places, in order: equal ends first, then anchors, then the gaps."""
    out: list[tuple[int, int]] = []
    work = [(0, len(text), 0, len(template))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once = _once(template, c, d)
        there = _once(text, a, b)
        anchors = [(there[w], t) for w, t in once.items() if w in there]
        kept = [anchors[i] for i in rising([x for x, _ in anchors])]
        if not kept:
            continue
        out += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        work += [(x + 1, p, y + 1, q) for (x, y), (p, q) in zip(edges, edges[1:])]
    return sorted(out)


def _once(items: list[int], start: int, stop: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for i in range(start, stop):
        seen[items[i]] = -1 if items[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def regions(hits: np.ndarray, length: int, least: int, stretch: int = STRETCH) -> Iterator[tuple[int, int]]:
    """Stretches of a text around windows of ``stretch`` times ``length`` words that hold ``least`` hits, from the sorted places of hits."""
    if len(hits) < least:
        return
    dense = np.flatnonzero(hits[least - 1 :] - hits[: len(hits) - least + 1] < stretch * length)
    start = stop = -1
    for k in dense:
        a, b = int(hits[k]) - length // 4 - 1, int(hits[k + least - 1]) + length // 4 + 2
        if a > stop:
            if stop >= 0:
                yield max(start, 0), stop
            start = a
        stop = max(stop, b)
    if stop >= 0:
        yield max(start, 0), stop


def spans(text: list[int], template: list[int], least: int, at: int, stretch: int = STRETCH) -> Iterator[tuple[list[tuple[int, int]], int, int]]:
    """(matched pairs, first, end) of the stretches of ``text`` that match ``least`` words of the template, in order.

    A window starts at a word of the template and is about as long as the template, so
    that a second copy behind it does not hide the words that occur once; the next one
    starts at the end of a match. Windows that hold too few of the template's words,
    counted with their copies, cannot match and are not aligned. ``at`` is the place of
    the text's first word.
    """
    have = Counter(template)
    length = len(template)
    widths = sorted({length, length + length // 4 + 1, *(k * length for k in range(2, stretch + 1))})
    hits = [i for i, w in enumerate(text) if w in have]

    def aligned(start: int, width: int) -> tuple[int, int, int, list[tuple[int, int]]] | None:
        """With a score first: a matched word counts 4, another one between the ends of the match -1."""
        pairs = [(start + x, t) for x, t in align(text[start : start + width], template)]
        if len(pairs) < least:
            return None
        return 5 * len(pairs) - (pairs[-1][0] + 1 - pairs[0][0]), -pairs[0][0], len(pairs), pairs

    held: Counter[int] = Counter()
    common = stop = done = 0  # ``held`` are the hits from the k-th to ``stop``
    for k, start in enumerate(hits):
        while stop < len(hits) and hits[stop] < start + widths[-1]:
            word = text[hits[stop]]
            common += held[word] < have[word]
            held[word] += 1
            stop += 1
        if common >= least and start >= done:
            best = max(filter(None, (aligned(start, w) for w in widths)), default=None)
            tried = {start}
            while best:
                # most pairs are on the diagonal of the copy itself, which says where it starts
                shift = Counter(x - t for x, t in best[3]).most_common(1)[0][0]
                starts = {max(shift, done), best[3][0][0]} - tried
                tried |= starts
                better = max(filter(None, (aligned(s, w) for s in starts for w in widths)), default=None)
                if not better or better[:3] <= best[:3]:
                    break
                best = better
            if best:
                done = best[3][-1][0] + 1
                yield best[3], at + best[3][0][0], at + done
        word = text[start]
        held[word] -= 1
        common -= held[word] < have[word]


def resolved(found: list[tuple]) -> list[tuple]:
    """Of (name, matched, total, first, end) matches that overlap, the one with more matched words, then of higher coverage."""
    kept: list[tuple] = []
    for one in sorted(found, key=lambda f: (-f[1], f[2], f[3], f[0])):
        if all(one[4] <= k[3] or k[4] <= one[3] for k in kept):
            kept.append(one)
    return sorted(kept, key=lambda f: f[3])


def _scanned(templates: tuple[tuple[str, str], ...], coverage: float, telling: dict[str, tuple[str, str]], stretch: int):
    def hashed(text: str) -> np.ndarray:
        return words(np.frombuffer(text.encode(), np.uint8))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = []
        for name, text in templates:
            w = hashed(text).tolist()
            if w:
                must, rivals = (hashed(t) for t in telling.get(name, ("", "")))
                places = {i for i, x in enumerate(w) if x in set(must.tolist())}
                known.append((name, w, np.unique(np.array(w, np.uint64)), int(np.ceil(coverage * len(w))), must, places, set(rivals.tolist())))
        vocabulary = np.unique(np.concatenate([k[2] for k in known])) if known else np.zeros(0, np.uint64)
        for batch in batches:
            for start, _, data, offsets in text_chunks(batch.column(1)):
                hashes, at = words(data)
                place = np.searchsorted(vocabulary, hashes)
                hit = np.flatnonzero((place < len(vocabulary)) & (vocabulary[np.minimum(place, max(len(vocabulary) - 1, 0))] == hashes)) if len(vocabulary) else np.zeros(0, int)
                edges = np.searchsorted(at, offsets)
                rows: list[tuple] = []
                share = np.searchsorted(hit, edges)
                for k in np.flatnonzero(np.diff(share)):
                    own = hit[share[k] : share[k + 1]]
                    text = None
                    found: list[tuple] = []
                    present = set(hashes[own].tolist())
                    for name, template, vocab, least, must, places, rivals in known:
                        if not present.issuperset(must.tolist()):
                            continue
                        mine = own[np.isin(hashes[own], vocab)]
                        if len(mine) < least:
                            continue
                        text = hashes[edges[k] : edges[k + 1]].tolist() if text is None else text
                        for a, b in regions(mine - edges[k], len(template), least, stretch):
                            for pairs, first, end in spans(text[a:b], template, least, a, stretch):
                                if places <= {t for _, t in pairs} and rivals.isdisjoint(text[first:end]):
                                    found.append((name, len(pairs), len(template), first, end))
                    rows += [(start + int(k), *f) for f in resolved(found)]
                if rows:
                    r, name, matched, total, first, last = map(list, zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(r)), pa.array(name), pa.array(matched, pa.int64()),
                         pa.array([m / t for m, t in zip(matched, total)]), pa.array(first, pa.int64()), pa.array(last, pa.int64())],
                        ["doc", "license", "matched_words", "coverage", "first_word", "end_word"],
                    )

    return run


def licenses(
    docs: DataFrame, id_col: str, text_col: str, templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE,
    telling: dict[str, tuple[str, str]] = TELLING, stretch: int = STRETCH,
) -> DataFrame:
    """(id_col, license, matched_words, coverage, first_word, end_word) of templates that texts hold.

    Words are runs of letters and digits, A-Z in lower case. A match lies within ``stretch`` times
    a template's length; stretches of a text that hold too few of its words are not aligned, as the
    coverage could not be reached there. ``telling`` has for a template's name the words that
    a match must hold and those that it must not. Of matches that overlap, the one with more
    matched words is a row, on a tie the one of higher coverage. Null and empty
    texts and templates hold nothing; rows may repeat; an empty table gives no rows; other
    columns are not read. Nothing is shuffled. Templates are few: a parameter.
    """
    flat = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([
        T.StructField("doc", flat.schema["doc"].dataType), T.StructField("license", T.StringType()),
        T.StructField("matched_words", T.LongType()), T.StructField("coverage", T.DoubleType()),
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
    ])
    return flat.transform(in_arrow, _scanned(tuple(templates), coverage, dict(telling), stretch), schema).withColumnRenamed("doc", id_col)
