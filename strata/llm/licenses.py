"""License scans by patience alignment of texts with license templates.

Words that occur once in the template and once in the stretch of text are anchors; the
longest run of anchors in the same order in both is kept, and the gaps between them are
aligned the same way. Coverage is the share of the template's words that found a partner.

The copies of a full license text are chosen by the words that occur once in the template:
their places in the whole text are dealt to chains that rise in both, and coverage alone
decides about a chain. A line of few words has no such redundancy: it must hold the words
that make it this license, and stands around one of them.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from strata.llm.rows import id_type, per_row

_WORD = re.compile(r"[^\W_]+")

#: up to this many words a template is a line, and must be found with its needed words
LINE = 16
#: extra words between two anchors cost this for each doubling, so that no number of them ends a copy
GAP_COST = 0.25

# fixed values: name, words that must be matched (of a line), text
TEMPLATES = [
    ("Apache-2.0", "apache", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0-header", "apache unless", """Licensed under the Apache License, Version 2.0 (the
     "License"); you may not use this file except in compliance with the License. You may obtain
     a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
     applicable law or agreed to in writing, software distributed under the License is
     distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
     express or implied. See the License for the specific language governing permissions and
     limitations under the License."""),
    ("MIT", "mit released", "Released under the MIT License"),
    ("MIT-notice", "mit licensed", "Licensed under the MIT License"),
    ("MIT-text", "sublicense noninfringement", """Permission is hereby granted, free of charge, to any person obtaining
     a copy of this software and associated documentation files (the "Software"), to deal in the
     Software without restriction, including without limitation the rights to use, copy, modify,
     merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
     persons to whom the Software is furnished to do so, subject to the following conditions:
     The above copyright notice and this permission notice shall be included in all copies or
     substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF
     ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
     FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
     COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
     OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
     THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC-text", "fee granted", """Permission to use, copy, modify, and/or distribute this software for any
     purpose with or without fee is hereby granted, provided that the above copyright notice and
     this permission notice appear in all copies."""),
    ("BSD-2-text", "retain reproduce", """Redistribution and use in source and binary forms, with or without
     modification, are permitted provided that the following conditions are met: Redistributions
     of source code must retain the above copyright notice, this list of conditions and the
     following disclaimer. Redistributions in binary form must reproduce the above copyright
     notice, this list of conditions and the following disclaimer in the documentation and/or
     other materials provided with the distribution."""),
    ("GPL-3.0", "gnu 3", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0-header", "gnu redistribute", """This program is free software: you can redistribute it and/or
     modify it under the terms of the GNU General Public License as published by the Free
     Software Foundation, either version 3 of the License, or (at your option) any later
     version."""),
    ("CC-BY-NC-4.0", "cc nc 4", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "commons attribution 4", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
]


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in both; ``pairs`` come in order of the first."""
    tops: list[int] = []
    ends: list[int] = []  # index into pairs of each pile's top
    before = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        pile = bisect.bisect_left(tops, b)
        before[i] = ends[pile - 1] if pile else -1
        tops[pile : pile + 1] = [b]
        ends[pile : pile + 1] = [i]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places of the two lists, rising in both."""
    found: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        many_a, many_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if many_b[w] == 1}
        shared = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if many_a[w] == 1 and w in place]
        anchors = _increasing(shared)
        found += anchors
        if anchors:
            lows = [(a0 - 1, b0 - 1), *anchors]
            highs = [*anchors, (a1, b1)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(lows, highs)]
    return sorted(found)


@dataclass(frozen=True)
class Template:
    name: str
    needed: frozenset[str]
    words: tuple[str, ...]

    @property
    def slack(self) -> int:
        return len(self.words) // 4 + 2

    @property
    def line(self) -> bool:
        return len(self.words) <= LINE

    @cached_property
    def counts(self) -> Counter:
        return Counter(self.words)

    @cached_property
    def anchors(self) -> dict[str, int]:
        """The words that occur once, with their places."""
        return {w: i for i, w in enumerate(self.words) if self.counts[w] == 1}

    def may_stand(self, present: set[str], min_coverage: float) -> bool:
        """Whether a text of these words can be covered enough, whatever their order."""
        if self.line and not self.needed <= present:
            return False
        lost = sum(self.counts[w] for w in self.counts.keys() - present)
        return (len(self.words) - lost) / len(self.words) >= min_coverage


def templates(rows: Iterable[tuple[str, str, str]] = TEMPLATES) -> list[Template]:
    known = [Template(n, frozenset(words(k)), tuple(words(t))) for n, k, t in rows]
    for t in known:
        if not any(t.words.count(w) == 1 for w in t.needed) or not t.needed <= set(t.words):
            raise ValueError(f"{t.name} needs a word that occurs once in it")
    return known


def stretches(t: Template, text: list[str], where: dict[str, list[int]]) -> list[tuple[int, int]]:
    """Where a line may stand: around each place of its rarest needed word.

    Two copies of a license next to each other would hide each other's anchors, so a stretch
    that may reach into another copy is also tried cut off between the two places.
    """
    rarest = min((w for w in t.needed if t.words.count(w) == 1), key=lambda w: (len(where[w]), w))
    before = t.words.index(rarest)
    after = len(t.words) - before
    places = where[rarest]
    out = []
    for i, p in enumerate(places):
        low, high = max(0, p - before - t.slack), min(len(text), p + after + t.slack)
        out.append((low, high))
        if i and places[i - 1] + after > low:
            low = max(low, places[i - 1] + 1, min(p - before, places[i - 1] + after))
        if i + 1 < len(places) and places[i + 1] - before < high:
            high = min(high, places[i + 1], max(p + after, places[i + 1] - before))
        if (low, high) != out[-1]:
            out.append((low, high))
    return out


def chains(t: Template, where: dict[str, list[int]]) -> list[list[tuple[int, int]]]:
    """Places of the template's anchors in the text as (template, text), one chain a copy.

    A chain rises in both; the chains follow each other and hold as many places as they can,
    less the cost of gaps. A further chain costs a quarter of the anchors: less than a copy
    holds, more than what is gained by leaving a copy for a passage that is quoted inside it.
    """
    places = sorted((p, i) for w, i in t.anchors.items() for p in where.get(w, ()))
    again = len(t.anchors) / 4
    score, before, fresh = [0.0] * len(places), [-1] * len(places), [True] * len(places)
    # for each place of the template the best and the latest of its places in the text
    best, latest = [-1] * len(t.words), [-1] * len(t.words)
    top = -1
    for k, (p, i) in enumerate(places):
        most, last, new = 0.0, -1, True
        if top >= 0 and score[top] - again > 0:
            most, last = score[top] - again, top
        for j in {*best[:i], *latest[:i]}:
            if j >= 0 and score[j] > most:
                extra = abs(p - places[j][0] - i + places[j][1])
                value = score[j] - (GAP_COST * math.log2(extra + 1) if extra else 0.0)
                if value > most:
                    most, last, new = value, j, False
        score[k], before[k], fresh[k] = most + 1, last, new
        latest[i] = k
        if best[i] < 0 or score[k] >= score[best[i]]:
            best[i] = k
        if top < 0 or score[k] > score[top]:
            top = k
    out: list[list[tuple[int, int]]] = [[]]
    while top >= 0:
        p, i = places[top]
        out[-1].append((i, p))
        if fresh[top]:
            out.append([])
        top = before[top]
    return [c[::-1] for c in out[::-1] if c]


def around(t: Template, text: list[str], chain: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    """The chain with what aligns in its gaps, and before and after it within low and high."""
    pairs = list(chain)
    i, p = chain[0]
    while i and p > low and t.words[i - 1] == text[p - 1]:
        i, p = i - 1, p - 1
        pairs.append((i, p))
    gaps = [((-1, low - 1), (i, p)), *zip(chain, chain[1:]), (chain[-1], (len(t.words), high))]
    for (i, p), (j, q) in gaps:
        if i + 1 < j and p + 1 < q:
            inside = patience(list(t.words[i + 1 : j]), text[p + 1 : q])
            pairs += [(i + 1 + x, p + 1 + y) for x, y in inside]
    return sorted(pairs)


def copies(t: Template, text: list[str], where: dict[str, list[int]], min_coverage: float) -> list[list[tuple[int, int]]]:
    """The alignments of a full text's copies that are covered enough, one after the other."""
    found: list[list[tuple[int, int]]] = []
    end, dealt = 0, chains(t, where)
    for k, chain in enumerate(dealt):
        (i, p), (j, q) = chain[0], chain[-1]
        after = len(t.words) - j
        low, high = max(end, p - 2 * i - t.slack), min(len(text), q + 2 * after + t.slack)
        if k + 1 < len(dealt):
            x, y = dealt[k + 1][0]
            high = min(high, y, max(q + after, y - x))
        pairs = around(t, text, chain, low, high)
        end = q + 1
        if len(pairs) / len(t.words) >= min_coverage:
            found.append(pairs)
            end = pairs[-1][1] + 1
    return found


def scan(text: list[str], known: list[Template], min_coverage: float) -> list[tuple[str, int, int, int, float]]:
    """name, start, end (words), matched words and coverage of each license found.

    Of matches that overlap, the one with more matched words stays, then the shorter, then
    the first by name.
    """
    present = set(text)
    known = [t for t in known if t.may_stand(present, min_coverage)]
    vocabulary = {w for t in known for w in (t.needed if t.line else t.anchors)}
    where: dict[str, list[int]] = {}
    for i, w in enumerate(text if known else ()):
        if w in vocabulary:
            where.setdefault(w, []).append(i)
    found = []
    for t in known:
        if t.line:
            aligned = []
            for low, high in stretches(t, text, where):
                pairs = [(i, low + p) for i, p in patience(list(t.words), text[low:high])]
                if len(pairs) / len(t.words) >= min_coverage and t.needed <= {t.words[i] for i, _ in pairs}:
                    aligned.append(pairs)
        else:
            aligned = copies(t, text, where, min_coverage)
        found += [(t.name, a[0][1], a[-1][1] + 1, len(a), len(a) / len(t.words)) for a in aligned]
    chosen: list[tuple[str, int, int, int, float]] = []
    for f in sorted(found, key=lambda f: (-f[3], f[2] - f[1], f[0], f[1])):
        if all(f[2] <= c[1] or c[2] <= f[1] for c in chosen):
            chosen.append(f)
    return sorted(chosen, key=lambda f: f[1:3])


def license_scan(
    docs: DataFrame, rows: list[tuple[str, str, str]] = TEMPLATES, min_coverage: float = 0.8
) -> DataFrame:
    """doc_id, n_matches, licenses, best_coverage, spans for every row of ``docs``.

    ``licenses`` are the names found, sorted and joined by commas; ``spans`` are
    ``name:start:end:matched`` in words, in order. A null or empty text has no matches and
    coverage 0. Repeated rows are scanned each; an empty table gives no rows; other columns
    are not used.
    """
    known = templates(rows)

    def make() -> Callable[[tuple], Iterable[tuple]]:
        def one(row: tuple) -> Iterable[tuple]:
            found = scan(words((row[1] or b"").decode()), known, min_coverage)
            yield (
                row[0], len(found), ",".join(sorted({f[0] for f in found})),
                max((f[4] for f in found), default=0.0),
                ",".join(f"{f[0]}:{f[1]}:{f[2]}:{f[3]}" for f in found),
            )

        return one

    return per_row(
        docs, ["doc_id", "text"],
        f"doc_id {id_type(docs)}, n_matches long, licenses string, best_coverage double, spans string",
        make,
    )
