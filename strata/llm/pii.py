"""Personal data by weak supervision, in column functions only.

Base kinds are found by fixed patterns and stay. Looser patterns propose further spans
(obfuscated addresses, local phone numbers, credentials, national numbers). Labelers vote on
every proposal: its strict form, the words before it, a gazetteer, its inner make-up, and
contexts that speak against it. Expectation maximisation over the counts of vote patterns
estimates how reliable each labeler is; a logistic span classifier is then trained on the
votes and the span's shape with the estimated labels, and decides which proposals are added.

The counts cover all documents; what reaches the driver is one row for each vote pattern
that occurs, at most ``3 ** 5 * 3 * 4`` of them.

The patterns give the contract's matches in linear time: a match can begin only where a run
of its first class begins, so that a run is not tried again from each of its characters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.decontaminate import let
from strata.llm.rows import save_and_read

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret", "id"]
_LOCAL = "[A-Za-z0-9._%+-]"
#: kind -> (cheap test that must hold, pattern)
BASE = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    # a maximal run of digits with single separators; only 13 to 19 digits can pass
    "card": (r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
             r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
PROPOSALS = {
    "email": (r"(?i)[\[(] ?at ?[\])]",
              rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?[\[(] ?at ?[\])] ?[a-z0-9-]{{1,63}}+"
              r"(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[a-z0-9-]{1,63}+){1,5}+"),
    "phone": (r"[0-9]{3}[.-][0-9]{4}",
              r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])"),
    "secret": (r"[=:]", r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}"
               r"[\"']?[a-z0-9_+/-]{8,}+"),
    # account numbers end in a group of one to three; behind a blank it needs a digit, not to take
    # a word, but for the countries whose last group may be letters
    "id": (r"[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
           r"|\bCH[0-9]{2}(?: ?[A-Z0-9]{4}){4} ?[A-Z0-9]\b|\bIT[0-9]{2}(?: ?[A-Z0-9]{4}){5} ?[A-Z0-9]{3}\b"
           r"|\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?:(?: (?=[A-Z]{0,2}[0-9]))?[A-Z0-9]{1,3})?\b"),
}
# fixed values: words that speak for a kind in front of a span, and gazetteers
CONTEXT = {
    "email": "mail|contact|write|reach",
    "phone": "phone|call|tel|fax|mobile|dial",
    "secret": "config|export|login|auth|key|set",
    "id": "ssn|social|iban|account|passport|tax",
}
AGAINST = "version|isbn|issn|order|page|chapter|example|placeholder|section"
GAZETTEER = {
    "email": r"(?i)(?:com|org|net|edu|gov|de|fr|es|uk|io)$",
    "phone": r"(?:555|800|888|877|866)",
    "secret": r"(?i)(?:password|passwd|token|api[_-]?key)",
    "id": r"^(?:DE|FR|ES|GB|IT|NL|AT|CH|BE)[0-9]{2}",
}
LABELERS = ["strict", "context", "gazetteer", "make_up", "against"]
_SPAN = "array<struct<start:int,end:int,hit:string,before:string>>"


def _spans(text: Column, test: str, pattern: str) -> Column:
    """Matches with their place in code points and the text between them and the last one."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.array().cast(_SPAN)

    def walk(ms: Column) -> Column:
        def step(acc: Column, pair: Column) -> Column:
            low = acc.at + F.length(pair.before)
            high = low + F.length(pair.hit)
            found = F.struct(low.alias("start"), high.alias("end"), pair.hit.alias("hit"),
                             F.lower(F.right(pair.before, F.lit(40))).alias("before"))
            return F.struct(high.alias("at"), F.concat(acc.found, F.array(found)).alias("found"))

        pairs = F.zip_with(ms, F.slice(between, 1, F.size(ms)), lambda m, b: F.struct(
            m.alias("hit"), b.alias("before")))
        start = F.struct(F.lit(0).alias("at"), empty.alias("found"))
        return F.when(F.size(ms) == 0, empty).otherwise(F.aggregate(pairs, start, step, lambda a: a.found))

    return F.when(text.rlike(test), let(matches, walk)).otherwise(empty)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        one = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = one * 2
        return F.when(i % 2 == 0, one).when(twice > 9, twice - 9).otherwise(twice)

    places = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), value)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def _part_fits(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+(?=.)", "")
    return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)


def base_spans(text: Column, kind: str) -> Column:
    test, pattern = BASE[kind]
    passes = {
        "email": lambda s: F.lit(True),
        "ip": lambda s: F.forall(F.split(s.hit, r"\."), _part_fits),
        "card": lambda s: _luhn(_digits(s.hit)),
        "phone": lambda s: F.length(_digits(s.hit)).between(9, 15),
    }[kind]
    return F.filter(_spans(text, test, pattern), passes)


def _vote(yes: Column, no: Column | None = None) -> Column:
    vote = F.when(yes, 1)
    return (vote.when(no, -1) if no is not None else vote).otherwise(0)


def _votes(kind: str, s: Column) -> Column:
    """One vote a labeler: 1 for personal data, -1 against, 0 none."""
    value = F.regexp_replace(s.hit, r"^[^=:]*[=:]\s*[\"']?", "")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    digits = _digits(s.hit)
    strict = {
        "email": s.hit.rlike(r"(?i)[\[(] ?dot ?[\])]|\.[a-z]{2,}$"),
        "phone": F.length(digits) == 10,
        "secret": s.hit.rlike(r"[=:]") & (F.length(value) >= 8),
        "id": F.length(F.replace(s.hit, F.lit(" "), F.lit(""))) >= 11,
    }[kind]
    make_up = {
        "email": _vote(~s.hit.rlike(r"[0-9]{6}")),
        "phone": _vote(~digits.rlike(r"^([0-9])\1+$"), digits.rlike(r"^([0-9])\1+$")),
        "secret": _vote(mixed, ~mixed),
        "id": _vote(~digits.rlike("^(?:000|666|9)"), digits.rlike("^(?:000|666|9)")),
    }[kind]
    return F.array(
        _vote(strict, ~strict),
        _vote(s.before.rlike(CONTEXT[kind])),
        _vote(s.hit.rlike(GAZETTEER[kind])),
        make_up,
        F.when(s.before.rlike(AGAINST) | s.hit.rlike(f"(?i){AGAINST}"), -1).otherwise(0),
    )


def proposals(text: Column, kind: str) -> Column:
    def judged(s: Column) -> Column:
        shape = F.when(s.end - s.start <= 16, 0).when(s.end - s.start <= 40, 1).otherwise(2)
        return F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"),
                        _votes(kind, s).alias("votes"), shape.alias("shape"))

    return F.transform(_spans(text, *PROPOSALS[kind]), judged)


Pattern = tuple[str, tuple[int, ...], int]


def reliabilities(counts: dict[Pattern, int], rounds: int = 30) -> dict[Pattern, float]:
    """Expectation maximisation: the chance of each vote pattern to be personal data.

    Votes are independent given the truth; each labeler has one table for all kinds, each
    kind its own share. Begins with the majority of the votes.
    """
    belief = {p: 1 / (1 + math.exp(-sum(p[1]))) for p in counts}
    for _ in range(rounds):
        share, tables = {}, {}
        for kind in {p[0] for p in counts}:
            mine = {p: n for p, n in counts.items() if p[0] == kind}
            share[kind] = (1 + sum(belief[p] * n for p, n in mine.items())) / (2 + sum(mine.values()))
        for truth in (0, 1):
            for at in range(len(LABELERS)):
                seen = {v: 1.0 for v in (-1, 0, 1)}
                # without these a vote against could come to count in favour
                seen[1 if truth else -1] += 1.0
                for p, n in counts.items():
                    seen[p[1][at]] += n * (belief[p] if truth else 1 - belief[p])
                tables[truth, at] = {v: x / sum(seen.values()) for v, x in seen.items()}
        for p in counts:
            odds = math.log(share[p[0]] / (1 - share[p[0]])) + sum(
                math.log(tables[1, at][v] / tables[0, at][v]) for at, v in enumerate(p[1])
            )
            belief[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief


def classifier(counts: dict[Pattern, int], belief: dict[Pattern, float], steps: int = 400) -> list[float]:
    """Weights of a logistic model on votes and shape, trained on the estimated labels.

    Prior weight one vote for every vote, so that little data means the majority.
    """
    total = sum(counts.values()) or 1
    prior = [0.0, *(1.0 for _ in LABELERS), 0.0, 0.0]
    weights = list(prior)
    for _ in range(steps):
        slope = [0.01 * (w - p) for w, p in zip(weights, prior)]
        for p, n in counts.items():
            x = _inputs(p)
            miss = 1 / (1 + math.exp(-sum(a * b for a, b in zip(weights, x)))) - belief[p]
            for i, v in enumerate(x):
                slope[i] += miss * v * n / total
        weights = [w - 0.5 * s for w, s in zip(weights, slope)]
    return weights


def _inputs(p: Pattern) -> list[float]:
    return [1.0, *map(float, p[1]), float(p[2] == 1), float(p[2] == 2)]


def personal_data(docs: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """doc_id, base (kind -> spans), spans (kind, start, end) of every row of ``docs``.

    ``extra`` columns are carried along. A null or empty text has none. Repeated rows are
    searched each; an empty table gives no rows. Spans are in code points, end exclusive;
    proposals that overlap a base span are dropped, and of two that overlap the one that
    begins later (of equal beginnings, the later kind).
    """
    text = F.coalesce("text", F.lit(""))
    plain = "struct<kind:string,start:int,end:int>"

    def place(kind: Column, s: Column) -> Column:
        return F.struct(kind.alias("kind"), s.start.alias("start"), s.end.alias("end"))

    def placed(kind: str) -> Column:
        return F.transform(base_spans(text, kind), lambda s: place(F.lit(kind), s))

    base = F.concat(*map(placed, BASE_KINDS))
    proposed = F.concat(*(proposals(text, k) for k in PROPOSALS))

    def fresh(bs: Column) -> Column:
        return F.struct(bs.alias("base"), F.filter(proposed, lambda c: ~F.exists(
            bs, lambda b: (b.start < c.end) & (c.start < b.end))).alias("more"))

    found = docs.select("doc_id", *(extra or []), let(base, fresh).alias("found")).select(
        "doc_id", *(extra or []), "found.base", "found.more"
    )
    found = save_and_read(found, "proposals")
    histogram = found.select(F.explode("more").alias("c")).groupBy("c.kind", "c.votes", "c.shape").count()
    counts = {(r.kind, tuple(r.votes), r.shape): r["count"] for r in histogram.collect()}
    weights = classifier(counts, reliabilities(counts)) if counts else [0.0] * (len(LABELERS) + 3)

    def odds(c: Column) -> Column:
        total = F.lit(weights[0])
        for i in range(len(LABELERS)):
            total = total + weights[1 + i] * c.votes[i]
        return total + F.when(c["shape"] == 1, weights[-2]).when(c["shape"] == 2, weights[-1]).otherwise(0.0)

    sure = F.transform(F.filter("more", lambda c: odds(c) > 0), lambda c: place(c.kind, c))
    alone = let(sure, lambda ss: F.filter(ss, lambda c: ~F.exists(ss, lambda o: (
        (o.start < c.end) & (c.start < o.end)
        & ((o.start < c.start) | ((o.start == c.start) & (o.kind < c.kind)))))))
    return found.select(
        "doc_id", *(extra or []), "base", F.concat("base", alone).cast(f"array<{plain}>").alias("spans")
    )


def _listed(spans: Column) -> Column:
    """kind:start:end in the order of the kinds, then of the starts."""

    def of(kind: str) -> Column:
        mine = F.transform(
            F.filter(spans, lambda s: s.kind == kind),
            lambda s: F.struct(s.start.alias("a"), s.end.alias("b")),
        )
        return F.transform(F.array_sort(mine), lambda s: F.concat_ws(
            ":", F.lit(kind), s.a.cast("string"), s.b.cast("string")))

    return F.array_join(F.concat(*map(of, KINDS)), ",")


def span_report(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256 and spans (see ``personal_data``)."""
    found = personal_data(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in angle brackets."""
    whole = F.struct(*docs.columns).alias("whole_row")
    found = personal_data(docs.select("doc_id", "text", whole), extra=["text", "whole_row"])
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(
        s.start.alias("a"), s.end.alias("b"), s.kind.alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        # base spans of different kinds may overlap: the text is cut once
        skipped = F.substring("text", acc.at + 1, F.greatest(F.lit(0), s.a - acc.at))
        mark = F.when(s.a >= acc.at, F.concat(F.lit("<"), F.upper(s.k), F.lit(">"))).otherwise("")
        return F.struct(F.greatest(acc.at, s.b).alias("at"), F.concat(acc.done, skipped, mark).alias("done"))

    text = F.aggregate(ordered, start, step, lambda a: F.concat(
        a.done, F.substring("text", a["at"] + 1, F.length("text"))))
    text = F.when(F.size("spans") > 0, text).otherwise(F.col("text"))
    return found.select(
        *(text.alias(c) if c == "text" else F.col(f"whole_row.{c}") for c in docs.columns)
    )
