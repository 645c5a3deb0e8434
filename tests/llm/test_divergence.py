import math
import random
import re
from collections import Counter

from strata.llm.divergence import COMMON, features, quality

SPACE = "\x20\x09-\x0d"


def brute(text):
    text = text or ""
    words = re.findall(f"[^{SPACE}]+", text)
    places = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = set()
    for i in range(len(words) - 7):
        if places[tuple(words[i : i + 8])] > 1:
            marked.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACE}]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(marked))


TEXTS = [
    None, "", " \n ", "a b c", "x y z w v u t s " * 3, "a\nb\na\n \na\n", "é ü　ß | <b> #1 $%&*",
    "one two three four five six seven eight nine " * 2 + "tail", "  a\x0bb\x0cc\x1cd",
]


def test_base_counts():
    for text in TEXTS:
        data = None if text is None else text.encode()
        assert features(data)[:5] == brute(text), text


def _distance(p, q):
    def kl(a, m):
        return sum(x * math.log2(x / y) for x, y in zip(a, m) if x)

    p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(x + y) / 2 for x, y in zip(p, q)]
    return math.sqrt(max(0.0, (kl(p, m) + kl(q, m)) / 2))


def test_distances_and_verdicts(spark, make_docs):
    draw = random.Random(3)
    common = "the dog and cat of it was here with you that is for a house on hill".split()
    texts = [(i, " ".join(draw.choice(common) for _ in range(80)), "en") for i in range(40)]
    junk = " ".join(f"q{i}***$$$%%%" for i in range(60))
    rows = {r.doc_id: r for r in quality(make_docs([*texts, (99, junk, "en")])).collect()}
    mine = [features(t.encode()) for _, t, _ in [*texts, (99, junk, "en")]]
    good = [f for f in mine if not (f[0] < 20 or 100 * f[4] > 30 * f[0])]
    for at, name in ((5, "class_distance"), (6, "word_distance")):
        reference = [sum(x) for x in zip(*(f[at] for f in good))]
        assert math.isclose(getattr(rows[99], name), _distance(mine[-1][at], reference), abs_tol=1e-9)
    assert not rows[99].kept and not rows[99].base_failed


def test_odd_rows(odd, none):
    found = quality(odd).collect()
    assert len(found) == 9
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].n_words == 0 and by_id[2].base_failed and not by_id[2].kept
    assert by_id[2].class_distance is None
    assert by_id[5].base_failed  # nearly all of it is repeated
    assert quality(none).count() == 0


def test_word_lists_are_in_lower_case():
    assert all(w == w.lower() for words in COMMON.values() for w in words)


def test_labelled_documents(spark, data):
    big = data.replace("sf0.001", "sf0.01")
    found = quality(spark.read.parquet(f"{big}/documents.parquet"))
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rows = found.where("not base_failed").join(labels, "doc_id").collect()
    clean = [r for r in rows if r.quality == 1]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)
    assert sum(not r.kept for r in bad) > 0.3 * len(bad)
