import pytest

from strata.llm.licenses import TEMPLATES, license_scan, patience, scan, templates, words

KNOWN = templates()


@pytest.mark.parametrize("name, needed, text", TEMPLATES, ids=[t[0] for t in TEMPLATES])
def test_every_template_is_found(name, needed, text):
    inside = words("Foo bar of the baz. " * 3 + text + ". And the end of the line. " * 4)
    [found] = scan(inside, KNOWN, 0.8)
    assert found[0] == name and found[4] == 1.0 and inside[found[1] : found[2]] == words(text)
    twice = scan(words(f"{text} {text} and {text}"), KNOWN, 0.8)
    assert [f[0] for f in twice] == [name] * 3 and all(f[4] == 1.0 for f in twice)


def test_changed_words_lower_the_coverage():
    mit = words(next(t for n, _, t in TEMPLATES if n == "MIT-text"))
    for every, low, high in ((20, 0.9, 0.96), (6, 0.8, 0.85)):
        text = ["changed" if i % every == every - 1 and w not in ("sublicense", "noninfringement") else w
                for i, w in enumerate(mit)]
        [found] = scan(["x"] * 50 + text + ["y"] * 50, KNOWN, 0.8)
        assert found[0] == "MIT-text" and low <= found[4] <= high
    assert scan(mit[: len(mit) // 2], KNOWN, 0.8) == []


def test_patience_is_an_alignment():
    a, b = "a x b y c z d".split(), "q a b w c x d z".split()
    pairs = patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p < q and r < s for (p, r), (q, s) in zip(pairs, pairs[1:]))
    assert [a[i] for i, _ in pairs] == ["a", "b", "c", "d"]
    assert patience([], b) == patience(["k"], b) == []
    assert len(patience(a, a)) == len(a)


def test_mentions_are_not_licenses(spark, make_docs):
    rows = [(1, "the mit lab released a license to travel"), (2, "apache helicopters"), (3, "Released under the MIT License.")]
    found = {r.doc_id: r for r in license_scan(make_docs(rows)).collect()}
    assert [found[i].n_matches for i in (1, 2, 3)] == [0, 0, 1]
    assert found[3].spans == "MIT:0:5:5" and found[3].best_coverage == 1.0


def test_against_the_lines_of_the_documents(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    lines = {
        "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "MIT": "Released under the MIT License.",
        "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    }
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in license_scan(docs).collect():
        want = sorted(n for n, line in lines.items() if line in texts[r.doc_id])
        assert r.licenses == ",".join(want)


def test_odd_rows(odd, none):
    found = license_scan(odd).collect()
    assert len(found) == 9 and all((r.n_matches, r.spans, r.best_coverage) == (0, "", 0.0) for r in found)
    assert license_scan(none).count() == 0


def text_of(name):
    return words(next(t for n, _, t in TEMPLATES if n == name))


@pytest.mark.parametrize("name, word, other", [
    ("MIT-text", "noninfringement", ["non", "infringement"]), ("MIT-text", "sublicense", ["relicense"]),
    ("Apache-2.0-header", "unless", []), ("ISC-text", "granted", []), ("BSD-2-text", "retain", ["keep"]),
    ("GPL-3.0-header", "gnu", []),
])
def test_no_single_word_decides_about_a_full_text(name, word, other):
    text, at = text_of(name), text_of(name).index(word)
    changed = ["x"] * 30 + text[:at] + other + text[at + 1 :] + ["y"] * 30
    [found] = scan(changed, KNOWN, 0.8)
    assert found[:4] == (name, 30, len(changed) - 30, len(text) - 1)


@pytest.mark.parametrize("name", [t.name for t in KNOWN if not t.line])
def test_inserted_words_do_not_lower_the_coverage(name):
    text = text_of(name)
    extra = "some words of another kind that were put in between ".split()
    half, third = len(text) // 2, len(text) // 3
    block = text[:half] + extra * 200 + text[half:]
    spread = [w for i, v in enumerate(text) for w in ([extra[i % 5], v] if i % 2 else [v])]
    parts = text[:third] + extra * len(text) + text[third : 2 * third] + extra * len(text) + text[2 * third :]
    for changed in (block, spread, parts):
        [found] = scan(["x"] * 30 + changed + ["y"] * 30, KNOWN, 0.8)
        assert found[:2] == (name, 30) and found[2] == 30 + len(changed) and found[4] > 0.95


@pytest.mark.parametrize("name", [t.name for t in KNOWN if not t.line])
def test_damaged_copies_next_to_each_other_stay_apart(name):
    text = text_of(name)
    first = text[: len(text) * 9 // 10] + ["x"] * (len(text) // 10)
    second = ["y"] * (len(text) // 10) + text[len(text) // 10 :]
    for copies in ([first, second], [second, first], [first, second, text, first]):
        found = scan([w for c in copies for w in c], KNOWN, 0.8)
        assert [f[0] for f in found] == [name] * len(copies)
        starts = [sum(map(len, copies[:i])) for i in range(len(copies))]
        assert all(s <= f[1] and f[2] <= s + len(c) + 1 for s, f, c in zip(starts, found, copies))


def test_words_of_a_license_far_apart_are_none():
    isc = text_of("ISC-text")
    far = [w for v in isc for w in [v, *(f"w{i}" for i in range(60))]]
    assert scan(far, KNOWN, 0.8) == []
