import hashlib
import random
import re

from strata.llm.pii import classifier, masked, personal_data, reliabilities, span_report

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(x) <= 255 for x in hit.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1])]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    return [
        (k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])
    ]


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def test_base_spans_against_brute_force(spark):
    draw = random.Random(10)
    parts = [*"aB9.%+-_@ 0129()é🙂\n", "a@b.c", "1.2.3.4", "4539578763621486", "+1 (556) 555-9070", "@x.y", "256", "..", "- "]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 25))) for _ in range(2000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = span_report(frame).collect()
    assert len(found) == len(texts)
    for r in found:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == digest(want), texts[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in PATTERNS]


def test_base_spans_of_documents(spark, data):
    docs = spark.read.parquet(f"{data.replace('sf0.001', 'sf0.01')}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.base_sha256 == digest(base(texts[r.doc_id])) for r in span_report(docs).collect())


def test_proposals_are_judged(spark):
    rows = [
        (1, 'token = "392c32d5b55f97ff33fc3fc853cf31109db4ef39" and more'),
        (2, "write to joe [at] site [dot] com or call (556) 555-9070"),
        (3, "my ssn 123-45-6789"),
        (4, "see section 3.2, order 555-1234 and page 12:30 of the token list"),
        (5, "clean words only: nothing at all to see here, 2024-01-02"),
    ]
    found = {r.doc_id: r.spans for r in span_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: "secret:0:49", 2: "email:9:32,phone:41:55", 3: "id:7:18", 4: "", 5: ""}


def test_labelers_are_weighed():
    # the last labeler is noise: it votes at random, the others agree
    counts = {("secret", (1, 1, 1, 1, v), 0): 50 for v in (0, -1)} | {("secret", (-1, 0, 0, -1, v), 0): 50 for v in (0, -1)}
    belief = reliabilities(counts)
    assert all((b > 0.9) == (p[1][0] == 1) for p, b in belief.items())
    weights = classifier(counts, belief)
    assert weights[1] > abs(weights[5] - 1)


def test_odd_rows_and_long_runs(spark, odd, none, make_docs):
    found = span_report(odd).collect()
    assert len(found) == 9 and all(r.spans == "" for r in found)
    assert span_report(none).count() == 0
    runs = make_docs([(1, "4" * 100_000), (2, "a" * 100_000 + "@"), (3, "1 " * 50_000), (4, "+1" + " " * 50_000)])
    assert {r.spans for r in span_report(runs).collect()} == {""}


def test_masking_keeps_the_rest(spark, make_docs):
    rows = [(1, "mail a@b.com now", "en"), (1, "mail a@b.com now", "en"), (2, "no data", "de"), (3, None, None)]
    docs = make_docs(rows)
    found = masked(docs)
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    assert sorted(str(r.text) for r in found.collect()) == ["None", "mail <EMAIL> now", "mail <EMAIL> now", "no data"]
    assert {r.spans for r in found.collect()} == {"spans"}  # the table's own column


def test_no_python_runs(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    plan = personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_secrets_are_masked_whole(spark, make_docs):
    draw = random.Random(5)
    keys = ["".join(draw.choice("abcdefgh0123456") for _ in range(n)) for n in (8, 128, 129, 300, 5000)]
    docs = make_docs([(i, f'set api_key = "{k}" and more') for i, k in enumerate(keys)])
    assert {r.text for r in masked(docs).collect()} == {'set <SECRET>" and more'}


def test_account_numbers_are_masked_whole(spark, make_docs):
    numbers = [
        "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606",
        "NL91 ABNA 0417 1643 00", "IT60 X054 2811 1010 0000 0123 456", "CH93 0076 2011 6238 5295 7",
        "CH93 0076 2011 6238 5295 K", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "ES91 2100 0418 4502 0005 1332",
    ]
    texts = [f"iban {n}{after}" for n in numbers for n in (n, n.replace(" ", "")) for after in (" BIC as before", ".")]
    found = masked(make_docs(list(enumerate(texts)))).collect()
    assert {(texts[r.doc_id], r.text) for r in found} == {(t, "iban <ID>" + (" BIC as before" if "BIC" in t else ".")) for t in texts}
