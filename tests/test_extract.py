from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.sources import extract
from strata.sources.extract import CHILD, PARENT, read_lines, value_rows


def small(spark):
    parents = spark.createDataFrame([("P1", "one"), ("P2", "two|x")], "p string, name string")
    children = spark.createDataFrame([("P1", 2, "b"), ("P1", 1, "a"), ("P2", 10, None)], "p string, n int, t string")
    covers = spark.createDataFrame([("P1", "SG"), ("P2", "IN")], "p string, m string")
    columns = {"CTR": ["p", "name"], "SBP": ["p", "n", "t"], "COM": ["m"]}
    return extract.tagged_lines(parents, children, covers, "p", "n", ["C", "id"], ["PLAN", "7.1"], columns)


def test_file_order_and_trailer(spark, tmp_path):
    extract.write_lines(small(spark), str(tmp_path / "f"))
    parts = sorted((tmp_path / "f").glob("part-*"))
    text = "".join(p.read_text() for p in parts).splitlines()
    assert text == [
        "HDR|PLAN|7.1", "CLI|C|id",
        "CTR|P1|one", "SBP|P1|1|a", "SBP|P1|2|b", "COM|SG",
        "CTR|P2|two|x", "SBP|P2|10|", "COM|IN",
        "FTR|PLAN|7.1", "CNT|1|2|3|2|8",
    ]


def test_lines_find_their_parent_across_files_and_blanks(spark, tmp_path):
    place = tmp_path / "f"
    place.mkdir()
    (place / "a.txt").write_text("HDR|x\nCLI|c|1\n\nCTR|P1|one\n\nSBP|P1|1\n")
    (place / "b.txt").write_text("COM|SG\n\nCTR|P2|two\nSBP|P2|1\n")
    (place / "c.txt").write_text("COM|IN\nFTR|x\nCNT|1|2|2|2|7\n")
    lines = extract.read_lines(spark, str(place))
    found = sorted((r.tag, r.fields[0], r.parent) for r in lines.collect())
    assert found == [
        ("CLI", "c", None), ("CNT", "1", None), ("COM", "IN", "P2"), ("COM", "SG", "P1"),
        ("CTR", "P1", "P1"), ("CTR", "P2", "P2"), ("FTR", "x", None), ("HDR", "x", None),
        ("SBP", "P1", "P1"), ("SBP", "P2", "P2"),
    ]
    assert all(r.matches for r in extract.reconcile(lines).collect())


def test_wrong_trailer_is_reported(spark, tmp_path):
    place = tmp_path / "f"
    place.mkdir()
    (place / "a.txt").write_text("CLI|c\nCTR|P1\nSBP|P1|1\nCNT|1|1|5|0|7\n")
    wrong = {r.tag for r in extract.reconcile(extract.read_lines(spark, str(place))).collect() if not r.matches}
    assert wrong == {"SBP", "TOTAL"}


@pytest.mark.parametrize("limit,count", [(None, 3), (2, 2)])
def test_sql_values(spark, limit, count):
    df = spark.createDataFrame([(1, "it's", True), (2, None, False), (3, "", None)], "k int, s string, b boolean")
    got = [r[0] for r in extract.value_rows(df, limit, ["k"]).collect()]
    assert got == ["(1, 'it''s', TRUE)", "(2, NULL, FALSE)", "(3, '', NULL)"][:count]
    assert extract.create_statement("t", df.schema) == (
        "CREATE TABLE IF NOT EXISTS t (`k` int, `s` string, `b` boolean);"
    )
    statement = extract.insert_statements(df.filter(F.col("k") == 1), "t").first().value
    assert statement == "INSERT INTO t (`k`, `s`, `b`) VALUES (1, 'it''s', TRUE);"


def test_literals_give_the_same_values_back(spark):
    kinds = "t string, d date, ts timestamp, b binary, f double, n decimal(10,2), y boolean, i long"
    rows = [
        ("it's a \\ back\\n", date(2025, 4, 8), datetime(2025, 4, 8, 1, 2, 3, 456789), b"\x00\xff'", 1.5, Decimal("1.20"), True, 7),
        (None,) * 8,
        ("", date(1, 1, 1), datetime(1970, 1, 1), b"", float("inf"), Decimal("-0.01"), False, -1),
    ]
    df = spark.createDataFrame(rows, kinds)
    values = [r.value_row for r in value_rows(df, escape_backslashes=True).collect()]
    back = spark.sql(f"SELECT * FROM VALUES {', '.join(values)} AS x(t, d, ts, b, f, n, y, i)")
    again = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in back.collect()]
    assert sorted(again, key=str) == sorted(rows, key=str)
    with pytest.raises(TypeError, match="has no SQL literal"):
        value_rows(spark.sql("SELECT array(1) AS a"))


def test_lines_are_in_the_order_of_part_numbers(spark, tmp_path):
    (tmp_path / "part-99999-x.txt").write_text(f"{PARENT}|A\n")
    (tmp_path / "part-100000-x.txt").write_text(f"{CHILD}|1\n")
    found = {r.tag: r.parent for r in read_lines(spark, str(tmp_path)).collect()}
    assert found == {PARENT: "A", CHILD: "A"}
