from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.labels import COUNT_TYPES, label
from strata.functions.parsing import load_timestamp, mixed_date, term_date
from strata.functions.registry import lookup, register
from strata.functions.text import strip, title_case
from strata.operators.bronze import clean_headers, to_bronze
from strata.operators.mapping import EntityMapping, choose_mapping, map_entity, union_sources
from strata.operators.transform import TransformRule, apply_transforms, with_defaults
from strata.plans import group_dimension as dim
from strata.sources.contracts import drift, load_schema, required_columns, rescue, save_schema


def test_mixed_dates_never_fail(spark):
    df = spark.createDataFrame([("20250408",), ("2025-04-08",), ("2025-13-99",), ("",), (None,)], "x string")
    parsed = [r[0] for r in df.select(mixed_date(F.col("x"))).collect()]
    assert parsed == [date(2025, 4, 8)] * 2 + [None] * 3


def test_term_dates(spark):
    df = spark.createDataFrame([("20781231",), ("20250630",), (None,)], "x string")
    assert [r[0] for r in df.select(term_date(F.col("x"))).collect()] == [date(9999, 12, 31), date(2025, 6, 30), None]


def test_load_timestamp_from_number(spark):
    df = spark.createDataFrame([(202504081230,), (None,), (5,)], "x long")
    stamps = [r[0] for r in df.select(F.date_format(load_timestamp(F.col("x")), "yyyyMMddHHmm")).collect()]
    assert stamps == ["202504081230", None, None]


def test_title_case_is_not_initcap(spark):
    df = spark.createDataFrame([("o'neil a-b 3m",), ("ÉCOLE",), (None,), ("",)], "x string")
    got = [r[0] for r in df.select(title_case(F.col("x"))).collect()]
    assert got == [None if s is None else s.title() for s in ("o'neil a-b 3m", "ÉCOLE", None, "")]
    assert df.select(F.initcap("x")).first()[0] == "O'neil A-b 3m"


def test_strip_takes_all_white_space(spark):
    df = spark.createDataFrame([("\t a b\n ",), (None,)], "x string")
    assert [r[0] for r in df.select(strip(F.col("x"))).collect()] == ["a b", None]


def test_registry():
    with pytest.raises(KeyError, match="no custom function"):
        lookup("missing")


def test_registered_function_is_used(spark):
    register("shout", lambda c: F.concat(F.upper(c), F.lit("!")))
    df = spark.createDataFrame([("a",)], "x string")
    assert apply_transforms(df, [TransformRule("x", "custom", "shout")]).first().x == "A!"


def test_rules_chain_in_order(spark):
    df = spark.createDataFrame([(" ann ", 7)], "x string, n int")
    rules = [
        TransformRule("x", "title case", "initcap"),
        TransformRule("x", "trim", "trim"),
        TransformRule("n", "trim", "trim"),
        TransformRule("c", "default", "Facets"),
        TransformRule("both", "expression", "concat(x, n)"),
        TransformRule("x", "trim", ""),
    ]
    row = apply_transforms(df, rules).first()
    assert (row.x, row.n, row.c, row.both) == ("Ann", "7", "Facets", "Ann7")
    plan = apply_transforms(df, rules[:4])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1
    assert with_defaults(df, ["x"], {"x": "k", "y": "z"}).first().x == "k"


def test_headers_and_missing_columns(spark):
    df = spark.createDataFrame([(1, "a")], "`Group ID` int, `Group Name` string")
    assert clean_headers(df).columns == ["Group_ID", "Group_Name"]
    with pytest.raises(Exception, match="Not There"):
        to_bronze(df, ["Group ID", "Not There"], 1)


def test_contract_lookup():
    assert "GRGR_CK" in required_columns(dim.CONTRACTS, "Facets", "cdc", "cmc_grgr_group")
    with pytest.raises(KeyError, match="no contract"):
        required_columns(dim.CONTRACTS, "Facets", "cdc", "cmc_grgc_group_count")


def test_unknown_mapping(spark):
    with pytest.raises(KeyError, match="no mapping"):
        choose_mapping(dim.mappings(), "VHP", "DF_Group_Count")


def test_mapping_case_and_union(spark):
    a = spark.createDataFrame([("1", "x", True)], "Group_ID string, v string, is_valid boolean")
    mapping = EntityMapping(rename={"group_id": "Group_Id"}, derive={"s": F.lit("A")}, drop=["is_valid"])
    mapped = map_entity(a, mapping)
    assert mapped.columns == ["Group_Id", "v", "s"]
    both = union_sources([mapped, mapped.drop("v").withColumn("s", F.lit("B"))])
    assert sorted((r.s, r.v) for r in both.collect()) == [("A", "x"), ("B", None)]


def test_entities_have_their_columns(spark, data):
    from strata.queries import shaping

    a = shaping.mapped(shaping.a_history(spark, data), "Facets", "DF_Group_History")
    b = shaping.mapped(shaping.b_history(spark, data), "VHP", "DF_Group_History")
    assert set(a.columns) == set(b.columns) >= set(dim.HISTORY_ATTRIBUTES)
    a = shaping.mapped(shaping.a_group(spark, data), "Facets", "DF_Group")
    b = shaping.mapped(shaping.b_group(spark, data), "VHP", "DF_Group")
    assert set(a.columns) == set(b.columns) >= set(dim.GROUP_ATTRIBUTES)
    types = {f.name: f.dataType.simpleString() for f in a.schema}
    assert types == {f.name: f.dataType.simpleString() for f in b.schema}


def test_labels(spark):
    df = spark.createDataFrame([("MLRR",), ("MLRP",), ("MLRD",), ("ZZ",), (None,)], "x string")
    got = [r[0] for r in df.select(label(F.col("x"), COUNT_TYPES)).collect()]
    assert got == ["Group Response", "Previous Group Response", "Default", "Not Applicable", "Not Applicable"]


def test_schema_snapshot_and_drift(spark, tmp_path):
    old = spark.createDataFrame([], "a int, b string, c date")
    save_schema(old, str(tmp_path / "schema"))
    assert load_schema(spark, str(tmp_path / "schema")) == old.schema
    new = spark.createDataFrame([], "A long, b string, d int")
    assert drift(old.schema, new.schema) == [
        ("a", "retyped", "int", "bigint"), ("c", "missing", "date", None), ("d", "added", None, "int"),
    ]


def test_rescue_keeps_extras(spark):
    want = T.StructType([T.StructField("a", T.LongType()), T.StructField("z", T.StringType())])
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, extra string")
    assert [tuple(r) for r in rescue(df, want).collect()] == [(1, None, '{"extra":"x"}'), (2, None, None)]
    assert rescue(df.select("a"), want).first().rescued_data is None
