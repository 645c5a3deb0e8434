"""The group dimension: two source systems, three entities, one gold table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.labels import COUNT_TYPES, deleted_flag, label
from strata.functions.parsing import mixed_date, open_end, term_date
from strata.operators.mapping import EntityMapping
from strata.operators.temporal import Intervals, align, dealt, islands, slices, trim
from strata.plans.config import CDC_CONFIG, DQ_CONFIG, SOURCE_CONFIG, TRANSFORM_CONFIG

DIMENSION = "D_Group"
SYSTEM_A, SYSTEM_B = "Facets", "VHP"
GROUP, HISTORY, COUNT = "DF_Group", "DF_Group_History", "DF_Group_Count"

# fixed values: input tables and their own columns
A_GROUP, A_HISTORY, A_COUNT = "cmc_grgr_group", "cmc_grgr_group_history", "cmc_grgc_group_count"
B_GROUP, B_HISTORY = "ma_group", "ma_group_history"
A_GROUP_COLUMNS = (
    "GRGR_CK GRGR_ID GRGR_NAME GRGR_MCTR_TYPE GRGR_ITS_CODE GRGR_ORIG_EFF_DT GRGR_CONV_DT"
).split()
A_HISTORY_COLUMNS = (
    "GRGR_CK GRGR_ID GRGR_STS GRGR_ADDR1 GRGR_ADDR2 GRGR_ADDR3 GRGR_CITY GRGR_STATE GRGR_COUNTY "
    "GRGR_ZIP GRGR_CTRY_CD GRGR_EMAIL GRGR_PHONE GRGR_PHONE_EXT GRGR_FAX GRGR_FAX_EXT GRGR_TERM_DT "
    "GRGR_MCTR_TRSN GRGR_RNST_DT GRGR_RENEW_MMDD GRGR_ERIS_MMDD CICI_ID GRGR_EIN"
).split()
A_COUNT_COLUMNS = "GRGR_CK GRGC_MCTR_CTYP GRGC_EFF_DT GRGC_TERM_DT GRGC_COUNT".split()
B_GROUP_COLUMNS = ["Group ID", "Group Name", "Group Type Code", "Group Original Effective Date"]
B_HISTORY_COLUMNS = [
    "Group ID", "Group Termination Date",
    "Group Address Line 1", "Group Address Line 2", "Group Address Line 3",
    "Group Address City", "Group Address State", "Group Address Zip Code", "Group Address Country",
    "Group Email", "Group Phone Number", "Group Phone Ext", "Group Fax Number", "Group Fax Ext",
    "Group Renewal Month", "Group EIN",
]
COMMON_COLUMNS = ["loadtimestamp", "source", "source_schema", "business_date"]
A_OPERATION, B_OPERATION = "__$operation", "Operation Code"


def _contracts() -> dict[tuple[str, str, str], list[str]]:
    a_tail, b_tail = [*COMMON_COLUMNS, A_OPERATION], [*COMMON_COLUMNS, B_OPERATION]
    found = {
        (SYSTEM_A, "audit", A_HISTORY): [*A_HISTORY_COLUMNS, "HIST_CREATE_DTM", *a_tail],
        (SYSTEM_B, "N/A", B_GROUP): [*B_GROUP_COLUMNS, *b_tail],
        (SYSTEM_B, "N/A", B_HISTORY): [*B_HISTORY_COLUMNS, *b_tail],
    }
    for schema in ("test", "cdc", "dbo"):
        found[(SYSTEM_A, schema, A_GROUP)] = [*A_GROUP_COLUMNS, *a_tail]
    for schema in ("test", "cdc"):
        found[(SYSTEM_A, schema, A_HISTORY)] = [*A_HISTORY_COLUMNS, *a_tail]
    for schema in ("test", "dbo"):
        found[(SYSTEM_A, schema, A_COUNT)] = [*A_COUNT_COLUMNS, *a_tail]
    return found


CONTRACTS = _contracts()

# fixed values: source to entity column names
A_GROUP_NAMES = {
    "GRGR_ID": "Group_Id",
    "GRGR_NAME": "Group_Name",
    "GRGR_MCTR_TYPE": "Group_Type_Code",
    "GRGR_ITS_CODE": "ITS_Code",
}
A_HISTORY_NAMES = {
    "GRGR_ID": "Group_Id",
    "GRGR_STS": "Status_Code",
    "GRGR_ADDR1": "Address_Line_1",
    "GRGR_ADDR2": "Address_Line_2",
    "GRGR_ADDR3": "Address_Line_3",
    "GRGR_CITY": "Address_City",
    "GRGR_STATE": "Address_State",
    "GRGR_COUNTY": "Address_County",
    "GRGR_ZIP": "Zip_Code",
    "GRGR_CTRY_CD": "Country",
    "GRGR_EMAIL": "Email",
    "GRGR_PHONE": "Phone_Nbr",
    "GRGR_PHONE_EXT": "Phone_Ext",
    "GRGR_FAX": "Fax_Nbr",
    "GRGR_FAX_EXT": "Fax_Ext",
    "GRGR_MCTR_TRSN": "Term_Reason_Code",
    "CICI_ID": "Client_Code",
    "GRGR_EIN": "EIN",
}
A_COUNT_NAMES = {
    "GRGC_MCTR_CTYP": "Count_Type",
    "GRGC_EFF_DT": "Row_Effective_Date",
    "GRGC_TERM_DT": "Row_Term_Date",
    "GRGC_COUNT": "Employee_Count",
}
B_HISTORY_NAMES = {
    "Group_Address_Line_1": "Address_Line_1",
    "Group_Address_Line_2": "Address_Line_2",
    "Group_Address_Line_3": "Address_Line_3",
    "Group_Address_City": "Address_City",
    "Group_Address_State": "Address_State",
    "Group_Address_Zip_Code": "Zip_Code",
    "Group_Address_Country": "Country",
    "Group_Email": "Email",
    "Group_Phone_Number": "Phone_Nbr",
    "Group_Phone_Ext": "Phone_Ext",
    "Group_Fax_Number": "Fax_Nbr",
    "Group_Fax_Ext": "Fax_Ext",
    "Group_EIN": "EIN",
}
HELPERS = ["loadtimestamp", "source", "source_schema", "is_valid", "action_details"]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _common(system: str, key: Column, operation: str, delete: str) -> dict[str, Column]:
    return {
        "Group_Source_Key": key,
        "Source_System_Code": F.lit(system),
        "Row_Change_Datetime": F.col("business_date").cast("timestamp"),
        "Row_Is_Deleted_Ind": deleted_flag(F.col(f"`{operation}`"), delete),
    }


def mappings() -> dict[tuple[str, str], EntityMapping]:
    """Built on call: column expressions need a running session."""
    a = _common(SYSTEM_A, _text("GRGR_CK"), A_OPERATION, "1")
    b = _common(SYSTEM_B, _text("Group_ID"), "Operation_Code", "D")
    a_gone = [*HELPERS, A_OPERATION, "GRGR_CK"]
    b_gone = [*HELPERS, "Operation_Code", "Group_ID"]
    return {
        (SYSTEM_A, GROUP): EntityMapping(
            rename=A_GROUP_NAMES,
            derive={
                **a,
                "Original_Effective_Date": F.col("GRGR_ORIG_EFF_DT").cast("date"),
                "Group_Facets_Conversion_Date": F.col("GRGR_CONV_DT").cast("date"),
            },
            drop=[*a_gone, "GRGR_ORIG_EFF_DT", "GRGR_CONV_DT"],
        ),
        (SYSTEM_A, HISTORY): EntityMapping(
            rename=A_HISTORY_NAMES,
            derive={
                **a,
                "Termination_Date": F.col("GRGR_TERM_DT").cast("date"),
                "Reinstatement_Date": F.col("GRGR_RNST_DT").cast("date"),
                "Renewal_MMDD": _text("GRGR_RENEW_MMDD"),
                "ERISA_Plan_Begin_MMDD": _text("GRGR_ERIS_MMDD"),
            },
            drop=[
                *a_gone, "GRGR_TERM_DT", "GRGR_RNST_DT", "GRGR_RENEW_MMDD", "GRGR_ERIS_MMDD",
                "HIST_CREATE_DTM",
            ],
        ),
        (SYSTEM_A, COUNT): EntityMapping(rename=A_COUNT_NAMES, derive=a, drop=a_gone),
        (SYSTEM_B, GROUP): EntityMapping(
            derive={
                **b,
                "Group_Id": _text("Group_ID"),
                "ITS_Code": F.lit(""),
                "Original_Effective_Date": mixed_date(F.col("Group_Original_Effective_Date")),
                "Group_Facets_Conversion_Date": open_end(),
            },
            drop=[*b_gone, "Group_Original_Effective_Date"],
        ),
        (SYSTEM_B, HISTORY): EntityMapping(
            rename=B_HISTORY_NAMES,
            derive={
                **b,
                "Group_Id": _text("Group_ID"),
                "Status_Code": F.lit(""),
                "Address_County": F.lit(""),
                "Termination_Date": term_date(F.col("Group_Termination_Date")),
                "Term_Reason_Code": F.lit(""),
                "Reinstatement_Date": open_end(),
                "Renewal_MMDD": _text("Group_Renewal_Month"),
                "ERISA_Plan_Begin_MMDD": F.lit("0000"),
                "Client_Code": F.lit(""),
            },
            drop=[*b_gone, "Group_Termination_Date", "Group_Renewal_Month"],
        ),
    }


# fixed values: quality rules (system, target, column, action, constraint, made for tests)
QUALITY_RULES = [
    (SYSTEM_B, HISTORY, "Group_Address_Line_1", "WARN", "Group_Address_Line_1 is null", False),
    (SYSTEM_B, HISTORY, "Group_Address_Line_2", "WARN", "Group_Address_Line_2 is null", False),
    (SYSTEM_A, GROUP, "GRGR_ID", "FAIL", "GRGR_ID is null", False),
    (SYSTEM_A, HISTORY, "GRGR_CK", "FAIL", "GRGR_CK is null", False),
    (SYSTEM_A, COUNT, "GRGR_CK", "FAIL", "GRGR_CK is null", False),
    (SYSTEM_A, COUNT, "GRGC_COUNT", "QUARANTINE", "GRGC_COUNT = 0", False),
    (SYSTEM_A, GROUP, "GRGR_CK", "FAIL", "GRGR_CK is null", False),
    (SYSTEM_A, GROUP, "GRGR_MCTR_TYPE", "WARN", "trim(GRGR_MCTR_TYPE)='UNK' ", True),
    (SYSTEM_A, GROUP, "GRGR_NAME", "WARN", "trim(GRGR_NAME)='Unknown'", True),
    (SYSTEM_A, GROUP, "GRGR_ID", "QUARANTINE", "trim(GRGR_ID)='XXXXX'", True),
    (SYSTEM_A, GROUP, "GRGR_NAME", "QUARANTINE", "trim(GRGR_NAME)='XXXXX'", True),
    (SYSTEM_A, HISTORY, "CICI_ID", "WARN", "trim(CICI_ID)='UNK'", True),
    (SYSTEM_A, HISTORY, "GRGR_STS", "WARN", "trim(GRGR_STS)='XX' and trim(GRGR_STS)<>' '", True),
    (SYSTEM_A, HISTORY, "GRGR_ID", "QUARANTINE", "trim(GRGR_ID)='XXXXX'", True),
    (
        SYSTEM_A, HISTORY, "GRGR_CTRY_CD", "QUARANTINE",
        "trim(GRGR_CTRY_CD)='UK' and trim(GRGR_CTRY_CD)<>' '", True,
    ),
    (SYSTEM_A, COUNT, "GRGC_MCTR_CTYP", "WARN", "trim(GRGC_MCTR_CTYP)='UNK'", True),
    (SYSTEM_A, HISTORY, "GRGR_ID", "FAIL", "GRGR_ID is null", False),
]

# fixed values: columns that are trimmed, per system and target
TRIMMED = {
    (SYSTEM_A, GROUP): ["GRGR_CK", "GRGR_ID", "GRGR_NAME"],
    (SYSTEM_A, HISTORY): ["GRGR_ID"],
    (SYSTEM_A, COUNT): ["GRGC_MCTR_CTYP"],
    (SYSTEM_B, GROUP): ["Group_Original_Effective_Date", "Group_Type_Code"],
    (SYSTEM_B, HISTORY): [
        "Group_Address_State", "Group_Address_Country", "Group_Address_City",
        "Group_Address_Zip_Code", "Group_Address_Line_1", "Group_Address_Line_2",
        "Group_Address_Line_3", "Group_Renewal_Month", "Group_Fax_Number", "Group_Fax_Ext",
        "Group_EIN", "Group_Phone_Number", "Group_Phone_Ext", "Group_Email",
    ],
}

#: versions and counts whose timelines one task of the gold build takes
ROWS_OF_A_TASK = 1 << 17

INCREMENTAL = "incremental_run,apply_correction,apply_test"


def source_config(spark: SparkSession, root: str) -> DataFrame:
    """Where each system delivers each input, for history and for dated runs."""
    a_both = (f"{A_GROUP},{A_HISTORY}", f"{GROUP},{HISTORY}", GROUP)
    a_count = (A_COUNT, COUNT, COUNT)
    b_both = (f"{B_GROUP},{B_HISTORY}", f"{GROUP},{HISTORY}", GROUP)
    dated = "BusinessStartDate={}"
    rows = [
        (SYSTEM_A, "dbo", f"{root}/A/History/{A_COUNT}", *a_count, "historical_run", "parquet", None, "N"),
        (SYSTEM_A, "test", f"{root}/A/Test/History/{A_COUNT}", *a_count, "historical_run", "parquet", None, "Y"),
        (SYSTEM_A, "dbo", f"{root}/A/History/{A_GROUP}", A_GROUP, GROUP, GROUP, "historical_run", "parquet", None, "N"),
        (SYSTEM_A, "audit", f"{root}/A/History/{A_HISTORY}", A_HISTORY, HISTORY, HISTORY, "historical_run", "parquet", "HIST_CREATE_DTM", "N"),
        (SYSTEM_A, "test", f"{root}/A/Test/History/{A_GROUP}", *a_both, "historical_run", "parquet", "transaction_dtm", "Y"),
        (SYSTEM_B, "N/A", f"{root}/B/History/Group", *b_both, "historical_run", "csv", None, "Y"),
        (SYSTEM_A, "dbo", f"{root}/A/{dated}/{A_COUNT}", *a_count, INCREMENTAL, "parquet", None, "N"),
        (SYSTEM_A, "test", f"{root}/A/Test/{dated}/{A_COUNT}", *a_count, INCREMENTAL, "parquet", None, "Y"),
        (SYSTEM_B, "N/A", f"{root}/B/{dated}/Group", *b_both, INCREMENTAL, "csv", None, "N"),
        (SYSTEM_A, "cdc", f"{root}/A/{dated}/{A_GROUP}", *a_both, INCREMENTAL, "parquet", None, "N"),
        (SYSTEM_A, "test", f"{root}/A/Test/{dated}/{A_GROUP}", *a_both, INCREMENTAL, "parquet", None, "Y"),
    ]
    full = [
        (DIMENSION, system, schema, "FILES", "", path, inputs, targets, target, scenario, "daily",
         kind, dated_by, test, "Y", None, None, None)
        for system, schema, path, inputs, targets, target, scenario, kind, dated_by, test in rows
    ]
    return spark.createDataFrame(full, SOURCE_CONFIG)


def cdc_config(spark: SparkSession) -> DataFrame:
    keys = "Group_Source_Key,Source_System_Code"
    count_keys = "Group_Source_Key,Count_Type,Source_System_Code,Row_Effective_Date"
    rows = [
        (DIMENSION, GROUP, keys, "business_date", None, "N", "1", None, None),
        (DIMENSION, HISTORY, keys, "business_date", None, "N", "2", None, None),
        (DIMENSION, COUNT, count_keys, "business_date", None, "Y", "1", None, None),
    ]
    return spark.createDataFrame(rows, CDC_CONFIG)


def dq_config(spark: SparkSession) -> DataFrame:
    rows = [
        (DIMENSION, system, target, column, action, rule, "Y", None, mocked, None, None)
        for system, target, column, action, rule, mocked in QUALITY_RULES
    ]
    return spark.createDataFrame(rows, DQ_CONFIG)


def transform_config(spark: SparkSession) -> DataFrame:
    """Trims first, then the proper-case name and the system code constants."""
    rules = [(s, t, c, "trim", "trim") for (s, t), columns in TRIMMED.items() for c in columns]
    rules.append((SYSTEM_A, GROUP, "GRGR_NAME", "title case", "initcap"))
    for target in (GROUP, HISTORY, COUNT):
        rules.append((SYSTEM_A, target, "Source_System_Code", "default", SYSTEM_A))
    rows = [(DIMENSION, *rule, "Y", None, None, None) for rule in rules]
    return spark.createDataFrame(rows, TRANSFORM_CONFIG)


# source columns that identify a row of a snapshot delivered without operation codes
SNAPSHOT_KEYS = {A_COUNT: ["GRGR_CK", "GRGC_MCTR_CTYP", "GRGC_EFF_DT"]}

GROUP_ATTRIBUTES = (
    "Group_Id Group_Name Group_Type_Code ITS_Code Original_Effective_Date "
    "Group_Facets_Conversion_Date"
).split()
HISTORY_ATTRIBUTES = (
    "Status_Code Address_Line_1 Address_Line_2 Address_Line_3 Address_City Address_State "
    "Address_County Zip_Code Country Email Phone_Nbr Phone_Ext Fax_Nbr Fax_Ext Termination_Date "
    "Term_Reason_Code Reinstatement_Date Renewal_MMDD ERISA_Plan_Begin_MMDD Client_Code EIN"
).split()
COUNT_ATTRIBUTES = ["Employee_Count", "Count_Type"]


def gold(
    group: DataFrame,
    history: DataFrame,
    count: DataFrame,
    mode: str = "state",
    county_as_country: bool = False,
    require_counts: bool = True,
    by_system: bool = True,
    only: DataFrame | None = None,
    with_deleted: bool = True,
    size: int | None = None,
) -> DataFrame:
    """Closed-day timeline of every group: entity, history and employee counts combined.

    Every source system has its own timeline of a key. Without ``by_system`` sources are
    matched by key alone and the published system code is that of the first system.
    ``only`` lists the Group_Source_Key values to build (all without it), ``with_deleted``
    lets deleted rows take part. ``county_as_country`` publishes the county as the
    country. Count types are parallel timelines of one group. Without ``require_counts``
    slices without an employee count stay, as for a source that sends none. With ``size``,
    the number of versions and counts together, the wide rows of a timeline are dealt out
    to as many tasks as that needs, so that a task holds no more of a larger table; else
    the session's number of partitions decides.
    """
    parts = size // ROWS_OF_A_TASK + 1 if size else None
    if parts and parts <= group.sparkSession.sparkContext.defaultParallelism:
        parts = None
    key = ["Group_Source_Key", "Source_System_Code"] if by_system else ["Group_Source_Key"]

    def chosen(df: DataFrame) -> DataFrame:
        if only is not None:
            df = df.join(only.select("Group_Source_Key").distinct(), "Group_Source_Key", "left_semi")
        if not with_deleted:
            df = df.filter(~F.col("Row_Is_Deleted_Ind").eqNullSafe(F.lit("Y")))
        return df

    group, history, count = map(chosen, (group, history, count))
    hist = Intervals(history, key, "Row_Effective_Date", "Row_Term_Date")
    counts = Intervals(count, key, "Row_Effective_Date", "Row_Term_Date", "Employee_Count <> 0")
    rows = slices([counts, hist], parts=parts).join(group.select(*key, *GROUP_ATTRIBUTES), key)
    if require_counts:
        rows = align(rows, [(hist, HISTORY_ATTRIBUTES), (counts, COUNT_ATTRIBUTES)], unique=True, parts=parts)
    else:
        rows = align(rows, [(hist, HISTORY_ATTRIBUTES)], unique=True, parts=parts)
        rows = align(rows, [(counts, COUNT_ATTRIBUTES)], unique=True, outer=True)
    country = F.col("Address_County") if county_as_country else F.col("Country")
    rows = rows.withColumns(
        {
            "Source_System_Code": F.col("Source_System_Code") if by_system else F.lit(SYSTEM_A),
            "Country": country,
            "Count_as_of_Year": F.year("slice_start"),
            "Count_Type": label(F.col("Count_Type"), COUNT_TYPES),
        }
    )
    attributes = [
        "Source_System_Code", *GROUP_ATTRIBUTES, *HISTORY_ATTRIBUTES, "Employee_Count",
        "Count_as_of_Year",
    ]
    attributes = [a for a in attributes if a not in key]
    line = [*key, "Count_Type"]
    if mode == "state":
        # islands and trimming both work within a timeline: move the wide rows once
        together = rows.repartition(*line) if parts is None else dealt(rows, line, parts)
        merged = islands(together, line, attributes, "slice_start", "slice_end")
    else:
        distinct = rows.distinct()
        merged = islands(distinct, key, [*attributes, "Count_Type"], "slice_start", "slice_end", mode)
    closed = trim(merged, key, "slice_start", "slice_end", parallel=["Count_Type"])
    renamed = {"slice_start": "Row_Effective_Date", "slice_end": "Row_Term_Date"}
    first = ["Group_Source_Key", "Source_System_Code", "Row_Effective_Date", "Row_Term_Date"]
    rest = [a for a in attributes if a not in first]
    # islands without systems put the code among the attributes, else it is part of the key
    return closed.withColumnsRenamed(renamed).select(*first, *rest, "Count_Type")
