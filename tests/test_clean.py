from pyspark.sql import functions as F

from dialstat.operators import clean as C
from dialstat.params import Params


def one_col(spark, values, dtype, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_age_range_and_segments(spark):
    ages = [None, 17, 18, 25, 26, 65, 66, 100, 101]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ages)], "i long, age long")
    cleaned = [r.age for r in df.select("i", C.age_expr(Params()).alias("age")).orderBy("i").collect()]
    assert cleaned == [None, None, 18, 25, 26, 65, 66, 100, None]
    seg = one_col(spark, cleaned, "long", C.age_segment)
    assert seg == ["unknown", "unknown", "18-25", "18-25", "26-35", "56-65", "65+", "65+", "unknown"]


def test_balance_segments_with_integer_gaps(spark):
    vals = [-1.0, 0.0, 1.0, 500.0, 501.0, 2000.0, 2001.0, 10000.0, 10001.0, 0.5, 500.5, None]
    got = one_col(spark, vals, "double", C.balance_segment)
    assert got == ["negative", "zero", "low (1-500)", "low (1-500)", "medium (501-2k)", "medium (501-2k)",
                   "high (2k-10k)", "high (2k-10k)", "very_high (10k+)", "unknown", "unknown", "unknown"]


def test_duration_segments(spark):
    vals = [None, 0, 59, 60, 180, 181, 300, 301, 600, 601]
    got = one_col(spark, vals, "long", C.duration_segment)
    assert got == ["unknown", "no_contact", "very_short (<1min)", "short (1-3min)", "short (1-3min)",
                   "medium (3-5min)", "medium (3-5min)", "long (5-10min)", "long (5-10min)", "very_long (10min+)"]


def test_campaign_intensity(spark):
    got = one_col(spark, [None, 1, 2, 3, 4, 6, 7], "long", C.campaign_intensity)
    assert got == ["unknown", "single_contact", "low (2-3)", "low (2-3)", "medium (4-6)", "medium (4-6)", "high (7+)"]


def test_month_lookup_and_quarter(spark):
    df = spark.createDataFrame([(" MAY ",), ("",), ("unknown",), (None,), ("dec",)], "m string")
    out = df.select(C.norm_text("m").alias("contact_month")).select(
        "contact_month", C.month_number().alias("n"), C.month_quarter().alias("q")).collect()
    assert [tuple(r) for r in out] == [("may", 5, "Q2"), ("", None, None), ("unknown", None, None),
                                      (None, None, None), ("dec", 12, "Q4")]


RAW_COLS = ("_row_id long, age long, job string, marital string, education string, `default` string, "
            "balance long, housing string, loan string, contact string, day_of_week long, month string, "
            "duration long, campaign long, pdays long, previous long, poutcome string, y string, "
            "_dbt_loaded_at timestamp")


def raw_row(**kw):
    base = dict(_row_id=1, age=30, job="admin", marital="single", education="primary", default="no", balance=10,
                housing="no", loan="no", contact="cellular", day_of_week=5, month="may", duration=100, campaign=1,
                pdays=-1, previous=0, poutcome="unknown", y="no", _dbt_loaded_at=None)
    base.update(kw)
    return tuple(base[k] for k in ["_row_id", "age", "job", "marital", "education", "default", "balance", "housing",
                                   "loan", "contact", "day_of_week", "month", "duration", "campaign", "pdays",
                                   "previous", "poutcome", "y", "_dbt_loaded_at"])


def clean_rows(spark, rows):
    return {r["row_id"]: r for r in C.contacts_clean(spark.createDataFrame(rows, RAW_COLS), Params()).collect()}


def test_row_rules(spark):
    rows = [
        raw_row(_row_id=1, job="\tAdmin ", marital="UNKNOWN", education=" other", default="YES", balance=-10001,
                day_of_week=0, pdays=29, previous=-1, contact="Telephone", poutcome=" SUCCESS"),
        raw_row(_row_id=2, job="", marital=" x ", default=None, balance=100001, day_of_week=32, pdays=30,
                duration=-1, previous=2),
        raw_row(_row_id=3, pdays=-2, day_of_week=31, duration=0, month="", housing="yes"),
        raw_row(_row_id=4, pdays=0, day_of_week=1, month="unknown"),
        raw_row(_row_id=5, month=None),          # dropped: month NULL
        raw_row(_row_id=6, y="maybe"),          # dropped: target NULL after cleaning
        raw_row(_row_id=7, age=17),             # dropped: age NULL after cleaning
        raw_row(_row_id=8, campaign=0),         # dropped: campaign NULL after cleaning
    ]
    got = clean_rows(spark, rows)
    assert sorted(got) == [1, 2, 3, 4]
    r1, r2, r3, r4 = got[1], got[2], got[3], got[4]
    assert (r1.job, r1.marital_status, r1.education_level) == ("admin", None, None)
    assert (r1.has_credit_default, r1.account_balance_eur, r1.balance_segment) == (True, -10000, "negative")
    assert (r1.contact_day, r1.days_since_last_contact, r1.recently_contacted) == (None, 29, True)
    assert (r1.num_contacts_previous, r1.was_contacted_before) == (None, False)
    assert (r1.contact_type, r1.previous_campaign_outcome, r1.previous_campaign_success) == ("telephone", "success", True)
    assert r1.has_debt_indicators is True
    assert (r2.job, r2.marital_status, r2.has_credit_default) == (None, "x", None)
    assert (r2.account_balance_eur, r2.contact_day, r2.recently_contacted) == (100000, None, False)
    assert (r2.contact_duration_sec, r2.call_duration_segment, r2.contact_duration_min) == (None, "unknown", None)
    assert r2.has_debt_indicators is False and r2.was_contacted_before is True
    assert (r3.days_since_last_contact, r3.contact_day, r3.call_duration_segment) == (None, 31, "no_contact")
    assert (r3.contact_month, r3.contact_month_num, r3.contact_quarter) == ("", None, None)
    assert r3.has_any_loan is True
    assert (r4.days_since_last_contact, r4.recently_contacted, r4.contact_month_num) == (0, True, None)


def test_flags_null_to_false(spark):
    raw = [raw_row(_row_id=1, default=None, balance=None, housing=None, loan=None, pdays=-1, previous=None, poutcome=None),
           raw_row(_row_id=2, default="yes", balance=None, housing="yes", pdays=29, previous=1, poutcome="success"),
           raw_row(_row_id=3, default=None, balance=-1, loan="yes", pdays=30, previous=0, poutcome="failure"),
           raw_row(_row_id=4, default="no", balance=0, pdays=0)]
    out = C.contacts_clean(spark.createDataFrame(raw, RAW_COLS)).orderBy("row_id").collect()
    flags = lambda r: (r.has_debt_indicators, r.has_any_loan, r.was_contacted_before, r.recently_contacted, r.previous_campaign_success)
    assert [flags(r) for r in out] == [(False, False, False, False, False), (True, True, True, True, True),
                                       (True, True, False, False, False), (False, False, False, True, False)]


def test_duration_minutes(spark):
    assert one_col(spark, [90, 61, None], "long", C.duration_minutes) == [1.5, 1.02, None]


def test_clean_schema_is_32_columns(clean_small):
    assert len(clean_small.columns) == 32
    assert clean_small.schema["contact_duration_min"].dataType.typeName() == "double"
    assert clean_small.schema["contact_month_num"].dataType.typeName() == "integer"
