import datetime as dt

from dialstat.operators import quality as Q
from dialstat.operators.reports import column_domain


def kpi_rows(spark, rows):
    cols = ("kpi_row_id long, age_segment string, job string, contact_month string, total_contacts long, "
            "successful_contacts long, unsuccessful_contacts long, conversion_rate_pct double, "
            "avg_call_duration_min double, avg_contacts_per_client double")
    return spark.createDataFrame(rows, cols)


def test_null_id_fails_not_null_and_passes_unique(spark):
    df = spark.createDataFrame([(1,), (None,)], "id long")
    assert Q.failing_rows(df, Q.Check("nn", "t", "not_null", ("id",))).count() == 1
    assert Q.failing_rows(df, Q.Check("u", "t", "unique", ("id",))).count() == 0


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "row_id long")
    rows = Q.failing_rows(df, Q.Check("d", "t", "duplicates", ("row_id",))).collect()
    assert [(r.row_id, r.occurrences) for r in rows] == [(1, 2)]


def test_singular_checks_catch_broken_rows(spark):
    df = kpi_rows(spark, [
        (1, "a", "j", "may", 5, 2, 2, 40.0, 1.0, 1.0),     # broken total
        (2, "a", "j", "may", 4, 1, 3, 25.02, 1.0, 1.0),    # rate off by 0.02
        (3, "a", "j", "may", 4, 1, 3, 25.005, 1.0, 1.0),   # off by 0.005: passes
        (4, "a", "j", "may", 4, 1, 3, 25.0, -1.0, 1.0),    # negative metric
        (5, "a", "j", "may", 4, 1, 3, 25.0, None, 1.0),    # NULL metric: passes
    ])
    get = lambda kind: sorted(r.kpi_row_id for r in Q.failing_rows(df, Q.Check(kind, "k", kind)).collect())
    assert get("total_sum") == [1]
    assert get("rate_logic") == [2]  # row 1: 2/5 = 40.0 is consistent
    assert get("no_negative") == [4]


def test_accepted_values_and_ranges_let_null_pass(spark):
    df = spark.createDataFrame([("yes", 17), ("no", 18), (None, None), ("maybe", 101)], "y string, age long")
    av = Q.failing_rows(df, Q.Check("av", "t", "accepted_values", ("y",), values=("yes", "no"))).collect()
    assert [(r.value_field, r.n_records) for r in av] == [("maybe", 1)]
    rng = Q.failing_rows(df, Q.Check("r", "t", "accepted_range", ("age",), min_value=18, max_value=100))
    assert sorted(r.age for r in rng.collect()) == [17, 101]


def test_summary_one_pass_and_status(spark):
    df = spark.createDataFrame([(1, 17), (None, 20), (3, 30), (3, 40)], "id long, age long")
    checks = [Q.Check("nn", "t", "not_null", ("id",)), Q.Check("rng", "t", "between", ("age",), min_value=18),
              Q.Check("u", "t", "unique", ("id",), severity="warn"), Q.Check("ok", "t", "not_null", ("age",))]
    got = {r.check_name: (r.failures, r.status) for r in Q.summarize({"t": df}, checks).collect()}
    assert got == {"nn": (1, "fail"), "rng": (1, "fail"), "u": (1, "warn"), "ok": (0, "pass")}


def test_freshness_thresholds(spark):
    as_of = dt.datetime(2024, 1, 3, 0, 0, 0)
    for hours, status in ((23, "pass"), (25, "warn"), (49, "error")):
        loaded = as_of - dt.timedelta(hours=hours)
        df = spark.createDataFrame([(loaded,)], "_dbt_loaded_at timestamp")
        assert Q.source_freshness(df, as_of).first().status == status


def test_published_suite_has_27_checks():
    checks = Q.published_checks()
    assert len(checks) == 27 and len({c.name for c in checks}) == 27


def test_column_domain_is_sorted_and_whole(clean_small):
    months = [r.value for r in column_domain(clean_small, "contact_month").collect()]
    assert months == sorted(months) and len(months) == 12


def test_stored_failures_of_grouped_checks_equal_the_checks_one_by_one(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,), (None,)], "row_id long")
    checks = [Q.Check("u", "r", "unique", ("row_id",)), Q.Check("uc", "r", "unique_combo", ("row_id",)),
              Q.Check("d", "r", "duplicates", ("row_id",))]
    got = sorted(Q.failures_long({"r": df}, checks, {"r": "row_id"}).collect(), key=str)
    assert sorted(((r.check_name, r.row_key) for r in got), key=str) == sorted(
        [("u", "1"), ("uc", "1"), ("uc", "_null_"), ("d", "1"), ("d", None)], key=str)
    assert {r.check_name: r.failures for r in Q.summarize({"r": df}, checks).collect()} == {"u": 1, "uc": 2, "d": 2}
