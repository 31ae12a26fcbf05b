"""DuckDB SQL equivalents of the catalog queries (the correctness oracle).

Written apart from the Spark code, over the same driver tables: medians by sorted lists, ranks by counting in
one global order, segments and reports summed over the contacts. Typing
rules kept on purpose: double literals (``::DOUBLE``) where the published
dialect uses FLOAT64, ``NULLIF`` for safe division, ``CAST(SUM(..) AS BIGINT)``
for integer sums, the lower median (an input element), explicit
NULL ordering, and the group surrogate key as the tie-break of every rank.
"""

from __future__ import annotations

from dialstat.sources.faults import CLEAN_FAULTS, MART_FAULTS, RAW_FAULTS, TEXT_FAULTS

# The run's timestamp and the grain of the mart.
RUN_TS = "2024-01-01 00:00:00"
DIMENSIONS = [
    "age_segment", "job", "marital_status", "education_level", "balance_segment", "contact_type",
    "contact_month", "contact_month_num", "contact_quarter", "call_duration_segment", "campaign_intensity",
    "previous_campaign_outcome", "has_any_loan", "has_debt_indicators", "was_contacted_before"]
DIMS = ", ".join(DIMENSIONS)
SK_SQL = "md5(" + " || '|' || ".join(f"coalesce(CAST({d} AS VARCHAR), '_null_')" for d in DIMENSIONS) + ")"


def _norm(c: str) -> str:
    return f"lower(trim({c}))"


# Fixed values: (least, greatest, label) of each segment of whole numbers; None is open.
AGE_BANDS = [(18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, 65, "56-65"), (66, None, "65+")]
BALANCE_BANDS = [(None, -1, "negative"), (0, 0, "zero"), (1, 500, "low (1-500)"), (501, 2000, "medium (501-2k)"),
                 (2001, 10000, "high (2k-10k)"), (10001, None, "very_high (10k+)")]
DURATION_BANDS = [(0, 0, "no_contact"), (1, 59, "very_short (<1min)"), (60, 180, "short (1-3min)"),
                  (181, 300, "medium (3-5min)"), (301, 600, "long (5-10min)"), (601, None, "very_long (10min+)")]
CAMPAIGN_BANDS = [(1, 1, "single_contact"), (2, 3, "low (2-3)"), (4, 6, "medium (4-6)"), (7, None, "high (7+)")]


def _band(col: str, bands: list) -> str:
    """The label of the band that holds the value, looked up in a list of structs; 'unknown' outside."""
    low, high = -(2**62), 2**62
    table = ", ".join(f"{{'lo': {low if a is None else a}, 'hi': {high if b is None else b}, 'label': '{name}'}}"
                      for a, b, name in bands)
    return f"coalesce(list_filter([{table}], lambda b: {col} BETWEEN b.lo AND b.hi)[1].label, 'unknown')"


RAW_CTE = f"""
li_agg AS (
  SELECT l_orderkey, COUNT(*) AS li_n,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS li_r,
         SUM(l_quantity) AS li_qty
  FROM lineitem GROUP BY l_orderkey
),
order_hist AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         ROW_NUMBER() OVER w - 1 AS prev_count,
         LAG(o_orderdate) OVER w AS prev_dt,
         LAG(o_orderstatus) OVER w AS prev_st
  FROM orders
  WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
),
contacts_raw AS (
  SELECT CAST(h.o_orderkey AS BIGINT) AS _row_id,
    CAST(15 + (h.o_custkey * 37) % 90 AS BIGINT) AS age,
    CASE WHEN h.o_custkey % 13 = 0 THEN 'unknown' WHEN h.o_custkey % 17 = 0 THEN ''
         ELSE ' ' || c.c_mktsegment || ' ' END AS job,
    ['Married', 'single ', 'divorced', 'married', 'unknown'][CAST(h.o_custkey % 5 AS INTEGER) + 1] AS marital,
    ['Primary', ' secondary', 'tertiary', 'unknown', 'other'][CAST(c.c_nationkey % 5 AS INTEGER) + 1] AS education,
    CASE WHEN h.o_custkey % 51 = 0 THEN NULL WHEN h.o_custkey % 50 = 0 THEN 'yes' ELSE 'no' END AS "default",
    CAST(floor(c.c_acctbal * 12) AS BIGINT) AS balance,
    CASE WHEN h.o_custkey % 3 = 0 THEN 'yes' ELSE 'no' END AS housing,
    CASE WHEN h.o_orderpriority = '1-URGENT' THEN 'YES' ELSE 'no' END AS loan,
    CASE WHEN h.o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown'
         WHEN starts_with(h.o_orderpriority, '1-') OR starts_with(h.o_orderpriority, '2-') THEN 'cellular'
         ELSE 'Telephone' END AS contact,
    CAST(day(h.o_orderdate) AS BIGINT) AS day_of_week,
    ['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'][month(h.o_orderdate)] AS month,
    CAST(floor(li.li_qty * 3) AS BIGINT) AS duration,
    CAST(coalesce(li.li_n, 0) AS BIGINT) AS campaign,
    CAST(CASE WHEN h.prev_dt IS NULL THEN -1
              ELSE date_diff('day', CAST(h.prev_dt AS DATE), CAST(h.o_orderdate AS DATE)) END AS BIGINT) AS pdays,
    CAST(h.prev_count AS BIGINT) AS previous,
    CASE h.prev_st WHEN 'F' THEN 'success' WHEN 'O' THEN 'failure' WHEN 'P' THEN 'other' ELSE 'unknown' END AS poutcome,
    CASE WHEN li.li_n IS NULL THEN NULL WHEN 3 * li.li_r >= 2 * li.li_n THEN 'yes' ELSE 'no' END AS y,
    CAST(h.o_orderdate AS TIMESTAMP) AS _dbt_loaded_at
  FROM order_hist h
  JOIN customer c ON c.c_custkey = h.o_custkey
  LEFT JOIN li_agg li ON li.l_orderkey = h.o_orderkey
)"""

# Cleaned columns over the raw names (before derivations and the row filter).
CLEANED_CTE = f"""
cleaned AS (
  SELECT _row_id AS row_id, _dbt_loaded_at AS loaded_at,
    CASE WHEN age < 18 OR age > 100 THEN NULL ELSE age END AS age,
    CASE WHEN {_norm('job')} IN ('unknown', '') THEN NULL ELSE {_norm('job')} END AS job,
    CASE WHEN {_norm('marital')} IN ('unknown', '') THEN NULL ELSE {_norm('marital')} END AS marital_status,
    CASE WHEN {_norm('education')} IN ('primary', 'secondary', 'tertiary') THEN {_norm('education')} END AS education_level,
    CASE {_norm('"default"')} WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS has_credit_default,
    CASE WHEN balance < -10000 THEN -10000 WHEN balance > 100000 THEN 100000 ELSE balance END AS account_balance_eur,
    CASE {_norm('housing')} WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS has_housing_loan,
    CASE {_norm('loan')} WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS has_personal_loan,
    CASE WHEN {_norm('contact')} IN ('cellular', 'telephone') THEN {_norm('contact')} END AS contact_type,
    CASE WHEN day_of_week BETWEEN 1 AND 31 THEN day_of_week END AS contact_day,
    {_norm('month')} AS contact_month,
    CASE WHEN duration >= 0 THEN duration END AS contact_duration_sec,
    CASE WHEN campaign >= 1 THEN campaign END AS num_contacts_campaign,
    CASE WHEN pdays >= 0 THEN pdays END AS days_since_last_contact,
    CASE WHEN previous >= 0 THEN previous END AS num_contacts_previous,
    CASE WHEN {_norm('poutcome')} IN ('success', 'failure', 'other') THEN {_norm('poutcome')} END AS previous_campaign_outcome,
    CASE {_norm('y')} WHEN 'yes' THEN TRUE WHEN 'no' THEN FALSE END AS subscribed
  FROM contacts_raw
),
derived AS (
  SELECT *,
    {_band('age', AGE_BANDS)} AS age_segment,
    {_band('account_balance_eur', BALANCE_BANDS)} AS balance_segment,
    coalesce(has_credit_default = TRUE OR account_balance_eur < 0, FALSE) AS has_debt_indicators,
    coalesce(has_housing_loan = TRUE OR has_personal_loan = TRUE, FALSE) AS has_any_loan,
    round(contact_duration_sec / 60.0::DOUBLE, 2) AS contact_duration_min,
    {_band('contact_duration_sec', DURATION_BANDS)} AS call_duration_segment,
    CAST(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], contact_month)
         AS INTEGER) AS contact_month_num_raw,
    'Q' || CAST((NULLIF(contact_month_num_raw, 0) + 2) // 3 AS VARCHAR) AS contact_quarter,
    coalesce(num_contacts_previous > 0, FALSE) AS was_contacted_before,
    coalesce(days_since_last_contact IS NOT NULL AND days_since_last_contact < 30, FALSE) AS recently_contacted,
    {_band('num_contacts_campaign', CAMPAIGN_BANDS)} AS campaign_intensity,
    coalesce(previous_campaign_outcome = 'success', FALSE) AS previous_campaign_success
  FROM cleaned
),
enriched AS (
  SELECT * EXCLUDE (contact_month_num_raw),
         CASE WHEN contact_month_num_raw > 0 THEN contact_month_num_raw END AS contact_month_num
  FROM derived
),
contacts_clean AS (
  SELECT row_id, loaded_at, age, age_segment, job, marital_status, education_level, has_credit_default,
    account_balance_eur, balance_segment, has_housing_loan, has_personal_loan, has_any_loan, has_debt_indicators,
    contact_type, contact_day, contact_month, contact_month_num, contact_quarter, contact_duration_sec,
    contact_duration_min, call_duration_segment, num_contacts_campaign, campaign_intensity,
    days_since_last_contact, recently_contacted, num_contacts_previous, was_contacted_before,
    previous_campaign_outcome, previous_campaign_success, subscribed,
    TIMESTAMP '{RUN_TS}' AS dbt_updated_at
  FROM enriched
  WHERE subscribed IS NOT NULL AND age IS NOT NULL AND num_contacts_campaign >= 1 AND contact_month IS NOT NULL
)"""


def fixed_mean(col: str, decimals: int) -> str:
    scale = 10 ** decimals
    return f"SUM(CAST(round({col} * {scale}.0::DOUBLE) AS BIGINT)) / NULLIF(COUNT({col}) * {scale}.0::DOUBLE, 0)"


def _mean(col: str) -> str:
    """Mean of whole numbers: their exact sum, divided once."""
    return f"SUM({col})::DOUBLE / NULLIF(COUNT({col}), 0)"


def _middle(col: str) -> str:
    """Lower median: the middle place of the sorted values."""
    return f"list_sort(list({col}) FILTER ({col} IS NOT NULL))[(COUNT({col}) + 1) // 2]"


# Least share of conversions (SQL) and label, best first; the last label takes the rest.
TARGET_LABELS = [("0.1::DOUBLE", "above_target"), ("0.1::DOUBLE * 0.8::DOUBLE", "near_target"), (None, "below_target")]
PERFORMANCE_LABELS = [("0.2::DOUBLE", "high_performance"), ("0.1::DOUBLE", "medium_performance"),
                      ("0.05::DOUBLE", "low_performance"), (None, "very_low_performance")]


def _label(share: str, labels: list) -> str:
    """The first label whose least share is reached."""
    table = ", ".join(f"{{'least': {'-1' if a is None else a}, 'label': '{name}'}}" for a, name in labels)
    return f"list_filter([{table}], lambda b: {share} >= b.least)[1].label"


def groups_cte(name: str, dims: str, source: str = "contacts_clean") -> str:
    """Metrics, rates, bands and indices at the grain of ``dims``: one aggregate, shares, then labels."""
    return f"""
{name}_base AS (
  SELECT {dims}, COUNT(*) AS total_contacts,
    COUNT(*) FILTER (subscribed) AS successful_contacts, COUNT(*) FILTER (NOT subscribed) AS unsuccessful_contacts,
    CAST(SUM(contact_duration_sec) AS BIGINT) AS total_call_duration_sec, MAX(num_contacts_campaign) AS max_contacts_to_client,
    {_mean('contact_duration_sec')} AS avg_call_duration_sec, {fixed_mean('contact_duration_min', 2)} AS avg_call_duration_min,
    {_mean('num_contacts_campaign')} AS avg_contacts_per_client, {_mean('age')} AS avg_age,
    {_mean('account_balance_eur')} AS avg_account_balance, {_mean('days_since_last_contact')} AS avg_days_since_last_contact,
    {_middle('contact_duration_sec')} AS median_call_duration_sec, {_middle('account_balance_eur')} AS median_account_balance,
    (COUNT(*) FILTER (was_contacted_before))::DOUBLE / COUNT(*) AS pct_previously_contacted
  FROM {source} GROUP BY {dims}
),
{name}_shares AS (
  SELECT *, successful_contacts::DOUBLE / total_contacts AS won, unsuccessful_contacts::DOUBLE / total_contacts AS lost,
    NULLIF(total_call_duration_sec / 60.0::DOUBLE, 0) AS minutes
  FROM {name}_base
),
{name}_rates AS (
  SELECT * EXCLUDE (won, lost, minutes), round(won * 100.0::DOUBLE, 2) AS conversion_rate_pct,
    round(lost * 100.0::DOUBLE, 2) AS non_conversion_rate_pct,
    round(successful_contacts::DOUBLE / minutes, 4) AS conversions_per_call_minute,
    {_label('won', TARGET_LABELS)} AS performance_vs_target, {_label('won', PERFORMANCE_LABELS)} AS performance_segment
  FROM {name}_shares
),
{name} AS (
  SELECT *, round(conversion_rate_pct / NULLIF(avg_contacts_per_client, 0), 2) AS efficiency_index,
    round(conversion_rate_pct * avg_call_duration_min / 10.0::DOUBLE, 2) AS contact_quality_index
  FROM {name}_rates
)"""


# The columns of the mart, in order.
MART_COLUMNS = """kpi_row_id age_segment job marital_status education_level balance_segment has_any_loan has_debt_indicators
contact_type contact_month contact_month_num contact_quarter call_duration_segment campaign_intensity
previous_campaign_outcome was_contacted_before total_contacts successful_contacts unsuccessful_contacts
conversion_rate_pct non_conversion_rate_pct conversions_per_call_minute avg_call_duration_sec avg_call_duration_min
median_call_duration_sec total_call_duration_sec avg_contacts_per_client max_contacts_to_client avg_age
avg_account_balance median_account_balance pct_previously_contacted avg_days_since_last_contact efficiency_index
contact_quality_index conversion_rank_by_age conversion_rank_by_month conversion_percentile performance_vs_target
performance_segment is_top_performer_in_age_segment total_contacts_in_segment total_conversions_in_segment
avg_conversion_rate_in_segment best_month_for_segment share_of_contacts_in_segment_pct conversion_rate_vs_segment_avg
dbt_updated_at dbt_run_timestamp""".split()
_SEGMENT = "age_segment, job, education_level, balance_segment"

# Ranks count better groups through one global order; segments are summed over the contacts, not the groups.
MART_CTE = groups_cte("kpi_groups", DIMS) + f""",
kpi_keyed AS (SELECT *, {SK_SQL} AS group_sk FROM kpi_groups),
kpi_ordered AS (
  SELECT *, ROW_NUMBER() OVER (ORDER BY conversion_rate_pct DESC NULLS LAST, group_sk) AS kpi_row_id FROM kpi_keyed
),
kpi_below AS (
  SELECT conversion_rate_pct AS rate, SUM(COUNT(*)) OVER (ORDER BY conversion_rate_pct NULLS FIRST) - COUNT(*) AS below,
    SUM(COUNT(*)) OVER () AS n
  FROM kpi_keyed GROUP BY 1
),
kpi_ranked AS (
  SELECT o.*, COUNT(*) OVER (PARTITION BY age_segment ORDER BY kpi_row_id) AS conversion_rank_by_age,
    COUNT(*) OVER (PARTITION BY contact_month ORDER BY kpi_row_id) AS conversion_rank_by_month,
    CASE WHEN n > 1 THEN below::DOUBLE / (n - 1)::DOUBLE ELSE 0.0::DOUBLE END AS conversion_percentile
  FROM kpi_ordered o JOIN kpi_below b ON b.rate IS NOT DISTINCT FROM o.conversion_rate_pct
),
month_leaders AS (
  SELECT contact_month, min_by(struct_pack(a := age_segment, j := job, e := education_level, b := balance_segment), kpi_row_id) AS s
  FROM kpi_ordered GROUP BY contact_month
),
kpi_segments AS (
  SELECT c.*, r.avg_conversion_rate_in_segment, (SELECT MAX(contact_month) FROM month_leaders l
    WHERE l.s.a IS NOT DISTINCT FROM c.age_segment AND l.s.j IS NOT DISTINCT FROM c.job
      AND l.s.e IS NOT DISTINCT FROM c.education_level AND l.s.b IS NOT DISTINCT FROM c.balance_segment) AS best_month_for_segment
  FROM (SELECT {_SEGMENT}, COUNT(*) AS total_contacts_in_segment, COUNT(*) FILTER (subscribed) AS total_conversions_in_segment
        FROM contacts_clean GROUP BY {_SEGMENT}) c
  JOIN (SELECT {_SEGMENT}, {fixed_mean('conversion_rate_pct', 2)} AS avg_conversion_rate_in_segment
        FROM kpi_groups GROUP BY {_SEGMENT}) r
    ON c.age_segment IS NOT DISTINCT FROM r.age_segment AND c.job IS NOT DISTINCT FROM r.job
   AND c.education_level IS NOT DISTINCT FROM r.education_level AND c.balance_segment IS NOT DISTINCT FROM r.balance_segment
),
kpi_wide AS (
  SELECT * FROM kpi_ranked LEFT JOIN kpi_segments USING ({_SEGMENT})
),
campaign_kpis AS (
  SELECT {', '.join(MART_COLUMNS)}, group_sk
  FROM (SELECT *, conversion_rank_by_age = 1 AS is_top_performer_in_age_segment,
          round(total_contacts::DOUBLE / total_contacts_in_segment * 100.0::DOUBLE, 2) AS share_of_contacts_in_segment_pct,
          round(conversion_rate_pct - avg_conversion_rate_in_segment, 2) AS conversion_rate_vs_segment_avg,
          TIMESTAMP '{RUN_TS}' AS dbt_updated_at, '{RUN_TS}+00:00' AS dbt_run_timestamp
        FROM kpi_wide)
)"""

BASE = "WITH " + RAW_CTE.strip() + ",\n" + CLEANED_CTE.strip()
WITH_MART = BASE + ",\n" + MART_CTE.strip()


def _planted(faults: dict, key: str) -> str:
    """The planted faults as a REPLACE list."""
    out = []
    for col, rules in faults.items():
        cases = " ".join(f"WHEN {key} % {d} = 0 THEN {v.replace('as string', 'AS VARCHAR').replace('1.5D', '1.5::DOUBLE')}"
                         for d, v in rules)
        out.append(f"CASE {cases} ELSE {col} END AS {col}")
    return f"* REPLACE ({', '.join(out)})"


FAULTY_CLEAN = f"(SELECT {_planted(CLEAN_FAULTS, 'row_id')} FROM contacts_clean) contacts_clean"
FAULTY_MART = f"(SELECT {_planted(MART_FAULTS, 'kpi_row_id')} FROM campaign_kpis) campaign_kpis"
FAULTY_BASE = (
    "WITH " + RAW_CTE.strip().replace("contacts_raw AS (", "contacts_given AS (")
    + f",\ncontacts_raw AS (SELECT {_planted(RAW_FAULTS, '_row_id')} FROM contacts_given),\n" + CLEANED_CTE.strip())


def over_faulty(select: str) -> str:
    return FAULTY_BASE + "\n" + select


def over_raw(select: str) -> str:
    return BASE + "\n" + select


def over_mart(select: str) -> str:
    return WITH_MART + "\n" + select


def over_groups(dims: str, select: str, name: str = "g") -> str:
    return BASE + ",\n" + groups_cte(name, dims).strip() + "\n" + select


# ---------------------------------------------------------------------------
# Per-query SQL
# ---------------------------------------------------------------------------
RAW_COLS = ["_row_id", "age", "job", "marital", "education", '"default"', "balance", "housing", "loan", "contact",
            "day_of_week", "month", "duration", "campaign", "pdays", "previous", "poutcome", "y", "_dbt_loaded_at"]
NUMERIC = ["age", "balance", "day_of_week", "duration", "campaign", "pdays", "previous"]
CATEGORICAL = ["job", "marital", "education", '"default"', "housing", "loan", "contact", "month", "poutcome", "y"]
MONTH_LIST = "('jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec')"


def _unquote(c: str) -> str:
    return c.strip('"')


def _coerce_sql(text: str) -> str:
    """Whole numbers by their digits; decimals by exact decimal arithmetic, never through a double."""
    d = f"TRY_CAST({text} AS DECIMAL(38, 12))"
    return (f"CASE WHEN regexp_full_match({text}, '\\s*[+-]?[0-9]+\\s*') THEN TRY_CAST(trim({text}) AS BIGINT) "
            f"WHEN {d} = floor({d}) THEN TRY_CAST(floor({d}) AS BIGINT) END")


def _text_sql(c: str) -> str:
    if c == "duration":
        return "CAST(CAST(duration AS DOUBLE) AS VARCHAR)"
    rules = " ".join(f"WHEN _row_id % {d} = 0 THEN {v}" for d, v in TEXT_FAULTS.get(c, []))
    return f"(CASE {rules} ELSE CAST({c} AS VARCHAR) END)" if rules else f"CAST({c} AS VARCHAR)"


def _null_counts_sql(where_positive: bool, with_pct: bool) -> str:
    parts = []
    for c in RAW_COLS:
        name = _unquote(c)
        sel = f"SELECT '{name}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count"
        if with_pct:
            sel += f", round(count_if({c} IS NULL) * 100.0::DOUBLE / COUNT(*), 2) AS null_pct"
        parts.append(sel + " FROM contacts_raw")
    body = "\nUNION ALL ".join(parts)
    if where_positive:
        return f"SELECT * FROM ({body}) WHERE null_count > 0"
    return body


def _rule(cols: str) -> str:
    return over_faulty(f"SELECT row_id, {cols} FROM enriched")


def _coarse(select_cols: str, dims: str = "age_segment, job") -> str:
    return over_groups(dims, f"SELECT {dims}, {select_cols} FROM g")


def _mart(cols: str) -> str:
    return over_mart(f"SELECT kpi_row_id, {cols} FROM campaign_kpis")


def _by_contacts(key: str, of_groups: str, of_contacts: str, order: str) -> str:
    """A report by one key: counts over the contacts beside means over the groups."""
    return (BASE + ",\n" + groups_cte("g", DIMS).strip() + f"\nSELECT c.*, r.* EXCLUDE (k) FROM (SELECT {key}, {of_contacts} "
            f"FROM contacts_clean GROUP BY {key}) c JOIN (SELECT {key} AS k, {of_groups} FROM g GROUP BY {key}) r "
            f"ON r.k IS NOT DISTINCT FROM c.{key} ORDER BY {order}")


# The published checks as SQL: (name, relation, kind, failing predicate or column)
_REL_KEY = {"contacts_raw": "_row_id", "contacts_clean": "row_id", "campaign_kpis": "kpi_row_id"}
_EXPECTED = "round(successful_contacts::DOUBLE / NULLIF(total_contacts, 0) * 100.0::DOUBLE, 2)"
# Fixed rules: the published predicates of three checks, as they are.
_OFF_RATE = f"abs(conversion_rate_pct - {_EXPECTED}) > 0.01"
# The columns that must not be negative.
_NOT_NEGATIVE = ["total_contacts", "successful_contacts", "unsuccessful_contacts", "conversion_rate_pct",
                 "avg_call_duration_min", "avg_contacts_per_client"]
_BELOW_ZERO = " OR ".join(f"{c} < 0" for c in _NOT_NEGATIVE)
_UNCOUNTED = "total_contacts - successful_contacts - unsuccessful_contacts"
CHECKS_SQL = [
    ("src_age_not_null", "contacts_raw", "row", "age IS NULL"),
    ("src_age_between", "contacts_raw", "row", "NOT (age >= 18 AND age <= 100)"),
    ("src_campaign_not_null", "contacts_raw", "row", "campaign IS NULL"),
    ("src_campaign_between", "contacts_raw", "row", "NOT (campaign >= 1 AND campaign <= 100)"),
    ("src_previous_not_null", "contacts_raw", "row", "previous IS NULL"),
    ("src_y_not_null", "contacts_raw", "row", "y IS NULL"),
    ("src_y_accepted_values", "contacts_raw", "values", ("y", "('yes','no')")),
    ("stg_row_id_unique_combo", "contacts_clean", "groups", "row_id"),
    ("stg_row_id_not_null", "contacts_clean", "row", "row_id IS NULL"),
    ("stg_row_id_unique", "contacts_clean", "unique", "row_id"),
    ("stg_age_not_null", "contacts_clean", "row", "age IS NULL"),
    ("stg_age_accepted_range", "contacts_clean", "row", "NOT (age >= 18 AND age <= 100)"),
    ("stg_contact_month_not_null", "contacts_clean", "row", "contact_month IS NULL"),
    ("stg_contact_month_accepted_values", "contacts_clean", "values", ("contact_month", MONTH_LIST)),
    ("stg_subscribed_not_null", "contacts_clean", "row", "subscribed IS NULL"),
    ("kpi_row_id_unique", "campaign_kpis", "unique", "kpi_row_id"),
    ("kpi_row_id_not_null", "campaign_kpis", "row", "kpi_row_id IS NULL"),
    ("kpi_rate_not_null", "campaign_kpis", "row", "conversion_rate_pct IS NULL"),
    ("kpi_rate_accepted_range", "campaign_kpis", "row", "NOT (conversion_rate_pct >= 0 AND conversion_rate_pct <= 100)"),
    ("kpi_total_not_null", "campaign_kpis", "row", "total_contacts IS NULL"),
    ("kpi_total_accepted_range", "campaign_kpis", "row", "NOT (total_contacts >= 0)"),
    ("kpi_successful_not_null", "campaign_kpis", "row", "successful_contacts IS NULL"),
    ("kpi_successful_accepted_range", "campaign_kpis", "row", "NOT (successful_contacts >= 0)"),
    ("assert_conversion_rate_logic", "campaign_kpis", "row", _OFF_RATE),
    ("assert_no_negative_metrics", "campaign_kpis", "row", _BELOW_ZERO),
    ("assert_staging_no_duplicates", "contacts_clean", "groups", "row_id"),
    ("assert_total_contacts_sum", "campaign_kpis", "row", f"{_UNCOUNTED} <> 0"),
]


def _check_count_sql(name, rel, kind, arg) -> str:
    if kind == "row":
        return f"SELECT '{name}' AS check_name, CAST(count_if(coalesce({arg}, FALSE)) AS BIGINT) AS failures FROM {rel}"
    if kind == "values":
        col, vals = arg
        return (f"SELECT '{name}' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures FROM "
                f"(SELECT {col} FROM {rel} WHERE {col} NOT IN {vals} GROUP BY {col})")
    if kind == "unique":
        return (f"SELECT '{name}' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures FROM "
                f"(SELECT {arg} FROM {rel} WHERE {arg} IS NOT NULL GROUP BY {arg} HAVING COUNT(*) > 1)")
    return (f"SELECT '{name}' AS check_name, CAST(COUNT(*) AS BIGINT) AS failures FROM "
            f"(SELECT {arg} FROM {rel} GROUP BY {arg} HAVING COUNT(*) > 1)")


def _check_rows_sql(name, rel, kind, arg) -> str:
    if kind == "row":
        key = f"coalesce(CAST({_REL_KEY[rel]} AS VARCHAR), '_null_')"
        return f"SELECT '{name}' AS check_name, '{rel}' AS relation, {key} AS row_key FROM {rel} WHERE {arg}"
    if kind == "values":
        col, vals = arg
        return (f"SELECT '{name}' AS check_name, '{rel}' AS relation, coalesce(CAST({col} AS VARCHAR), '_null_') AS row_key "
                f"FROM {rel} WHERE {col} NOT IN {vals} GROUP BY {col}")
    where = f"WHERE {arg} IS NOT NULL " if kind == "unique" else ""
    return (f"SELECT '{name}' AS check_name, '{rel}' AS relation, CAST({arg} AS VARCHAR) AS row_key "
            f"FROM {rel} {where}GROUP BY {arg} HAVING COUNT(*) > 1")


def _dq_summary_sql() -> str:
    counts = "\nUNION ALL ".join(_check_count_sql(*c) for c in CHECKS_SQL)
    meta = ", ".join(f"('{n}', '{r}', 'error')" for n, r, _, _ in CHECKS_SQL)
    return over_mart(
        f"SELECT c.check_name, m.relation, m.severity, c.failures, "
        f"CASE WHEN c.failures = 0 THEN 'pass' WHEN m.severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
        f"FROM ({counts}) c JOIN (VALUES {meta}) m(check_name, relation, severity) USING (check_name)"
    )


def _dq_failures_sql() -> str:
    return over_mart("\nUNION ALL ".join(_check_rows_sql(*c) for c in CHECKS_SQL))


ORACLE: dict[str, str] = {
    # 2.1
    "scan_contacts": over_raw("SELECT * FROM contacts_raw"),
    "combine_features_target": over_raw(
        "SELECT * FROM (SELECT * EXCLUDE (y, _dbt_loaded_at) FROM contacts_raw) f "
        "FULL OUTER JOIN (SELECT _row_id, y FROM contacts_raw) t USING (_row_id)"),
    "required_field_nulls": over_raw(
        "SELECT CAST(count_if(_row_id IS NULL) AS BIGINT) AS null_row_id, "
        "CAST(count_if(_dbt_loaded_at IS NULL) AS BIGINT) AS null_dbt_loaded_at FROM contacts_raw"),
    "loaded_row_count": over_raw("SELECT COUNT(*) AS row_count FROM contacts_raw"),
    # a CSV field cannot tell '' from NULL (the published export writes both empty)
    "csv_export": over_raw(
        "SELECT * REPLACE (" + ", ".join(f"NULLIF({c}, '') AS {c}" for c in CATEGORICAL) + ") FROM contacts_raw"),
    "load_preview": over_raw(
        f"SELECT * EXCLUDE (_dbt_loaded_at), TIMESTAMP '{RUN_TS}' AS _dbt_loaded_at FROM contacts_raw "
        "ORDER BY _row_id LIMIT 5"),
    "range_partition_bucket": over_mart(
        "SELECT CASE WHEN contact_month_num >= 1 AND contact_month_num < 13 "
        "THEN CAST(floor((contact_month_num - 1) / 1) AS INTEGER) END AS partition_bucket, "
        "COUNT(*) AS kpi_rows FROM campaign_kpis GROUP BY 1"),
    "dq_failures_all": _dq_failures_sql(),
    # 2.2
    "ingest_validation": over_faulty(
        "SELECT b = 0 AS is_valid, CASE WHEN b = 0 THEN '' ELSE format('invalid target values: {} distinct in {} rows', v, b) "
        "END AS message, CAST(NULL AS VARCHAR) AS invalid_value, n AS row_count FROM (SELECT COUNT(*) AS n, "
        "COUNT(*) FILTER (y NOT IN ('yes','no')) AS b, COUNT(DISTINCT y) FILTER (y NOT IN ('yes','no')) AS v FROM contacts_raw) "
        "UNION ALL SELECT FALSE, 'invalid target value', y, COUNT(*) FROM contacts_raw WHERE y NOT IN ('yes','no') GROUP BY y"),
    "stamp_load_ts": over_raw(f"SELECT _row_id, TIMESTAMP '{RUN_TS}' AS _dbt_loaded_at FROM contacts_raw"),
    "dense_row_id": over_raw("SELECT _row_id, ROW_NUMBER() OVER (ORDER BY _row_id) AS row_num FROM contacts_raw"),
    "coerce_numeric": over_raw(
        "SELECT _row_id, " + ", ".join(f"{_coerce_sql(_text_sql(c))} AS {c}" for c in NUMERIC) + " FROM contacts_raw"),
    "coerce_categorical": over_raw(
        "SELECT _row_id, " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CATEGORICAL) + " FROM contacts_raw"),
    "null_profile": over_raw(_null_counts_sql(True, True)),
    "dataset_shape": over_raw("SELECT COUNT(*) AS n_rows, CAST(19 AS BIGINT) AS n_columns FROM contacts_raw"),
    "null_counts_all": over_raw(_null_counts_sql(False, False)),
    "target_value_counts": over_raw(
        'SELECT y, COUNT(*) AS "count" FROM contacts_raw WHERE y IS NOT NULL GROUP BY y ORDER BY 2 DESC, y'),
    # 2.3
    "rename_contacts": over_raw(
        "SELECT _row_id AS row_id, _dbt_loaded_at AS loaded_at, age, job, marital, education, "
        '"default" AS has_credit_default, balance, housing AS has_housing_loan, loan AS has_personal_loan, '
        "contact AS contact_type, day_of_week AS contact_day, month AS contact_month, "
        "duration AS contact_duration_sec, campaign AS num_contacts_campaign, pdays AS days_since_last_contact, "
        "previous AS num_contacts_previous, poutcome AS previous_outcome, y AS subscribed FROM contacts_raw"),
    "clean_age": _rule("age"),
    "clean_job_marital": _rule("job, marital_status"),
    "clean_whitelists": _rule("education_level, contact_type, previous_campaign_outcome"),
    "clean_booleans": _rule("has_credit_default, has_housing_loan, has_personal_loan, subscribed"),
    "clamp_balance": _rule("account_balance_eur"),
    "clean_day": _rule("contact_day"),
    "clean_month": _rule("contact_month"),
    "clean_lower_bounds": _rule("contact_duration_sec, num_contacts_campaign, num_contacts_previous"),
    "clean_pdays": _rule("days_since_last_contact"),
    "bucket_age": _rule("age, age_segment"),
    "bucket_balance": _rule("account_balance_eur, balance_segment"),
    "bucket_duration": _rule("contact_duration_sec, call_duration_segment"),
    "bucket_intensity": _rule("num_contacts_campaign, campaign_intensity"),
    "flag_debt_loan": _rule("has_debt_indicators, has_any_loan"),
    "flag_history": _rule("was_contacted_before, recently_contacted, previous_campaign_success"),
    "duration_minutes": _rule("contact_duration_sec, contact_duration_min"),
    "month_number": _rule("contact_month, contact_month_num"),
    "month_quarter": _rule("contact_month, contact_quarter"),
    "quality_filter": over_faulty(
        "SELECT row_id, subscribed, age, num_contacts_campaign, contact_month FROM enriched "
        "WHERE subscribed IS NOT NULL AND age IS NOT NULL AND num_contacts_campaign >= 1 AND contact_month IS NOT NULL"),
    "contacts_clean": over_raw("SELECT * FROM contacts_clean"),
    "safe_divide": over_raw(
        "SELECT row_id, num_contacts_previous::DOUBLE / NULLIF(days_since_last_contact, 0) AS previous_per_day "
        "FROM contacts_clean"),
    "conversion_rates": _coarse("total_contacts, successful_contacts, conversion_rate_pct, non_conversion_rate_pct"),
    "rate_helper": over_groups("contact_month",
        "SELECT contact_month, round(successful_contacts::DOUBLE / NULLIF(total_contacts, 0) * 100.0::DOUBLE, 1) "
        "AS rate_pct_1dp, round(unsuccessful_contacts::DOUBLE / NULLIF(total_contacts, 0) * 100.0::DOUBLE, 3) "
        "AS non_rate_pct_3dp FROM g"),
    "conversions_per_minute": _coarse("total_call_duration_sec, conversions_per_call_minute"),
    "performance_vs_target": _coarse("conversion_rate_pct, performance_vs_target"),
    "performance_segment": _coarse("conversion_rate_pct, performance_segment"),
    "efficiency_index": _coarse("avg_contacts_per_client, efficiency_index"),
    "contact_quality_index": _coarse("avg_call_duration_min, contact_quality_index"),
    "share_in_segment": _mart("total_contacts, total_contacts_in_segment, share_of_contacts_in_segment_pct"),
    "rate_vs_segment": _mart("conversion_rate_pct, avg_conversion_rate_in_segment, conversion_rate_vs_segment_avg"),
    "top_performer_flag": _mart("conversion_rank_by_age, is_top_performer_in_age_segment"),
    "cents_to_euros": (
        "SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100.0::DOUBLE) AS BIGINT) AS price_cents, "
        "round(CAST(round(l_extendedprice * 100.0::DOUBLE) AS BIGINT) / 100.0::DOUBLE, 2) AS price_eur FROM lineitem"),
    "surrogate_key": over_raw(
        "SELECT row_id, md5(coalesce(CAST(job AS VARCHAR), '_null_') || '|' || "
        "coalesce(CAST(education_level AS VARCHAR), '_null_') || '|' || "
        "coalesce(CAST(has_credit_default AS VARCHAR), '_null_') || '|' || "
        "coalesce(CAST(contact_day AS VARCHAR), '_null_')) AS sk FROM contacts_clean"),
    "filter_by_id": over_raw("SELECT row_id, age, job, subscribed FROM contacts_clean WHERE row_id = 1"),
    "campaign_kpis": over_mart("SELECT * EXCLUDE (group_sk) FROM campaign_kpis"),
    # 2.4
    "base_metrics": over_mart("SELECT * FROM kpi_groups_base"),
    "pct_previously_contacted": over_groups("contact_month", "SELECT contact_month, pct_previously_contacted FROM g"),
    "median_by_group": _coarse("median_call_duration_sec, median_account_balance"),
    "segment_summary": over_mart("SELECT * FROM kpi_segments"),
    "column_domain": over_raw(
        "SELECT DISTINCT contact_month AS value FROM contacts_clean WHERE contact_month IS NOT NULL ORDER BY 1"),
    "row_count": over_raw("SELECT COUNT(*) AS row_count FROM contacts_clean"),
    "avg_conversion": over_mart(
        f"SELECT round({fixed_mean('conversion_rate_pct', 2)}, 2) AS avg_conversion FROM campaign_kpis"),
    # 2.5
    "rank_by_age": over_mart("SELECT group_sk, conversion_rate_pct, conversion_rank_by_age FROM kpi_ranked"),
    "rank_by_month": over_mart("SELECT group_sk, conversion_rate_pct, conversion_rank_by_month FROM kpi_ranked"),
    "conversion_percentile": over_mart("SELECT group_sk, conversion_rate_pct, conversion_percentile FROM kpi_ranked"),
    "kpi_row_id": over_mart("SELECT group_sk, conversion_rate_pct, kpi_row_id FROM kpi_ranked"),
    # 2.6
    "kpi_with_segment": _mart(
        "age_segment, job, education_level, balance_segment, total_contacts_in_segment, "
        "total_conversions_in_segment, avg_conversion_rate_in_segment, best_month_for_segment"),
    # 2.7 / 2.8
    "contacts_chronological": over_raw(
        "SELECT row_id, contact_month_num, contact_day FROM contacts_clean "
        "ORDER BY contact_month_num NULLS FIRST, contact_day NULLS FIRST, row_id"),
    "top_segments": over_mart(
        "SELECT age_segment, job, education_level, conversion_rate_pct, total_contacts, successful_contacts "
        "FROM campaign_kpis WHERE total_contacts >= 2 ORDER BY conversion_rate_pct DESC, kpi_row_id LIMIT 10"),
    "top_segments_coarse": over_groups("age_segment, job, education_level",
        "SELECT age_segment, job, education_level, conversion_rate_pct, total_contacts, successful_contacts FROM g "
        "WHERE total_contacts >= 100 ORDER BY conversion_rate_pct DESC, age_segment, job NULLS FIRST, "
        "education_level NULLS FIRST LIMIT 10"),
    "top_age_segments": _by_contacts(
        "age_segment", f"round({fixed_mean('conversion_rate_pct', 2)}, 2) AS conversion", "COUNT(*) AS contacts",
        "conversion DESC, age_segment LIMIT 5"),
    "monthly_trend": _by_contacts(
        "contact_month", f"{fixed_mean('conversion_rate_pct', 2)} AS avg_conversion_rate",
        "COUNT(*) AS total_contacts, COUNT(*) FILTER (subscribed) AS total_conversions",
        f"list_position([{MONTH_LIST[1:-1]}], contact_month)"),
    "weak_segments": over_mart(
        "SELECT age_segment, job, balance_segment, conversion_rate_pct, total_contacts, performance_segment "
        "FROM campaign_kpis WHERE performance_segment = 'very_low_performance' AND total_contacts >= 2 "
        "ORDER BY total_contacts DESC, kpi_row_id"),
    "roi_by_duration": _by_contacts(
        "call_duration_segment",
        f"{fixed_mean('conversion_rate_pct', 2)} AS avg_conversion_rate, round(AVG(avg_call_duration_min), 6) AS avg_duration_min, "
        f"{fixed_mean('conversions_per_call_minute', 4)} AS conversions_per_min",
        "COUNT(*) AS total_calls, COUNT(*) FILTER (subscribed) AS conversions", "conversions_per_min DESC NULLS LAST"),
    "layer_counts": over_mart(
        "SELECT 'contacts_raw' AS layer, COUNT(*) AS row_count FROM contacts_raw UNION ALL "
        "SELECT 'contacts_clean', COUNT(*) FROM contacts_clean UNION ALL "
        "SELECT 'campaign_kpis', COUNT(*) FROM campaign_kpis"),
    # 2.9
    "dq_not_null": over_raw("SELECT * FROM contacts_raw WHERE y IS NULL"),
    "dq_unique": over_raw(
        "SELECT row_id AS unique_field, COUNT(*) AS n_records FROM " + FAULTY_CLEAN + " WHERE row_id IS NOT NULL "
        "GROUP BY row_id HAVING COUNT(*) > 1"),
    "dq_unique_combo": over_raw(
        "SELECT row_id, COUNT(*) AS n_records FROM " + FAULTY_CLEAN + " GROUP BY row_id HAVING COUNT(*) > 1"),
    "dq_accepted_values": over_raw(
        f"SELECT contact_month AS value_field, COUNT(*) AS n_records FROM {FAULTY_CLEAN} "
        f"WHERE contact_month NOT IN {MONTH_LIST} GROUP BY contact_month"),
    "dq_accepted_range": over_raw("SELECT * FROM " + FAULTY_CLEAN + " WHERE NOT (age >= 18 AND age <= 100)"),
    "dq_rate_logic": over_mart(
        "SELECT kpi_row_id, age_segment, job, total_contacts, successful_contacts, conversion_rate_pct, "
        f"{_EXPECTED} AS expected_conversion_rate, abs(conversion_rate_pct - expected_conversion_rate) "
        f"AS difference FROM {FAULTY_MART} WHERE {_OFF_RATE}"),
    "dq_no_negative": over_mart(
        f"SELECT kpi_row_id, age_segment, job, contact_month, {', '.join(_NOT_NEGATIVE)} FROM {FAULTY_MART} WHERE {_BELOW_ZERO}"),
    "dq_staging_duplicates": over_raw(
        "SELECT row_id, COUNT(*) AS occurrences FROM " + FAULTY_CLEAN + " GROUP BY row_id HAVING COUNT(*) > 1 "
        "ORDER BY occurrences DESC, row_id"),
    "dq_total_sum": over_mart(
        "SELECT kpi_row_id, age_segment, job, contact_month, total_contacts, successful_contacts, unsuccessful_contacts, "
        f"{_UNCOUNTED} AS difference, total_contacts - difference AS calculated_total FROM {FAULTY_MART} "
        "WHERE difference <> 0"),
    "dq_between": over_raw("SELECT * FROM contacts_raw WHERE NOT (age >= 18 AND age <= 100)"),
    "source_freshness": over_raw(
        "SELECT max_loaded_at, round(age_hours, 2) AS age_hours, "
        "CASE WHEN age_hours IS NULL THEN 'error' WHEN age_hours > 48 THEN 'error' WHEN age_hours > 24 THEN 'warn' "
        "ELSE 'pass' END AS status FROM (SELECT MAX(_dbt_loaded_at) AS max_loaded_at, "
        f"(epoch(TIMESTAMP '{RUN_TS}') - epoch(MAX(_dbt_loaded_at))) / 3600.0::DOUBLE AS age_hours FROM contacts_raw)"),
    "dq_summary": _dq_summary_sql(),
}

# ---- stored tables, sketches and builds ----

_ORDERED = "ROW_NUMBER() OVER (ORDER BY _row_id)"
_FEATURES = ", ".join(c for c in RAW_COLS if c not in ("_row_id", "y", "_dbt_loaded_at"))
_COARSE_DIMS = "age_segment, job"


def _at_share(col: str, share: str) -> str:
    """The value at a share of the sorted values (an input element)."""
    return f"list_sort(list({col}) FILTER ({col} IS NOT NULL))[CAST(ceil({share}::DOUBLE * COUNT({col})) AS BIGINT)]"


def _quantiles_sql(dims: str) -> str:
    call = "contact_duration_sec"
    return over_raw(
        f"SELECT {dims}, COUNT(*) AS total_contacts, {_middle(call)} AS median_call_duration_sec, "
        f"{_middle('account_balance_eur')} AS median_account_balance, {_at_share(call, '0.25')} AS p25_call_duration_sec, "
        f"{_at_share(call, '0.75')} AS p75_call_duration_sec, {_at_share(call, '0.9')} AS p90_call_duration_sec "
        f"FROM contacts_clean GROUP BY {dims}")


def _profile_sql() -> str:
    kinds = {c: "VARCHAR" for c in RAW_COLS}
    return over_raw("\nUNION ALL ".join(
        f"SELECT '{_unquote(c)}' AS column_name, {i} AS position, '2' AS loads, COUNT(*) AS n_rows, count_if({c} IS NULL)::BIGINT AS n_nulls, "
        f"round(count_if({c} IS NULL) * 100.0::DOUBLE / COUNT(*), 2) AS null_pct, CAST(MIN({c}) AS {kinds[c]}) AS least, "
        f"CAST(MAX({c}) AS {kinds[c]}) AS greatest FROM contacts_raw" for i, c in enumerate(RAW_COLS)))


def _head_sql() -> str:
    kinds = {c: "bigint" for c in ["_row_id", *NUMERIC]} | {"_dbt_loaded_at": "timestamp"}
    heads = lambda c: ", ".join(f"MAX(CAST({c} AS VARCHAR)) FILTER (k = {i}) AS head_{i}" for i in range(1, 6))
    rows = f"(SELECT *, {_ORDERED} AS k FROM contacts_raw QUALIFY k <= 5)"
    return over_raw("\nUNION ALL ".join(
        f"SELECT {i} AS position, '{_unquote(c)}' AS column_name, '{kinds.get(c, 'string')}' AS data_type, {heads(c)} FROM {rows}"
        for i, c in enumerate(RAW_COLS)))


def _graded_sql() -> str:
    counts = "\nUNION ALL ".join(_check_count_sql(*c) for c in CHECKS_SQL)
    rules = {"src_y_not_null": ("warn", 0, 0), "src_age_between": ("error", 0, 10), "src_campaign_between": ("error", 0, 1_000_000_000)}
    meta = ", ".join("('{}', '{}', '{}', {}, {})".format(n, r, *rules.get(n, ("error", 0, 0))) for n, r, _, _ in CHECKS_SQL)
    return over_mart(
        "SELECT c.check_name, m.relation, m.severity, c.failures, CASE WHEN c.failures <= m.w THEN 'pass' "
        "WHEN m.severity = 'warn' OR c.failures <= m.e THEN 'warn' ELSE 'fail' END AS status "
        f"FROM ({counts}) c JOIN (VALUES {meta}) m(check_name, relation, severity, w, e) USING (check_name)")


ORACLE |= {
    "month_rebuild": over_mart(
        "SELECT CAST(contact_month_num - 1 AS INTEGER) AS partition_bucket, COUNT(*) AS kpi_rows, "
        "COUNT(*) FILTER (contact_month_num = 3) AS rebuilt_rows FROM campaign_kpis GROUP BY 1"),
    "kpis_of_quarter": over_mart(
        "SELECT kpi_row_id, contact_month, total_contacts, conversion_rate_pct FROM campaign_kpis WHERE contact_quarter = 'Q2'"),
    "published_view": ORACLE["campaign_kpis"],
    "combine_by_position": over_raw(
        f"SELECT * FROM (SELECT {_ORDERED} - 1 AS _position, _row_id, {_FEATURES} FROM contacts_raw) f FULL OUTER JOIN "
        f"(SELECT {_ORDERED} - 1 AS _position, y FROM contacts_raw WHERE _row_id % 10 <> 0) t USING (_position)"),
    "kpi_with_segment_bucketed": ORACLE["kpi_with_segment"],
    "footer_row_count": ORACLE["loaded_row_count"],
    "footer_freshness": ORACLE["source_freshness"],
    "median_sketch": _quantiles_sql(_COARSE_DIMS),
    "median_rollup": _quantiles_sql("contact_month"),
    "merged_profile": _profile_sql(),
    "dataset_head": _head_sql(),
    "dq_summary_graded": _graded_sql(),
    "model_build": over_mart(
        "SELECT 'contacts_raw' AS model, 'built' AS status, COUNT(*) AS rows, '' AS failed_checks, CAST(NULL AS VARCHAR) AS because "
        "FROM contacts_raw UNION ALL SELECT 'contacts_clean', 'built', COUNT(*), '', NULL FROM contacts_clean UNION ALL "
        "SELECT 'campaign_kpis', 'built', COUNT(*), '', NULL FROM campaign_kpis UNION ALL "
        "SELECT 'monthly_trend', 'built', COUNT(DISTINCT contact_month), '', NULL FROM campaign_kpis UNION ALL "
        "SELECT 'audited_raw', 'failed', COUNT(*), 'audit_age_between,audit_y_not_null', NULL FROM contacts_raw UNION ALL "
        "SELECT 'audited_targets', 'skipped', NULL, '', 'audited_raw'"),
}
