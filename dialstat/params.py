"""Run parameters and the fixed value lists the cleaning rules depend on."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# These must equal the published rules for results to agree.
# ---------------------------------------------------------------------------
TEXT_SENTINELS = ("unknown", "")
EDUCATION_LEVELS = ("primary", "secondary", "tertiary")
CONTACT_TYPES = ("cellular", "telephone")
OUTCOMES = ("success", "failure", "other")
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
QUARTERS = {"Q1": ("jan", "feb", "mar"), "Q2": ("apr", "may", "jun"),
            "Q3": ("jul", "aug", "sep"), "Q4": ("oct", "nov", "dec")}
TARGET_VALUES = ("yes", "no")
RAW_COLUMNS = ("age", "job", "marital", "education", "default", "balance", "housing", "loan",
               "contact", "day_of_week", "month", "duration", "campaign", "pdays", "previous",
               "poutcome", "y")
CATEGORICAL_COLUMNS = ("job", "marital", "education", "default", "housing", "loan", "contact",
                       "month", "poutcome", "y")
NUMERIC_COLUMNS = ("age", "balance", "day_of_week", "duration", "campaign", "pdays", "previous")

UNKNOWN = "unknown"
# Segments: (lowest, highest, label) inclusive ranges, then the open top range (above, label).
AGE_SEGMENTS = ((18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 55, "46-55"), (56, 65, "56-65"))
AGE_TOP = (65, "65+")
BALANCE_NEGATIVE, BALANCE_ZERO = "negative", "zero"
BALANCE_SEGMENTS = ((1, 500, "low (1-500)"), (501, 2000, "medium (501-2k)"), (2001, 10000, "high (2k-10k)"))
BALANCE_TOP = (10000, "very_high (10k+)")
DURATION_NONE = "no_contact"
DURATION_UNDER_MINUTE = (60, "very_short (<1min)")
DURATION_SEGMENTS = ((60, 180, "short (1-3min)"), (181, 300, "medium (3-5min)"), (301, 600, "long (5-10min)"))
DURATION_TOP = (600, "very_long (10min+)")
INTENSITY_SINGLE = "single_contact"
INTENSITY_SEGMENTS = ((2, 3, "low (2-3)"), (4, 6, "medium (4-6)"))
INTENSITY_TOP = (6, "high (7+)")
DAY_RANGE = (1, 31)
RECENT_DAYS = 30
# Target bands: at or above the threshold; at or above threshold * factor; else.
TARGET_BANDS = ("above_target", "near_target", "below_target")
NEAR_TARGET_FACTOR = 0.8
# Performance bands: (lowest ratio, label), highest first; below all of them the floor label.
PERFORMANCE_BANDS = ((0.20, "high_performance"), (0.10, "medium_performance"), (0.05, "low_performance"))
PERFORMANCE_FLOOR = "very_low_performance"

# The fifteen grouping dimensions of the KPI mart, in grouping order.
KPI_DIMENSIONS = (
    "age_segment", "job", "marital_status", "education_level", "balance_segment",
    "contact_type", "contact_month", "contact_month_num", "contact_quarter",
    "call_duration_segment", "campaign_intensity", "previous_campaign_outcome",
    "has_any_loan", "has_debt_indicators", "was_contacted_before",
)
# Keys of the second-level segment summary.
SEGMENT_KEYS = ("age_segment", "job", "education_level", "balance_segment")

# A fixed run timestamp keeps registered queries reproducible; real runs pass "now".
DEFAULT_RUN_TS = _dt.datetime(2024, 1, 1, 0, 0, 0)


@dataclass(frozen=True)
class Params:
    """Project variables of the published pipeline plus engine knobs."""

    min_age: int = 18
    max_age: int = 100
    min_balance: int = -10000
    max_balance: int = 100000
    success_threshold: float = 0.10
    # Clock values are parameters, never per-row calls to a clock.
    run_ts: _dt.datetime = field(default=DEFAULT_RUN_TS)
    # Freshness thresholds of the raw source, in hours.
    warn_after_hours: int = 24
    error_after_hours: int = 48
    # Rank cells above this many rows are split by surrogate-key prefix.
    rank_cell_rows: int = 1_000_000
    # Reporting floors of the shipped usage queries.
    top_segments_min_contacts: int = 100
    weak_segments_min_contacts: int = 50

    @property
    def run_ts_text(self) -> str:
        return self.run_ts.strftime("%Y-%m-%d %H:%M:%S")

    @property
    def run_started_at_text(self) -> str:
        """The run start as the templating layer prints a UTC datetime ('2024-01-01 00:00:00+00:00')."""
        return str(self.run_ts.replace(tzinfo=_dt.timezone.utc))
