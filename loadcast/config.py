"""Run configuration and the fixed names and values of the load-forecasting data model.

Everything in the "fixed values" block must stay as it is for results to match the
reference pipeline: column spellings (including its misspelt ``SubSerivce`` columns),
lag offsets, the rolling-window shape, the indexed columns and the forest settings.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

# --------------------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# --------------------------------------------------------------------------------------

# Raw session log, in file order.
SESSION_COLUMNS = [
    "TrafficType", "SessionStart", "SessionEnd", "ConcurrentConnectionCounts",
    "MbytesTransferred", "ServiceGrade", "HTTP1", "ServerType",
    "SubService_1_Load", "SubSerivce_2_Load", "SubSerivce_3_Load",
    "SubSerivce_4_Load", "SubSerivce_5_Load", "SecureBytes_Load", "TotalLoad",
    "ServerIP", "ClientIP",
]

# Stray header rows carry this value in the server column.
HEADER_SERVER_VALUE = "IPs"

# Five-minute sums: (output column, session column). NumSession is count(*), placed second.
FIVE_MIN_SUMS = [
    ("SumTotalLoad", "TotalLoad"),
    ("SumMBytes", "MbytesTransferred"),
    ("SumLoad1", "SubService_1_Load"),
    ("SumLoad2", "SubSerivce_2_Load"),
    ("SumLoad3", "SubSerivce_3_Load"),
    ("SumLoad4", "SubSerivce_4_Load"),
    ("SumLoad5", "SubSerivce_5_Load"),
    ("SumLoadSecure", "SecureBytes_Load"),
]

# Hourly peak measures: (output column, five-minute column).
PEAK_MEASURES = [
    ("peakLoad", "SumTotalLoad"),
    ("peakBytes", "SumMBytes"),
    ("peakLoad1", "SumLoad1"),
    ("peakLoad2", "SumLoad2"),
    ("peakLoad3", "SumLoad3"),
    ("peakLoad4", "SumLoad4"),
    ("peakLoad5", "SumLoad5"),
    ("peakLoadSecure", "SumLoadSecure"),
]

# Daily means of the peaks: <peak>Daily.
DAILY_SUFFIX = "Daily"

# Rolling mean of the daily means: skip 2 days, average the 7 before them.
ROLLING_LAG_DAYS = 2
ROLLING_WINDOW_DAYS = 7

# Hourly lags of peakLoad: 48..96 hours, one week, one month (int(24 * 365.25 / 12)).
HOURLY_LAGS = [48, 49, 50, 51, 52, 55, 60, 67, 72, 96, 168, 730]
LAGGED_MEASURE = "peakLoad"

# Calendar flags, inclusive hour ranges.
BUSINESS_HOURS = (8, 18)
MORNING_HOURS = (6, 9)

# Trend unit: years of 365.25 days.
SECONDS_PER_YEAR = 3600 * 24 * 365.25

# Categorical columns indexed by frequency (and one-hot encoded when they have 2+ levels).
INDEX_COLUMNS = [
    "dayofweek", "ServerIP", "year", "month", "weekofyear", "dayofmonth", "hourofday",
    "Holiday", "BusinessHour", "Morning",
]

# Scoring horizon: 48 hours scored; features from the 365.25/12 days before.
SCORE_HOURS = 48
FEATURE_WINDOW_SECONDS = int(365.25 / 12 * 24 * 3600)

# Random forest.
RF_NUM_TREES = 100
RF_MAX_DEPTH = 8
RF_SEED = 42

# Reference thresholds for the load label (x7 when the whole history is used).
DEFAULT_LOW, DEFAULT_HIGH = 100.0, 500.0
FULL_HISTORY_FACTOR = 7

# --------------------------------------------------------------------------------------
# Derived names
# --------------------------------------------------------------------------------------

SUM_COLUMNS = [name for name, _ in FIVE_MIN_SUMS]
PEAK_COLUMNS = [name for name, _ in PEAK_MEASURES]
DAILY_COLUMNS = [p + DAILY_SUFFIX for p in PEAK_COLUMNS]
ROLLING_COLUMNS = [f"{d}Lag{ROLLING_LAG_DAYS}Win{ROLLING_WINDOW_DAYS}" for d in DAILY_COLUMNS]
LAG_COLUMNS = [f"{LAGGED_MEASURE}Lag{i}" for i in HOURLY_LAGS]
# Rolling columns come first: that is the order the feature table creates them in.
SCALED_INPUTS = ROLLING_COLUMNS + LAG_COLUMNS
SCALED_COLUMNS = ["scaled" + c for c in SCALED_INPUTS]
INDEXED_COLUMNS = [c + "_indexed" for c in INDEX_COLUMNS]
CALENDAR_INT_COLUMNS = ["year", "month", "weekofyear", "dayofmonth", "hourofday"]
FLAG_COLUMNS = ["Holiday", "BusinessHour", "Morning"]

# The lags must not look into the scored horizon.
assert min(HOURLY_LAGS) >= SCORE_HOURS
assert ROLLING_LAG_DAYS * 24 >= SCORE_HOURS


@dataclass(frozen=True)
class RunConfig:
    """Time range, split and label thresholds of one run.

    Timestamps are wall-clock strings ``yyyy-MM-dd HH:mm:ss`` (no zone).
    ``lag_mode`` is ``calendar`` (lags count hours on the clock, the default for both
    training and scoring) or ``observed`` (lags count existing rows, as the original
    training ETL did).
    """

    train_begin: str
    train_end: str
    test_split_start: str
    low: float = DEFAULT_LOW
    high: float = DEFAULT_HIGH
    score_begin: str | None = None
    lag_mode: str = "calendar"
    fit_on: str = "all"  # rows the indexer and scaler are fitted on: "all" or "train"
    handle_invalid: str = "skip"  # unseen levels at scoring time
    # Cuts from the data: with fractions given, ``low`` and ``high`` are those percentiles of the train
    # split's loads once ``plans.training.with_cuts`` has looked at it.
    label_quantiles: tuple[float, float] | None = None

    @property
    def duration(self) -> str:
        """``ONE_MONTH`` or ``FULL``: whether training spans one calendar month or more."""
        return "ONE_MONTH" if self.train_begin[:7] == self.train_end[:7] else "FULL"

    def with_(self, **kw) -> "RunConfig":
        return replace(self, **kw)


# The reference's two duration modes.
ONE_MONTH = RunConfig("2016-06-01 00:00:00", "2016-06-30 23:59:59", "2016-06-29 00:00:00",
                      score_begin="2016-07-01 00:00:00")
FULL = RunConfig("2009-01-01 00:00:00", "2016-06-30 23:59:59", "2016-06-01 00:00:00",
                 low=DEFAULT_LOW * FULL_HISTORY_FACTOR, high=DEFAULT_HIGH * FULL_HISTORY_FACTOR,
                 score_begin="2016-07-01 00:00:00")

# Test fixture: the `events` table (30 days of January 2024), split on the last two days.
# One pair of thresholds for every folder (the hourly peaks grow with the scale).
EVENTS = RunConfig("2024-01-01 00:00:00", "2024-01-30 23:59:59", "2024-01-29 00:00:00",
                   low=50.0, high=230.0, score_begin="2024-01-29 00:00:00")

# The same with cuts from the train split: three classes of like size in every folder.
EVENTS_CUTS = EVENTS.with_(label_quantiles=(1 / 3, 2 / 3))

# Long-history fixture: `lineitem` as a daily session log, 1995-2001, processed the way the
# original training ETL did (lags and rolling means over observed rows).
LINEITEM = RunConfig("1995-01-01 00:00:00", "2001-12-31 23:59:59", "2001-01-01 00:00:00",
                     low=10.0, high=30.0, lag_mode="observed", score_begin="2001-01-01 00:00:00")
