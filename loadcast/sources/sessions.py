"""Session log: declared schema, CSV read/write, cleaning, and adapters from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import HEADER_SERVER_VALUE, SESSION_COLUMNS

_TYPES = {
    "TrafficType": T.StringType(),
    "SessionStart": T.TimestampNTZType(),
    "SessionEnd": T.TimestampNTZType(),
    "ConcurrentConnectionCounts": T.LongType(),
    "MbytesTransferred": T.DoubleType(),
    "ServiceGrade": T.StringType(),
    "HTTP1": T.StringType(),
    "ServerType": T.StringType(),
    "SubService_1_Load": T.DoubleType(),
    "SubSerivce_2_Load": T.DoubleType(),
    "SubSerivce_3_Load": T.DoubleType(),
    "SubSerivce_4_Load": T.DoubleType(),
    "SubSerivce_5_Load": T.DoubleType(),
    "SecureBytes_Load": T.DoubleType(),
    "TotalLoad": T.DoubleType(),
    "ServerIP": T.StringType(),
    "ClientIP": T.StringType(),
}

# Declared once: the files are read in one pass, with no inference job, and the
# positional layout of the headerless files maps straight onto these names.
SESSION_SCHEMA = T.StructType([T.StructField(c, _TYPES[c], True) for c in SESSION_COLUMNS])

WRITE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIME_COLUMNS = ["SessionStart", "SessionEnd"]
# As read from the files: times as text, so that none is lost to a pattern it doesn't match.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType() if c in TIME_COLUMNS else _TYPES[c], True)
                           for c in SESSION_COLUMNS])


def parse_time(text: F.Column, timestamp_format: str | None = None) -> F.Column:
    """A wall-clock time. By default any form of the SQL cast: date and time divided by a
    space or ``T``, seconds and fractions optional; with a pattern, that pattern first."""
    plain = F.trim(text).try_cast("timestamp_ntz")
    if timestamp_format is None:
        return plain
    own = F.from_csv(text, "t TIMESTAMP_NTZ", {"timestampNTZFormat": timestamp_format, "sep": "\u0001"})["t"]
    return F.coalesce(own, plain)


def read_sessions_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Headerless CSV (a path, glob or list of them) with the two time columns as text.
    Other malformed fields become NULL."""
    return (spark.read.schema(RAW_SCHEMA)
            .option("header", "false").option("sep", ",")
            .option("mode", "PERMISSIVE").option("nanValue", "")
            .csv(path))


def read_sessions_csv(spark: SparkSession, path: str | list[str],
                      timestamp_format: str | None = None) -> DataFrame:
    """The session log of headerless CSV files. ``timestamp_format`` is a Spark datetime
    pattern for files whose times are in another form than the usual ones."""
    raw = read_sessions_text(spark, path)
    return raw.withColumns({c: parse_time(F.col(c), timestamp_format) for c in TIME_COLUMNS})


NUMBER_COLUMNS = [c for c in SESSION_COLUMNS if isinstance(_TYPES[c], (T.LongType, T.DoubleType))]
REJECT_COLUMNS = ["file", "line", "reason"]


def read_sessions_checked(spark: SparkSession, path: str | list[str],
                          timestamp_format: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sessions, rejects) of headerless CSV files. A line of another number of fields, or with a
    number or time that is there but can't be read, is a reject with its file, its text and the
    reason (the first one, in file order), and no session: so no sum takes a field for missing that
    was malformed. Empty fields are missing values, as they stand; header lines are no rejects and
    are left to ``clean_sessions``. NaN and infinite numbers are malformed.

    Both are lazy over one reading of text; the fields are parsed once each."""
    texts = T.StructType([T.StructField(c, T.StringType()) for c in [*SESSION_COLUMNS, "_line"]])
    raw = (spark.read.schema(texts).option("header", "false").option("sep", ",").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line").option("columnPruning", "false").csv(path))
    parsed = {}
    for c in SESSION_COLUMNS:
        text = F.col(c)
        if c in TIME_COLUMNS:
            parsed[c] = parse_time(text, timestamp_format)
        elif c in NUMBER_COLUMNS:
            number = F.trim(text).try_cast(_TYPES[c])
            if isinstance(_TYPES[c], T.DoubleType):
                number = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
            parsed[c] = number
    typed = raw.select("*", F.col("_metadata.file_path").alias("_file"), *[v.alias(f"_as_{c}") for c, v in parsed.items()])
    bad = [F.when(F.col(c).isNotNull() & F.col(f"_as_{c}").isNull(),
                  F.lit(f"{c}: not a {'time' if c in TIME_COLUMNS else 'number'}")) for c in SESSION_COLUMNS if c in parsed]
    header = F.coalesce(F.col("ServerIP") == HEADER_SERVER_VALUE, F.lit(False))
    reason = F.when(F.col("_line").isNotNull(), F.lit("number of fields")).when(~header, F.coalesce(*bad))
    typed = typed.withColumn("_reason", reason)
    line = F.coalesce("_line", F.to_csv(F.struct(*SESSION_COLUMNS)))
    rejects = typed.where(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), line.alias("line"), F.col("_reason").alias("reason"))
    sessions = typed.where(F.col("_reason").isNull()).select(
        *[F.col(f"_as_{c}" if c in parsed else c).alias(c) for c in SESSION_COLUMNS])
    return sessions, rejects


def unparsed_times(raw: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """(metric, n) of rows read as text whose time is there but can't be parsed, header rows
    aside, for each time column."""
    rows = raw.where(F.col("ServerIP").isNull() | (F.col("ServerIP") != HEADER_SERVER_VALUE))
    counts = rows.agg(*[F.count_if(F.col(c).isNotNull() & parse_time(F.col(c), timestamp_format).isNull())
                        .alias(f"unparsed_{c}") for c in TIME_COLUMNS])
    return counts.unpivot([], counts.columns, "metric", "n")


def write_sessions_csv(sessions: DataFrame, path: str, folder: F.Column | None = None) -> None:
    """Headerless CSV below ``path``, in ``folder=<value>`` folders when a column is given."""
    out = sessions.select(*SESSION_COLUMNS, *([folder.alias("folder")] if folder is not None else []))
    writer = out.write.mode("overwrite").option("header", "false").option("timestampNTZFormat", WRITE_TIMESTAMP_FORMAT)
    (writer.partitionBy("folder") if folder is not None else writer).csv(path)


def clean_sessions(sessions: DataFrame) -> DataFrame:
    """Drop stray header rows and rows without a server."""
    return sessions.where(F.col("ServerIP").isNotNull() & (F.col("ServerIP") != HEADER_SERVER_VALUE))


def filter_servers(sessions: DataFrame, servers) -> DataFrame:
    """Keep the given servers: a Python list (an IN list) or a one-column DataFrame
    of ``ServerIP`` values (a semi join, so the list can be of any size)."""
    if isinstance(servers, DataFrame):
        kept = sessions.join(servers.select("ServerIP").distinct(), "ServerIP", "left_semi")
        return kept.select(*sessions.columns)
    return sessions.where(F.col("ServerIP").isin(list(servers)))


def sessions_from_events(events: DataFrame, **columns: F.Column) -> DataFrame:
    """Map the ``events`` table onto the session log (one session per event).

    ``k`` is parsed from the JSON once, in its own projection (Catalyst does not merge a
    projection into one that would repeat an expensive expression); a malformed value
    becomes NULL, as a malformed CSV field does. ``columns`` replaces some of the mapping."""
    parse_k, cols = _events_mapping()
    return events.withColumn("_k", parse_k).select(
        *[columns[c].alias(c) if c in columns else cols[i] for i, c in enumerate(SESSION_COLUMNS)])


def _events_mapping():
    """Column expressions of the events adapter."""
    k = F.col("_k")
    v = F.col("value")
    by_type = {"click": 1, "purchase": 2, "error": 3, "signup": 4, "view": 5}
    sub = {n: F.when(F.col("event_type") == t, v).otherwise(F.lit(0.0)) for t, n in by_type.items()}
    cols = {
        "TrafficType": F.col("event_type"),
        "SessionStart": F.col("ts"),
        "SessionEnd": F.timestamp_add("SECOND", k, F.col("ts")),
        "ConcurrentConnectionCounts": k,
        "MbytesTransferred": v * k / F.lit(100),
        "ServiceGrade": (F.col("event_id") % 3).cast("string"),
        "HTTP1": (F.col("event_id") % 2).cast("string"),
        "ServerType": (F.col("user_id") % 3).cast("string"),
        "SubService_1_Load": sub[1],
        "SubSerivce_2_Load": sub[2],
        "SubSerivce_3_Load": sub[3],
        "SubSerivce_4_Load": sub[4],
        "SubSerivce_5_Load": sub[5],
        "SecureBytes_Load": F.when(k % 2 == 0, v).otherwise(F.lit(0.0)),
        "TotalLoad": v,
        # some events stand for stray header rows, some for rows without a server
        "ServerIP": F.when(F.col("event_id") % 97 == 0, HEADER_SERVER_VALUE)
                     .when(F.col("event_id") % 89 == 0, F.lit(None))
                     .otherwise(F.concat(F.lit("10.0.0."), (F.col("user_id") % 8).cast("string"))),
        "ClientIP": F.concat(F.lit("172.16.0."), F.col("user_id").cast("string")),
    }
    return (F.get_json_object("props", "$.k").try_cast("long"),
            [cols[c].cast(_TYPES[c]).alias(c) for c in SESSION_COLUMNS])


def sessions_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Map ``lineitem`` onto the session log: one session per line, a long daily history."""
    zero = F.lit(0.0)
    cols = {
        "TrafficType": F.col("l_returnflag"),
        "SessionStart": F.col("l_shipdate"),
        "SessionEnd": F.col("l_shipdate"),
        "ConcurrentConnectionCounts": F.lit(1),
        "MbytesTransferred": F.col("l_extendedprice"),
        "ServiceGrade": F.col("l_linestatus"),
        "HTTP1": F.lit(None),
        "ServerType": F.lit(None),
        "SubService_1_Load": zero,
        "SubSerivce_2_Load": zero,
        "SubSerivce_3_Load": zero,
        "SubSerivce_4_Load": zero,
        "SubSerivce_5_Load": zero,
        "SecureBytes_Load": zero,
        "TotalLoad": F.col("l_quantity"),
        "ServerIP": F.concat(F.lit("10.1.0."), (F.col("l_suppkey") % 4).cast("string")),
        "ClientIP": F.col("l_orderkey").cast("string"),
    }
    return lineitem.select(*[cols[c].cast(_TYPES[c]).alias(c) for c in SESSION_COLUMNS])
