"""Regular time grids and gap filling.

A per-server grid is generated by exploding a ``sequence`` on each server row: no cross
join, and each server's grid is produced by the task that holds that server. Grid size is
bounded by the time range (65,712 hours or 2,738 days for 7.5 years), not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timegrid import DAY, add_seconds, floor_ts, grid_bounds, grid_points


def time_grid(bounds: DataFrame, begin: str, end: str, seconds: int, out: str = "Time") -> DataFrame:
    """One row per grid point for each row of ``bounds`` (which holds ``begin``/``end``).

    Day-sized grids come from one sequence. Finer grids are built in two steps, days then
    points within the day, so that after a repartition on the day rows the points are
    generated in parallel rather than all in one task.
    """
    if seconds >= DAY:
        return bounds.select(F.explode(grid_points(F.col(begin), F.col(end), seconds)).alias(out))
    lo = floor_ts(F.col(begin), seconds)
    hi = add_seconds(floor_ts(F.col(end), seconds), seconds)
    days = bounds.select(lo.alias("_lo"), hi.alias("_hi"),
                         F.explode(grid_points(F.col(begin), F.col(end), DAY)).alias("_day"))
    days = days.where(F.col("_day") <= F.col("_hi")).repartition("_day")
    start = F.greatest(F.col("_day"), F.col("_lo"))
    stop = F.least(add_seconds(F.col("_day"), DAY - seconds), F.col("_hi"))
    pts = days.select(F.explode(F.sequence(start, stop, F.make_dt_interval(secs=F.lit(seconds)))).alias(out))
    return pts


def server_grid(servers: DataFrame, begin: Column, end: Column, seconds: int,
                server: str = "ServerIP", out: str = "ts") -> DataFrame:
    """Every server x every grid point of [begin, end] (plus one bucket past the end)."""
    return servers.select(F.col(server), F.explode(grid_points(begin, end, seconds)).alias(out))


def fill_gaps(facts: DataFrame, begin: Column, end: Column, seconds: int, ts: str, server: str = "ServerIP") -> DataFrame:
    """Every server of ``facts`` x every grid point of [begin, end] (plus one bucket past the end), with
    the facts of the points that have some and NULLs in the others; facts off the range are left out.

    No grid and no join: a row brings its own point and the missing ones up to the next row, the
    first row also those before it, the last those behind it. One shuffle, by server; a server's
    rows are at most one per bucket. Gives what ``gap_fill`` gives on ``server_grid``."""
    lo, hi = grid_bounds(begin, end, seconds)
    mine = Window.partitionBy(server).orderBy(ts)
    t, following = F.col(ts), F.lead(ts).over(mine)
    first = F.row_number().over(mine) == 1
    until = F.when(following.isNull(), hi).otherwise(F.greatest(add_seconds(following, -seconds), t))
    rows = facts.withColumns({"_from": F.when(first, lo).otherwise(F.greatest(t, lo)), "_until": F.least(until, hi)})
    step = F.make_dt_interval(secs=F.lit(seconds))
    points = F.when(F.col("_from") <= F.col("_until"), F.sequence("_from", "_until", step))
    rows = rows.withColumn("_point", F.explode(points))
    kept = [F.col("_point").alias(ts) if c == ts else F.col(c) if c == server
            else F.when(F.col("_point") == t, F.col(c)).alias(c) for c in facts.columns]
    return rows.select(*kept)


def gap_fill(grid: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of facts onto a complete grid: missing buckets keep NULL measures."""
    return grid.join(facts, keys, "left")


def grid_outer_join(grid: DataFrame, rollup: DataFrame, grid_ts: str = "Time",
                    ts: str = "SessionStartFiveMin") -> DataFrame:
    """Full outer join of a global grid with per-server rows on time only.

    Buckets nobody used appear once, with a NULL server. Each time key matches at most
    one row per server, so no key is hot.
    """
    return grid.join(rollup, grid[grid_ts] == rollup[ts], "full")
