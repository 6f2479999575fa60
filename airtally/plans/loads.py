"""Incremental loads."""

from __future__ import annotations

from datetime import date, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.functions.times import day_window, instant_literal, landing_days, within_days
from airtally.plans.marts import BROADCAST, broadcast_columns, live_facts, with_names


# When the incremental load's day starts, and on which clock.
DAY_START = time(6)
ZONE = "UTC"


def broadcast_incremental(
    live: DataFrame,
    streamers: DataFrame,
    games: DataFrame,
    *,
    as_of: date,
    day_start: time = DAY_START,
    zone: str = ZONE,
) -> DataFrame:
    """M2: the broadcast mart's rows of one day, both ends left out.

    A row per streamer, broadcast, game name and platform: stretches of a game
    are one row, and all codes without a game are one row under the largest of
    them. So session numbers play no part, and only the day's folders are read.
    """
    start, end = day_window(as_of, day_start, zone)
    facts = live_facts(within_days(live, *landing_days(start, end)))
    facts = facts.where(
        (F.col("parsed_time") > instant_literal(start)) & (F.col("parsed_time") < instant_literal(end))
    )
    folded = facts.groupBy("streamer_id", "broadcast_id", "n_game_code", "platform").agg(
        F.min("broadcast_title").alias("broadcast_title"),
        F.max("viewer_num").alias("max_viewer_num"),
        F.sum("viewer_num").alias("_viewers"),
        F.count("viewer_num").alias("_snapshots"),
        F.min("parsed_time").alias("session_start"),
        F.max("parsed_time").alias("session_end"),
    )
    game_nm = F.coalesce("dim_game_nm", F.max("n_game_code"))
    return (
        with_names(folded, streamers, games)
        .groupBy("streamer_nm", "broadcast_id", "dim_game_nm", "platform")
        .agg(game_nm.alias("game_nm"), *broadcast_columns(as_of))
        .select(*BROADCAST)
    )


def rows_after_mark(
    source: DataFrame,
    target: DataFrame,
    column: str = "collect_time",
    *,
    bootstrap: bool = True,
    partition_date: Column | None = None,
) -> DataFrame:
    """Source rows past the largest `column` of the target.

    An empty target has no mark; `bootstrap` then takes every row, otherwise
    none passes. The mark is a scalar subquery, read when the query runs.
    `partition_date`, the day of a row's folder on the clock that `column` is in,
    prunes both sides: the mark is looked for in the target's last folder only,
    which needs the folders' names, and the source's folders before it are not
    read.
    """
    newest = None
    if partition_date is not None:
        newest = target.agg(F.max(partition_date)).scalar()
        target = target.where(partition_date == newest)
    mark = target.agg(F.max(column)).scalar()
    passes = [F.col(column) > mark]
    if newest is not None:
        passes.append(partition_date >= newest)
    for condition in passes:
        source = source.where(condition | mark.isNull() if bootstrap else condition)
    return source
