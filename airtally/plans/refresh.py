"""Jobs: a table's documents to normalised rows, and the marts of a day."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, date, datetime, time, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.functions.times import day_window, instant, landing_days, partition_date
from airtally.operators.games import ByCode
from airtally.plans import loads, marts, normalize, upkeep
from airtally.schemas import SILVER, partition_columns
from airtally.sinks import writers
from airtally.sources import landing, tables

DATED = {"raw_game_price": normalize.game_price, "raw_game_rating": normalize.game_rating}
UNDATED = {
    "raw_live_viewer": normalize.live_viewer,
    "raw_game_ccu": normalize.game_ccu,
    "followers": normalize.followers,
    "raw_game_review": normalize.review_flatten,
}


def transform_for(table: str, day: date) -> Callable[[DataFrame], DataFrame]:
    """The normalisation of a table; prices and ratings get their day from the job."""
    if table in DATED:
        return lambda documents: DATED[table](documents, f"{day.year}-{day.month}-{day.day}")
    return UNDATED[table]


def normalize_table(
    spark: SparkSession,
    root: str,
    table: str,
    day: date,
    *,
    hour: int | None = None,
    multiline: bool | None = None,
) -> None:
    """One day's, or hour's, documents of a table. Run again, it replaces its own folders."""
    documents = landing.read_documents(spark, root, table, first=day, hour=hour, multiline=multiline)
    rows, keys = transform_for(table, day)(documents), partition_columns(table)
    writers.overwrite_partitions(
        rows,
        tables.table_folder(root, "parquet", table),
        keys,
        sort_within=["platform"] if "platform" in rows.columns else None,
        owned=documents.select(*keys),
    )


def mart_folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/analytics/{name}"


#: The folders of a published broadcast mart: the UTC day of a stretch's start.
START_DAY = "start_day"


def publish_broadcasts(rows: DataFrame | ByCode, root: str) -> int:
    """Replace the broadcast mart as a whole, in folders by start day; rows under codes stay under them."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(instant("broadcast_start_time")) / 86_400).cast("int"))
    return writers.publish(
        rows.each(lambda df: df.withColumn(START_DAY, day)) if isinstance(rows, ByCode) else rows.withColumn(START_DAY, day),
        mart_folder(root, "anal_broadcast"),
        sort_within=["streamer_nm", "broadcast_id", "broadcast_start_time"],
        partition_by=(START_DAY,),
    )


def _published(spark: SparkSession, folder: str, started: tuple[date, date] | None = None) -> DataFrame | ByCode:
    def of_days(rows: DataFrame) -> DataFrame:
        if START_DAY not in rows.columns:
            return rows
        if started:
            rows = rows.where(F.col(START_DAY).between(F.lit(started[0]), F.lit(started[1])))
        return rows.drop(START_DAY)

    rows = tables.read_published(spark, folder)
    return rows.each(of_days) if isinstance(rows, ByCode) else of_days(rows)


def read_broadcasts(spark: SparkSession, root: str, *, started: tuple[date, date] | None = None) -> DataFrame | ByCode:
    """The broadcast mart: the version published last, under codes if it was published so, and the days added to that version since.

    `started` names the first and the last UTC day of starts that are wanted: of the version, only their
    folders are read.
    """
    folder = mart_folder(root, "anal_broadcast")
    base = tables.current_version(spark, folder)
    rows = _published(spark, folder, started) if base else None
    added = _added_days(spark, folder, base, rows)
    if rows is None or added is None:
        if rows is None and added is None:
            raise FileNotFoundError(f"no broadcasts have been written in {folder}")
        return rows if added is None else added
    return replace(rows, named=added) if isinstance(rows, ByCode) else rows.unionByName(added.select(*rows.columns))


def _added_days(spark: SparkSession, folder: str, base: tuple[int, str] | None, like: DataFrame | ByCode | None) -> DataFrame | None:
    """The days added to a version, None if there are none."""
    try:
        if isinstance(like, ByCode):
            like = like.rows.withColumnRenamed("n_game_code", "game_nm")
        reader = spark.read.schema(like.schema) if like is not None else spark.read
        return reader.parquet(_increments(folder, base))
    except AnalysisException as missing:
        if not landing.is_missing(missing):
            raise
        return None


def _increments(folder: str, base: tuple[int, str] | None) -> str:
    """Where the days added to a version lie; without a version, those before the first one."""
    return f"{folder}/increments/{f'{base[0]:08d}-{base[1]}' if base else 'none'}"


def refresh_broadcasts(
    spark: SparkSession, root: str, streamers: DataFrame, games: DataFrame, *, as_of: date, full: bool = True
) -> DataFrame:
    """The broadcast mart, by one writer of two: rebuilt as a whole, or with the last day's rows added.

    A day is a partition of the increments of the current version, so adding it
    again replaces it. Readers get both (`read_broadcasts`).
    """
    folder = mart_folder(root, "anal_broadcast")
    if full:
        live = tables.read_normalized(spark, root, "raw_live_viewer")
        publish_broadcasts(marts.broadcast_by_code(live, streamers, games, as_of=as_of), root)
    else:
        first, last = landing_days(*day_window(as_of, loads.DAY_START, loads.ZONE))
        live = tables.read_normalized(spark, root, "raw_live_viewer", first=first, last=last)
        rows = loads.broadcast_incremental(live, streamers, games, as_of=as_of)
        add_broadcasts(rows, folder, as_of)
    built = read_broadcasts(spark, root)
    return built.spelled() if isinstance(built, ByCode) else built


def add_broadcasts(rows: DataFrame, folder: str, as_of: date) -> None:
    """One day's broadcasts, in place of what that day had added before."""
    spark = rows.sparkSession
    owned = spark.createDataFrame([(as_of,)], "created_date date")
    target = _increments(folder, tables.current_version(spark, folder))
    writers.overwrite_partitions(rows, target, ["created_date"], owned=owned)


def refresh_marts(
    spark: SparkSession,
    root: str,
    streamers: DataFrame,
    games: DataFrame,
    *,
    as_of: date,
    now: datetime | None = None,
    full: bool = True,
) -> list[str]:
    """Every mart of a day; `read_built` reads them.

    Those that add up over broadcasts are kept up: a full refresh folds the new
    version anew, any other the days that it does not have yet. The others are published.
    """
    refresh_broadcasts(spark, root, streamers, games, as_of=as_of, full=full)
    keep_up(spark, root, as_of)
    ranked = [moment.astimezone(UTC).date() for moment in day_window(as_of, marts.RANK_DAY_START, marts.RANK_ZONE)]
    now = now or datetime.combine(as_of, time())

    def silver(table: str, first: date | None = None, last: date | None = None) -> DataFrame:
        return tables.read_normalized(spark, root, table, first=first, last=last)

    built = {
        "anal_game_price": marts.game_price(silver("raw_game_price"), games),
        "anal_streamer_follower_info": marts.streamer_follower_info(
            silver("followers"), streamers, as_of=as_of
        ),
        "anal_tdy_game_rating": marts.today_game_rating(
            silver("raw_game_rating", as_of), games, as_of=as_of
        ),
        "anal_week_game_viewer": marts.week_game_viewer(silver("raw_live_viewer"), streamers, games),
        "anal_ysd_game_ccu": marts.yesterday_game_ccu(
            silver("raw_game_ccu", (now - timedelta(days=1)).date(), (now + timedelta(days=1)).date()),
            games,
            now=now,
        ),
        "anal_ysd_game_rank": marts.yesterday_game_rank(
            read_broadcasts(spark, root, started=(ranked[0], ranked[1])), games, as_of=as_of
        ),
    }
    for name, rows in built.items():
        writers.publish(rows, mart_folder(root, name))
    return [*built, *upkeep.MARTS]


def kept_folder(root: str) -> str:
    return f"{root.rstrip('/')}/analytics/kept"


def keep_up(spark: SparkSession, root: str, as_of: date) -> None:
    """Bring the kept marts up to the broadcasts: the current version if it is a new one, days not folded yet, and the day of the run again."""
    folder, kept = mart_folder(root, "anal_broadcast"), kept_folder(root)
    base = tables.current_version(spark, folder)
    rows = _published(spark, folder) if base else None
    if base and f"base-{base[1]}" not in upkeep.state(spark, kept)["loads"]:
        upkeep.add_load(rows, kept, f"base-{base[1]}", replace_all=True)
    added = _added_days(spark, folder, base, rows)
    days = [r[0] for r in added.select("created_date").distinct().collect()] if added is not None else []
    done = upkeep.state(spark, kept)["loads"]
    for day in sorted(days):
        if str(day) not in done or day == as_of:
            upkeep.add_load(added.where(F.col("created_date") == F.lit(day)), kept, str(day))
    if str(as_of) in done and as_of not in days:
        upkeep.add_load(added.limit(0) if added is not None else spark.createDataFrame([], upkeep.LOAD), kept, str(as_of))


def read_built(spark: SparkSession, root: str, name: str, *, as_of: date, games: DataFrame) -> DataFrame:
    """A mart of the last refresh, kept up or published."""
    if name in upkeep.MARTS:
        return upkeep.read_kept(spark, kept_folder(root), name, as_of=as_of, games=games)
    return tables.read_mart(spark, mart_folder(root, name))


def load_raw_ccu(spark: SparkSession, root: str, load: str) -> None:
    """M14 with its target: rows past the mark of earlier loads, as one load under a name of its own.

    Loads are named so that they sort as they are run (a day, say). The same
    load run again, also after a failure, finds the same mark and takes the
    place of itself.
    """
    folder = f"{root.rstrip('/')}/raw_data/raw_game_ccu"
    source = tables.read_normalized(spark, root, "raw_game_ccu")
    target = read_raw_ccu(spark, root).where(F.col("load") < load)
    rows = loads.rows_after_mark(source, target, partition_date=partition_date())
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("year", "month", "day")
        .parquet(f"{folder}/load={load}")
    )


def read_raw_ccu(spark: SparkSession, root: str) -> DataFrame:
    """The raw copy with the name of each row's load."""
    schema = landing._with_folder_keys(SILVER["raw_game_ccu"], "raw_game_ccu").add("load", "string")
    try:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/raw_data/raw_game_ccu")
    except AnalysisException as missing:
        if landing.is_missing(missing):
            return spark.createDataFrame([], schema)
        raise
