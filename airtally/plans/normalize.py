"""S1-S5 and the review table: landing documents to flat, typed rows.

Each takes documents read with their declared schema, batch or streaming, and
casts every column, so that both platforms' rows have one type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.functions.texts import price_from_text
from airtally.functions.times import collect_time_text
from airtally.schemas import SILVER

# The price landed when a fetch failed; the age from which a broadcast is for adults.
FAILED_PRICE = 999_999_999
ADULT_GRADE = 19


def _conform(df: DataFrame, table: str, keep: list[str]) -> DataFrame:
    fields = SILVER[table].fields
    return df.select(*[F.col(f.name).cast(f.dataType) for f in fields], *keep)


def _partitions(documents: DataFrame) -> list[str]:
    """Folder keys the documents were read with go along to the rows."""
    return [c for c in ("year", "month", "day", "hour") if c in documents.columns]


def _chzzk_row(element: Column) -> Column:
    content = element["content"]
    return F.struct(
        element["streamer_id"].alias("streamer_id"),
        content["liveId"].alias("broadcast_id"),
        element["current_time"].alias("live_collect_time"),
        content["liveTitle"].alias("broadcast_title"),
        content["liveCategoryValue"].alias("game_code"),
        content["concurrentUserCount"].alias("viewer_num"),
        F.lit("chzzk").alias("platform"),
    )


def _afreeca_row(element: Column) -> Column:
    status = element["live_status"]
    return F.struct(
        element["streamer_id"].alias("streamer_id"),
        status["BNO"].alias("broadcast_id"),
        element["current_time"].alias("live_collect_time"),
        status["TITLE"].alias("broadcast_title"),
        status["CATE"].alias("game_code"),
        element["broad_info"]["broad"]["current_sum_viewer"].alias("viewer_num"),
        F.lit("afreeca").alias("platform"),
    )


def live_viewer(documents: DataFrame) -> DataFrame:
    """Both platforms' live rows, adult broadcasts and those of unknown grade dropped.

    The two lists of a document become one before it is exploded: a union of
    two explodes would read and parse every document twice.
    """
    keep = _partitions(documents)
    first = F.filter("stream_data.chzzk", lambda e: ~e["content"]["adult"])
    second = F.filter(
        "stream_data.afreeca", lambda e: e["broad_info"]["broad"]["broad_grade"] < ADULT_GRADE
    )
    both = F.concat(
        F.coalesce(F.transform(first, _chzzk_row), F.array()),
        F.coalesce(F.transform(second, _afreeca_row), F.array()),
    )
    rows = documents.select(F.explode(both).alias("_e"), *keep).select("_e.*", *keep)
    return _conform(rows, "raw_live_viewer", keep)


def game_ccu(documents: DataFrame) -> DataFrame:
    """The document's collect time goes to every game in it; one that can't be read is NULL."""
    keep = _partitions(documents)
    rows = documents.select(F.explode("raw_game_ccu").alias("_e"), "collect_time", *keep).select(
        F.col("_e.game_id").alias("game_id"),
        collect_time_text("collect_time").alias("collect_time"),
        F.col("_e.player_count").alias("game_ccu"),
        *keep,
    )
    return _conform(rows, "raw_game_ccu", keep)


def unreadable_times(documents: DataFrame) -> DataFrame:
    """The games whose document has a collect time that S2 could not read, for a look at by hand."""
    return (
        documents.where(F.col("collect_time").isNotNull() & collect_time_text("collect_time").isNull())
        .select(F.explode("raw_game_ccu").alias("_e"), "collect_time")
        .select(F.col("_e.game_id").cast("string").alias("game_id"), F.col("collect_time").alias("time_text"))
    )


def game_price(documents: DataFrame, collect_date: str, *, drop_failed: bool = False) -> DataFrame:
    """S3. `collect_date` is the job's argument, as `2024-1-5`.

    Text that is no price gives NULL. A percent missing from a price block
    counts as a discount. `drop_failed` drops the price a failed fetch lands.
    """
    keep = _partitions(documents)
    block = F.col("_e.data.price_overview")
    text = F.col("_e.data.price_overview.final_formatted")
    percent = F.col("_e.data.price_overview.discount_percent")
    rows = documents.select(F.explode("raw_game_price").alias("_e"), *keep).select(
        F.col("_e.data.steam_appid").alias("game_id"),
        F.to_date(F.lit(collect_date), "yyyy-M-d").alias("collect_date"),
        F.when(text.isNull(), 0).otherwise(price_from_text(text)).alias("current_price"),
        (block.isNotNull() & ~F.coalesce(percent == 0, F.lit(False))).alias("is_discount"),
        *keep,
    )
    if drop_failed:
        rows = rows.where(F.coalesce(F.col("current_price") != FAILED_PRICE, F.lit(True)))
    return _conform(rows, "raw_game_price", keep)


def unreadable_prices(documents: DataFrame) -> DataFrame:
    """The elements whose price text S3 could not read, for a look at by hand."""
    text = F.col("_e.data.price_overview.final_formatted")
    return (
        documents.select(F.explode("raw_game_price").alias("_e"))
        .where(text.isNotNull() & price_from_text(text).isNull())
        .select(F.col("_e.data.steam_appid").cast("string").alias("game_id"), text.alias("price_text"))
    )


def game_rating(documents: DataFrame, collect_date: str) -> DataFrame:
    """S4."""
    keep = _partitions(documents)
    rows = documents.select(F.explode("raw_game_rating").alias("_e"), *keep).select(
        "_e.game_id",
        F.to_date(F.lit(collect_date), "yyyy-M-d").alias("collect_date"),
        "_e.recent_positive_num",
        "_e.recent_positive_percent",
        "_e.all_positive_num",
        "_e.all_positive_percent",
        *keep,
    )
    return _conform(rows, "raw_game_rating", keep)


def followers(documents: DataFrame, on: tuple[str, ...] = ("streamer_id", "collect_time")) -> DataFrame:
    """Both platforms' counts of a streamer side by side.

    By default a poll's row meets the same poll's row. With
    `on=("streamer_id",)` every row of a streamer meets every row of the other
    platform: the same over one poll, and n * m rows over a day of hourly ones.
    A full join of the two sides, done by one explode and one grouping, so that
    documents are read and parsed once.
    """
    keep = _partitions(documents)
    kind = SILVER["followers"]["chz_follower_num"].dataType

    def tagged(side: str, count: str):
        def row(element: Column) -> Column:
            value = element
            for name in count.split("."):
                value = value[name]
            return F.struct(
                F.lit(side).alias("side"),
                element["streamer_id"].cast("string").alias("streamer_id"),
                element["current_time"].alias("time"),
                value.cast(kind).alias("n"),
            )

        return F.coalesce(F.transform(f"stream_data.{side}", row), F.array())

    both = F.concat(tagged("chzzk", "content.followerCount"), tagged("afreeca", "broad_info.station.upd.fan_cnt"))
    rows = documents.select(F.explode(both).alias("_e"), *keep).select("_e.*", *keep)
    keys = ["streamer_id", *keep]
    if "collect_time" in on:
        keys = [*keys, "_poll"]
        rows = rows.withColumn("_poll", F.col("time"))
    # Rows without key meet nothing, and are not brought together either.
    spread = F.when(F.concat(*[F.col(k).cast("string") for k in keys]).isNull(), F.xxhash64(*rows.columns))
    keys = [*keys, "_spread"]

    def of(side: str) -> Column:
        return F.collect_list(F.when(F.col("side") == side, F.struct("time", "n")))

    met = rows.withColumn("_spread", spread).groupBy(*keys).agg(of("chzzk").alias("_a"), of("afreeca").alias("_b"))
    pairs = met.select(*keys, F.explode_outer("_a").alias("_a"), "_b").select(*keys, "_a", F.explode_outer("_b").alias("_b"))
    joined = pairs.select(
        "streamer_id",
        F.when(F.col("_a.time") != "", F.col("_a.time")).otherwise(F.col("_b.time")).alias("collect_time"),
        F.col("_a.n").alias("chz_follower_num"),
        F.col("_b.n").alias("afc_follower_num"),
        *keep,
    )
    return _conform(joined, "followers", keep)


def review_flatten(documents: DataFrame) -> DataFrame:
    """One row per review. A game's id lands as a list of one; failed fetches as NULL."""
    keep = _partitions(documents)
    rows = (
        documents.select(F.explode("raw_game_review").alias("_g"), *keep)
        .select(F.get("_g.game_id", F.lit(0)).alias("game_id"), F.explode("_g.reviews").alias("_r"), *keep)
        .select(
            "game_id",
            F.col("_r.recommendationid").alias("review_id"),
            F.col("_r.author.steamid").alias("author_id"),
            F.col("_r.review").alias("review"),
            F.col("_r.voted_up").alias("voted_up"),
            *keep,
        )
    )
    return _conform(rows, "raw_game_review", keep)
