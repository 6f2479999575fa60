"""The table work inside the collectors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.functions.texts import plain_text, trailing_numbers
from airtally.operators.lookups import attach_or_blank
from airtally.plans.normalize import FAILED_PRICE
from airtally.schemas import CHAT_FRAME

dimension_left_lookup = attach_or_blank


def select_targets(games: DataFrame, as_of: date) -> DataFrame:
    """Games to poll for players: top ones, and others until their redo date."""
    flag, redo = F.col("is_top300"), F.to_date("redo_time")
    return games.where(
        F.when(flag == "T", True).when((flag == "F") & (redo >= F.lit(as_of)), True).otherwise(False)
    ).select("game_id", "game_nm")


def tracked_games(games: DataFrame) -> DataFrame:
    """Games to poll for prices, ratings and reviews."""
    return games.where(F.col("is_top300").isin("T", "F")).select("game_id", "game_nm")


def unpivot_platform_ids(streamers: DataFrame) -> DataFrame:
    """R2: one row per streamer and platform it has an id on."""
    ids = streamers.select("streamer_id", F.col("chz_id").alias("chzzk"), F.col("afc_id").alias("afreeca"))
    long = ids.unpivot(["streamer_id"], ["chzzk", "afreeca"], "platform", "platform_id")
    return long.where(F.col("platform_id") != "")


def chzzk_live_only(answers: DataFrame) -> DataFrame:
    """Open broadcasts of the first platform."""
    return answers.where(F.col("content.status") == "OPEN")


def afreeca_live_only(statuses: DataFrame, stations: DataFrame) -> DataFrame:
    """Broadcasts of the second platform that both of its feeds say are on."""
    on = statuses.where(F.col("live_status.RESULT") != 0)
    there = stations.where(F.col("broad_info.broad").isNotNull())
    return on.join(there, ["streamer_id", "afc_s_id", "current_time"])


def merge_platforms(chzzk: DataFrame, afreeca: DataFrame) -> DataFrame:
    """Both platforms' elements in one table, told apart by `platform`.

    Rows stay rows: one document of everything would sit in one task.
    """
    return chzzk.withColumn("platform", F.lit("chzzk")).unionByName(
        afreeca.withColumn("platform", F.lit("afreeca")), allowMissingColumns=True
    )


def as_documents(chzzk: DataFrame, afreeca: DataFrame, poll: str = "current_time") -> DataFrame:
    """Landing documents, one per element, the other platform's list empty."""
    first = F.struct(*chzzk.columns)
    second = F.struct(*afreeca.columns)
    empty_first = F.array().cast(f"array<{chzzk.schema.simpleString()}>")
    empty_second = F.array().cast(f"array<{afreeca.schema.simpleString()}>")
    of_first = chzzk.select(
        poll, F.struct(F.array(first).alias("chzzk"), empty_second.alias("afreeca")).alias("stream_data")
    )
    of_second = afreeca.select(
        poll, F.struct(empty_first.alias("chzzk"), F.array(second).alias("afreeca")).alias("stream_data")
    )
    return of_first.unionByName(of_second)


# Fixed values a target without answer gets.
FAILED_PRICE_ANSWER = {"current_price": FAILED_PRICE, "is_discount": False}
FAILED_RATING_ANSWER = {
    "all_positive_num": 0,
    "all_positive_percent": 0,
    "recent_positive_num": 0,
    "recent_positive_percent": 0,
}


def fill_failed_fetch(targets: DataFrame, answers: DataFrame, key: str, constants: dict) -> DataFrame:
    """Answers, and a row of constants for each target without one.

    An empty `constants` fills nothing: a player count that failed lands no row.
    """
    if not constants:
        return answers
    missing = targets.select(key).join(answers.select(key), key, "left_anti")
    filled = missing.select(
        key, *[F.lit(v).cast(answers.schema[c].dataType).alias(c) for c, v in constants.items()]
    )
    return answers.unionByName(filled, allowMissingColumns=True)


# The class of a review summary's span and the texts that tell which it is.
_SUMMARY_SPAN = r'(?s)<span[^>]*\bclass="(?:[^"]* )?responsive_reviewdesc_short(?: [^"]*)?"[^>]*>(.*?)</span>'
_RECENT, _ALL_TIME = "Recent", "All Time"


def review_summary(pages: DataFrame, key: str = "game_id", html: str = "html") -> DataFrame:
    """Review counts and percents off a store page.

    A page without summaries, and recent figures that are not there, are zeros.
    All-time figures that are not there are NULL. Of several summaries of a
    kind the last one counts.
    """
    texts = F.transform(
        F.regexp_extract_all(F.col(html), F.lit(_SUMMARY_SPAN), F.lit(1)), lambda s: plain_text(s)
    )
    spans = pages.select(key, texts.alias("_texts"))

    def last_numbers(wanted) -> Column:
        return trailing_numbers(F.try_element_at(F.filter("_texts", wanted), F.lit(-1)))

    numbers = spans.select(
        key,
        (F.size("_texts") == 0).alias("_none"),
        last_numbers(lambda t: t.contains(_RECENT)).alias("_recent"),
        last_numbers(lambda t: ~t.contains(_RECENT) & t.contains(_ALL_TIME)).alias("_all"),
    )
    no_recent = F.coalesce(F.size("_recent"), F.lit(0)) <= 0

    def figure(column: str, at: int, zero: Column) -> Column:
        return F.when(zero, 0).otherwise(F.get(column, F.lit(at)))

    return numbers.select(
        key,
        figure("_all", 0, F.col("_none")).alias("all_positive_num"),
        figure("_all", 1, F.col("_none")).alias("all_positive_percent"),
        figure("_recent", 0, F.col("_none") | no_recent).alias("recent_positive_num"),
        figure("_recent", 1, F.col("_none") | no_recent).alias("recent_positive_percent"),
    )


def chart_links(pages: DataFrame, html: str = "html", *keep: str) -> DataFrame:
    """Name and id of each game in a page's chart table, from the third cell's link."""
    table = F.regexp_extract(F.col(html), r'(?s)<table[^>]*\bid="table-apps"[^>]*>(.*?)</table>', 1)
    body = F.regexp_extract(table, r"(?s)<tbody[^>]*>(.*)</tbody>", 1)
    rows = pages.select(*keep, F.explode(F.regexp_extract_all(body, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))).alias("_row"))
    cells = F.regexp_extract_all("_row", F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1))
    link = r'(?s)<a[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>'
    return (
        rows.select(*keep, F.get(cells, F.lit(2)).alias("_cell"))
        .where(F.regexp_like("_cell", F.lit(link)))
        .select(
            *keep,
            plain_text(F.regexp_extract("_cell", link, 2)).alias("game_nm"),
            F.get(F.split(F.regexp_extract("_cell", link, 1), "/"), F.lit(2)).alias("game_id"),
        )
    )


def update_dimension(
    dimension: DataFrame,
    fetched: DataFrame,
    key: str,
    column: str,
    *,
    order: str | None = None,
    prefix: str = "",
) -> DataFrame:
    """The dimension with `column` set where a value was fetched for its key.

    Of several values of a key the one last by `order`, then by itself, is
    taken, so no row of the dimension is multiplied.
    """
    new = (
        fetched.where(F.col(column).isNotNull())
        .groupBy(key)
        .agg((F.max_by(column, F.struct(order, column)) if order else F.max(column)).alias("_new"))
        .withColumn("_new", F.concat(F.lit(prefix), "_new"))
    )
    return (
        dimension.join(new, key, "left")
        .withColumn(column, F.coalesce("_new", column))
        .select(*dimension.columns)
    )


def chat_last_message(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """`message`, the last one in a chat frame; NULL for frames that hold none."""
    parsed = F.from_json(F.col(frame), CHAT_FRAME)
    return frames.withColumn("message", F.try_element_at(parsed["bdy"], F.lit(-1))["msg"])


def chat_split(frames: DataFrame, frame: str = "frame") -> DataFrame:
    """Parts of a chat frame; frames that are no chat are dropped.

    Frames of more than five parts give parts 1, 2 and 6. Shorter ones keep
    only `parts`.
    """
    kind = F.col("parts")[1]
    long = F.size("parts") > 5
    return (
        frames.withColumn("parts", F.split(frame, "\f"))
        .where(F.size("parts") > 1)
        .where(~kind.isin("-1", "1") & ~kind.contains("|"))
        .withColumns(
            {f"part_{i}": F.when(long, F.get("parts", F.lit(i))) for i in (1, 2, 6)}
        )
    )
