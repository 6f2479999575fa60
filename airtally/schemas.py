"""Declared schemas of landing documents, normalised tables and dimensions.

Reads never infer: a platform with nobody live lands an empty array, whose
inferred element type has no fields.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

STRING, INT, LONG = StringType(), IntegerType(), LongType()
BOOLEAN, DATE, TIMESTAMP = BooleanType(), DateType(), TimestampType()


def struct(**fields: DataType) -> StructType:
    out = StructType()
    for name, kind in fields.items():
        out = out.add(name, kind)
    return out


# --- one feed per platform, before they are put in one document ----------------

_CHZZK = {"streamer_id": STRING, "chzzk_s_id": STRING, "current_time": STRING}
_AFREECA = {"streamer_id": STRING, "afc_s_id": STRING, "current_time": STRING}
_STATUS = struct(RESULT=INT, BNO=STRING, TITLE=STRING, CATE=STRING)
_BROAD = struct(broad=struct(broad_grade=INT, current_sum_viewer=INT))

FEEDS = {
    "chzzk_live": struct(
        **_CHZZK,
        content=struct(
            status=STRING,
            adult=BOOLEAN,
            liveId=STRING,
            liveTitle=STRING,
            liveCategoryValue=STRING,
            concurrentUserCount=INT,
        ),
    ),
    "afreeca_live_status": struct(**_AFREECA, live_status=_STATUS),
    "afreeca_broad_info": struct(**_AFREECA, broad_info=_BROAD),
    "afreeca_live": struct(**_AFREECA, live_status=_STATUS, broad_info=_BROAD),
    "chzzk_followers": struct(**_CHZZK, content=struct(followerCount=INT)),
    "afreeca_followers": struct(
        **_AFREECA, broad_info=struct(station=struct(upd=struct(fan_cnt=INT)))
    ),
}

# --- landing documents ----------------------------------------------------------


def _both(chzzk: str, afreeca: str) -> StructType:
    return struct(stream_data=struct(chzzk=ArrayType(FEEDS[chzzk]), afreeca=ArrayType(FEEDS[afreeca])))


_PRICE_BLOCK = struct(final=LONG, initial=LONG, discount_percent=INT, final_formatted=STRING)
_REVIEW = struct(recommendationid=STRING, author=struct(steamid=STRING), review=STRING, voted_up=BOOLEAN)

LANDING = {
    "raw_live_viewer": _both("chzzk_live", "afreeca_live"),
    "followers": _both("chzzk_followers", "afreeca_followers"),
    "raw_game_ccu": struct(
        collect_time=STRING,
        raw_game_ccu=ArrayType(struct(player_count=INT, result=INT, game_id=STRING)),
    ),
    "raw_game_price": struct(
        raw_game_price=ArrayType(
            struct(success=BOOLEAN, data=struct(steam_appid=LONG, price_overview=_PRICE_BLOCK))
        )
    ),
    "raw_game_rating": struct(
        raw_game_rating=ArrayType(
            struct(
                game_id=STRING,
                all_positive_num=INT,
                all_positive_percent=INT,
                recent_positive_num=INT,
                recent_positive_percent=INT,
            )
        )
    ),
    "raw_game_review": struct(
        raw_game_review=ArrayType(struct(game_id=ArrayType(STRING), reviews=ArrayType(_REVIEW)))
    ),
}

# Pretty-printed by their collectors, so a document spans lines.
MULTILINE = {"raw_live_viewer", "followers"}

CHAT_FRAME = struct(bdy=ArrayType(struct(msg=STRING)))

# --- normalised tables ------------------------------------------------------------

SILVER = {
    "raw_live_viewer": struct(
        streamer_id=STRING,
        broadcast_id=STRING,
        live_collect_time=STRING,
        broadcast_title=STRING,
        game_code=STRING,
        viewer_num=INT,
        platform=STRING,
    ),
    "raw_game_ccu": struct(game_id=STRING, collect_time=STRING, game_ccu=INT),
    "raw_game_price": struct(game_id=STRING, collect_date=DATE, current_price=INT, is_discount=BOOLEAN),
    "raw_game_rating": struct(
        game_id=STRING,
        collect_date=DATE,
        recent_positive_num=INT,
        recent_positive_percent=INT,
        all_positive_num=INT,
        all_positive_percent=INT,
    ),
    "followers": struct(
        streamer_id=STRING, collect_time=STRING, chz_follower_num=INT, afc_follower_num=INT
    ),
    "raw_game_review": struct(
        game_id=STRING, review_id=STRING, author_id=STRING, review=STRING, voted_up=BOOLEAN
    ),
}

HOURLY = {"raw_live_viewer", "raw_game_ccu"}


def partition_columns(table: str) -> list[str]:
    """The keys a table's folders are named by."""
    return ["year", "month", "day", "hour"] if table in HOURLY else ["year", "month", "day"]


# --- dimensions ---------------------------------------------------------------------

GAME_INFO = struct(
    game_id=STRING,
    game_nm=STRING,
    is_top300=STRING,
    redo_time=TIMESTAMP,
    game_banner_url=STRING,
    chz_game_code=STRING,
    afc_game_code=STRING,
    price=INT,
)
STREAMER_INFO = struct(
    streamer_id=STRING,
    streamer_nm=STRING,
    chz_id=STRING,
    afc_id=STRING,
    chz_banner_url=STRING,
    afc_banner_url=STRING,
)
