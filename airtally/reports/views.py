"""The driver's tables seen as the model's tables.

Every view is made of whole tables; remainders and cases only choose what a
row stands for. `oracles.py` has the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.schemas import LANDING


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`part` as the game dimension. Neighbours of one type share a name; some have one code, or none."""
    return table(spark, sf_dir, "part").selectExpr(
        "cast(p_partkey as string) game_id",
        "concat(p_type, ' ', cast(p_partkey div 2 as string)) game_nm",
        "case p_size % 3 when 0 then 'T' when 1 then 'F' else 'N' end is_top300",
        "date_add(date'2024-01-01', p_size) redo_time",
        "concat('https://img.example.com/', p_partkey) game_banner_url",
        "case p_partkey % 7 when 1 then '' when 3 then null else concat('G', p_partkey) end chz_game_code",
        "case when p_partkey % 500 = 1 then '' when p_partkey % 5 = 2 then null else cast(p_partkey as string) end afc_game_code",
        "cast(round(p_retailprice * 100) as int) price",
    )


def streamers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`supplier` as the streamer dimension. Pairs share a name, and streamer 0 is unknown."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey + 1 as string) streamer_id",
        "concat('S', (s_suppkey + 1) div 2) streamer_nm",
        "case s_nationkey % 3 when 0 then '' when 1 then null else concat('c', s_suppkey) end chz_id",
        "case when s_acctbal < 1000 then null else concat('a', s_suppkey) end afc_id",
        "concat('https://chz.example.com/', s_suppkey) chz_banner_url",
        "concat('https://afc.example.com/', s_suppkey) afc_banner_url",
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as live snapshots: a supplier's year is a broadcast, the line number picks a kind of code."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_suppkey as string) streamer_id",
        "case when l_quantity < 50 then concat(l_suppkey, '-', year(l_shipdate)) end broadcast_id",
        "case l_linestatus when 'O' then 'chzzk' else 'afreeca' end platform",
        "concat(l_returnflag, l_linestatus, l_linenumber) broadcast_title",
        "cast(l_quantity as int) viewer_num",
        """case l_linenumber when 1 then null when 2 then '' when 3 then 'talk'
             when 4 then concat('000', l_partkey) when 5 then concat('G', l_partkey)
             when 6 then concat('0', l_partkey % 10) else concat('X', l_returnflag) end game_code""",
        "l_shipdate + make_dt_interval(0, l_linenumber) live_collect_time",
        "year(l_shipdate) year",
        "month(l_shipdate) month",
        "day(l_shipdate) day",
        "cast(l_linenumber as string) hour",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as daily prices: the part's list price less the line's discount, in whole cents."""
    listed = games(spark, sf_dir).select("game_id", "price")
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_partkey as string) game_id",
        "to_date(l_shipdate) collect_date",
        "cast(round(l_discount * 100) as int) percent",
        "l_discount > 0 is_discount",
    )
    return lines.join(listed, "game_id").selectExpr(
        "game_id", "collect_date", "cast(price * (100 - percent) div 100 as int) current_price", "is_discount"
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`orders` as daily ratings."""
    return table(spark, sf_dir, "orders").selectExpr(
        "cast(o_custkey as string) game_id",
        "to_date(o_orderdate) collect_date",
        "cast(o_orderkey % 97 as int) recent_positive_num",
        "cast(o_orderkey % 89 as int) recent_positive_percent",
        "cast(o_orderkey % 1009 as int) all_positive_num",
        "cast(o_orderkey % 101 as int) all_positive_percent",
    )


def ccu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as player counts."""
    return table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) game_id",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+09:00'\") collect_time",
        "cast(floor(value) as int) game_ccu",
        "year(ts) year",
        "month(ts) month",
        "day(ts) day",
        "hour(ts) hour",
    )


def event_sessions_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as snapshots at times of their own."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id", "event_type", "ts", "cast(floor(value) as bigint) viewers"
    )


# --- landing documents, through JSON text and back -----------------------------


def _parsed(documents: DataFrame, name: str) -> DataFrame:
    columns = F.struct(*documents.columns)
    return documents.select(F.from_json(F.to_json(columns), LANDING[name]).alias("_d")).select("_d.*")


def live_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per event: both platforms, none or one of them, adult flags true, false and missing."""
    documents = table(spark, sf_dir, "events").selectExpr(
        """named_struct(
          'chzzk', case when event_id % 4 = 0 then array() else array(named_struct(
              'streamer_id', cast(user_id as string), 'chzzk_s_id', concat('c', user_id),
              'current_time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+09:00'"),
              'content', named_struct('status', 'OPEN',
                 'adult', case event_id % 5 when 0 then true when 1 then null else false end,
                 'liveId', event_id, 'liveTitle', props, 'liveCategoryValue', event_type,
                 'concurrentUserCount', cast(floor(value) as int)))) end,
          'afreeca', case when event_id % 3 = 0 then null else array(named_struct(
              'streamer_id', cast(user_id as string), 'afc_s_id', concat('a', user_id),
              'current_time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+09:00'"),
              'live_status', named_struct('RESULT', 1, 'BNO', concat('b', event_id), 'TITLE', props,
                                          'CATE', concat('000', event_id % 7)),
              'broad_info', named_struct('broad', named_struct(
                  'broad_grade', case event_id % 6 when 0 then 19 when 1 then null else 0 end,
                  'current_sum_viewer', cast(floor(value) as int) + 1)))) end) stream_data"""
    )
    return _parsed(documents, "raw_live_viewer")


def ccu_documents(spark: SparkSession, sf_dir: str, unreadable: bool = False) -> DataFrame:
    """A document per event, of two games, its time parts not padded; some times are no times if asked for."""
    time = "date_format(ts, 'yyyy-M-d H:m')"
    documents = table(spark, sf_dir, "events").selectExpr(
        f"case when user_id % 11 = 3 then 'bad' else {time} end collect_time" if unreadable else f"{time} collect_time",
        """array(named_struct('player_count', cast(floor(value) as int), 'result', 1, 'game_id', user_id),
                 named_struct('player_count', cast(floor(value) as int) + 1, 'result', 1,
                              'game_id', user_id + 1000000)) raw_game_ccu""",
    )
    return _parsed(documents, "raw_game_ccu")


def price_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per order: no price block, no text, text that is no price, prices with separators."""
    documents = table(spark, sf_dir, "orders").selectExpr(
        """array(named_struct('success', true, 'data', named_struct('steam_appid', o_orderkey,
             'price_overview', case when o_orderkey % 5 = 0 then null else named_struct(
                'final', cast(floor(o_totalprice) as bigint), 'initial', cast(floor(o_totalprice) as bigint),
                'discount_percent', case o_orderkey % 3 when 0 then 0 when 1 then null else 30 end,
                'final_formatted', case o_orderkey % 7 when 0 then null when 1 then 'Free'
                    else concat('₩ ', format_number(floor(o_totalprice), 0)) end) end))) raw_game_price"""
    )
    return _parsed(documents, "raw_game_price")


def rating_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per order; numeric ids, recent figures missing from some."""
    documents = table(spark, sf_dir, "orders").selectExpr(
        """array(named_struct('game_id', o_orderkey, 'all_positive_num', cast(o_orderkey % 1009 as int),
             'all_positive_percent', cast(o_orderkey % 101 as int),
             'recent_positive_num', case when o_orderkey % 4 > 0 then cast(o_orderkey % 97 as int) end,
             'recent_positive_percent', case when o_orderkey % 4 > 0 then cast(o_orderkey % 89 as int) end))
           raw_game_rating"""
    )
    return _parsed(documents, "raw_game_rating")


def follower_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per event: clicks and views hold the first platform's count, all but clicks the second's."""
    documents = table(spark, sf_dir, "events").selectExpr(
        """named_struct(
          'chzzk', case when event_type in ('click', 'view') then array(named_struct(
              'streamer_id', cast(user_id as string), 'chzzk_s_id', concat('c', user_id),
              'current_time', cast(ts as string),
              'content', named_struct('followerCount', cast(floor(value * 100) as int)))) else array() end,
          'afreeca', case when event_type <> 'click' then array(named_struct(
              'streamer_id', cast(user_id as string), 'afc_s_id', concat('a', user_id),
              'current_time', cast(ts as string),
              'broad_info', named_struct('station', named_struct('upd', named_struct(
                  'fan_cnt', cast(floor(value * 100) as int) + 7))))) else array() end) stream_data"""
    )
    return _parsed(documents, "followers")


def review_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document per text: one review of it, and the mark of a failed fetch after it."""
    texts = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    documents = texts.selectExpr(
        """array(named_struct('game_id', array(source), 'reviews', array(named_struct(
              'recommendationid', cast(doc_id as string), 'author', named_struct('steamid', lang),
              'review', text, 'voted_up', quality = 1))), null) raw_game_review"""
    )
    return _parsed(documents, "raw_game_review")


# --- pages and chat ------------------------------------------------------------


def store_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` with review summaries put after them: both, the all-time one, or none."""
    return table(spark, sf_dir, "pages").selectExpr(
        "page_id game_id",
        """concat(html,
            case when page_id % 7 = 0 or page_id % 3 = 0 then '' else concat(
              '<span class="game_area responsive_reviewdesc_short">(', page_id % 100, '% of the&#160;',
              format_number(page_id * 1237 + 5, 0), ')&nbsp;Recent</span>') end,
            case when page_id % 7 = 0 then '' else concat(
              '<span class="responsive_reviewdesc_short">\n(', page_id % 101, '% of ',
              format_number(page_id * 99991 + 12, 0), ') All Time</span>') end) html""",
    )


def chart_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`pages` with their navigation links as a chart table, link in the third cell, references in the names."""
    nav = F.regexp_extract("html", "(?s)<nav>(.*?)</nav>", 1)
    rows = F.regexp_replace(
        nav,
        r'<li><a href="(/[^"]*)">([^<]*)</a></li>',
        '<tr class="app"><td>1</td><td></td><td><a href="/app$1/"> $2&#039;s &amp;lt; &eacute;&#x2122;&nbsp;&nope; </a></td></tr>',
    )
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(
            F.col("html"),
            F.lit('<table id="table-apps"><thead><tr><td>#</td></tr></thead><tbody>'),
            rows,
            F.lit("</tbody></table>"),
        ).alias("html"),
    )


def chat_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` as JSON chat frames: whole, with an empty list, without one, and no JSON."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """case turn % 5 when 0 then concat('not json ', role) when 1 then '{"bdy":[]}' when 2 then '{"cmd":1}'
             else to_json(named_struct('bdy', array(named_struct('msg', role), named_struct('msg', text)))) end frame""",
    )


def split_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` as form-feed separated chat frames: of a dropped kind, short, and whole."""
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id",
        "turn",
        """concat_ws(char(12), 'head',
             case turn % 6 when 0 then '-1' when 1 then '1' when 2 then 'a|b' else concat('m', turn) end,
             cast(conv_id as string), 'x',
             case when turn % 4 = 3 then null else concat_ws(char(12), 'y', 'z', text) end) frame""",
    )
