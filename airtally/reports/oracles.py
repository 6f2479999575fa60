"""The registered queries in SQL, written from the queries' meaning.

`{name}` stands for a view of the same name in VIEWS; views may use others.
"""

from __future__ import annotations

import re

TIME = "'%Y-%m-%d %H:%M:%S.%f'"

VIEWS = {
    "games": """
        SELECT CAST(p_partkey AS VARCHAR) AS game_id, p_type || ' ' || (p_partkey // 2) AS game_nm,
               CASE p_size % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' ELSE 'N' END AS is_top300,
               DATE '2024-01-01' + p_size AS redo_time,
               'https://img.example.com/' || p_partkey AS game_banner_url,
               CASE p_partkey % 7 WHEN 1 THEN '' WHEN 3 THEN NULL ELSE 'G' || p_partkey END AS chz_game_code,
               CASE WHEN p_partkey % 500 = 1 THEN '' WHEN p_partkey % 5 = 2 THEN NULL
                    ELSE CAST(p_partkey AS VARCHAR) END AS afc_game_code,
               CAST(round(p_retailprice * 100) AS BIGINT) AS price
        FROM part""",
    "streamers": """
        SELECT CAST(s_suppkey + 1 AS VARCHAR) AS streamer_id, 'S' || ((s_suppkey + 1) // 2) AS streamer_nm,
               CASE s_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'c' || s_suppkey END AS chz_id,
               CASE WHEN s_acctbal < 1000 THEN NULL ELSE 'a' || s_suppkey END AS afc_id,
               'https://chz.example.com/' || s_suppkey AS chz_banner_url,
               'https://afc.example.com/' || s_suppkey AS afc_banner_url
        FROM supplier""",
    "live": """
        SELECT CAST(l_suppkey AS VARCHAR) AS streamer_id,
               CASE WHEN l_quantity < 50 THEN l_suppkey || '-' || year(l_shipdate) END AS broadcast_id,
               CASE l_linestatus WHEN 'O' THEN 'chzzk' ELSE 'afreeca' END AS platform,
               l_returnflag || l_linestatus || l_linenumber AS broadcast_title,
               CAST(l_quantity AS BIGINT) AS viewer_num,
               CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN 'talk'
                 WHEN 4 THEN '000' || l_partkey WHEN 5 THEN 'G' || l_partkey
                 WHEN 6 THEN '0' || (l_partkey % 10) ELSE 'X' || l_returnflag END AS game_code,
               l_shipdate + to_hours(l_linenumber) AS live_collect_time,
               year(l_shipdate) AS year, month(l_shipdate) AS month, day(l_shipdate) AS day,
               l_linenumber AS hour
        FROM lineitem""",
    "prices": """
        SELECT game_id, CAST(l_shipdate AS DATE) AS collect_date,
               price * (100 - CAST(round(l_discount * 100) AS BIGINT)) // 100 AS current_price
        FROM lineitem JOIN {games} ON game_id = CAST(l_partkey AS VARCHAR)""",
    "ratings": """
        SELECT CAST(o_custkey AS VARCHAR) AS game_id, CAST(o_orderdate AS DATE) AS collect_date,
               o_orderkey % 97 AS recent_positive_num, o_orderkey % 89 AS recent_positive_percent,
               o_orderkey % 1009 AS all_positive_num, o_orderkey % 101 AS all_positive_percent
        FROM orders""",
    "ccu": """
        SELECT CAST(user_id AS VARCHAR) AS game_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS collect_time,
               date_trunc('second', ts) AS wall, CAST(floor(value) AS BIGINT) AS game_ccu,
               year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour
        FROM events""",
    "marked": """
        SELECT *, COALESCE(NULLIF(game_code, ''), 'talk') AS n_game_code,
               CASE WHEN live_collect_time - INTERVAL 30 DAY > LAG(live_collect_time) OVER (
                      PARTITION BY streamer_id, broadcast_id, game_code ORDER BY live_collect_time)
                    THEN 1 ELSE 0 END AS starts
        FROM {live} WHERE broadcast_id IS NOT NULL""",
    "numbered": """
        SELECT *, SUM(starts) OVER (PARTITION BY streamer_id, broadcast_id, n_game_code
                                    ORDER BY live_collect_time, game_code NULLS FIRST) AS group_id
        FROM {marked}""",
    "named": """
        SELECT n.*, s.streamer_nm, g.game_nm
        FROM {numbered} n
        LEFT JOIN {streamers} s ON n.streamer_id = s.streamer_id
        LEFT JOIN {games} g ON n.n_game_code = g.chz_game_code OR ltrim(n.n_game_code, '0') = g.afc_game_code""",
    "broadcast": """
        SELECT streamer_nm, broadcast_id, COALESCE(game_nm, n_game_code) AS game_nm, platform,
               MIN(broadcast_title) AS broadcast_title, MAX(viewer_num) AS max_viewer_num,
               CAST(SUM(viewer_num) // COUNT(viewer_num) AS BIGINT) AS avg_viewer_num,
               MIN(live_collect_time) AS broadcast_start_time, MAX(live_collect_time) AS broadcast_end_time,
               date_diff('second', MIN(live_collect_time), MAX(live_collect_time)) / 60.0::DOUBLE AS game_duration
        FROM {named}
        GROUP BY streamer_nm, broadcast_id, named.game_nm, platform, group_id, n_game_code""",
    "played": """
        SELECT * FROM {broadcast} WHERE game_nm NOT IN ('talk', '-', 'Virtual', '종합 게임')""",
    "grown": """
        SELECT streamer_nm, broadcast_id, game_nm, platform, max_viewer_num, avg_viewer_num, game_duration FROM {broadcast}
        UNION ALL
        SELECT streamer_nm, broadcast_id, COALESCE(game_nm, MAX(n_game_code)), platform, MAX(viewer_num),
               CAST(SUM(viewer_num) // COUNT(viewer_num) AS BIGINT),
               date_diff('second', MIN(live_collect_time), MAX(live_collect_time)) / 60.0::DOUBLE
        FROM {named} m
        WHERE live_collect_time > TIMESTAMP '1999-06-14 06:00:00' AND live_collect_time < TIMESTAMP '1999-06-15 06:00:00'
        GROUP BY streamer_nm, broadcast_id, m.game_nm, platform""",
    "grown_played": """
        SELECT * FROM {grown} WHERE game_nm NOT IN ('talk', '-', 'Virtual', '종합 게임')""",
    "follower_rows": """
        SELECT COALESCE(c.user_id, a.user_id) AS streamer_id, COALESCE(c.ts, a.ts) AS collect_time,
               c.n AS chz_follower_num, a.n + 7 AS afc_follower_num
        FROM (SELECT user_id, ts, CAST(floor(value * 100) AS BIGINT) AS n FROM events
              WHERE event_type IN ('click', 'view')) c
        FULL JOIN (SELECT user_id, ts, CAST(floor(value * 100) AS BIGINT) AS n FROM events
              WHERE event_type <> 'click') a ON c.user_id = a.user_id AND c.ts = a.ts""",
    "afreeca_rows": """
        SELECT CAST(user_id AS VARCHAR) AS streamer_id, 'b' || event_id AS broadcast_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS live_collect_time, props AS broadcast_title,
               '000' || (event_id % 7) AS game_code, CAST(floor(value) AS BIGINT) + 1 AS viewer_num,
               'afreeca' AS platform
        FROM events WHERE event_id % 3 <> 0 AND event_id % 6 NOT IN (0, 1)""",
    "chzzk_rows": """
        SELECT CAST(user_id AS VARCHAR) AS streamer_id, CAST(event_id AS VARCHAR) AS broadcast_id,
               strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS live_collect_time, props AS broadcast_title,
               event_type AS game_code, CAST(floor(value) AS BIGINT) AS viewer_num, 'chzzk' AS platform
        FROM events WHERE event_id % 4 <> 0 AND event_id % 5 NOT IN (0, 1)""",
    "price_change": """
        SELECT game_nm, collect_date AS modified_date, current_price
        FROM (SELECT *, LAG(current_price) OVER (
                       PARTITION BY game_nm ORDER BY collect_date, current_price, price) AS prev_price
              FROM (SELECT DISTINCT g.game_nm, g.price, p.collect_date, p.current_price
                    FROM {prices} p JOIN {games} g ON p.game_id = g.game_id) days) steps
        WHERE (current_price < price AND (prev_price = price OR prev_price IS NULL))
           OR (current_price = price AND prev_price < price)""",
    "timely_price_change": """
        SELECT game_nm, collect_date AS modified_date, current_price
        FROM (SELECT *, LAG(current_price) OVER (
                       PARTITION BY game_nm ORDER BY collect_date, current_price, price) AS prev_price
              FROM (SELECT DISTINCT g.game_nm, g.price, p.collect_date, p.current_price
                    FROM {prices} p JOIN {games} g ON p.game_id = g.game_id
                    WHERE p.collect_date NOT BETWEEN DATE '1995-03-01' AND DATE '1995-03-07') days) steps
        WHERE (current_price < price AND (prev_price = price OR prev_price IS NULL))
           OR (current_price = price AND prev_price < price)""",
    "event_sessions": """
        SELECT user_id, event_type, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS snapshots,
               MAX(viewers) AS max_viewers, CAST(SUM(viewers) AS BIGINT) AS viewers
        FROM (SELECT *, SUM(starts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS group_id
              FROM (SELECT *, CAST(floor(value) AS BIGINT) AS viewers,
                           CASE WHEN ts - INTERVAL 24 HOUR > LAG(ts) OVER (
                                  PARTITION BY user_id, event_type ORDER BY ts) THEN 1 ELSE 0 END AS starts
                    FROM events) steps) numbered
        GROUP BY user_id, event_type, group_id""",
}

_BROADCAST_SHOWN = f"""streamer_nm, broadcast_id, game_nm, platform, broadcast_title,
        CAST(max_viewer_num AS BIGINT) AS max_viewer_num, avg_viewer_num,
        strftime(broadcast_start_time, {TIME}) AS broadcast_start_time,
        strftime(broadcast_end_time, {TIME}) AS broadcast_end_time, game_duration"""

_EVENT_SESSIONS = f"""
    SELECT user_id, event_type, strftime(session_start, {TIME}) AS session_start,
           strftime(session_end, {TIME}) AS session_end, snapshots, max_viewers, viewers FROM {{event_sessions}}"""

_CCU_ROWS = """
    SELECT game_id, strftime(ts, '%Y-%m-%dT%H:%M') || ':00+09:00' AS collect_time, game_ccu FROM (
      SELECT CAST(user_id AS VARCHAR) AS game_id, ts, CAST(floor(value) AS BIGINT) AS game_ccu FROM events
      UNION ALL
      SELECT CAST(user_id + 1000000 AS VARCHAR), ts, CAST(floor(value) AS BIGINT) + 1 FROM events) pair"""

_LIVE_ROWS = "SELECT * FROM {chzzk_rows} UNION ALL SELECT * FROM {afreeca_rows}"

_RAW_CCU = """SELECT game_id, collect_time, game_ccu, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
       CAST(day AS BIGINT) AS day, CAST(hour AS BIGINT) AS hour FROM {ccu}"""


#: Minutes are summed in whole microseconds.
_MINUTES = "CAST(SUM(CAST(round(game_duration * 60000000) AS BIGINT)) AS BIGINT) / 60000000.0::DOUBLE"


def _rank(measure: str, name: str, rank: str) -> str:
    return f"""
        SELECT r.streamer_nm, r.game_nm, r.platform, r.{rank}, r.{name}, g.game_banner_url, '1999-06-15' AS created_date
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY streamer_nm, platform ORDER BY {name} DESC, game_nm) AS {rank}
              FROM (SELECT streamer_nm, game_nm, platform, {measure} AS {name}
                    FROM {{played}} GROUP BY streamer_nm, game_nm, platform) totals) r
        LEFT JOIN {{games}} g ON r.game_nm = g.game_nm
        WHERE r.{rank} <= 3"""


QUERIES = {
    "m1_session_core": _EVENT_SESSIONS,
    "m1_broadcast": f"SELECT {_BROADCAST_SHOWN}, '1999-06-15' AS created_date FROM {{broadcast}}",
    "m2_broadcast_incremental": f"""
        SELECT streamer_nm, broadcast_id, COALESCE(game_nm, MAX(n_game_code)) AS game_nm, platform,
               MIN(broadcast_title) AS broadcast_title, MAX(viewer_num) AS max_viewer_num,
               CAST(SUM(viewer_num) // COUNT(viewer_num) AS BIGINT) AS avg_viewer_num,
               strftime(MIN(live_collect_time), {TIME}) AS broadcast_start_time,
               strftime(MAX(live_collect_time), {TIME}) AS broadcast_end_time,
               date_diff('second', MIN(live_collect_time), MAX(live_collect_time)) / 60.0::DOUBLE AS game_duration,
               '1999-06-15' AS created_date
        FROM {{named}} m
        WHERE live_collect_time > TIMESTAMP '1999-06-14 06:00:00' AND live_collect_time < TIMESTAMP '1999-06-15 06:00:00'
        GROUP BY streamer_nm, broadcast_id, m.game_nm, platform""",
    "m3_game_price": """
        SELECT game_nm, CAST(modified_date AS VARCHAR) AS modified_date, current_price FROM {price_change}""",
    "m4_streamer_count_rank": _rank("COUNT(game_nm)", "total_broadcast_count", "count_rank"),
    "m5_streamer_duration_rank": _rank(_MINUTES, "total_broadcast_duration", "duration_rank"),
    "m6_streamer_follower_info": """
        -- Decimals: the division would be one of doubles here, on which a half rounds either way.
        SELECT s.streamer_nm, s.chz_banner_url, s.afc_banner_url,
               CAST(round(r.chz_follower_num * 0.0001, 2) AS DOUBLE) AS chz_follower_num,
               CAST(round(r.afc_follower_num * 0.0001, 2) AS DOUBLE) AS afc_follower_num,
               '2024-02-01' AS created_date
        FROM (SELECT *, ROW_NUMBER() OVER (
                       PARTITION BY streamer_id
                       ORDER BY collect_time DESC NULLS FIRST, chz_follower_num DESC NULLS FIRST,
                                afc_follower_num DESC NULLS FIRST) AS latest
              FROM {follower_rows}) r
        JOIN {streamers} s ON CAST(r.streamer_id AS VARCHAR) = s.streamer_id
        WHERE r.latest = 1""",
    "m7_streamer_game_radar": """
        SELECT streamer_nm, game_nm, AVG(avg_viewer_num) AS avg_viewer_num, MAX(max_viewer_num) AS max_viewer_num,
               COUNT(broadcast_id) AS total_broadcast_count, AVG(game_duration) AS avg_broadcast_duration,
               MAX(game_duration) AS max_broadcast_duration, MIN(game_duration) AS min_broadcast_duration,
               '1999-06-15' AS created_date
        FROM {played} WHERE game_duration <> 0 GROUP BY streamer_nm, game_nm""",
    "m8_today_game_rating": """
        SELECT g.game_nm, CAST(r.all_positive_percent * 0.05 AS DOUBLE) AS positive_percent,
               '1999-06-15' AS created_date
        FROM {ratings} r JOIN {games} g ON r.game_id = g.game_id
        WHERE r.collect_date = DATE '1999-06-15'""",
    "m9_week_broadcast_duration": f"""
        SELECT game_nm, streamer_nm, {_MINUTES} AS broadcast_duration, '1999-06-15' AS created_date
        FROM {{broadcast}} GROUP BY game_nm, streamer_nm""",
    "m10_week_broadcast_freq": """
        SELECT game_nm, streamer_nm, COUNT(DISTINCT broadcast_id) AS broadcast_freq, '1999-06-15' AS created_date
        FROM {broadcast} GROUP BY game_nm, streamer_nm""",
    "m11_week_game_viewer": """
        SELECT u.game_nm, CAST(u.hour AS BIGINT) AS hour, s.streamer_nm, AVG(u.viewer_num) AS viewer_avg,
               strftime(u.live_collect_time, '%Y-%m-%d') AS created_date
        FROM (SELECT g.game_nm, l.game_code, l.live_collect_time, l.viewer_num, l.year, l.month, l.day, l.hour, l.streamer_id
              FROM {live} l JOIN {games} g ON l.game_code = g.chz_game_code
              WHERE g.chz_game_code <> ''
              UNION
              SELECT g.game_nm, l.game_code, l.live_collect_time, l.viewer_num, l.year, l.month, l.day, l.hour, l.streamer_id
              FROM {live} l
              JOIN {games} g ON l.game_code = lpad(g.afc_game_code, CAST(length(g.afc_game_code) + 3 AS INTEGER), '0')
              WHERE g.afc_game_code <> '') u
        JOIN {streamers} s ON u.streamer_id = s.streamer_id
        GROUP BY u.game_nm, strftime(u.live_collect_time, '%Y-%m-%d'), u.hour, s.streamer_nm""",
    "m12_yesterday_game_ccu": """
        SELECT g.game_nm, AVG(c.game_ccu) AS ccu_avg, '2024-01-15' AS created_date
        FROM {ccu} c JOIN {games} g ON c.game_id = g.game_id
        WHERE c.wall BETWEEN TIMESTAMP '2024-01-14 15:30:00' AND TIMESTAMP '2024-01-15 15:30:00'
        GROUP BY g.game_nm""",
    "m13_yesterday_game_rank": """
        SELECT t.game_nm, g.game_banner_url, t.total_viewer_avg, '1999-06-15' AS created_date
        FROM (SELECT game_nm, CAST(SUM(avg_viewer_num) AS BIGINT) AS total_viewer_avg FROM {broadcast}
              WHERE game_nm NOT IN ('talk', '종합 게임')
                AND broadcast_start_time >= TIMESTAMP '1999-06-13 21:00:00'
                AND broadcast_start_time < TIMESTAMP '1999-06-14 21:00:00'
              GROUP BY game_nm) t
        JOIN {games} g ON t.game_nm = g.game_nm
        ORDER BY t.total_viewer_avg DESC, t.game_nm, g.game_banner_url LIMIT 5""",
    "m14_raw_game_ccu_incremental": f"""
        {_RAW_CCU} WHERE collect_time > (SELECT MAX(collect_time) FROM {{ccu}} WHERE collect_time < '2024-01-15')""",
    "m14_first_load": _RAW_CCU,
    "j4_resolve_codes": """
        SELECT code, game_id, game_nm FROM (SELECT DISTINCT game_code AS code FROM {live}) c
        JOIN {games} ON code = chz_game_code OR ltrim(code, '0') = afc_game_code""",
    "s1_live_viewer": _LIVE_ROWS,
    "s2_game_ccu": """
        SELECT game_id, CASE WHEN user_id % 11 = 3 THEN NULL
                        ELSE strftime(ts, '%Y-%m-%dT%H:%M') || ':00+09:00' END AS collect_time, game_ccu FROM (
          SELECT CAST(user_id AS VARCHAR) AS game_id, user_id, ts, CAST(floor(value) AS BIGINT) AS game_ccu FROM events
          UNION ALL
          SELECT CAST(user_id + 1000000 AS VARCHAR), user_id, ts, CAST(floor(value) AS BIGINT) + 1 FROM events) pair""",
    "s2_unreadable_times": """
        SELECT CAST(user_id AS VARCHAR) AS game_id, 'bad' AS time_text FROM events WHERE user_id % 11 = 3
        UNION ALL
        SELECT CAST(user_id + 1000000 AS VARCHAR), 'bad' FROM events WHERE user_id % 11 = 3""",
    "s3_game_price": """
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, '2024-01-05' AS collect_date,
               CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 THEN 0 WHEN o_orderkey % 7 = 1 THEN NULL
                    ELSE floor(o_totalprice) END::DOUBLE AS current_price,
               o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 AS is_discount
        FROM orders""",
    "s3_unreadable_prices": """
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, 'Free' AS price_text
        FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 = 1""",
    "s4_game_rating": """
        SELECT CAST(o_orderkey AS VARCHAR) AS game_id, '2024-01-05' AS collect_date,
               (CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 97 END)::DOUBLE AS recent_positive_num,
               (CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 89 END)::DOUBLE AS recent_positive_percent,
               o_orderkey % 1009 AS all_positive_num, o_orderkey % 101 AS all_positive_percent
        FROM orders""",
    "s5_followers": f"""
        SELECT CAST(streamer_id AS VARCHAR) AS streamer_id, strftime(collect_time, {TIME}) AS collect_time,
               chz_follower_num::DOUBLE AS chz_follower_num, afc_follower_num::DOUBLE AS afc_follower_num
        FROM {{follower_rows}}""",
    "r1_select_targets": """
        SELECT game_id, game_nm FROM {games}
        WHERE is_top300 = 'T' OR (is_top300 = 'F' AND redo_time >= DATE '2024-01-20')""",
    "r1_tracked_games": "SELECT game_id, game_nm FROM {games} WHERE is_top300 IN ('T', 'F')",
    "r2_unpivot_platform_ids": """
        SELECT streamer_id, 'chzzk' AS platform, chz_id AS platform_id FROM {streamers} WHERE chz_id <> ''
        UNION ALL SELECT streamer_id, 'afreeca', afc_id FROM {streamers} WHERE afc_id <> ''""",
    "r3_chzzk_live_only": """
        SELECT CAST(o_custkey AS VARCHAR) AS streamer_id, CAST(o_orderkey AS VARCHAR) AS broadcast_id
        FROM orders WHERE o_orderstatus = 'O'""",
    "r3_afreeca_live_only": """
        SELECT CAST(o_orderkey AS VARCHAR) AS streamer_id, 'b' || o_orderkey AS broadcast_id, o_custkey AS viewers
        FROM orders WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority <> '5-LOW'""",
    "r4_merge_platforms": """
        SELECT 'chzzk' AS platform, CAST(COUNT(*) AS BIGINT) AS elements, COUNT(DISTINCT o_custkey) AS streamers
        FROM orders
        UNION ALL SELECT 'afreeca', COUNT(*), COUNT(DISTINCT o_orderkey) FROM orders
        WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority <> '5-LOW'""",
    "r4_merged_documents": """
        SELECT CAST(o_custkey AS VARCHAR) AS streamer_id, 'chzzk' AS platform, o_custkey AS viewer_num FROM orders
        WHERE o_orderstatus = 'O'
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'afreeca', o_custkey FROM orders
        WHERE o_orderstatus NOT IN ('F', 'P') AND o_orderpriority <> '5-LOW'""",
    "r5_fill_failed_price": """
        SELECT game_id, current_price, is_discount FROM (
          SELECT CAST(c_custkey AS VARCHAR) AS game_id, c_custkey * 100 AS current_price, c_custkey % 2 = 0 AS is_discount
          FROM customer) answers
        UNION ALL SELECT game_id, 999999999, false FROM {games}
        WHERE is_top300 IN ('T', 'F') AND CAST(game_id AS BIGINT) NOT IN (SELECT c_custkey FROM customer)""",
    "r5_fill_failed_rating": """
        SELECT CAST(c_custkey AS VARCHAR) AS game_id, c_custkey % 1009 AS all_positive_num,
               c_custkey % 101 AS all_positive_percent, c_custkey % 97 AS recent_positive_num,
               c_custkey % 89 AS recent_positive_percent FROM customer
        UNION ALL SELECT game_id, 0, 0, 0, 0 FROM {games}
        WHERE is_top300 IN ('T', 'F') AND CAST(game_id AS BIGINT) NOT IN (SELECT c_custkey FROM customer)""",
    "r6_review_summary": """
        SELECT page_id AS game_id,
               CASE WHEN page_id % 7 = 0 THEN 0 ELSE page_id * 99991 + 12 END AS all_positive_num,
               CASE WHEN page_id % 7 = 0 THEN 0 ELSE page_id % 101 END AS all_positive_percent,
               CASE WHEN page_id % 7 = 0 OR page_id % 3 = 0 THEN 0 ELSE page_id * 1237 + 5 END AS recent_positive_num,
               CASE WHEN page_id % 7 = 0 OR page_id % 3 = 0 THEN 0 ELSE page_id % 100 END AS recent_positive_percent
        FROM pages""",
    "r7_chart_links": """
        SELECT page_id,
               unnest(regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a></li>', 2)) || '''s &lt; é™ &nope;' AS game_nm,
               unnest(regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a></li>', 1)) AS game_id
        FROM pages""",
    "r8_review_flatten": """
        SELECT source AS game_id, CAST(d.doc_id AS VARCHAR) AS review_id, lang AS author_id, text AS review,
               quality = 1 AS voted_up
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "r9_update_game_banner": """
        SELECT g.game_id, g.game_nm, COALESCE(f.url, g.game_banner_url) AS game_banner_url
        FROM {games} g LEFT JOIN (
          SELECT CAST(o_custkey AS VARCHAR) AS game_id, arg_max('https://new.example.com/' || o_orderkey, o_orderkey) AS url
          FROM orders GROUP BY o_custkey) f ON g.game_id = f.game_id""",
    "r9_update_streamer_banner": """
        SELECT s.streamer_id, s.afc_id, COALESCE('https:' || f.url, s.afc_banner_url) AS afc_banner_url
        FROM {streamers} s LEFT JOIN (
          SELECT 'a' || s_suppkey AS afc_id, '//img.example.com/' || s_name AS url FROM supplier
          WHERE s_nationkey < 12) f ON s.afc_id = f.afc_id""",
    "r10_chat_last_message": """
        SELECT conv_id, turn, CASE WHEN turn % 5 IN (0, 1, 2) THEN NULL ELSE text END AS message
        FROM conversations""",
    "r11_chat_split": """
        SELECT conv_id, turn, CASE WHEN turn % 4 = 3 THEN NULL ELSE 'm' || turn END AS part_1,
               CASE WHEN turn % 4 = 3 THEN NULL ELSE CAST(conv_id AS VARCHAR) END AS part_2,
               CASE WHEN turn % 4 = 3 THEN NULL ELSE text END AS part_6,
               CAST(CASE WHEN turn % 4 = 3 THEN 4 ELSE 7 END AS BIGINT) AS part_count
        FROM conversations WHERE turn % 6 > 2""",
    "r12_dimension_left_lookup": """
        SELECT g.game_id, COALESCE(c.c_mktsegment, '') AS category FROM {games} g
        LEFT JOIN customer c ON g.game_id = CAST(c.c_custkey AS VARCHAR)""",
    "sc1_landing_documents": _LIVE_ROWS,
    "sc1_unreadable_documents": """
        SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, CAST(day(ts) AS BIGINT) AS day,
               '{{"collect_time": "' || strftime(ts, '%Y-%-m-%-d %-H:%-M') || '", "raw_game_ccu": [{{"player_count": ' || user_id AS document
        FROM events WHERE user_id % 11 = 3 AND ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-21'""",
    "st1_old_and_new_document": "SELECT *, CAST(2 AS BIGINT) AS folders_read FROM (" + _CCU_ROWS + ") rows",
    "sc2_normalized_day": """
        SELECT game_id, collect_time, game_ccu FROM {ccu} WHERE wall >= TIMESTAMP '2024-01-10' AND wall < TIMESTAMP '2024-01-12'""",
    "sc3_dimension": "SELECT * FROM {streamers}",
    "sc4_mart_on_mart": f"""
        SELECT game_nm, streamer_nm, {_MINUTES} AS broadcast_duration, '1999-06-15' AS created_date
        FROM {{broadcast}} GROUP BY game_nm, streamer_nm""",
    "sc5_only_new_files": _CCU_ROWS,
    "sk1_rerun_same_table": _RAW_CCU,
    "sk2_spread_by_platform": "SELECT streamer_id, platform, viewer_num FROM {live}",
    "sk4_full_refresh": "SELECT game_id, game_nm FROM {games}",
    "sk5_append_increment": """
        SELECT game_id, collect_time, game_ccu FROM {ccu}""",
    "sk7_landing_layout": """
        SELECT event_id, CAST(year(local) AS BIGINT) AS year, CAST(month(local) AS BIGINT) AS month,
               CAST(day(local) AS BIGINT) AS day, CAST(hour(local) AS BIGINT) AS hour
        FROM (SELECT event_id, ts + INTERVAL 9 HOUR AS local FROM events) seoul""",
    "st1_normalize_stream": _LIVE_ROWS,
    # A stream has written what ends an hour, the time rows may be late, before the last row.
    "st2_session_stream": f"""
        {_EVENT_SESSIONS} s WHERE s.session_end + INTERVAL 24 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR""",
    "st3_hourly_average": f"""
        SELECT event_type, strftime(date_trunc('hour', ts), {TIME}) AS window_start,
               strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {TIME}) AS window_end,
               AVG(CAST(floor(value) AS BIGINT)) AS viewer_avg
        FROM events
        WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY event_type, date_trunc('hour', ts)""",
    "st7_late_rows": f"""
        SELECT event_type, strftime(date_trunc('hour', ts), {TIME}) AS window_start,
               strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, {TIME}) AS window_end,
               AVG(CAST(floor(value) AS BIGINT)) AS viewer_avg
        FROM events
        WHERE ts >= '2024-01-10'
          AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY event_type, date_trunc('hour', ts)""",
    "sc4_base_and_days": """
        SELECT game_nm, streamer_nm,
               CAST(SUM(CAST(round(game_duration * 60000000) AS BIGINT)) AS BIGINT) / 60000000.0::DOUBLE
                 AS broadcast_duration, '1999-06-15' AS created_date
        FROM (SELECT game_nm, streamer_nm, game_duration FROM {broadcast}
              UNION ALL
              SELECT COALESCE(game_nm, MAX(n_game_code)), streamer_nm,
                     date_diff('second', MIN(live_collect_time), MAX(live_collect_time)) / 60.0::DOUBLE
              FROM {named} m
              WHERE live_collect_time > TIMESTAMP '1999-06-14 06:00:00'
                AND live_collect_time < TIMESTAMP '1999-06-15 06:00:00'
              GROUP BY streamer_nm, broadcast_id, m.game_nm, platform) rows
        GROUP BY game_nm, streamer_nm""",
    "st3_week_game_viewer": """
        SELECT u.game_nm, CAST(u.hour AS BIGINT) AS hour, s.streamer_nm, AVG(u.viewer_num) AS viewer_avg,
               strftime(u.live_collect_time, '%Y-%m-%d') AS created_date
        FROM (SELECT g.game_nm, l.game_code, l.live_collect_time, l.viewer_num, l.year, l.month, l.day, l.hour, l.streamer_id
              FROM {live} l JOIN {games} g ON l.game_code = g.chz_game_code
              WHERE g.chz_game_code <> ''
              UNION
              SELECT g.game_nm, l.game_code, l.live_collect_time, l.viewer_num, l.year, l.month, l.day, l.hour, l.streamer_id
              FROM {live} l
              JOIN {games} g ON l.game_code = lpad(g.afc_game_code, CAST(length(g.afc_game_code) + 3 AS INTEGER), '0')
              WHERE g.afc_game_code <> '') u
        JOIN {streamers} s ON u.streamer_id = s.streamer_id
        -- An hour is closed once a snapshot is 200 days past its end.
        WHERE date_trunc('hour', u.live_collect_time) + INTERVAL 1 HOUR <= (SELECT MAX(live_collect_time) FROM {live}) - INTERVAL 200 DAY
        GROUP BY u.game_nm, strftime(u.live_collect_time, '%Y-%m-%d'), u.hour, s.streamer_nm""",
    "st2_broadcast_sessions": f"""
        -- The stream is 1200 days behind; it has a stretch when the next one has begun, or 400 days after the last snapshot.
        SELECT streamer_id, broadcast_id, n_game_code, CAST(group_id AS BIGINT) AS group_id,
               strftime(MIN(live_collect_time), {TIME}) AS session_start, strftime(MAX(live_collect_time), {TIME}) AS session_end,
               COUNT(*) AS snapshots, CAST(MAX(viewer_num) AS BIGINT) AS top, CAST(SUM(viewer_num) AS BIGINT) AS total
        FROM (SELECT n.*, passed, MAX(live_collect_time) OVER k AS last,
                     MAX(CASE WHEN live_collect_time < passed THEN group_id END) OVER k AS reached
              FROM {{numbered}} n, (SELECT MAX(live_collect_time) - INTERVAL 1200 DAY AS passed FROM {{live}} WHERE broadcast_id IS NOT NULL) m
              WINDOW k AS (PARTITION BY streamer_id, broadcast_id, n_game_code)) n
        WHERE last + INTERVAL 400 DAY < passed OR group_id < reached
        GROUP BY streamer_id, broadcast_id, n_game_code, group_id""",
    "st4_sliding_day_average": f"""
        SELECT event_type, strftime(window_start, {TIME}) AS window_start,
               strftime(window_start + INTERVAL 24 HOUR, {TIME}) AS window_end, AVG(viewers) AS viewer_avg
        FROM (SELECT event_type, CAST(floor(value) AS BIGINT) AS viewers,
                     date_trunc('hour', ts) - to_hours(unnest(range(24))) AS window_start FROM events) spread
        WHERE window_start + INTERVAL 24 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
        GROUP BY event_type, window_start""",
    "st5_price_change_stream": """
        -- A day is closed once the newest one is more than 800 days after it.
        SELECT game_nm, CAST(modified_date AS VARCHAR) AS modified_date, current_price FROM {timely_price_change}
        WHERE modified_date < (SELECT MAX(collect_date) FROM {prices}) - INTERVAL 800 DAY""",
    "st5_late_prices": """
        SELECT g.game_nm, CAST(p.collect_date AS VARCHAR) AS collect_date, p.current_price
        FROM {prices} p JOIN {games} g ON p.game_id = g.game_id
        WHERE p.collect_date BETWEEN DATE '1995-03-01' AND DATE '1995-03-07'""",
    "st6_increment_stream": """
        SELECT event_id, user_id, event_type FROM events""",
    "st1_stream_and_batch": f"""
        SELECT *, 'whole' AS read FROM ({_CCU_ROWS}) a UNION ALL SELECT *, 'range' AS read FROM ({_CCU_ROWS}) b""",
    "sk1_fewer_rows": "SELECT game_id, collect_time, game_ccu FROM {ccu} WHERE day % 2 = 0",
    "sk3_rows_per_file": """
        SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, COUNT(*) AS total, true AS within
        FROM {ccu} GROUP BY year, month""",
    "sk6_register": """
        SELECT CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month, CAST(day AS BIGINT) AS day, COUNT(*) AS n
        FROM {ccu} GROUP BY year, month, day""",
    "sk4_two_publications": """
        SELECT game_id, 'early' AS reader FROM {games}
        UNION ALL SELECT game_id, 'late' FROM {games} WHERE CAST(game_id AS BIGINT) % 3 = 0""",
    # Single relational operators.
    "j3_full_outer_using": """
        SELECT CAST(COALESCE(c, s) AS VARCHAR) AS key, c IS NOT NULL AS in_orders, s IS NOT NULL AS in_lines
        FROM (SELECT DISTINCT o_custkey AS c FROM orders) o FULL JOIN (SELECT DISTINCT l_partkey AS s FROM lineitem) l
          ON c = s""",
    "j5_padded_code_join": """
        SELECT l.game_code, g.game_nm, CAST(COUNT(*) AS BIGINT) AS snapshots
        FROM {live} l JOIN {games} g ON l.game_code = lpad(g.afc_game_code, CAST(length(g.afc_game_code) + 3 AS INTEGER), '0')
        GROUP BY l.game_code, g.game_nm""",
    "w3_running_sum": """
        SELECT user_id, event_id, CAST(SUM(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running FROM events""",
}

#: Kept marts are the marts over all broadcasts and the day's.
for _kept, _mart in (
    ("sk5_kept_count_rank", "m4_streamer_count_rank"),
    ("sk5_kept_game_radar", "m7_streamer_game_radar"),
    ("sk5_kept_duration", "m9_week_broadcast_duration"),
    ("sk5_kept_freq", "m10_week_broadcast_freq"),
):
    QUERIES[_kept] = QUERIES[_mart].replace("{played}", "{grown_played}").replace("{broadcast}", "{grown}")
QUERIES["m1_dense_polls"] = QUERIES["m1_broadcast"]
QUERIES["sc4_rank_of_days"] = QUERIES["m13_yesterday_game_rank"]


def sql(name: str) -> str:
    """A query with its views spelled out."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for view in re.findall(r"\{(\w+)\}", text):
            if view not in needed:
                visit(VIEWS[view])
                if view not in needed:
                    needed.append(view)

    body = QUERIES[name]
    visit(body)
    names = {v: v for v in VIEWS}
    parts = ",\n".join(f"{v} AS ({VIEWS[v].format(**names)})" for v in needed)
    return (f"WITH {parts}\n" if needed else "") + body.format(**names)
