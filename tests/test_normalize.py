"""Landing documents as files, with the odd rows collectors leave."""

import json
from datetime import date

import pytest

from airtally.plans import normalize
from airtally.sources import landing


@pytest.fixture
def land(tmp_path):
    """Write one document per file under a table's folders, as its collector does."""

    def write(table, documents, folder="year=2024/month=1/day=5", pretty=False):
        where = tmp_path / "source" / "json" / f"table_name={table}" / folder
        where.mkdir(parents=True, exist_ok=True)
        for document in documents:
            name = f"{table}_{len(list(where.iterdir()))}.json"
            text = json.dumps(document, ensure_ascii=False, indent=4 if pretty else None)
            (where / name).write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def chzzk(adult=False, live_id=7, **content):
    return {
        "streamer_id": "s1",
        "chzzk_s_id": "c1",
        "current_time": "2024-01-05 12:35:00+09:00",
        "content": {"status": "OPEN", "adult": adult, "liveId": live_id, "liveTitle": "t",
                    "liveCategoryValue": "g", "concurrentUserCount": 10, **content},
    }


def afreeca(grade=0, bno="B9"):
    return {
        "streamer_id": "s2",
        "afc_s_id": "a2",
        "current_time": "2024-01-05 12:35:00+09:00",
        "live_status": {"RESULT": 1, "BNO": bno, "TITLE": "u", "CATE": "00040019", "extra": [1]},
        "broad_info": {"broad": {"broad_grade": grade, "current_sum_viewer": 20}, "station": {"x": 1}},
    }


def live(spark, root):
    return normalize.live_viewer(landing.read_documents(spark, root, "raw_live_viewer"))


def test_s1_reads_pretty_printed_documents_of_both_platforms(spark, land, rows):
    root = land("raw_live_viewer", [{"stream_data": {"chzzk": [chzzk()], "afreeca": [afreeca()]}}],
                "year=2024/month=1/day=5/hour=12", pretty=True)
    when = "2024-01-05 12:35:00+09:00"
    assert rows(live(spark, root)) == [
        ("s1", "7", when, "t", "g", 10, "chzzk", 2024, 1, 5, 12),
        ("s2", "B9", when, "u", "00040019", 20, "afreeca", 2024, 1, 5, 12),
    ]


@pytest.mark.parametrize("data", [{"chzzk": [], "afreeca": [afreeca()]}, {"afreeca": [afreeca()]}])
def test_s1_platform_with_nobody_live(spark, land, rows, data):
    root = land("raw_live_viewer", [{"stream_data": data}], "year=2024/month=1/day=5/hour=12", pretty=True)
    assert rows(live(spark, root), "platform") == [("afreeca",)]


def test_s1_drops_adult_and_unknown(spark, land, rows):
    elements = [chzzk(True, 1), chzzk(False, "2"), chzzk(None, 3)]
    others = [afreeca(19, "a"), afreeca(18, "b"), afreeca(None, "c")]
    root = land("raw_live_viewer", [{"stream_data": {"chzzk": elements, "afreeca": others}}],
                "year=2024/month=1/day=5/hour=12", pretty=True)
    assert rows(live(spark, root), "broadcast_id") == [("2",), ("b",)]


def test_sc1_reads_only_the_hour_asked_for(spark, land, rows):
    for hour in (11, 12):
        document = {"stream_data": {"chzzk": [chzzk(live_id=hour)], "afreeca": []}}
        root = land("raw_live_viewer", [document], f"year=2024/month=1/day=5/hour={hour}", pretty=True)
    documents = landing.read_documents(spark, root, "raw_live_viewer", first=date(2024, 1, 5), hour=12)
    assert rows(normalize.live_viewer(documents), "broadcast_id") == [("12",)]
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_s2_pads_times(spark, land, rows):
    games = [{"player_count": 5, "result": 1, "game_id": 730}, {"player_count": 6, "result": 1, "game_id": "x"}]
    root = land("raw_game_ccu", [{"collect_time": "2024-1-5 7:0", "raw_game_ccu": games},
                                 {"collect_time": "2024-11-15 17:30", "raw_game_ccu": []}],
                "year=2024/month=1/day=5/hour=7")
    out = normalize.game_ccu(landing.read_documents(spark, root, "raw_game_ccu"))
    when = "2024-01-05T07:00:00+09:00"
    assert rows(out, "game_id", "collect_time", "game_ccu") == [("730", when, 5), ("x", when, 6)]


def price(appid, block):
    return {"success": True, "data": {"steam_appid": appid, **({} if block == "absent" else {"price_overview": block})}}


def test_s3_prices(spark, land, rows):
    def block(text, percent):
        return {"final": 1, "initial": 1, "discount_percent": percent, "final_formatted": text}

    listed = [
        price(1, "absent"),
        price(2, None),
        price(3, block(None, 10)),
        price(4, block("₩ 19,500", 0)),
        price(5, block(" ₩ 1,234,500 ", 30)),
        price(6, block("Free", None)),
        price(7, block("₩ 999,999,999", 0)),
    ]
    root = land("raw_game_price", [{"raw_game_price": listed}])
    documents = landing.read_documents(spark, root, "raw_game_price")
    out = normalize.game_price(documents, "2024-1-5")
    day = date(2024, 1, 5)
    assert rows(out, "game_id", "collect_date", "current_price", "is_discount") == [
        ("1", day, 0, False),
        ("2", day, 0, False),
        ("3", day, 0, True),
        ("4", day, 19500, False),
        ("5", day, 1234500, True),
        ("6", day, None, True),
        ("7", day, 999999999, False),
    ]
    kept = rows(normalize.game_price(documents, "2024-1-5", drop_failed=True), "game_id")
    assert kept == [(str(i),) for i in range(1, 7)]
    assert rows(normalize.unreadable_prices(documents)) == [("6", "Free")]


def test_s4_ratings(spark, land, rows):
    ratings = [
        {"game_id": 1, "all_positive_num": 3, "all_positive_percent": 0},
        {"game_id": "2", "all_positive_num": 3, "all_positive_percent": 90, "recent_positive_num": 1,
         "recent_positive_percent": 100},
    ]
    root = land("raw_game_rating", [{"raw_game_rating": ratings}, {"raw_game_rating": []}])
    out = normalize.game_rating(landing.read_documents(spark, root, "raw_game_rating"), "2024-01-05")
    day = date(2024, 1, 5)
    assert rows(out.drop("year", "month", "day")) == [("1", day, None, None, 3, 0), ("2", day, 1, 100, 3, 90)]


def follower_poll(time, first=(), second=()):
    return {
        "stream_data": {
            "chzzk": [{"streamer_id": s, "current_time": time, "content": {"followerCount": n}} for s, n in first],
            "afreeca": [
                {"streamer_id": s, "current_time": time, "broad_info": {"station": {"upd": {"fan_cnt": n}}}}
                for s, n in second
            ],
        }
    }


def test_s5_joins_polls(spark, land, rows):
    polls = [
        follower_poll("10:00", [("both", 1), ("one", 2)], [("both", 3), ("two", 4)]),
        follower_poll("11:00", [("both", 5)], [("both", 6)]),
        follower_poll("", [("blank", 7)]),
        follower_poll(None, [], [("none", 8)]),
    ]
    root = land("followers", polls, pretty=True)
    documents = landing.read_documents(spark, root, "followers")
    out = normalize.followers(documents)
    assert rows(out.drop("year", "month", "day")) == [
        ("blank", None, 7, None),
        ("both", "10:00", 1, 3),
        ("both", "11:00", 5, 6),
        ("none", None, None, 8),
        ("one", "10:00", 2, None),
        ("two", "10:00", None, 4),
    ]
    by_streamer = normalize.followers(documents, on=("streamer_id",)).where("streamer_id = 'both'")
    assert by_streamer.count() == 4


def test_r8_reviews(spark, land, rows):
    review = {"recommendationid": "r", "author": {"steamid": "a", "x": 1}, "review": "줄\n\"둘\"", "voted_up": True}
    games = [{"success": 1, "reviews": [review], "game_id": [730]}, None, {"reviews": [], "game_id": [1]}]
    root = land("raw_game_review", [{"raw_game_review": games}])
    out = normalize.review_flatten(landing.read_documents(spark, root, "raw_game_review"))
    assert rows(out.drop("year", "month", "day")) == [("730", "r", "a", "줄\n\"둘\"", True)]
