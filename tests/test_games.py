"""Rows under codes of very many names: the same marts as over a row per name, and no row for each streamer and name on the way."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airtally.operators import games as by_code
from airtally.operators.games import ByCode
from airtally.plans import marts, refresh, upkeep
from airtally.sinks import writers
from airtally.sources import tables

DAY = date(2024, 3, 1)
MARTS = {
    "m4": lambda b, g: marts.streamer_count_rank(b, g, as_of=DAY),
    "m5": lambda b, g: marts.streamer_duration_rank(b, g, as_of=DAY),
    "m7": lambda b, g: marts.streamer_game_radar(b, as_of=DAY),
    "m7_whole": lambda b, g: marts.streamer_game_radar(b, as_of=DAY, integer_avg=True),
    "m9": lambda b, g: marts.week_broadcast_duration(b, as_of=DAY),
    "m10": lambda b, g: marts.week_broadcast_freq(b, as_of=DAY),
    "m10_about": lambda b, g: marts.week_broadcast_freq(b, as_of=DAY, approximate=True),
    "m13": lambda b, g: marts.yesterday_game_rank(b, g, as_of=DAY),
}
KEPT = {
    "anal_streamer_count_rank": "m4", "anal_streamer_duration_rank": "m5", "anal_streamer_game_rader": "m7",
    "anal_week_broadcast_duration": "m9", "anal_week_broadcast_freq": "m10",
}


@pytest.fixture
def dimension(games):
    return games(*({"game_id": str(i), "game_nm": f"g{i // 2}", "game_banner_url": f"u{i}"} for i in range(60)))


@pytest.fixture(autouse=True)
def short(monkeypatch):
    """Codes of four names and more have lists, of about five."""
    monkeypatch.setattr(by_code, "NAMES_PER_KEY", 3)
    monkeypatch.setattr(by_code, "LIST", 5)
    monkeypatch.setattr(by_code, "SALTS", 2)


def names(spark):
    """Two codes of the same many names, one of some of them and others, some of a name each, of two, of none; odd ones as well."""
    of = {"00": [f"g{i}" for i in range(20)], "0000": [f"g{i}" for i in range(20)], "big": [f"g{i}" for i in range(15, 25)] + ["talk", "Virtual", None, ""]}
    of |= {f"c{i}": [f"g{i}"] for i in range(22)} | {"two": ["g1", "g40"], "big2": ["x1", "x2", "x3", "x4"]}
    rows = [(code, name or code if name is None else name, name is not None) for code, every in of.items() for name in every]
    return spark.createDataFrame([*rows, ("talk", "talk", False), ("none", "none", False)], by_code.NAMES)


def stretches(spark, n, seed, game="n_game_code", codes=None):
    chance = random.Random(seed)
    codes = codes or ["00", "0000", "big", "big2", "two", "talk", "none", *(f"c{i}" for i in range(22))]
    rows = []
    for i in range(n):
        start = datetime(2024, 2, 28, chance.randint(0, 23)) + timedelta(days=chance.randint(0, 3))
        rows.append((
            chance.choice([None, "hot", "hot", *(f"s{k}" for k in range(6))]), f"b{chance.randint(0, 8)}", chance.choice(codes), chance.choice(["chzzk", "afreeca"]),
            f"t{i}", chance.choice([None, chance.randint(0, 99)]), chance.choice([None, chance.randint(0, 50)]), start, start, chance.choice([None, 0.0, 5.0, 12.5]), DAY,
        ))
    return spark.createDataFrame(rows, f"""streamer_nm string, broadcast_id string, {game} string, platform string, broadcast_title string, max_viewer_num int,
        avg_viewer_num int, broadcast_start_time timestamp, broadcast_end_time timestamp, game_duration double, created_date date""")


@pytest.fixture
def broadcasts(spark):
    return ByCode(stretches(spark, 150, 1), names(spark), stretches(spark, 20, 2, "game_nm", ["g1", "g3", "g19", "g40", "talk", None]))


def test_spelled_is_the_join_with_the_names(spark, broadcasts, rows):
    joined = broadcasts.rows.join(broadcasts.names, "n_game_code").drop("known", "n_game_code").unionByName(broadcasts.named)
    assert rows(broadcasts.spelled(), *broadcasts.named.columns) == rows(joined, *broadcasts.named.columns)
    assert broadcasts.spelled().columns == broadcasts.named.columns


@pytest.mark.parametrize("name", MARTS)
def test_marts_under_codes_equal_those_over_names(broadcasts, dimension, rows, name):
    ours, theirs = MARTS[name](broadcasts, dimension), MARTS[name](broadcasts.spelled(), dimension)
    assert ours.columns == theirs.columns and [f.dataType for f in ours.schema] == [f.dataType for f in theirs.schema]
    assert rows(ours) == rows(theirs)


def test_kept_marts_under_codes_equal_a_rebuild(spark, tmp_path, broadcasts, dimension, rows):
    folder = str(tmp_path / "kept")

    def same(whole):
        for name, mart in KEPT.items():
            kept = upkeep.read_kept(spark, folder, name, as_of=DAY, games=dimension)
            wanted = MARTS[mart](whole, dimension)
            assert kept.columns == wanted.columns and [f.dataType for f in kept.schema] == [f.dataType for f in wanted.schema], name
            assert rows(kept) == rows(wanted), name

    base = ByCode(broadcasts.rows, broadcasts.names)
    day = stretches(spark, 15, 3, "game_nm", ["g1", "g3", "g19", "g40", "talk", None]).where("streamer_nm = 'hot' or streamer_nm is null")
    upkeep.add_load(base, folder, "base", replace_all=True)
    same(base.spelled())
    upkeep.add_load(day, folder, "d1")
    same(base.spelled().unionByName(day))
    more = ByCode(stretches(spark, 10, 4), names(spark).where("game_nm <> 'g3'"))  # other names by now
    upkeep.add_load(more, folder, "d2")
    same(base.spelled().unionByName(day).unionByName(more.spelled()))
    upkeep.add_load(more, folder, "base", replace_all=True)
    same(more.spelled())


def test_published_under_codes(spark, tmp_path, broadcasts, dimension, rows):
    root, base = str(tmp_path), ByCode(broadcasts.rows, broadcasts.names)
    refresh.publish_broadcasts(base, root)
    folder = refresh.mart_folder(root, "anal_broadcast")
    assert spark.read.parquet(f"{folder}/versions").count() == base.rows.count()  # no row per name is stored
    assert rows(tables.read_mart(spark, folder), *broadcasts.named.columns) == rows(base.spelled())
    refresh.add_broadcasts(broadcasts.named, folder, DAY)
    assert rows(MARTS["m9"](refresh.read_broadcasts(spark, root), dimension)) == rows(MARTS["m9"](broadcasts.spelled(), dimension))
    days = (date(2024, 2, 29), date(2024, 3, 1))
    assert rows(MARTS["m13"](refresh.read_broadcasts(spark, root, started=days), dimension)) == rows(MARTS["m13"](broadcasts.spelled(), dimension))
    writers.publish(base.rows.limit(1), folder)
    assert len(writers.expire(spark, folder, 1)) == 1 and tables.read_mart(spark, folder).count() == 1


def test_no_grouping_or_shuffle_sees_a_row_per_streamer_and_name(spark, games, streamers, monkeypatch):
    """A code of zeros stands for 2,000 games, and 300 streamers have it: what is shuffled stays far below their product."""
    monkeypatch.setattr(by_code, "LIST", 4096)
    dimension = games(*({"game_id": str(i), "game_nm": f"N{i}", "afc_game_code": ""} for i in range(2000)))
    live = spark.range(600).selectExpr(
        "cast(id % 300 as string) streamer_id", "concat('b', id % 300) broadcast_id", "'p' platform", "'t' broadcast_title", "5 viewer_num", "'00' game_code",
        "timestamp'2024-01-01 10:00' + make_dt_interval(0, cast(id div 300 as int) * 2) live_collect_time",
    )
    people = streamers(*({"streamer_id": str(i), "streamer_nm": f"S{i}"} for i in range(300)))
    stretches = marts.broadcast_by_code(live, people, dimension, as_of=DAY)
    for out in (marts.week_broadcast_freq(stretches, as_of=DAY), marts.week_broadcast_duration(stretches, as_of=DAY)):
        assert out.count() == 600_000
    top = marts.streamer_count_rank(stretches, dimension, as_of=DAY)
    assert top.count() == 900
    for out in (marts.week_broadcast_freq(stretches, as_of=DAY), top):
        plan = out._jdf.queryExecution().optimizedPlan()
        # Names are spelled out last: but for the top three's ranking, nothing groups or joins above.
        above = plan.toString().split("Generate explode(CASE WHEN", 1)[0]
        assert "Aggregate" not in above and (out is top or "Join" not in above), above
