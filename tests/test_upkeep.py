"""Marts kept up from loads against their rebuild, and what a load reads."""

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from pathlib import Path

import pytest

from airtally.plans import marts, upkeep

DAY = date(2024, 3, 1)
SCHEMA = """streamer_nm string, broadcast_id string, game_nm string, platform string, broadcast_title string, max_viewer_num int,
    avg_viewer_num int, broadcast_start_time string, broadcast_end_time string, game_duration double, created_date date"""
REBUILT = {
    "anal_streamer_count_rank": lambda b, g: marts.streamer_count_rank(b, g, as_of=DAY),
    "anal_streamer_duration_rank": lambda b, g: marts.streamer_duration_rank(b, g, as_of=DAY),
    "anal_streamer_game_rader": lambda b, g: marts.streamer_game_radar(b, as_of=DAY),
    "anal_week_broadcast_duration": lambda b, g: marts.week_broadcast_duration(b, as_of=DAY),
    "anal_week_broadcast_freq": lambda b, g: marts.week_broadcast_freq(b, as_of=DAY),
}


@pytest.fixture
def dimension(games):
    return games(*({"game_id": str(i), "game_nm": f"g{i // 2}", "game_banner_url": f"u{i}"} for i in range(8)))


def broadcasts(spark, n, seed, streamers=9):
    chance = random.Random(seed)
    rows = []
    for i in range(n):
        streamer = chance.choice([None, *(f"s{k}" for k in range(streamers)), *["hot"] * streamers])
        rows.append((
            streamer, chance.choice([None, *(f"b{k}" for k in range(20))]), chance.choice([None, "", "talk", *(f"g{k}" for k in range(6))]),
            chance.choice(["chzzk", "afreeca"]), f"t{i}", chance.choice([None, chance.randint(0, 99)]), chance.choice([None, chance.randint(0, 50)]),
            None, None, chance.choice([None, 0.0, 5.0, 12.5]), DAY,
        ))
    return spark.createDataFrame(rows, SCHEMA)


def same(spark, folder, whole, dimension, rows):
    for name, rebuild in REBUILT.items():
        wanted = rebuild(whole, dimension)
        kept = upkeep.read_kept(spark, folder, name, as_of=DAY, games=dimension)
        assert kept.columns == wanted.columns and [f.dataType for f in kept.schema] == [f.dataType for f in wanted.schema], name
        assert rows(kept) == rows(wanted), name


def test_loads_equal_a_rebuild(spark, tmp_path, dimension, rows):
    folder = str(tmp_path / "kept")
    base, one, two, less = (broadcasts(spark, n, seed) for n, seed in ((300, 1), (40, 2), (30, 3), (5, 4)))
    assert upkeep.add_load(base, folder, "base", replace_all=True) == 1
    same(spark, folder, base, dimension, rows)
    upkeep.add_load(one, folder, "d1")
    same(spark, folder, base.union(one), dimension, rows)
    upkeep.add_load(two, folder, "d2")
    same(spark, folder, base.union(one).union(two), dimension, rows)
    upkeep.add_load(one, folder, "d1")  # again
    same(spark, folder, base.union(one).union(two), dimension, rows)
    upkeep.add_load(less, folder, "d1")  # other rows in its place
    same(spark, folder, base.union(less).union(two), dimension, rows)
    upkeep.add_load(less.limit(0), folder, "d1")  # none
    same(spark, folder, base.union(two), dimension, rows)
    upkeep.add_load(two, folder, "base", replace_all=True)
    same(spark, folder, two, dimension, rows)


def test_a_load_reads_and_writes_the_buckets_of_its_streamers_only(spark, tmp_path, dimension, rows):
    folder = str(tmp_path / "kept")
    base = broadcasts(spark, 200, 5)
    upkeep.add_load(base, folder, "base", replace_all=True)
    before = upkeep.state(spark, folder)
    day = broadcasts(spark, 60, 6).where("streamer_nm = 's1'")
    bucket = day.selectExpr(f"pmod(xxhash64(streamer_nm), {upkeep.BUCKETS}) b").first()["b"]
    for path in Path(folder).rglob("*.parquet"):
        if f"bucket={bucket}/" not in str(path):
            path.rename(path.with_suffix(".hidden"))  # would fail to be read
            path.write_text("no Parquet")
    upkeep.add_load(day, folder, "d1")
    after = upkeep.state(spark, folder)
    assert {b for b, mark in after["parts"].items() if mark != before["parts"].get(b)} == {str(bucket)}
    for path in Path(folder).rglob("*.hidden"):
        path.rename(path.with_suffix(".parquet"))
        crc = path.parent / f".{path.stem}.parquet.crc"
        crc.unlink(missing_ok=True)
    same(spark, folder, base.union(day), dimension, rows)


def test_loads_at_once_are_all_there(spark, tmp_path, dimension, rows):
    folder = str(tmp_path / "kept")
    parts = [broadcasts(spark, 20, seed) for seed in (11, 12, 13)]
    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(lambda k: upkeep.add_load(parts[k], folder, f"d{k}"), range(3)))
    assert sorted(versions) == [1, 2, 3] and set(upkeep.state(spark, folder)["loads"]) == {"d0", "d1", "d2"}
    same(spark, folder, parts[0].union(parts[1]).union(parts[2]), dimension, rows)


def test_nothing_kept_is_empty(spark, tmp_path, dimension):
    for name in upkeep.MARTS:
        assert upkeep.read_kept(spark, str(tmp_path / "none"), name, as_of=DAY, games=dimension).count() == 0
