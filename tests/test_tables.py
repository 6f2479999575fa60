"""Sources and sinks: layouts, pruning, reruns, refreshes, jobs."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from airtally.functions.times import partition_date, within_days
from airtally.plans import loads, marts, normalize, refresh
from airtally.session import work_folder
from airtally.sinks import writers
from airtally.sources import landing, log, tables


def ccu(spark, n=200):
    return spark.range(n).selectExpr(
        "cast(id % 10 as string) game_id", "concat('2024-01-', lpad(id % 4 + 1, 2, '0'), 'T0', id % 3, ':00:00+09:00') collect_time",
        "cast(id as int) game_ccu", "2024 year", "1 month", "cast(id % 4 + 1 as int) day", "cast(id % 3 as int) hour",
    )


KEYS = ["year", "month", "day", "hour"]


def pruned(df):
    """The partition filters of the plan's scans."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split("], ")[0] for part in plan.split("PartitionFilters: [")[1:]]


def test_sk1_rerun_and_other_partitions(spark, tmp_path):
    folder = str(tmp_path / "t")
    writers.overwrite_partitions(ccu(spark), folder, KEYS)
    writers.overwrite_partitions(ccu(spark).where("day = 2"), folder, KEYS)
    assert spark.read.parquet(folder).count() == 200
    writers.overwrite_partitions(ccu(spark).where("day = 2 and game_ccu < 50"), folder, KEYS, rows_per_file=5)
    assert spark.read.parquet(folder).count() == 150 + sum(1 for i in range(50) if i % 4 == 1)
    assert (tmp_path / "t" / "year=2024" / "month=1" / "day=2" / "hour=0").is_dir()


def test_sk3_files_are_split_by_rows(spark, tmp_path):
    folder = str(tmp_path / "t")
    writers.overwrite_partitions(ccu(spark), folder, ["year"], rows_per_file=50, sort_within=["game_id"])
    files = list((tmp_path / "t" / "year=2024").glob("*.parquet"))
    assert len(files) == 4


def test_sc2_prunes_days(spark, tmp_path):
    folder = tables.table_folder(str(tmp_path), "parquet", "raw_game_ccu")
    writers.overwrite_partitions(ccu(spark), folder, KEYS)
    df = tables.read_normalized(spark, str(tmp_path), "raw_game_ccu", first=date(2024, 1, 2), last=date(2024, 1, 3))
    assert df.count() == 100
    assert all("make_date" in f for f in pruned(df))
    text_keys = spark.read.option("basePath", folder).schema("game_ccu int, year string, month string, day string").parquet(folder)
    assert within_days(text_keys, date(2024, 1, 4), date(2024, 1, 4)).count() == 50


def test_any_number_of_days_is_one_read(spark, tmp_path):
    root, folder = str(tmp_path), tables.table_folder(str(tmp_path), "parquet", "raw_game_ccu")
    writers.overwrite_partitions(ccu(spark), folder, KEYS)
    two = tables.read_normalized(spark, root, "raw_game_ccu", first=date(2024, 1, 2), last=date(2024, 1, 3))
    assert two.count() == 100 and all("make_date" in f for f in pruned(two))
    years = tables.read_normalized(spark, root, "raw_game_ccu", first=date(2023, 1, 1), last=date(2024, 12, 31))
    assert years.count() == tables.read_normalized(spark, root, "raw_game_ccu").count() == 200
    more = tables.read_normalized(spark, root, "raw_game_ccu", first=date(2024, 1, 4), last=date(2024, 1, 9))
    assert more.count() == 50
    assert tables.read_normalized(spark, root, "raw_game_ccu", first=date(2025, 1, 1)).count() == 0


def test_incremental_marts_read_only_their_days(spark, tmp_path, games, streamers):
    folder = tables.table_folder(str(tmp_path), "parquet", "raw_game_ccu")
    writers.overwrite_partitions(ccu(spark), folder, KEYS)
    out = marts.yesterday_game_ccu(
        tables.read_normalized(spark, str(tmp_path), "raw_game_ccu"), games(), now=datetime(2024, 1, 3)
    )
    assert any("make_date" in f for f in pruned(out))


def test_m14_prunes_folders_by_the_mark(spark, tmp_path):
    root = str(tmp_path)
    writers.overwrite_partitions(ccu(spark), tables.table_folder(root, "parquet", "raw_game_ccu"), KEYS)
    source = tables.read_normalized(spark, root, "raw_game_ccu")
    target = source.where("day <= 2")
    target.write.parquet(f"{root}/copy")
    out = loads.rows_after_mark(source, spark.read.parquet(f"{root}/copy"), partition_date=partition_date())
    assert any("make_date" in f and "ubquery" in f for f in pruned(out))
    # Rows of day 2, hour 2 are at the mark and not past it.
    assert out.count() == 100


def test_sk2_more_tasks_than_values(spark):
    df = spark.range(10_000).withColumn("platform", F.when(F.col("id") % 3 == 0, "a").otherwise("b"))
    spread = writers.spread_by(df, "platform", 8)
    assert spread.count() == 10_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert spread.select(F.spark_partition_id()).distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sk4_readers_never_see_half_a_mart(spark, tmp_path):
    folder = str(tmp_path / "mart")
    with pytest.raises(FileNotFoundError):
        tables.read_mart(spark, folder)
    assert writers.publish(spark.range(5), folder) == 1
    reader = tables.read_mart(spark, folder)
    broken = spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        writers.publish(broken, folder)
    assert tables.read_mart(spark, folder).count() == 5
    assert writers.publish(spark.range(7), folder) == 2
    assert reader.count() == 5
    assert tables.read_mart(spark, folder).count() == 7
    assert writers.publish(spark.range(3), folder) == 3
    assert tables.read_mart(spark, folder).count() == 3
    assert reader.count() == 5  # two publications later
    assert len(writers.expire(spark, folder, keep=2)) == 1
    assert tables.read_mart(spark, folder).count() == 3


def test_sk5_same_load_twice(spark, tmp_path):
    folder = str(tmp_path / "t")
    for load, n in ((date(2024, 1, 1), 5), (date(2024, 1, 2), 7), (date(2024, 1, 2), 7)):
        writers.append_increment(spark.range(n), folder, "load", F.lit(load))
    assert spark.read.parquet(folder).count() == 12


def test_sk5_a_load_without_rows_empties_what_it_had(spark, tmp_path):
    folder = str(tmp_path / "t")
    for n in (5, 0):
        writers.append_increment(spark.range(n), folder, "load", F.lit(date(2024, 1, 1)))
        writers.append_increment(spark.range(3), folder, "load", F.lit(date(2024, 1, 2)))
    assert [tuple(r) for r in spark.read.parquet(folder).groupBy("load").count().collect()] == [(date(2024, 1, 2), 3)]


def test_sk4_publishers_at_once_all_get_a_version(spark, tmp_path):
    """Every one of many publishers is in the log, under a number of its own, and the last number is what readers get."""
    folder = str(tmp_path / "mart")
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda n: writers.publish(spark.range(n), folder), range(1, 13)))
    assert sorted(numbers) == list(range(1, 13))
    log = {r["version"]: r["mark"] for r in tables.published(spark, folder).collect()}
    assert sorted(log) == sorted(numbers) and len(set(log.values())) == 12
    for n, version in enumerate(numbers, 1):
        assert spark.read.parquet(tables.version_folder(folder, log[version])).count() == n
    assert tables.read_mart(spark, folder).count() == numbers.index(12) + 1


def test_sk4_an_entry_is_created_once(spark, tmp_path):
    path = log.entry_path(str(tmp_path / "log"), 7)
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: log.put_if_absent(spark, path, str(n)), range(32)))
    assert sum(won) == 1
    assert log.read_entry(spark, str(tmp_path / "log"), 7) == str(won.index(True))
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["00000000000000000007.json"]
    assert log.last_number(spark, str(tmp_path / "log")) == 7 and log.last_number(spark, str(tmp_path / "none")) == 0


def test_sk4_an_entry_by_rename_is_created_once(spark, tmp_path, monkeypatch):
    """The way of file systems without links."""
    monkeypatch.setattr(log, "_by_link", log._by_rename)
    path = log.entry_path(str(tmp_path / "log"), 1)
    assert [log.put_if_absent(spark, path, text) for text in ("first", "second")] == [True, False]
    assert log.read_entry(spark, str(tmp_path / "log"), 1) == "first"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.endswith(".crc")] == ["00000000000000000001.json"]


def test_sk6_new_partitions_are_found(spark, tmp_path):
    folder = str(tmp_path / "t")
    writers.overwrite_partitions(ccu(spark).where("day < 3"), folder, ["year", "month", "day"])
    try:
        writers.register(spark, "airtally_ccu", folder)
        assert spark.table("airtally_ccu").count() == 100
        writers.overwrite_partitions(ccu(spark).where("day = 3"), folder, ["year", "month", "day"])
        writers.register(spark, "airtally_ccu", folder)
        assert spark.table("airtally_ccu").where("day = 3").count() == 50
    finally:
        spark.sql("DROP TABLE IF EXISTS airtally_ccu")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sk7_folders_go_by_the_collectors_clock(spark, tmp_path, zone):
    folder = tmp_path / zone.replace("/", "_")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT 1 AS n, timestamp'2024-01-04 22:30:00+00:00' AS ts")
        for _ in range(2):
            writers.land(df, str(folder), "ts", poll="p1")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert (folder / "year=2024" / "month=1" / "day=5" / "hour=7").is_dir()
    assert spark.read.json(str(folder)).count() == 1


def test_sk1_owned_partitions_without_rows_are_emptied(spark, tmp_path):
    folder = str(tmp_path / "t")
    writers.overwrite_partitions(ccu(spark), folder, KEYS)
    owned = ccu(spark).where("day <= 2").select(*KEYS)
    writers.overwrite_partitions(ccu(spark).where("day = 2"), folder, KEYS, owned=owned)
    assert {r["day"] for r in spark.read.parquet(folder).select("day").distinct().collect()} == {2, 3, 4}


def test_jobs_from_documents_to_marts(spark, tmp_path, games, streamers):
    """The whole way, each step twice."""
    root, day = str(tmp_path), date(2024, 3, 9)

    def land(table, document, folder="year=2024/month=3/day=9"):
        where = tmp_path / "source" / "json" / f"table_name={table}" / folder
        where.mkdir(parents=True, exist_ok=True)
        (where / f"{len(list(where.iterdir()))}.json").write_text(json.dumps(document, indent=4 if "stream_data" in document else None))

    for minute in (0, 5, 10, 30):
        when = f"2024-03-09 18:{minute:02d}:00+09:00"
        content = {"status": "OPEN", "adult": False, "liveId": 7, "liveTitle": "t", "liveCategoryValue": "G1", "concurrentUserCount": 10 + minute}
        element = {"streamer_id": "1", "chzzk_s_id": "c", "current_time": when, "content": content}
        land("raw_live_viewer", {"stream_data": {"chzzk": [element], "afreeca": []}}, "year=2024/month=3/day=9/hour=18")
    follower = {"streamer_id": "1", "current_time": "2024-03-09 18:02:00+09:00", "content": {"followerCount": 54321}}
    land("followers", {"stream_data": {"chzzk": [follower], "afreeca": []}})
    land("raw_game_ccu", {"collect_time": "2024-3-9 18:30", "raw_game_ccu": [{"player_count": 8, "result": 1, "game_id": 1}]}, "year=2024/month=3/day=9/hour=18")
    block = {"final": 1, "initial": 2, "discount_percent": 50, "final_formatted": "₩ 500"}
    land("raw_game_price", {"raw_game_price": [{"success": True, "data": {"steam_appid": 1, "price_overview": block}}]})
    land("raw_game_rating", {"raw_game_rating": [{"game_id": 1, "all_positive_num": 9, "all_positive_percent": 80}]})
    land("raw_game_review", {"raw_game_review": [{"game_id": [1], "reviews": [{"recommendationid": "r", "review": "x", "voted_up": True}]}]})

    names = streamers({"streamer_id": "1", "streamer_nm": "S"})
    dimension = games({"game_id": "1", "game_nm": "One", "chz_game_code": "G1", "price": 1000, "game_banner_url": "u"})
    for _ in range(2):
        for table in (*refresh.DATED, *refresh.UNDATED):
            refresh.normalize_table(spark, root, table, day)
        refresh.load_raw_ccu(spark, root, "2024-03-10")
        built = refresh.refresh_marts(spark, root, names, dimension, as_of=day + timedelta(days=1), now=datetime(2024, 3, 10, 0))

    def mart(name):
        return refresh.read_built(spark, root, name, as_of=day, games=dimension)

    assert spark.read.parquet(f"{root}/raw_data/raw_game_ccu").count() == 1
    assert [(r["game_nm"], r["max_viewer_num"], r["game_duration"]) for r in mart("anal_broadcast").orderBy("broadcast_start_time").collect()] == [
        ("One", 20, 10.0), ("One", 40, 0.0),
    ]
    counts = {name: mart(name).count() for name in built}
    assert counts == {**dict.fromkeys(built, 1), "anal_tdy_game_rating": 0}
    for _ in range(2):  # the day is added to what was published, once
        added = refresh.refresh_broadcasts(spark, root, names, dimension, as_of=day + timedelta(days=1), full=False)
        assert sorted((r["game_nm"], r["game_duration"]) for r in added.collect()) == [("One", 0.0), ("One", 10.0), ("One", 30.0)]
        refresh.keep_up(spark, root, day + timedelta(days=1))
        assert [tuple(r)[:3] for r in mart("anal_week_broadcast_duration").collect()] == [("One", "S", 40.0)]


def test_work_folder_is_the_named_one(spark, shared_folder):
    a, b = work_folder(spark, "x"), work_folder(spark, "x")
    assert a.startswith(f"{shared_folder}/x-") and a != b


def test_read_documents_prunes(spark, tmp_path):
    where = tmp_path / "source" / "json" / "table_name=raw_game_ccu"
    for d in (1, 2):
        folder = where / f"year=2024/month=1/day={d}/hour=0"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text('{"collect_time":"2024-1-1 0:0","raw_game_ccu":[]}')
    assert landing.read_documents(spark, str(tmp_path), "raw_game_ccu", first=date(2024, 1, 2)).count() == 1


def test_sc1_broken_documents_are_listed_and_others_read(spark, tmp_path):
    """One whole document, one that breaks off, one that is no JSON, an empty file; over several lines and one to a line."""
    where = tmp_path / "source" / "json" / "table_name=raw_game_ccu" / "year=2024" / "month=1" / "day=5" / "hour=0"
    where.mkdir(parents=True)
    whole = {"collect_time": "2024-1-5 0:0", "raw_game_ccu": [{"player_count": 1, "result": 1, "game_id": 7}]}
    texts = {"whole": json.dumps(whole, indent=1), "cut": json.dumps(whole)[:-9], "no": "<html>", "empty": ""}
    for name, text in texts.items():
        (where / f"{name}.json").write_text(text)
    bad = landing.unreadable_documents(spark, str(tmp_path), "raw_game_ccu", first=date(2024, 1, 5), multiline=True).collect()
    assert sorted((r["file"].rsplit("/", 1)[1], r["document"], r["day"], r["hour"]) for r in bad) == [
        ("cut.json", texts["cut"], 5, 0), ("no.json", texts["no"], 5, 0),
    ]
    assert landing.unreadable_documents(spark, str(tmp_path), "raw_game_ccu", first=date(2024, 1, 6), multiline=True).count() == 0
    rows = normalize.game_ccu(landing.read_documents(spark, str(tmp_path), "raw_game_ccu", multiline=True))
    assert [r["game_id"] for r in rows.collect()] == ["7"]


def test_st1_reads_listed_folders_only(spark, tmp_path):
    where = tmp_path / "source" / "json" / "table_name=raw_game_ccu"
    for d in range(1, 9):
        folder = where / f"year=2024/month=1/day={d}/hour=0"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text('{"collect_time":"2024-1-1 0:0","raw_game_ccu":[]}')
    folders = [Row(year=2024, month=1, day=d, hour=0) for d in (2, 8)]
    rows = landing.read_folders(spark, str(tmp_path), "raw_game_ccu", folders)
    assert sorted(r["day"] for r in rows.select("day").collect()) == [2, 8] and len(rows.inputFiles()) == 2


def test_m13_reads_two_folders_of_the_published_mart(spark, tmp_path, games):
    """Other days' files can't even be opened, and it still comes out."""
    root = str(tmp_path)
    rows = spark.range(40).selectExpr(
        "'S' streamer_nm", "cast(id as string) broadcast_id", "concat('g', id % 4) game_nm", "'chzzk' platform", "'t' broadcast_title",
        "cast(id as int) max_viewer_num", "cast(id as int) avg_viewer_num", "timestamp'2024-03-01 12:00:00' + make_dt_interval(cast(id div 4 as int)) broadcast_start_time",
        "timestamp'2024-03-01 13:00:00' + make_dt_interval(cast(id div 4 as int)) broadcast_end_time", "60.0D game_duration", "date'2024-03-20' created_date",
    )
    refresh.publish_broadcasts(rows, root)
    assert sorted(refresh.read_broadcasts(spark, root).collect()) == sorted(rows.collect())
    days = (date(2024, 3, 4), date(2024, 3, 5))
    dimension = games(*({"game_id": str(i), "game_nm": f"g{i}"} for i in range(4)))
    picked = marts.yesterday_game_rank(refresh.read_broadcasts(spark, root, started=days), dimension, as_of=date(2024, 3, 5))
    assert any("start_day" in f for f in pruned(picked))
    for path in tmp_path.rglob("*.parquet"):
        if not any(f"start_day=2024-03-0{d}/" in str(path) for d in (4, 5)):
            path.write_text("no Parquet")
    whole = marts.yesterday_game_rank(rows, dimension, as_of=date(2024, 3, 5))
    assert sorted(picked.collect()) == sorted(whole.collect()) and picked.count() == 4
