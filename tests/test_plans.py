"""What the plans of all queries must not hold, and how a hot key fares."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from airtally.operators.lookups import resolve_codes
from airtally.plans.marts import with_names
from airtally.reports.queries import QUERIES
from places import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.001"
# Queries that write and read files plan their work while they run.
WRITES = ("sc", "sk", "st")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITES)))
def test_no_nested_loops_and_no_python_rows(name, spark):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "EvalPython", "InPandas"):
        assert bad not in plan


def test_codes_equal_the_or_join(spark, games, rows):
    codes = spark.createDataFrame([(c,) for c in ("G1", "001", "1", "000", "", "0", None, "G1")], "code string")
    dimension = games(
        {"game_id": "1", "chz_game_code": "G1", "afc_game_code": "1"},
        {"game_id": "2", "chz_game_code": "1", "afc_game_code": "1"},
        {"game_id": "3", "chz_game_code": "", "afc_game_code": ""},
        {"game_id": "3", "chz_game_code": "", "afc_game_code": ""},
        {"game_id": "4", "afc_game_code": "G1"},
    )
    ours = resolve_codes(codes, dimension, ["game_id"])
    theirs = (
        codes.distinct()
        .join(dimension, F.expr("code = chz_game_code OR ltrim('0', code) = afc_game_code"))
        .select("code", "game_id")
    )
    assert rows(ours) == rows(theirs)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_hot_code_is_split_where_names_are_joined(spark, games, streamers):
    """Two thirds of 40 000 broadcasts play one game; without broadcasts, its partition is read in pieces."""
    facts = spark.range(40_000).selectExpr(
        "cast(id as string) streamer_id", "uuid() broadcast_id", "if(id % 3 > 0, 'hot', concat('g', id % 50)) n_game_code",
        "uuid() title",
    )
    names = games({"game_id": "1", "game_nm": "Hot", "chz_game_code": "hot"}, {"game_id": "2", "game_nm": "Seven", "chz_game_code": "g7"})
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        named = with_names(facts, streamers(), names)
        out = named.groupBy("streamer_nm", "broadcast_id", "dim_game_nm", "n_game_code").agg(F.min("title"))
        counts = out.groupBy("dim_game_nm").count()
        got = {r["dim_game_nm"]: r["count"] for r in counts.collect()}
        plan = plan_of(counts)
    finally:
        for key in SKEW:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got["Hot"] == sum(1 for i in range(40_000) if i % 3 > 0)
    assert "skew=true" in plan, plan


@pytest.mark.parametrize("name", ["m1_broadcast", "m3_game_price", "m11_week_game_viewer", "m12_yesterday_game_ccu"])
def test_same_rows_without_broadcasts(name, spark, rows):
    run = contract.queries()[name]
    expected = rows(run(spark, SF_DIR))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(run(spark, SF_DIR)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_scans_read_only_the_columns_they_need(spark):
    plan = plan_of(contract.queries()["m12_yesterday_game_ccu"](spark, SF_DIR))
    schemas = [part.split("\n")[0] for part in plan.split("ReadSchema: ")[1:]]
    assert not any("props" in s or "event_type" in s for s in schemas)


def test_no_row_holds_all_games_of_a_code(spark, games, streamers, rows):
    """A code of half of 20 000 games: no list is made of them, and the join gives what the OR join gives."""
    many = spark.range(20_000).selectExpr(
        "cast(id as string) game_id", "concat('n', id) game_nm", "if(id % 2 = 0, 'hot', if(id % 3 = 0, null, concat('c', id % 100))) chz_game_code",
        "if(id % 5 = 0, 'hot', if(id % 7 = 0, '7', null)) afc_game_code",
    )
    facts = spark.createDataFrame([(c,) for c in ("hot", "c1", "007", "7", "none", "talk", "000")], "n_game_code string").selectExpr("'s' streamer_id", "n_game_code broadcast_id", "n_game_code")
    named = with_names(facts, streamers({"streamer_id": "s", "streamer_nm": "S"}), many)
    plan = plan_of(named)
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan
    theirs = facts.join(many, F.expr("n_game_code = chz_game_code OR ltrim('0', n_game_code) = afc_game_code"), "left")
    assert rows(named, "n_game_code", "dim_game_nm") == rows(theirs, "n_game_code", "game_nm")
