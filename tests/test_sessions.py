"""Gap sessions against a plain loop over the rows."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from airtally.functions.codes import code_track, normalized_code
from airtally.operators.sessions import cut_cells, gap_sessions

START = datetime(2024, 1, 1)
GAP = timedelta(minutes=5)
MEASURES = {"title": ("min", "title"), "top": ("max", "n"), "total": ("sum", "n"), "rows": ("count", "n")}
SCHEMA = "b string, code string, platform string, ts timestamp, title string, n int"


def by_hand(table, gap=GAP):
    """Row by row: the step is taken on the raw code, the numbers are counted on the normalised one."""
    order = {None: 0, "": 1, "talk": 2}
    norm = lambda c: c or "talk"
    last, number, sessions = {}, {}, {}
    for b, code, platform, ts, title, n in sorted(
        table, key=lambda r: (r[0], norm(r[1]), r[3], order.get(r[1], 3), str(r[1]))
    ):
        track, group = (b, code), (b, norm(code))
        starts = track in last and ts - gap > last[track]
        last[track] = ts
        number[group] = number.get(group, 0) + starts
        key = (*group, platform, number[group])
        sessions.setdefault(key, []).append((ts, title, n))
    return sorted(
        (b, code, platform, min(t for t, _, _ in rows), max(t for t, _, _ in rows), min(x for _, x, _ in rows),
         max(n for _, _, n in rows), sum(n for _, _, n in rows), len(rows))
        for (b, code, platform, _), rows in sessions.items()
    )


def by_spark(spark, table, gap=GAP):
    """Both ways of folding shared keys, which must agree."""
    often, seldom = (_by_spark(spark, table, gap, dense) for dense in (True, False))
    assert often == seldom
    return often


def _by_spark(spark, table, gap, dense):
    df = spark.createDataFrame(table, SCHEMA).withColumn("norm", normalized_code("code"))
    out = gap_sessions(
        df, ["b", "norm"], "ts", gap, MEASURES,
        track=code_track("code"), tracks=3, split_tracks=F.col("norm") == "talk", also=("platform",), dense=dense,
    )
    picked = out.select("b", "norm", "platform", "session_start", "session_end", *MEASURES)
    return sorted(tuple(r) for r in picked.collect())


def at(seconds):
    return START + timedelta(seconds=seconds)


def test_exact_gap_stays_and_one_second_more_splits(spark):
    table = [("b", "g", "p", at(s), "t", 1) for s in (0, 300, 601)]
    assert [r[3:5] for r in by_spark(spark, table)] == [(at(0), at(300)), (at(601), at(601))]


def test_talk_codes_have_histories_of_their_own(spark):
    # Each of the three steps twice; a break of one of them divides the others.
    table = [
        ("b", code, "p", at(s), f"{code}{s}", s)
        for code, times in ((None, (0, 900)), ("", (100, 400, 700, 1000)), ("talk", (50, 350, 2000)))
        for s in times
    ]
    assert by_spark(spark, table) == by_hand(table)
    assert len(by_spark(spark, table)) == 3


def test_overlapping_platforms_do_not_split_a_session(spark):
    # In the slice [0, 300) platform q ends before p does; the step to 520 is from p's last row.
    table = [("b", "g", "p", at(0), "t", 1), ("b", "g", "p", at(290), "t", 1), ("b", "g", "q", at(10), "t", 1),
             ("b", "g", "q", at(520), "t", 1)]
    assert by_spark(spark, table) == by_hand(table)
    assert len(by_spark(spark, table)) == 2


def test_rows_without_time_belong_to_the_last_session(spark):
    table = [("b", "g", "p", at(0), "t", 1), ("b", "g", "p", at(900), "u", 2), ("b", "g", "p", None, "v", 4)]
    assert [r[3:] for r in by_spark(spark, table)] == [(at(0), at(0), "t", 1, 1, 1), (at(900), at(900), "u", 4, 6, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_random_tables(spark, seed):
    rng = random.Random(seed)
    table = [
        (
            rng.choice("ab"),
            rng.choice([None, "", "talk", "g", "h"]),
            rng.choice("pq"),
            at(rng.randrange(0, 30_000)),
            rng.choice("xyz"),
            rng.randrange(100),
        )
        for _ in range(400)
    ]
    assert by_spark(spark, table) == by_hand(table)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.just("b"),
            st.sampled_from([None, "", "talk", "g"]),
            st.sampled_from(["p", "q"]),
            st.integers(0, 12).map(lambda k: at(150 * k)),
            st.sampled_from(["x", "y"]),
            st.integers(0, 9),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_any_small_table(spark, table):
    assert by_spark(spark, table) == by_hand(table)


def test_sessions_hold_every_row_once(spark):
    rng = random.Random(7)
    table = [("b", rng.choice(["", "g"]), "p", at(rng.randrange(0, 90_000)), "t", 1) for _ in range(500)]
    out = by_spark(spark, table)
    assert sum(r[-1] for r in out) == len(table)
    for code in ("talk", "g"):
        spans = sorted(r[3:5] for r in out if r[1] == code)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def records_read_from_shuffles(spark, action):
    """Largest number of records any stage of the action read from a shuffle."""
    context = spark.sparkContext
    store = context._jsc.sc().statusStore()

    def stages():
        listed = store.stageList(None, False, False, context._gateway.new_array(context._jvm.double, 0), None)
        return {listed.apply(i).stageId(): listed.apply(i) for i in range(listed.size())}

    before = set(stages())
    result = action()
    return result, max(s.shuffleReadRecords() for i, s in stages().items() if i not in before)


@pytest.mark.parametrize("code", ["g", ""])
def test_hot_key_is_folded_before_it_is_shuffled(spark, code):
    """100 000 snapshots of one broadcast leave each task as one row per slice, or per collect time."""
    hot = spark.range(0, 100_000, 1, 8).selectExpr(
        "'b' b", f"'{code}' code", "'p' platform", "timestamp_seconds(1704067200 + (id % 50) * 60) ts", "'t' title", "1 n"
    )
    df = hot.withColumn("norm", normalized_code("code"))
    sessions = gap_sessions(
        df, ["b", "norm"], "ts", GAP, MEASURES,
        track=code_track("code"), tracks=3, split_tracks=F.col("norm") == "talk", also=("platform",),
    )
    out, read = records_read_from_shuffles(spark, sessions.collect)
    assert [(r["rows"], r["total"]) for r in out] == [(100_000, 100_000)]
    # Eight tasks; fifty collect times lie in ten slices.
    assert read == 8 * (10 if code else 50)


def test_windows_of_a_hot_talk_broadcast_see_slices(spark):
    """A snapshot a second on three tracks, one of which breaks off now and then: cells are a few per slice, not one per second."""
    seconds = 20_000
    hot = spark.range(0, 3 * seconds, 1, 8).selectExpr(
        "'b' b", "element_at(array(null, '', 'talk'), cast(id % 3 + 1 as int)) code", "'p' platform",
        "timestamp_seconds(1704067200 + id div 3) ts", "'t' title", "1 n",
    ).where("code is null or code = '' or (unix_seconds(ts) div 700) % 2 = 0")
    rows = hot.withColumn("norm", normalized_code("code")).withColumns({"_hash": F.xxhash64("b", "norm"), "_track": code_track("code")})
    cells = cut_cells(rows, ["b", "norm"], "ts", int(GAP.total_seconds()) * 10**6, MEASURES, 3, ("platform",))
    slices = seconds / GAP.total_seconds()
    breaks = seconds // 1400
    assert cells.count() <= 3 * (slices + 1) + 3 * (breaks + 1)
    assert cells.agg(F.sum("rows")).first()[0] == rows.count()
    table = [tuple(r) for r in hot.collect()]
    assert len(by_hand(table)) > 10 and by_spark(spark, table) == by_hand(table)
