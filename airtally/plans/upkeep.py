"""Marts over broadcasts kept up from increments.

Each load of broadcasts, a day or a whole rebuild, is folded once to figures that
add up over loads: sums, counts and extremes per streamer, game and platform, and
the set of broadcasts per streamer and game. Both lie in buckets of streamers. A new
load recomputes the marts of the streamers that it has, from the figures of all
loads in their buckets; other buckets keep the files they had. A log entry
then names the figures of every load and the files of every bucket, so that a
refresh is seen as a whole or not at all, and the same load again takes the place of
itself.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airtally.functions.codes import is_game
from airtally.operators.games import MERGE, NAMES, ByCode, Dealt, deal, distinct_per_game, per_game, spell
from airtally.operators.ordered import top_per_group
from airtally.sources.log import entry_path, last_number, put_if_absent, read_entry

#: Over how many buckets streamers are dealt; fixed for the life of a folder.
BUCKETS = 64
MICROS = 60_000_000
FIGURES = """streamer_nm string, game_nm string, platform string, stretches long, micros long, viewers long, viewer_rows long,
    max_viewer_num int, broadcasts long, long_stretches long, duration double, duration_rows long,
    max_duration double, min_duration double, mark string, bucket int"""
SEEN = "streamer_nm string, game_nm string, broadcast_id string, mark string, bucket int"
#: Loads under codes have figures and sets of their own, by code, and the names of their codes.
SCHEMAS = {
    "figures": FIGURES,
    "seen": SEEN,
    "code_figures": FIGURES.replace("game_nm", "n_game_code"),
    "code_seen": SEEN.replace("game_nm", "n_game_code"),
}
#: Rows of a mart that stand for names of a list: the list's files and slot, and the names that are rows of their own.
LISTED = "list_mark string, list_slot string, list_but array<string>"
LISTS = "_slot string, games array<string>, list_mark string"
#: What is read of a load.
LOAD = """streamer_nm string, broadcast_id string, game_nm string, platform string, max_viewer_num int, avg_viewer_num int,
    game_duration double"""


def figures(broadcasts: DataFrame, game: str = "game_nm") -> DataFrame:
    """What adds up: one row per streamer, game, or code, and platform of a load."""
    lasting = F.col("game_duration") != 0
    lasting = is_game(game) & lasting if game == "game_nm" else lasting

    def of(column: str) -> Column:
        return F.when(lasting, F.col(column))

    return broadcasts.groupBy("bucket", "streamer_nm", game, "platform").agg(
        F.count(F.lit(1)).alias("stretches"),
        F.sum(F.round(F.col("game_duration") * MICROS).cast("long")).alias("micros"),
        F.sum(of("avg_viewer_num")).alias("viewers"),
        F.count(of("avg_viewer_num")).alias("viewer_rows"),
        F.max(of("max_viewer_num")).alias("max_viewer_num"),
        F.count(of("broadcast_id")).alias("broadcasts"),
        F.count(of("game_duration")).alias("long_stretches"),
        F.sum(of("game_duration")).alias("duration"),
        F.count(of("game_duration")).alias("duration_rows"),
        F.max(of("game_duration")).alias("max_duration"),
        F.min(of("game_duration")).alias("min_duration"),
    )


def seen(broadcasts: DataFrame, game: str = "game_nm") -> DataFrame:
    """Which broadcasts a streamer has had of a game, or code, a row each."""
    return broadcasts.where(F.col("broadcast_id").isNotNull()).select("bucket", "streamer_nm", game, "broadcast_id").distinct()


def _rank(of_loads: ByCode, dealt: Dealt | None, measure: str, name: str, rank: str, n: int = 3) -> DataFrame:
    rows = per_game(of_loads.folded(["streamer_nm", "platform"], [F.sum(measure).alias(name)]), dealt, ["platform"], {name: "sum"})
    totals = (spell(rows, dealt.lists, first=n) if dealt else rows).where(is_game("game_nm"))
    order = [F.col(name).desc_nulls_first(), F.col("game_nm")]
    none = F.lit(None)
    unlisted = {"_mass": F.lit(False), "_slot": none.cast("string"), "_but": none.cast("array<string>")}
    return top_per_group(totals, ["streamer_nm", "platform"], order, n, rank).withColumns(unlisted)


def _count_rank(of_loads: ByCode, met: ByCode, dealt: Dealt | None) -> DataFrame:
    return _rank(of_loads, dealt, "stretches", "total_broadcast_count", "count_rank")


def _duration_rank(of_loads: ByCode, met: ByCode, dealt: Dealt | None) -> DataFrame:
    name = "total_broadcast_duration"
    return _rank(of_loads, dealt, "micros", name, "duration_rank").withColumn(name, _minutes(name))


def _minutes(column: str) -> Column:
    return F.col(column) / F.lit(float(MICROS))


def _radar(of_loads: ByCode, met: ByCode, dealt: Dealt | None) -> DataFrame:
    kinds = {"viewers": "sum", "viewer_rows": "sum", "max_viewer_num": "max", "broadcasts": "sum", "duration": "sum", "duration_rows": "sum",
             "max_duration": "max", "min_duration": "min"}
    folds = [MERGE[kind](name).alias(name) for name, kind in kinds.items()]
    lasting = of_loads.each(lambda df: df.where(F.col("long_stretches") > 0)).folded(["streamer_nm"], folds)
    rows = per_game(lasting, dealt, [], kinds).where(F.col("_mass") | is_game("game_nm"))
    return rows.withColumns(
        {
            "avg_viewer_num": F.col("viewers") / F.nullif(F.col("viewer_rows"), F.lit(0)),
            "total_broadcast_count": F.col("broadcasts"),
            "avg_broadcast_duration": F.col("duration") / F.col("duration_rows"),
            "max_broadcast_duration": F.col("max_duration"),
            "min_broadcast_duration": F.col("min_duration"),
        }
    )


def _week_duration(of_loads: ByCode, met: ByCode, dealt: Dealt | None) -> DataFrame:
    name = "broadcast_duration"
    rows = per_game(of_loads.folded(["streamer_nm"], [F.sum("micros").alias(name)]), dealt, [], {name: "sum"})
    return rows.withColumn(name, _minutes(name))


def _week_freq(of_loads: ByCode, met: ByCode, dealt: Dealt | None) -> DataFrame:
    def groups(figures: DataFrame, broadcasts: DataFrame, game: str) -> DataFrame:
        return figures.select("streamer_nm", game, F.lit(None).cast("string").alias("broadcast_id")).unionByName(broadcasts.select("streamer_nm", game, "broadcast_id"))

    rows = None if of_loads.rows is None else groups(of_loads.rows, met.rows, "n_game_code")
    every = ByCode(rows, of_loads.names, groups(of_loads.named, met.named, "game_nm"))
    return distinct_per_game(every.folded(["streamer_nm", "broadcast_id"], []), dealt, "broadcast_id", "broadcast_freq")


#: Marts that can be kept up: name -> (rows from figures and sets, columns in the order of the rebuilt mart, whether it shows banners).
MARTS: dict[str, tuple[Callable[[ByCode, ByCode, Dealt | None], DataFrame], list[str], bool]] = {
    "anal_streamer_count_rank": (_count_rank, ["streamer_nm", "game_nm", "platform", "count_rank", "total_broadcast_count"], True),
    "anal_streamer_duration_rank": (_duration_rank, ["streamer_nm", "game_nm", "platform", "duration_rank", "total_broadcast_duration"], True),
    "anal_streamer_game_rader": (
        _radar,
        ["streamer_nm", "game_nm", "avg_viewer_num", "max_viewer_num", "total_broadcast_count", "avg_broadcast_duration",
         "max_broadcast_duration", "min_broadcast_duration"],
        False,
    ),
    "anal_week_broadcast_duration": (_week_duration, ["game_nm", "streamer_nm", "broadcast_duration"], False),
    "anal_week_broadcast_freq": (_week_freq, ["game_nm", "streamer_nm", "broadcast_freq"], False),
}


def _log(folder: str) -> str:
    return f"{folder.rstrip('/')}/log"


def state(spark: SparkSession, folder: str) -> dict:
    """The last log entry: its version, the mark of each load's figures, and the mark of each bucket's mart files."""
    number = last_number(spark, _log(folder))
    return json.loads(read_entry(spark, _log(folder), number)) if number else {"version": 0, "loads": {}, "parts": {}}


def _read(spark: SparkSession, root: str, marks: set[str], schema: str, wanted: Column) -> DataFrame:
    """Rows of the named marks; folders that `wanted`, a condition on mark and bucket, leaves out are not read."""
    if not marks:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", root)
    return reader.parquet(*[f"{root}/mark={mark}" for mark in sorted(marks)]).where(wanted)


def _of_loads(spark: SparkSession, folder: str, table: str, marks: set[str], buckets: list[int]) -> DataFrame:
    return _read(spark, f"{folder}/{table}", marks, SCHEMAS[table], F.col("bucket").isin(buckets))


def _loaded(spark: SparkSession, folder: str, kind: str, marks: set[str], coded: set[str], touched: list[int], streamers: DataFrame, names: DataFrame) -> ByCode:
    """The touched streamers' figures or sets of all loads; a code is one of its load."""
    named = _touched(_of_loads(spark, folder, kind, marks, touched), streamers, "left_semi").drop("mark")
    if not coded:
        return ByCode(None, None, named)
    rows = _touched(_of_loads(spark, folder, f"code_{kind}", coded, touched), streamers, "left_semi")
    return ByCode(_of_mark(rows), names, named)


def _of_mark(rows: DataFrame) -> DataFrame:
    return rows.withColumn("n_game_code", F.concat("mark", F.lit(":"), "n_game_code")).drop("mark")


def _of_parts(spark: SparkSession, folder: str, name: str, parts: dict[str, str], schema: str) -> DataFrame:
    """A mart's rows in the buckets of `parts`, each in the files that the log names for it."""
    by_mark: dict[str, list[int]] = {}
    for bucket, mark in parts.items():
        by_mark.setdefault(mark, []).append(int(bucket))
    wanted = F.lit(False)
    for mark, buckets in by_mark.items():
        wanted = wanted | ((F.col("mark") == mark) & F.col("bucket").isin(buckets))
    return _read(spark, f"{folder}/{name}", set(by_mark), f"{schema}, mark string, bucket int", wanted).drop("mark")


def _schema(spark: SparkSession, name: str) -> str:
    make, columns, _ = MARTS[name]
    of_loads, met = (ByCode(None, None, spark.createDataFrame([], SCHEMAS[kind])) for kind in ("figures", "seen"))
    empty = make(of_loads, met, None).select(*columns)
    return ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in empty.schema.fields), LISTED])


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _streamers(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("bucket").alias("_bucket"), F.col("streamer_nm").alias("_streamer")).distinct()


def _touched(rows: DataFrame, streamers: DataFrame, how: str) -> DataFrame:
    """The rows of these streamers, or of all others; a streamer without a name is one as well."""
    return rows.join(streamers, (F.col("bucket") == F.col("_bucket")) & F.col("streamer_nm").eqNullSafe(F.col("_streamer")), how)


def add_load(broadcasts: DataFrame | ByCode, folder: str, load: str, *, replace_all: bool = False, buckets: int = BUCKETS) -> int:
    """Put one load of broadcasts into the kept marts; returns the version of the log.

    A load of a name that is there takes its place. replace_all drops all others,
    as a full rebuild does. Figures are written first; the marts of the touched
    streamers are then computed on the last log entry, and again if another load has
    been put in meanwhile. `broadcasts` is read twice: store it first if it is dear.
    A load under codes is folded under them: neither its figures nor the marts' files have a
    row for each streamer and each of the names of a code that has very many.
    """
    under_codes = isinstance(broadcasts, ByCode)
    spark, folder = (broadcasts.rows if under_codes else broadcasts).sparkSession, folder.rstrip("/")
    mark = uuid.uuid4().hex[:12]
    bucket = F.pmod(F.xxhash64("streamer_nm"), F.lit(buckets)).cast("int")
    named = broadcasts.named if under_codes else broadcasts
    named = (spark.createDataFrame([], LOAD) if named is None else named).withColumn("bucket", bucket)
    folded = {"figures": figures(named), "seen": seen(named)}
    if under_codes:
        rows = broadcasts.rows.withColumn("bucket", bucket)
        folded |= {"code_figures": figures(rows, "n_game_code"), "code_seen": seen(rows, "n_game_code")}
        broadcasts.names.write.parquet(f"{folder}/names/mark={mark}")
    for table, of_table in folded.items():
        of_table.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{folder}/{table}/mark={mark}")
    while True:
        old = state(spark, folder)
        before = {m for name, m in old["loads"].items() if replace_all or name == load}
        loads = {load: mark} if replace_all else {**old["loads"], load: mark}
        marks, attempt = set(loads.values()), uuid.uuid4().hex[:12]
        coded = {*old.get("coded", []), *([mark] if under_codes else [])}
        fresh = _streamers(_read(spark, f"{folder}/figures", {mark, *before}, FIGURES, F.lit(True))).unionByName(
            _streamers(_read(spark, f"{folder}/code_figures", coded & {mark, *before}, SCHEMAS["code_figures"], F.lit(True)))
        )
        streamers = fresh.distinct()
        touched = sorted(r[0] for r in fresh.select("_bucket").distinct().collect())  # at most `buckets` numbers
        coded &= marks
        names = _of_mark(_read(spark, f"{folder}/names", coded, f"{NAMES}, mark string", F.lit(True)))
        of_loads, met = (_loaded(spark, folder, kind, marks, coded, touched, streamers, names) for kind in ("figures", "seen"))
        # Stored, as every mart's plan has them.
        dealt = deal(names).each(lambda df, name: _stored(df, f"{folder}/{name}/list_mark={attempt}")) if coded else None
        listed = {
            "list_mark": F.when(F.col("_mass"), F.lit(attempt)),
            "list_slot": F.when(F.col("_mass"), F.col("_slot")),
            "list_but": F.when(F.col("_mass"), F.col("_but")),
            "bucket": bucket,
        }
        parts = {b: m for b, m in old["parts"].items() if int(b) in touched}
        for name, (make, columns, _) in MARTS.items():
            kept = _touched(_of_parts(spark, folder, name, parts, _schema(spark, name)), streamers, "left_anti")
            part = make(of_loads, met, dealt).withColumns(listed).select(*columns, *listed).unionByName(kept.select(*columns, *listed))
            part.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{folder}/{name}/mark={attempt}")
        version = old["version"] + 1
        entry = {"version": version, "loads": loads, "parts": {**old["parts"], **{str(b): attempt for b in touched}}, "coded": sorted(coded),
                 "lists": [*old.get("lists", []), *([attempt] if coded else [])]}
        if put_if_absent(spark, entry_path(_log(folder), version), json.dumps(entry)):
            return version


def read_kept(spark: SparkSession, folder: str, name: str, *, as_of: date, games: DataFrame | None = None) -> DataFrame:
    """A kept mart as its rebuild gives it; banners come from the games as they are now."""
    _, columns, banners = MARTS[name]
    folder = folder.rstrip("/")
    now = state(spark, folder)
    rows = _of_parts(spark, folder, name, now["parts"], _schema(spark, name)).drop("bucket")
    if now.get("lists"):
        lists = spark.read.schema(LISTS).option("basePath", f"{folder}/lists").parquet(*[f"{folder}/lists/list_mark={m}" for m in now["lists"]])
        of_list = {"_mass": F.col("list_slot").isNotNull(), "_slot": F.col("list_slot"), "_but": F.col("list_but")}
        rows = spell(rows.withColumns(of_list).drop("list_slot", "list_but"), lists, ("_slot", "list_mark"))
    rows = rows.select(*columns)
    if banners:
        rows = rows.join(games.select("game_nm", "game_banner_url"), "game_nm", "left").select(*columns, "game_banner_url")
    return rows.withColumn("created_date", F.lit(as_of))
