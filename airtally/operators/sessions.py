"""Gap sessions."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Measures are kept as partial aggregates that can be merged again.
_MERGE = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}
_START = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


def gap_sessions(
    df: DataFrame,
    by: list[str],
    ts: str,
    gap: timedelta,
    measures: dict[str, tuple[str, str]],
    *,
    track: Column | None = None,
    tracks: int = 1,
    split_tracks: Column | None = None,
    also: tuple[str, ...] = (),
    dense: bool = False,
) -> DataFrame:
    """One row per session with its measures, `session_start` and `session_end`.

    A row starts a new session of `by` when it is more than `gap` after the row
    before it on the same `track`, a number below `tracks` (default: one track).
    Session numbers count over all tracks of `by`, in the order of time, then
    track. `also` columns split the output rows, not the sessions.
    Rows without time belong to the last session.

    Rows are first folded into cells: all rows of one track within an aligned
    slice of time no longer than the gap. No session can start inside a cell
    but at its first row, so cells carry all there is to know, and a hot key's
    rows are combined before they are shuffled. The windows below then see at
    most (time range / gap) rows of a key, however many rows it has.

    `split_tracks`, a condition on columns of `by`, marks the keys that have
    several tracks; all others must have one. There a start on one track also
    divides the rows of the others, so cells are one per distinct time. Where rows
    come once a gap or less often, as those of one poll do, there are no more of
    these than slices. `dense` is for rows that come more often: cells are
    slices cut at such starts (`cut_cells`), at most `tracks` of a slice and
    track, for the price of some more shuffles of folded rows.

    measures: name -> (min | max | sum | count, column).
    """
    width = gap // timedelta(microseconds=1)
    rows = df.withColumns({"_hash": F.xxhash64(*by), "_track": F.lit(0) if track is None else track})
    if split_tracks is None:
        return _numbered(_cells(rows, by, ts, width, measures, also), by, width, measures, tracks, also)
    if not dense:
        width_at = F.when(split_tracks, F.lit(1)).otherwise(F.lit(width))
        return _numbered(_cells(rows, by, ts, width_at, measures, also), by, width, measures, tracks, also)
    shared = F.coalesce(split_tracks, F.lit(False))
    single = rows.where(~shared).withColumn("_track", F.lit(0))
    plain = _numbered(_cells(single, by, ts, width, measures, also), by, width, measures, 1, also)
    cut = cut_cells(rows.where(shared), by, ts, width, measures, tracks, also)
    return plain.unionByName(_numbered(cut, by, width, measures, tracks, also))


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _slice(micros: Column, width: int | Column) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return micros - F.coalesce(F.pmod(micros, F.nullif(width, F.lit(0))), F.lit(0))


def _merged(measures: dict[str, tuple[str, str]]) -> list[Column]:
    return [
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        *[_MERGE[kind](name).alias(name) for name, (kind, _) in measures.items()],
    ]


def _cells(rows: DataFrame, by: list[str], ts: str, width: int | Column, measures: dict, also: tuple[str, ...], fine: bool = False) -> DataFrame:
    """Rows of one track folded by slice, or by distinct time within slices. A hash before the keys lets sorts mostly compare one number."""
    keys = ["_hash", *by, "_track", *also, _slice(_micros(ts), width).alias("_cell")]
    return rows.groupBy(*keys, *([_micros(ts).alias("_at")] if fine else [])).agg(
        F.min(ts).alias("session_start"),
        F.max(ts).alias("session_end"),
        *[_START[kind](column).alias(name) for name, (kind, column) in measures.items()],
    )


def _starting(cells: DataFrame, by: list[str], width: int, tracks: int) -> DataFrame:
    """The cells laid out by key, each with `_starts`, 1 if it starts a session on its track."""
    # All windows share one order, so that rows are sorted once.
    before = _in_order(by).rowsBetween(Window.unboundedPreceding, -1)

    def on(number: int) -> Column:
        return F.col("_track") == number

    last_on_track = F.coalesce(
        *[F.when(on(n), F.max(F.when(on(n), F.col("session_end"))).over(before)) for n in range(tracks)]
    )
    starts = _micros("session_start") - width > F.unix_micros(last_on_track.cast("timestamp"))
    return cells.repartition(*by).withColumn("_starts", F.when(starts, 1).otherwise(0))


def _in_order(by: list[str]):
    return Window.partitionBy("_hash", *by).orderBy(F.col("session_start").asc_nulls_last(), "_track")


def _numbered(
    cells: DataFrame, by: list[str], width: int, measures: dict, tracks: int, also: tuple[str, ...]
) -> DataFrame:
    """Cells with the number of their session, folded to sessions."""
    # Peers are counted together, so one of them starting a session is enough.
    so_far = _in_order(by).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        _starting(cells, by, width, tracks)
        .withColumn("group_id", F.sum("_starts").over(so_far))
        .groupBy("_hash", *by, *also, "group_id")
        .agg(*_merged(measures))
        .drop("_hash")
    )


def cut_cells(
    rows: DataFrame, by: list[str], ts: str, width: int, measures: dict, tracks: int, also: tuple[str, ...]
) -> DataFrame:
    """Cells by slice, cut where another track starts a session inside them.

    Rows are folded by distinct time, then by slice; where the slices tell of a start on
    another track between a cell's first row and its last, its times are folded
    again, apart before and after it. Only those slices are.
    """
    cell = ["_hash", *by, "_track", *also, "_cell"]
    fine = _cells(rows, by, ts, width, measures, also, fine=True)
    # The first and last time are taken from the folded times, in the unit that cuts are compared in.
    sliced = fine.groupBy(*cell).agg(*_merged(measures), F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    coarse = _starting(sliced, by, width, tracks)
    of_slice = Window.partitionBy("_hash", *by, "_cell")
    place = F.struct(F.col("_from").alias("t"), F.col("_track").alias("k"))
    cuts = F.collect_list(F.when(F.col("_starts") == 1, place)).over(of_slice)
    end = F.struct(F.col("_to").alias("t"), F.col("_track").alias("k"))
    inside = F.filter(cuts, lambda c: (c["k"] != F.col("_track")) & (c > place) & (c <= end))
    marked = coarse.withColumn("_cuts", inside)
    whole = marked.where(F.size("_cuts") == 0).select(*cell, "session_start", "session_end", *measures)
    open_ = marked.where(F.size("_cuts") > 0).select(*[F.col(c).alias(f"_r{c}") for c in cell], "_cuts")
    equal = F.lit(True)
    for c in cell:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_r{c}"))
    own = F.struct(F.col("_at").alias("t"), F.col("_track").alias("k"))
    parts = (
        fine.join(open_, equal)
        .withColumn("_part", F.size(F.filter("_cuts", lambda c: c <= own)))
        .groupBy(*cell, "_part")
        .agg(*_merged(measures))
        .drop("_part")
    )
    return whole.unionByName(parts.select(*whole.columns))
