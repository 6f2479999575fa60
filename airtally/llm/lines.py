"""Line dedup: repeated runs of lines found by prefix doubling, later copies deleted. DataFrame functions only.

A document is the sequence of its lines that have a word. Prefix doubling ranks
all runs of 1, 2, 4, ... lines: a run of 2**(k+1) lines is the pair of ranks of
its halves, the repeated pairs are sorted over the cluster, and their places in
that order are the ranks of the next round. This is the order of the suffixes
by their first 2**k lines; suffixes of equal rank form an interval in which the
longest common prefix is at least that long. Runs that occur once drop out, as
they can't be part of a repeated one.

A run of m lines is then named by the ranks of its first and last 2**k lines,
2**k the power next below m, and equal names are the interval of all suffixes
that share m lines. Only runs of at least min_words words count. The shortest
such runs from each line on and up to each line cover every longer one, so that
these are the ones looked up, and their lengths bound the number of rounds.
Runs of fewer words can count too, if they are hot: then each of them is looked
up, and counts if its words times its places reach a bound of their own.
Of each interval the first run stays, in the order of documents and lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 30


def _free(names: list[str], name: str) -> str:
    while any(name.lower() == n.lower() for n in names):
        name = "_" + name
    return name


def _sorted_ranks(groups: DataFrame, *keys: str) -> DataFrame:
    """The groups with a rank each: their place in the order of the keys over all partitions."""
    order = groups.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(order.withColumn("rank", F.monotonically_increasing_id()), "ranks")


def _ranked(runs: DataFrame, *keys: str) -> DataFrame:
    """Runs whose keys occur more than once, with the keys replaced by their rank."""
    groups = runs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return stored(runs.join(_sorted_ranks(groups, *keys), [*keys]).select("uid", "seq", "rank"), "runs")


def line_table(docs: DataFrame, uid: str, id_col: str, text_col: str) -> DataFrame:
    """Lines with a word: uid, doc (for the order), seq (among these), pos (in the text), words, and a hash of 128 bits."""
    lines = F.transform(F.split(F.col(text_col).cast("string"), "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line")))
    worded = F.filter(lines, lambda s: s["line"].rlike(WORD))
    rows = docs.select(F.col(uid).alias("uid"), F.col(id_col).alias("doc"), F.posexplode(worded).alias("seq", "s"))
    line = F.col("s.line")
    return rows.select(
        "uid", "doc", "seq", F.col("s.pos").alias("pos"),
        F.regexp_count(line, F.lit(WORD)).cast("long").alias("words"),
        F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2"),
    )


def shortest_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """The shortest runs of min_words words from each line on and up to each line: uid, doc, start, m, first_pos, last_pos."""
    whole = Window.partitionBy("uid").orderBy("seq")
    places = lines.withColumns(
        {
            "upto": F.sum("words").over(whole),
            "pos_before": F.lag("pos").over(whole),
            "pos_after": F.lead("pos").over(whole),
        }
    ).withColumn("before", F.col("upto") - F.col("words"))
    by_doc = Window.partitionBy("uid")
    ahead = by_doc.orderBy("before").rangeBetween(min_words, Window.unboundedFollowing)
    behind = by_doc.orderBy("upto").rangeBetween(Window.unboundedPreceding, -min_words)
    found = places.withColumns(
        {
            "next": F.first(F.struct("seq", "pos_before")).over(ahead),
            "last": F.last(F.struct("seq", "pos_after")).over(behind),
            "total": F.sum("words").over(by_doc),
            "n": F.count(F.lit(1)).over(by_doc),
            "first_of_all": F.min("pos").over(by_doc),
            "last_of_all": F.max("pos").over(by_doc),
        }
    )
    enough_ahead = F.col("total") - F.col("before") >= min_words
    enough_behind = F.col("upto") >= min_words

    def run(start: Column, end: Column, first: Column, last: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), (end - start).cast("int").alias("m"), first.alias("first_pos"), last.alias("last_pos"))

    forward = F.when(
        enough_ahead,
        run(F.col("seq"), F.coalesce("next.seq", "n"), F.col("pos"), F.coalesce("next.pos_before", "last_of_all")),
    )
    back_from = F.coalesce(F.col("last.seq") + 1, F.lit(0))
    backward = F.when(
        enough_behind, run(back_from, F.col("seq") + 1, F.coalesce("last.pos_after", "first_of_all"), F.col("pos"))
    )
    runs = F.array_distinct(F.filter(F.array(forward, backward), lambda r: r.isNotNull()))
    return found.select("uid", "doc", F.explode(runs).alias("r")).select("uid", "doc", "r.*").distinct()


def short_runs(lines: DataFrame, min_words: int) -> DataFrame:
    """All runs of fewer than min_words words: as shortest_runs, and their words."""
    whole = Window.partitionBy("uid").orderBy("seq")
    near = Window.partitionBy("uid").orderBy("upto").rangeBetween(0, min_words - 1)
    found = lines.withColumn("upto", F.sum("words").over(whole)).withColumn("ends", F.collect_list(F.struct("seq", "pos", "upto")).over(near))
    rows = found.where(F.col("words") < min_words).withColumn("before", F.col("upto") - F.col("words"))
    rows = rows.select("uid", "doc", "seq", "pos", "before", F.explode("ends").alias("e"))
    return rows.select(
        "uid", "doc", F.col("seq").cast("int").alias("start"), (F.col("e.seq") + 1 - F.col("seq")).cast("int").alias("m"),
        F.col("pos").alias("first_pos"), F.col("e.pos").alias("last_pos"), (F.col("e.upto") - F.col("before")).alias("words"),
    ).where(F.col("words") < min_words)


def deleted_ranges(docs: DataFrame, uid: str, id_col: str, text_col: str, min_words: int, hot_words: int | None = None) -> DataFrame:
    """Per document that loses lines: uid, and the ranges of its lines, by place in the text, that are later copies."""
    lines = stored(line_table(docs, uid, id_col, text_col), "lines")
    runs = shortest_runs(lines, min_words)
    if hot_words is not None:
        runs = runs.withColumn("words", F.lit(None).cast("long")).unionByName(short_runs(lines, min_words))
    hot = [] if hot_words is None else ["words"]
    level = _ranked(lines.select("uid", "seq", "h1", "h2"), "h1", "h2")
    levels, k = level.withColumn("k", F.lit(0)), 0
    while 2 ** (k + 1) <= min_words and level.take(1):  # a line has a word at least
        later = level.select("uid", (F.col("seq") - 2**k).alias("seq"), F.col("rank").alias("rank_2"))
        pairs = level.withColumnRenamed("rank", "rank_1").join(later, ["uid", "seq"])
        level, k = _ranked(pairs, "rank_1", "rank_2"), k + 1
        levels = levels.unionByName(level.withColumn("k", F.lit(k)))
    named = (
        runs.withColumn("k", F.floor(F.log2("m")).cast("int"))
        .join(levels.select("uid", "k", F.col("seq").alias("start"), F.col("rank").alias("head")), ["uid", "k", "start"])
        .withColumn("tail_at", (F.col("start") + F.col("m") - F.pow(F.lit(2), F.col("k"))).cast("int"))
        .join(levels.select("uid", "k", F.col("seq").alias("tail_at"), F.col("rank").alias("tail")), ["uid", "k", "tail_at"])
        .withColumn("at", F.struct(F.col("doc").isNull().alias("late"), "doc", "uid", "start"))
        .select("at", "m", "head", "tail", "first_pos", "last_pos", *hot)
    )
    named = stored(named, "named")
    groups = named.groupBy("m", "head", "tail", *hot).agg(F.min("at").alias("kept"), F.max("at").alias("end"), F.count(F.lit(1)).alias("n"))
    if hot:
        groups = groups.where(F.col("words").isNull() | (F.col("words") * F.col("n") >= hot_words)).drop("words")
    firsts = stored(groups.drop("n").where("kept < end"), "kept")
    copies = named.join(firsts.drop("end"), ["m", "head", "tail"]).where(
        (F.col("at.uid") != F.col("kept.uid")) | (F.col("at.start") >= F.col("kept.start") + F.col("m"))
    )
    # Runs that touch or overlap become one range.
    order = Window.partitionBy("uid").orderBy("first_pos", "last_pos")
    opened = (
        copies.select(F.col("at.uid").alias("uid"), "first_pos", "last_pos")
        .distinct()
        .withColumn("reach", F.max("last_pos").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("opens", F.when(F.col("first_pos") > F.col("reach") + 1, 1).otherwise(0))
        .withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    ranges = opened.groupBy("uid", "part").agg(F.min("first_pos").alias("first"), F.max("last_pos").alias("last"))
    return ranges.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("ranges"))


def drop_repeated_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    deleted_col: str | None = None,
    hot_words: int | None = None,
) -> DataFrame:
    """The documents without the later copies of repeated runs of lines of at least min_words words.

    Lines are parted by \\n and equal if all their characters are. A run is a
    later copy if the same lines stand before it, in the order of id (null ids
    last), row and place, and the first of those does not overlap it. Lines
    without a word are no part of a run; they go if they stand inside one that
    goes. All rows and columns come back, also of documents that have lost all
    lines (text ''); null texts stay null. Of repeated rows, one counts as the
    first. deleted_col names a column for the number of places deleted. With
    hot_words, runs of fewer than min_words words count as well if their words
    times the number of places where they stand are at least hot_words.
    """
    uid = _free(docs.columns, "uid")
    rows = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "documents")
    ranges_col, lines_col = _free([*rows.columns, "uid"], "ranges"), _free([*rows.columns, "uid"], "lines")
    ranges = deleted_ranges(rows, uid, id_col, text_col, min_words, hot_words)
    ranges = ranges.select(F.col("uid").alias(uid), F.col("ranges").alias(ranges_col))
    joined = rows.join(ranges, uid, "left").withColumn(
        lines_col, F.when(F.col(ranges_col).isNotNull(), F.split(F.col(text_col).cast("string"), "\n"))
    )
    # What stays are the stretches between one range's end and the next one's start.
    starts = F.concat(F.array(F.lit(0)), F.transform(F.col(ranges_col), lambda r: r["last"] + 1))
    ends = F.concat(F.transform(F.col(ranges_col), lambda r: r["first"]), F.array(F.size(lines_col)))
    stretches = F.zip_with(starts, ends, lambda s, e: F.slice(F.col(lines_col), s + 1, e - s))
    kept = F.array_join(F.flatten(stretches), "\n")
    gone = F.aggregate(F.col(ranges_col), F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    out = [F.when(F.col(ranges_col).isNull(), F.col(c).cast("string")).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if deleted_col:
        out.append(F.coalesce(gone, F.lit(0)).cast("long").alias(deleted_col))
    return joined.select(*out)
