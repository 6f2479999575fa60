"""Rows under game codes, and the games that the codes stand for.

A code may stand for very many games, so a row under it stands for a row per name. Here such
rows stay one for as long as they can: figures are folded under their codes, and meet
names in lists of bounded length, which are spelled out last.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airtally.functions.codes import is_game

#: A code of more names has them in lists, of about LIST names each; rows of one list are dealt over SALTS copies of it.
NAMES_PER_KEY = 64
LIST = 4096
SALTS = 32

NAMES = "n_game_code string, game_nm string, known boolean"
MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class ByCode:
    """Rows that each stand for one row per name of their code, and rows that have a name already.

    rows: n_game_code and others. names: n_game_code, game_nm, known; every code of the rows has one at
    least, and names that are `known` are distinct within a code. named: game_nm in place of n_game_code.
    Either of rows, with their names, and named may be missing.
    """

    rows: DataFrame | None
    names: DataFrame | None
    named: DataFrame | None = None

    def each(self, change: Callable[[DataFrame], DataFrame]) -> ByCode:
        """The same change to all rows; it leaves code and name as they are."""
        return ByCode(None if self.rows is None else change(self.rows), self.names, None if self.named is None else change(self.named))

    def folded(self, keys: list[str], figures: list[Column]) -> ByCode:
        """Rows of the same keys and code, or name, as one."""
        def fold(rows: DataFrame, *by: str) -> DataFrame:
            return rows.groupBy(*by).agg(*figures) if figures else rows.select(*by).distinct()

        return ByCode(None if self.rows is None else fold(self.rows, *keys, "n_game_code"), self.names, None if self.named is None else fold(self.named, *keys, "game_nm"))

    def spelled(self) -> DataFrame:
        """A row per name."""
        dealt = deal(self.names)
        targets = dealt.single.withColumns({"_slot": F.lit(None).cast("string"), "_mass": F.lit(False)})
        met = self.rows.join(targets.unionByName(_mass(dealt)), "n_game_code").drop("n_game_code")
        out = spell(met, dealt.lists).select(*["game_nm" if c == "n_game_code" else c for c in self.rows.columns])
        return out if self.named is None else out.unionByName(self.named.select(*out.columns))


@dataclass(frozen=True)
class Dealt:
    """single: n_game_code, game_nm. slots: game_nm, _slot. of_code: n_game_code, _slot. lists: _slot, games (in order).

    homed: as single, with the slots of the names.
    """

    single: DataFrame
    slots: DataFrame
    of_code: DataFrame
    lists: DataFrame
    homed: DataFrame

    def each(self, change: Callable[[DataFrame, str], DataFrame]) -> Dealt:
        """Each of them changed, by its name: stored, say, if several plans use them."""
        return Dealt(**{f.name: change(getattr(self, f.name), f.name) for f in fields(self)})


def deal(names: DataFrame) -> Dealt:
    """Names of codes with few of them one by one, those of others in lists.

    Names that have the same set of such codes are a class, so that each name is in one list. Codes
    that are names of nothing, and names that are no game's, are never in a list.
    """
    listed = F.col("known") & is_game("game_nm")
    own = names.select("n_game_code", "game_nm", F.coalesce(listed, F.lit(False)).alias("_listed"))
    count = F.count(F.when(F.col("_listed"), 1))
    many = own.groupBy("n_game_code").agg(count.alias("_n")).where(F.col("_n") > NAMES_PER_KEY)
    marked = own.join(many.select("n_game_code", F.lit(True).alias("_many")), "n_game_code", "left")
    mass = F.col("_listed") & F.coalesce("_many", F.lit(False))
    classes = marked.where(mass).groupBy("game_nm").agg(F.to_json(F.sort_array(F.collect_set("n_game_code"))).alias("_class"))
    parts = classes.groupBy("_class").agg(F.ceil(F.count(F.lit(1)) / LIST).alias("_parts"))
    part = F.pmod(F.xxhash64("game_nm"), F.col("_parts"))
    slots = classes.join(parts, "_class").select("game_nm", "_class", F.concat("_class", F.lit("/"), part.cast("string")).alias("_slot"))
    of_code = slots.select("_class", "_slot").distinct().select(F.explode(F.from_json("_class", "array<string>")).alias("n_game_code"), "_slot")
    lists = slots.groupBy("_slot").agg(F.sort_array(F.collect_list("game_nm")).alias("games"))
    single, slots = marked.where(~mass).select("n_game_code", "game_nm"), slots.drop("_class")
    return Dealt(single, slots, of_code, lists, _homed(single, slots))


def _mass(dealt: Dealt) -> DataFrame:
    return dealt.of_code.select("n_game_code", F.lit(None).cast("string").alias("game_nm"), "_slot", F.lit(True).alias("_mass"))


def _homed(rows: DataFrame, slots: DataFrame) -> DataFrame:
    """Single names with the list that they are in, or else a slot of their own."""
    home = F.coalesce("_slot", F.concat(F.lit("="), F.col("game_nm")))
    return rows.join(slots, "game_nm", "left").withColumns({"_slot": home, "_mass": F.lit(False)})


def _laid_out(rows: ByCode, dealt: Dealt) -> DataFrame:
    """Rows under single names and under lists, where those of one streamer and list are together."""
    met = rows.rows.join(dealt.homed.unionByName(_mass(dealt)), "n_game_code").drop("n_game_code")
    if rows.named is not None:
        met = met.unionByName(_homed(rows.named, dealt.slots).select(*met.columns))
    return met.repartition("streamer_nm", "_slot")


def _unlisted(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_slot": F.lit(None).cast("string"), "_mass": F.lit(False), "_but": F.lit(None).cast("array<string>")})


def per_game(rows: ByCode, dealt: Dealt | None, also: list[str], figures: dict[str, str]) -> DataFrame:
    """Figures per streamer, game and `also`: rows under single names, and rows that stand for the names of a list but for some.

    figures: name -> sum | max | min. Columns besides: game_nm (NULL in a list's row), _slot, _mass, _but (names of the
    list that have rows of their own, into which the list's figures are merged). A game of many codes is one row.
    """
    keys = ["streamer_nm", *also]
    folds = [MERGE[kind](name).alias(name) for name, kind in figures.items()]
    if rows.rows is None:
        return _unlisted(rows.named.groupBy(*keys, "game_nm").agg(*folds))
    merged = _laid_out(rows, dealt).groupBy(*keys, "_slot", "_mass", "game_nm").agg(*folds)
    slot = Window.partitionBy(*keys, "_slot")

    def whole(name: str, kind: str) -> Column:
        own, listed = F.col(name), F.max(F.when(F.col("_mass"), F.col(name))).over(slot)  # one row of a list at most
        both = {"sum": F.coalesce(own + listed, own, listed), "max": F.greatest(own, listed), "min": F.least(own, listed)}
        return F.when(F.col("_mass"), own).otherwise(both[kind]).alias(name)

    return merged.select(*keys, "game_nm", "_slot", "_mass", _apart(slot), *[whole(*f) for f in figures.items()])


def _apart(slot) -> Column:
    singles = F.collect_set(F.when(~F.col("_mass"), F.col("game_nm"))).over(slot)
    return F.when(F.col("_mass"), singles).alias("_but")


def distinct_per_game(rows: ByCode, dealt: Dealt | None, column: str, name: str) -> DataFrame:
    """How many distinct values of `column` a streamer has of a game, in rows as those of `per_game`."""
    if rows.rows is None:
        return _unlisted(rows.named.groupBy("streamer_nm", "game_nm").agg(F.count_distinct(column).alias(name)))
    keys = ["streamer_nm", "_slot"]
    every = _laid_out(rows, dealt).select(*keys, "_mass", "game_nm", column).distinct()
    listed = F.max("_mass").over(Window.partitionBy(*keys, column))
    counted = (
        every.withColumn("_listed", listed)
        .groupBy(*keys, "_mass", "game_nm")
        .agg(F.count(column).alias("_n"), F.count(F.when(~F.col("_listed"), F.col(column))).alias("_more"))
    )
    slot = Window.partitionBy(*keys)
    of_list = F.coalesce(F.max(F.when(F.col("_mass"), F.col("_n"))).over(slot), F.lit(0))
    total = F.when(F.col("_mass"), F.col("_n")).otherwise(of_list + F.col("_more"))
    return counted.select("streamer_nm", "game_nm", "_slot", "_mass", _apart(slot), total.alias(name))


def spell(rows: DataFrame, lists: DataFrame, on: tuple[str, ...] = ("_slot",), first: int | None = None) -> DataFrame:
    """Rows with a name each: those of a list once per name in it but for `_but`, or for its `first` names only.

    Every list comes in SALTS copies, so that its rows come from many tasks. Single names have numbers below 0, of no list.
    """
    others = [c for c in rows.columns if c not in ("game_nm", "_mass", "_but", *on)]
    copy = F.pmod(F.xxhash64(*others), F.lit(SALTS)).cast("int")
    salt = F.when(F.col("_mass"), copy).otherwise(-1 - F.pmod(F.xxhash64("game_nm", *others), F.lit(1 << 20)).cast("int"))
    keys = {c: F.when(F.col("_mass"), F.col(c)).otherwise(F.lit("")) for c in on}
    copies = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = rows.withColumns(keys | {"_salt": salt}).join(copies, [*on, "_salt"], "left")
    games = F.col("games")
    if "_but" in rows.columns:
        games = F.when(F.size("_but") > 0, F.array_except("games", "_but")).otherwise(games)
    if first is not None:
        games = F.slice(games, 1, first)
    names = F.when(F.col("_mass"), games).otherwise(F.array("game_nm"))
    return met.select(*others, F.explode(names).alias("game_nm"))
