"""Joins with dimensions.

None of them forces a broadcast: a dimension grows with the data. Spark
broadcasts a side whose size it knows to be under
`spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles both, where
adaptive execution splits hot partitions. What is joined here has been
aggregated before, so a hot key is few rows by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airtally.functions.codes import without_zeros


def resolve_codes(codes: DataFrame, games: DataFrame, columns: list[str]) -> DataFrame:
    """Every game a code stands for: `code = chz_game_code OR code without zeros = afc_game_code`.

    An OR cannot be hashed, so a code stands under two keys, itself and itself
    without zeros, and so does a game, under its two codes; a mark keeps the
    two kinds apart. A game that matches both ways is taken the first way only,
    so there are as many rows as with the OR. `codes` has one column, `code`.
    """
    wanted = codes.where(F.col("code").isNotNull()).distinct()
    code_keys = wanted.select("code", _marked(F.col("code"), without_zeros(F.col("code"))))
    game_keys = games.select(
        *columns, F.col("chz_game_code").alias("_exact"), _marked(F.col("chz_game_code"), F.col("afc_game_code"))
    )
    twice = (F.col("_by") == "plain") & F.col("code").eqNullSafe(F.col("_exact"))
    return (
        code_keys.join(game_keys.where(F.col("_key").isNotNull()), ["_by", "_key"])
        .where(~twice)
        .select("code", *columns)
    )


def _marked(exact: Column, plain: Column) -> Column:
    """Two rows: `_by` says which way, `_key` holds what has to be equal."""
    return F.inline(
        F.array(
            F.struct(F.lit("exact").alias("_by"), exact.alias("_key")),
            F.struct(F.lit("plain").alias("_by"), plain.alias("_key")),
        )
    )


def attach_or_blank(df: DataFrame, lookup: DataFrame, on: str, column: str) -> DataFrame:
    """`column` of the lookup, '' where it has no such key."""
    return df.join(lookup.select(on, column), on, "left").withColumn(column, F.coalesce(column, F.lit("")))
