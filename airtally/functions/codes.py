"""Game codes of the two platforms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_GAME_CODE = "talk"
NOT_A_GAME = ("talk", "-", "Virtual", "종합 게임")
NOT_RANKED = ("talk", "종합 게임")
AFREECA_CODE_ZEROS = 3


def normalized_code(code: str | Column) -> Column:
    """Missing and empty codes are talk broadcasts."""
    return F.coalesce(F.nullif(F.col(code) if isinstance(code, str) else code, F.lit("")), F.lit(NO_GAME_CODE))


# Raw codes that are one code when normalised: missing, empty and spelled out.
CODE_TRACKS = 3


def code_track(code: str | Column) -> Column:
    """Which of the raw codes behind a normalised one this is."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code.isNull(), 0).when(code == "", 1).otherwise(2)


def without_zeros(code: Column) -> Column:
    return F.ltrim(code, F.lit("0"))


def with_zeros(code: Column) -> Column:
    """The code with three zeros put before it."""
    return F.lpad(code, F.length(code) + F.lit(AFREECA_CODE_ZEROS), F.lit("0"))


def is_game(name: str, excluded: tuple[str, ...] = NOT_A_GAME) -> Column:
    """Not one of the excluded names; a missing name is dropped as well."""
    return ~F.col(name).isin(*excluded)
