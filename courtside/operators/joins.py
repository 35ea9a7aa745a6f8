"""Key-checked joins.

Each is one equi-join, so a side is scanned and exchanged once. A key, or null, that owns a large share of the rows is left
to adaptive execution, which splits its shuffle partition by what the tasks before wrote; there is no list of
hot keys and no bound on their number. Which side is broadcast is Spark's choice by bytes.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class CardinalityError(ValueError):
    """A key that had to be unique is not."""


def cardinality_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that occur more than once, with how often."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], side: str) -> None:
    """Raise when a key repeats. Reads the key columns only and combines before the shuffle."""
    examples = cardinality_report(df, keys).limit(5).collect()
    if examples:
        shown = [tuple(row[:-1]) for row in examples]
        raise CardinalityError(f"{side} side repeats {tuple(keys)}, for example {shown}")


def join_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a side that is unique by key, as after an aggregation by it; rows with a null key match nothing."""
    return left.join(right, list(keys), "left")


def guarded_join(left: DataFrame, right: DataFrame, keys: Sequence[str], validate: str = "m:1") -> DataFrame:
    """Left join that first proves the promised cardinality, "1:1" or "m:1"."""
    if validate not in ("1:1", "m:1"):
        raise ValueError(f"unknown cardinality {validate!r}")
    require_unique(right, keys, "right")
    if validate == "1:1":
        require_unique(left, keys, "left")
    return join_to_one(left, right, keys)


def missing_from(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null keys of one frame that the other lacks.

    Both sides shrink to distinct keys before they meet, so repeated keys cost nothing.
    """
    wanted = df.select(*keys).dropna().distinct()
    return wanted.join(other.select(*keys).distinct(), list(keys), "left_anti")
