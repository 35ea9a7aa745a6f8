"""The closed schema at the sink."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.schema import PLAYER_GAME


def fill_missing(df: DataFrame, schema: T.StructType = PLAYER_GAME) -> DataFrame:
    """Columns of the schema that the frame lacks, added as typed nulls."""
    absent = [field for field in schema.fields if field.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])


def lock_schema(df: DataFrame, schema: T.StructType = PLAYER_GAME) -> DataFrame:
    """Exactly the schema's columns, in its order and types; a missing column is an error."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"missing schema columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def stack(*frames: DataFrame) -> DataFrame:
    """Frames one after the other; a column one of them lacks is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
