"""Output typing contract shared by all operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, DateType, DecimalType, IntegerType, ShortType


def finish(df: DataFrame) -> DataFrame:
    """Output typing contract: decimals leave as double, small ints as bigint,
    calendar dates as midnight TIMESTAMP_NTZ (zone-free, identical in every
    engine that reads the result), lists as compact JSON text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif isinstance(f.dataType, ArrayType):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            out.append(F.col(f.name).cast("bigint").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
