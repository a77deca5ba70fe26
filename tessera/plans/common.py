"""Helpers shared by the plan modules: output normalisation and the derived document collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finalize(df: DataFrame) -> DataFrame:
    """Normalise output types so Spark and the SQL oracle agree column by column.

    Integers of every width become BIGINT, floats DOUBLE, timestamps a ``yyyy-MM-dd HH:mm:ss``
    string. Arrays and structs are left to the query (they are flattened explicitly there).
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
