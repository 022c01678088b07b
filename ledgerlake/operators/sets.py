"""Set operations (SET1-SET4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def union_all(labelled: Sequence[tuple[str, DataFrame]], label: str = "Source") -> DataFrame:
    """SET1: stack labelled results (by name, not position)."""
    out = None
    for name, df in labelled:
        d = df.withColumn(label, F.lit(name))
        out = d if out is None else out.unionByName(d)
    return out


def union_columns(df: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "Column",
                  value: str = "Value") -> DataFrame:
    """SET2: stack per-column scans as one ``unpivot`` (a single pass)."""
    return df.unpivot(list(keys), list(cols), name, value)


def inline_values(spark: SparkSession, rows, schema) -> DataFrame:
    """SET3: a VALUES list as a table."""
    return spark.createDataFrame(rows, schema)


def row_diff(source: DataFrame, replica: DataFrame) -> DataFrame:
    """SET4: rows in the source missing from the replica and the reverse, with
    duplicates counted (``exceptAll`` both ways)."""
    return union_all([("missing_in_replica", source.exceptAll(replica)),
                      ("extra_in_replica", replica.exceptAll(source))], label="Side")
