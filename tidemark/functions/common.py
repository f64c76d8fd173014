"""Column helpers shared by operators: blanks, instants, tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def is_blank(c: Column | str) -> Column:
    """Null, empty or only spaces; never null itself."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(c) == "", F.lit(True))


def unblank(c: Column | str) -> Column:
    """The text itself, or null where it is blank."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.trim(c) != "", c)


def instant(c: Column | str) -> Column:
    """Instant of an RFC 3339 text in any spelling; null where blank or not a time."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(F.upper(c)).try_cast("timestamp") if hasattr(c, "try_cast") else F.trim(F.upper(c)).cast("timestamp")


def first_element(c: Column | str, sep: str = ";") -> Column:
    """First element of a packed list as it stands; null where it is blank."""
    return unblank(F.substring_index(F.col(c) if isinstance(c, str) else c, sep, 1))
