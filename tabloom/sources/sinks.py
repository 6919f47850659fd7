"""Writers; every partition writes its own files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from tabloom.functions.scalar import fixed


def write_csv(df: DataFrame, path: str, fmt: str | None = None, rows_per_file: int | None = None) -> None:
    """CSV with header; ``fmt`` writes every number with one fixed pattern."""
    if fmt:
        df = df.select(*[
            fixed(f.name, fmt).alias(f.name) if isinstance(f.dataType, NumericType) else F.col(f.name)
            for f in df.schema
        ])
    writer = df.write.option("header", True).option("escape", '"')
    if fmt:
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.csv(path)


def write_tables(tables: Mapping[str, DataFrame], out: str, fmt: str = "csv") -> None:
    """One folder per table. Tables of a common source are cheap if that source is stored first."""
    for name, df in tables.items():
        writer = df.write.option("header", True).option("escape", '"') if fmt == "csv" else df.write
        writer.format(fmt).save(f"{out}/{name}")


def save_table(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def export_measures(long: DataFrame, frame: str = "frame", measure: str = "measure", value: str = "value",
                    measures: Sequence[str] | None = None) -> DataFrame:
    """One row per frame, one column per measure. Known measures save a pass."""
    grouped = long.groupBy(frame)
    pivoted = grouped.pivot(measure, list(measures)) if measures else grouped.pivot(measure)
    return pivoted.agg(F.first(value, ignorenulls=True))
