"""Readers for delimited, JSON and vector text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions.scalar import NULL_TOKENS, null_tokens


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def scan_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
             null_values: Sequence[str] = NULL_TOKENS, header: bool = True,
             line_sep: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Typed scan of one or many files, local or in an object store.

    Columns load as text, tokens become null, and each used column is cast; a value that
    does not parse is null. Unused columns are neither parsed nor cast.
    """
    schema = _schema(schema)
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    reader = spark.read.schema(text).option("header", header).option("enforceSchema", True)
    reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    raw = reader.csv(path if isinstance(path, str) else list(path))
    return raw.select(*[_typed(f, null_values).alias(f.name) for f in schema])


def _typed(field: T.StructField, tokens: Sequence[str]) -> Column:
    value = null_tokens(field.name, tokens) if tokens else F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return value
    return value.try_cast(field.dataType)


def scan_csv_inferred(spark: SparkSession, path: str | Sequence[str], sampling_ratio: float = 1.0) -> DataFrame:
    return (spark.read.option("header", True).option("inferSchema", True)
            .option("samplingRatio", sampling_ratio).csv(path if isinstance(path, str) else list(path)))


def scan_many(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str, **kw) -> DataFrame:
    """Several files with one schema as one scan."""
    return scan_csv(spark, list(paths), schema, **kw)


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(_schema(schema)).option("multiLine", multi_line).json(path)


def parse_json(df: DataFrame, c: str, schema: T.StructType | str, name: str) -> DataFrame:
    return df.withColumn(name, F.from_json(c, _schema(schema)))


def read_word_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Lines of ``word f1 .. fN`` as (word, vector); the word may itself contain blanks."""
    parts = F.split("value", " ")
    words = F.size(parts) - dim
    return (
        spark.read.text(path)
        .filter(F.size(parts) > dim)
        .select(
            F.array_join(F.slice(parts, F.lit(1), words), " ").alias("word"),
            F.transform(F.slice(parts, words + 1, F.lit(dim)), lambda x: x.cast("float")).alias("vector"),
        )
    )


def combine_ts(d: str | Column, t: str | Column) -> Column:
    """Date text and time text as one timestamp; unreadable text is null."""
    return F.concat_ws(" ", d, t).try_cast("timestamp_ntz")


def cast_ts(c: str, coerce: bool = False) -> Column:
    """Text to timestamp; with ``coerce`` a bad value is null instead of an error."""
    return F.col(c).try_cast("timestamp_ntz") if coerce else F.col(c).cast("timestamp_ntz")
