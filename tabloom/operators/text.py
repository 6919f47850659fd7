"""Title vectors, word analogies, nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tabloom.functions.scalar import recode
from tabloom.functions.vectors import cosine, doubles, literal, norm
from tabloom.plans.sizes import bounded_rows
from tabloom.plans.skew import join_rows
from tabloom.session import written

#: Numbers of a vector table (rows by dimension, as measured) that a join may broadcast.
BROADCAST_NUMBERS = 8_000_000
# fixed values: spelling repairs before the lookup
SUBSTITUTES = {"vegi": "vegetable", "smoothy": "malt"}


def title_words(items: DataFrame, key: str, title: str, subst: Mapping[str, str] = SUBSTITUTES) -> DataFrame:
    words = items.select(key, F.explode(F.split(F.lower(title), " ")).alias("word")).filter("word <> ''")
    if subst:
        words = words.withColumn("word", F.coalesce(recode("word", subst), F.col("word")))
    return words


def title_vectors(items: DataFrame, vectors: DataFrame, key: str, title: str, dim: int,
                  subst: Mapping[str, str] = SUBSTITUTES) -> DataFrame:
    """Mean vector of the words of each title that have one.

    The vectors are stored and counted. A table of at most ``BROADCAST_NUMBERS`` numbers goes to the tasks, where each title's words are looked up
    and added up before anything is shuffled; a larger one is joined by word, after the words of a title are counted. The sums are plain
    double columns, so they are combined before the shuffle.
    """
    vectors = written(vectors.select("word", "vector"), "word-vectors")
    words = title_words(items, key, title, subst)
    if vectors.count() * dim <= BROADCAST_NUMBERS:
        joined = words.join(F.broadcast(vectors), "word").withColumn("k", F.lit(1))
    else:
        joined = join_rows(words.groupBy(key, "word").agg(F.count("*").alias("k")), vectors, ["word"])
    sums = [F.sum(F.col("k") * F.get("vector", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(dim)]
    totals = joined.groupBy(key).agg(F.sum("k").alias("words"), *sums)
    return totals.select(key, "words", F.array(*[F.col(f"s{i}") / F.col("words") for i in range(dim)]).alias("vector"))


def unknown_words(items: DataFrame, vectors: DataFrame, key: str, title: str,
                  subst: Mapping[str, str] = SUBSTITUTES) -> DataFrame:
    """Title words without a vector, with their counts."""
    words = title_words(items, key, title, subst).groupBy("word").agg(F.count("*").alias("n"))
    return words.join(vectors.select("word"), "word", "left_anti")


def most_similar(vectors: DataFrame, word: str, vector: str, positive: Sequence, negative: Sequence = (),
                 k: int = 10) -> DataFrame:
    """The k words closest to mean(+positive, -negative) of unit vectors; inputs are excluded."""
    given = [*positive, *negative]
    unit = F.transform(doubles(vector), lambda x: x / norm(vector))
    rows = bounded_rows(vectors.filter(F.col(word).isin(given)).select(word, unit.alias("u")), len(given), "input words")
    if len(rows) != len(set(given)):
        raise ValueError("an input word has no vector")
    units = {r[word]: r["u"] for r in rows}
    signed = [(units[w], 1.0) for w in positive] + [(units[w], -1.0) for w in negative]
    goal = [sum(s * u[i] for u, s in signed) / len(signed) for i in range(len(signed[0][0]))]
    scored = vectors.filter(~F.col(word).isin(given)).select(word, cosine(vector, literal(goal)).alias("similarity"))
    return scored.orderBy(F.desc("similarity"), word).limit(k)


def flatten_records(df: DataFrame, fields: Mapping[str, str], items: str | None = None, item: str = "item",
                    default=None) -> DataFrame:
    """Nested records to flat rows: ``{output: struct path}``, and one row per list entry.

    A missing or empty list gives one row with ``default``.
    """
    cols = [F.col(path).alias(name) for name, path in fields.items()]
    if items is None:
        return df.select(*cols)
    out = df.select(*cols, F.explode_outer(items).alias(item))
    return out.withColumn(item, F.coalesce(F.col(item), F.lit(default))) if default is not None else out
