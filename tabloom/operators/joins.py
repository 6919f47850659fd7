"""Equi joins and small-grid evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.vectors import quadratic_root
from tabloom.operators.graphs import chain_ends
from tabloom.plans.sizes import bounded_rows
from tabloom.plans.ordered import numbered
from tabloom.plans.skew import join_rows
from tabloom.session import written

def join_lookup(fact: DataFrame, dim: DataFrame, left_on: str, right_on: str, how: str = "inner") -> DataFrame:
    """Fact rows with the columns of their dimension row; the key keeps the fact's name."""
    return join_rows(fact, dim.withColumnRenamed(right_on, left_on), [left_on], how)


def join_natural(a: DataFrame, b: DataFrame) -> DataFrame:
    """Inner join on every shared column name."""
    shared = [c for c in a.columns if c in b.columns]
    if not shared:
        raise ValueError("no shared column")
    return join_rows(a, b, shared)


def join_on(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return join_rows(df, other, [key])


def join_checked(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Join that must keep every row of ``a`` exactly once; otherwise it raises."""
    on = list(on)
    if not b.groupBy(*on).count().filter("count > 1").isEmpty():
        raise ValueError("the right side repeats a key")
    if not a.join(b, on, "left_anti").isEmpty():
        raise ValueError("rows without a partner")
    return join_rows(a, b, on)


def map_values(df: DataFrame, key: str, mapping: DataFrame, map_key: str, map_value: str, name: str) -> DataFrame:
    """Look each key up in a mapping table; absent keys give null."""
    return join_rows(df, mapping.select(F.col(map_key).alias(key), F.col(map_value).alias(name)), [key], "left")


def _grid_columns(rows: list, names: Sequence[str], loss: str, sep: str = "$") -> list[Column]:
    out = []
    for i, row in enumerate(rows):
        text = loss
        for n in names:
            text = text.replace(sep + n, f"({row[n]!r})")
        out.append(F.expr(text).alias(f"g{i}"))
    return out


#: Parameter rows of a grid at most, and those that share one pass over the data.
MAX_GRID, GRID_BLOCK = 100_000, 200


def grid_eval(grid: DataFrame, data: DataFrame, loss: str, name: str = "loss", limit: int = MAX_GRID) -> DataFrame:
    """An aggregate of all data rows for each parameter row, ``GRID_BLOCK`` of them per pass over the data.

    ``loss`` is an aggregate expression with ``$name`` for grid columns. The grid is a parameter list of at most ``limit`` rows (more raise),
    so a block of it becomes columns of one aggregate: the data is neither copied per grid row nor shuffled.
    """
    rows = bounded_rows(grid, limit, "grid rows")
    types = {f.name: f.dataType.simpleString() for f in grid.schema}
    out = None
    for at in range(0, max(len(rows), 1), GRID_BLOCK):
        block = rows[at : at + GRID_BLOCK]
        entries = [F.struct(*[F.lit(r[n]).cast(types[n]).alias(n) for n in grid.columns], F.col(f"g{i}").alias(name)) for i, r in enumerate(block)]
        part = data.agg(*_grid_columns(block, grid.columns, loss) or [F.count("*")]).select(F.inline(F.array(*entries))) if block else None
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("an empty grid")
    return out


def corner_grid(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every combination of the column maxima and minima: 2^k rows from one aggregate."""
    out = df.agg(*[F.array(F.max(c), F.min(c)).alias(c) for c in cols])
    for c in cols:
        out = out.withColumn(c, F.explode(c))
    return out


def max_distance(corners: DataFrame, rows: DataFrame, cols: Sequence[str],
                 inverse: Sequence[Sequence[float]], name: str = "dist") -> DataFrame:
    """For each corner the largest Mahalanobis distance to any row: ``GRID_BLOCK`` corners per pass, ``MAX_GRID`` at most (16 columns)."""
    points = bounded_rows(corners.select(*cols), MAX_GRID, "corners")
    out = None
    for at in range(0, len(points), GRID_BLOCK):
        block = points[at : at + GRID_BLOCK]
        best = [F.max(quadratic_root([F.lit(float(p[c])) - F.col(c) for c in cols], inverse)).alias(f"g{i}") for i, p in enumerate(block)]
        entries = F.array(*[F.struct(*[F.lit(float(p[c])).alias(c) for c in cols], F.col(f"g{i}").alias(name)) for i, p in enumerate(block)])
        part = rows.agg(*best).select(F.inline(entries))
        out = part if out is None else out.unionByName(part)
    return out


def shift_diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], c: str, place: str = "place", name: str = "diff", n: int = 1) -> DataFrame:
    """(keys, ``place``, ``name``): the value of each row minus that of the row ``n`` before it, by a join on the shifted place.

    Rows are numbered per key from 1 (hot keys through a range shuffle); a row without such a predecessor has no result.
    """
    placed = written(numbered(df.select(*dict.fromkeys([*keys, *order, c])), keys, order, place).select(*keys, place, c), "numbered")
    back = placed.select(*keys, (F.col(place) + n).alias(place), F.col(c).alias("_before"))
    return join_rows(placed, back, [*keys, place], null_safe=True).select(*keys, place, (F.col(c) - F.col("_before")).alias(name))


def resolve_redirects(links: DataFrame, redirects: DataFrame, articles: DataFrame) -> DataFrame:
    """Replace link targets that are redirects by what these lead to in the end, and add the id of that article.

    links (source_article_id, target_article_name), redirects (title, redirect), articles (article_id, title). A redirect to a
    redirect is followed to its end; a link into a circle of redirects gets a null target. Links to missing articles get a null id.
    """
    ends = chain_ends(redirects, "title", "redirect").select(F.col("title").alias("target_article_name"), F.col("redirect").alias("_to"), F.lit(True).alias("_moved"))
    named = join_rows(links, ends, ["target_article_name"], "left").select(
        "source_article_id", F.when(F.col("_moved"), F.col("_to")).otherwise(F.col("target_article_name")).alias("target"))
    goal = articles.select(F.col("article_id").alias("target_article_id"), F.col("title").alias("target"))
    return join_rows(named, goal, ["target"], "left").select("source_article_id", "target", "target_article_id")
