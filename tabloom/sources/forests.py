"""Exported forests (PMML): read to a node table, score as expressions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.plans.sizes import bounded_rows

NODE_SCHEMA = ("tree int, node long, parent long, field string, op string, value double, "
               "score string")


def read_pmml_forest(spark: SparkSession, path: str) -> DataFrame:
    """One row per tree node: (tree, node, parent, field, op, value, score)."""
    # each tree is one Segment element; nodes nest to any depth, so a segment is walked in the task
    segments = spark.read.text(path, lineSep="<Segment ").filter(F.col("value").contains("<TreeModel"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xml.etree.ElementTree as ET

        for batch in batches:
            rows: list[tuple] = []
            for text in batch["value"]:
                segment = ET.fromstring("<Segment " + text[: text.index("</Segment>")] + "</Segment>")
                tree = int(segment.get("id"))
                todo = [(n, None) for n in segment.find("TreeModel").findall("Node")]
                while todo:
                    node, parent = todo.pop()
                    test = node.find("SimplePredicate")
                    rows.append((
                        tree, int(node.get("id")), parent,
                        None if test is None else test.get("field"),
                        None if test is None else test.get("operator"),
                        None if test is None else float(test.get("value")),
                        node.get("score"),
                    ))
                    todo.extend((child, int(node.get("id"))) for child in node.findall("Node"))
            frame = pd.DataFrame(rows, columns=["tree", "node", "parent", "field", "op", "value", "score"])
            yield frame.astype({"parent": "Int64"})

    return segments.mapInPandas(walk, NODE_SCHEMA)


# fixed values: predicate operators of the exchange format
OPERATORS = {
    "lessOrEqual": np.less_equal,
    "lessThan": np.less,
    "greaterThan": np.greater,
    "greaterOrEqual": np.greater_equal,
    "equal": np.equal,
    "notEqual": np.not_equal,
}


#: Nodes of a model at most: they travel with the tasks, about a hundred bytes each.
MAX_NODES = 2_000_000


def tree_votes(nodes: DataFrame, fields: Mapping[str, str] | None = None) -> tuple[Column, int]:
    """The votes of all trees as an array column, and how many trees there are.

    A model is small and fixed, so its nodes travel with the tasks. There the rows of a batch walk down each tree
    together: a node's children are tried in order, the first whose test holds takes the row. A null field fails every test;
    a row that no child takes has no vote.
    """
    rows = bounded_rows(nodes, MAX_NODES, "forest nodes")
    fields = fields or {}
    names = sorted({fields.get(r["field"], r["field"]) for r in rows if r["op"] is not None})
    place = {n: i for i, n in enumerate(names)}
    children: dict[tuple, list] = {}
    for r in sorted(rows, key=lambda r: (r["tree"], r["node"])):
        at = place[fields.get(r["field"], r["field"])] if r["op"] is not None else None
        children.setdefault((r["tree"], r["parent"]), []).append((r["node"], r["op"], at, r["value"], r["score"]))
    trees = sorted({r["tree"] for r in rows})

    @F.pandas_udf("array<string>")
    def votes(values: pd.DataFrame) -> pd.Series:
        x = values.to_numpy(dtype=float, na_value=np.nan)
        out = np.full((len(x), len(trees)), None, dtype=object)
        for k, tree in enumerate(trees):
            todo = [(None, np.arange(len(x)))]
            while todo:
                parent, left = todo.pop()
                for node, op, at, value, score in children.get((tree, parent), []):
                    holds = np.ones(len(left), bool) if op is None else OPERATORS[op](x[left, at], value) & ~np.isnan(x[left, at])
                    if (tree, node) in children:
                        todo.append((node, left[holds]))
                    else:
                        out[left[holds], k] = score
                    left = left[~holds]
        return pd.Series(out.tolist())

    used = [F.col(f"`{n}`").cast("double").alias(n) for n in names] or [F.lit(0.0).alias("none")]
    return votes(F.struct(*used)), len(trees)


def score_pmml(df: DataFrame, nodes: DataFrame, classes: list[str],
               fields: Mapping[str, str] | None = None) -> DataFrame:
    """Add the votes per class, their shares and the majority class (first class on ties)."""
    votes, n_trees = tree_votes(nodes, fields)
    scored = df.withColumn("_votes", votes)

    def share(name: str) -> Column:
        return F.size(F.filter("_votes", lambda v: v == name)) / F.lit(n_trees)

    shares = [share(k) for k in classes]
    scored = scored.withColumns({f"probability_{k}": s for k, s in zip(classes, shares)})
    best = F.array(*[F.col(f"`probability_{k}`") for k in classes])
    pick = F.element_at(F.array(*[F.lit(k) for k in classes]), F.array_position(best, F.array_max(best)).cast("int"))
    return scored.withColumn("predicted", pick).drop("_votes")
