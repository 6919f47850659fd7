"""Product-quantisation codes of vectors: integer codebooks learned over metric trees of the parts."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.ball_trees import BallTree
from tabloom.llm.common import join_per_key
from tabloom.session import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of one tree per part.
BLOCK_ROWS = 4096
#: Integer components beyond this count as this, so that sums stay exact.
LARGEST_COMPONENT = 1 << 40
#: Rows whose sums a task adds up before it hands them on.
SUM_ROWS = 1 << 20
RESULTS = ["code", "error", "label_error", "codebooks_sha256"]


def _integers(lists: pa.ListArray, scale: int) -> np.ndarray:
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    limit = LARGEST_COMPONENT
    return np.clip(np.floor(flat * scale), -limit, limit).astype(np.int64).reshape(len(lists), -1)


def usable(vectors: DataFrame, vector: str, parts: int) -> DataFrame:
    """Rows whose vector can be cut into equal parts and holds finite numbers only."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0) & (F.size(vector) % parts == 0) & ~bad)


def _first_rows(kept: DataFrame, entries: int) -> list:
    """The rows of the smallest keys, nulls last, equal keys by their vectors: ``entries`` at most."""
    return kept.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).collect()


def _trees(kept: DataFrame, parts: int, scale: int, block_rows: int) -> DataFrame:
    """One row per block of vectors: keys, labels and a tree for each part."""
    kinds = {c: kept.schema[c].dataType.simpleString() for c in ("key", "label")}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = -(-batch.num_rows // block_rows)
            ends = np.linspace(0, batch.num_rows, blocks + 1).astype(int)
            for lo, hi in zip(ends, ends[1:]):
                part = batch.slice(lo, hi - lo)
                whole = _integers(part.column(2), scale)
                trees = [BallTree.build(x).to_bytes() for x in np.split(whole, parts, axis=1)]
                one = pa.array([0, hi - lo], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(one, part.column(0)), pa.ListArray.from_arrays(one, part.column(1)),
                                                  pa.array([trees], pa.list_(pa.binary()))], names=["keys", "labels", "trees"])

    return kept.select("key", "label", "v").mapInArrow(build, f"keys array<{kinds['key']}>, labels array<{kinds['label']}>, trees array<binary>")


def _moved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts nearest to it.

    Counts and sums come from the trees' nodes, are added up in their tasks, and met in one aggregate of one row per part and entry.
    """
    parts, entries, width = books.shape

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, counts, sums = 0, np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)

        def out() -> pa.RecordBatch:
            part, entry = np.nonzero(counts)
            return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]),
                                               pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

        for batch in batches:
            for block in batch.column(0):
                for p, raw in enumerate(block):
                    tree = BallTree.from_bytes(raw.as_py())
                    n, s, _, _ = tree.owners(books[p], False)
                    counts[p] += n
                    sums[p] += s
                rows += len(tree.points)
                if rows >= SUM_ROWS:
                    yield out()
                    rows, counts[:], sums[:] = 0, 0, 0
        yield out()

    found = trees.select("trees").mapInArrow(sums_of, "part int, entry int, n long, sums array<long>")
    total = [F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    moved = books.copy()
    for row in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect():  # parts x entries rows at most
        moved[row["part"], row["entry"]] = [int(row[f"s{i}"]) // row["n"] for i in range(width)]
    return moved


def _assigned(trees: DataFrame, books: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    parts = len(books)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys, labels = (batch.column(c).slice(i, 1).flatten() for c in (0, 1))
                codes, errors = np.empty((len(keys), parts), np.uint8), np.zeros(len(keys), np.int64)
                for p, raw in enumerate(batch.column(2)[i]):
                    _, _, entry, error = BallTree.from_bytes(raw.as_py()).owners(books[p], True)
                    codes[:, p] = entry
                    errors = np.minimum(errors, (1 << 62) - 1) + error
                yield pa.RecordBatch.from_arrays([keys, labels, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)],
                                                 names=["key", "label", "code", "error"])

    return trees.mapInArrow(assign, f"key {kinds['key']}, label {kinds['label']}, code string, error long")


def code_vectors(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(key, label, code, error, label_error, codebooks_sha256) of every usable vector.

    Components become ``floor(scale * x)`` and vectors are cut into ``parts`` of equal width. A part's codebook starts as
    that part of the ``entries`` smallest keys (256 at most); in each round every part goes to its nearest entry (squared distance, ties
    to the lower index) and every entry that has parts becomes their floored mean. ``code`` holds two hex digits per part,
    ``error`` the squared distances to the final entries, ``label_error`` its sum over equal labels (nulls together).

    The vectors are read once: blocks of them become one metric tree per part, stored in the shared folder. A round walks the trees with the
    codebooks (``entries`` times the vector's width numbers) and sends counts and sums only; results do not depend on blocks or tasks.

    Left out are null and empty vectors, those with null or non-finite components, and those whose length cannot be cut into
    equal parts or differs from that of the first used row (smallest key, nulls last; equal keys by their vectors). Repeated rows stay and count
    each time; equal vectors are one ball. With fewer rows than ``entries`` the codebooks are smaller; without any the result is
    empty. Components beyond 2^40 count as 2^40, distances beyond 2^61 as 2^61, sums beyond a long as the largest long. Other columns are not
    carried.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits")
    if {key, label} & set(RESULTS):
        raise ValueError("key and label columns may not be named like the results")
    spark, kinds = vectors.sparkSession, {"key": vectors.schema[key].dataType.simpleString(), "label": vectors.schema[label].dataType.simpleString()}
    named = vectors.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    kept = usable(named, "v", parts)
    first = _first_rows(kept, entries)
    if not first:
        return spark.createDataFrame([], f"`{key}` {kinds['key']}, `{label}` {kinds['label']}, code string, error long, label_error long, codebooks_sha256 string")
    size = len(first[0]["v"])
    kept = kept.filter(F.size("v") == size)
    if any(len(r["v"]) != size for r in first):
        first = _first_rows(kept, entries)
    start = _integers(pa.array([r["v"] for r in first], pa.list_(pa.float64())), scale)
    books = np.stack(np.split(start, parts, axis=1))
    trees = written(_trees(kept, parts, scale, block_rows), "ball-trees")
    for _ in range(rounds):
        books = _moved(trees, books)
    coded = written(_assigned(trees, books, kinds), "vector-codes")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    totals = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.count("*").alias("n"), F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long").alias("label_error"))
    digest = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    all_of_label = join_per_key(coded, written(totals, "label-errors"), F.col("label"), "of_label", "n")
    return all_of_label.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
