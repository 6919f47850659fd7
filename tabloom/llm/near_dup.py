"""Near-duplicate texts: ProbMinHash signatures of shingle sets, banding, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import folded, mixed, release, utf8, words_of
from tabloom.session import written

SHINGLE = 5
SIMILARITY = 0.8
#: A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^24, three in a million. This holds as bands are made
#: of registers that agree with the similarity a link is defined by, that of the sets: each shingle counts once.
BANDS, BAND_ROWS = 24, 4
#: Words whose texts are hashed together in a task, and words whose hashes it keeps: the workers of an executor share its memory with the heap.
SLICE_WORDS, KEPT_WORDS = 50_000, 30_000
#: Measured rows of 24 bytes that a join may broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000
#: Cells of the table of marks that bounds the common shingles of a pair before their sets are fetched.
MARK_CELLS = 1024
#: Leaders of a bucket grow by this factor from round to round.
GROWTH = 8


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingles(texts: list[bytes | None], size: int = SHINGLE) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct hashed shingles of every text, sorted, with their counts. A text of fewer words than
    ``size`` has one shingle of them all; a text without words has none."""
    split = [words_of(t) for t in texts]
    sizes = [len(w) for w in split]
    flat = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(split)), np.uint64, sum(sizes))
    n = max(0, len(flat) - size + 1)
    run = np.zeros(n, np.uint64)
    for k in range(size):
        run = folded(run, flat[k : k + n])
    out, at = [], 0
    for s in sizes:
        if s >= size:
            out.append(np.unique(run[at : at + s - size + 1], return_counts=True))
        elif s:
            h = np.full(1, s, np.uint64)
            for k in range(s):
                h = folded(h, flat[at + k : at + k + 1])
            out.append((h, np.ones(1, np.int64)))
        else:
            out.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
        at += s
    return out


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * BAND_ROWS) -> np.ndarray:
    """ProbMinHash: two signatures agree in a register with the probability Jaccard of their weighted sets.

    Every element is a Poisson process whose rate is its weight; each arrival falls into a random register,
    which keeps the element of its earliest arrival. A process ends as soon as its next arrival is later than the
    latest register of its text. Arrivals are drawn for all texts together in rounds; elements whose first arrival
    lies beyond a time at which all registers are most likely taken wait until that turns out wrong.
    The weight of a shingle is 1 + ln(count). With counts of one, two signatures agree in a register with the Jaccard similarity
    of the sets; bands need that, as other counts can bring the agreement of equal sets far below it.
    """
    rows = len(sets)
    earliest = np.full(rows * registers, np.inf)
    taken = np.zeros(rows * registers, np.uint64)
    element = np.concatenate([s for s, _ in sets]) if sets else np.empty(0, np.uint64)
    row = np.repeat(np.arange(rows), [len(s) for s, _ in sets])
    weight = 1 + np.log(np.concatenate([c for _, c in sets])) if len(element) else np.empty(0)
    total = np.bincount(row, weight, rows)
    filled = total == 0  # texts without shingles are done
    horizon = np.where(filled, 0, registers * (np.log(registers) + 3) / np.maximum(total, 1))
    stop = np.where(filled, -1.0, np.inf)

    def gap(e: np.ndarray, k: np.ndarray, w: np.ndarray) -> np.ndarray:
        u = ((mixed(folded(e, k.astype(np.uint64))) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        return -np.log(u) / w

    turn = np.zeros(len(element), np.int64)
    held = [element, row, weight, turn, gap(element, turn, weight)]
    cells = earliest.reshape(rows, registers)
    while True:
        soon = held[4] <= np.minimum(horizon, stop)[held[1]]
        element, row, weight, turn, time = (x[soon] for x in held)
        waiting = [[x[~soon] for x in held]]
        while len(element):
            # few processes draw many arrivals at a time; one later than needed changes nothing
            block = int(np.clip(20_000 // len(element), 1, 64))
            turns = turn[:, None] + np.arange(block)
            drawn = np.repeat(element, block).reshape(-1, block)
            ahead = gap(drawn, turns + 1, weight[:, None])
            times = time[:, None] + np.concatenate([np.zeros((len(time), 1)), np.cumsum(ahead, axis=1)[:, :-1]], axis=1)
            register = (mixed(folded(drawn ^ np.uint64(0x5DEECE66D), turns.astype(np.uint64))) % np.uint64(registers)).astype(np.int64)
            cell, at = (row[:, None] * registers + register).ravel(), times.ravel()
            np.minimum.at(earliest, cell, at)
            first = earliest[cell] == at
            taken[cell[first]] = drawn.ravel()[first]
            turn, time = turn + block, times[:, -1] + ahead[:, -1]
            touched = np.flatnonzero(np.bincount(row, minlength=rows))
            stop[touched] = cells[touched].max(axis=1)
            go = time <= np.minimum(horizon, stop)[row]
            waiting.append([x[~go] for x in (element, row, weight, turn, time)])
            element, row, weight, turn, time = element[go], row[go], weight[go], turn[go], time[go]
        late = stop > horizon
        if not late.any():
            break
        horizon[late] *= 2
        held = [np.concatenate(parts) for parts in zip(*([x[late[w[1]]] for x in w] for w in waiting))]
    return taken.reshape(rows, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    keys = np.empty((len(signature), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, np.uint64)
        for k in range(rows):
            key = folded(key, signature[:, b * rows + k])
        keys[:, b] = key
    return keys.view(np.int64)


def _slices(texts: pa.Array) -> Iterator[list[bytes | None]]:
    held, size = [], 0
    for value in texts:
        t = value.as_py()
        held.append(t)
        size += len(t or b"") // 6
        if size >= SLICE_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _band_udf(size: int, bands: int, rows: int):
    def keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], pa.list_(pa.int64()))]
            for texts in _slices(batch):
                sets = shingles(texts, size)
                own = band_keys(signatures([(s, np.ones_like(c)) for s, c in sets], bands * rows), bands, rows)
                has = np.array([len(s) > 0 for s, _ in sets])
                offsets = np.concatenate([[0], np.cumsum(np.where(has, bands, 0))])
                parts.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(own[has].ravel())))
            yield pa.concat_arrays(parts)
        _HASHES.clear()
        release()

    return F.arrow_udf(keys, "array<long>")


def marks_of(shingle_set: np.ndarray) -> tuple[np.ndarray, int]:
    """Shingles per cell of a small table, as bits: once or more, twice or more; and how many are beyond two.

    Two sets have at most as many shingles in common as bits, and the smaller one's shingles beyond.
    """
    count = np.bincount((shingle_set % np.uint64(MARK_CELLS)).astype(np.int64), minlength=MARK_CELLS)
    bits = np.packbits(np.concatenate([count >= 1, count >= 2]))
    return bits.view(np.int64), int(np.maximum(count - 2, 0).sum())


def _at_most_common() -> F.Column:
    """Upper bound of the common shingles of a member and a leader (names with _b)."""
    both = F.zip_with("marks", "marks_b", lambda x, y: F.bit_count(x.bitwiseAND(y)))
    return F.aggregate(both, F.lit(0), lambda total, bits: total + bits) + F.least("beyond", "beyond_b")


def _set_udf(size: int):
    kind = pa.struct([("set", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("beyond", pa.int32())])

    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([], kind)]
            for texts in _slices(batch):
                rows = []
                for own, _ in shingles(texts, size):
                    marks, beyond = marks_of(own)
                    rows.append({"set": own.view(np.int64), "marks": marks, "beyond": beyond})
                parts.append(pa.array(rows, kind))
            yield pa.concat_arrays(parts)
        _HASHES.clear()
        release()

    return F.arrow_udf(sets, "struct<set:array<long>,marks:array<long>,beyond:int>")


def digest(text: str) -> F.Column:
    """16 bytes that stand for a text; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _looked_up(large: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join; ``small`` (a stored table of short rows) is broadcast only if its measured rows are few."""
    return large.join(F.broadcast(small) if small.count() <= BROADCAST_ROWS else small, keys, how)


def components(links: DataFrame) -> DataFrame:
    """(tid, cls): the least id of each connected component, for ids that have a link.

    Labels are the least of the neighbours', then jump to their label's label; a round does both twice and is stored in
    the shared folder. Rounds end when no label moves.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("tid")).agg(F.least(F.col("a"), F.min("b")).alias("cls"))

    def step(labels: DataFrame) -> DataFrame:
        near = both.join(labels.select(F.col("tid").alias("b"), F.col("cls").alias("near")), "b").groupBy(F.col("a").alias("tid")).agg(F.min("near").alias("near"))
        moved = labels.join(near, "tid").withColumn("cls", F.least("cls", "near")).drop("near")
        far = labels.select(F.col("tid").alias("cls"), F.col("cls").alias("far"))
        return moved.join(far, "cls").withColumn("cls", F.least("cls", "far")).drop("far")

    while True:
        start = written(labels.withColumn("was", F.col("cls")), "labels")
        labels = written(step(step(start)), "labels")
        if labels.filter("cls <> was").isEmpty():
            return labels.select("tid", "cls")
        labels = labels.select("tid", "cls")


def _verified(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) whose shingle sets have the Jaccard similarity, from candidate pairs."""
    first = edges.join(sets.select(F.col("tid").alias("b"), F.col("set").alias("sb")), "b")
    pairs = first.join(sets.select(F.col("tid").alias("a"), F.col("set").alias("sa")), "a")
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    close = pairs.filter(small >= similarity * large)
    common = F.size(F.array_intersect("sa", "sb"))
    return close.filter(common >= F.lit(similarity) * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets in which more than one class is left."""
    split = members.groupBy("bucket").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo <> hi").select("bucket")
    return members.join(split, "bucket")


def _possible(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Members of open buckets that may still have a partner there, with their set size and own shingles.

    ``alone`` counts a member's shingles that no other open member has. The union with a partner holds the partner's own
    shingles besides all of the member's, and the common part none of either's, so with the least ``alone`` of the bucket a
    similarity can be ruled out without looking at pairs.
    """
    near = sets.join(members.select("tid").distinct(), "tid", "left_semi")
    single = near.select("tid", F.explode("set").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("tid").alias("tid")).filter("k = 1")
    alone = single.groupBy("tid").agg(F.count("*").alias("alone"))
    known = written(near.select("tid", F.size("set").alias("n"), "marks", "beyond").join(alone, "tid", "left").na.fill(0, ["alone"]), "own-shingles")
    known = members.join(known, "tid")
    least = known.groupBy("bucket").agg(F.min("alone").alias("least"))
    return _open(known.join(least, "bucket").filter(F.col("n") - F.col("alone") >= F.lit(similarity) * (F.col("n") + F.col("least"))).drop("least"))


def _links(members: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(tid, cls): classes of all members by links between bucket mates, from leaders instead of all pairs.

    In each round every open bucket (one with members of two classes or more) names leaders; the members of other
    classes are verified against them. A leader has then met everyone in its bucket and leaves it, so rows emitted are in
    proportion to the members, and when no bucket is open every pair of bucket mates is of one class, was verified, or
    was ruled out by ``_possible``. As soon as a round may emit as many rows as there are pairs left between classes, all of them
    are met at once and it is the last round. The first leader is the member that most others share buckets with; later ones are those
    with the fewest shingles of their own, which can have most partners. Their number grows from round to round, so rounds
    are as many as the logarithm of the largest bucket.
    """
    central = members.groupBy("tid").agg(F.sum(F.log("n")).alias("rank"))
    current = members.select("bucket", "tid").join(central, "tid").withColumn("cls", F.col("tid"))
    classes, leaders_each, all_members = central.select("tid", F.col("tid").alias("cls")), 1, members.count()
    alike = F.lit(True)
    while True:
        current = written(current, "open-buckets")
        if current.isEmpty():
            return classes
        # a pair of two classes has a member outside the largest class of its bucket
        sizes = current.groupBy("bucket", "cls").agg(F.count("*").alias("k")).groupBy("bucket")
        sizes = sizes.agg(F.sum("k").alias("k"), F.max("k").alias("k_top"), F.max_by("cls", F.struct("k", "cls")).alias("top"))
        pairs = F.sum((F.col("k") - F.col("k_top")) * F.col("k"))
        last = leaders_each > 1 and sizes.agg(pairs).first()[0] <= leaders_each * all_members
        other = F.struct(*[F.col(c).alias(f"{c}_b") for c in current.columns if c != "bucket"]).alias("l")
        if last:
            leaders = current.join(sizes, "bucket").filter("cls <> top").select("bucket", "top", other).select("bucket", "top", "l.*")
            alike = alike & ((F.col("cls") == F.col("top")) | (F.col("tid") < F.col("tid_b")))
        else:
            part = F.pmod(F.xxhash64("tid"), F.lit(leaders_each))
            leaders = current.groupBy("bucket", part.alias("part")).agg(F.max_by(other, F.struct("rank", "tid")).alias("l")).select("bucket", "l.*")
        edges = current.join(leaders, "bucket").filter((F.col("cls") != F.col("cls_b")) & alike).select(F.col("tid").alias("a"), F.col("tid_b").alias("b")).distinct()
        links = written(_verified(edges, sets, similarity), "verified")
        some = not links.isEmpty()
        if some:
            name = lambda c: classes.select(F.col("tid").alias(c), F.col("cls").alias(f"cls_{c}"))
            moved = components(links.join(name("a"), "a").join(name("b"), "b").select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).filter("a <> b"))
            moved = moved.select(F.col("tid").alias("cls"), F.col("cls").alias("to"))
            classes = written(classes.join(moved, "cls", "left").select("tid", F.coalesce("to", "cls").alias("cls")), "classes")
        if last:
            return classes
        left = current.join(leaders.select("bucket", F.col("tid_b").alias("tid")), ["bucket", "tid"], "left_anti").select("bucket", "tid", "cls")
        if some:
            left = left.join(moved, "cls", "left").select("bucket", "tid", F.coalesce("to", "cls").alias("cls"))
        left = written(_open(left), "left")
        current = _possible(left, sets, similarity).withColumn("rank", -F.col("alone") / F.col("n"))
        alike = F.lit(True)
        for bound in (F.col("n") - F.col("alone"), F.col("n_b") - F.col("alone_b"), _at_most_common()):
            alike = alike & (bound >= F.lit(similarity) * (F.col("n") + F.col("n_b") - bound))
        leaders_each *= GROWTH


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE, similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = BAND_ROWS) -> DataFrame:
    """Classes of near-duplicate texts: one row (digest, class key, class digest) per distinct text.

    Equal texts are one text from the start (a null text is an empty one). Texts get ProbMinHash signatures of their
    sets of word shingles; bands of equal registers propose partners; a link needs a Jaccard similarity of the shingle sets of
    at least ``similarity``, verified exactly. Classes are connected components; a class is named by the least
    (key, digest) of its rows. Texts without words are only equal to each other if they are equal texts.
    """
    banded = docs.select(digest(text).alias("digest"), F.col(key).alias("key"), _band_udf(size, bands, rows)(utf8(text)).alias("bands"))
    texts = banded.groupBy("digest").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    texts = written(texts.withColumn("tid", F.monotonically_increasing_id()), "texts")
    # a bucket is a band's key; only those with company stay
    flat = texts.select("tid", F.explode("bands").alias("bucket"))
    shared = flat.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(flat.join(shared, "bucket"), "members")
    wanted = written(texts.select("digest", "tid").join(members.select("tid").distinct(), "tid", "left_semi"), "wanted")
    own = _looked_up(docs.select(digest(text).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("t")), wanted, ["digest"])
    own = own.groupBy("tid").agg(F.first("t").alias("t"))
    sets = written(own.select("tid", _set_udf(size)(utf8("t")).alias("own")).select("tid", "own.*"), "shingle-sets")
    classes = _links(members, sets, similarity)
    named = texts.select("digest", "key", "tid").join(classes, "tid", "left")
    named = written(named.withColumn("cls", F.coalesce("cls", "tid")).drop("tid"), "classes")
    # nulls sort first in a struct, so a null key would name its class; others go before
    heads = named.groupBy("cls").agg(F.min(F.struct(F.col("key").isNull().alias("x"), "key", "digest")).alias("head"))
    return named.join(heads, "cls").select("digest", F.col("head.key").alias("class_key"), F.col("head.digest").alias("class_digest"))


def duplicate_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """(key, class_id, is_first) for every row of ``docs``; ``class_id`` is the least key of its class.
    Rows that repeat (key and text equal) get equal results."""
    found = written(near_duplicates(docs, text, key, **how), "text-classes")
    rows = docs.select(F.col(key).alias(key), digest(text).alias("digest"))
    first = F.col(key).eqNullSafe(F.col("class_key")) & (F.col("digest") == F.col("class_digest"))
    return rows.join(found, "digest").select(key, F.col("class_key").alias("class_id"), first.alias("is_first"))


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """One row of every class: the one with the least key. All columns stay, whatever their names. Rows that repeat as a whole in
    key and text are one row afterwards; a null text is an empty one; an empty table gives an empty one."""
    found = written(near_duplicates(docs, text, key, **how), "text-classes")
    # the input row is one struct from here on, so that no column of it meets one of these helpers
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"), digest(text).alias("digest"))
    heads = found.select(F.col("class_key").alias("first_key"), F.col("class_digest").alias("first_digest")).distinct()
    counted = held.groupBy("key", "digest").agg(F.count("*").alias("n"))
    same = F.col("first_digest").eqNullSafe(F.col("digest")) & F.col("first_key").eqNullSafe(F.col("key"))
    chosen = written(heads.join(counted, same).select("digest", "first_key", "n"), "kept-texts")
    marked = _looked_up(held, chosen, ["digest"]).filter(F.col("key").eqNullSafe(F.col("first_key")))
    once = marked.filter("n = 1").select("row")
    repeated = marked.filter("n > 1").groupBy("key", "digest").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(repeated).select("row.*")
