"""Benchmark decontamination with an FM-index per shard of documents."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import add_struct, fresh, release, utf8, words_of
from tabloom.session import written

WIDTH = 13
#: Words of a shard, that is of one index. A longer document is a shard of its own.
SHARD_WORDS = 1_000_000
#: Bytes of test texts that tasks hold at a time; beyond it the items are searched in several passes.
BLOCK_BYTES = 16 << 20
SAMPLE_STEP = 16
FOUND = "struct<n_words:long,n_hit:long,items:array<string>,spans:array<struct<start:int,end:int>>>"


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling. Symbol 0 ends a piece; every 0 ranks by its place, so no
    comparison runs past a piece."""
    n = len(ids)
    ends = ids == 0
    rank = ids.astype(np.int64) + np.count_nonzero(ends)
    rank[ends] = np.arange(np.count_nonzero(ends))
    rank = np.unique(rank, return_inverse=True)[1].astype(np.int64)
    reach = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: n - reach] = rank[reach:] if reach < n else rank[:0]
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        steps = np.concatenate([[0], (np.diff(key[order]) != 0).astype(np.int64)])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(steps)
        if rank[order[-1]] == n - 1 or reach >= n:
            return order
        reach *= 2


class WaveletRanks:
    """Occurrences of a symbol before a place: one bit vector with running counts for each bit of the
    symbols, highest bit first; zeros move to the front of the next level."""

    def __init__(self, symbols: np.ndarray):
        self.bits = max(1, int(symbols.max(initial=0)).bit_length())
        self.ones, self.zeros = [], []
        level = symbols
        for b in reversed(range(self.bits)):
            bit = (level >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(level) - int(self.ones[-1][-1]))
            level = np.concatenate([level[bit == 0], level[bit == 1]])

    def _down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for k, b in enumerate(reversed(range(self.bits))):
            ones = self.ones[k][place]
            place = np.where((symbol >> b) & 1, self.zeros[k] + ones, place - ones)
        return place

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self._down(symbol, place) - self._down(symbol, np.zeros_like(place))


class ShardIndex:
    """FM-index of a sequence of word numbers in which 0 ends a piece."""

    def __init__(self, ids: np.ndarray):
        order = suffix_order(ids)
        self.n = len(ids)
        self.last = ids[order - 1]
        self.ranks = WaveletRanks(self.last)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(ids))]).astype(np.int64)
        # positions are kept for every SAMPLE_STEP-th word and for starts of pieces, where a walk would leave its piece
        sampled = (order % SAMPLE_STEP == 0) | (self.last == 0)
        self.sampled = sampled
        self.sample_no = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of equally long phrases: numbers of the found ones and their row ranges."""
        which = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[which, column]
            known = (symbol > 0) & (symbol < len(self.before) - 1)
            which, symbol, low, high = which[known], symbol[known], low[known], high[known]
            low = self.before[symbol] + self.ranks.rank(symbol, low)
            high = self.before[symbol] + self.ranks.rank(symbol, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all rows in the ranges, with the number of the range each comes from."""
        sizes = high - low
        source = np.repeat(np.arange(len(low)), sizes)
        row = np.repeat(low - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        walked, place = np.zeros(len(row), np.int64), np.full(len(row), -1, np.int64)
        open_ = np.arange(len(row))
        while len(open_):
            at_sample = self.sampled[row[open_]]
            done = open_[at_sample]
            place[done] = self.samples[self.sample_no[row[done]]] + walked[done]
            open_ = open_[~at_sample]
            symbol = self.last[row[open_]]
            row[open_] = self.before[symbol] + self.ranks.rank(symbol, row[open_])
            walked[open_] += 1
        return source, place


class Phrases:
    """Windows of test items as word numbers, grouped by length, with the items of each."""

    def __init__(self, items: list[tuple[str, bytes | None]], width: int):
        self.numbers: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - width + 1)) if ids else ():
                windows.setdefault(tuple(ids[i : i + width]), set()).add(name)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(w) for w in windows}):
            own = [w for w in windows if len(w) == length]
            self.by_length[length] = (np.array(own, np.int64), [sorted(windows[w]) for w in own])
        self.least = min(self.by_length, default=0)


def search_shard(texts: list[bytes | None], phrases: Phrases) -> list[tuple]:
    """Words, hit words, items and merged spans (word numbers, end exclusive) of every text."""
    # words become numbers text by text, as the words of a whole shard take six times the memory of their numbers
    numbered = [np.fromiter(map(phrases.numbers.get, words_of(t), repeat(0)), np.int64) for t in texts]
    sizes = np.array([len(n) for n in numbered], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([np.empty(0, np.int64), *numbered])
    del numbered
    nothing = [(int(n), 0, [], []) for n in sizes]
    if not phrases.least or not len(ids):
        return nothing
    # a word that no phrase has, or the end of a text, ends a piece; shorter pieces than the shortest phrase hold none
    inside = ids > 0
    edge = np.zeros(len(ids) + 1, bool)
    edge[starts] = True
    begins = np.flatnonzero(inside & (edge[:-1] | np.concatenate([[True], ~inside[:-1]])))
    stops = np.flatnonzero(inside & (edge[1:] | np.concatenate([~inside[1:], [True]]))) + 1
    long = stops - begins >= phrases.least
    begins, stops = begins[long], stops[long]
    if not len(begins):
        return nothing
    lengths = stops - begins
    piece_at = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    sequence = np.zeros(int((lengths + 1).sum()), np.int64)
    shift = np.repeat(begins - piece_at, lengths)
    filled = np.repeat(piece_at, lengths) + (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths))
    sequence[filled] = ids[filled + shift]
    index = ShardIndex(sequence)
    marks = np.zeros(len(ids) + 1, np.int64)
    found: dict[int, set[str]] = {}
    for length, (windows, names) in phrases.by_length.items():
        which, low, high = index.search(windows)
        source, place = index.locate(low, high)
        place = place + (begins - piece_at)[np.searchsorted(piece_at, place, side="right") - 1]
        np.add.at(marks, place, 1)
        np.add.at(marks, place + length, -1)
        doc = np.searchsorted(starts, place, side="right") - 1
        for pair in np.unique(doc * len(windows) + which[source]) if len(doc) else ():
            found.setdefault(int(pair) // len(windows), set()).update(names[int(pair) % len(windows)])
    hit = np.cumsum(marks[:-1]) > 0
    out = nothing
    for doc, names in found.items():
        own = np.concatenate([[False], hit[starts[doc] : starts[doc + 1]], [False]]).astype(np.int8)
        turns = np.flatnonzero(np.diff(own))
        spans = [{"start": int(a), "end": int(b)} for a, b in zip(turns[::2], turns[1::2])]
        out[doc] = (int(sizes[doc]), int(own.sum()), sorted(names), spans)
    return out


def _merged(old: dict, new: tuple) -> tuple:
    """Results of two passes over different items."""
    spans = sorted([(s["start"], s["end"]) for s in old["spans"]] + [(s["start"], s["end"]) for s in new[3]])
    joined: list[list[int]] = []
    for a, b in spans:
        if joined and a <= joined[-1][1]:
            joined[-1][1] = max(b, joined[-1][1])
        else:
            joined.append([a, b])
    return (new[0], sum(b - a for a, b in joined), sorted({*old["items"], *new[2]}), [{"start": a, "end": b} for a, b in joined])


def _finder(items: list[tuple[str, bytes | None]], width: int, shard_words: int):
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                      ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])

    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        phrases = Phrases(items, width)
        for raw, earlier in batches:
            out, shard, size = [], [], 0
            for text in raw:
                text = text.as_py()
                shard.append(text)
                size += len(text or b"") // 6
                if size >= shard_words:
                    out += search_shard(shard, phrases)
                    shard, size = [], 0
            out += search_shard(shard, phrases)
            if earlier.null_count < len(earlier):
                out = [_merged(e, o) if e else o for e, o in zip(earlier.to_pylist(), out)]
            yield pa.array([dict(zip(("n_words", "n_hit", "items", "spans"), o)) for o in out], kind)
        release()

    # called nondeterministic so that a filter on the results does not search the texts again, in a second worker of the task
    return F.arrow_udf(find, FOUND).asNondeterministic()


def find_overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  width: int = WIDTH, shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Where documents repeat windows of ``width`` words of test items.

    Each Arrow batch of documents is cut into shards of about ``shard_words`` words; each shard gets
    an FM-index that is searched backwards for all windows at once; sampled suffix positions give the places and
    places are merged to spans. Adds ``n_words``, ``n_hit`` (words inside spans), ``items`` (ids as text,
    sorted as text) and ``spans`` (word numbers, end exclusive); input columns of these names are replaced.

    An item of fewer words than ``width`` is one window; null or empty items have none. A null or empty
    document has no words. Repeated documents and repeated items give the same result each. A null item id counts as
    an empty one. The test items travel with the tasks up to ``block_bytes`` of text; larger sets are searched block by
    block, one pass over the documents each.
    """
    total = items.agg(F.coalesce(F.sum(F.octet_length(item_text) + 16), F.lit(0)).alias("b")).first()["b"]
    blocks = int(total // block_bytes) + 1
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), utf8(item_text).alias("t"))
    held = fresh("found")
    out = docs.withColumn(held, F.lit(None).cast(FOUND))
    for block in range(blocks):
        own = named if blocks == 1 else named.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        if block:
            out = written(out, "overlaps")
        rows = [(r["i"], bytes(r["t"]) if r["t"] is not None else None) for r in own.collect()]
        out = out.withColumn(held, _finder(rows, width, shard_words)(utf8(text), F.col(held)))
    return add_struct(out, F.col(held), ["n_words", "n_hit", "items", "spans"]).drop(held)


def _cut(raw: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    flat = np.frombuffer(raw, np.uint8)
    is_word = _WORD[flat]
    begins = np.flatnonzero(is_word & ~np.concatenate([[False], is_word[:-1]]))
    stops = np.flatnonzero(is_word & ~np.concatenate([is_word[1:], [False]])) + 1
    out, at = [], 0
    for s in spans:
        out.append(raw[at : begins[s["start"]]])
        at = stops[s["end"] - 1]
    return b"".join([*out, raw[at:]])


_WORD = np.array([bool(words_of(bytes([b]))) for b in range(256)])


def cut_spans(found: DataFrame, text: str = "text") -> DataFrame:
    """Take the spans found by ``find_overlaps`` out of the texts; other texts, null and empty ones among them, stay as they are. Texts of any length
    are cut whole; repeated rows are cut alike; an empty table gives an empty one."""

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for raw, spans in batches:
            rows = ((t.as_py(), s.as_py()) for t, s in zip(raw, spans))
            yield pa.array([(_cut(t, s) if s else t).decode("utf-8", "replace") if t is not None else None for t, s in rows], pa.string())
        release()

    return found.withColumn(text, F.when(F.size("spans") > 0, F.arrow_udf(cut, "string")(utf8(text), F.col("spans"))).otherwise(F.col(text)))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """At least one word in twenty stands in a window of a test item."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
