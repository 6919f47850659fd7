"""Byte-level BPE over a corpus: every distinct word is encoded once, and ids return to their places."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.bpe import merge_pairs
from tabloom.llm.common import copied, release

#: Characters of the texts that one chunk holds. A longer text is a chunk of its own.
CHUNK_CHARS = 28_000_000
#: Characters of the texts that are split at once.
SPLIT_CHARS = 500_000
#: The pattern that is split by the kinds of neighbouring signs; others take the splitter, with the same matches and more time.
RUNS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Encoded words that are packed together on their way back to their chunks.
PACK_WORDS = 200_000
#: A vocabulary travels with the tasks; larger files than this are refused.
VOCABULARY_BYTES = 64 << 20
_LOW_BITS = (1 << 63) - 1


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary is too large to travel with tasks")
    return raw


@lru_cache(2)
def _ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, raw.splitlines())}


@lru_cache(2)
def _bytes_by_id(raw: bytes) -> dict[int, bytes]:
    return {rank: word for word, rank in _ranks(raw).items()}


def _forget() -> None:
    """At the end of a task: its worker stays for tasks of other kinds, which need no vocabulary."""
    _bytes_by_id.cache_clear()
    _ranks.cache_clear()
    release()


@lru_cache(4)
def splitter(pattern: str):
    """The pattern's matches; white space is meant as Unicode has it, as in the library of the rank files."""
    return regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")).findall


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    return [ranks[s] for s in merge_pairs([word[i : i + 1] for i in range(len(word))], ranks.get)]


@lru_cache(1)
def _kinds() -> np.ndarray:
    """Kind of every code point: 0 white space, 1 the blank, 2 letters, 3 numbers, 4 the rest, as the splitter's library has them."""
    kinds = np.full(0x110000, 4, np.uint8)
    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0  # not in any text
    signs = points.tobytes().decode("utf-32-le")
    for kind, name in enumerate((r"\p{White_Space}+", " ", r"\p{L}+", r"\p{N}+")):
        for run in regex.finditer(name, signs):
            kinds[run.start() : run.end()] = kind
    return kinds


def _token_starts(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the matches of ``RUNS`` start in the UTF-8 bytes of joined texts, and how many each text has. ``bounds``: where texts start, and the end.

    That pattern leaves no sign out, so a match is known by its first sign alone: one whose kind differs from the sign before
    it, unless that is a blank, which goes with what follows. The last sign of a run of white space before other signs is cut off.
    """
    if len(raw) == 0:
        return np.empty(0, np.int64), np.zeros(len(bounds) - 1, np.int64)
    signs, places, firsts = raw, None, bounds[:-1]
    if raw.max() >= 128:
        signs = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
        places = np.flatnonzero((raw & 0xC0) != 0x80)
        firsts = np.searchsorted(places, firsts)
    n, kinds = len(signs), _kinds()[signs]
    first = np.zeros(n + 3, bool)
    first[firsts] = True
    first[n:] = True
    white = kinds <= 1
    begins = np.ones(n + 3, bool)
    before, own = kinds[:-1], kinds[1:]
    ahead = np.zeros(n, bool)
    ahead[:-1] = ~(white[1:] | first[1:n])
    begins[1:n] = np.where(white[1:], ~white[:-1] | ahead[1:], (before != own) & (before != 1)) | first[1:n]
    # 's 't 'm 'd 're 've 'll, where a match may start at the quote
    quotes = np.flatnonzero(signs == 39)
    quotes = quotes[begins[quotes] & ~first[quotes + 1]]
    padded = np.concatenate([signs[np.minimum(quotes + k, n - 1)] for k in (1, 2)]).reshape(2, -1)
    short = np.isin(padded[0], np.frombuffer(b"stmd", np.uint8))
    long = ~first[quotes + 2] & (((padded[1] == 101) & np.isin(padded[0], np.frombuffer(b"rv", np.uint8))) | ((padded[0] == 108) & (padded[1] == 108)))
    begins[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    begins[quotes[long] + 3] = True
    starts = np.flatnonzero(begins[:n])
    sizes = np.diff(np.searchsorted(starts, np.append(firsts, n)))
    return (starts if places is None else places[starts]), sizes


def _split(texts: pa.Array, pattern: str) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The matches of the pattern in all texts, one after the other, and how many each text has."""
    if pattern != RUNS:
        found = list(map(splitter(pattern), texts.to_pylist()))
        matches = [w.encode("utf-8", "surrogatepass") for own in found for w in own]
        return pa.array(matches, pa.binary()).dictionary_encode(), np.fromiter(map(len, found), np.int64, len(found))
    _, offsets, body = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, 8 * texts.offset)
    raw = np.frombuffer(body or b"", np.uint8)[bounds[0] : bounds[-1]]
    starts, sizes = _token_starts(raw, bounds - bounds[0])
    ends = np.append(starts, len(raw)).astype(np.int32)
    matches = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(raw)])
    return matches.dictionary_encode(), sizes


def _chunks(batches: Iterator[pa.RecordBatch], pattern: str, chunk_chars: int) -> Iterator[tuple]:
    """(chunk, keys, tokens per text, word numbers, distinct words): whole texts, up to ``chunk_chars`` characters.

    The chunk's name is a digest of its task, its order there and its words, so a second pass over other rows does not meet the first one.
    """
    task, order = TaskContext.get().partitionId(), 0
    # the empty word is always there, so that a chunk without words has one
    no_words = pa.DictionaryArray.from_arrays(pa.array([], pa.int32()), pa.array([b""], pa.binary()))
    keys, sizes, parts, chars = [], [], [no_words], 0

    def closed() -> tuple:
        whole = pa.chunked_array(parts).unify_dictionaries()
        words = whole.chunk(0).dictionary
        sequence = np.concatenate([part.indices.to_numpy() for part in whole.chunks])
        parts.clear()
        del whole
        # frequent words get small numbers, which pack better
        order_by_count = np.argsort(-np.bincount(sequence, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order_by_count] = np.arange(len(words), dtype=np.uint32)
        sequence, words = rank[sequence], words.take(pa.array(order_by_count))
        digest = xxhash.xxh3_64(b"%d-%d-" % (task, order))
        for part in (*words.buffers()[1:], sequence):
            digest.update(part)
        return digest.intdigest() & _LOW_BITS, pa.concat_arrays(keys), np.concatenate(sizes), sequence, words

    def add(lo: int, hi: int) -> None:
        part, own = _split(texts.slice(lo, hi - lo), pattern)
        parts.append(part)
        sizes.append(own)
        keys.append(copied(batch.column(0).slice(lo, hi - lo)))

    for batch in batches:
        batch.column(1).validate(full=True)
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        first, held = 0, 0
        for i, n in enumerate(pc.utf8_length(texts).to_pylist()):
            full = chars and chars + n > chunk_chars
            if i > first and (full or held + n > SPLIT_CHARS):
                add(first, i)
                first, held = i, 0
            if full:
                yield closed()
                keys, sizes, parts, chars, order = [], [], [no_words], 0, order + 1
            chars += n
            held += n
        if batch.num_rows:
            add(first, batch.num_rows)
    if sizes:
        yield closed()
    del keys, sizes
    release()


def _packed(sequence: np.ndarray) -> bytes:
    """Byte planes, each compressed: word numbers are mostly small."""
    planes = sequence.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=4 * n), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack(chunks: np.ndarray, numbers: np.ndarray, coded: list[bytes]) -> pa.RecordBatch:
    """One row per chunk of a run of encoded words: their numbers, byte lengths and ids, compressed together."""
    order = np.argsort(chunks, kind="stable")
    chunks, numbers = chunks[order], numbers[order]
    lengths = np.fromiter(map(len, coded), np.uint32, len(coded))[order]
    bounds = np.flatnonzero(np.concatenate([[True], chunks[1:] != chunks[:-1], [True]]))
    rows = []
    pack = zstandard.ZstdCompressor(level=3).compress
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        planes = np.stack([numbers[lo:hi].astype("<u4"), lengths[lo:hi].astype("<u4")]).view(np.uint8).reshape(-1, 4).T
        body = np.ascontiguousarray(planes).tobytes() + b"".join([coded[i] for i in order[lo:hi]])
        rows.append((int(chunks[lo]), int(hi - lo), len(body), pack(body)))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["chunk", "n", "bytes", "coded"])


def _unpack(coded: pa.Table, n: int, packed: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a chunk by their numbers: how many ids, where they start, and all ids."""
    lengths, starts, flat, at = np.zeros(n, np.int64), np.zeros(n, np.int64), [np.empty(0, packed)], 0
    for k, size, raw in zip(*(coded.column(c).to_pylist() for c in ("n", "bytes", "coded"))):
        body = zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, size))
        numbers, sizes = np.ascontiguousarray(np.frombuffer(body, np.uint8, 8 * k).reshape(4, 2 * k).T).view("<u4").reshape(2, k)
        ids = np.frombuffer(body, packed, offset=8 * k) if size > 8 * k else np.empty(0, packed)
        own = sizes.astype(np.int64) // packed.itemsize
        lengths[numbers], starts[numbers] = own, at + np.cumsum(own) - own
        flat.append(ids)
        at += len(ids)
    return lengths, starts, np.concatenate(flat)


def encode(docs: DataFrame, ranks: bytes, pattern: str, text: str = "text", key: str = "doc_id", ids: str = "ids",
           chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Encode whole texts: (key, ids), one row per row of ``docs``. Other columns are not carried.

    1. Texts are cut by ``pattern`` in their tasks. A chunk of texts becomes its distinct words, and for the
       places one number per token, so that a token costs a byte or two instead of a row.
    2. The distinct words of all chunks meet in one shuffle by word and are sorted; each run of equal words is encoded
       once, and its ids go back to every chunk that has the word.
       What goes back is packed: one row per chunk and run of words.
    3. Every chunk puts its texts together by position.

    Smaller chunks (``chunk_chars``) take less memory and, as more of them have the same word, more shuffle and time.

    Nothing depends on how often a word occurs: a chunk has a word once. A null or empty text has no
    ids; keys may repeat or be null; an empty table gives an empty one.
    """
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    packed = np.dtype("<u2" if ranks.count(b"\n") < 65_536 and max(_ranks(ranks).values(), default=0) < 65_536 else "<u4")

    def chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, _, words in _chunks(batches, pattern, chunk_chars):
            # in order of the words, which packs better on the way
            order = pc.array_sort_indices(words)
            for at in range(0, len(order), 50_000):
                part = order.slice(at, 50_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), chunk)), part.cast(pa.int32()), words.take(part)], names=["chunk", "no", "word"])

    def chunk_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, keys, sizes, sequence, words in _chunks(batches, pattern, chunk_chars):
            held = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), held, pa.array([sizes], pa.list_(pa.int32())), pa.array([len(words)], pa.int64()),
                 pa.array([_packed(sequence)], pa.binary())], names=["chunk", "keys", "sizes", "n_words", "places"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last, ids_of = _ranks(ranks), None, b""
        chunks, numbers, coded = [], [], []
        for batch in batches:
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, ids_of = word, np.array(encode_word(word, known), packed).tobytes()
                coded.append(ids_of)
            chunks.append(batch.column("chunk").to_numpy())
            numbers.append(batch.column("no").to_numpy())
            if len(coded) >= PACK_WORDS:
                yield _pack(np.concatenate(chunks), np.concatenate(numbers), coded)
                chunks, numbers, coded = [], [], []
        if coded:
            yield _pack(np.concatenate(chunks), np.concatenate(numbers), coded)
        del known, chunks, numbers, coded
        _forget()

    def put_together(places: pa.Table, coded: pa.Table) -> pa.Table:
        n = sum(coded.column("n").to_pylist())
        if places.num_rows != 1 or n != places.column("n_words")[0].as_py():
            raise RuntimeError("the documents changed between two passes over them")
        lengths, starts, flat = _unpack(coded, n, packed)
        sizes = np.asarray(places.column("sizes")[0].as_py(), np.int64)
        sequence = _unpacked(places.column("places")[0].as_py(), int(sizes.sum()))
        each = lengths[sequence]
        ends = np.cumsum(each)
        at = np.repeat((starts[sequence] - (ends - each)).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        values = flat[at]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
        rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
        del lengths, starts, flat, sequence, each, ends, at, values, bounds
        release()
        return pa.Table.from_arrays([places.column("keys").combine_chunks().flatten(), rows], names=[key, ids])

    words = source.mapInArrow(chunk_words, "chunk long, no int, word binary")
    coded = words.repartition("word").sortWithinPartitions("word").mapInArrow(encode_words, "chunk long, n int, bytes int, coded binary")
    placed = source.mapInArrow(chunk_places, f"chunk long, keys array<{kind}>, sizes array<int>, n_words long, places binary")
    return placed.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(put_together, f"`{key}` {kind}, `{ids}` array<int>")


def decode(coded: DataFrame, ranks: bytes, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes of every id list, joined from the token-byte table, which is as large as the vocabulary and so
    travels with the tasks. Null lists give null; unknown ids raise; a column of the result name is replaced."""

    def look_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = _bytes_by_id(ranks)
        for batch in batches:
            yield pa.array([b"".join(map(table.__getitem__, x.values.to_numpy().tolist())) if x.is_valid else None for x in batch], pa.binary())
        del table
        _forget()

    return coded.withColumn(decoded, F.arrow_udf(look_up, "binary")(F.col(ids)))
