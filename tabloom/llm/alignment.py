"""Alignment of the tokens of two tokenizers by products of sparse token-byte and token-group incidence matrices."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from tabloom.llm.common import copied, release
from tabloom.session import written

#: Characters of the texts whose matrices are multiplied together, bytes of one chunk (about), characters of a piece of a long text.
SLICE_CHARS, CHUNK_BYTES, PIECE_CHARS = 1 << 20, 12 << 20, 1 << 17
#: Words, and characters of words, whose tokens a worker remembers; beyond it the memory starts anew. It changes speed only.
KEPT_WORDS, KEPT_CHARS = 300_000, 8 << 20
#: Tokenizer files travel with the tasks; larger ones are refused.
FILE_BYTES = 64 << 20
BLANK = "▁"  # stands for a blank inside pieces
_CUT = re.compile(r"(?<=\S) (?=[\s\S])")
COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


@dataclass
class Csr:
    """A sparse matrix by rows: the columns and values of row i stand from ``starts[i]`` to ``starts[i + 1]``."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @classmethod
    def of_ones(cls, starts: np.ndarray, columns: np.ndarray, width: int) -> Csr:
        return cls(starts, columns, np.ones(len(columns), np.int64), width)

    def row_products(self, other: Csr) -> Csr:
        """This matrix times another one, by rows: row i is the sum of the other's rows that its columns name.

        All products of all rows are laid out one after another; those of one row and column are added up. They are sorted
        first only if they do not come in order, which they do for tokens along a text.
        """
        sizes = np.diff(other.starts)[self.columns]
        row = np.repeat(np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts)), sizes)
        ends = np.cumsum(sizes)
        at = np.repeat(other.starts[self.columns] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        key = row * other.width + other.columns[at]
        value = np.repeat(self.values, sizes) * other.values[at]
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        key = key[first]
        rows = key // other.width if len(key) else key
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(self.starts) - 1))])
        return Csr(starts, key % other.width if len(key) else key, np.add.reduceat(value, first) if len(first) else value[:0], other.width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def row_product_sizes(self, other: Csr) -> np.ndarray:
        """Products per row, without making them (the symbolic pass)."""
        total = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens by bytes, from the byte offsets where tokens end."""
    return Csr.of_ones(np.concatenate([[0], ends]), np.arange(ends[-1] if len(ends) else 0), int(ends[-1]) if len(ends) else 0)


def bytes_token(ends: np.ndarray) -> Csr:
    """The same matrix transposed: every byte has one token."""
    n = int(ends[-1]) if len(ends) else 0
    return Csr.of_ones(np.arange(n + 1), np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0)), len(ends))


def token_groups(group: np.ndarray, n: int) -> Csr:
    """Tokens by groups: every token has one."""
    return Csr.of_ones(np.arange(len(group) + 1), group, n)


def groups_token(group: np.ndarray, n: int) -> Csr:
    """The same matrix transposed."""
    return Csr.of_ones(np.concatenate([[0], np.cumsum(np.bincount(group, minlength=n))]), np.argsort(group, kind="stable"), len(group))


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        raw = f.read(FILE_BYTES + 1)
    if len(raw) > FILE_BYTES:
        raise ValueError("the tokenizer file is too large to travel with tasks")
    return raw


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable Latin-1 signs for themselves, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Slice:
    """Aligned segments: where their tokens, groups and links stand, and their groups as text."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int
    links: Csr
    segment_a: np.ndarray
    counts: np.ndarray
    texts: list[bytes]


class _Words(dict):
    """Numbers words in the order they come and lists the new ones."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]`` one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Aligner:
    """The two tokenizers, and the bytes of their tokens.

    No token reaches across a blank that follows another sign, so texts are cut there, and a word is encoded once for as long as it
    is remembered.
    """

    def __init__(self, json_file: bytes, model_file: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(json_file.decode("utf-8"))
        self.first.encode_special_tokens = True
        self.first.no_truncation()
        self.first.no_padding()
        self.second = SentencePieceProcessor(model_proto=model_file)
        signs = _byte_signs()
        words = self.first.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.bytes_a[i] = bytes(signs[c] for c in word) if all(c in signs for c in word) else word.encode("utf-8")
        sp = self.second
        piece = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if sp.is_byte(i) else p.replace(BLANK, " ").encode("utf-8") for i, p in enumerate(piece)]
        self.size_a, self.size_b = (np.array([len(w) for w in words], np.int64) for words in (self.bytes_a, self.bytes_b))
        # a text may be cut before a blank that follows another sign if no token of either side reaches across
        pre = (json.loads(json_file).get("pre_tokenizer") or {})
        self.may_cut = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in piece)
        self._forget()
        digits = len(str(max(len(self.bytes_a), len(self.bytes_b))))
        ids = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        rows = [(i + sep).ljust(digits + 1, "\0").encode() for sep in ",|;" for i in ids]
        self.written = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), digits + 1)
        self.n_ids = len(ids)

    def pieces(self, text: str) -> list[str]:
        """A blank and the text, cut before blanks that follow another sign. Every piece starts with a blank and has more."""
        text, out = " " + text, []
        at = 0
        while self.may_cut and len(text) - at > PIECE_CHARS:
            found = _CUT.search(text, at + PIECE_CHARS - 64)
            if not found:
                break
            out.append(text[at : found.start()])
            at = found.start()
        return [*out, text[at:]]

    def _forget(self) -> None:
        self.numbers, self.chars = _Words(), 0
        self.flat = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.starts = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.sizes = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.length, self.fine = np.empty(0, np.int64), np.empty(0, bool)

    def words(self, piece: str) -> np.ndarray:
        """Numbers of a piece's words. A piece starts with a blank, and so does each word, whose blank is not kept."""
        found = _CUT.split(piece[1:]) if self.may_cut else [piece[1:]]
        return np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))

    def _encode_words(self) -> None:
        """Encode the words that have come since the last time. A word is fine if either side's tokens give its bytes back."""
        words, self.numbers.fresh = self.numbers.fresh, []
        if not words:
            return
        whole = [" " + w for w in words]
        encode = getattr(self.first, "encode_batch_fast", self.first.encode_batch)
        ids = [e.ids for e in encode(whole, add_special_tokens=False)], self.second.encode(words, num_threads=1)
        raw = [w.encode("utf-8", "surrogatepass") for w in whole]
        fine = [b"".join(map(self.bytes_a.__getitem__, x)) == r and b"".join(map(self.bytes_b.__getitem__, y)) == r for x, y, r in zip(*ids, raw)]
        self.chars += sum(map(len, whole))
        for k in (0, 1):
            sizes = np.fromiter(map(len, ids[k]), np.int64, len(words))
            self.starts[k] = np.concatenate([self.starts[k], len(self.flat[k]) + np.cumsum(sizes) - sizes])
            self.sizes[k] = np.concatenate([self.sizes[k], sizes])
            self.flat[k] = np.concatenate([self.flat[k], np.fromiter(chain.from_iterable(ids[k]), np.int64, int(sizes.sum()))])
        self.length = np.concatenate([self.length, np.fromiter(map(len, raw), np.int64, len(raw))])
        self.fine = np.concatenate([self.fine, np.array(fine, bool)])

    def align(self, segments: list[np.ndarray]) -> tuple[list[bool], Slice]:
        """Align pieces given by their words. One with a word whose tokens do not give its bytes back is left out (False)."""
        self._encode_words()
        fine = [bool(self.fine[s].all()) for s in segments]
        kept = [s for s, f in zip(segments, fine) if f]
        words = np.concatenate([np.empty(0, np.int64), *kept])
        a, b = (_gathered(self.flat[k], self.starts[k][words], self.sizes[k][words]) for k in (0, 1))
        done = self._matrices(a, b, np.cumsum([self.length[s].sum() for s in kept], dtype=np.int64))
        if len(self.numbers) > KEPT_WORDS or self.chars > KEPT_CHARS:
            self._forget()
        return fine, done

    def _matrices(self, a: np.ndarray, b: np.ndarray, segment_ends: np.ndarray) -> Slice:
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        group_ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        n, segments = len(group_ends), len(segment_ends)
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        links = token_bytes(ends_a).row_products(bytes_token(ends_b))
        shared = token_groups(group_a, n).row_product_sizes(groups_token(group_b, n))
        segment_a, segment_b, segment_g = (np.searchsorted(segment_ends, e) for e in (ends_a, ends_b, group_ends))
        per = lambda x, w=None: np.bincount(x, w, segments).astype(np.int64)
        counts = np.stack([per(segment_a), per(segment_b), per(segment_g), per(segment_a, np.diff(links.starts)), per(segment_a, shared)], axis=1)
        # the text of the groups: A ids of a group, then its B ids; the sign behind an id tells what follows
        in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        code = np.empty(len(a) + len(b), np.int64)
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (group_a, group_b))
        code[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + np.where(last_a, self.n_ids, 0)
        code[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = b + np.where(last_b, 2 * self.n_ids, 0)
        signs = self.written[code]
        real = signs != 0
        flat = signs[real].tobytes()
        upto = np.concatenate([[0], np.cumsum(real.sum(1))])[np.cumsum(counts[:, 0] + counts[:, 1])]
        texts = [flat[lo : hi - 1] for lo, hi in zip(np.concatenate([[0], upto[:-1]]), upto)] if segments else []
        return Slice(a, b, group_a, group_b, n, links, segment_a, counts, texts)

    def documents(self, texts: Iterator[tuple[object, str | None]], fold: Callable) -> Iterator[tuple[object, object]]:
        """(mark, state) of every text, in order. ``fold(state, slice, segment)`` is called for each of its pieces, with None first;
        the state is None for a text without tokens. Short texts share slices; of long ones only their state is held."""
        open_docs: list[list] = []  # mark, state, whether all pieces gave their bytes back, pieces in the open slice
        held: list[np.ndarray] = []
        size = 0

        def run() -> None:
            nonlocal held, size
            fine, done = self.align(held)
            no = at = 0
            for doc in open_docs:
                for ok in fine[at : at + doc[3]]:
                    if ok and doc[2]:
                        doc[1] = fold(doc[1], done, no)
                    no += ok
                    doc[2] &= ok
                at, doc[3] = at + doc[3], 0
            held, size = [], 0

        for mark, text in texts:
            doc = [mark, None, True, 0]
            open_docs.append(doc)
            for piece in self.pieces(text) if text else []:
                held.append(self.words(piece))
                doc[3] += 1
                size += len(piece)
                if size >= SLICE_CHARS:
                    run()
            if not held:
                yield from ((m, state if fine else None) for m, state, fine, _ in open_docs)
                open_docs.clear()
        if held:
            run()
        yield from ((m, state if fine else None) for m, state, fine, _ in open_docs)


@lru_cache(1)
def _aligner(json_file: bytes, model_file: bytes) -> Aligner:
    return Aligner(json_file, model_file)


def _packed(numbers: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, 4 * n)), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, str | None]]:
    """(key as an array of one, text) of every row."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield copied(batch.column(0).slice(i, 1)), batch.column(1)[i].as_py()


class _Document:
    """What is kept of a document: counts, groups, and its distinct id pairs with the number of links of each."""

    def __init__(self, digest: bool):
        self.counts, self.pairs, self.times, self.held = np.zeros(len(COUNTS), np.int64), [], [], 0
        self.hash, self.parts = (sha256(), None) if digest else (None, [])
        self.pieces = 0

    def add(self, counts: np.ndarray, text: bytes, pairs: np.ndarray, times: np.ndarray) -> None:
        self.counts += counts
        if self.hash:
            self.hash.update(b";" * (self.pieces > 0) + text)
        else:
            self.parts.append(text)
        self.pieces += 1
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)
        if self.held > 1 << 20:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pairs) > 1:
            own, back = np.unique(np.concatenate(self.pairs), return_inverse=True)
            self.pairs, self.times = [own], [np.bincount(back, np.concatenate(self.times), len(own)).astype(np.int64)]
        self.held = 0
        return self.pairs[0], self.times[0]

    def groups(self) -> str:
        return self.hash.hexdigest() if self.hash else b";".join(self.parts).decode()


def _chunks(batches: Iterator[pa.RecordBatch], aligner: Aligner, digest: bool, chunk_bytes: int) -> Iterator[pa.RecordBatch]:
    """One row per chunk of documents: keys, counts and groups of each, their distinct links as numbers into the chunk's list of id
    pairs, and that list with the number of documents that hold each pair."""
    order, task = 0, TaskContext.get().partitionId()
    width = len(aligner.bytes_b)
    keys, counts, texts, pairs, times, size = [], [], [], [], [], 0

    def closed() -> pa.RecordBatch:
        flat = np.concatenate([np.empty(0, np.int64), *pairs])
        sizes = np.array([len(p) for p in pairs], np.int64)
        names, place = np.unique(flat, return_inverse=True)
        steps = place.astype(np.uint32)
        steps[1:] -= place[:-1].astype(np.uint32)
        one = lambda x, kind: pa.array([x], pa.list_(kind))
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 32) + order], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), pa.concat_arrays(keys)),
             *[one([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))], one(texts, pa.string()), one(sizes, pa.int32()),
             pa.array([_packed(steps)], pa.binary()), pa.array([_packed(np.concatenate([np.empty(0, np.int64), *times]))], pa.binary()),
             pa.array([len(names)], pa.int64()), pa.array([_packed(names // width)], pa.binary()), pa.array([_packed(names % width)], pa.binary()),
             pa.array([_packed(np.bincount(place, minlength=len(names)))], pa.binary())], names=CHUNK)

    last: list = [None, None]

    def fold(state: _Document | None, done: Slice, segment: int) -> _Document:
        if last[0] is not done:
            last[:] = done, _pairs_by_segment(done, width)
        state = state or _Document(digest)
        state.add(done.counts[segment], done.texts[segment], *last[1](segment))
        return state

    none = np.empty(0, np.int64)
    for key, state in aligner.documents(_rows(batches), fold):
        keys.append(key)
        counts.append((state.counts if state else np.zeros(len(COUNTS), np.int64)).tolist())
        texts.append(state.groups() if state else "")
        own, many = state.merge() if state else (none, none)
        pairs.append(own)
        times.append(many)
        size += counts[-1][3] * 4 + (0 if digest else len(texts[-1]))
        if size >= chunk_bytes:
            yield closed()
            keys, counts, texts, pairs, times, size, order = [], [], [], [], [], 0, order + 1
    if keys:
        yield closed()
    release()


def _pairs_by_segment(done: Slice, width: int):
    """For a slice: a look-up of the distinct id pairs of a segment's links, and how often each occurs."""
    i = done.links.rows()
    pair = done.a[i] * width + done.b[done.links.columns]
    span = int(pair.max()) + 1 if len(pair) else 1
    both, times = np.unique(done.segment_a[i] * span + pair, return_counts=True)
    segment = both // span
    bounds = np.searchsorted(segment, np.arange(len(done.counts) + 1))
    both -= segment * span

    def of(s: int) -> tuple[np.ndarray, np.ndarray]:
        return both[bounds[s] : bounds[s + 1]], times[bounds[s] : bounds[s + 1]]

    return of


CHUNK = ["chunk", "keys", *COUNTS, "groups", "sizes", "places", "times", "n_pairs", "first", "second", "docs"]


def align_tokens(docs: DataFrame, json_path: str, model_path: str, text: str = "text", key: str = "doc_id", digest: bool = False,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Align the tokens of whole texts: one row per row of ``docs`` with the key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``,
    ``n_group_links`` (pairs that share a group), ``n_best``, ``count_sum`` and ``groups``.

    A (``json_path``, byte-level) encodes a blank and the text, B (``model_path``, pieces) the text. Links are the nonzero cells of A's token-byte
    matrix times B's transposed one. Groups end where tokens of both end; ``groups`` is their text, ``a1,a2|b1;a3|b2,b3``, or with ``digest`` its
    SHA-256. The count of an id pair is the number of documents that hold it linked; ``n_best`` counts links whose pair has the
    highest count of its A id, ``count_sum`` adds up the counts of all links.

    1. Tasks encode slices of texts and multiply their matrices; a chunk of documents is stored as its distinct id pairs and, for
       each document, numbers into that list.
    2. Every chunk sends each of its pairs once to be counted: documents per pair, the highest count per A id.
    3. The counts go back to the chunks and are added up per document.

    A null or empty text, and one whose tokens do not give back its bytes (with a sign that B writes as a blank, say), has zeros and an empty
    ``groups``. Texts of any length are encoded whole: longer ones piece by piece, cut where no token can reach across. Keys may repeat or
    be null: every row is a document of its own. An empty table gives an empty one. Other columns are not carried.
    """
    if key in {*COUNTS, "n_best", "count_sum", "groups"}:
        raise ValueError("the key column may not be named like the results")
    files = read_file(json_path), read_file(model_path)
    kind = docs.schema[key].dataType.simpleString()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _chunks(batches, _aligner(*files), digest, chunk_bytes)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, n, *packed in zip(*[batch.column(c).to_pylist() for c in range(5)]):
                a, b, held = (_unpacked(p, n).astype(np.int32) for p in packed)
                for at in range(0, n, 100_000):
                    part = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a[part]), chunk)), pa.array(np.arange(at, at + len(a[part]), dtype=np.int32)),
                                                      pa.array(a[part]), pa.array(b[part]), pa.array(held[part])], names=["chunk", "no", "a", "b", "n"])

    def add_up(chunk: pa.Table, counted: pa.Table) -> pa.Table:
        if chunk.num_rows != 1 or counted.num_rows != chunk.column("n_pairs")[0].as_py():
            raise RuntimeError("a chunk has lost pairs")
        one = lambda c: chunk.column(c).combine_chunks().flatten()
        sizes = one("sizes").to_numpy().astype(np.int64)
        n = int(sizes.sum())
        total, best = np.zeros(counted.num_rows, np.int64), np.zeros(counted.num_rows, bool)
        no = counted.column("no").to_numpy()
        total[no], best[no] = counted.column("total").to_numpy(), counted.column("best").to_numpy()
        place = np.cumsum(_unpacked(chunk.column("places")[0].as_py(), n), dtype=np.uint32)
        times = _unpacked(chunk.column("times")[0].as_py(), n).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        added = []
        for value in (best[place] * times, total[place] * times):
            run = np.concatenate([[0], np.cumsum(value, dtype=np.int64)])
            added.append(pa.array(run[upto[1:]] - run[upto[:-1]]))
        return pa.Table.from_arrays([one("keys"), *[one(c) for c in COUNTS], *added, one("groups")], names=[key, *COUNTS, "n_best", "count_sum", "groups"])

    source = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    lists = ", ".join(f"{c} array<long>" for c in COUNTS)
    stored = written(source.mapInArrow(chunks, f"chunk long, keys array<{kind}>, {lists}, groups array<string>, sizes array<int>, places binary, times binary, "
                                               "n_pairs long, first binary, second binary, docs binary"), "aligned-chunks")
    sent = stored.select("chunk", "n_pairs", "first", "second", "docs").mapInArrow(pairs, "chunk long, no int, a int, b int, n int")
    # a chunk has a pair once, so no pair is a large part of the rows
    counted = written(sent.select("chunk", "no", "a", F.sum("n").over(W.partitionBy("a", "b")).alias("total")), "pair-counts")
    # as many rows as A has ids
    highest = counted.groupBy("a").agg(F.max("total").alias("most"))
    back = counted.join(F.broadcast(highest), "a").select("chunk", "no", "total", (F.col("total") == F.col("most")).alias("best"))
    own = stored.drop("first", "second", "docs")
    result = ", ".join([f"`{key}` {kind}", *[f"{c} long" for c in COUNTS], "n_best long", "count_sum long", "groups string"])
    return own.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(add_up, result)


def token_links(docs: DataFrame, json_path: str, model_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The links themselves, one row each: key, position and id of the A and the B token, the bytes they share (``overlap``) and the number of their
    group. Texts without tokens have none; see ``align_tokens`` for what is compared. The links of one text are held until it ends."""
    files = read_file(json_path), read_file(model_path)
    kind = docs.schema[key].dataType.simpleString()

    def fold(state: tuple | None, done: Slice, segment: int) -> tuple:
        before, parts = state or (np.zeros(3, np.int64), [])
        upto = np.concatenate([[[0, 0, 0]], np.cumsum(done.counts[:, :3], axis=0)])
        shift = before - upto[segment]
        lo, hi = done.links.starts[upto[segment : segment + 2, 0]]
        i, j, shared = done.links.rows()[lo:hi], done.links.columns[lo:hi], done.links.values[lo:hi]
        parts.append((i + shift[0], done.a[i], j + shift[1], done.b[j], shared, done.group_a[i] + shift[2]))
        return before + done.counts[segment, :3], parts

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, state in _aligner(*files).documents(_rows(batches), fold):
            for columns in state[1] if state else []:
                repeated = own.take(pa.array(np.zeros(len(columns[0]), np.int64)))
                yield pa.RecordBatch.from_arrays([repeated, *map(pa.array, columns)], names=[key, "a_at", "a", "b_at", "b", "overlap", "group"])

    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").alias("t")).mapInArrow(rows, f"`{key}` {kind}, a_at long, a long, b_at long, b long, overlap long, `group` long")
