"""Token counts of a piece model by heap-and-linked-list merging; no token identifiers are made."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.bpe import merge_pairs
from tabloom.llm.common import add_struct

#: Words whose counts a worker keeps; when full, the memory starts anew. It changes speed only.
KEPT_WORDS = 400_000
BLANK = "▁"  # stands for a blank inside pieces
RESULT = "struct<n_bytes:long,n_tokens:long>"


class PieceCounter:
    """Counts tokens as the model's own library does, without begin and end marks.

    Only plain pieces take part in merges; a symbol that is no piece falls back to its bytes, one token each.
    A merge never joins what no piece joins: where no piece has a blank behind another sign, texts are cut before
    blanks (and around line ends, where no piece has one) and the parts are counted on their own.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        norm = spec.normalizer_spec
        if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.escape_whitespaces or spec.trainer_spec.model_type != 2:
            raise ValueError("only byte-pair models without normalisation")
        if not spec.trainer_spec.byte_fallback or any(p.type in (4, 5) for p in spec.pieces):
            raise ValueError("only models with byte fallback and without user-defined pieces")
        self.front = BLANK if norm.add_dummy_prefix else ""
        plain = [p for p in spec.pieces if p.type == 1]
        self.rank = {p.piece: -p.score for p in plain}.get
        self.known = frozenset(p.piece for p in plain)
        line = "\n" if not any("\n" in p.piece for p in plain) else ""
        cut = not any(re.search(f"[^{BLANK}]{BLANK}", p.piece) for p in plain)
        self.parts = re.compile(f"{BLANK}*[^{BLANK}{line}]+|{BLANK}+" + "|\n+" * bool(line) if cut else r"(?s).+").findall
        self.kept: dict[str, int] = {}

    def part(self, part: str) -> int:
        """Initial symbols minus merges; a symbol outside the model counts its bytes."""
        merged = merge_pairs(list(part), self.rank)
        return sum(1 if s in self.known else len(s.encode("utf-8", "surrogatepass")) for s in merged)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        kept, total = self.kept, 0
        for part in self.parts(self.front + text.replace(" ", BLANK)):
            n = kept.get(part)
            if n is None:
                n = self.part(part)
                if len(kept) >= KEPT_WORDS:
                    kept.clear()
                if len(part) <= 64:
                    kept[part] = n
            total += n
        return total


@lru_cache(2)
def _counter(model: bytes) -> PieceCounter:
    """One counter per worker and model; its memory lasts over tasks."""
    return PieceCounter(model)


def count_tokens(docs: DataFrame, model_path: str, text: str = "text", limit: int = 4096) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every whole text; columns of these names are replaced.

    The model file is read once on the driver and travels with the job (a vocabulary, half a megabyte). A null text
    counts as an empty one: no bytes, no tokens.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = _counter(model)
        for batch in batches:
            yield pa.StructArray.from_arrays([
                pa.array([len(t.as_buffer()) if t.is_valid else 0 for t in batch], pa.int64()),
                pa.array([counter.count(t.as_py()) for t in batch], pa.int64())], names=["n_bytes", "n_tokens"])

    out = add_struct(docs.drop("over_limit"), F.arrow_udf(count, RESULT)(F.col(text)), ["n_bytes", "n_tokens"])
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
