"""Quality scores by attention-based multiple-instance learning over passages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.llm.common import in_fit_fold, release, utf8

#: Bytes of a passage, hashed three-byte features, width of an encoded passage and of its attention.
PASSAGE, BUCKETS, HIDDEN, GATE = 512, 128, 24, 12
#: Labelled rows to learn from at most (the lowest hashes of their ids), and passages of all of them together. A text with more than an
#: eighth of these gives evenly spread ones.
FIT_ROWS, FIT_PASSAGES = 3_000, 64_000
#: Bytes whose passages a task holds at a time. A longer text is encoded piece by piece.
SLICE_BYTES = 4 << 20
THRESHOLD = 0.7

_CLASSES = [frozenset(range(65, 91)), frozenset(range(97, 123)), frozenset(range(48, 58)), frozenset(b" "), frozenset(b"\n"),
            frozenset(b"!?"), frozenset(b"|#*$%&<>~^=_\\"), frozenset(b".,;:"), frozenset(b"()[]{}'\"-/@+"), frozenset(range(128, 256))]
_CLASS_OF = np.full(256, len(_CLASSES), np.int64)
for _n, _members in enumerate(_CLASSES):
    _CLASS_OF[sorted(_members)] = _n
WIDTH = BUCKETS + len(_CLASSES) + 2


def encode_passages(raw: bytes) -> np.ndarray:
    """One row per passage of a text: roots of hashed three-byte shares, shares of kinds of signs, and its length."""
    flat = np.frombuffer(raw, np.uint8)
    n = max(1, -(-len(flat) // PASSAGE))
    out = np.zeros((n, WIDTH), np.float32)
    if not len(flat):
        return out
    passage = np.arange(len(flat)) // PASSAGE
    sizes = np.bincount(passage, minlength=n)[:, None]
    code = flat.astype(np.uint32)
    if len(flat) > 2:
        three = (code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(25)
        inside = passage[:-2] == passage[2:]
        counts = np.bincount((passage[:-2] * BUCKETS + three)[inside], minlength=n * BUCKETS).reshape(n, BUCKETS)
        out[:, :BUCKETS] = np.sqrt(counts / sizes)
    kinds = len(_CLASSES) + 1
    out[:, BUCKETS : BUCKETS + kinds] = np.bincount(passage * kinds + _CLASS_OF[flat], minlength=n * kinds).reshape(n, kinds) / sizes
    out[:, -1] = np.log1p(sizes[:, 0]) / np.log1p(PASSAGE)
    return out


def _spread(raw: bytes, most: int) -> np.ndarray:
    """The passages of a text, or ``most`` evenly spread ones of them."""
    n = max(1, -(-len(raw) // PASSAGE))
    if n <= most:
        return encode_passages(raw)
    return np.concatenate([encode_passages(raw[i * PASSAGE : (i + 1) * PASSAGE]) for i in np.linspace(0, n - 1, most).astype(int)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionPooling:
    """Passage encoder, gated attention over the passages of a text, and a logistic score of the weighted sum."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        draw = np.random.default_rng(seed)
        shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "d": (1,)}
        self.p = {k: (draw.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "wc" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
        self.mean, self.scale = mean, scale

    def passages(self, x: np.ndarray) -> dict[str, np.ndarray]:
        e = np.tanh(((x - self.mean) / self.scale) @ self.p["W"] + self.p["b"])
        t, g = np.tanh(e @ self.p["V"]), _sigmoid(e @ self.p["U"])
        return {"e": e, "t": t, "g": g, "s": (t * g) @ self.p["w"]}

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.01, decay: float = 1e-4) -> None:
        """Adam on the mean logistic loss of the texts; the gradient goes through attention and encoder."""
        sizes = np.diff(np.append(starts, len(x)))
        text = np.repeat(np.arange(len(starts)), sizes)
        z = ((x - self.mean) / self.scale).astype(np.float32)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        for step in range(1, rounds + 1):
            p, h = self.p, self.passages(x)
            a = np.exp(h["s"] - np.maximum.reduceat(h["s"], starts)[text])
            a /= np.add.reduceat(a, starts)[text]
            pooled = np.add.reduceat(a[:, None] * h["e"], starts)
            off = (_sigmoid(pooled @ p["c"] + p["d"]) - y) / len(y)
            d_pooled = (off[:, None] * p["c"])[text]
            d_a = (d_pooled * h["e"]).sum(1)
            d_s = a * (d_a - np.add.reduceat(a * d_a, starts)[text])
            d_t = d_s[:, None] * p["w"] * h["g"] * (1 - h["t"] ** 2)
            d_g = d_s[:, None] * p["w"] * h["t"] * h["g"] * (1 - h["g"])
            d_e = (a[:, None] * d_pooled + d_t @ p["V"].T + d_g @ p["U"].T) * (1 - h["e"] ** 2)
            grad = {"W": z.T @ d_e, "b": d_e.sum(0), "V": h["e"].T @ d_t, "U": h["e"].T @ d_g, "w": (h["t"] * h["g"]).T @ d_s,
                    "c": pooled.T @ off, "d": off.sum(keepdims=True)}
            for k in p:
                g = grad[k] + decay * p[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def score(self, raw: bytes | None) -> float:
        """Score of one text from all its passages; the weighted sum is kept up piece by piece."""
        raw = raw or b""
        top, weight, pooled = -np.inf, 0.0, np.zeros(HIDDEN)
        step = SLICE_BYTES // PASSAGE * PASSAGE
        for at in range(0, max(1, len(raw)), step):
            h = self.passages(encode_passages(raw[at : at + step]))
            new = max(top, float(h["s"].max()))
            shrink = np.exp(top - new) if np.isfinite(top) else 0.0
            a = np.exp(h["s"] - new)
            top, weight, pooled = new, weight * shrink + float(a.sum()), pooled * shrink + a @ h["e"]
        return float(_sigmoid((pooled / weight) @ self.p["c"] + self.p["d"][0]))


def fit_quality(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
                fit_rows: int = FIT_ROWS, fit_passages: int = FIT_PASSAGES) -> AttentionPooling:
    """Learn from ``fit_rows`` labelled rows of the fit fold at most, and from as many of these as have ``fit_passages`` passages together.

    Rows come in the order of a hash, so a text's length does not decide whether it is learned from; of a text with more than an eighth of
    the passages evenly spread ones are taken. Passages are encoded in Spark; what comes to the driver is bounded by the two parameters. An id
    with several labels takes the lowest. Null texts are empty ones: one passage of nothing. Without rows of both labels the score is constant: the share of good rows, 1 without any.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & in_fit_fold(F.col(key)))
              .groupBy(F.col(key).alias("_k")).agg(F.min(label).alias("_y")).orderBy(F.xxhash64("_k"), "_k").limit(fit_rows))

    most = max(1, fit_passages // 8)

    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_spread(t.as_py() or b"", most).tobytes() for t in batch], pa.binary())
        release()

    rows = docs.select(F.col(key).alias("_k"), utf8(text).alias("_t")).join(F.broadcast(chosen), "_k")  # the bound of the broadcast is the parameter
    size = F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length("_t"), F.lit(0)) / PASSAGE))
    order = [F.xxhash64("_k"), F.col("_k"), F.xxhash64("_t")]
    sizes = rows.orderBy(*order).select(F.least(size, F.lit(most)).alias("n")).limit(fit_rows).collect()
    taken = int(np.searchsorted(np.cumsum([r["n"] for r in sizes]), fit_passages, "right"))
    seen = rows.orderBy(*order).limit(taken).select("_y", F.arrow_udf(encoded, "binary")("_t").alias("x")).collect() if taken else []
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in seen]
    y = np.array([r["_y"] > 0 for r in seen], np.float32)
    x = np.concatenate(bags) if bags else np.zeros((1, WIDTH), np.float32)
    model = AttentionPooling(x.mean(0), x.std(0) + 1e-3)
    if len(set(y.tolist())) == 2:
        model.fit(x, np.cumsum([0] + [len(b) for b in bags[:-1]]), y)
    else:
        model.p["c"][:] = 0
        model.p["d"][:] = 30 if not len(y) or y[0] else -30
    return model


def score_quality(docs: DataFrame, model: AttentionPooling, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` of every whole text; columns of these names are replaced.
    A null text counts as an empty one: one passage of nothing. Texts of any length are scored from all passages, piece by piece; repeated rows
    get equal scores; an empty table gives an empty one."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(t.as_py()) for t in batch], pa.float64())
        release()

    scored = docs.drop("predicted", "score").withColumn("score", F.arrow_udf(score, "double")(utf8(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
