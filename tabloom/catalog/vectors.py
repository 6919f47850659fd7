"""Vectors, text, detections, signals, loans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.functions import vectors as V
from tabloom.operators import signals as SG, text as TX
from tabloom.plans.draws import uniform_sql
from tabloom.sources import images

DIM = 64
HALF = DIM // 2


# ---------------------------------------------------------------- vectors

_PAIRS = """SELECT vec_id, embedding::DOUBLE[] AS a, lead(embedding) OVER (PARTITION BY label ORDER BY vec_id)::DOUBLE[] AS b, label FROM embeddings"""


@query("vec_lerp", f"""SELECT label, vec_id, s::INT AS step, 1 AS repeat, list_transform(list_zip(a, b), lambda p: p[1] + (p[2] - p[1]) * (s / 4.0::DOUBLE)) AS vector
FROM ({_PAIRS}), range(1, 5) r(s) WHERE b IS NOT NULL""")
def _(t):
    return SG.interpolate(t.embeddings, ["label"], "vec_id", "embedding", 4)


@query("vec_lerp_freeze", f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i, count(*) OVER (PARTITION BY label) AS n FROM ({_PAIRS}) WHERE b IS NOT NULL)
SELECT label, vec_id, s::INT AS step, count(*) AS copies FROM p, range(0, 4) r(s), range(1, 31) q(k) WHERE k = 1 OR (i = 1 AND s = 0) OR (i = n AND s = 3) GROUP BY ALL""")
def _(t):
    out = SG.interpolate(t.embeddings, ["label"], "vec_id", "embedding", 4, include_start=True, freeze=30)
    return out.groupBy("label", "vec_id", "step").agg(F.count("*").alias("copies"))


_MEMBERS = "(SELECT label, embedding::DOUBLE[] AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS i, count(*) OVER (PARTITION BY label) AS n FROM embeddings)"


@query("vec_mix_pairs", f"""WITH m AS {_MEMBERS}, d AS (SELECT label, draw, floor({uniform_sql(42, 'label', 'draw')} * n)::BIGINT AS a, floor({uniform_sql(43, 'label', 'draw')} * n)::BIGINT AS b
 FROM (SELECT DISTINCT label, n FROM m), range(1, 21) r(draw)),
p AS (SELECT d.label, draw, unnest(x.v) AS x, unnest(y.v) AS y, generate_subscripts(x.v, 1) - 1 AS k FROM d JOIN m x ON x.label = d.label AND x.i = a JOIN m y ON y.label = d.label AND y.i = b)
SELECT label, draw::INT AS draw, count(*) AS size, round(sum(round(x + (y - x) * (0.2::DOUBLE + 0.6::DOUBLE * {uniform_sql(44, 'label', 'draw', 'k')}), 5)), 3) AS total FROM p GROUP BY label, draw""")
def _(t):
    made = SG.synthesize(t.embeddings, "label", "vec_id", "embedding", 20)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x)
    return made.select("label", "draw", F.size("vector").cast("long").alias("size"), F.round(total, 3).alias("total"))


@query("vec_block_set", """SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i BETWEEN 6 AND 30 THEN 4 ELSE x END)::DOUBLE[] AS v FROM embeddings""")
def _(t):
    return t.embeddings.select("vec_id", V.set_block(V.doubles("embedding"), 5, 30, 4.0).alias("v"))


@query("vec_element_set", """SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN i IN (1, 64) THEN 7 ELSE x END) AS v, list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN i = 33 THEN x + 0.25 ELSE x END) AS w FROM embeddings""")
def _(t):
    return t.embeddings.select("vec_id", V.set_elements("embedding", {0: 7.0, 63: 7.0}).alias("v"),
                               V.set_elements("embedding", {32: 0.25}, add=True).alias("w"))


@query("vec_random_step", f"""WITH e AS (SELECT vec_id, c, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS k FROM embeddings, range(1, 26) r(c))
SELECT vec_id, c::INT AS candidate, round(sum(x + {uniform_sql(42, 'vec_id', 'c', 'k')} - 0.5), 6) AS total FROM e GROUP BY vec_id, c""")
def _(t):
    moved = SG.explore(t.embeddings, "vec_id", "embedding", 25)
    return moved.select("vec_id", "candidate", F.round(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query("vec_to_columns", "SELECT vec_id, label, " + ", ".join(f"embedding[{i}] AS v{i}" for i in range(1, DIM + 1)) + " FROM embeddings")
def _(t):
    return V.to_columns(t.embeddings, "embedding", DIM)


@query("vec_from_columns", "SELECT vec_id, label, embedding FROM embeddings")
def _(t):
    wide = V.to_columns(t.embeddings, "embedding", DIM)
    return V.from_columns(wide, [f"v{i}" for i in range(1, DIM + 1)], "embedding")


@query("vec_scale", "SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / 127.5::DOUBLE - 1) AS v FROM embeddings")
def _(t):
    return t.embeddings.select("vec_id", V.scale_bytes("embedding").alias("v"))


@query("vec_mahalanobis", f"""WITH d AS (SELECT vec_id, list_transform(list_zip(embedding[1:{HALF}], embedding[{HALF + 1}:{DIM}]), lambda p: p[1]::DOUBLE - p[2]::DOUBLE) AS d FROM embeddings)
SELECT vec_id, round(sqrt(2 * list_sum(list_transform(d, lambda x: x * x)) - 0.75::DOUBLE * list_sum(list_transform(range(1, {HALF}), lambda i: d[i] * d[i + 1]))), 7) AS d FROM d""")
def _(t):
    # neighbouring elements go together: a band matrix over the whole half
    inverse = [[2.0 if i == j else -0.375 if abs(i - j) == 1 else 0.0 for j in range(HALF)] for i in range(HALF)]
    d = V.mahalanobis(F.slice("embedding", 1, HALF), F.slice("embedding", HALF + 1, HALF), inverse)
    return t.embeddings.select("vec_id", F.round(d, 7).alias("d"))


# ---------------------------------------------------------------- text

_WORDS = """SELECT doc_id, CASE w WHEN 'the' THEN 'der' ELSE w END AS word, count(*) AS k FROM
(SELECT doc_id, unnest(string_split(lower(text), ' ')) AS w FROM documents) WHERE w <> '' GROUP BY 1, 2"""
_WORD_VECTORS = """SELECT word, [(ascii(substr(word, 1, 1)) % 7)::FLOAT, length(word)::FLOAT, 1::FLOAT] AS v FROM (SELECT DISTINCT word FROM ({words})) WHERE length(word) <= 6""".replace("{words}", _WORDS)


def _word_vectors(t: Tables) -> DataFrame:
    """A small vector per short word of the documents."""
    words = TX.title_words(t.documents, "doc_id", "text", {"the": "der"}).select("word").distinct()
    return words.filter(F.length("word") <= 6).select("word", F.array(
        (F.ascii(F.substring("word", 1, 1)) % 7).cast("float"), F.length("word").cast("float"), F.lit(1.0).cast("float")).alias("vector"))


@query("text_mean_vector", f"""SELECT doc_id, sum(k)::BIGINT AS words, [sum(k * v[1])::DOUBLE / sum(k)::DOUBLE, sum(k * v[2])::DOUBLE / sum(k)::DOUBLE, sum(k * v[3])::DOUBLE / sum(k)::DOUBLE] AS vector
FROM ({_WORDS}) JOIN ({_WORD_VECTORS}) USING (word) GROUP BY 1""")
def _(t):
    return TX.title_vectors(t.documents, _word_vectors(t), "doc_id", "text", 3, {"the": "der"})


@query("text_unknown_words", f"""SELECT word, sum(k)::BIGINT AS n FROM ({_WORDS}) WHERE length(word) > 6 GROUP BY 1""")
def _(t):
    return TX.unknown_words(t.documents, _word_vectors(t), "doc_id", "text", {"the": "der"})


@query("text_most_similar", """WITH u AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y)))) AS u FROM embeddings),
g AS (SELECT list_transform(list_zip(a.u, b.u, c.u), lambda p: (p[1] + p[2] - p[3]) / 3) AS g FROM u a, u b, u c WHERE a.vec_id = 1 AND b.vec_id = 2 AND c.vec_id = 3)
SELECT vec_id, round(list_cosine_similarity(u, g), 8) AS similarity FROM u, g WHERE vec_id NOT IN (1, 2, 3) ORDER BY list_cosine_similarity(u, g) DESC LIMIT 10""")
def _(t):
    out = TX.most_similar(t.embeddings, "vec_id", "embedding", [1, 2], [3], 10)
    return out.withColumn("similarity", F.round("similarity", 8))


@query("json_flatten", """WITH c AS (SELECT conv_id, turn, list_filter([CASE WHEN role <> 'system' THEN role END, CASE WHEN turn = 0 THEN 'first' END], lambda x: x IS NOT NULL) AS tags FROM conversations)
SELECT conv_id, 'turn ' || turn AS name, unnest(CASE WHEN len(tags) = 0 THEN ['no tag'] ELSE tags END) AS item FROM c""")
def _(t):
    tags = F.array_compact(F.array(F.when(F.col("role") != "system", F.col("role")), F.when(F.col("turn") == 0, F.lit("first"))))
    who = F.struct(F.concat(F.lit("turn "), "turn").alias("name"))
    nested = t.conversations.select(F.to_json(F.struct("conv_id", who.alias("who"), tags.alias("tags"))).alias("value"))
    parsed = nested.select(F.from_json("value", "conv_id long, who struct<name:string>, tags array<string>").alias("r")).select("r.*")
    return TX.flatten_records(parsed, {"conv_id": "conv_id", "name": "who.name"}, "tags", "item", "no tag")


# ---------------------------------------------------------------- detections


@query("det_count", "SELECT ts::DATE AS date, count(*) FILTER (event_type = 'click') AS people FROM events GROUP BY 1")
def _(t):
    return SG.count_named(t.events.withColumn("date", F.to_date("ts")), ["date"], "event_type", "click")


@query("det_split", """SELECT ts::DATE AS date, count(*) FILTER (event_type = 'click' AND value < 50) AS people_left, count(*) FILTER (event_type = 'click' AND value >= 50) AS people_right FROM events GROUP BY 1""")
def _(t):
    return SG.count_zones(t.events.withColumn("date", F.to_date("ts")), ["date"], "event_type", "value", 50.0, "click")


@query("det_threshold", "SELECT event_id, value FROM events WHERE value >= 25")
def _(t):
    return SG.above_score(t.events, "value", 25.0).select("event_id", "value")


@query("det_infer", """SELECT doc_id::VARCHAR AS path, 'the' AS name, (unnest(range(1, (length(text) - length(replace(text, 'the', ''))) // 3 + 1)))::BIGINT AS number FROM documents""")
def _(t):
    def find(content: bytes) -> list[tuple]:
        return [("the", i + 1) for i in range(content.count(b"the"))]

    files = t.documents.select(F.col("doc_id").cast("string").alias("path"), F.encode("text", "UTF-8").alias("content"))
    return images.detect(files, find, "name string, number long")


# ---------------------------------------------------------------- signals

# a reading every row of a user: the value is the sample, the row number its index
RATE, STEP, SIZE = 16.0, 4, 8
_SAMPLES = "(SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value FROM events)"


def _samples(t: Tables) -> DataFrame:
    from tabloom.plans.ordered import numbered

    rows = numbered(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts", "event_id"], "i")
    return rows.select("user_id", (F.col("i") - 1).alias("i"), "value")


_FRAMES = f"""SELECT s.user_id, f AS frame, (i - (f * {STEP} - {SIZE}))::INT AS pos, value FROM {_SAMPLES} s
JOIN (SELECT user_id, unnest(range(0, count(*) // {STEP})) AS f FROM events GROUP BY 1) n ON n.user_id = s.user_id AND i >= f * {STEP} - {SIZE} AND i < f * {STEP}"""


def _frames(t: Tables) -> DataFrame:
    return SG.frames(_samples(t), "user_id", "i", "value", STEP, SIZE)


@query("fft_frames", _FRAMES)
def _(t):
    return _frames(t)


# the transform as sums of cosines and sines over the eight samples of a frame
_SPECTRUM = f"""WITH f AS ({_FRAMES}), b AS (SELECT unnest(range(0, {SIZE} // 2 + 1)) AS bin),
m AS (SELECT user_id, frame, bin, sqrt(pow(sum(value * 0.5 * (1 - cos(2 * pi() * pos / {SIZE})) * cos(2 * pi() * bin * pos / {SIZE})), 2)
 + pow(sum(value * 0.5 * (1 - cos(2 * pi() * pos / {SIZE})) * sin(2 * pi() * bin * pos / {SIZE})), 2)) AS mag FROM f, b GROUP BY 1, 2, 3)
SELECT user_id, frame, bin::INT AS bin, bin * {RATE / SIZE}::DOUBLE AS freq, mag / max(mag) OVER () AS magnitude FROM m"""


@query("sig_spectrum", f"SELECT user_id, frame, bin, freq, round(magnitude, 9) AS magnitude FROM ({_SPECTRUM})")
def _(t):
    return SG.spectrum(_frames(t), "user_id", RATE, SIZE).withColumn("magnitude", F.round("magnitude", 9))


@query("topk_distinct_notes", f"""WITH s AS (SELECT user_id, frame, bin, bin * {RATE * 64 / SIZE}::DOUBLE AS freq, round(magnitude, 9) AS magnitude FROM ({_SPECTRUM}) WHERE bin > 0),
n AS (SELECT *, round_even(69 + 12 * log2(freq / 440), 0)::INT AS num FROM s),
m AS (SELECT *, ['C', 'C#', 'D', 'D#', 'E', 'F', 'F#', 'G', 'G#', 'A', 'A#', 'B'][num % 12 + 1] || trunc(num / 12 - 1)::INT AS note FROM n),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, frame, note ORDER BY magnitude DESC, bin) AS r FROM m),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id, frame ORDER BY magnitude DESC, bin) AS place, max(magnitude) OVER (PARTITION BY user_id, frame) AS loud FROM b WHERE r = 1)
SELECT user_id, frame, place::INT AS place, note, freq, magnitude FROM p WHERE loud >= 0.001 AND place <= 3""")
def _(t):
    heard = SG.spectrum(_frames(t), "user_id", RATE * 64, SIZE).withColumn("magnitude", F.round("magnitude", 9))
    return SG.top_notes(heard, "user_id", 3)


@query("udf_group", f"SELECT user_id, frame, count(*) AS n, round(max(value) - min(value), 9) AS spread FROM ({_FRAMES}) GROUP BY 1, 2")
def _(t):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each group comes with all its values; a batch of groups is one array operation. A group with a value that is missing has no spread."""
        for batch in batches:
            held = batch.column("held")
            v, sizes = held.flatten().to_numpy(), held.value_lengths().to_numpy()
            starts = np.cumsum(sizes) - sizes
            gaps = np.maximum.reduceat(v, starts) - np.minimum.reduceat(v, starts) if len(sizes) else np.empty(0)
            gaps = pa.array([round(g, 9) for g in gaps.tolist()], pa.float64(), from_pandas=True)
            yield pa.RecordBatch.from_arrays([batch.column("user_id"), batch.column("frame"), pa.array(sizes, pa.int64()), gaps], names=["user_id", "frame", "n", "spread"])

    # a fixed partition count keeps the Python work spread out even if the bytes are few; frames have few samples, so a group is one list
    parts = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    groups = _frames(t).repartition(parts, "user_id", "frame").groupBy(F.col("user_id").cast("long").alias("user_id"), F.col("frame").cast("long").alias("frame")).agg(
        F.collect_list(F.coalesce("value", F.lit(float("nan")))).alias("held"))
    return groups.mapInArrow(spread, "user_id long, frame long, n long, spread double")


# ---------------------------------------------------------------- loans


# a rate with many digits, so that no amount ends on an exact half, which engines round differently
@query("fin_amortize", """WITH l AS (SELECT o_orderkey, o_totalprice AS p, 0.0412345678::DOUBLE / 12 AS r FROM orders), s AS (SELECT *, p * r / (1 - pow(1 + r, -12)) AS pay, m FROM l, range(1, 13) q(m)),
b AS (SELECT *, p * pow(1 + r, m - 1) - pay * (pow(1 + r, m - 1) - 1) / r AS remaining FROM s)
SELECT o_orderkey, m::INT AS month, round(remaining, 4) AS remaining, round(pay, 4) AS payment, round(remaining * r, 4) AS interest, round(pay - remaining * r, 4) AS principal FROM b""")
def _(t):
    out = SG.amortize(t.orders, ["o_orderkey"], "o_totalprice", 0.0412345678, 12)
    return out.withColumns({c: F.round(c, 4) for c in ("remaining", "payment", "interest", "principal")})
