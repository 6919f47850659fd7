"""Operators that compare texts, and the pipeline: brute-force twins, and odd input."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import line_dedup, near_dup

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def shingle_set(text):
    ws = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()


def brute_classes(rows):
    """Least id of the component of each text; null texts are empty ones."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingle_set(t) for t in texts]
    up = list(range(len(texts)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    least = {}
    for k, t in rows:
        c = root(texts.index(t or ""))
        best = least.get(c)
        least[c] = k if best is None else best if k is None else min(best, k)
    return {(k, t): least[root(texts.index(t or ""))] for k, t in rows}


def near_copies(rnd, n, words=80, edits=6):
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rnd.randrange(edits)):
            own[rnd.randrange(words)] = f"z{rnd.randrange(10**6)}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def mixed_rows():
    """Groups of near copies around the threshold, exact copies, one shared passage, and odd rows."""
    rnd = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(30))
    texts = near_copies(rnd, 60, edits=8) + near_copies(rnd, 15, 40, 3) + near_copies(rnd, 8, 200, 20)
    texts += [passage + " " + " ".join(f"w{rnd.randrange(5000)}" for _ in range(70)) for _ in range(30)]
    texts += ["The same text, many times over and over again."] * 12
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(500, ""), (501, None), (502, "one two"), (503, "One, two!"), (504, "..."), (None, "only a null id here, friends"), (505, "a b c d e " * 300), (506, "a b c d e " * 300 + "f")]
    return rows + rows[:3]


def test_classes_equal_brute_force(spark, mixed_rows):
    got = near_dup.duplicate_classes(spark.createDataFrame(mixed_rows, SCHEMA).repartition(4))
    rows = got.collect()
    want = brute_classes(mixed_rows)
    assert len(rows) == len(mixed_rows)
    by_id = {}
    for (k, _), c in want.items():
        by_id[k] = c
    assert {r["doc_id"]: r["class_id"] for r in rows} == by_id


def test_one_document_of_each_class_stays(spark, mixed_rows):
    docs = spark.createDataFrame(mixed_rows, SCHEMA).withColumns({"key": F.lit(1), "cls": F.lit(None).cast("string"), "digest": F.lit("x")})
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == sorted({str(c) for c in brute_classes(mixed_rows).values()})


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert near_dup.duplicate_classes(empty).count() == 0 and near_dup.keep_first(empty).count() == 0
    lone = spark.createDataFrame([(1, "first text of all the texts here"), (2, "another one, quite unlike the other")], SCHEMA)
    assert {(r["doc_id"], r["class_id"]) for r in near_dup.duplicate_classes(lone).collect()} == {(1, 1), (2, 2)}


def test_signatures_estimate_the_probability_jaccard():
    draw = np.random.default_rng(3)
    common, a, b = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (300, 60, 40))
    counts = draw.integers(1, 5, 400)
    left = (np.concatenate([common, a]), np.concatenate([counts[:300], counts[300:360]]))
    right = (np.concatenate([common, b]), np.concatenate([counts[:300], counts[360:400]]))
    signature = near_dup.signatures([left, right, left], 2000)
    weights = [dict(zip(s.tolist(), 1 + np.log(c))) for s, c in (left, right)]
    exact = 0.0
    for d in set(weights[0]) & set(weights[1]):
        exact += 1 / sum(max(w.get(e, 0) / w[d] for w in weights) for e in set(weights[0]) | set(weights[1]))
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.04
    assert (signature[0] == signature[2]).all()


def test_signatures_do_not_depend_on_the_batch():
    rnd = random.Random(1)
    texts = [" ".join(f"w{rnd.randrange(300)}" for _ in range(n)).encode() for n in (0, 1, 3, 7, 60, 900)] + [None]
    sets = near_dup.shingles(texts)
    together = near_dup.signatures(sets)
    for k, one in enumerate(sets):
        assert (near_dup.signatures([one])[0] == together[k]).all()


def test_inner_repeats_lose_no_link(spark):
    """Links are of shingle sets, so how often a text says a shingle must not keep a pair from being proposed."""
    rnd = random.Random(5)
    own = lambda k, n: [f"{k}x{rnd.randrange(10**6)}" for _ in range(n)]
    texts = []
    for k in range(40):
        base = own(k, 200)
        texts += [base + own(k, 15) * rnd.choice((20, 100)) for _ in range(2)]
    for k in range(40, 60):
        base, block = own(k, 60), own(k, 60)
        texts += [base + block * 2, base + block * 100]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want = brute_classes(rows)
    assert {c % 2 for c in want.values()} == {0}  # every pair is a link
    got = near_dup.duplicate_classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {k: c for (k, _), c in want.items()}


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (103, 101)], "a long, b long")
    got = {r["tid"]: r["cls"] for r in near_dup.components(links).collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100, 103: 100}


# ---------------------------------------------------------------- lines


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_lines(rows):
    """Earlier lines by (id, text hash order is irrelevant for different ids), then line number."""
    places = []
    for k, t in rows:
        for no, line in enumerate((t or "").split("\n")):
            line = line.strip(" ")
            if len(line) >= 1:
                places.append(((k is None, k, no), line))
    first = {}
    for at, line in sorted(set(places), key=lambda p: p[0]):
        first.setdefault(line, at)
    out = {}
    for k, t in rows:
        lines, kept, exact, near = (t or "").split("\n"), [], 0, 0
        for no, raw in enumerate(lines):
            line, at = raw.strip(" "), (k is None, k, no)
            if len(line) >= 1 and first[line] < at:
                exact += 1
            elif len(line) >= line_dedup.NEAR_CHARS and any(f < at and len(o) >= line_dedup.NEAR_CHARS and one_edit(line, o) for o, f in first.items()):
                near += 1
            else:
                kept.append(raw)
        out[(k, t)] = (0 if t is None else len(lines), exact, near, t if exact + near == 0 else "\n".join(kept))
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(6)
    pool = ["".join(rnd.choice("abc ") for _ in range(n)) for n in (5, 9, 10, 12, 19, 20, 21, 25, 40, 60) for _ in range(4)]

    def line():
        s = rnd.choice(pool)
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            k = rnd.randrange(len(s) + 1)
            s = rnd.choice([s[:k] + "x" + s[k:], s[:k] + s[k + 1 :], s[:k] + "y" + s[k + 1 :]])
        return " " * rnd.randrange(2) + s

    rows = [(k, "\n".join(line() for _ in range(rnd.randrange(8)))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, "\n\n"), (None, "\n".join(pool[-6:])), (203, "long line " * 4000 + "\nother"), (204, "long line " * 4000 + "\nother")]
    rows += rows[:2]  # repeated rows share their decision
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_near", F.lit("old")).withColumn("line", F.lit(1)).repartition(3)
    got = line_dedup.dedup_lines(docs).collect()
    want = brute_lines(rows)
    assert len(got) == len(rows)
    texts = {}
    for k, t in rows:
        texts.setdefault(k, t)
    for r in got:
        assert (r["n_lines"], r["n_exact"], r["n_near"], r["text"]) == want[(r["doc_id"], texts[r["doc_id"]])], r["doc_id"]


def test_short_lines_repeat(spark):
    rows = [(1, "{\n  a = 1\n}\n\n \n\t\nyes"), (2, "{\n  b = 1\n }\n\n \n\t\nyes"), (3, "yes\nStep 1 of 3\nStep 2 of 3\nStep 1 of 3")]
    got = {r["doc_id"]: (r["n_lines"], r["n_exact"], r["n_near"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: (7, 0, 0, rows[0][1]), 2: (7, 3, 0, "  b = 1\n\n \n\t"), 3: (4, 2, 0, "Step 1 of 3\nStep 2 of 3")}


def test_lines_of_nothing(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0


def test_many_equal_lines_leave_one(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat_ws("\n", F.lit("A line that everybody has, word for word."), F.concat(F.lit("own "), F.md5(F.col("id").cast("string")))).alias("text"))
    done = line_dedup.dedup_lines(rows)
    assert done.agg(F.sum("n_exact")).first()[0] == 2999 and done.filter("text not like '%own%'").count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == before.columns, name
        from tabloom.session import written

        docs = written(after, "stage")
        assert 0 < docs.count() <= before.count()
        if name == "MinHash near-dedup":
            rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
            assert all(k == c for (k, _), c in brute_classes(rows).items())
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert tokens.count() == docs.count()
    joined = tokens.join(docs, "doc_id").filter(F.col("decoded_sha256") != F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    assert joined.count() == 0
