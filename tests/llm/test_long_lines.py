"""Lines of any length: variant keys, near lines from one character on, clashing names; bags of passages."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabloom.llm import byte_bpe, decontaminate, line_dedup, near_dup, quality_mil, quality_rules, sharding


@settings(max_examples=100, deadline=None)
@given(st.text("abß🙂", min_size=1, max_size=12))
def test_variant_keys_are_keys_of_the_variants(line):
    cut, _ = line_dedup.variant_keys(line)
    for i in range(len(line)):
        rest = line[:i] + line[i + 1 :]
        assert int(cut[i]) == (line_dedup.variant_keys(rest)[1] if rest else 0)


def edits(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return a != b and abs(len(a) - len(b)) > 1
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return not (a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :])


def brute(rows, near_chars):
    """(key, text): lines that stay."""
    seen, out = [], []
    for key, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for raw in (text or "").split("\n"):
            line = raw.strip(" ")
            solid = any(c not in " \t\n\x0b\x0c\r" for c in line)
            exact = solid and line in seen
            near = solid and not exact and len(line) >= near_chars and any(len(o) >= near_chars and o != line and not edits(o, line) for o in seen)
            if solid:
                seen.append(line)
            if not (exact or near):
                kept.append(raw)
        out.append((key, "\n".join(kept)))
    return out


@pytest.mark.parametrize("near_chars", [1, 20])
def test_near_lines_by_hand_from_any_length(spark, near_chars):
    rnd = random.Random(near_chars)
    rows = [(i, "\n".join("".join(rnd.choices("ab ", k=rnd.randint(0, 6))) + rnd.choice(["", " common tail of a line", "\x0b"]) for _ in range(6))) for i in range(14)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, near_chars=near_chars).collect()}
    assert got == dict(brute(rows, near_chars))


def test_two_long_lines_one_edit_apart(spark):
    rnd = random.Random(1)
    line = "".join(rnd.choices("abcdefgh ", k=200_000))
    other = line[:120_000] + "X" + line[120_001:]
    rows = [(1, line), (2, other), (3, line[:-1]), (4, line[:50_000] + "XY" + line[50_002:])]
    got = {r["doc_id"]: (r["n_near"], len(r["text"])) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (0, 200_000), 2: (1, 0), 3: (1, 0), 4: (0, 200_000)}


NAMES = ["key", "row", "exact", "near", "parts", "gone", "digest", "n", "place", "h1", "_k", "_r", "_w", "_found", "_jump", "_mid", "_part", "_rank", "_digest", "_row", "_text", "first_key"]


def test_no_column_meets_a_helper(spark):
    rows = [(1, "one line of some length\nshared line of this text", 40), (2, "shared line of this text", 41), (2, "shared line of this text", 41), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, v int").select("doc_id", "text", *[F.col("v").alias(n) for n in NAMES])
    want = sorted((r[2] for r in rows), key=str)
    items = spark.createDataFrame([("a", "shared line")], "item_id string, text string")
    for out in (line_dedup.dedup_lines(df), decontaminate.find_overlaps(df, items), quality_rules.text_statistics(df), sharding.jump_shards(df, "doc_id", 4),
                sharding.slotted(df, "doc_id")):
        assert all(n in out.columns for n in NAMES)
        held = out.collect()
        for name in NAMES:
            assert sorted((r[name] for r in held), key=str) == want
    kept = near_dup.keep_first(df).collect()
    assert sorted(r["_digest"] for r in kept if r["doc_id"] != 3) == [40, 41] and set(df.columns) == set(kept[0].asDict())


# --- quality classifier ------------------------------------------------------------------------------------------------


def loss_of(model, x, starts, y):
    total = 0.0
    for lo, hi, want in zip(starts, [*starts[1:], len(x)], y):
        z = (x[lo:hi] - model.mean) / model.scale
        weights, rows = [], []
        for passage in z:
            e = np.tanh(passage @ model.p["W"] + model.p["b"])
            gate = 1 / (1 + np.exp(-(e @ model.p["U"])))
            weights.append(np.exp(float((np.tanh(e @ model.p["V"]) * gate) @ model.p["w"])))
            rows.append(e)
        pooled = sum(a / sum(weights) * e for a, e in zip(weights, rows))
        p = 1 / (1 + np.exp(-float(pooled @ model.p["c"] + model.p["d"][0])))
        total -= np.log(p if want else 1 - p) / len(y)
    return total


def test_every_gradient_is_the_slope_of_the_loss():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(9, quality_mil.WIDTH)).astype(np.float32)
    starts, y = np.array([0, 2, 3, 7]), np.array([1, 0, 1, 0], np.float32)
    model = quality_mil.AttentionPooling(np.zeros(quality_mil.WIDTH, np.float32), np.ones(quality_mil.WIDTH, np.float32))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    before = {k: v.copy() for k, v in model.p.items()}
    slopes = {}
    for name, values in before.items():
        for at in list(np.ndindex(values.shape))[:: max(1, values.size // 6)]:
            ends = []
            for step in (1e-5, -1e-5):
                model.p[name] = values.copy()
                model.p[name][at] += step
                ends.append(loss_of(model, x, starts, y))
            model.p[name] = values
            slopes[name, at] = (ends[0] - ends[1]) / 2e-5
    # one step of the optimiser moves every weight by the rate, against the sign of its slope
    model.fit(x, starts, y, rounds=1, rate=1e-3, decay=0.0)
    for (name, at), slope in slopes.items():
        if abs(slope) > 1e-5:
            assert (before[name][at] - model.p[name][at]) == pytest.approx(1e-3 * np.sign(slope), rel=0.05), (name, at)


def test_scores_are_those_of_a_loop():
    rnd = random.Random(5)
    texts = ["".join(rnd.choices("abc XYZ.,\n|#0é", k=n)).encode() for n in (1, 511, 512, 513, 3000)] + [b""]
    x = [quality_mil.encode_passages(t) for t in texts]
    flat = np.concatenate(x)
    model = quality_mil.AttentionPooling(flat.mean(0), flat.std(0) + 1e-3)
    for raw, bag in zip(texts, x):
        want = np.exp(-loss_of(model, bag, np.array([0]), [1]))
        assert model.score(raw) == pytest.approx(want, abs=1e-5)


def test_long_labelled_texts_are_learned_from(spark):
    assert len(quality_mil._spread(b"x" * 512 * 100, 10)) == 10 and len(quality_mil._spread(b"x" * 700, 10)) == 2
    rnd = random.Random(3)
    rows = [(i, ("good words here. " if i % 2 else "|#$%& ") * rnd.choice([3, 40, 9000])) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = quality_mil.fit_quality(df, labels, fit_rows=40, fit_passages=800)
    scored = {r["doc_id"]: r["predicted"] for r in quality_mil.score_quality(df, model).collect()}
    assert sum(scored[i] == i % 2 for i in range(40)) >= 38
    assert quality_mil.fit_quality(df, labels, fit_passages=0).score(b"x") == pytest.approx(1.0)


# --- packed words ------------------------------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.lists(st.integers(0, 65_000), max_size=5)), max_size=30))
def test_words_come_back_from_their_packs(words):
    import pyarrow as pa

    numbers, per = [], {}
    for chunk, _ in words:
        numbers.append(per.get(chunk, 0))
        per[chunk] = numbers[-1] + 1
    if not words:
        return
    kind = np.dtype("<u2")
    batch = byte_bpe._pack(np.array([c for c, _ in words]), np.array(numbers, np.int32), [np.array(ids, kind).tobytes() for _, ids in words])
    for chunk, n in per.items():
        rows = pa.Table.from_batches([batch]).filter(pa.compute.equal(batch.column("chunk"), chunk))
        lengths, starts, flat = byte_bpe._unpack(rows, n, kind)
        assert [flat[s : s + k].tolist() for s, k in zip(starts, lengths)] == [ids for c, ids in words if c == chunk]


def test_shingle_tasks_hold_few_words(spark):
    """A worker holds the words, hashes and arrivals of a slice, not those of a batch: before, 300,000 words of one batch were one slice."""
    words = np.random.default_rng(8).integers(0, 200_000, (600, 500))
    batch = pa.array([" ".join(f"w{k}" for k in row).encode() for row in words] + [None, b""], pa.binary())
    for udf, most in ((near_dup._band_udf(5, 24, 4), 24e6), (near_dup._set_udf(5), 24e6)):
        tracemalloc.start()
        (out,) = udf.func(iter([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert len(out) == len(batch) and peak < most, peak


def test_last_round_meets_all_pairs_left(spark, monkeypatch):
    """Buckets of sets that are alike without being linked end in few rounds; before, leaders went on until none was left. Links are those of brute force."""
    draw, similarity = random.Random(4), 0.8
    own = [sorted(draw.sample(range(16), 12)) for _ in range(60)]
    buckets = {1: range(0, 40), 2: range(20, 60), 3: range(55, 60)}
    rows = []
    for tid, s in enumerate(own):
        marks, beyond = near_dup.marks_of(np.array(s, np.uint64))
        rows.append((tid, s, marks.tolist(), beyond))
    sets = spark.createDataFrame(rows, "tid long, set array<long>, marks array<long>, beyond int")
    members = spark.createDataFrame([(b, t, len(ts)) for b, ts in buckets.items() for t in ts], "bucket long, tid long, n long")
    labels, plain = [], near_dup.written
    monkeypatch.setattr(near_dup, "written", lambda df, label="step": labels.append(label) or plain(df, label))
    got = {r["tid"]: r["cls"] for r in near_dup._links(members, sets, similarity).collect()}
    top = list(range(60))
    for ts in buckets.values():
        for a in ts:
            for b in ts:
                common = len({*own[a]} & {*own[b]})
                if common >= similarity * (24 - common) and top[a] != top[b]:
                    low, high = sorted((top[a], top[b]))
                    top = [low if t == high else t for t in top]
    alike = lambda of: {frozenset(t for t in range(60) if of[t] == c) for c in {of[t] for t in range(60)}}
    assert 1 < len({*top}) < 60 and alike(got) == alike(top)
    assert labels.count("verified") <= 3, labels
