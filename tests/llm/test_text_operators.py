"""Operators that work on each text alone: brute-force twins, and odd input."""

import base64
import collections
import hashlib
import random
import re
import time
import tracemalloc
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabloom.llm import byte_bpe, decontaminate, licenses, pii, quality_mil, quality_rules, sharding, token_count

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000 + "Ünïcode end."


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a very long text."""
    rows = [(1, "", "en", "a", 0), (2, None, None, None, None), (None, "Some text here", "en", "a", 14), (3, " \n\n ", "en", None, 4),
            (4, "Some text here", "en", "a", 14), (4, "Some text here", "en", "a", 14), (5, LONG, "en", "a", len(LONG)),
            (6, "x" * 20_000, "en", "a", None), (-7, "naïve 😀 a@b.co +1 212 555 0000\r\n", "fr", "b", 3)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_results_replace_columns_of_their_names(odd):
    clash = odd.withColumns({n: F.lit("old") for n in ("spans", "n_words", "items", "score", "n_tokens", "labels", "kept", "predicted", "shard", "slot")})
    assert len(pii.find_personal_data(clash).collect()) == 9
    assert dict(licenses.scan_licenses(clash).dtypes)["score"] == "double"
    assert dict(quality_rules.apply_rules(clash, []).dtypes)["kept"] == "boolean"
    assert dict(sharding.slotted(sharding.jump_shards(clash, "doc_id", 4), "shard").dtypes)["slot"] == "bigint"
    items = odd.select(F.col("doc_id").alias("item_id"), "text")
    found = decontaminate.find_overlaps(clash, items)
    assert dict(found.dtypes)["n_words"] == "bigint" and {"lang", "source"} <= set(found.columns)


# ---------------------------------------------------------------- decontamination


def brute_overlaps(text, items, width):
    own = words(text)
    hit, names = set(), set()
    for name, item in items:
        ws = words(item)
        for i in range(max(1, len(ws) - width + 1)) if ws else ():
            window = ws[i : i + width]
            for k in range(len(own) - len(window) + 1):
                if own[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    names.add(name)
    return len(own), len(hit), sorted(names)


@pytest.mark.parametrize("shard_words,block_bytes", [(1_000_000, 1 << 24), (40, 1 << 24), (40, 300)])
def test_overlaps_equal_brute_force(spark, shard_words, block_bytes):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abcd") for _ in range(n))
    items = [(k, text(rnd.randrange(0, 9))) for k in range(40)] + [(None, "a b c d a b"), (41, None), (42, "a b c d a b"), (42, "a b c d a b")]
    docs = [(k, text(rnd.randrange(0, 60))) for k in range(60)] + [(None, None), (61, ""), (62, "a b c d a b"), (62, "a b c d a b")]
    named = [("" if k is None else str(k), t) for k, t in items]
    found = decontaminate.find_overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                                        width=5, shard_words=shard_words, block_bytes=block_bytes).collect()
    got = sorted((str(r["doc_id"]), r["text"] or "", r["n_words"], r["n_hit"], r["items"]) for r in found)
    want = sorted((str(k), t or "", *brute_overlaps(t, named, 5)) for k, t in docs)
    assert got == want
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_spans_are_cut_out(spark):
    docs = spark.createDataFrame([(1, "Keep this: one two three four five six. And this."), (2, "nothing here"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "ONE two-three four five six")], "item_id long, text string")
    found = decontaminate.find_overlaps(docs, items, width=4)
    got = {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(found).collect()}
    assert got == {1: "Keep this: . And this.", 2: "nothing here", 3: None}


def test_texts_are_searched_once_before_the_cut(spark):
    """Before, the filter searched each text a second time, in a third worker of the task."""
    docs = spark.createDataFrame([(1, "one two three four five six " * 20), (2, "seven " * 30 + "one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "one two three four five six")], "item_id long, text string")
    cut = decontaminate.cut_spans(decontaminate.find_overlaps(docs, items).filter(F.expr("20 * n_hit < 10 * n_words")))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert plan.count("find(") == plan.count("cut(") == 1, plan
    assert [(r["doc_id"], r["text"].strip()) for r in cut.collect()] == [(2, ("seven " * 30).strip())]


def test_a_shard_holds_numbers_of_words():
    """Before, the words of a whole shard were held as objects of their own: a peak of 31 MB here."""
    rnd = random.Random(6)
    texts = [" ".join(f"word{rnd.randrange(90_000)}" for _ in range(1_000)).encode() for _ in range(400)]
    phrases = decontaminate.Phrases([("a", b" ".join(texts[7].split()[5:30])), ("b", b"not there")], 13)
    tracemalloc.start()
    found = decontaminate.search_shard(texts, phrases)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found[7] == (1_000, 25, ["a"], [{"start": 5, "end": 30}]) and {f[0] for f in found} == {1_000}
    assert peak < 17e6, peak


def test_overlaps_of_nothing(odd, nothing):
    items = odd.select(F.col("doc_id").alias("item_id"), "text")
    assert decontaminate.find_overlaps(nothing, items).count() == 0
    none = decontaminate.find_overlaps(odd, items.filter("1 = 0")).collect()
    assert {r["n_hit"] for r in none} == {0} and max(r["n_words"] for r in none) == 60_002


# ---------------------------------------------------------------- byte-level BPE


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return byte_bpe.read_ranks(path), P.PATTERN, tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk_chars", [16_000_000, 50])
def test_encoding_equals_the_library_and_comes_back(spark, odd, tokenizer, chunk_chars):
    ranks, pattern, library = tokenizer
    rnd = random.Random(3)
    signs = "ab cdE1 \n\t  é日😀'st.,#_  \x1c"
    rows = [(k, "".join(rnd.choice(signs) for _ in range(rnd.randrange(80)))) for k in range(300)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern, chunk_chars=chunk_chars), ranks).collect()
    got = collections.Counter((str(r["doc_id"]), tuple(r["ids"]), bytes(r["decoded"])) for r in coded)
    want = collections.Counter((str(r["doc_id"]), tuple(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode()) for r in docs.collect())
    assert got == want


def test_runs_of_signs_are_the_matches_of_the_splitter():
    find, rnd = byte_bpe.splitter(byte_bpe.RUNS), random.Random(5)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rnd.shuffle(every)
    texts = [None, "", "".join(every)]
    for signs in ("'' sretlvdmS1\n", "'  \n\t\x1c\x85\xa0\u3000\u200bsle1²٣Ⅳéñ日😀\u0301.-_\x00\r\ufeff"):
        texts += ["".join(rnd.choice(signs) for _ in range(rnd.randrange(12))) for _ in range(4_000)]
    for part in (pa.array(texts, pa.large_string()).fill_null(""), pa.array([t or "" for t in texts], pa.large_string()).slice(1)):
        want = [find(t) for t in part.to_pylist()]
        for pattern in (byte_bpe.RUNS, f"(?:{byte_bpe.RUNS})"):
            words, sizes = byte_bpe._split(part, pattern)
            assert sizes.tolist() == list(map(len, want))
            assert words.dictionary.take(words.indices).to_pylist() == [w.encode() for own in want for w in own]


def test_chunking_takes_less_time_than_the_matches_of_the_splitter(tokenizer, monkeypatch):
    pattern, rnd = tokenizer[1], random.Random(6)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) for _ in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=500)) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["k", "t"])
    monkeypatch.setattr(byte_bpe, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))

    def seconds(work) -> float:
        began = time.process_time()
        work()
        return time.process_time() - began

    find = byte_bpe.splitter(pattern)
    alone = min(seconds(lambda: [len(find(t)) for t in texts]) for _ in range(3))
    assert min(seconds(lambda: list(byte_bpe._chunks(iter([batch]), pattern, 1_000_000))) for _ in range(3)) < alone


def test_encoding_of_nothing(nothing, tokenizer):
    ranks, pattern, _ = tokenizer
    assert byte_bpe.encode(nothing, ranks, pattern).count() == 0


def test_decoding_of_null(spark, tokenizer):
    ranks, _, library = tokenizer
    rows = spark.createDataFrame([(None, "old"), ([], "old"), (library.encode_ordinary("Grüße"), "old")], "ids array<int>, decoded string")
    assert [r["decoded"] for r in byte_bpe.decode(rows, ranks).collect()] == [None, b"", "Grüße".encode()]


# ---------------------------------------------------------------- licences

BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute_licenses(text):
    own = words(text)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(own), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def test_licences_equal_brute_force(spark, odd):
    rnd = random.Random(9)
    bag = "gnu general public license apache cc by mit nc the Version 3 other".split()
    rows = [(k, " ".join(rnd.choice(bag) for _ in range(rnd.randrange(60)))) for k in range(300)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in licenses.scan_licenses(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licenses(r["text"])
        assert set(r["base_labels"]) <= set(r["labels"]) and 0 <= r["score"] <= 1


def test_further_licences_need_their_key_phrase(spark):
    terms = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    rows = [(1, terms), (2, terms.replace("modification", "changes")), (3, terms.replace("binary forms", "other forms")), (4, "under the Mozilla Public License")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1][0] == got[2][0] == ["bsd-terms"] and 0 < got[4][1] < got[2][1] < got[1][1] < 1
    assert got[3] == ([], 0.0) and got[4][0] == ["mpl"]


def test_all_alignments_equal_brute_force():
    rnd = random.Random(1)
    split = [(t, common_words(t.text), common_words(t.key)) for t in licenses.TEMPLATES]
    vocabulary = sorted({w for _, own, _ in split for w in own})
    index = licenses.RareWordIndex(licenses.TEMPLATES, {w: rnd.choice([0.1, 1, 3, 7]) for w in vocabulary})
    for _ in range(300):
        words = []
        for _ in range(rnd.randint(0, 6)):
            own = rnd.choice(split)[1]
            words += [w if rnd.random() > 0.08 else rnd.choice([*vocabulary, b"zzz"]) for w in own] if rnd.random() < 0.6 else [rnd.choice([*vocabulary, b"x"]) for _ in range(rnd.randint(0, 9))]
        want = []
        for k, (t, own, key) in enumerate(split):
            for s in range(len(words) - len(own) + 1):
                share = sum(words[s + j] == w for j, w in enumerate(own)) / len(own)
                at = next((i for i in range(len(own)) if own[i : i + len(key)] == key), 0)
                if share >= t.least and words[s + at : s + at + len(key)] == key:
                    want.append((k, s, share))
        assert index.scan(words) == sorted(want)


def common_words(text):
    from tabloom.llm.common import words_of

    return words_of(text.encode())


def test_licences_of_nothing(nothing):
    assert licenses.scan_licenses(nothing).count() == 0


# ---------------------------------------------------------------- personal data

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(p[-5:]) <= 255 and not p[:-5].strip("0") for p in m.group().split(".")),
                    "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@pytest.mark.parametrize("signs", ["a.@1+- 0(4)é\n12.%", "0123456789-  ", "123.", "ab@.", "+1 ()23"])
def test_spans_equal_patterns(signs):
    rnd, cues = random.Random(len(signs)), pii.automaton()
    for _ in range(4000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randrange(70)))
        assert [s for s in pii.find_spans(text, cues) if s[0] in pii.BASE] == brute_spans(text), text


def test_further_kinds():
    text = "see https://ex.org/a?b=1. IBAN DE89 3704 0044 0532 0130 00, bad DE89370400440532013001, 123-45-6789, password = \"hunter2024\" 9.9.9." + "9" * 6000
    got = {(k, text[a:b]) for k, a, b in pii.find_spans(text, pii.automaton())}
    assert got == {("url", "https://ex.org/a?b=1"), ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("secret", "hunter2024")}


def test_masks(odd, nothing):
    got = {r["doc_id"]: r["text"] for r in pii.masked(pii.find_personal_data(odd)).filter("doc_id in (-7, 2, 1)").collect()}
    assert got == {-7: "naïve 😀 [email] [phone]\r\n", 2: None, 1: ""}
    assert pii.find_personal_data(nothing).count() == 0


# ---------------------------------------------------------------- token counts


def test_counts_equal_the_library(spark, odd, nothing):
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    rnd = random.Random(2)
    signs = "ab \n\t▁é日<s>/.0x😀\x00"
    rows = [(k, "".join(rnd.choice(signs) for _ in range(rnd.randrange(60)))) for k in range(500)] + [(900, "<s> a </s> <0x0A> <unk>")]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in token_count.count_tokens(docs, P.path("piece_bpe_32k.model"), limit=100).collect():
        n = len(library.encode(r["text"] or ""))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 100)
    assert token_count.count_tokens(nothing, P.path("piece_bpe_32k.model")).count() == 0


# ---------------------------------------------------------------- shards


def jump(key, shards):
    """The published loop."""
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_equal_the_published_loop(spark):
    rnd = random.Random(1)
    keys = [rnd.randrange(-2**63, 2**63) for _ in range(3000)] + list(range(300)) + [-1, 2**63 - 1, -2**63, None]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long")
    for r in sharding.jump_shards(rows, "doc_id", 40).collect():
        key = 0 if r["doc_id"] is None else r["doc_id"]
        assert (r["shard"], r["grown_shard"]) == (jump(key, 40), jump(key, 41))
        assert r["grown_shard"] in (r["shard"], 40)


def test_slots_have_no_gaps_and_sizes_are_right(spark, odd, nothing):
    import zlib

    got = sharding.shard_documents(odd.unionByName(odd).repartition(5)).collect()
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    assert len(got) == 18 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    texts = collections.Counter((str(r["doc_id"]), len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in odd.collect() * 2)
    assert collections.Counter((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == texts
    assert sharding.shard_documents(nothing).count() == 0


def test_one_hot_key_still_gets_slots(spark):
    rows = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same").alias("text")).repartition(7)
    assert sorted(r["slot"] for r in sharding.shard_documents(rows).collect()) == list(range(20_000))


# ---------------------------------------------------------------- quality rules


def brute_statistics(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    again = {j for i in range(len(ws) - 2) if seen[tuple(ws[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines, n = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n += line in lines
            lines.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), n, len(again)


def test_statistics_equal_brute_force(spark, odd, nothing):
    rnd = random.Random(8)
    signs = ["a", "b", "c#", " ", " ", "\n", "\t", "|", "é", "\x0b", "\x1c"]
    rows = [(k, "".join(rnd.choice(signs) for _ in range(rnd.randrange(120)))) for k in range(400)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    for r in quality_rules.apply_rules(docs, []).collect():
        stats = brute_statistics(r["text"])
        assert tuple(r[c] for c in quality_rules.STATS) == stats, r["text"]
        failed = stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)
    assert quality_rules.apply_rules(nothing, []).count() == 0


def labelled(spark, n=900):
    rnd = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        good = rnd.random() < 0.7
        ws = ["".join(rnd.choice("aeiorstn") for _ in range(rnd.randrange(2, 9))) for _ in range(rnd.randrange(60, 120))]
        if not good:
            ws = [w.upper() + "!!" for w in ws] if k % 2 else [w + rnd.choice(["###", "%%%"]) for w in ws]
        rows.append((k, " ".join(ws)))
        labels.append((k, int(good)))
    labels += [(None, 1), (1, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels[:n])


def held_out(key):
    import zlib

    return zlib.crc32(str(key).encode()) % 4 == 2


def test_learned_list_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark)
    rules = quality_rules.fit_rules(docs, labels)
    assert rules and all(not r.keep for r in rules)
    rows = [r for r in quality_rules.apply_rules(docs, rules).collect() if held_out(r["doc_id"])]
    assert sum(r["kept"] == bool(truth[r["doc_id"]]) for r in rows) / len(rows) > 0.97


def test_list_without_labels(spark, odd):
    assert quality_rules.fit_rules(odd, spark.createDataFrame([], "doc_id long, quality int")) == []


# ---------------------------------------------------------------- quality classifier


def test_classifier_on_held_out_rows(spark):
    docs, labels, truth = labelled(spark)
    model = quality_mil.fit_quality(docs, labels)
    rows = [r for r in quality_mil.score_quality(docs, model).collect() if held_out(r["doc_id"])]
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows) > 0.97


def test_gradient_of_the_attention():
    """One step of the fit moves against the numeric gradient."""
    import numpy as np

    draw = np.random.default_rng(0)
    x, starts, y = draw.normal(size=(9, quality_mil.WIDTH)).astype(np.float32), np.array([0, 2, 3]), np.array([1, 0, 1], np.float32)
    model = quality_mil.AttentionPooling(np.zeros(quality_mil.WIDTH), np.ones(quality_mil.WIDTH))

    def loss():
        out = 0.0
        for k, (a, b) in enumerate(zip(starts, [2, 3, 9])):
            h = model.passages(x[a:b])
            w = np.exp(h["s"] - h["s"].max())
            z = (w / w.sum()) @ h["e"] @ model.p["c"] + model.p["d"][0]
            out += np.log1p(np.exp(-z if y[k] else z)) / 3
        return out

    before = loss()
    model.fit(x, starts, y, rounds=5, rate=1e-3, decay=0.0)
    assert loss() < before


def test_scores_of_odd_texts(spark, odd, nothing):
    model = quality_mil.fit_quality(odd, spark.createDataFrame([(4, 1)], "doc_id long, quality int"))
    rows = quality_mil.score_quality(odd, model).collect()
    assert len(rows) == 9 and {r["predicted"] for r in rows} == {1}
    assert quality_mil.score_quality(nothing, model).count() == 0


def test_pieces_of_a_long_text_score_as_one(monkeypatch):
    import numpy as np

    model = quality_mil.AttentionPooling(np.zeros(quality_mil.WIDTH), np.ones(quality_mil.WIDTH))
    raw = bytes(random.Random(1).randrange(256) for _ in range(9000))
    whole = model.score(raw)
    monkeypatch.setattr(quality_mil, "SLICE_BYTES", 1024)
    assert model.score(raw) == pytest.approx(whole, rel=1e-5)


def test_digest_columns_of_the_queries(spark):
    from tabloom.llm import queries

    got = {r["doc_id"]: r for r in queries.op6_personal_data(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        spans = brute_spans(r["text"] or "")
        row = got[r["doc_id"]]
        assert [row[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in spans) for k in pii.BASE]
        assert row["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
