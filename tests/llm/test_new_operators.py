"""Host reputations, vector codes and token alignment: brute-force twins, and odd input."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tabloom.llm import alignment, ball_trees, common, url_filter, vector_codes

public_tokenizers = pytest.importorskip("public_tokenizers")
JSON, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def judged_by_hand(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=lambda f: len(f[0])) if fits else None


URLS = [None, "", "nothing", "http://", "://x.org/a", "HTTP://A.Example.ORG/es/1", "http://example.org/en/12?x#y", "http://notexample.org/en/1",
        "http://example.org", "https://b.com/fr/", "https://b.com/de/3", "https://b.com/en/3", "https://u:p@b.com:80/de/", "http://10.0.0.1/de/", "http://a.b://c/d",
        "http://Ä.com/fr/1", "http://x.net/" + "a" * 20000, "http://com/de/", "http://x.net?/de/", "http://x.net#/", "http://x.org./"]


def test_rules_by_hand_and_odd_rows(spark):
    rows = [(i, u, "kept") for i, u in enumerate(URLS)] + [(3, "https://b.com/de/3", "kept"), (None, "https://b.com/de/3", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, pages string")
    out = url_filter.filter_urls(df, RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, fit = judged_by_hand(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, fit[0] if fit else None), r
        assert r["verdict"] == (fit[1] if fit else "block" if r["bound"] > 0.5 else "allow")
    assert {r["pages"] for r in out} == {"kept", None}
    assert url_filter.filter_urls(df.limit(0), RULES).count() == 0
    assert {r["verdict"] for r in url_filter.filter_urls(df, []).collect()} == {"allow"}


def test_reputation_shrinks_by_level(spark):
    counts = [("a.bad.com", 400, 390), ("b.bad.com", 2, 0), ("c.bad.com", 0, 0), ("x.good.com", 400, 4), ("y.good.com", 2, 2), ("z.good.com", 300, 0),
              ("new.com", 0, 0), ("lone.net", 1, 1), ("other.dk", 0, 0)]
    df = spark.createDataFrame(counts, "host string, n long, bad long")
    got = {r["host"]: r for r in url_filter.reputation(df).collect()}
    share = lambda h: got[h]["bad_share"]
    assert share("a.bad.com") > 0.95 and share("x.good.com") < 0.05
    assert share("b.bad.com") > share("y.good.com") or share("c.bad.com") > share("z.good.com")
    assert share("c.bad.com") > share("z.good.com")  # hosts without labels take their domain's share
    assert abs(share("other.dk") - (397.5 / 1106)) < 1e-9  # and without a domain that of all pages
    assert all(0 <= r["bound"] <= r["bad_share"] <= 1 for r in got.values())
    assert got["lone.net"]["bound"] < 0.5 < got["a.bad.com"]["bound"]  # one page proves little
    assert {round(r["bad_share"], 9) for r in url_filter.reputation(df.filter("n < 0")).collect()} == set()
    assert [r["bad_share"] for r in url_filter.reputation(df.filter("host = 'new.com'")).collect()] == [0.5]


def test_outcomes_of_the_caller(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 2}.d{i % 2}.net/{i}") for i in range(400)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, bool(i % 2)) for i in range(200)] + [(None, True), (3, None)], "page_id long, bad boolean")
    got = {r["host"]: r["verdict"] for r in url_filter.filter_urls(pages, [], outcomes=outcomes).collect()}
    assert got == {"h0.d0.net": "allow", "h1.d1.net": "block"}


def test_many_hosts_are_joined_like_few(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 7 if i % 3 else 0}.net/fr/{i}") for i in range(200)] + [(500, None)], "page_id long, url string")
    plain = sorted(url_filter.filter_urls(pages, RULES).collect(), key=str)
    monkeypatch.setattr(common, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(common, "HOT_KEY_ROWS", 30)
    assert sorted(url_filter.filter_urls(pages, RULES).collect(), key=str) == plain


def test_domain_columns(spark):
    from pyspark.sql import functions as F

    hosts = ["a.b.co.uk", "b.co.uk", "x.y.example.com:80", "user@example.com", "10.1.2.3:8080", "com", "", "a.com."]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    site = url_filter.site_of(F.col("host"))
    domain = url_filter.domain_of(site, ["co.uk"])
    got = {r[0]: (r[1], r[2]) for r in df.select("host", domain, url_filter.suffix_of(domain)).collect()}
    assert got == {"a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "x.y.example.com:80": ("example.com", "com"), "user@example.com": ("example.com", "com"),
                   "10.1.2.3:8080": ("10.1.2.3", ""), "com": ("com", ""), "": ("", ""), "a.com.": ("a.com", "com")}


# --- vector codes ------------------------------------------------------------------------------------------------------


def nearest(points, entries):
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(p, e)) for e in entries] for p in points]
    return [min(range(len(f)), key=lambda i: (f[i], i)) for f in far], [min(f) for f in far]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 300), st.integers(1, 5), st.integers(1, 40), st.integers(1, 12), st.sampled_from([1, 3, 60, 10**5, 1 << 35]), st.integers(0, 10**6))
def test_balls_find_the_nearest_entries(n, width, k, leaf, spread, seed):
    draw = np.random.default_rng(seed)
    points = draw.integers(-spread, spread + 1, (n, width))
    entries = draw.integers(-spread, spread + 1, (k, width))
    tree = ball_trees.BallTree.from_bytes(ball_trees.BallTree.build(points, leaf).to_bytes())
    counts, sums, entry, error = tree.owners(entries, True)
    own, far = nearest(points, entries)
    assert entry.tolist() == own
    assert error.tolist() == [min(f, ball_trees.LARGEST) for f in far]
    fast_counts, fast_sums, _, _ = tree.owners(entries, False)
    want = np.zeros((k, width), np.int64)
    np.add.at(want, own, points)
    assert counts.tolist() == fast_counts.tolist() == np.bincount(own, minlength=k).tolist()
    assert (sums == want).all() and (fast_sums == want).all()
    if n:
        inner = np.flatnonzero(tree.left >= 0)
        assert (tree.count[inner] == tree.count[tree.left[inner]] + tree.count[tree.right[inner]]).all()
        assert tree.count[-1] == n and (tree.total[-1] == points.sum(0)).all()


def test_whole_balls_are_taken_without_their_points():
    draw = np.random.default_rng(5)
    centers = draw.integers(-10**4, 10**4, (20, 8))
    points = (centers[draw.integers(0, 20, 4000)] + draw.integers(-20, 20, (4000, 8)))
    tree = ball_trees.BallTree.build(points)
    seen = []
    tree._ranges, plain = (lambda node: seen.append(node) or plain(node)), tree._ranges
    counts, _, _, _ = tree.owners(centers, False)
    assert counts.sum() == 4000 and not seen


def codes_by_hand(rows, entries=256, parts=4, rounds=4, scale=1024):
    fine = [(k, lab, [int(np.floor(scale * x)) for x in v]) for k, v, lab in rows
            if v and len(v) % parts == 0 and all(x is not None and np.isfinite(x) for x in v)]
    fine.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not fine:
        return []
    fine = [r for r in fine if len(r[2]) == len(fine[0][2])]
    w = len(fine[0][2]) // parts
    pts = [[v[p * w : p * w + w] for _, _, v in fine] for p in range(parts)]
    books = [[list(x) for x in part[:entries]] for part in pts]
    for step in range(rounds + 1):
        found = [nearest(pts[p], books[p]) for p in range(parts)]
        if step < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    mine = [x for x, o in zip(pts[p], found[p][0]) if o == e]
                    if mine:
                        books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    errors = [sum(found[p][1][i] for p in range(parts)) for i in range(len(fine))]
    by_label = Counter()
    for (_, lab, _), e in zip(fine, errors):
        by_label[lab] += e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(k, lab, "".join(f"{found[p][0][i]:02x}" for p in range(parts)), errors[i], by_label[lab], digest) for i, (k, lab, _) in enumerate(fine)]


def test_codes_by_hand_and_odd_rows(spark):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(8)], rnd.choice([1, 2, None])) for i in range(80)]
    rows += [(i, [0.25] * 8, 7) for i in range(100, 160)] + [(5, rows[5][1], rows[5][2])] * 2
    rows += [(200, None, 1), (201, [], 1), (202, [1.0] * 7 + [None], 1), (203, [float("nan")] * 8, 1), (204, [float("inf")] * 8, 1), (205, [0.5] * 12, 1),
             (206, [0.1] * 7, 1), (None, [0.3] * 8, 9), (207, [-0.0] * 8, 9), (208, [-3e4] * 8, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    got = sorted(map(tuple, vector_codes.code_vectors(df, entries=16, block_rows=13).collect()), key=str)
    as_float = [(k, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for k, v, lab in rows]
    assert got == sorted(codes_by_hand(as_float, entries=16), key=str)
    few = df.filter("vec_id < 9")
    assert sorted(map(tuple, vector_codes.code_vectors(few).collect()), key=str) == sorted(
        codes_by_hand([r for r in as_float if r[0] is not None and r[0] < 9]), key=str)
    none = vector_codes.code_vectors(df.filter("vec_id = 200"))
    assert none.count() == 0 and none.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_huge_components_keep_exact_or_saturate(spark):
    rows = [(i, [float(i * 1000003 % 977) * 2**k for k in range(4, 8)], i % 2) for i in range(30)] + [(40, [1e30, -1e30, 3.0, 1e9], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in vector_codes.code_vectors(df, entries=8).collect()}
    assert len(got) == 31 and all(r["error"] >= 0 for r in got.values())


# --- token alignment ---------------------------------------------------------------------------------------------------


def aligned_by_hand(rows):
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by comparing every token with every other one."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(JSON), SentencePieceProcessor(model_file=PIECES)
    first.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    sign = {chr(b): b for b in own}
    for b in range(256):
        if b not in own:
            sign[chr(256 + len(sign) - len(own))] = b
    words = {i: w for w, i in first.get_vocab().items()}

    def spans(tokens):
        at, out = 0, []
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out

    out, pairs_of, docs = [], [], Counter()
    for key, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(sign[c] for c in words[i]) for i in a]
        pieces = [(i, second.id_to_piece(i)) for i in b]
        bytes_b = [bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not text or {b"".join(bytes_a), b"".join(bytes_b)} != {(" " + text).encode()}:
            a, b, bytes_a, bytes_b = [], [], [], []
        at_a, at_b = spans(bytes_a), spans(bytes_b)
        groups, start = [], 0
        for end in sorted({e for _, e in at_a} & {e for _, e in at_b}):
            inside = [",".join(str(t) for t, (lo, hi) in zip(ids, at) if start <= lo and hi <= end) for ids, at in ((a, at_a), (b, at_b))]
            groups.append("|".join(inside))
            start = end
        links = [(a[i], b[j]) for i, (lo, hi) in enumerate(at_a) for j, (low, high) in enumerate(at_b) if lo < high and low < hi]
        out.append([key, len(a), len(b), len(groups), len(links), ";".join(groups)])
        pairs_of.append(links)
        docs.update(set(links))
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return [(*row[:5], sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links), row[5]) for row, links in zip(out, pairs_of)]


BITS = ["the", "naïve", "Straße", "señor", "  ", "\n", "I'll", "<s>", "<|endoftext|>", "x1y2", "日本語", "🙂", "\t", "foo,bar", "…", "don't", "  \n ", "\u00a0", "\u2003"]


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(BITS, k=rnd.randint(0, 40)))) for i in range(50)]
    return rows + [(60, None), (61, ""), (62, " "), (63, "▁"), (64, "a" * 300), (None, "null key"), (5, "again"), (5, "again"), (66, "\x00\x1f x"),
                   (67, "word naïve  x " * 300 + " "), (68, "mixed ▁ with the sign")]


def as_rows(df):
    return sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["groups"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk_bytes", [12 << 20, 2000, 1])
def test_alignment_by_hand(spark, odd_texts, chunk_bytes):
    df = spark.createDataFrame(odd_texts, "doc_id long, text string").repartition(3)
    want = aligned_by_hand(odd_texts)
    assert as_rows(alignment.align_tokens(df, JSON, PIECES, chunk_bytes=chunk_bytes)) == sorted(want, key=str)
    digests = {(r["doc_id"], r["groups"]) for r in alignment.align_tokens(df, JSON, PIECES, digest=True).collect()}
    assert digests == {(w[0], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want}


def test_alignment_of_empty_tables(spark, odd_texts):
    df = spark.createDataFrame(odd_texts, "doc_id long, text string")
    assert alignment.align_tokens(df.limit(0), JSON, PIECES).count() == 0
    nothing = alignment.align_tokens(df.filter("doc_id in (60, 61, 63)"), JSON, PIECES).collect()
    assert len(nothing) == 3 and all(r["n_a"] == r["n_links"] == r["count_sum"] == 0 and r["groups"] == "" for r in nothing)


def test_long_texts_are_cut_where_no_token_reaches(monkeypatch, odd_texts):
    aligner = alignment._aligner(alignment.read_file(JSON), alignment.read_file(PIECES))
    assert aligner.may_cut

    def fold(state, done, segment):
        counts, texts, pairs = state or (np.zeros(5, np.int64), [], Counter())
        own, times = alignment._pairs_by_segment(done, len(aligner.bytes_b))(segment)
        return counts + done.counts[segment], [*texts, done.texts[segment]], pairs + Counter(dict(zip(own.tolist(), times.tolist())))

    texts = [(k, t) for k, t in enumerate(t for _, t in odd_texts)]

    def run():
        return [(k, s and (s[0].tolist(), b";".join(s[1]), s[2])) for k, s in aligner.documents(iter(texts), fold)]

    whole = run()
    monkeypatch.setattr(alignment, "PIECE_CHARS", 70)
    monkeypatch.setattr(alignment, "SLICE_CHARS", 150)
    monkeypatch.setattr(alignment, "KEPT_WORDS", 20)  # the memory of words starts anew time and again
    assert any(len(aligner.pieces(t)) > 5 for _, t in texts if t)
    assert all("".join(aligner.pieces(t)) == " " + t for _, t in texts if t)
    assert run() == whole


def test_links_one_by_one(spark, odd_texts):
    df = spark.createDataFrame(odd_texts, "doc_id long, text string").filter("doc_id is not null and doc_id <> 5")
    rows = [r for r in odd_texts if r[0] is not None and r[0] != 5]
    got = Counter((r["doc_id"], r["a"], r["b"]) for r in alignment.token_links(df, JSON, PIECES).collect())
    assert sum(got.values()) == sum(w[4] for w in aligned_by_hand(rows))
    one = sorted(alignment.token_links(df.filter("doc_id = 64"), JSON, PIECES).collect(), key=lambda r: (r["a_at"], r["b_at"]))
    assert sum(r["overlap"] for r in one) == 301 and one[0]["group"] == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 7), st.integers(1, 7), st.integers(1, 7), st.integers(0, 10**6))
def test_row_products_are_matrix_products(n, m, k, seed):
    draw = np.random.default_rng(seed)
    dense = [draw.integers(0, 3, s) * draw.integers(0, 2, s) for s in ((n, m), (m, k))]

    def sparse(x):
        row, column = np.nonzero(x)
        order = draw.permutation(len(row))
        order = order[np.argsort(row[order], kind="stable")]
        return alignment.Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(x)))]).astype(np.int64), column[order], x[row[order], column[order]], x.shape[1])

    a, b = map(sparse, dense)
    product = a.row_products(b)
    back = np.zeros((n, k), np.int64)
    np.add.at(back, (product.rows(), product.columns), product.values)
    assert (back == dense[0] @ dense[1]).all()
    sizes = a.row_product_sizes(b)
    assert sizes.tolist() == [int(((dense[1] != 0).sum(1)[np.flatnonzero(r)]).sum()) for r in dense[0]]


def test_shared_groups_are_a_product_of_incidences():
    group_a, group_b = np.array([0, 0, 1, 2, 2, 2]), np.array([0, 1, 1, 2])
    shared = alignment.token_groups(group_a, 3).row_products(alignment.groups_token(group_b, 3))
    pairs = set(zip(shared.rows().tolist(), shared.columns.tolist()))
    assert pairs == {(i, j) for i in range(6) for j in range(4) if group_a[i] == group_b[j]}
    assert alignment.token_groups(group_a, 3).row_product_sizes(alignment.groups_token(group_b, 3)).sum() == len(pairs)
