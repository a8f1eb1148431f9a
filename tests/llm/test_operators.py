"""Operators against brute force on small tables with nulls, empties, ties, repeated rows,
long texts and extra columns with clashing names."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from roomrate.llm import exact_dedup, html_text, langid, mix, ngram_join, packing, pseudonyms, quality, registry, toxicity, url_rules

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, row string, n long, key string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(60)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE two"), (5, "ONE two"), (None, "one two three four five"), (7, "É\x1f  x")]
    for i in range(20, 60):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((i, " ".join(w)))
    rows.append((60, " ".join(base * 40)))
    rows += [(61, "same text"), (62, "same text"), (62, "same text")]
    full = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", "c", None]), 1, "x", "y", 2, "z") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_ngram_join(odd, empty, spark):
    def sets(t):
        w = WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
        return {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()

    d = [(r.doc_id, sets(r.text)) for r in odd.collect()]
    part = list(range(len(d)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(d)):
        for j in range(i):
            both = len(d[i][1] & d[j][1])
            if both and 100 * both >= 85 * len(d[i][1] | d[j][1]):
                part[root(i)] = root(j)
    low = {}
    for i, (k, s) in enumerate(d):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    want = sorted(((k, len(s), low.get(root(i))) for i, (k, s) in enumerate(d)), key=repr)
    assert rows(ngram_join.groups(odd), "doc_id", "n_shingles", "component_id") == want
    one = ngram_join.representatives(odd)
    assert one.columns == odd.columns
    wordless = sum(not s for _, s in d)
    assert one.count() == wordless + len({root(i) for i, (_, s) in enumerate(d) if s})
    assert ngram_join.groups(empty).count() == 0


def test_ngram_join_long_lists_and_blocks(spark, monkeypatch):
    """A ball of variants that mostly do not link: the block search finds what brute force does."""
    rng = random.Random(3)
    base = ["b%d" % i for i in range(120)]
    texts = []
    for i in range(150):
        w = list(base)
        for j in rng.sample(range(120), rng.choice([1, 2, 2, 3, 3])):
            w[j] = f"x{i}_{j}" if rng.random() < 0.6 else f"y{j}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 40)
    monkeypatch.setattr(ngram_join, "LONG_LIST", 8)
    got = dict(rows(ngram_join.groups(df), "doc_id", "component_id"))
    s = [set(zip(*[t.split()[k:] for k in range(4)], strict=False)) for t in texts]
    part = list(range(150))
    for i in range(150):
        for j in range(i):
            if 100 * len(s[i] & s[j]) >= 85 * len(s[i] | s[j]):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    assert got == dict(enumerate(part))
    assert 1 < len(set(part)) < 150


def test_pipeline_drops_near_copies_from_a_similarity_of_80_on(spark):
    def sets(text, n):
        w = text.split()
        return {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}

    def similarity(a, b, n=5):
        return len(sets(a, n) & sets(b, n)) / len(sets(a, n) | sets(b, n))

    rng = random.Random(8)
    texts = []
    for g, more in enumerate([40, 48, 52, 30]):  # words appended to a copy of 200 words
        base = ["g%dw%d" % (g, rng.randrange(5000)) for _ in range(200)]
        texts += [" ".join(base), " ".join(base + ["g%dx%d" % (g, i) for i in range(more)])]
    j = [similarity(a, b) for a, b in zip(texts[::2], texts[1::2], strict=True)]
    assert 0.8 <= j[1] < j[0] < 0.85 <= j[3] and j[2] < 0.8
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["ngram_join"]
    assert rows(stage(spark, df, SF), "doc_id") == [(0,), (2,), (4,), (5,), (6,)]
    assert rows(ngram_join.representatives(df), "doc_id") == [(i,) for i in range(7)]


def test_ngram_join_at_5_words_and_80_matches_brute_force(spark, monkeypatch):
    rng = random.Random(11)
    base = ["b%d" % i for i in range(120)]
    texts = []
    for i in range(150):
        w = list(base)
        for j in rng.sample(range(120), rng.choice([1, 2, 2, 3, 4])):
            w[j] = f"x{i}_{j}" if rng.random() < 0.6 else f"y{j}"
        texts.append(" ".join(w))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 40)
    monkeypatch.setattr(ngram_join, "LONG_LIST", 8)
    s = [set(zip(*[t.split()[k:] for k in range(5)], strict=False)) for t in texts]
    part = list(range(150))
    for i in range(150):
        for j in range(i):
            if 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    got = rows(ngram_join.grouped(df, words=5, percent=80), "doc_id", "__near_component_id")
    assert dict(got) == dict(enumerate(part)) and 1 < len(set(part)) < 150


def test_ngram_join_moves_the_sets_of_close_pairs_only(spark, monkeypatch):
    """Texts that share many shingles but cannot link: their sets are neither fetched nor stored."""
    base = ["b%d" % i for i in range(1000)]
    # neighbours have a similarity of 0.64 and meet in more lists than a partner must
    texts = [" ".join(base[15 * i : 15 * i + 100] + ["g%dw%d" % (i, j) for j in range(8)]) for i in range(60)]
    texts += [texts[0] + " tail", texts[1] + " tail", texts[0].upper(), texts[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tables = {}

    def record(df, name, written=ngram_join.written):
        tables.setdefault(name, []).append(written(df, name))
        return tables[name][-1]

    monkeypatch.setattr(ngram_join, "written", record)
    got = dict(rows(ngram_join.groups(df), "doc_id", "component_id"))
    s = [set(zip(*[t.lower().split()[k:] for k in range(4)], strict=False)) for t in texts]
    part = list(range(len(texts)))
    linked = set()
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(s[i] & s[j]) >= 85 * len(s[i] | s[j]):
                linked |= {frozenset(s[i]), frozenset(s[j])} if s[i] != s[j] else set()
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    assert got == dict(enumerate(part)) and len(set(part)) == 60
    assert {kind for _, kind in tables["lists"][0].dtypes} == {"bigint"}  # numbers of classes, no digests
    fetched = sum(t.count() for name in ("sets", "more-sets") for t in tables.get(name, []))
    assert len(linked) == 4 <= fetched <= 8


def test_ngram_join_copies_with_full_filters(spark, monkeypatch):
    """Large groups of copies, and Bloom filters that let everything through."""
    texts = ["a b c d e f g h"] * 40 + ["A b c d e f g h"] * 3 + ["q%d r s t u v" % i for i in range(10)] + ["x y"] * 2 + [None, ""]
    df = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = rows(ngram_join.groups(df), "doc_id", "n_shingles", "component_id")
    low = dict([(100 - i, 58) for i in range(43)] + [(57 - i, 57 - i) for i in range(10)] + [(47, 46), (46, 46), (45, 45), (44, 44)])
    assert {i: c for i, _, c in want} == low
    monkeypatch.setattr(ngram_join, "all_set", lambda *_: F.lit(True))
    assert rows(ngram_join.groups(df), "doc_id", "n_shingles", "component_id") == want


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_never_reject_a_link(percent):
    rng = np.random.default_rng(7)
    rejected = 0
    for n in (1, 2, 20, 63, 64, 65, 127, 130, 1000, 5000):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        for share in (0.0, 0.02, 0.05, 0.08, 0.1, 0.15, 0.3, 0.9):
            new = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            b = np.unique(np.r_[a[int(n * share) // 2 :], new])
            may = ngram_join.may_link(len(a), ngram_join.sketch(a), len(b), ngram_join.sketch(b), percent)
            assert may or not ngram_join.linked(a, b, percent)
            rejected += not may
    assert rejected >= 10


def test_heap_merge_and_probe():
    assert ngram_join.merge_short([[1, 3], [1, 2], [1, 3]], lambda _: 2) == [(1, 3), (3, 2)]
    a, b = np.array([1, 5, 9], np.uint64), np.array([5, 9, 10, 11], np.uint64)
    assert ngram_join.probe_long(a, b) == ngram_join.probe_long(b, a) == 2


def test_exact_dedup(odd, empty):
    groups = Counter(r.text or "" for r in odd.collect())
    high = {}
    for r in odd.collect():
        high[r.text or ""] = max(high.get(r.text or "", -1), -1 if r.doc_id is None else r.doc_id)
    out = exact_dedup.mark_copies(odd, prefix="p_").collect()
    assert len(out) == odd.count()
    kept = Counter(r.text or "" for r in out if r.p_kept)
    assert kept == Counter(dict.fromkeys(groups, 1))
    for r in out:
        assert r.p_group_size == groups[r.text or ""]
        assert (-1 if r.p_keep_id is None else r.p_keep_id) == high[r.text or ""]
    assert exact_dedup.drop_copies(odd).columns == odd.columns
    assert rows(exact_dedup.mark_copies(odd, prefix="p_", max_bits=1 << 16), "doc_id", "p_kept") == rows(
        exact_dedup.mark_copies(odd, prefix="p_"), "doc_id", "p_kept"
    )
    assert exact_dedup.verdicts(empty).count() == 0
    assert exact_dedup.mark_copies(odd, prefix="p_", with_text=False).columns == [c for c in odd.columns if c != "text"] + ["p_keep_id", "p_group_size", "p_kept", "p_sha256"]


def test_exact_dedup_segments_and_both_ways_to_mark(spark, monkeypatch):
    """Every repeated text is found, in many segments, with the filter and with the join."""
    texts = [f"t{i % 4000 if i % 10 < 3 else i}" for i in range(12_000)] + ["hot"] * 6000 + [None, "", "x" * 3_000_000, "x" * 3_000_000]
    df = spark.createDataFrame([(i // 2, t, i) for i, t in enumerate(texts)], "doc_id long, text string, uid long").repartition(7)
    count = Counter(t or "" for t in texts)
    best = {}
    for i, t in enumerate(texts):
        best[t or ""] = max(best.get(t or "", -1), i // 2)
    found = exact_dedup.repeated_hashes(df.select(F.xxhash64(F.coalesce("text", F.lit("")))), segment=1000)
    hashes = {r["h"] for r in found.collect()}
    real = {r["h"] for r in df.groupBy(F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).count().where("count > 1").collect()}
    assert real <= hashes and len(hashes) < len(real) + 600
    for max_bits in (exact_dedup.MAX_BITS, 0):
        out = exact_dedup.mark_copies(df, prefix="p_", max_bits=max_bits).collect()
        assert len(out) == len(texts) and sum(r.p_kept for r in out) == len(count)
        for r in out:
            assert (r.p_group_size, r.p_keep_id) == (count[r.text or ""], best[r.text or ""])
            assert not r.p_kept or r.doc_id == r.p_keep_id


def test_exact_dedup_splits_a_hot_text(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(40_000, numPartitions=8).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.when(F.col("id") % 50 == 1, F.col("id") % 900).otherwise(F.col("id")))).alias("text"))
        out = exact_dedup.verdicts(df)
        assert out.where("kept").count() == df.select("text").distinct().count()
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in plan or "isSkewJoin=true" in plan, plan[:4000]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_url_globs_match_brute_force(n):
    globs = ["*a*b?", "x*", "*", "", "?", "*.net\x01/en/*"]
    strings = [b"", b"a", b"xab", b"aabbc", b"q.net\x01/en/x", b"z" * 300][: n or None]
    import fnmatch

    got = url_rules.GlobSet(globs).match(strings)
    want = [[fnmatch.fnmatchcase(s.decode(), g) for g in globs] for s in strings]
    assert got.tolist() == want


def test_url_verdicts(spark):
    urls = [None, "", "no scheme", "http://Example.NET/en/x?q", "http://a.example.net", "http://xexample.net/en/", "ftp://a.org/fr/#x",
            "http://b.net:80/x", "HTTP://example.com/de/1", "http://" + "a" * 5000 + ".net/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.verdicts(df).collect()}
    assert got == {0: (None, "allow"), 1: (None, "allow"), 2: (None, "allow"), 3: ("example.net/en/", "allow"), 4: (None, "allow"),
                   5: ("net/", "block"), 6: ("org/fr/", "allow"), 7: (None, "allow"), 8: ("example.com/de/", "block"), 9: ("net/", "block")}


def test_packing(odd, empty):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    texts = Counter((r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids) + (1,)) for r in odd.collect())
    got = packing.packed(odd).collect()
    pieces = Counter()
    for (i, ids), n in texts.items():
        start = 0
        for length in packing.cuts(len(ids)):
            part = np.array(ids[start : start + length], "<u4").tobytes()
            pieces[(i, start, length, zlib.crc32(part), len(ids))] += n
            start += length
        assert start == len(ids)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == pieces
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.packed(empty).count() == 0


def test_packing_takes_the_special_token_as_tokenizers_does(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, end * 3, f" {end} \n{end}", f"{end[:-1]} |>{end}é", f"<|{end}|>", f"x {end.upper()} y", f"one two  {end}\t three"]
    assert t.encode(texts[0], add_special_tokens=False).ids == [64, 50256, 65]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = []
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        want.append((i, 0, len(ids), zlib.crc32(ids.tobytes()), len(ids)))
        assert list(packing.encoder().encode(text, allowed_special="all")) == ids[:-1].tolist()
    assert rows(packing.pieces(df), "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want


def test_packing_of_very_long_texts(spark):
    """Runs of blanks that the fast pattern gives up on, and other long runs."""
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    m = 2_000_000
    texts = ["a" + " " * m + "b", "x" + "\n" * m, " \t\n" * (m // 3) + "\u00e9", "\u00a0" * (m // 2) + "<|endoftext|>" + " " * m, "ab" * (m // 2), "word " * (m // 5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    with pytest.raises(ValueError):  # else the second way is not tried
        packing.encoder().encode(texts[0], allowed_special="all")
    want = []
    for i, text in enumerate(texts):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        start = 0
        for length in packing.cuts(len(ids)):
            want.append((i, start, length, zlib.crc32(ids[start : start + length].tobytes()), len(ids)))
            start += length
    got = packing.packed(df)
    assert rows(got, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == sorted(want, key=repr)


def test_cutting_stock_is_near_the_bound():
    rng = np.random.default_rng(1)
    histogram = {int(k) * 32: int(n) for k, n in zip(range(1, 64), rng.integers(1, 400, 63), strict=True)}
    slots = packing.plan(histogram)
    used = sum(s.times for s in {s.sequence: s for s in slots}.values())
    total = sum(k * n for k, n in histogram.items())
    sizes = np.arange(63, 0, -1)
    least = packing.column_generation(sizes, np.array([histogram[k * 32] for k in sizes], float), 64)[1].sum()
    assert total / 2048 <= least <= used <= least + 8  # the linear program bounds every packing from below
    for size, n in histogram.items():
        own = sorted((s.first, s.times * s.each) for s in slots if s.size == size)
        assert [f for f, _ in own] == list(np.cumsum([0] + [k for _, k in own])[:-1]) and sum(k for _, k in own) == n


def test_quality_measures_match_brute_force(odd):
    def brute(text):
        w = WORD.findall(text or "")
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {i + j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(8)}
        lines, seen, dup = (text or "").split("\n"), set(), 0
        for x in lines:
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)

    extra = ["a b c d e f g h a b c d e f g h", "x\nx\n\n \nx", "#é*ü$ %&|<>", "a " * 30]
    for text in [r.text for r in odd.collect()] + extra:
        assert tuple(quality.measure((text or "").encode())[0]) == brute(text)


def test_binomial_bound():
    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert quality.upper_bound(5, 5, 0.05) == 1.0
    from math import comb

    p = quality.upper_bound(3, 50, 0.01)
    assert sum(comb(50, i) * p**i * (1 - p) ** (50 - i) for i in range(4)) == pytest.approx(0.01, rel=1e-6)


def test_quality_controls_false_rejections(spark):
    rng = random.Random(2)
    rows_, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        w = ["w%d" % rng.randrange(3000) for _ in range(40)]
        rows_.append((i, " ".join(x + "%%%" if bad else x for x in w), "en" if i % 2 else None))
        labels.append((i, 0 if bad else 1))
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    out = quality.verdicts(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    good, bad = [r for r in out if r.doc_id % 5], [r for r in out if r.doc_id % 5 == 0]
    assert sum(not r.kept for r in good) <= 0.02 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)
    none = quality.verdicts(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert none.filter("kept = base_failed").count() == 0


def test_toxicity_finds_misspellings():
    rng = random.Random(1)
    plain = ["".join(rng.choice("aeiourstlnm") for _ in range(rng.randint(3, 9))).encode() for _ in range(800)]
    docs, toxic = [], []
    for i in range(400):
        d = set(rng.sample(plain, 30))
        if i % 4 == 0:
            d.add(rng.choice([b"zwickfool", b"zwickfoolish", b"zwickfools", b"kwackhead", b"kwackheads"]))
        docs.append(b" ".join(sorted(d)))
        toxic.append(i % 4 == 0)
    model = toxicity.SubwordSoftmax.train(docs, np.array(toxic))
    p = model.score([{b"zwickfoool"}, {b"kwackheaded"}, {plain[0]}, set()])
    assert min(p[:2]) > 0.5 > max(p[2:])


def test_toxicity_and_language_tables(odd, empty, spark):
    labels = spark.createDataFrame([(20, 1), (21, 0), (None, 1), (22, None)], "doc_id long, toxic int")
    for docs in (odd, empty):
        s = toxicity.scores(docs, labels).collect()
        assert len(s) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in s)
        p = langid.predictions(docs).collect()
        assert len(p) == docs.count() and all(0 <= r.score <= 1 for r in p)
    by_text = langid.predicted(odd, langid.fit(odd)).select("text", "__lang.lang_pred").collect()
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in by_text)


def test_training_rows_are_bounded_however_often_an_id_repeats(spark, monkeypatch):
    ids = spark.range(20).withColumnRenamed("id", "doc_id")
    docs = ids.crossJoin(spark.range(30)).select("doc_id", F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    labels = ids.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = []
    monkeypatch.setattr(toxicity.SubwordSoftmax, "train", classmethod(lambda cls, d, t: seen.append(len(d)) or cls(np.zeros(toxicity.BUCKETS), 0.0)))
    monkeypatch.setattr(langid.ByteCnn, "train", classmethod(lambda cls, w, lang, langs: seen.append(len(w))))
    toxicity.fit(docs, labels)
    langid.fit(docs)
    assert len(seen) == 2 and 0 < max(seen) <= 20


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predictions(docs).join(docs, "doc_id").filter("held_out")
    assert got.filter("lang_pred = lang").count() >= 0.9 * got.count()


def test_pseudonyms(odd, empty, spark):
    texts = ["pay 4111 1111 1111 1111 or 4111111111111111, not 4111111111111112", "on 2024-02-29, 31/12/1999, not 2023-02-30",
             "ip 10.0.0.1 and 300.1.1.1", "call +1 (248) 555-6359", "mail ab.c9@x.example.com", None, "", "x" * 100_000 + " 7"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in pseudonyms.pseudonymised(df, "k").collect()}
    cards = re.findall(r"\d[\d ]{14,}\d", out[0])
    assert cards[0].replace(" ", "") == cards[1] != "4111111111111111" and cards[2] == "4111111111111112"
    double = [int(c) for c in cards[1]]
    assert sum(double[1::2]) + sum(sum(divmod(2 * d, 10)) for d in double[::2]) and len(cards[0]) == 19
    assert "2023-02-30" in out[1] and "2024-02-29" not in out[1] and "300.1.1.1" in out[2] and "10.0.0.1" not in out[2]
    assert re.fullmatch(r"call \+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}", out[3]) and out[3] != texts[3]
    assert re.fullmatch(r"mail [a-z]{2}\.[a-z]\d@x\.example\.com", out[4])
    assert out[5] is None and out[6] == "" and out[7] == texts[7]
    days = spark.range(73049).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("t"))
    assert days.select(pseudonyms.pseudonym(F.col("t"), "k")["value"].alias("v")).distinct().count() == 73049
    assert pseudonyms.masked(odd).count() == odd.count() and pseudonyms.pseudonymised(empty).count() == 0


def test_pseudonyms_of_cards_next_to_other_digits(spark):
    plain, grouped, amex = "4111111111111111", "4111 1111 1111 1111", "3782 822463 10005"
    texts = [plain, grouped, f"{grouped} 12/27", f"{plain} 123", f"in 2024 {grouped}", f"{grouped} 5500 0000 0000 0004 12/27", amex,
             f"1 2 {amex} 1234 12/2027", f"{grouped} 2024-02-29", f"{grouped}-123-45-6789", f"{grouped} 123@x.example.com",
             f"{grouped} 10.0.0.1", "41111111 11111111 1227", "9" * 30, "1 " * 2_000, f"{'7 ' * 400}{grouped} 12", "4111 1111 1111 1112 12/27"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(df, "k").collect()}
    got = [out[i].text for i in range(len(texts))]
    card, first = got[0], got[1]
    four, fives = first.replace(" ", ""), got[6].replace(" ", "")
    assert four == card != plain and len(first) == 19 and fives != amex.replace(" ", "")
    assert got[2] == f"{first} 12/27" and got[3] == f"{card} 123" and got[4] == f"in 2024 {first}"
    assert re.fullmatch(rf"{first} \d{{4}} \d{{4}} \d{{4}} \d{{4}} 12/27", got[5]) and "5500 0000 0000 0004" not in got[5]
    assert got[7] == f"1 2 {got[6]} 1234 12/2027"
    assert got[8].startswith(first + " ") and "2024-02-29" not in got[8]
    assert got[9].startswith(first + "-") and "123-45-6789" not in got[9]
    assert re.fullmatch(rf"{first} \d{{3}}@x\.example\.com", got[10]) and got[11].startswith(first + " ") and "10.0.0.1" not in got[11]
    assert got[12] == f"{four[:8]} {four[8:]} 1227"
    assert got[13:15] == texts[13:15] and got[15] == f"{'7 ' * 400}{first} 12" and got[16] == texts[16]
    assert [out[i].n_card for i in (0, 2, 4, 5, 8, 13, 16)] == [1, 1, 1, 2, 1, 0, 1]


def test_mix(odd, empty, spark):
    got = mix.taken(odd).collect()
    assert len(got) == odd.count()
    assert sum(r.size for r in got) == sum(len(WORD.findall(r.text or "")) for r in odd.collect())
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    targets = {(r.source_size, r.target) for r in got}
    assert all(t <= 2 * s + 1e-9 for s, t in targets)
    again = mix.taken(odd.repartition(7))
    assert rows(again, "doc_id", "size", "taken") == rows(mix.taken(odd), "doc_id", "size", "taken")
    assert mix.mixed(odd).columns == odd.columns
    assert mix.taken(empty).count() == 0 and mix.mixed(empty).count() == 0
    big = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 97 as int))").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
    )
    sums = mix.taken(big).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r.t - r.target) <= 0.02 * r.target + 97 for r in sums)
    total = sum(r.source_size for r in sums)
    assert sum(r.target for r in sums) == pytest.approx(1.5 * total)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("<p>a<p>b", "a\n\nb"), ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c"),
        ("<table><tr><th>Name<th>n<tr><td>pie<td>2</table>", "Name  n\npie   2"), ("<div hidden>x</div>y", "y"),
        ("<p style='display: none'>x</p>y<script>'</p>'</script>", "y"), ("a &lt; b<br>c", "a < b\nc"),
        ("<pre> x\n  y</pre>", " x\n  y"), ("1 < 2 <", "1 < 2 <"), ("<details><summary>s</summary>x</details>", "s"),
    ],
)
def test_html(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<head><title>T</title><body>Hello <p>x", "Hello\n\nx"), ("<head><title>T</title>Hello", "Hello"),
        ("<html><head>\n<meta charset=utf-8>\n<title>T</title>\n<body class=a>Hello <b>you</b>", "Hello you"),
        ("<head><style>p {}</style><script>1</script></head>Hello", "Hello"), ("<head><title>T</title>", ""),
        ("<svg><title>t</title><defs/><path d='a/'/>\n<text>North</text><text>South</text>q</svg>!", "North South !"),
        ("<svg><style/><desc><p>d</p></desc><g><text>a <tspan>b</tspan></text></g></svg>c", "a b c"),
        ("<svg/>a<svg><foreignObject><p>b</foreignObject></svg>c", "a\n\nb\n\nc"), ("<svg><path d=a><p>Hello", "Hello"),
        ("<math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></semantics></math> y", "x=2 y"),
        ("<a href=b/>c</a><div/>d", "c\nd"),
    ],
)
def test_html_open_head_and_drawings(page, text):
    assert html_text.render(page) == text


@pytest.mark.parametrize("page", ["<div>" * 30000 + "x", '<a href="' * 5000, "<" * 20000, "</td></tr></table>x", "<b></i>" * 20000])
def test_html_broken_pages_end(page):
    html_text.render(page)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<table><tr><td rowspan=2>a<td>bb<tr><td>c<tr><td>d<td>e</table>", "a  bb\n   c\nd  e"),
        ("<table><tr><td>a<td rowspan=3 colspan=2>b<td>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h<td>i</table>",
         "a  b    c\nd       e\nf       g\nh  i"),
        ("<table><tbody><tr><td rowspan=0>a<td>b<tr><td>c<tbody><tr><td>d<td>e</table>", "a  b\n   c\nd  e"),
        ("<table><tr><td rowspan=x>a<td>b<tr><td rowspan=-1>c<td>d</table>", "a  b\nc  d"),
        ("<p style='visibility:hidden'>a <b style='visibility: visible'>b</b> c</p>d", "b\n\nd"),
        ("<p style='display:none'>a <b style='visibility:visible'>b</b></p>d", "d"),
        ("<p style='visibility:hidden;visibility:VISIBLE'>a</p><p style='backface-visibility:hidden'>b</p>", "a\n\nb"),
        ("<ul><li style='visibility:hidden'>a<li>b</ul>", "- b"),
        ("<table><tr style='visibility:collapse'><td>a<tr><td>b</table>", "b"),
    ],
)
def test_html_spans_and_visibility(page, text):
    assert html_text.render(page) == text


def test_html_wide_tables_keep_all_cells():
    page = "<table><tr>" + "<td rowspan=65534>x" * 2000 + "".join(f"<tr><td>y{i}" for i in range(3000))
    text = html_text.render(page)
    assert text.count("x") == 2000 and re.findall(r"y\d+", text) == [f"y{i}" for i in range(3000)]
    assert len(text) < 64 * len(page)


def test_html_without_rows(spark):
    assert html_text.extracted(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_html_table(spark):
    df = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (3, "<p>a b", "u")], "page_id long, html string, text string")
    assert rows(html_text.extracted(df), "page_id", "text", "n_lines", "n_words") == [(1, None, 0, 0), (2, "", 0, 0), (3, "a b", 1, 2)]
    assert html_text.rendered(df).columns == ["page_id", "html", "text", "__html"]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(registry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert rows(registry.queries()[name](spark, SF), *cols) == sorted(want.fetchall(), key=repr)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns and out.exceptAll(kept).count() == 0
        kept = out
    texts = [r.text for r in kept.collect()]
    assert len(texts) == len(set(texts))
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert pieces.join(kept, "doc_id", "left_anti").count() == 0
