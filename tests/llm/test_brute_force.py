"""Toxicity, language ID, pseudonyms and the pipeline's stages against plain loops."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from roomrate.llm import langid, mix, packing, pseudonyms, toxicity

SF = "/root/testdata/sf0.001"


def test_word_logits_match_a_loop_over_ngrams():
    rng = np.random.default_rng(3)
    model = toxicity.SubwordSoftmax(rng.normal(0, 1, toxicity.BUCKETS), -2.0, 1.5, 0.25)
    words = [b"a", b"abc", "größe".encode(), b"hello", b"x" * 400, "日本語".encode()]

    def logit(word):
        chars, votes = [ord(c) for c in f"<{word.decode()}>"], []
        for n in (3, 4, 5):
            for i in range(len(chars) - n + 1):
                h = 0
                for c in chars[i : i + n]:
                    h = (h * 0x100000001B3 + c) % 2**64
                x = ((h ^ (h >> 31)) * 0x9E3779B97F4A7C15 + n) % 2**64
                votes.append(float(model.votes[(x >> 40) % toxicity.BUCKETS]))
        return sum(votes) / len(votes) - 2.0

    want = [logit(w) for w in words]
    assert model.logits(words) == pytest.approx(want, abs=1e-6)
    got = model.score([set(words), {b"abc", b"hello"}, set()], step=1)
    top = [max(want), max(want[1], want[3]), -2.0]
    assert got == pytest.approx([1 / (1 + math.exp(-(1.5 * z + 0.25))) for z in top], abs=1e-6)


def test_language_scores_match_direct_convolution(spark):
    rng = np.random.default_rng(4)
    tables = [rng.normal(0, 0.3, (k, 256, langid.FILTERS)).astype(np.float32) for k in langid.WIDTHS]
    head = rng.normal(0, 1, (len(langid.WIDTHS) * langid.FILTERS + 1, 3)).astype(np.float32)
    net = langid.ByteCnn(tables, head, ["a", "b", "c"])
    texts = ["short", "word " * 60, "é日本 " * 200, "x" * langid.WINDOW, "12 34", None, ""]

    def log_probabilities(window):
        pooled = []
        for t in tables:
            for f in range(langid.FILTERS):
                places = range(langid.WINDOW - len(t) + 1)
                pooled.append(max(0.0, max(sum(float(t[j, window[p + j], f]) for j in range(len(t))) for p in places)))
        z = np.array([*pooled, 1.0]) @ head.astype(float)
        return z - np.log(np.exp(z).sum())

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r["__lang"] for r in langid.predicted(df, net).collect()}
    for i, text in enumerate(texts):
        if not any(map(str.isalpha, text or "")):
            assert (got[i].lang_pred, got[i].score) == ("und", 0)
            continue
        raw, total = text.encode(), np.zeros(3)
        for at in range(0, len(raw), langid.WINDOW):
            piece = raw[at : at + langid.WINDOW]
            total += log_probabilities(piece.ljust(langid.WINDOW, b"\0")) * len(piece)
        p = np.exp(total / len(raw))
        p /= p.sum()
        assert got[i].lang_pred == "abc"[p.argmax()] and got[i].score == pytest.approx(p.max(), abs=1e-4)


def test_language_sample_is_the_smallest_hashes_of_each_language(spark):
    ids = spark.range(30_000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 7)).alias("lang"))
    want = defaultdict(list)
    for r in ids.withColumn("h", F.xxhash64("id")).collect():
        want[r.lang].append((r.h, r.id))
    got = defaultdict(set)
    for r in langid._smallest(ids, 50).collect():
        got[r.lang].add(r.id)
    assert got == {k: {i for _, i in sorted(v)[:50]} for k, v in want.items()}
    assert langid._smallest(ids.limit(0), 50).count() == 0


def test_more_languages_than_the_softmax_takes_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGS", 3)
    df = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"), (F.col("id") % 5).alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        langid.fit(df)


def _prf(key, kind, i, half):
    return int(hashlib.sha256(f"{key}|{kind}|{i}|{half}".encode()).hexdigest()[:15], 16)


def _network(key, kind, a, b, size_a, size_b):
    for i in range(1, pseudonyms.ROUNDS + 1):
        if i % 2:
            a = (a + _prf(key, kind, i, b)) % size_a
        else:
            b = (b + _prf(key, kind, i, a)) % size_b
    return a, b


def _luhn(digits):
    double = [int(c) * (1 + (len(digits) - 1 - i) % 2) for i, c in enumerate(digits)]
    return sum(d - 9 if d > 9 else d for d in double) % 10


def _masked_card(key, text):
    payload = re.sub(r"\D", "", text)[:-1]
    u = len(payload) // 2
    a, b = _network(key, "card", int(payload[:u]), int(payload[u:]), 10**u, 10 ** (len(payload) - u))
    image = str(a).zfill(u) + str(b).zfill(len(payload) - u)
    digits = iter(image + str((10 - _luhn(image + "0")) % 10))
    return "".join(next(digits) if c.isdigit() else c for c in text)


def _masked_run(key, run):
    groups, found = run.split(" "), []
    for at in range(len(groups)):
        for n in range(1, 20):
            part = groups[at : at + n]
            digits = "".join(part)
            if len(part) < n or not 13 <= len(digits) <= 19 or _luhn(digits):
                continue
            laid_out = n == 1 or "-".join(str(len(g)) for g in part) in pseudonyms._LAYOUTS
            network = re.search(pseudonyms._NETWORK, digits)
            rank = 1 if laid_out and network else 2 if laid_out else 3 if n == len(groups) else 4 if network else None
            if rank:
                found.append((rank, at, n))
    taken = []
    for _, at, n in sorted(found):
        if all(at + n <= x or x + m <= at for x, m in taken):
            taken.append((at, n))
    for at, n in taken:
        groups[at : at + n] = _masked_card(key, " ".join(groups[at : at + n])).split(" ")
    return " ".join(groups), len(taken)


def test_cards_in_runs_match_a_loop_over_all_windows(spark):
    rng = random.Random(2)

    def valid(prefix, size):
        body = prefix + "".join(rng.choice("0123456789") for _ in range(size - len(prefix) - 1))
        return body + str((10 - _luhn(body + "0")) % 10)

    def cut(digits, layout):
        at = [sum(layout[:k]) for k in range(len(layout) + 1)]
        return [digits[i:j] for i, j in zip(at, at[1:], strict=False)]

    runs = []
    for _ in range(120):
        groups = []
        for _ in range(rng.randint(1, 8)):
            kind = rng.randrange(5)
            if kind == 0:
                groups += cut(valid(rng.choice(["4", "51", "9"]), 16), [4, 4, 4, 4])
            elif kind == 1:
                groups += cut(valid("37", 15), [4, 6, 5])
            elif kind == 2:
                groups += cut(valid("4", 16), rng.choice([[1, 15], [5, 11], [2, 7, 7], [16]]))
            else:
                groups += ["".join(rng.choice("0123456789") for _ in range(rng.choice([1, 2, 4, 4, 5, 13, 20]))) for _ in range(rng.randint(1, 5))]
        if len("".join(groups)) >= 13:
            runs.append(" ".join(groups))
    df = spark.createDataFrame(list(enumerate(runs)), "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymised(df, "k").collect()}
    several = 0
    for i, run in enumerate(runs):
        text, n = _masked_run("k", run)
        several += n > 1
        assert got[i].text == text, run
    assert several > 20


def test_dates_and_social_security_numbers_match_the_network(spark):
    import datetime as dt

    first = dt.date(1900, 1, 1)
    days = [first + dt.timedelta(d) for d in range(0, 73049, 997)]
    numbers = ["001-01-0001", "899-99-9999", "665-12-3456", "667-12-3456", "123-45-6789"]
    stay = ["000-12-3456", "666-12-3456", "900-12-3456", "123-00-4567", "123-45-0000"]
    texts = [d.isoformat() for d in days] + numbers + stay
    got = [r.text for r in pseudonyms.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k").orderBy("doc_id").collect()]

    def date(d):
        n = (d - first).days
        a, b = _network("k", "date", n % 319, n // 319, 319, 229)
        return (first + dt.timedelta(b * 319 + a)).isoformat()

    areas = [x for x in range(1, 900) if x != 666]

    def number(s):
        area, group, serial = map(int, s.split("-"))
        a, b = _network("k", "ssn", areas.index(area) * 99 + group - 1, serial - 1, 898 * 99, 9999)
        return f"{areas[a // 99]:03d}-{a % 99 + 1:02d}-{b + 1:04d}"

    assert got == [date(d) for d in days] + [number(s) for s in numbers] + stay


def test_many_cards_in_one_run_and_clashing_columns(spark):
    card = "4111 1111 1111 1111"
    df = spark.createDataFrame([(1, card, "f", "p"), (2, " ".join([card] * 16_000), "f", "p")], "doc_id long, text string, __found string, `__PARTS` string")
    start = time.monotonic()
    out = {r.doc_id: r for r in pseudonyms.masked(df, key="k").collect()}
    took = time.monotonic() - start
    assert out[2]["__pii"].text == " ".join([out[1]["__pii"].text] * 16_000) and len(out[2]["__pii"].found) == 16_000
    assert out[1]["__found"] == "f" and out[1]["__PARTS"] == "p"
    assert took < 60


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage, with exact and near copies planted into the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    top = docs.agg(F.max("doc_id")).first()[0]
    some = docs.filter(F.length("text") > 600).orderBy("doc_id").limit(30)
    exact = some.withColumn("doc_id", F.col("doc_id") + top + 1)
    near = some.withColumn("doc_id", F.col("doc_id") + 2 * top + 2).withColumn("text", F.concat("text", F.lit(" one more line")))
    held = [docs.unionByName(exact).unionByName(near)]
    for _, stage in corpus_pipeline.STAGES:
        held.append(stage(spark, held[-1], SF).cache())
    return held


def test_stage_toxicity(stages, spark):
    before, after = stages[0], stages[1]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    y = {r.doc_id: r.toxic for r in before.select("doc_id").join(labels.select("doc_id", "toxic"), "doc_id").collect()}
    bad, good = [i for i, t in y.items() if t == 1], [i for i, t in y.items() if t == 0]
    assert bad and sum(i not in kept for i in bad) >= 0.9 * len(bad)
    assert sum(i in kept for i in good) >= 0.95 * len(good)  # some hundred labelled rows to learn from
    scores = toxicity.scores(before, labels).filter("predicted = 0").select("doc_id").collect()
    assert sorted(r.doc_id for r in scores) == sorted(kept)


def test_stage_exact_dedup(stages):
    best = {}
    for r in stages[1].collect():
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in stages[2].collect()) == sorted(best.values())
    assert stages[2].count() < stages[1].count()


def test_stage_ngram_join(stages):
    rows = {r.doc_id: (r.text or "").encode().lower().split() for r in stages[2].collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for i, w in rows.items()}
    part, holds = {i: i for i in sets}, defaultdict(list)

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in sorted(sets):
        meets = Counter(j for s in sets[i] for j in holds[s])
        for j, n in meets.items():
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                part[b] = a
        for s in sets[i]:
            holds[s].append(i)
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(i for i in sets if root(i) == i)
    assert stages[3].count() < stages[2].count()


def test_stage_mix(stages):
    copies = Counter(r.doc_id for r in stages[4].collect())
    taken = mix.taken(stages[3]).collect()
    assert all(copies[r.doc_id] * r.size == r.taken for r in taken)
    ids = {r.doc_id: r.source for r in stages[3].select("doc_id", "source").collect()}
    size = {r.doc_id: r.size for r in taken}
    total = sum(size.values())
    words = Counter()
    for i, n in copies.items():
        words[ids[i]] += n * size[i]
    goal = {ids[r.doc_id]: r.target for r in taken}
    assert sum(goal.values()) == pytest.approx(1.5 * total)
    assert all(abs(words[s] - t) <= 0.02 * t + 2 * max(size.values()) for s, t in goal.items())


def test_stage_packing(stages):
    tok = tokenizers.Tokenizer.from_file(packing.WHOLE_TOKENIZER)
    docs = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [1] for r in stages[3].collect()}
    copies = Counter(r.doc_id for r in stages[4].collect())
    cover, places = defaultdict(Counter), defaultdict(list)
    for p in stages[5].collect():
        ids = docs[p.doc_id][p.start : p.start + p.length]
        assert len(ids) == p.length and p.doc_tokens == len(docs[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        cover[p.doc_id].update(range(p.start, p.start + p.length))
        places[p.sequence_id].append((p.offset, p.length))
    assert cover == {i: Counter(dict.fromkeys(range(len(docs[i])), n)) for i, n in copies.items()}
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert sorted(places) == list(range(len(places)))
