"""MinHash near-dedup, vector codes and whitening against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from harness import compare, duck
from roomrate.llm import minhash_dedup, registry, vector_codes, whitening

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAN, INF = float("nan"), float("inf")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


# near-dedup


def shingle_set(text, n=3):
    w = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return {tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))} if w else set()


def brute(docs, n=3, percent=85):
    """(id, set size, component, kept) by comparing all pairs."""
    d = [(i, shingle_set(t, n)) for i, t in docs]
    part = list(range(len(d)))
    for i in range(len(d)):
        for j in range(i):
            both = len(d[i][1] & d[j][1])
            if both and 100 * both >= percent * len(d[i][1] | d[j][1]):
                a, b = part[i], part[j]
                part = [a if p == b else p for p in part]
    low = {}
    for (k, _), p in zip(d, part, strict=True):
        if k is not None:
            low[p] = min(low.get(p, k), k)
    found = [low.get(p) for p in part]
    return sorted(((k, len(s), c, k == c) for (k, s), c in zip(d, found, strict=True)), key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(17)
    vocabulary = ["w%d" % i for i in range(400)]
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (5, "ONE"), (None, "a b c d"), (6, "a b c d"), (None, None), (7, "É\x1f  x")]
    out += [(8, "long " * 3000), (9, " ".join(rng.choice(vocabulary) for _ in range(30_000)))]
    k = 100
    for _ in range(12):  # families of near copies, some apart from each other
        base = [rng.choice(vocabulary) for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(rng.choice([2, 5, 14])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            out.append((k, " ".join(w)))
            k += 1
    out += [(k, "same text again"), (k + 1, "same text again"), (k + 1, "Same Text again")]
    return out


def test_near_dedup(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in texts], "doc_id long, text string, node string, n long").repartition(4)
    want = brute(texts)
    assert rows(minhash_dedup.groups(df), "doc_id", "n_shingles", "component_id", "kept") == want
    assert 30 < len({c for _, _, c, _ in want}) < len(want)
    kept = minhash_dedup.grouped(df)
    assert kept.columns == ["doc_id", "node", "n", *[f"__near_{c}" for c in ("n_shingles", "component_id", "kept", "root")]]
    assert set(rows(kept, "node", "n")) == {("x", 1)}
    assert minhash_dedup.groups(df.limit(0)).collect() == []


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_dedup_of_variants_that_do_not_link(spark, monkeypatch, words, percent):
    """A ball of variants around a text that is not there: bags, blocks and counted overlaps."""
    rng = random.Random(23)
    base = ["b%d" % i for i in range(120)]
    texts = []
    for i in range(170):
        w = list(base)
        for j in rng.sample(range(120), rng.choice([1, 2, 2, 3, 3, 4])):
            w[j] = f"x{i}_{j}" if rng.random() < 0.6 else f"y{j}"
        texts.append((i, " ".join(w)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(minhash_dedup, "BLOCK_SETS", 40)
    want = brute(texts, words, percent)
    got = minhash_dedup.grouped(df, words=words, percent=percent)
    assert rows(got, "doc_id", "__near_n_shingles", "__near_component_id", "__near_kept") == want
    assert 1 < len({c for _, _, c, _ in want}) < 170


def test_near_dedup_of_a_table_matches_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = registry.queries()["op11_minhash_dedup"](spark, SF)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == brute([tuple(r) for r in docs.collect()])


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    a, b = pool[:2000], pool[300:2300]  # 1700 of 2300 shared
    s = minhash_dedup.signatures([np.sort(a), np.zeros(0, np.uint64), np.sort(b)])
    x, y = minhash_dedup.hash_functions()
    folded = (int(v) for v in (a ^ (a >> np.uint64(32))) & np.uint64(0xFFFFFFFF))
    first = min(((int(x[0]) * v + int(y[0])) % (1 << 64)) >> 32 for v in folded)
    assert int(s[0, 0]) == first and (s[1] == 0xFFFFFFFF).all()
    assert abs((s[0] == s[2]).mean() - 1700 / 2300) < 0.15
    assert minhash_dedup.band_rows(85) == 4 and 60 < minhash_dedup.least_agreement(85) < 100


def test_star_edges(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    part = {x: x for p in pairs for x in p}
    for a, b in pairs * 60:
        part[a] = part[b] = min(part[a], part[b])
    name = lambda x: b"%05d" % x
    df = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in pairs], "u binary, v binary")
    got = {bytes(r.u): bytes(r.v) for r in minhash_dedup.star_edges(df, "t").collect()}
    assert got == {name(x): name(r) for x, r in part.items() if x != r}


# vector codes


def plain_codes(table):
    """Codes by comparing every part with every entry."""
    kept = [(i, np.floor(np.array(v, float) * 4096).astype(int), label) for i, v, label in table if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1].tolist()))
    x = np.array([v for _, v, _ in kept]).reshape(len(kept), 8, -1)
    books = x[:16].transpose(1, 0, 2).copy()

    def nearest():
        far = ((x[:, :, None, :] - books[None]) ** 2).sum(-1)
        return far.argmin(-1), far.min(-1)

    for _ in range(6):
        best, _ = nearest()
        for p in range(8):
            for e in range(books.shape[1]):
                own = x[best[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    best, far = nearest()
    per_label = defaultdict(int)
    for (_, _, label), f in zip(kept, far.sum(1), strict=True):
        per_label[label] += int(f)
    sha = hashlib.sha256(",".join(map(str, books.ravel())).encode()).hexdigest()
    return sorted(
        ((i, "".join("%02x" % e for e in b), int(f), per_label[label], sha) for (i, _, label), b, f in zip(kept, best, far.sum(1), strict=True)), key=repr
    )


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    out = [(i, np.round(rng.normal(size=16) * 0.2, 2).tolist(), [None, 1, 2][i % 3]) for i in range(120)]
    out += [(200 + i, out[3][1], 2) for i in range(40)] + [(5, out[5][1], 1), (None, out[7][1], None)]  # copies and repeated rows
    out += [(300, None, 1), (301, [0.1] * 15 + [None], 1), (302, [0.1] * 15 + [NAN], 1), (303, [0.1] * 15 + [-INF], None), (304, [0.0] * 16, 1)]
    return out


def test_vector_codes(spark, vectors):
    cols = "vec_id long, embedding array<float>, label int"
    columns = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    as_float = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], label) for i, v, label in vectors]
    df = spark.createDataFrame(vectors, cols).repartition(3)
    assert rows(vector_codes.codes(df), *columns) == plain_codes(as_float)
    few = df.filter("vec_id < 5")  # fewer rows than entries; repeated rows
    assert rows(vector_codes.codes(few), *columns) == plain_codes([r for r in as_float if r[0] is not None and r[0] < 5])
    assert vector_codes.codes(df.limit(0)).collect() == []
    odd = df.selectExpr("vec_id", "embedding", "label", "'a' as row", "1 as s", "2 as error", "3 as v")
    got = vector_codes.coded(odd)
    assert got.columns[:7] == odd.columns and set(rows(got, "row", "s", "error", "v")) == {("a", 1, 2, 3)}
    with pytest.raises(Exception, match="components"):
        vector_codes.codes(spark.createDataFrame([(1, [0.1] * 8, 1), (2, [0.1] * 16, 1)], cols)).collect()
    with pytest.raises(Exception, match="reaches"):
        vector_codes.codes(spark.createDataFrame([(1, [1e30] * 8, 1)], cols)).collect()


def test_vector_codes_match_sql(spark):
    res = compare(registry.queries()["op12_vector_codes"](spark, SF), duck(SF), registry.oracle_sql()["op12_vector_codes"])
    assert res["ok"] and res["spark_rows"] == 500, res


@pytest.mark.parametrize("run", [3, 4096])
def test_trie_walk_equals_direct_distances(monkeypatch, run):
    monkeypatch.setattr(vector_codes, "RUN", run)
    rng = np.random.default_rng(6)
    for n, width, high in ((1, 8, 5), (900, 8, 2), (700, 3, 40), (500, 1, 300)):
        parts = np.unique(rng.integers(-high, high + 1, (n, width)), axis=0)
        entries = rng.integers(-high, high, (16, width))
        far = ((parts[:, None] - entries[None]) ** 2).sum(-1)
        best, error = vector_codes.assign(parts, entries)
        assert (best == far.argmin(1)).all() and (error == far.min(1)).all()
        found = vector_codes.keys(parts, 3)
        assert found == sorted(found)


# whitening


def plain_whitening(table):
    x = np.array([np.floor(np.array(v, float) * 256) for _, v in table])
    f = np.unique(x, axis=0)
    n, s = len(f), f.sum(0)
    v = (f - s / n).T @ (f - s / n) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ vectors[:, :4] / np.sqrt(values[:4]), values[:4] / values.sum()


def test_whitening(spark, vectors):
    table = [(i, v) for i, v, _ in vectors]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").repartition(3)
    kept = [(i, v) for i, v in table if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, deviation, z, explained = plain_whitening(kept)
    got = whitening.components(df).collect()
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    for c in range(4):
        own = sorted(((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in got if r.component == c + 1))
        plain = sorted((i is None, i or 0, int(d), w) for (i, _), d, w in zip(kept, deviation, z[:, c], strict=True))
        assert [o[:3] for o in own] == [p[:3] for p in plain]
        a, b = np.array([o[3] for o in own]), np.array([p[3] for p in plain])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
        assert [r.explained for r in got if r.component == c + 1] == pytest.approx([explained[c]] * len(kept), rel=1e-9)
    assert whitening.components(df.limit(0)).collect() == []
    odd = df.selectExpr("vec_id", "embedding", "'a' as row", "1 as s", "2 as component", "3 as v")
    out = whitening.whitened(odd, k=2)
    assert out.columns[:6] == odd.columns and set(rows(out, "row", "s", "component", "v")) == {("a", 1, 2, 3)}


def test_whitening_of_one_vector_and_of_low_rank(spark):
    one = whitening.components(spark.createDataFrame([(1, [0.5, 1.5]), (2, [0.5, 1.5])], "vec_id long, embedding array<double>")).collect()
    assert [(r.n, r.component, r.deviation, r.whitened, r.identity_error) for r in sorted(one)] == [(1, 1, 0, None, None), (1, 2, 0, None, None)] * 2
    line = spark.createDataFrame([(i, [i / 256.0, i / 128.0, 0.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.components(line).collect()
    assert {r.component for r in got if r.whitened is not None} == {1} and {r.explained for r in got} == {1.0, 0.0}
    assert max(r.identity_error for r in got) < 1e-9


def test_moments_do_not_depend_on_partitions_and_are_exact(spark):
    rng = random.Random(9)
    data = [[rng.randrange(-(1 << 40), 1 << 40) for _ in range(3)] for _ in range(50)]
    df = spark.createDataFrame([(v,) for v in data], "x array<long>")
    found = [whitening.moments(df.repartition(k), 3) for k in (1, 7)]
    n, s = len(data), [sum(c) for c in zip(*data, strict=True)]
    want = [[sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in data) // n for j in range(3)] for i in range(3)]
    for m in found:
        assert m[:2] == (n, s) and m[2].tolist() == want


@pytest.mark.parametrize(
    "values",
    [np.linspace(1, 40, 40), np.r_[10, 10 - 1e-9, 10 - 1e-12, np.linspace(1, 2, 30)], np.r_[7, 7, 7, np.linspace(1, 2, 20)], np.ones(9), np.r_[5, np.zeros(7)]],
)
def test_refinement_of_clustered_eigenvalues(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(len(q), dtype=q.dtype) - 0.5 * (q.T @ q))
    a = (q * values.astype(np.longdouble)) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1]
    value, x = whitening.refined(a, start)
    assert np.abs(np.sort(value) - np.sort(values)).max() < 1e-16 * values.max()
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 4e-15
    assert np.abs(a @ x - x * value).max() < 1e-17 * values.max() * len(x)
