"""Quality rules with risk-controlled thresholds (operator 4).

Every rule compares one ratio of a document with a cutoff. Labelled documents are split in
two halves by a hash of the id. The first half proposes, per stratum (language), a short
sequence of rule sets from lenient to strict: set k puts each cutoff where at most
``PROPOSALS[k]`` of the good documents of the half are rejected by that rule. The second
half, the holdout, tests each set as a whole: its false rejection rate among good documents
has an exact (Clopper-Pearson) upper bound at level ``DELTA`` over the number of tests
(Bonferroni over strata and sets). Of the sets whose bound is at most ``ALPHA``, the one
that rejects the most bad holdout documents is used; a stratum without such a set rejects
nothing by rule.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts, with_struct, written

ALPHA, DELTA = 0.02, 0.05
PROPOSALS = (0.0, 0.0005, 0.001, 0.002, 0.005)
#: Ratios are binned for the proposals; a cutoff is a bin edge.
BINS = 400
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: name: (largest value of the bins, True if high values are bad)
RULES = {
    "symbols": (1.0, True), "shouts": (2.0, True), "capitals": (1.0, True), "dup_lines": (1.0, True),
    "repeats": (1.0, True), "no_letters": (1.0, True), "top_word": (1.0, True), "long_words": (40.0, True),
    "short_words": (40.0, False),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[bytes]) -> int:
    """Words inside 8-word windows that occur at least twice in ``words``."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    w = np.zeros(n, np.uint64)
    for j in range(WINDOW):
        w = w * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    order = np.argsort(w, kind="stable")
    same = w[order[1:]] == w[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: bytes) -> tuple[list[int], list[float]]:
    """(base counts, ratio of each rule) of a text."""
    words = text.split()
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)  # every figure by character, in one pass
    chars = int(len(text) - seen[0x80:0xC0].sum() - seen[9:14].sum() - seen[32])
    symbols = int(seen[list(SYMBOLS)].sum())
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeats = repeated_words(words)
    n, c = max(len(words), 1), max(chars, 1)
    upper = int(seen[65:91].sum())
    letters = int(upper + seen[97:123].sum() + seen[0xC0:].sum())  # a character beyond ASCII counts as a letter
    top = 0
    if words:
        counts: dict[bytes, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        top = max(counts.values()) if len(words) >= 20 else 0
    ratios = [
        symbols / c, int(seen[33]) / n, upper / max(letters, 1), dup / max(len(lines), 1), repeats / n,
        1 - letters / c, top / n, chars / n, chars / n,
    ]
    return [len(words), chars, symbols, dup, repeats], ratios


def _batch(b: pa.Array) -> pa.Array:
    rows = [measure(t) for t in texts(b)]
    base = [pa.array([r[0][i] for r in rows], pa.int64()) for i in range(len(BASE))]
    ratios = [pa.array([r[1][i] for r in rows], pa.float64()) for i in range(len(RULES))]
    return pa.StructArray.from_arrays([*base, *ratios], [*BASE, *RULES])


def measured(docs: DataFrame, text_col: str = "text", name: str = "__q") -> DataFrame:
    """Every row plus struct ``name``: the base counts and the ratio of each rule."""
    returns = "struct<" + ", ".join([f"{b}: long" for b in BASE] + [f"{r}: double" for r in RULES]) + ">"
    return with_struct(docs, name, F.col(f"`{text_col}`"), returns, _batch)


def upper_bound(k: int, n: int, level: float) -> float:
    """Clopper-Pearson: the largest rate at which k or fewer of n still has probability ``level``."""
    if k >= n:
        return 1.0

    def at_most(p: float) -> float:
        lp, lq = math.log(p), math.log1p(-p)
        logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * lp + (n - i) * lq for i in range(k + 1)]
        m = max(logs)
        return math.exp(m) * sum(math.exp(x - m) for x in logs)

    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if 0 < mid < 1 and at_most(mid) > level else (low, mid)
    return high


def _bin(name: str, value: Column) -> Column:
    """Bin of a ratio, larger is worse; the last bin is open."""
    top, high = RULES[name]
    b = F.least(F.greatest(F.floor(value / F.lit(top / BINS)), F.lit(0)), F.lit(BINS - 1)).cast("int")
    return b if high else F.lit(BINS - 1) - b


def thresholds(measures: DataFrame, labels: DataFrame) -> dict[str, list[int]]:
    """Per stratum the bin from which each rule rejects (``BINS``: never).

    ``measures``: id, stratum and the ratios, one row per document. Only counts per stratum,
    rule and bin reach the driver.
    """
    y = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("id"))
    known = measures.join(y.agg(F.min("quality").alias("quality")), "id")
    known = known.withColumn("half", F.crc32(F.concat(F.lit("half"), F.col("id").cast("string")).cast("binary")) % 2)
    known = known.select("stratum", "quality", "half", *[_bin(r, F.col(r)).alias(r) for r in RULES])
    bins = F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), F.col(r).alias("bin")) for i, r in enumerate(RULES)]))
    fit = known.filter((F.col("half") == 0) & (F.col("quality") == 1)).select("stratum", bins.alias("x"))
    counts = fit.groupBy("stratum", "x.rule", "x.bin").count().collect()
    strata = sorted({r["stratum"] for r in counts})
    if not strata:
        return {}
    table = np.zeros((len(strata), len(RULES), BINS), np.int64)
    for r in counts:
        table[strata.index(r["stratum"]), r["rule"], r["bin"]] = r["count"]
    tail = table[:, :, ::-1].cumsum(axis=2)[:, :, ::-1]  # good documents in this bin or worse ones
    sets = {}
    for i, s in enumerate(strata):
        allowed = [int(q * tail[i, 0, 0]) for q in PROPOSALS]
        # one spare bin: a cutoff at the very edge of the good documents would reject the next one
        sets[s] = [[min(BINS, int((tail[i, r] > a).sum()) + 1) for r in range(len(RULES))] for a in allowed]
    cuts = F.create_map(*[x for s in strata for x in (F.lit(s), F.array(*[F.array(*map(F.lit, c)) for c in sets[s]]))])
    own = F.try_element_at(cuts, F.col("stratum"))
    hit = [
        F.sum(F.when(F.greatest(*[F.col(r) >= own[k][i] for i, r in enumerate(RULES)]), 1).otherwise(0)).alias(f"k{k}")
        for k in range(len(PROPOSALS))
    ]
    held = known.filter((F.col("half") == 1) & F.col("stratum").isin(strata))
    tests = held.groupBy("stratum", "quality").agg(F.count("*").alias("n"), *hit).collect()
    got = {(r["stratum"], r["quality"]): r for r in tests}
    level = DELTA / (len(strata) * len(PROPOSALS))
    chosen = {}
    for s in strata:
        good, bad = got.get((s, 1)), got.get((s, 0))
        passed = [k for k in range(len(PROPOSALS)) if good and upper_bound(good[f"k{k}"], good["n"], level) <= ALPHA]
        if passed:
            best = max(passed, key=lambda k: (bad[f"k{k}"] if bad else 0, -k))
            chosen[s] = sets[s][best]
    return chosen


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept.

    Null text is empty text: all counts 0, so it fails the base rule. A null language is a
    stratum of its own; a null id has no label. Rows are judged one by one, repeated rows
    alike.
    """
    stratum = F.coalesce(F.concat(F.lit("s"), F.col("lang").cast("string")), F.lit("-"))
    m = measured(docs.select("doc_id", "text", stratum.alias("stratum")))
    m = written(m.select(F.col("doc_id").alias("id"), "stratum", "__q.*"), "quality")
    cuts = thresholds(m, labels)
    rejects = F.lit(False)
    for s, edges in cuts.items():
        worse = F.greatest(*[_bin(r, F.col(r)) >= e for r, e in zip(RULES, edges, strict=True)])
        rejects = F.when(F.col("stratum") == s, worse).otherwise(rejects)
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return m.select(F.col("id").alias("doc_id"), *BASE, failed.alias("base_failed"), (~failed & ~rejects).alias("kept"))
