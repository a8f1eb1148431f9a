"""Toxicity by subword-bag embeddings and a linear softmax (operator 5).

A word is the bag of its character 3- to 5-grams (with word ends). The bag's embeddings
are averaged and go through a linear softmax; embeddings and softmax are trained jointly
in numpy, so an unseen misspelling shares most of its n-gram vectors with the known word.

One hateful word makes a document toxic however long it is, so a document is scored by
its most toxic word, and training attributes a document's label to its words by noisy-or:
no word of a clean document is toxic, some word of a toxic document is.

A fifth of the training rows stays out of the gradient and calibrates the score: words
that training never saw are judged there, as they are in the corpus (Platt scaling of
the largest word logit).

Training rows are a bounded sample (``max_rows``: clean and toxic rows, smallest hashes of
the id); scoring reads every word of every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts, with_struct

BUCKETS = 1 << 17
DIM = 8
NGRAMS = (3, 4, 5)
#: Bound of the training sample: clean and toxic rows.
MAX_ROWS = (3000, 1500)
STEPS = 120
FOLDS, HELD_OUT = 5, 0
_TRIM = b".,;:!?\"'()[]{}*%$&#|<>-_=+/\\"


def fold(id_col: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")), F.lit(0)) % folds


def word_types(text: bytes) -> set[bytes]:
    """Distinct words of a text, lower-cased, without punctuation around them."""
    return {w for w in (x.strip(_TRIM) for x in set(text.decode("utf-8", "replace").lower().encode().split())) if w}


def subwords(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word index) of every character n-gram of every word."""
    joined = "".join(f"<{w.decode('utf-8', 'replace')}>" for w in words)
    size = np.array([len(w.decode("utf-8", "replace")) + 2 for w in words], np.int64)
    chars = np.frombuffer(joined.encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
    left = (np.repeat(np.cumsum(size), size) - np.arange(len(chars))).astype(np.int32)  # characters to the word's end
    ids, seg = [], []
    h = np.zeros(len(chars), np.uint64)
    for n in range(1, max(NGRAMS) + 1):
        h = h[: len(chars) - n + 1] * np.uint64(0x100000001B3) + chars[n - 1 :] if len(chars) >= n else h[:0]
        if n in NGRAMS:
            fits = left[: len(h)] >= n
            x = h[fits] ^ (h[fits] >> np.uint64(31))
            x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)
            ids.append((x >> np.uint64(40)).astype(np.int32) % BUCKETS)
            seg.append(owner[: len(h)][fits])
    return np.concatenate(ids), np.concatenate(seg)  # int32: the driver holds millions of them


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class SubwordSoftmax:
    """Embeddings (BUCKETS, DIM) and a two-class softmax; ``votes`` is their product.

    ``scale`` and ``shift`` turn a document's largest word logit into its calibrated logit.
    """

    def __init__(self, votes: np.ndarray, bias: float, scale: float = 1.0, shift: float = 0.0):
        self.votes, self.bias, self.scale, self.shift = votes.astype(np.float32), float(bias), float(scale), float(shift)

    def logits(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        ids, seg = subwords(words)
        n = np.maximum(np.bincount(seg, minlength=len(words)), 1)
        return np.bincount(seg, self.votes[ids], minlength=len(words)) / n + self.bias

    def score(self, bags: list[set[bytes]], step: int = 200) -> np.ndarray:
        """Probability that a document of these distinct words is toxic."""
        top = np.full(len(bags), self.bias)
        for i in range(0, len(bags), step):  # documents whose distinct words are held at once
            words = list(set().union(*bags[i : i + step]))
            z = dict(zip(words, self.logits(words).tolist(), strict=True))
            top[i : i + step] = [max(map(z.__getitem__, bag), default=self.bias) for bag in bags[i : i + step]]
        return _sigmoid(self.scale * top + self.shift)

    def calibrate(self, bags: list[set[bytes]], toxic: np.ndarray) -> None:
        """Newton steps of a logistic regression on the largest word logit, held near the identity."""
        self.scale, self.shift = 1.0, 0.0
        if not toxic.any() or toxic.all():
            return
        p = np.clip(self.score(bags), 1e-12, 1 - 1e-12)
        x = np.c_[np.log(p / (1 - p)), np.ones(len(bags))]
        ab = np.array([1.0, 0.0])
        for _ in range(50):
            q = _sigmoid(x @ ab)
            g = x.T @ (q - toxic) + 0.1 * (ab - [1.0, 0.0])
            h = (x * (q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(2)
            ab -= np.clip(np.linalg.solve(h, g), -1, 1)
        self.scale, self.shift = max(float(ab[0]), 1e-3), float(ab[1])

    @classmethod
    def train(cls, docs: list[bytes], toxic: np.ndarray, steps: int = STEPS, seed: int = 7) -> SubwordSoftmax:
        """Adam on the noisy-or likelihood of document labels; ``docs`` are their distinct words."""
        bias = -6.0
        if not len(docs) or not toxic.any() or toxic.all():
            return cls(np.zeros(BUCKETS), bias)
        at: dict[bytes, int] = {}
        bags = [np.array([at.setdefault(w, len(at)) for w in d.split()], np.int32) for d in docs]
        ids, seg = subwords(list(at))
        per_word = np.maximum(np.bincount(seg, minlength=len(at)), 1)
        word = np.concatenate(bags)
        doc = np.repeat(np.arange(len(bags), dtype=np.int32), [len(b) for b in bags])
        bad = toxic[doc]
        in_clean = np.bincount(word[~bad], minlength=len(at)).astype(float)
        word, doc = word[bad], doc[bad]
        w_clean, w_toxic = 1.0, max(1.0, (~toxic).sum() / toxic.sum())
        rng = np.random.default_rng(seed)
        emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
        out = rng.normal(0, 0.5, DIM).astype(np.float32)  # class 1 minus class 0 of the softmax
        moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (emb, out)]
        for t in range(1, steps + 1):
            z = np.bincount(seg, (emb @ out)[ids], minlength=len(at)) / per_word + bias
            p = _sigmoid(z)
            none = np.exp(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9))[word], minlength=len(docs)))
            pull = np.minimum(none / np.maximum(1 - none, 1e-9), 1e3)  # of a toxic document not yet explained
            grad = w_clean * in_clean * p - w_toxic * np.bincount(word, pull[doc], minlength=len(at)) * p
            by_ngram = np.bincount(ids, (grad / per_word)[seg], minlength=BUCKETS).astype(np.float32)
            grads = (by_ngram[:, None] * out[None, :], by_ngram @ emb)
            for x, g, m in zip((emb, out), grads, moments, strict=True):
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.01 * (g * g - m[1])
                x -= 0.1 * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-6)
        return cls(emb @ out, bias)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: tuple[int, int] = MAX_ROWS) -> SubwordSoftmax:
    """Model from the labelled documents outside the held-out fold."""
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).filter(F.col("id").isNotNull())
    d = d.filter(fold(F.col("id"), FOLDS) != HELD_OUT)
    y = labels.select(F.col("doc_id").alias("id"), "toxic").filter(F.col("toxic").isNotNull())
    y = y.filter(fold(F.col("id"), FOLDS) != HELD_OUT).groupBy("id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("id")
    # the labelled ids of a class that the table has, a bounded number of them
    chosen = None
    for c in (0, 1):
        part = y.filter(F.col("toxic") == c).join(d.select("id").distinct(), "id").orderBy(order, "id").limit(max_rows[c])
        chosen = part if chosen is None else chosen.union(part)
    # at most sum(max_rows) rows of distinct words reach the driver
    bag = with_struct(d.join(chosen, "id"), "__bag", F.col("text"), "struct<words:binary>", _bags)
    words = F.struct(F.length("__bag.words").alias("n"), F.col("__bag.words").alias("words"))
    once = bag.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min(words).alias("b"))  # however often an id repeats
    rows = sorted(once.select("id", "toxic", "b.words").collect(), key=lambda r: r["id"])
    bags, toxic = [bytes(r["words"]) for r in rows], np.array([r["toxic"] == 1 for r in rows], bool)
    apart = np.arange(len(rows)) % 5 == 4
    pick = lambda mask: [bags[i] for i in np.flatnonzero(mask)]
    model = SubwordSoftmax.train(pick(~apart), toxic[~apart])
    model.calibrate([set(b.split()) for b in pick(apart)], toxic[apart])
    return model


def _bags(batch: pa.Array) -> pa.Array:
    words = pa.array([b" ".join(sorted(word_types(t))) for t in texts(batch)], pa.binary())
    return pa.StructArray.from_arrays([words], ["words"])


def scored(docs: DataFrame, model: SubwordSoftmax, text_col: str = "text", name: str = "__tox") -> DataFrame:
    """Every row of ``docs`` plus struct ``name`` (score, predicted).

    Null and empty texts, and texts without a word, score as a word without known n-grams
    would (near 0). Rows are scored one by one.
    """
    def batch(b: pa.Array) -> pa.Array:
        score = model.score([word_types(t) for t in texts(b)])
        return pa.StructArray.from_arrays([pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["score", "predicted"])

    return with_struct(docs, name, F.col(f"`{text_col}`"), "struct<score:double, predicted:int>", batch)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "__tox.score", "__tox.predicted")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic."""
    return scored(docs, fit(docs, labels)).filter(F.col("__tox.predicted") == 0).drop("__tox")
