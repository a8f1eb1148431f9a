"""Language ID by a byte convolutional network (operator 7).

Windows of ``WINDOW`` bytes go through filters of widths 2, 3 and 4 over one-hot bytes,
a max over the window, and a softmax; trained in numpy with Adam. A text is cut into
windows from start to end, all windows of a batch go through the network together, and
the language has the largest mean log-probability over the windows, weighted by bytes.

A filter over one-hot bytes is a sum of table rows, so when applied, pairs of bytes index
one table of 65,536 rows instead of two of 256.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import texts, with_struct, written

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8
#: Bound of the training sample: rows per language, smallest hashes of the id; windows per row.
MAX_ROWS, ROW_WINDOWS = 500, 4
#: A softmax over more languages than this is refused; the counts per language fit a broadcast.
MAX_LANGS = 1000
EPOCHS, BATCH, RATE = 12, 64, 0.03
FOLDS, HELD_OUT = 4, 2
NONE = "und"


def fold(id_col: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")), F.lit(0)) % folds


def windows(texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, owner, bytes in use): whole texts cut into windows, the last one filled with zeros."""
    size = np.array([len(t) for t in texts_], np.int64)
    n = -(-size // WINDOW)
    flat = b"".join(t.ljust(k * WINDOW, b"\0") for t, k in zip(texts_, n.tolist(), strict=True))
    w = np.frombuffer(flat, np.uint8).reshape(-1, WINDOW)
    owner = np.repeat(np.arange(len(texts_)), n)
    first = np.cumsum(n) - n
    used = np.minimum(size[owner] - (np.arange(len(owner)) - first[owner]) * WINDOW, WINDOW)
    return w, owner, used


class ByteCnn:
    """tables: by width, (width, 256, FILTERS); head: (3 * FILTERS + 1, languages)."""

    def __init__(self, tables: list[np.ndarray], head: np.ndarray, langs: list[str]):
        self.tables, self.head, self.langs = tables, head, langs

    def prepare(self) -> None:
        """Pair tables: a filter's first and second (third and fourth) byte in one lookup."""
        two = lambda t, j: (t[j + 1][:, None, :] + t[j][None, :, :]).reshape(65536, FILTERS)
        a, b, c = (t.astype(np.float32) for t in self.tables)
        self.pairs = np.ascontiguousarray(two(a, 0)), np.ascontiguousarray(two(b, 0)), b[2].copy(), two(c, 0), two(c, 2)

    def pooled(self, w: np.ndarray) -> np.ndarray:
        """Max over each window of each filter: (windows, 3 * FILTERS)."""
        code = w[:, :-1].astype(np.uint16) | (w[:, 1:].astype(np.uint16) << 8)
        p2, p3, q3, p4, q4 = self.pairs
        z2 = p2[code].max(axis=1)
        z3 = (p3[code[:, :-1]] + q3[w[:, 2:]]).max(axis=1)
        z4 = (p4[code[:, :-2]] + q4[code[:, 2:]]).max(axis=1)
        return np.maximum(np.concatenate([z2, z3, z4], axis=1), 0)

    def log_probabilities(self, w: np.ndarray, step: int = 256) -> np.ndarray:
        out = np.zeros((len(w), len(self.langs)))
        for i in range(0, len(w), step):
            x = self.pooled(w[i : i + step])
            z = x @ self.head[:-1] + self.head[-1]
            z -= z.max(axis=1, keepdims=True)
            out[i : i + step] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out

    @classmethod
    def train(cls, w: np.ndarray, lang: np.ndarray, langs: list[str], seed: int = 11) -> ByteCnn:
        rng = np.random.default_rng(seed)
        tables = [rng.normal(0, 0.3, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS]
        head = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS + 1, len(langs))).astype(np.float32)
        params = [*tables, head]
        moments = [[np.zeros_like(x), np.zeros_like(x)] for x in params]
        t = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(w))
            for i in range(0, len(order), BATCH):
                rows = order[i : i + BATCH]
                x, y = w[rows], lang[rows]
                feats, tops = [], []
                for table, k in zip(tables, WIDTHS, strict=True):
                    n = WINDOW - k + 1
                    z = sum(table[j][x[:, j : j + n]] for j in range(k))
                    top = z.argmax(axis=1)
                    tops.append(top)
                    feats.append(np.take_along_axis(z, top[:, None, :], axis=1)[:, 0, :])
                raw = np.concatenate(feats, axis=1)
                hid = np.concatenate([np.maximum(raw, 0), np.ones((len(rows), 1), np.float32)], axis=1)
                s = hid @ head
                p = np.exp(s - s.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(rows)), y] -= 1
                p /= len(rows)
                back = (p @ head[:-1].T) * (raw > 0)
                grads = []
                for q, (table, top) in enumerate(zip(tables, tops, strict=True)):
                    g = np.zeros_like(table)
                    part = back[:, q * FILTERS : (q + 1) * FILTERS]
                    at = np.arange(len(rows))[:, None]
                    f = np.broadcast_to(np.arange(FILTERS), top.shape)
                    for j in range(table.shape[0]):
                        np.add.at(g[j], (x[at, top + j], f), part)
                    grads.append(g)
                grads.append(hid.T @ p)
                t += 1
                for v, g, m in zip(params, grads, moments, strict=True):
                    m[0] += 0.1 * (g - m[0])
                    m[1] += 0.01 * (g * g - m[1])
                    v -= RATE * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.99**t)) + 1e-6)
        return cls(tables, head, langs)


def _samples(b: pa.Array) -> pa.Array:
    """Up to ``ROW_WINDOWS`` windows spread evenly over a text."""
    out = []
    for t in texts(b):
        n = -(-len(t) // WINDOW)
        k = min(n, ROW_WINDOWS)
        at = [i * n // k for i in range(k)]
        out.append([t[i * WINDOW : (i + 1) * WINDOW].ljust(WINDOW, b"\0") for i in at])
    return pa.StructArray.from_arrays([pa.array(out, pa.list_(pa.binary()))], ["windows"])


def _smallest(ids: DataFrame, max_rows: int) -> DataFrame:
    """The ``max_rows`` rows of each language with the smallest hashes of the id.

    A first cut of the hashes, at twice the share that a language's count asks for, is made
    where the rows lie, so that no task ranks more than about ``2 * max_rows`` of a language.
    """
    counts = ids.groupBy("lang").count().limit(MAX_LANGS + 1).collect()  # one row per output of the softmax
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    most = [(r["lang"], 2**63 - 1 if r["count"] <= 2 * max_rows else 2**64 * 2 * max_rows // r["count"] - 2**63) for r in counts]
    cut = ids.sparkSession.createDataFrame(most, "lang string, most long")
    near = ids.withColumn("hash", F.xxhash64("id")).join(F.broadcast(cut), "lang").filter(F.col("hash") <= F.col("most"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "id"))
    return near.withColumn("r", rank).filter(F.col("r") <= max_rows).select("id", "lang")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> ByteCnn | None:
    """Network from rows with a language outside the held-out fold; None if there are none.

    Rows without text or id teach nothing; an id that repeats counts once per language, with
    the text whose windows come first. More than ``MAX_LANGS`` languages raise an error.
    """
    d = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    d = d.filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0) & (fold(F.col("id"), FOLDS) != HELD_OUT))
    ids = written(d.select("id", "lang").distinct(), "langid-ids")
    chosen = F.broadcast(_smallest(ids, max_rows))  # MAX_LANGS * max_rows ids at most
    cut = with_struct(d.join(chosen, ["id", "lang"]), "__w", F.col("text"), "struct<windows:array<binary>>", _samples)
    once = cut.groupBy("id", "lang").agg(F.min("__w.windows").alias("windows"))  # however often an id repeats
    rows = once.select("id", "lang", F.explode("windows").alias("w")).collect()  # languages * max_rows * ROW_WINDOWS windows
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["id"] is None, r["id"] or 0, bytes(r["w"])))
    langs = sorted({r["lang"] for r in rows})
    w = np.frombuffer(b"".join(bytes(r["w"]) for r in rows), np.uint8).reshape(-1, WINDOW)
    return ByteCnn.train(w, np.array([langs.index(r["lang"]) for r in rows]), langs)


def predicted(docs: DataFrame, model: ByteCnn | None, text_col: str = "text", name: str = "__lang") -> DataFrame:
    """Every row of ``docs`` plus struct ``name`` (lang_pred, score).

    Null texts and texts without a letter (and all texts, if no row has a language to
    learn) get ``und`` with score 0. Rows are scored one by one.
    """

    def batch(b: pa.Array, net: ByteCnn | None) -> pa.Array:
        raw = texts(b)
        lang, score = [NONE] * len(raw), np.zeros(len(raw))
        some = [i for i, t in enumerate(raw) if net and any(map(str.isalpha, t.decode("utf-8", "replace")))]
        step = 64  # documents whose windows are held at once
        for i in range(0, len(some), step):
            rows = some[i : i + step]
            w, owner, used = windows([raw[j] for j in rows])
            lp = net.log_probabilities(w) * used[:, None]
            total = np.stack([np.bincount(owner, lp[:, k], minlength=len(rows)) for k in range(lp.shape[1])], axis=1)
            mean = total / np.bincount(owner, used, minlength=len(rows))[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for j, q in zip(rows, p, strict=True):
                lang[j], score[j] = net.langs[int(q.argmax())], q.max()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    def setup() -> ByteCnn | None:
        if model:
            model.prepare()
        return model

    return with_struct(docs, name, F.col(f"`{text_col}`"), "struct<lang_pred:string, score:double>", batch, setup)


def predictions(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    out = predicted(docs.select("doc_id", "text"), fit(docs))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "__lang.lang_pred", "__lang.score")
