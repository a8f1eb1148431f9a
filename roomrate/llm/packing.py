"""Packing by cutting-stock column generation (operator 3).

A document's tokens are cut into full sequences of 2048, one piece that is a multiple of
``UNIT``, and a tail shorter than ``UNIT``. Only the histogram of piece lengths goes to the
driver (at most 2048 / UNIT + UNIT classes): a linear program over sequence patterns is
solved by column generation, where a knapsack dynamic program over the LP's prices proposes
the next pattern. Patterns are rounded down; the few classes left over are packed first-fit
decreasing. Pieces of a class are ranked by bucket and id, and the rank decides pattern,
sequence and offset by interval lookup, so assignment is one shuffle of the piece table.

Middle pieces use patterns over units, tails patterns over tokens. A sequence whose length
is a power of two needs no padding, so a leftover sequence of that length is as good as a
full one.
"""

from __future__ import annotations

import base64
import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import with_struct, written

LENGTH = 2048
UNIT = 32
END_ID = 1
#: The same vocabulary as byte_bpe_50k.json, as ranks; faster to apply. Tests hold both equal.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: The tokenizer itself, for the texts that the fast way cannot take.
WHOLE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The added token of byte_bpe_50k.json, which the rank file leaves out: found wherever a text holds it.
SPECIAL = {"<|endoftext|>": 50256}
#: Rows that a ranking group of one piece length holds at about.
GROUP_ROWS = 50_000

_ENCODERS: dict[str, tiktoken.Encoding] = {}
_WHOLE: dict[str, tokenizers.Tokenizer] = {}


def encoder(path: str = VOCABULARY) -> tiktoken.Encoding:
    if path not in _ENCODERS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        name = os.path.basename(path)
        _ENCODERS[path] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    return _ENCODERS[path]


def token_ids(text: str, enc: tiktoken.Encoding, whole: str = WHOLE_TOKENIZER) -> list[int]:
    """Ids of ``text`` as ``tokenizers`` gives them.

    The pattern of the fast way looks ahead after every blank of a run and gives up on runs of
    about a million; such texts, of any length, go to ``tokenizers`` itself.
    """
    try:
        return enc.encode(text, allowed_special="all")
    except ValueError:
        if whole not in _WHOLE:
            _WHOLE[whole] = tokenizers.Tokenizer.from_file(whole)
        return _WHOLE[whole].encode(text, add_special_tokens=False).ids


def cuts(n: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens, in order."""
    full, rest = divmod(n, LENGTH)
    return [LENGTH] * full + [x for x in (rest // UNIT * UNIT, rest % UNIT) if x]


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY, whole: str = WHOLE_TOKENIZER
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): one row per piece.

    Null and empty texts have the end id alone. Texts count whole, whatever their length or the
    length of their runs of blanks. Repeated rows are documents of their own; an empty table has
    no piece.
    """

    def batch(b: pa.Array, enc: tiktoken.Encoding) -> pa.Array:
        out = []
        for text in b.to_pylist():
            ids = np.array([*token_ids(text or "", enc, whole), END_ID], "<u4")
            start, rows = 0, []
            for n in cuts(len(ids)):
                rows.append({"start": start, "length": n, "ids_crc32": zlib.crc32(ids[start : start + n].tobytes())})
                start += n
            out.append({"n": len(ids), "pieces": rows})
        return pa.array(out, kind)

    kind = pa.struct([
        ("n", pa.int64()),
        ("pieces", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))),
    ])
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    returns = "struct<n: long, pieces: array<struct<start: long, length: long, ids_crc32: long>>>"
    done = with_struct(source, "__p", F.col("text"), returns, batch, lambda: encoder(path))
    return done.select("doc_id", F.col("__p.n").alias("doc_tokens"), F.explode("__p.pieces").alias("x")).select(
        "doc_id", "x.start", "x.length", "x.ids_crc32", "doc_tokens"
    )


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern of largest price within ``capacity``."""
    value = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, np.int64)
    for c in range(1, capacity + 1):
        fits = sizes <= c
        offers = np.where(fits, value[c - np.minimum(sizes, c)] + prices, -1.0)
        k = int(offers.argmax()) if len(offers) else -1
        if k >= 0 and offers[k] > value[c - 1] + 1e-12:
            value[c], last[c] = offers[k], k
        else:
            value[c] = value[c - 1]
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if last[c] < 0 or value[c] == value[c - 1]:
            c -= 1
        else:
            pattern[last[c]] += 1
            c -= sizes[last[c]]
    return float(value[capacity]), pattern


def column_generation(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, times used): the LP relaxation of fewest sequences, by revised simplex.

    ``rounds`` bounds the improvement of the objective; any basis met on the way covers all
    pieces, so the result is whole at every bound.
    """
    m = len(sizes)
    patterns = np.diag(capacity // sizes).astype(float)  # column j: sequences of class j only
    x = counts / np.diag(patterns)
    for _ in range(rounds):
        prices = np.linalg.solve(patterns.T, np.ones(m))
        worth, new = best_pattern(prices, sizes, capacity)
        if worth <= 1 + 1e-7:
            break
        way = np.linalg.solve(patterns, new.astype(float))
        ratio = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        x = np.maximum(x - step * way, 0)
        x[leave] = step
        patterns[:, leave] = new
    return patterns.T.astype(np.int64), x


@dataclass
class Slots:
    """Pieces ``first <= rank < first + times * each`` of a class go to ``times`` sequences from
    ``sequence``, ``each`` to a sequence, from ``offset`` on."""

    size: int
    first: int
    times: int
    each: int
    sequence: int
    offset: int


def _leftover(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> list[np.ndarray]:
    """First-fit decreasing of the pieces that rounding left: a number bounded by the classes."""
    bins: list[list] = []
    for k in np.argsort(-sizes):
        for _ in range(int(counts[k])):
            room = next((b for b in bins if b[0] >= sizes[k]), None)
            if room is None:
                room = [capacity, np.zeros(len(sizes), np.int64)]
                bins.append(room)
            room[0] -= sizes[k]
            room[1][k] += 1
    return [b[1] for b in bins]


def plan(histogram: dict[int, int]) -> list[Slots]:
    """Where the pieces of each length go; sequence ids run from 0 without gaps."""
    slots: list[Slots] = []
    sequence = 0
    used: dict[int, int] = {}

    def place(lengths: np.ndarray, pattern: np.ndarray, times: int) -> None:
        nonlocal sequence
        offset = 0
        for size, each in zip(lengths.tolist(), pattern.tolist(), strict=True):
            if each:
                slots.append(Slots(size, used.get(size, 0), times, each, sequence, offset))
                used[size] = used.get(size, 0) + times * each
                offset += size * each
        sequence += times

    if n := histogram.get(LENGTH, 0):
        place(np.array([LENGTH]), np.array([1]), n)
    middle = sorted((s for s in histogram if UNIT <= s < LENGTH), reverse=True)
    tails = sorted((s for s in histogram if s < UNIT), reverse=True)
    for lengths, unit in ((np.array(middle, np.int64), UNIT), (np.array(tails, np.int64), 1)):
        if not len(lengths):
            continue
        counts = np.array([histogram[int(s)] for s in lengths], np.int64)
        sizes, capacity = lengths // unit, LENGTH // unit
        patterns, x = column_generation(sizes, counts.astype(float), capacity)
        left = counts.copy()
        for pattern, times in zip(patterns, np.floor(x + 1e-9).astype(np.int64), strict=True):
            on = pattern > 0
            times = int(min(times, (left[on] // pattern[on]).min())) if on.any() else 0
            if times > 0:
                place(lengths, pattern, times)
                left -= pattern * times
        for pattern in _leftover(sizes, left, capacity):
            place(lengths, pattern, 1)
    return slots


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text is empty text: the end id alone. Repeated rows and ids are documents of their
    own. An empty table gives no piece.
    """
    p = written(pieces(docs, id_col, text_col, path), "pieces")
    buckets = max(256, p.count() // GROUP_ROWS)
    p = p.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    cells = p.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    rows = cells.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row per length: LENGTH / UNIT + UNIT at most
    by_size: dict[int, list[Slots]] = {}
    for s in plan({r["length"]: r["n"] for r in rows}):
        by_size.setdefault(s.size, []).append(s)
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = p.withColumn("rank", F.row_number().over(inside) - 1).join(cells, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before"))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def assign(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, r = length.to_numpy(), rank.to_numpy()
        seq, off = np.zeros(len(r), np.int64), np.zeros(len(r), np.int64)
        for value in np.unique(size):
            own = by_size[int(value)]
            at = np.flatnonzero(size == value)
            first = np.array([s.first for s in own], np.int64)
            k = np.searchsorted(first, r[at], side="right") - 1
            each, sequence, offset = (np.array([getattr(s, f) for s in own], np.int64)[k] for f in ("each", "sequence", "offset"))
            inner = r[at] - first[k]
            seq[at] = sequence + inner // each
            off[at] = offset + inner % each * value
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(off)], ["sequence_id", "offset"])

    out = ranked.withColumn("__a", assign("length", "rank"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "__a.sequence_id", "__a.offset")
