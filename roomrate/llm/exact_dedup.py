"""Exact dedup by two-pass Bloom filtering (operator 10).

Only 8-byte text hashes travel at first: a task names each hash of its rows once (per
million rows), with whether it met it again, and hashes go to segments by their leading bits. A segment has its own bit array of
16 bits a hash, so the whole filter follows the number of rows and lies nowhere in one piece.
Pass 1 sets a few bits per hash and keeps which bits were set once only and which twice; pass 2
tests the segment's hashes: unless all of its bits were set twice, a hash is that of one row.

The hashes left, all repeated ones and a few false alarms, mark the rows: by a Bloom filter that is
broadcast while 16 bits for each of them are at most ``MAX_BITS`` (32 MB), else by a join on
the hash. Rows that are not marked pass straight through without a shuffle. The marked ones are
written once and grouped by SHA-256 of the text; they meet their groups in a join of two
plain tables, which Spark splits if one text has many rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

HASHES = 4
BLOCK_BITS = 1 << 16
#: Hashes of a segment at about: what a task holds, with two bit arrays of 16 bits for each.
SEGMENT = 1 << 21
#: Largest bit array that is broadcast.
MAX_BITS = 1 << 28
_BLOCK_WORDS = BLOCK_BITS // 64
#: Hashes whose bit positions are held at a time.
_STEP = 1 << 18


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``HASHES`` bit positions of each 64-bit hash (double hashing), one row per hash."""
    h = hashes.astype(np.uint64)
    step = ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)
    mixed = h[:, None] + k[None, :] * step[:, None]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(20)) & np.uint64(bits - 1)


def _set_bits(once: np.ndarray, twice: np.ndarray, pos: np.ndarray) -> None:
    pos, counts = np.unique(pos, return_counts=True)
    word, mask = (pos >> np.uint64(6)).astype(np.int64), np.uint64(1) << (pos & np.uint64(63))
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    if not len(start):
        return
    at = word[start]
    new = np.bitwise_or.reduceat(mask, start)
    again = np.bitwise_or.reduceat(np.where(counts > 1, mask, np.uint64(0)), start)
    twice[at] |= again | (once[at] & new)
    once[at] |= new


def _blocks(once: np.ndarray, twice: np.ndarray, base: dict[int, int] | None = None) -> pa.RecordBatch:
    o, t = once.reshape(-1, _BLOCK_WORDS), twice.reshape(-1, _BLOCK_WORDS)
    used = np.flatnonzero(o.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used if base is None else [base[i] for i in used], pa.int64()),
            pa.array([o[i].tobytes() for i in used], pa.binary()),
            pa.array([t[i].tobytes() for i in used], pa.binary()),
        ],
        ["block", "once", "twice"],
    )


def set_bits(hashes: DataFrame, bits: int, repeated: bool = True) -> np.ndarray:
    """Bits set by two or more rows (by any row, if not ``repeated``) of the one-column table of
    64-bit hashes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 64, np.uint64), np.zeros(bits // 64, np.uint64)
        for b in batches:
            h = b.column(0).to_numpy(zero_copy_only=False)
            _set_bits(once, twice, _positions(h, bits).ravel())
        yield _blocks(once, twice)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}  # the blocks of this partition: a share of the bit array
        for b in batches:
            for block, o, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o, t = np.frombuffer(o, np.uint64), np.frombuffer(t, np.uint64)
                if block in held:
                    have = held[block]
                    have[1] = have[1] | t | (have[0] & o)
                    have[0] = have[0] | o
                else:
                    held[block] = [o, t]
        which = 1 if repeated else 0
        keys = [k for k, v in held.items() if v[which].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([held[k][which].tobytes() for k in keys], pa.binary())], ["block", "bits"]
        )

    parts = hashes.mapInArrow(gather, "block long, once binary, twice binary")
    merged = parts.repartition("block").mapInArrow(merge, "block long, bits binary")
    out = np.zeros(bits // 64, np.uint64)
    for block, words in merged.collect():  # at most bits / 8 bytes
        out[block * _BLOCK_WORDS : (block + 1) * _BLOCK_WORDS] = np.frombuffer(bytes(words), np.uint64)
    return out


def bits_for(rows: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(BLOCK_BITS, 1 << int(16 * rows).bit_length()))


def all_set(spark: SparkSession, words: np.ndarray, hashes: Column) -> Column:
    """Whether all bits of a 64-bit hash are among ``words``."""
    shared, bits = spark.sparkContext.broadcast(words), len(words) * 64

    @F.arrow_udf("boolean")
    def test(h: pa.Array) -> pa.Array:
        pos = _positions(h.to_numpy(zero_copy_only=False), bits)
        hit = (shared.value[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)
        return pa.array(hit.all(axis=1))

    return test(hashes)


def repeated_hashes(hashes: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(h): the hashes of the one-column table that two or more rows may have; few of one row only."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in chain(batches, [None]):
            if b is not None:
                held.append(b.column(0).to_numpy(zero_copy_only=False))
                size += b.num_rows
            if size and (b is None or size >= 4 * _STEP):
                h, n = np.unique(np.concatenate(held), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n > 1)], ["h", "again"])
                held, size = [], 0

    def tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)) for b in batches]
        if not held:
            return
        h, again = (np.concatenate(x) for x in zip(*held, strict=True))
        bits = bits_for(len(h), 1 << 62)
        once, twice = np.zeros(bits // 64, np.uint64), np.zeros(bits // 64, np.uint64)
        for start in range(0, len(h), _STEP):  # pass 1; what a task met again counts as two rows
            pos = _positions(h[start : start + _STEP], bits)
            _set_bits(once, twice, pos.ravel())
            _set_bits(once, twice, pos[again[start : start + _STEP]].ravel())
        for start in range(0, len(h), _STEP):  # pass 2
            own = h[start : start + _STEP]
            pos = _positions(own, bits)
            hit = (twice[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(own[hit.all(axis=1)]))], ["h"])

    spark = hashes.sparkSession
    few = written(hashes.toDF("h").mapInArrow(named, "h long, again boolean"), "hashes")
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), few.count() // segment)
    return written(few.repartition(segments, F.shiftrightunsigned("h", 24)).mapInArrow(tested, "h long").distinct(), "repeated")


def marked(rows: DataFrame, repeated: DataFrame, hashes: Column, name: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``rows`` with boolean ``name``: whether the row's hash may be among ``repeated`` (surely, if it is)."""
    needed = bits_for(repeated.count(), 1 << 62)
    if needed <= max_bits:
        words = set_bits(repeated, needed, repeated=False)
        return rows.withColumn(name, all_set(rows.sparkSession, words, hashes))
    found = repeated.select(F.col("h").alias(f"{name}_h"))
    return rows.join(found, hashes == F.col(f"{name}_h"), "left").withColumn(name, F.col(f"{name}_h").isNotNull()).drop(f"{name}_h")


def mark_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    normalise: Callable[[Column], Column] | None = None, max_bits: int = MAX_BITS, prefix: str = "__dedup_", with_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` (without its text unless ``with_text``) plus four columns named by
    ``prefix``: ``keep_id`` (largest id among rows of equal text), ``group_size``, ``kept`` and
    ``sha256``.

    Null text counts as empty text; all empty texts are equal. Texts of any length count whole.
    Rows that also share the largest id (repeated rows): exactly one is kept. A null id sorts below
    all others. An empty table gives an empty table. Other columns, whatever their names, pass
    unchanged.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    text = normalise(text) if normalise else text
    names = [x for x in docs.columns if with_text or x != text_col]
    known = [F.col(f"`{x}`") for x in names]
    repeated = repeated_hashes(docs.select(F.xxhash64(text)))
    row = F.struct(*known) if known else F.lit(None)
    rows = marked(docs, repeated, F.xxhash64(text), f"{prefix}maybe", max_bits).select(
        row.alias("row"), F.col(f"`{id_col}`").alias("id"), F.sha2(text.cast("binary"), 256).alias("sha256"), F.col(f"{prefix}maybe").alias("maybe")
    )
    outputs = ("keep_id", "group_size", "kept", "sha256")
    single = rows.filter(~F.col("maybe")).select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha256"
    )
    # written: the number that tells repeated rows apart is given once, whoever reads it
    some = written(rows.filter("maybe").select("row", "id", "sha256", F.monotonically_increasing_id().alias("uid")), "maybe")
    groups = some.groupBy(F.col("sha256").alias("key")).agg(F.count("*").alias("group_size"), F.max(F.struct("id", "uid")).alias("best"))
    multi = some.join(written(groups, "groups"), F.col("sha256") == F.col("key")).select(
        "row", F.col("best.id").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.uid")).alias("kept"), "sha256"
    )
    return single.union(multi).select(
        *[F.col("row").getField(x).alias(x) for x in names], *[F.col(c).alias(f"{prefix}{c}") for c in outputs]
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with its own columns: one of each text, as ``mark_copies`` says."""
    return mark_copies(docs, id_col, text_col, **options).filter(F.col("__dedup_kept")).select(
        *[F.col(f"`{x}`") for x in docs.columns]
    )


def verdicts(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    p = "__dedup_"
    return mark_copies(docs.select("doc_id", "text"), with_text=False, **options).select(
        "doc_id", F.col(f"{p}keep_id").alias("keep_id"), F.col(f"{p}group_size").alias("group_size"),
        F.col(f"{p}kept").alias("kept"), F.col(f"{p}sha256").alias("text_sha256"),
    )


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
