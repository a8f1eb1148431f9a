"""Vector code compression by a trie over distinct parts (operator 12).

A vector of integers ``floor(SCALE * x)`` is cut into equal consecutive parts, and each part is
coded by the nearest of a few codebook entries of its position. The codebooks are fitted by
rounds of assigning and averaging (k-means with whole numbers, so the result does not depend on
partitions or the order of rows).

The rounds work on the distinct parts, each with its number of rows. Spark counts them (copies
meet before the shuffle) and range-partitions them in lexicographic order, which is the order in
which a depth-first walk of their trie meets the leaves. A task walks its stretch of the trie from
a stack: a node's vector of accumulated distances, one number per codebook entry, is its parent's
plus the squares of one dimension, computed once for all parts that share the prefix. Sibling
subtrees are taken together until a run of them holds ``RUN`` leaves, below which all levels are
done at once; the stack holds at most one level's runs per dimension. A leaf takes the first
smallest distance, and its part times its rows goes to the entry's sums. Only these sums, one
number per position, entry and dimension, reach the driver.

The last assignment walks, in every task, the trie of the distinct parts of its own batch of rows,
so no row is joined with its parts. All numbers are exact; a component whose integer reaches
``limit`` raises an error, because squared distances would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import with_struct, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components stay below this size, so that they have a fixed place in the bytes of a part.
LIMIT = 1 << 28
#: Leaves of a run of sibling subtrees that is finished at once.
RUN = 4096
#: Distinct parts that a task holds at a time.
BLOCK = 1 << 16


def usable(vector: Column) -> Column:
    """Whether the vector is there and all of its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def limit(size: int) -> int:
    """Components of a part of ``size`` dimensions stay below this: their distances fit 63 bits."""
    return min(LIMIT, math.isqrt((1 << 62) // max(size, 1)) // 2)


def matrix(batch: pa.Array, scale: int, width: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` of a batch of vectors, one row each; ``width`` is their length."""
    ends = batch.offsets.to_numpy()
    if len(batch) and not (np.diff(ends) == width).all():
        raise ValueError(f"vectors must all have {width} components, as the first one has")
    x = np.floor(batch.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]].astype(np.float64) * scale)
    if len(x) and np.abs(x).max() >= limit:
        raise ValueError(f"a component times {scale} reaches {limit}")
    return x.astype(np.int64).reshape(len(batch), width)


def keys(parts: np.ndarray, position: int) -> list[bytes]:
    """Bytes of each part that sort as (position, part): the position, then big-endian offsets."""
    shifted = (parts + LIMIT).astype(">u4")
    out = np.empty((len(parts), 1 + 4 * parts.shape[1]), np.uint8)
    out[:, 0] = position
    out[:, 1:] = shifted.view(np.uint8).reshape(len(parts), -1)
    return [r.tobytes() for r in out]


def from_keys(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(positions, parts) of a batch of ``keys``."""
    raw = np.frombuffer(b"".join(found.to_pylist()), np.uint8).reshape(len(found), -1)
    parts = np.ascontiguousarray(raw[:, 1:]).view(">u4").astype(np.int64) - LIMIT
    return raw[:, 0].astype(np.int64), parts


def walk(parts: np.ndarray, entries: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """Depth-first over the trie of ``parts`` (sorted rows): (first leaf, end, distances) per run.

    The distances of a run have one row per leaf and one column per row of ``entries``. Rows out
    of order only share less.
    """
    count, width = parts.shape
    if not count:
        return
    changed = np.zeros((count, width), bool)  # whether a leaf starts a new node at a depth
    changed[0] = True
    np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1, out=changed[1:])
    # a run: leaves first..end, depth of its nodes, their first leaves, their distance vectors
    stack = [(0, count, 0, np.zeros(1, np.int64), np.zeros((1, len(entries)), np.int64))]
    while stack:
        first, end, depth, nodes, far = stack.pop()
        while depth < width:
            starts = changed[first:end, depth].copy()
            starts[nodes - first] = True
            child = np.flatnonzero(starts) + first
            parent = np.searchsorted(nodes, child, side="right") - 1
            far = far[parent] + (parts[child, depth, None] - entries[None, :, depth]) ** 2
            nodes, depth = child, depth + 1
            if end - first > RUN and len(nodes) > 1 and depth < width:
                break
        else:
            size = np.diff(np.r_[nodes, end])
            yield first, end, np.repeat(far, size, axis=0)
            continue
        cut = np.unique(np.searchsorted(nodes, np.arange(first, end, RUN), side="left"))
        cut = np.r_[cut[cut < len(nodes)], len(nodes)]
        runs = [(a, b) for a, b in zip(np.r_[0, cut[:-1]].tolist(), cut.tolist(), strict=True) if b > a]
        for a, b in reversed(runs):
            stop = int(nodes[b]) if b < len(nodes) else end
            stack.append((int(nodes[a]), stop, depth, nodes[a:b], far[a:b]))


def assign(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each of the sorted ``parts``; ties to the lower entry."""
    best, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
    for first, end, far in walk(parts, entries):
        best[first:end] = far.argmin(axis=1)
        error[first:end] = far[np.arange(end - first), best[first:end]]
    return best, error


def distinct_parts(rows: DataFrame, vector: str, width: int, name: str = "parts") -> DataFrame:
    """(key, n): every distinct part of every position with its number of rows, in trie order."""

    def batch(b: pa.Array) -> pa.Array:
        size = width // PARTS
        x = matrix(b, SCALE, width, limit(size))
        by_position = [keys(x[:, p * size : (p + 1) * size], p) for p in range(PARTS)]
        flat = [k for row in zip(*by_position, strict=True) for k in row]
        lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, PARTS, dtype=np.int32), pa.array(flat, pa.binary()))
        return pa.StructArray.from_arrays([lists], ["keys"])

    found = with_struct(rows.select(vector), "__codes", F.col(vector), "struct<keys: array<binary>>", batch)
    counted = found.select(F.explode("__codes.keys").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return written(counted.repartitionByRange("key").sortWithinPartitions("key"), name)


def _sums(table: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(position, entry) to (rows, sum of their parts) under the nearest entries of ``books``."""
    shared = table.sparkSession.sparkContext.broadcast(books)  # PARTS x ENTRIES x part width numbers

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        rows = np.zeros(books.shape[:2], object)
        total = np.zeros(books.shape, object)

        def add(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            position, parts = from_keys(t.column("key").chunk(0))
            n = t.column("n").to_numpy()
            big = int(n.max()) * int(np.abs(parts).max() + 1) * len(n) >= 1 << 62
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                best, _ = assign(parts[at], books[p])
                weight = n[at].astype(object) if big else n[at]
                own = np.zeros((books.shape[1], books.shape[2] + 1), weight.dtype)
                np.add.at(own, best, np.c_[parts[at].astype(weight.dtype) * weight[:, None], weight])
                total[p] += own[:, :-1].astype(object)
                rows[p] += own[:, -1].astype(object)

        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += b.num_rows
            if size >= BLOCK:
                add(held)
                held, size = [], 0
        if held:
            add(held)
        used = [(p, e, d) for p, e in zip(*np.nonzero(rows), strict=True) for d in range(books.shape[2])]
        columns = [pa.array([int(u[i]) for u in used], pa.int32()) for i in range(3)]
        numbers = ([rows[p, e] for p, e, _ in used], [total[u] for u in used])
        columns += [pa.array([Decimal(int(v)) for v in c], pa.decimal128(38, 0)) for c in numbers]
        yield pa.RecordBatch.from_arrays(columns, ["position", "entry", "dim", "n", "total"])

    found = table.mapInArrow(gather, "position int, entry int, dim int, n decimal(38,0), total decimal(38,0)")
    found = found.groupBy("position", "entry", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for r in found.orderBy("position", "entry", "dim").collect():  # at most PARTS x ENTRIES x part width rows
        out.setdefault((r["position"], r["entry"]), (int(r["n"]), []))[1].append(int(r["total"]))
    return out


def fit(rows: DataFrame, id_col: str, vector: str, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (position, entry, component) of the usable ``rows``; no entries if there are none.

    They start from the rows of the smallest ids; a null id comes last, equal ids in the order of
    their vectors. With fewer rows than ``ENTRIES`` there are as many entries as rows.
    """
    start = rows.select(F.col(f"`{id_col}`").alias("i"), F.col(vector).alias("v"))
    start = start.orderBy(F.col("i").asc_nulls_last(), "v").limit(ENTRIES).collect()  # a fixed number of rows
    if not start:
        return np.zeros((PARTS, 0, 0), np.int64)
    width = len(start[0]["v"])
    if not width or width % PARTS:
        raise ValueError(f"a vector of {width} components cannot be cut into {PARTS} equal parts")
    first = matrix(pa.array([r["v"] for r in start], pa.list_(pa.float64())), SCALE, width, limit(width // PARTS))
    books = first.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2).copy()
    table = distinct_parts(rows, vector, width)
    for _ in range(rounds):
        for (p, e), (n, total) in _sums(table, books).items():
            books[p, e] = [t // n for t in total]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", prefix: str = "__code_"
) -> DataFrame:
    """The rows of ``table`` with a usable vector, plus ``code``, ``error``, ``label_error`` and
    ``codebooks_sha256`` named by ``prefix``.

    Rows whose vector is null or holds null, NaN or infinite components are dropped. Repeated
    rows are rows of their own; equal distances go to the lower entry. Null labels are one label.
    An empty table gives an empty table. Vectors of different lengths, or of a length that the
    number of parts does not divide, raise an error. Other columns, whatever their names, pass
    unchanged.
    """
    vector, label = F.col(f"`{vector_col}`"), F.col(f"`{label_col}`")
    row = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    rows = table.filter(usable(vector)).select(
        row.alias("row"), F.col(f"`{id_col}`").alias("i"), vector.cast("array<double>").alias("v"), label.alias("l")
    )
    books = fit(rows, "i", "v")
    width = books.shape[0] * books.shape[2]

    def batch(b: pa.Array, books: np.ndarray) -> pa.Array:
        size = books.shape[2]
        x = matrix(b, SCALE, width, limit(size))
        codes, errors = np.zeros((len(x), PARTS), np.uint8), np.zeros(len(x), np.int64)
        for p in range(PARTS if len(x) else 0):
            parts, back = np.unique(x[:, p * size : (p + 1) * size], axis=0, return_inverse=True)
            best, error = assign(parts, books[p])
            codes[:, p] = best[back.ravel()]
            errors += error[back.ravel()]
        return pa.StructArray.from_arrays([pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors)], ["code", "error"])

    shared = table.sparkSession.sparkContext.broadcast(books)  # of a fixed size
    done = with_struct(rows, "s", F.col("v"), "struct<code: string, error: long>", batch, lambda: shared.value)
    done = written(done.select("row", "l", "s.code", "s.error"), "codes")
    per_label = written(done.groupBy("l").agg(F.sum("error").alias("label_error")), "label-errors")
    per_label = per_label.withColumnRenamed("l", "k")
    out = done.join(per_label, F.col("l").eqNullSafe(F.col("k")))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in table.columns],
        *[F.col(c).alias(f"{prefix}{c}") for c in ("code", "error", "label_error")],
        F.lit(digest(books)).alias(f"{prefix}codebooks_sha256"),
    )


def codes(embeddings: DataFrame) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256."""
    out = coded(embeddings.select("vec_id", "embedding", "label"))
    return out.select("vec_id", *[F.col(f"__code_{c}").alias(c) for c in ("code", "error", "label_error", "codebooks_sha256")])


def _sql() -> str:
    """All rounds as common table expressions: every part against every entry."""
    far = f"list_sum([(p.part[i] - b.part[i]) * (p.part[i] - b.part[i]) for i in range(1, len(p.part) + 1)])"
    ctes = [
        "kept AS MATERIALIZED (SELECT vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT) for x in embedding] AS x FROM embeddings"
        " WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)",
        "parts AS MATERIALIZED (SELECT vec_id, label, pos, x[pos * (len(x) // 8) + 1 : (pos + 1) * (len(x) // 8)] AS part"
        " FROM kept, (SELECT unnest(range(8)) AS pos))",
        "firsts AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16)",
        "book0 AS MATERIALIZED (SELECT pos, entry, part FROM parts JOIN firsts USING (vec_id))",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(
            f"near{r} AS MATERIALIZED (SELECT p.vec_id, p.label, p.pos, p.part, min(CAST({far} AS BIGINT)) AS error,"
            f" arg_min(b.entry, CAST({far} AS BIGINT) * 16 + b.entry) AS entry"
            f" FROM parts p JOIN book{r} b ON b.pos = p.pos GROUP BY p.vec_id, p.label, p.pos, p.part)"
        )
        if r < ROUNDS:
            ctes.append(
                f"sums{r} AS (SELECT pos, entry, i, CAST(floor(sum(part[i]) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS c"
                f" FROM near{r}, (SELECT unnest(range(1, 1 + (SELECT max(len(part)) FROM parts))) AS i) GROUP BY pos, entry, i)"
            )
            ctes.append(
                f"mean{r} AS (SELECT pos, entry, list(c ORDER BY i) AS part FROM sums{r} GROUP BY pos, entry)"
            )
            ctes.append(
                f"book{r + 1} AS MATERIALIZED (SELECT b.pos, b.entry, coalesce(m.part, b.part) AS part"
                f" FROM book{r} b LEFT JOIN mean{r} m ON m.pos = b.pos AND m.entry = b.entry)"
            )
    last = f"near{ROUNDS}"
    ctes.append(
        f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY pos) AS code, CAST(sum(error) AS BIGINT) AS error"
        f" FROM {last} GROUP BY vec_id, label)"
    )
    ctes.append(
        f"books AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY pos, entry)) AS codebooks_sha256 FROM book{ROUNDS})"
    )
    return "WITH " + ",\n".join(ctes) + (
        "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, books"
    )


SQL = _sql()
