"""N-gram Jaccard join by T-occurrence search (operator 1).

A document is its set of hashed shingles of ``words`` words. Two documents link when
``100 * |A and B| >= percent * |A or B|``, so a partner of a set of n has at least
required(n) = ceil(n * percent / 100) of its shingles. The query of the operator takes 4 words
and 85 (the defaults), the pipeline's stage 5 words and 80. DivideSkip splits the inverted lists
of a set by length:

* Short lists: shingles are ordered by how often they occur (counted over all documents),
  rarest first, and the first n - required(n) + T of a set, T = 1 + n // 32, are indexed.
  A linked pair meets in at least T of these lists. Spark counts the lists a pair
  meets in by a join and an aggregate, a block search by ``np.bincount``: equal to a heap merge
  in result, without a step per posting in Python. A candidate that comes up fewer than T times is
  dropped. Only the choice of pivots merges on a heap.
* Long lists: the frequent shingles left over are never read as lists. For a candidate
  they are binary-probed in its sorted set, which gives the exact overlap.

Equal sets are one class before the search, named by the smallest number among its rows: eight
bytes move per posting instead of a digest. In the first round each list names one pivot,
a class is checked against the pivot it meets in most lists, and links become connected
components. The second round takes the lists that still hold two or more components: short
ones are joined with themselves, for pairs of different components; long ones (many
variants of one text that do not link with each other) are cut into blocks of bounded size,
and the DivideSkip search runs inside every pair of blocks of a group, without emitting
pairs. Every pair that could link two components is checked, so the result is exact.

A set has a sketch of one to two bits a shingle: the parity of how many fall to each bit. The
bits in which two sketches differ are at most the shingles in which the sets differ, so
candidate pairs with too many of them cannot link. Texts and full sets move only for the others.

The count of frequent shingles only decides the order, that is, the cost. It keeps the
``FREQUENT`` most frequent ones (6 MB, broadcast); the result is the same at any bound.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_arrow, texts, with_struct, written
from .exact_dedup import all_set, bits_for, set_bits

#: Words of a shingle and least similarity in hundredths of the operator's query.
WORDS, PERCENT = 4, 85
#: One more short list must agree for each so many shingles.
SHINGLES_PER_T = 32
FREQUENT = 1 << 19
#: Lists of shingles counted at least so often get their pivot by an aggregate and a join that
#: can be split; shorter ones by a window.
HOT = 500
#: Bits of the largest sketch.
SKETCH_BITS = 1 << 20
#: Open lists of more classes are searched in blocks instead of joined with themselves.
LONG_LIST = 64
#: A block holds about so many classes and shingles at most (two of them meet in a task).
BLOCK_SETS, BLOCK_SHINGLES = 1500, 1_000_000
_CHUNK = 3_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; fewer words than a shingle make one, none none."""
    w = text.lower().split()  # of bytes: A-Z only, and the six separators of a word
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for j in range(min(words, len(h))):
        out = out * _MIX + h[j : j + n]
    out ^= out >> np.uint64(32)
    return np.unique(out * _MIX)


def required(n, percent: int = PERCENT):
    """Least overlap of a set of ``n`` with any partner."""
    return -(-percent * n // 100)


def occurrences(n):
    """T: lists of a set's index part that a partner of the same or a larger T must share."""
    return 1 + n // SHINGLES_PER_T


def merge_short(lists: Iterable[list], least) -> list[tuple[object, int]]:
    """Heap-merge of sorted lists: (id, count) of ids that occur at least ``least(id)`` times."""
    merged = ((i, sum(1 for _ in run)) for i, run in groupby(heapq.merge(*lists)))
    return [(i, c) for i, c in merged if c >= least(i)]


def probe_long(query: np.ndarray, candidate: np.ndarray) -> int:
    """Overlap of two sorted sets: each member of the smaller one is binary-probed in the larger."""
    if len(query) > len(candidate):
        query, candidate = candidate, query
    at = np.minimum(np.searchsorted(candidate, query), len(candidate) - 1)
    return int((candidate[at] == query).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = probe_long(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles that fall to each bit; bits are a power of two, at least 64."""
    bits = min(SKETCH_BITS, max(64, 1 << (len(shingles) - 1).bit_length()))
    at = (shingles >> np.uint64(40)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def may_link(n: int, a: bytes, m: int, b: bytes, percent: int = PERCENT) -> bool:
    """Whether sets of ``n`` and ``m`` shingles with these sketches can link; true if they do."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):  # the upper half falls to the same bits of the lower one
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    apart = int(np.bitwise_count(x ^ y).sum())
    return 100 * (n + m - apart) >= percent * (n + m + apart)


def divide_skip(
    sets: list[np.ndarray], parts: list, queries: np.ndarray, index: np.ndarray, percent: int = PERCENT
) -> list[tuple[int, int]]:
    """Links (query, indexed) that join different parts, found by merging and probing inverted lists.

    ``parts`` names the component each set is known to be in; a link between two sets of
    one component (known before or found on the way) is not looked for. With ``queries`` equal
    to ``index`` every pair is met once.
    """
    same = queries is index
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate([sets[i] for i in index])
    order = np.argsort(flat, kind="stable")
    postings = np.repeat(np.arange(len(index)), size[index])[order]
    tokens, start = np.unique(flat[order], return_index=True)
    end = np.r_[start[1:], len(flat)]
    number = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part = np.array([number[p] for p in parts], np.int64)
    links = []
    for k, q in enumerate(queries.tolist()):
        s, n = sets[q], size[q]
        t = required(n, percent)
        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
        at = at[tokens[at] == s]
        if len(at) < t:
            continue
        at = at[np.argsort(end[at] - start[at], kind="stable")]
        skip = min(t - 1, t // 4)  # the longest lists are probed, not merged
        short, long_ = at[: len(at) - skip], at[len(at) - skip :]
        count = np.bincount(np.concatenate([postings[start[a] : end[a]] for a in short]), minlength=len(index))
        other = size[index]
        fit = (count >= t - skip) & (part[index] != part[q]) & (100 * np.minimum(other, n) >= percent * np.maximum(other, n))
        if same:
            fit[k:] = False
        found = np.flatnonzero(fit)
        if not len(found):
            continue
        both = count[found]
        for a in long_:
            run = postings[start[a] : end[a]]
            p = np.minimum(np.searchsorted(run, found), len(run) - 1)
            both = both + (run[p] == found)
        for j in index[found[100 * both >= percent * (n + other[found] - both)]].tolist():
            if part[j] != part[q]:
                part[part == part[j]] = part[q]
                links.append((q, j))
    return links


def _search_block(group: pa.Table, percent: int) -> pa.Table:
    """Links of one pair of blocks: within the block if both are one, else across."""
    rows = group.select(["node", "root", "side", "set"]).to_pylist()
    rows.sort(key=lambda r: (r["side"], r["node"]))
    sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
    side = np.array([r["side"] for r in rows], np.int64)
    index = np.flatnonzero(side == 0)
    queries = np.flatnonzero(side == 1) if (side == 1).any() else index
    alone = len(rows) and group.column("first")[0].as_py() != group.column("second")[0].as_py() and not (len(index) and (side == 1).any())
    links = [] if alone else divide_skip(sets, [r["root"] for r in rows], queries, index, percent)
    return pa.table(
        [pa.array([rows[i]["node"] for i, _ in links], pa.int64()), pa.array([rows[j]["node"] for _, j in links], pa.int64())],
        names=["u", "v"],
    )


def _among(table: DataFrame, keys: DataFrame, column: str = "node", key: str | None = None) -> DataFrame:
    """The rows of ``table`` that a Bloom filter of the ``keys`` (in their column ``key``, else
    ``column``) lets through: all of theirs and few others. Keeps the others out of the shuffle of a
    join that follows."""
    words = set_bits(keys.select(F.xxhash64(key or column).alias("h")), bits_for(keys.count()), repeated=False)
    return table.filter(all_set(table.sparkSession, words, F.xxhash64(column)))


def block_links(crowded: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) between the classes of long open lists (token, node, root), searched in blocks."""
    heads = crowded.groupBy("token").agg(F.min("node").alias("v"))
    star = crowded.join(heads, "token").select(F.col("node").alias("u"), "v")
    place = components(star, "groups").select(F.col("u").alias("node"), F.col("v").alias("bag"))
    nodes = crowded.select("node", "root").distinct().join(place, "node", "left")
    nodes = nodes.withColumn("bag", F.coalesce("bag", "node"))
    nodes = nodes.join(_among(sets, crowded.select("node")).select("node", "n", "set"), "node")
    share = nodes.groupBy("bag").agg(
        F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    nodes = nodes.join(share, "bag").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    nodes = nodes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    nodes = nodes.select(
        "bag", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"), "node", "root", "set",
    )

    def search(group: pa.Table) -> pa.Table:
        return _search_block(group, percent)

    return nodes.groupBy("bag", "first", "second").applyInArrow(search, "u long, v long")


def frequent_shingles(docs: DataFrame, text: Column, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(shingles ascending, counts) of the most frequent shingles over all documents.

    Each task counts its documents in chunks of a few million shingles and passes on what
    occurs twice in a chunk.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def emit() -> pa.RecordBatch:
            flat = np.sort(np.concatenate(held))
            start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
            n = np.diff(np.r_[start, len(flat)])
            keep = n >= 2
            return pa.RecordBatch.from_arrays(
                [pa.array(flat[start[keep]].view(np.int64)), pa.array(n[keep].astype(np.int64))], ["token", "n"]
            )

        for b in batches:
            for t in texts(b.column(0)):
                s = shingles(t, words)
                held.append(s)
                size += len(s)
                if size >= _CHUNK:
                    yield emit()
                    held, size = [], 0
        if size:
            yield emit()

    bound_arrow(docs.sparkSession)
    found = docs.select(text.alias("t")).mapInArrow(count, "token long, n long")
    top = found.groupBy("token").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "token").limit(FREQUENT)
    table = top.toArrow()
    token = table.column("token").to_numpy().astype(np.int64).view(np.uint64)
    n = table.column("n").to_numpy().astype(np.int64)
    order = np.argsort(token)
    return token[order], n[order]


def indexed(
    docs: DataFrame, text: Column, frequent: tuple[np.ndarray, np.ndarray], words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """docs plus struct ``s``: n, digest and sketch of the set, short and hot (shingles of the index part)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def batch(b: pa.Array) -> pa.Array:
        tokens, counts = shared.value
        size, digest, sketches, short, hot = [], [], [], [], []
        for t in texts(b):
            s = shingles(t, words)
            n = len(s)
            size.append(n)
            digest.append(xxhash.xxh3_128_digest(s.tobytes()) if n else None)
            sketches.append(sketch(s) if n else None)
            often = np.zeros(n, np.int64)
            if len(tokens) and n:
                at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
                often = np.where(tokens[at] == s, counts[at], 0)
            part = n - required(n, percent) + min(occurrences(n), required(n, percent)) if n else 0
            if not often.any():
                first, first_often = s[:part], often[:part]
            else:
                order = np.argsort(often, kind="stable")[:part]
                first, first_often = s[order], often[order]
            short.append(first[first_often < HOT].view(np.int64))
            hot.append(first[first_often >= HOT].view(np.int64))
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (short, hot)]
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sketches, pa.binary()), *lists],
            ["n", "digest", "sketch", "short", "hot"],
        )

    returns = "struct<n: long, digest: binary, sketch: binary, short: array<long>, hot: array<long>>"
    return with_struct(docs, "s", text, returns, batch)


def components(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): every node of the undirected ``edges`` (u, v) except a component's smallest, with
    that smallest one as v. Large-star and small-star steps until nothing changes."""
    e = written(edges.select("u", "v").filter(F.col("u") != F.col("v")).distinct(), name)
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return e
        seen = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").filter(F.col("u") != F.col("v")).distinct(), name)


def _t(n: Column, percent: int) -> Column:
    return F.least(F.lit(1) + F.floor(n / SHINGLES_PER_T), F.ceil(n * percent / 100))


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _linked_sets(a: pa.Array, b: pa.Array, percent: int) -> pa.Array:
    pairs = zip(a.to_pylist(), b.to_pylist(), strict=True)
    return pa.array([linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in pairs], pa.bool_())


def _best_pivots(n: pa.Array, pivots: pa.Array, percent: int) -> pa.Array:
    """The pivot met in most short lists, if it is met as often as the smallest partner asks for."""
    out = []
    for size, met in zip(n.to_pylist(), pivots.to_pylist(), strict=True):
        least = required(size, percent)
        least = min(occurrences(least), required(least, percent))
        found = merge_short([[p] for p in met], lambda _, least=least: least)
        out.append(min(found, key=lambda x: (-x[1], x[0]))[0] if found else None)
    return pa.array(out, pa.int64())


def _representatives(flat: DataFrame) -> DataFrame:
    """The rows of ``flat`` (row, digest, ...) with one row of each digest, its smallest, as ``node``.

    Only digests that several rows have, and a few others, go through a join.
    """
    names = written(flat.groupBy("digest").agg(F.min("row").alias("node"), F.count("*").alias("m")), "names")
    copied = names.filter(F.col("m") > 1).select(F.xxhash64("digest").alias("h"))
    hit = all_set(flat.sparkSession, set_bits(copied, bits_for(copied.count()), repeated=False), F.xxhash64("digest"))
    first = written(names.filter(hit).select(F.col("node").alias("row")), "first-rows")
    others = _among(flat.filter(hit), first, "row").join(first, "row", "left_semi").select(flat.columns)
    return flat.filter(~hit).union(others).withColumnRenamed("row", "node")


def _hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("c")]


def _with_sets(wanted: DataFrame, docs: DataFrame, text: Column, words: int) -> DataFrame:
    """``wanted`` (with h and c, hashes of the class's text) plus ``set``; few other texts move."""
    bits = set_bits(wanted.select("h"), bits_for(wanted.count()), repeated=False)  # as in _among
    source = docs.select(*_hashes(text), text.alias("text")).filter(all_set(docs.sparkSession, bits, F.col("h")))
    source = source.groupBy("h", "c").agg(F.first("text").alias("text"))

    def as_set(b: pa.Array) -> pa.Array:
        found = [shingles(t, words) for t in texts(b)]
        return pa.StructArray.from_arrays([pa.array([s.tobytes() for s in found], pa.binary())], ["set"])

    found = with_struct(wanted.join(source, ["h", "c"]), "s", F.col("text"), "struct<set: binary>", as_set)
    return found.select(*[c for c in wanted.columns if c not in ("h", "c")], F.col("s.set").alias("set"))


def classes_and_links(
    docs: DataFrame, text_col: str, words: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """(every row of docs plus its number and s, with n and digest; links as star edges u, v between
    the numbers that name classes).

    The rows carry whatever columns ``docs`` has besides the text.
    """

    @F.arrow_udf("boolean")
    def _linked(a: pa.Array, b: pa.Array) -> pa.Array:
        return _linked_sets(a, b, percent)

    @F.arrow_udf("long")
    def _best_pivot(n: pa.Array, pivots: pa.Array) -> pa.Array:
        return _best_pivots(n, pivots, percent)

    @F.arrow_udf("boolean")
    def _may_link(n: pa.Array, a: pa.Array, m: pa.Array, b: pa.Array) -> pa.Array:
        pairs = zip(*(c.to_pylist() for c in (n, a, m, b)), strict=True)
        return pa.array([may_link(*pair, percent) for pair in pairs], pa.bool_())

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    frequent = frequent_shingles(docs, text, words)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = indexed(docs.select(*rest, text.alias("__text"), F.struct(*_hashes(text)).alias("__key")), F.col("__text"), frequent, words, percent)
    # written: the number of a row is given once, whoever reads it
    rows = written(rows.drop("__text").withColumn("__row", F.monotonically_increasing_id()), "shingles")
    flat = rows.select(F.col("__row").alias("row"), "__key.h", "__key.c", *[F.col(f"s.{c}").alias(c) for c in ("n", "digest", "sketch", "short", "hot")])
    classes = _representatives(flat.filter(F.col("n") > 0))

    # lists of two or more classes, each with one pivot; only (shingle, node) moves
    short = classes.select("node", F.explode("short").alias("token"))
    w = Window.partitionBy("token")
    short = short.withColumn("pivot", F.min("node").over(w)).withColumn("m", F.count("*").over(w)).filter(F.col("m") > 1)
    hot = classes.select("node", F.explode("hot").alias("token"))
    heads = hot.groupBy("token").agg(F.min("node").alias("pivot"), F.count("*").alias("m")).filter(F.col("m") > 1)
    columns = ["token", "node", "pivot"]
    lists = written(short.select(columns).union(hot.join(heads, "token").select(columns)), "lists")

    # classes that meet others in as many lists as the smallest possible partner asks for
    least = _t(F.ceil(F.col("n") * percent / 100), percent)
    meets = lists.groupBy("node").agg(
        F.count("*").alias("c"), F.collect_list(F.when(F.col("pivot") != F.col("node"), F.col("pivot"))).alias("pivots")
    )
    meets = meets.join(classes.select("node", "n"), "node").filter(F.col("c") >= least)
    meets = written(meets.select("node", "n", _best_pivot("n", "pivots").alias("pivot")), "meets")
    wanted = _among(classes.select("node", "h", "c", "sketch"), meets).join(meets, "node")
    wanted = written(wanted, "wanted")

    # first round: each class against its best pivot
    own = wanted.filter(F.col("pivot").isNotNull())
    sketches = wanted.select("node", "n", "sketch")
    pivots = _among(sketches, own, "node", "pivot").select(*[F.col(c).alias(f"v_{c}") for c in sketches.columns])
    near = own.join(pivots, F.col("pivot") == F.col("v_node")).filter(_sizes_fit(F.col("n"), F.col("v_n"), percent))
    near = written(near.filter(_may_link("n", "sketch", "v_n", "v_sketch")).select("node", "pivot"), "near")
    members = near.select("pivot").withColumnRenamed("pivot", "node").union(near.select("node")).distinct().join(near, "node", "left")
    sets = written(_with_sets(wanted.select("node", "n", "h", "c").join(members, "node"), docs, text, words), "sets")
    own_sets = sets.filter(F.col("pivot").isNotNull()).select(F.col("node").alias("u"), F.col("pivot").alias("v"), F.col("set").alias("u_set"))
    pivot_sets = _among(sets, near, "node", "pivot").select(F.col("node").alias("v"), F.col("set").alias("v_set"))
    edges = components(own_sets.join(pivot_sets, "v").filter(_linked("u_set", "v_set")).select("u", "v"), "first")

    # second round: pairs of different components in lists that hold several
    place = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    alive = _among(lists.select("token", "node"), wanted).join(wanted.select("node", "n"), "node")
    alive = alive.join(place, "node", "left").withColumn("root", F.coalesce("root", "node"))
    alive = written(alive, "alive")
    mixed = alive.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("m"))
    mixed = written(mixed.filter(F.col("a") != F.col("b")).select("token", "m"), "mixed")
    open_ = written(_among(alive, mixed, "token").join(mixed, "token"), "open")
    crowded, few = open_.filter(F.col("m") > LONG_LIST), open_.filter(F.col("m") <= LONG_LIST)
    x, y = (few.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("n", "node", "root")]) for s in "xy")
    met = x.join(y, "token").filter(
        (F.col("x_node") < F.col("y_node")) & (F.col("x_root") != F.col("y_root")) & _sizes_fit(F.col("x_n"), F.col("y_n"), percent)
    )
    met = met.groupBy("x_node", "y_node", "x_n", "y_n").agg(F.count("*").alias("c"))
    met = met.filter(F.col("c") >= F.least(_t(F.col("x_n"), percent), _t(F.col("y_n"), percent)))
    tried = own.select(F.least("node", "pivot").alias("x_node"), F.greatest("node", "pivot").alias("y_node"))
    met = written(met.select("x_node", "y_node", "x_n", "y_n").join(tried, ["x_node", "y_node"], "left_anti"), "pairs")
    a, b = (_among(sketches, met, "node", f"{s}_node").select(F.col("node").alias(f"{s}_node"), F.col("sketch").alias(f"{s}_sketch")) for s in "xy")
    met = met.join(a, "x_node").join(b, "y_node").filter(_may_link("x_n", "x_sketch", "y_n", "y_sketch"))
    met = written(met.select("x_node", "y_node"), "close")
    needed = met.select(F.explode(F.array("x_node", "y_node")).alias("node")).union(crowded.select("node")).distinct()
    needed = written(needed.join(wanted.select("node", "n", "h", "c"), "node"), "needed")
    more = written(_with_sets(needed, docs, text, words), "more-sets")
    a, b = (_among(more, met, "node", f"{s}_node").select(F.col("node").alias(f"{s}_node"), F.col("set").alias(s)) for s in "xy")
    found = met.join(a, "x_node").join(b, "y_node").filter(_linked("x", "y")).select(F.col("x_node").alias("u"), F.col("y_node").alias("v"))
    if not crowded.isEmpty():
        found = found.union(block_links(crowded.select("token", "node", "root"), more, percent))
    found = written(found, "links")
    return rows, edges if found.isEmpty() else components(edges.union(found), "second")


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: str = "__near_", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The columns of ``docs`` but the text, plus n_shingles, component_id and root (the
    component's number, null without words) named by ``prefix``.

    Null and empty texts and texts without words have no shingle and link with nothing. A
    null id never names a component that has another id. Repeated rows are equal sets.
    Other columns pass unchanged. An empty table gives an empty table.
    """
    rows, edges = classes_and_links(docs, text_col, words, percent)
    ident = F.col(f"`{id_col}`")
    node = rows.filter(F.col("s.n") > 0).groupBy(F.col("s.digest").alias("digest")).agg(F.min(ident).alias("low"), F.min("__row").alias("node"))
    node = node.join(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    node = node.select("digest", F.coalesce("root", "node").alias("root"), "low")
    roots = node.groupBy("root").agg(F.min("low").alias("component"))
    node = node.join(roots, "root").select(
        F.col("digest").alias("__digest"), F.col("component").alias(f"{prefix}component_id"), F.col("root").alias(f"{prefix}root")
    )
    out = rows.join(node, F.col("s.digest") == F.col("__digest"), "left")
    component = F.when(F.col("s.n") > 0, F.col(f"{prefix}component_id")).otherwise(ident)
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    return out.select(*rest, F.col("s.n").alias(f"{prefix}n_shingles"), component.alias(f"{prefix}component_id"), f"{prefix}root")


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    out = grouped(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("__near_n_shingles").alias("n_shingles"), F.col("__near_component_id").alias("component_id"))


def representatives(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: its smallest id, the smaller
    text hash among equal ids, one of repeated rows. Documents without words all stay."""
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.concat_ws("-", F.xxhash64(text), F.crc32(text.cast("binary")))
    has_word = text.rlike(r"[^\x20\x09-\x0D]")
    some = docs.filter(has_word)
    marked = grouped(some.select(ident.alias("id"), key.alias("k"), text.alias("t")), "id", "t", words=words, percent=percent)
    best = marked.groupBy("__near_root").agg(F.min(F.struct(F.col("id").isNull(), "id", "k")).alias("b"))
    kept = best.select(F.col("b.id").alias("__id"), F.col("b.k").alias("__k"))
    whole = some.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), ident.alias("id"), key.alias("k"))
    found = whole.join(kept, F.col("id").eqNullSafe(F.col("__id")) & (F.col("k") == F.col("__k")))
    found = found.dropDuplicates(["__id", "__k"]).select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    return docs.filter(~has_word).union(found)
