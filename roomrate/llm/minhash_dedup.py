"""MinHash near-dedup (operator 11).

A document is its set of hashed shingles of ``words`` words. ``HASHES`` universal hash functions
(multiply-shift) each keep their smallest value over the set: the signature. Two sets agree in
each place of the signature with the probability of their Jaccard similarity. The signature is
cut into bands of ``band_rows`` places; sets that agree in a whole band share its bucket. Bands are as
long as may be while a pair at the threshold shares no bucket with a probability of at most
``MISS`` (at 0.85: 32 bands of 4 places, 6e-11).

Equal sets are one class. Candidates are verified twice: by their signatures, which must agree
in ``least_agreement`` places (missed by a linked pair with a probability of at most ``UNSURE``),
and then exactly, on the full sets, so every link is a true one.

Candidates are not emitted as pairs. First, each bucket names its smallest class as head, and a
class is compared with the head that it shares most buckets with; the links become connected
components. Then only buckets that still hold two or more components matter. Classes that such
buckets chain together form a bag; a bag is compared inside one task, or, if it is large, in
pairs of blocks of bounded size, skipping what is known to be one component. So every pair that
shares a bucket and could join two components is verified.

Connected components alternate large-star and small-star steps until no edge changes.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts, with_struct, written
from .exact_dedup import all_set, bits_for, set_bits
from .ngram_join import linked, shingles

#: Words of a shingle and least similarity in hundredths of the operator's query.
WORDS, PERCENT = 3, 85
HASHES = 128
#: Largest probability that a pair at the threshold shares no bucket.
MISS = 1e-7
#: Largest probability that the signatures of a pair at the threshold speak against it.
UNSURE = 1e-10
#: A block holds about so many classes and shingles at most (two of them meet in a task).
BLOCK_SETS, BLOCK_SHINGLES = 1500, 1_000_000
#: Candidates of a set that are probed one by one; more are counted by inverted lists.
FEW = 16
_CHUNK = 1 << 16


@lru_cache
def hash_functions(count: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and addends of the hash functions, from a fixed sequence (splitmix64)."""
    out, state, mask = [], 0, (1 << 64) - 1
    for _ in range(2 * count):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    found = np.array(out, np.uint64)
    return found[:count] | np.uint64(1), found[count:]


@lru_cache
def band_rows(percent: int) -> int:
    """Places of a band: the longest band that misses a pair at the threshold with at most ``MISS``."""
    fits = [r for r in (1, 2, 4, 8, 16, 32) if (1 - (percent / 100) ** r) ** (HASHES // r) <= MISS]
    return max(fits, default=1)


@lru_cache
def least_agreement(percent: int) -> int:
    """Places in which the signatures of a pair at the threshold agree but for ``UNSURE``."""
    p, total = percent / 100, 0.0
    for k in range(HASHES + 1):
        total += math.comb(HASHES, k) * p**k * (1 - p) ** (HASHES - k)
        if total > UNSURE:
            return k
    return HASHES


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest value of each hash function over each set, one row per set (all ones if empty)."""
    a, b = hash_functions()
    out = np.full((len(sets), len(a)), 0xFFFFFFFF, np.uint32)
    place = [i for i, s in enumerate(sets) if len(s)]
    while place:
        size, n = 0, 0
        while n < len(place) and (n == 0 or size + len(sets[place[n]]) <= _CHUNK):
            size += len(sets[place[n]])
            n += 1
        own, place = place[:n], place[n:]
        flat = np.concatenate([sets[i] for i in own])
        flat = (flat ^ (flat >> np.uint64(32))) & np.uint64(0xFFFFFFFF)
        start = np.r_[0, np.cumsum([len(sets[i]) for i in own])[:-1]]
        hashed = np.empty_like(flat)
        for k in range(len(a)):
            np.multiply(flat, a[k], out=hashed)
            hashed += b[k]
            hashed >>= np.uint64(32)
            out[own, k] = np.minimum.reduceat(hashed, start)
    return out


def signed(docs: DataFrame, text: str, words: int) -> DataFrame:
    """docs plus struct ``__set``: n (size of the set), node (its digest), sig; both null if empty."""

    def batch(b: pa.Array) -> pa.Array:
        sets = [shingles(t, words) for t in texts(b)]
        sigs = signatures(sets)
        node = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        sig = [g.tobytes() if len(s) else None for s, g in zip(sets, sigs, strict=True)]
        return pa.StructArray.from_arrays(
            [pa.array([len(s) for s in sets], pa.int64()), pa.array(node, pa.binary()), pa.array(sig, pa.binary())], ["n", "node", "sig"]
        )

    return with_struct(docs, "__set", F.col(text), "struct<n: long, node: binary, sig: binary>", batch)


def star_edges(edges: DataFrame, name: str) -> DataFrame:
    """(u, v): every node of the undirected ``edges`` (u, v) but the smallest of its component, with
    that smallest node as v."""

    def least(pairs: DataFrame) -> DataFrame:  # written, so that the join below meets two plain tables and a hot node is split
        low = pairs.groupBy("u").agg(F.min("v").alias("m"))
        return written(low.select("u", F.least("u", "m").alias("m")), f"{name}-least")

    def cleaned(pairs: DataFrame) -> DataFrame:
        return written(pairs.filter(F.col("u") != F.col("v")).distinct(), name)

    now, before = cleaned(edges.select("u", "v")), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now
        before = state
        # large-star: the larger neighbours of a node go to the smallest of its neighbourhood
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least(both), "u").filter(F.col("v") > F.col("u"))
        large = cleaned(large.select(F.col("v").alias("u"), F.col("m").alias("v")))
        # small-star: a node and its smaller neighbours go to the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = least(down)
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        now = cleaned(small)


class _Lists:
    """Inverted lists of a block's sets, for the overlaps of one set with all of them."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.count = len(sets)
        self.postings = np.repeat(np.arange(self.count), [len(s) for s in sets])[order]
        self.tokens, self.start = np.unique(flat[order], return_index=True)
        self.end = np.r_[self.start[1:], len(flat)]

    def overlaps(self, query: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        met = [self.postings[self.start[i] : self.end[i]] for i in at]
        return np.bincount(np.concatenate(met), minlength=self.count) if met else np.zeros(self.count, np.int64)


def confirmed(
    sets: list[np.ndarray], sigs: np.ndarray, parts: list, queries: np.ndarray, index: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links (query, indexed) that join different parts; ``queries`` equal to ``index`` meets pairs once."""
    same, least = queries is index, least_agreement(percent)
    size = np.array([len(s) for s in sets], np.int64)
    number = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part = np.array([number[p] for p in parts], np.int64)
    lists, found = None, []
    for k, q in enumerate(queries.tolist()):
        at = np.arange(k if same else len(index))
        o, n = index[at], size[q]
        fit = (part[o] != part[q]) & (100 * np.minimum(size[o], n) >= percent * np.maximum(size[o], n))
        at, o = at[fit], o[fit]
        agree = (sigs[o] == sigs[q]).sum(axis=1)
        at, o = at[agree >= least], o[agree >= least]
        if len(o) > FEW:
            lists = lists or _Lists([sets[i] for i in index])
            both = lists.overlaps(sets[q])[at]
            o = o[100 * both >= percent * (n + size[o] - both)]
        else:
            o = [j for j in o.tolist() if linked(sets[q], sets[j], percent)]
        for j in o:
            if part[j] != part[q]:
                part[part == part[j]] = part[q]
                found.append((q, int(j)))
    return found


def _search(group: pa.Table, percent: int) -> pa.Table:
    """Links of the bags of a cell: whole bags, or one pair of blocks of a large bag."""
    rows = sorted(group.select(["bag", "side", "node", "root", "sig", "set"]).to_pylist(), key=lambda r: (r["bag"], r["side"], r["node"]))
    across = group.num_rows and group.column("first")[0].as_py() != group.column("second")[0].as_py()
    sets = [np.frombuffer(r["set"], np.uint64) for r in rows]
    sigs = np.array([np.frombuffer(r["sig"], np.uint32) for r in rows]).reshape(len(rows), -1)
    bags = np.array([r["bag"] for r in rows], object)
    found, start = [], 0
    while start < len(rows):
        end = start
        while end < len(rows) and bags[end] == bags[start]:
            end += 1
        at = range(start, end)
        index = np.array([i - start for i in at if rows[i]["side"] == 0], np.int64)
        queries = np.array([i - start for i in at if rows[i]["side"] == 1], np.int64) if across else index
        if len(index) and len(queries):
            links = confirmed([sets[i] for i in at], sigs[start:end], [rows[i]["root"] for i in at], queries, index, percent)
            found += [(rows[start + i]["node"], rows[start + j]["node"]) for i, j in links]
        start = end
    return pa.table([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], names=["u", "v"])


def bag_links(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) among the classes of open ``buckets`` (key, node, root), compared in blocks."""
    heads = written(buckets.groupBy("key").agg(F.min("node").alias("v")), "open-heads")
    place = star_edges(buckets.join(heads, "key").select(F.col("node").alias("u"), "v"), "bags")
    nodes = buckets.select("node", "root").distinct()
    nodes = nodes.join(place.select(F.col("u").alias("node"), F.col("v").alias("bag")), "node", "left")
    nodes = nodes.join(sets.select("node", "n"), "node").withColumn("bag", F.coalesce("bag", "node"))
    nodes = written(nodes, "bagged")
    share = nodes.groupBy("bag").agg(F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    share = written(share, "bag-sizes")
    cells = max(1, (nodes.agg(F.sum("n")).first()[0] or 0) // BLOCK_SHINGLES)
    nodes = nodes.join(share, "bag").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    nodes = nodes.join(sets.select("node", "sig", "set"), "node")
    nodes = nodes.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("bag"), F.lit(cells)).cast("string")).otherwise(F.hex("bag"))
    nodes = nodes.select(
        cell.alias("cell"), F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "bag",
        F.when(F.col("block") > F.col("other"), 1).otherwise(0).alias("side"), "node", "root", "sig", "set",
    )

    def search(group: pa.Table) -> pa.Table:
        return _search(group, percent)

    return nodes.groupBy("cell", "first", "second").applyInArrow(search, "u binary, v binary")


def _sets_of(docs: DataFrame, wanted: DataFrame, ident: Column, text: Column, key: Column, words: int) -> DataFrame:
    """``wanted`` (with rep: id and key of a row that has the set) plus ``set``, its sorted shingles."""
    bits = set_bits(wanted.select(F.xxhash64("rep").alias("h")), bits_for(wanted.count()), repeated=False)
    source = docs.select(F.struct(ident.alias("id"), key.alias("key")).alias("rep"), text.alias("text"))
    source = source.filter(all_set(docs.sparkSession, bits, F.xxhash64("rep")))  # keeps most other texts out of the shuffle
    known = wanted.withColumnRenamed("rep", "wanted")
    same = (F.col("rep.key") == F.col("wanted.key")) & F.col("rep.id").eqNullSafe(F.col("wanted.id"))
    found = source.join(known, same).drop("rep", "wanted").dropDuplicates(["node"])  # repeated rows have one id and text

    def batch(b: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array([shingles(t, words).tobytes() for t in texts(b)], pa.binary())], ["set"])

    out = with_struct(found, "__full", F.col("text"), "struct<set: binary>", batch)
    return out.select(*[c for c in found.columns if c != "text"], F.col("__full.set").alias("set"))


def components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(rows: row, id, key, n, node; classes with components: node, root, component)."""
    ident, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    key = F.struct(F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("c"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = (F.struct(*rest) if rest else F.lit(None)).alias("row")
    rows = signed(docs.select(row, ident.alias("id"), key.alias("key"), text.alias("text")), "text", words)
    rows = written(rows.select("row", "id", "key", "__set.n", "__set.node", "__set.sig"), "signatures")
    rep = F.min(F.struct("id", "key")).alias("rep")
    classes = rows.filter(F.col("n") > 0).groupBy("node").agg(F.min("id").alias("low"), rep, F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = written(classes, "classes")

    size = band_rows(percent)
    bands = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", 4 * size * i + 1, 4 * size)) for i in range(HASHES // size)])
    bands = classes.select("node", F.explode(bands).alias("key"))
    heads = bands.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("m")).filter(F.col("m") > 1)
    heads = written(heads.select("key", "head"), "heads")
    buckets = written(bands.join(heads, "key"), "buckets")

    met = buckets.filter(F.col("node") != F.col("head")).groupBy("node", "head").agg(F.count("*").alias("c"))
    best = met.groupBy("node").agg(F.max(F.struct("c", "head"))["head"].alias("head"))
    members = buckets.select("node").distinct().join(best, "node", "left")
    wanted = written(classes.select("node", "n", "sig", "rep").join(members, "node"), "wanted")
    sets = written(_sets_of(docs, wanted, ident, text, key, words), "sets")

    @F.arrow_udf("boolean")
    def near(a_sig: pa.Array, b_sig: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y, s, t in zip(*(c.to_pylist() for c in (a_sig, b_sig, a, b)), strict=True):
            agree = (np.frombuffer(x, np.uint32) == np.frombuffer(y, np.uint32)).sum() >= least_agreement(percent)
            out.append(bool(agree) and linked(np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64), percent))
        return pa.array(out, pa.bool_())

    own = sets.filter(F.col("head").isNotNull()).select(F.col("node").alias("u"), F.col("head").alias("v"), F.col("sig").alias("u_sig"), F.col("set").alias("u_set"))
    other = sets.select(F.col("node").alias("v"), F.col("sig").alias("v_sig"), F.col("set").alias("v_set"))
    other = other.join(own.select("v").distinct(), "v", "left_semi")
    first = own.join(other, "v").filter(near("u_sig", "v_sig", "u_set", "v_set")).select("u", "v")
    edges = star_edges(first, "first")

    place = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    placed = buckets.select("key", "node").join(place, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = written(placed, "placed")
    mixed = placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter(F.col("a") != F.col("b"))
    open_ = written(placed.join(written(mixed.select("key"), "mixed"), "key", "left_semi"), "open")
    if not open_.isEmpty():
        more = written(bag_links(open_, sets, percent), "links")
        if not more.isEmpty():
            edges = star_edges(edges.union(more), "second")

    place = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    node = classes.select("node", "low").join(place, "node", "left").withColumn("root", F.coalesce("root", "node"))
    roots = written(node.groupBy("root").agg(F.min("low").alias("component")), "roots")
    return rows, written(node.join(roots, "root").select("node", "root", "component"), "components")


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, prefix: str = "__near_"
) -> DataFrame:
    """The columns of ``docs`` but the text, plus ``n_shingles``, ``component_id`` (smallest id
    reachable by links), ``kept`` (the id is the component's) and ``root`` (the component's name
    among sets, null without words) named by ``prefix``.

    Null and empty texts and texts without words have no shingle, link with nothing and are kept.
    A null id never names a component that has another id, and is kept only if none has. Repeated
    rows are equal sets and alike. Texts of any length count whole. An empty table gives an empty
    table. Other columns, whatever their names, pass unchanged.
    """
    rows, node = components(docs, id_col, text_col, words, percent)
    node = node.select(F.col("node").alias("x"), "root", "component")
    out = rows.join(node, F.col("node") == F.col("x"), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c != text_col],
        F.col("n").alias(f"{prefix}n_shingles"), component.alias(f"{prefix}component_id"),
        F.col("id").eqNullSafe(component).alias(f"{prefix}kept"), F.col("root").alias(f"{prefix}root"),
    )


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    out = grouped(docs.select("doc_id", "text"))
    return out.select("doc_id", *[F.col(f"__near_{c}").alias(c) for c in ("n_shingles", "component_id", "kept")])
