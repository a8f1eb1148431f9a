"""URL filters by a bit-parallel wildcard automaton (operator 2).

A rule (host suffix, path prefix) becomes a glob over the canonical URL
``.host<SEP>path``: ``*.host<SEP>prefix*``. All globs are packed side by side into one
multiword Shift-And state. A step reads one byte of every URL of a batch and advances
all globs at once: state = ((state & mask[byte]) << 1) | (state & loops), where ``loops``
holds the positions on which a ``*`` stands.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, with_struct

#: Stands between host and path in a canonical URL; taken out of both before.
SEP = "\x01"
#: Production rules of the query: (verdict, host suffix, path prefix).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


class GlobSet:
    """Globs (``*`` any run, ``?`` any byte, the rest literal) as Shift-And masks."""

    def __init__(self, globs: Sequence[str]):
        step, loop, start, end = [], [], [], []  # by position: bytes that lead on, and whether a * stands here
        for g in globs:
            start.append(len(step))
            step.append(None)
            loop.append(False)
            for b in g.encode():
                if b == ord("*"):
                    loop[-1] = True
                else:
                    step[-1] = b
                    step.append(None)
                    loop.append(False)
            end.append(len(step) - 1)
        self.words = max(1, -(-len(step) // 64))
        self.masks = np.zeros((256, self.words), np.uint64)
        self.loops, self.first = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.ends = np.array(end, np.int64)
        for p, b in enumerate(step):
            bit = np.uint64(1 << (p % 64))
            if b == ord("?"):
                self.masks[:, p // 64] |= bit
            elif b is not None:
                self.masks[b, p // 64] |= bit
            if loop[p]:
                self.loops[p // 64] |= bit
        for p in start:
            self.first[p // 64] |= np.uint64(1 << (p % 64))

    def match(self, strings: Sequence[bytes]) -> np.ndarray:
        """Boolean (strings, globs): which glob fits the whole string."""
        size = np.array([len(s) for s in strings], np.int64)
        order = np.argsort(-size, kind="stable")
        flat = np.frombuffer(b"".join(strings) or b"\0", np.uint8)
        at = (np.cumsum(size) - size)[order]
        state = np.repeat(self.first[None, :], len(strings), axis=0)
        live = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1), side="right")
        for j, k in enumerate(live):  # k strings are longer than j
            s = state[:k]
            on = s & self.masks[flat[at[:k] + j]]
            up = on << np.uint64(1)
            up[:, 1:] |= on[:, :-1] >> np.uint64(63)
            state[:k] = up | (s & self.loops)
        fits = (state[:, self.ends // 64] >> (self.ends % 64).astype(np.uint64)) & np.uint64(1)
        out = np.zeros(fits.shape, bool)
        out[order] = fits.astype(bool)
        return out


def judge(pages: DataFrame, url_col: str = "url", rules=RULES, default: str = "allow", name: str = "__url") -> DataFrame:
    """Every row of ``pages`` plus struct ``name`` (host, path, rule, verdict).

    Null urls and urls without ``://`` have empty host and path; no rule fits them. The
    longest fitting rule (host and path text) wins, the first of equals; without one, rule
    is null and the verdict is ``default``. Rows are judged one by one, so repeated rows,
    empty tables and other columns need no care.
    """
    url = F.col(f"`{url_col}`")
    cut = F.locate("://", url)
    rest = F.when(cut > 0, F.substring(url, cut + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.translate(host, upper, upper.lower())
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    clean = lambda c: F.translate(c, SEP, "\x02")
    canonical = F.concat(F.lit("."), clean(low), F.lit(SEP), clean(path))
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    kinds, names = [r[0] for r in ranked], [r[1] + r[2] for r in ranked]
    globs = [f"*.{h}{SEP}{p}*" for _, h, p in ranked]

    def batch(b: pa.Array, automaton: GlobSet) -> pa.Array:
        fits = automaton.match(texts(b))
        best = np.where(fits.any(axis=1), fits.argmax(axis=1), -1)
        return pa.StructArray.from_arrays(
            [
                pa.array([names[i] if i >= 0 else None for i in best], pa.string()),
                pa.array([kinds[i] if i >= 0 else default for i in best], pa.string()),
            ],
            ["rule", "verdict"],
        )

    out = with_struct(pages, "__hit", canonical, "rule string, verdict string", batch, lambda: GlobSet(globs))
    return out.withColumn(
        name, F.struct(low.alias("host"), path.alias("path"), F.col("__hit.rule").alias("rule"), F.col("__hit.verdict").alias("verdict"))
    ).drop("__hit")


def verdicts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    j = judge(pages.select("page_id", "url"))
    return j.select("page_id", *[F.col(f"__url.{x}").alias(x) for x in ("host", "path", "rule", "verdict")])


SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r AS (
  SELECT *, '.' || host AS dotted FROM p
), m AS (
  SELECT *, CASE WHEN ends_with(dotted, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                 WHEN ends_with(dotted, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                 WHEN ends_with(dotted, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                 WHEN ends_with(dotted, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM r
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM m
"""
