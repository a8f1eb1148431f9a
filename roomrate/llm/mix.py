"""Mixing sources to target weights by systematic sampling (operator 9).

Within a source every document has the same expected number of copies, target words by
source words. Documents are put in a fixed order (by size class, then by a hash of the
id), their expected copies are prefix-summed, one random offset per source is added, and
a document is emitted once for each integer its interval crosses. Sorting by size first
keeps the words taken near the target even when sizes differ widely.

Prefix sums are two-level: counts per cell (source, size class, 256 id buckets) are
summed over the few thousand cells of a source, and row numbers are taken inside a cell,
so a source with a third of all rows is spread over thousands of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, written

WEIGHTS = (3, 1, 2)
SHARE_NUM, SHARE_DEN = 3, 2  # the mix has 150 % of all words
CAP = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, rate, offset) of a table (source, size); null is a source.

    Targets follow the weights, capped at ``CAP`` times the source, the excess reshared by
    weight: the capped sources are a prefix in the order of cap by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on
    s = s.withColumn("w", F.element_at(weights, ((F.row_number().over(by_name) - 1) % len(WEIGHTS)) + 1))
    s = s.withColumn("cap", F.col("source_size") * CAP)
    s = s.withColumn("goal", F.sum("source_size").over(total) * SHARE_NUM).withColumn("w_all", F.sum("w").over(total))
    left = F.col("goal") - SHARE_DEN * F.coalesce(F.sum("cap").over(ratio), F.lit(0))
    w_left = F.col("w_all") - F.coalesce(F.sum("w").over(ratio), F.lit(0))
    s = s.withColumn("capped", left * F.col("w") >= SHARE_DEN * F.col("cap") * w_left)
    rest = F.col("goal") - SHARE_DEN * F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(total)
    w_rest = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(total)
    s = s.withColumn("rest", rest).withColumn("w_rest", w_rest)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("rest") * F.col("w")).cast("double") / (F.lit(SHARE_DEN) * F.col("w_rest")).cast("double")
    )
    s = s.withColumn("target", target)
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-"))).cast("binary"))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(0.0)
    return s.select("source", "source_size", "target", rate.alias("rate"), offset.alias("offset"))


def sampled(rows: DataFrame) -> DataFrame:
    """``rows`` (id, tie, source, size, and any columns carried along) plus source_size, target
    and copies. The input is read three times: pass a written table."""
    bits = F.length(F.bin(F.col("size")))
    step = F.floor(F.col("size") / F.pow(F.lit(2), F.greatest(bits - 3, F.lit(0)))) % 4
    keyed = rows.withColumns({
        "key": F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")),  # null as a key of its own
        "cls": (bits * 4 + step).cast("int"),
        "bucket": F.substring(F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), 1, 2),
    })
    before = Window.partitionBy("key").orderBy("cls", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = keyed.groupBy("key", "cls", "bucket").agg(F.count("*").alias("n"))
    cells = cells.select("key", "cls", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    t = source_targets(rows.select("source", "size")).withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    cells = cells.join(t.drop("source"), "key")
    # rows move once: window and join share the partitioning by cell
    inside = Window.partitionBy("key", "cls", "bucket").orderBy("size", F.col("id").asc_nulls_first(), "tie")
    ranked = keyed.withColumn("rn", F.row_number().over(inside)).join(cells, ["key", "cls", "bucket"])
    upto = lambda k: F.floor((F.col("start") + F.col("rn") - k).cast("double") * F.col("rate") + F.col("offset"))
    copies = F.least(upto(0) - upto(1), F.lit(CAP)).cast("int")
    return ranked.withColumn("copies", copies).drop("key", "rn", "cls", "bucket", "start", "rate", "offset")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text = F.col(f"`{text_col}`")
    return [
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("tie"),
        F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
    ]


def taken(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    Null text and empty text have size 0 and are taken 0 times or with 0 words; null is a
    source of its own, last in order; repeated rows are documents of their own. An empty
    table gives an empty table.
    """
    thin = written(docs.select(*_rows(docs, "doc_id", "text", "source")), "mix")
    return sampled(thin).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with its own columns."""
    whole = F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("row")
    rows = docs.select(*_rows(docs, id_col, text_col, source_col), whole)
    out = sampled(rows).filter(F.col("copies") > 0)
    out = out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return out.select(*[F.col("row").getField(x).alias(x) for x in docs.columns])


SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s
), a AS (
  SELECT *, 2 * source_size AS cap, (sum(source_size) OVER () * 3)::BIGINT AS goal, (sum(w) OVER ())::BIGINT AS w_all FROM w
), p AS (
  SELECT *, coalesce(sum(cap) OVER o, 0)::BIGINT AS c_before, coalesce(sum(w) OVER o, 0)::BIGINT AS w_before FROM a
  WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), q AS (
  SELECT *, (goal - 2 * c_before) * w >= 2 * cap * (w_all - w_before) AS capped FROM p
), r AS (
  SELECT *, (goal - 2 * sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT AS rest,
         (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::BIGINT AS w_rest FROM q
), t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE ELSE (rest * w)::DOUBLE / (2 * w_rest)::DOUBLE END AS target,
         ('0x' || substr(md5('{SEED}' || coalesce('s' || source, '-')), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM r
), k AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY
           length(bin(d.size)) * 4 + (d.size >> greatest(length(bin(d.size)) - 3, 0)) % 4,
           substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 2), d.size, d.doc_id) AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(i::DOUBLE * rate + u) - floor((i - 1)::DOUBLE * rate + u), 2) * size)::BIGINT AS taken FROM k
"""
