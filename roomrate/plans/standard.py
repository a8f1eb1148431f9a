"""JOB_E, JOB_F, JOB_G: community standard-room prices from two sources.

The group statistics are computed once per group (``group_quantiles``) and,
where the row-level frame is wanted, attached back to the rows; the
reconciliation works on the one-row-per-group tables directly, which equals
the full join of row-level frames followed by ``distinct`` (the projection
keeps only group-constant columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.operators.grouped import attach, group_quantiles, group_sums, mean_of
from roomrate.operators.joins import join_null_safe
from roomrate.operators.scoring import TreeModel, numeric_features, score

GROUP = ["city", "block", "community"]

# fixed values: feature order of the own-listing model (19)
OWN_FEATURES = (
    "bedroom_num_x", "toilet_num_x", "living_area_x", "has_balcony_x", "price_x", "face_x", "has_toilet_x",
    "bedroom_num_y", "toilet_num_y", "living_area_y", "has_balcony_y", "face_y", "has_toilet_y",
    "city_level", "area_xy_dev", "face_xy_dev", "bedroom_xy_dev", "has_toilet_xy_dev", "has_balcony_xy_dev",
)
# fixed values: feature order of the crawl model (20)
CRAWL_FEATURES = (
    "area_y", "bathroom_y", "face_y", "balcony_y", "style_y", "bedroomnum_y",
    "area_x", "bathroom_x", "face_x", "balcony_x", "style_x", "bedroomnum_x", "price_x",
    "city_level", "area_xy_dev", "face_xy_dev", "bathroom_xy_dev", "balcony_xy_dev", "style_xy_dev", "bedroomnum_xy_dev",
)
# fixed values: the crawl city whose communities use the 0.65 quantile
QUANTILE_65_CITY = "北京"


def own_deviations(pairs: DataFrame) -> DataFrame:
    """PRJ6: standard minus listing, five features."""
    return pairs.withColumns(
        {
            "area_xy_dev": F.col("living_area_y") - F.col("living_area_x"),
            "face_xy_dev": F.col("face_y") - F.col("face_x"),
            "has_toilet_xy_dev": F.col("has_toilet_y") - F.col("has_toilet_x"),
            "has_balcony_xy_dev": F.col("has_balcony_y") - F.col("has_balcony_x"),
            "bedroom_xy_dev": F.col("bedroom_num_y") - F.col("bedroom_num_x"),
        }
    )


def crawl_deviations(pairs: DataFrame) -> DataFrame:
    """PRJ7: standard minus crawl listing, six features."""
    return pairs.withColumns(
        {
            "area_xy_dev": F.col("area_y") - F.col("area_x"),
            "face_xy_dev": F.col("face_y") - F.col("face_x"),
            "bathroom_xy_dev": F.col("bathroom_y") - F.col("bathroom_x"),
            "style_xy_dev": F.col("style_y") - F.col("style_x"),
            "balcony_xy_dev": F.col("balcony_y") - F.col("balcony_x"),
            "bedroomnum_xy_dev": F.col("bedroomnum_y") - F.col("bedroomnum_x"),
        }
    )


def _scored(pairs: DataFrame, devs: DataFrame, features, model: TreeModel) -> DataFrame:
    # the deviations exist only inside the feature block: the output keeps the
    # extract's own columns plus the prediction
    pred = score(model, numeric_features(devs, features))
    return devs.select(*pairs.columns, (F.col("price_x") + pred).alias("std_room_outprice_pre"))


def own_scored(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """SCR1: listing price + predicted gap to the standard room."""
    return _scored(pairs, own_deviations(pairs), OWN_FEATURES, model)


def crawl_scored(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """SCR2: crawl price + predicted gap to the standard room."""
    return _scored(pairs, crawl_deviations(pairs), CRAWL_FEATURES, model)


def own_group_prices(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """WIN1 per group: median standard price of each (city, block, community); a missing price fails the run."""
    return group_quantiles(own_scored(pairs, model), GROUP, "std_room_outprice_pre", {"final_std_room_outprice_pre": 0.5}, na_fails=True)


def crawl_group_prices(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """WIN2 per group: 0.65 quantile for city '北京', 0.6 otherwise (NULL city: NULL); a missing price fails the run."""
    q = group_quantiles(crawl_scored(pairs, model), GROUP, "std_room_outprice_pre", {"__q60": 0.6, "__q65": 0.65}, na_fails=True)
    city = F.col("city")
    final = F.when(city.isNull(), F.lit(None).cast("double")).when(city == QUANTILE_65_CITY, F.col("__q65")).otherwise(F.col("__q60"))
    return q.select(*GROUP, final.alias("final_std_room_outprice_pre"))


def own_standard_prices(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """JOB_E: extract A rows with their standard price and their group's median (30 columns)."""
    scored = own_scored(pairs, model)
    return attach(scored, own_group_prices(pairs, model), GROUP)


def crawl_standard_prices(pairs: DataFrame, model: TreeModel) -> DataFrame:
    """JOB_F: extract B rows with their standard price and their group's quantile (20 columns)."""
    scored = crawl_scored(pairs, model)
    return attach(scored, crawl_group_prices(pairs, model), GROUP)


def reconciled_pairs(own_groups: DataFrame, crawl_groups: DataFrame) -> DataFrame:
    """JN10: full join of the two sources on (city, community), NULL matching NULL.

    Columns: city, own_block (NULL for crawl-only communities), community,
    final_own, final_crawl; distinct, as after the reference's ``distinct()``.
    ``own_groups`` has one row per (city, block, community) (the output of
    ``own_group_prices``), so it needs no dedup; the crawl side drops its block
    and is deduplicated.
    """
    own = own_groups.select(
        "city", F.col("block").alias("own_block"), "community", F.col("final_std_room_outprice_pre").alias("final_own")
    )
    crawl = crawl_groups.select("city", "community", F.col("final_std_room_outprice_pre").alias("final_crawl")).distinct()
    full = join_null_safe(own, crawl, ["city", "community"], "full")
    return full.select("city", "own_block", "community", "final_own", "final_crawl").distinct()


def block_prices(rows: DataFrame) -> DataFrame:
    """WIN3 + ENC15 per group: one block price per (city, own_block)."""
    sums = group_sums(rows, ["city", "own_block"], {"final_own": "final_own", "final_crawl": "final_crawl"})
    return sums.select("city", "own_block", F.coalesce(mean_of("final_own"), mean_of("final_crawl")).alias("block_std_price"))


def community_prices(rows: DataFrame) -> DataFrame:
    """ENC14: the community price(s) per (city, community), own listings first.

    A distinct, written as a count that the price depends on: over a plain distinct the
    optimizer drops the distinct of ``reconciled_pairs`` below it, and moves a filter on the
    price under it, and the full join would no longer be shared with ``block_prices``.
    """
    price = F.coalesce("final_own", "final_crawl").alias("__price")
    found = rows.groupBy("city", "community", price).agg(F.count("*").alias("__n"))
    return found.select("city", "community", F.when(F.col("__n") > 0, F.col("__price")).alias("xiaoqu_std_price_final"))


def reconcile(own_groups: DataFrame, crawl_groups: DataFrame) -> DataFrame:
    """JOB_G: one price per community and block, own listings first (ENC14, ENC15, WIN3)."""
    rows = reconciled_pairs(own_groups, crawl_groups)
    block = ["city", "own_block"]
    return (
        attach(rows, block_prices(rows), block)
        .select(
            "city",
            "own_block",
            "community",
            F.coalesce("final_own", "final_crawl").alias("xiaoqu_std_price_final"),
            "block_std_price",
        )
        .distinct()
    )
