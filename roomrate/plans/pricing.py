"""JOB_H and JOB_I: attach the community prices to the rooms, then price them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.functions.numeric import snap_price
from roomrate.operators.joins import join_null_safe
from roomrate.operators.scoring import TreeModel, numeric_features, score

# fixed values: feature order of the room model (24)
ROOM_FEATURES = (
    "bedroom_num", "toilet_num", "total_area", "has_lift", "heating", "floor", "xianfang_days",
    "living_area", "has_toilet", "has_balcony", "has_storeroom", "has_terrace", "face", "lighting",
    "is_small_window", "shape", "balcony_area",
    "dts", "city_level", "xiaoqu_std_price_final", "block_std_price",
    "bedroom_num_dev", "living_area_dev", "face_dev",
)
# fixed values: the standard room the deviations are measured from
STD_BEDROOMS = 3
STD_LIVING_AREA = 12
STD_FACE = 3


def attach_prices(rooms: DataFrame, std_price: DataFrame) -> DataFrame:
    """JOB_H (JN11, JN12): community price by (city, community), block price by (city, block).

    ``std_price`` is the JOB_G table (city, own_block, community,
    xiaoqu_std_price_final, block_std_price). Both joins match NULL to NULL. A
    community priced under several blocks repeats its rooms, as in the
    reference. The rooms are already distinct and each right side is distinct,
    so the reference's ``distinct()`` after each join cannot remove a row and
    is not repeated here.
    """
    by_community = std_price.select("city", "community", "xiaoqu_std_price_final").distinct()
    by_block = std_price.select("city", "own_block", "block_std_price").distinct()
    return attach_lookups(rooms, by_community, by_block)


def attach_lookups(rooms: DataFrame, by_community: DataFrame, by_block: DataFrame) -> DataFrame:
    """JOB_H from the two lookup tables (``standard.community_prices`` and
    ``standard.block_prices`` of the same reconciled rows, which lets the plan
    share the reconciliation instead of computing it per lookup)."""
    with_community = join_null_safe(rooms, by_community, ["city", "community"], "left")
    return join_null_safe(with_community, by_block, ["city", "block"], "left", right_keys=["city", "own_block"])


def coverage_gaps(priced: DataFrame) -> DataFrame:
    """SNK2 content: communities of rooms that got no community price."""
    return priced.where(F.col("xiaoqu_std_price_final").isNull()).select("city", "block", "community").distinct()


def price_rooms(priced: DataFrame, model: TreeModel) -> DataFrame:
    """JOB_I: rooms with a community price, scored and snapped (49 columns)."""
    rows = priced.where(F.col("xiaoqu_std_price_final").isNotNull()).withColumns(
        {
            "bedroom_num_dev": F.lit(STD_BEDROOMS) - F.col("bedroom_num"),
            "living_area_dev": F.lit(STD_LIVING_AREA) - F.col("living_area"),
            "face_dev": F.lit(STD_FACE) - F.col("face"),
        }
    )
    pred = score(model, numeric_features(rows, ROOM_FEATURES))
    rows = rows.withColumn("room_outprice_pre", F.col("xiaoqu_std_price_final") - pred)
    return rows.withColumn("adj_room_outprice_pre", snap_price("room_outprice_pre"))
