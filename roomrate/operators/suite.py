"""Per-suite derived tables of the extracts (AGG1-AGG6, FLT9, FLT10, FLT14, JN8).

All of them are keyed by ``suite_id``; the extracts join them on that key, so
after the first exchange on ``suite_id`` the later sort-merge joins reuse the
same hash partitioning instead of shuffling again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.functions.dates import month_in_interval, not_after_day
from roomrate.functions.encode import YES
from roomrate.operators.grouped import group_sums, mean_of, total_of

# fixed values: status and type labels of the warehouse tables
DELISTED = "已下架"
WORKSTATION = "工作站"
APPROVED = ("审批通过", "特批通过")
SIGNED = "已签约"
SIGNED_OR_PENDING = ("已签约", "签约待确认")
TYPE_OWN_BRAND = "蛋壳"
TYPE_PARTNER_BRAND = "蓝鲸"
NO = "无"

BUDGET_TERMS = ("decoration", "furniture", "appliance", "allocation", "operation", "follow_operation")


def room_stats(rooms: DataFrame) -> DataFrame:
    """Every per-suite room statistic of the extracts, in one pass over ``rooms``.

    The original computes them in three derived tables (AGG1, AGG4, AGG6), each
    scanning the rooms table; here each is a conditional aggregate of a single
    ``groupBy(suite_id)`` (partial aggregation in the scan tasks), and the
    derived tables below are filters of it. Within one query plan Spark also
    reuses the one exchange for every consumer.
    """
    priced = F.col("price").isNotNull()
    live = F.col("deleted_at").isNull() & ~F.col("status").isin(DELISTED)
    toilet = F.col("has_toilet") == YES
    shower_only = (F.col("has_shower") == YES) & (F.col("has_toilet") == NO)
    return rooms.groupBy("suite_id").agg(
        F.count(F.when(priced, F.lit(1))).alias("priced_rooms"),
        F.count(F.when(priced & toilet, F.lit(1))).alias("priced_toilet_rooms"),
        F.count(F.when(live, F.lit(1))).alias("live_rooms"),
        F.count_distinct(F.when(live, F.col("code"))).alias("bed_num"),
        F.count(F.when(live & toilet, F.lit(1))).alias("dw_num"),
        F.count(F.when(live & shower_only, F.lit(1))).alias("dly_num"),
        F.max(F.when(live, F.col("available_date"))).alias("available_date"),
        F.count("available_date").alias("ever_available_rooms"),
    )


def suite_toilet_counts(rooms: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """AGG1: rooms with their own toilet per suite, over suites with priced rooms."""
    stats = room_stats(rooms) if stats is None else stats
    return stats.where(F.col("priced_rooms") > 0).select("suite_id", F.col("priced_toilet_rooms").alias("dw_num"))


def listed_suites(suites: DataFrame) -> DataFrame:
    """FLT9 and the suite side of AGG4: listed suites with a ready date."""
    return suites.where(
        ~F.col("status").isin(DELISTED)
        & ~F.col("address").contains(WORKSTATION)
        & F.col("ready_for_rent_date").isNotNull()
    )


def _cost(kind: str) -> F.Column:
    # a NULL in one of the six main terms voids that row's term (SQL +), the
    # material term counts 0 when missing; SUM skips the voided rows
    total = None
    for term in BUDGET_TERMS:
        c = F.col(f"{term}_{kind}")
        total = c if total is None else total + c
    return total + F.coalesce(F.col(f"construction_material_{kind}"), F.lit(0.0))


def decoration_cost(decorations: DataFrame, as_of: dt.date, only: tuple[str, ...] = ()) -> DataFrame:
    """AGG2-AGG3 with FLT14: approved decoration cost per suite (``only`` these figures, or all)."""
    approved = decorations.where(
        not_after_day("measure_approve_pass_at", as_of) & F.col("measure_approve_status").isin(*APPROVED)
    )
    costs = {"decoration_cost": _cost("budget"), "final_cost": _cost("amount"), "total_yuan": "total_yuan"}
    costs = {name: costs[name] for name in only or costs}
    sums = group_sums(approved, ["suite_id"], costs, {"suite_status": ("max", "suite_status")})
    return sums.select(
        "suite_id", "suite_status", *[(mean_of(c) if c == "total_yuan" else total_of(c)).alias(c) for c in costs]
    )


def suite_profile(rooms: DataFrame, suites: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """AGG4 with FLT9: bed count, toilets and shower-only rooms of listed suites."""
    stats = room_stats(rooms) if stats is None else stats
    s = listed_suites(suites).select(F.col("id").alias("suite_id"), F.col("toilet_num").alias("gw_num"))
    return stats.where(F.col("live_rooms") > 0).join(s, "suite_id").select(
        "suite_id",
        "bed_num",
        "gw_num",
        "dw_num",
        "dly_num",
        F.lit("0").alias("gly_num"),
        F.lit("1").alias("gcf_num"),
        F.lit("0").alias("dcf_num"),
        "available_date",
    )


def signed_contracts(contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """FLT10: signed landlord contracts of the two managed brands (many per suite)."""
    t = F.col("type")
    return contracts.where(
        (F.col("status") == SIGNED)
        & (F.col("sign_date") <= F.lit(as_of))
        & ((F.col("suite_id").isNotNull() & t.startswith(TYPE_OWN_BRAND)) | t.startswith(TYPE_PARTNER_BRAND))
    )


def landlord_price_in_force(schedules: DataFrame, contracts: DataFrame, as_of: dt.date) -> DataFrame:
    """AGG5 with FLT11 and JN4: the landlord's monthly price in force in the as_of month."""
    pay = schedules.where(
        (F.col("monthly_price") > 0)
        & F.col("deleted_at").isNull()
        & month_in_interval(as_of, "date", "end_date")
    ).groupBy("contract_id").agg(F.max("monthly_price").alias("monthly_price"))  # one row per contract meets the contracts
    con = contracts.where(
        F.col("suite_id").isNotNull()
        & F.col("type").startswith(TYPE_OWN_BRAND)
        & F.col("status").isin(*SIGNED_OR_PENDING)
    ).select(F.col("id").alias("contract_id"), "suite_id", "months", "free_days")
    return (
        pay.join(con, "contract_id")
        .groupBy("suite_id")
        .agg(
            F.round(F.max("monthly_price"), 0).alias("month_price"),
            F.max("months").alias("imonths"),
            F.max("free_days").alias("free_days"),
        )
    )


def ever_available_suites(rooms: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """JN8/AGG6: suites with at least one room that ever had an available date."""
    stats = room_stats(rooms) if stats is None else stats
    return stats.where(F.col("ever_available_rooms") > 0).select("suite_id")
