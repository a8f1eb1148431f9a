"""JOB_A..JOB_D: the four extracts, as lazy DataFrame plans.

Each job takes the input tables and an explicit ``as_of`` date in place of
``CURDATE()`` / ``Sys.Date()``, so a run repeats exactly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomrate.functions import encode as E
from roomrate.functions.dates import days_since, on_or_after, text_date_on_or_after
from roomrate.functions.numeric import clamp_nonneg, lenient_double, lenient_int, r_div
from roomrate.functions.text import crawl_block, with_city_suffix
from roomrate.operators.grouped import attach, group_quantiles, group_sums, total_of
from roomrate.operators.joins import join_spread, reduced
from roomrate.operators.suite import (
    DELISTED,
    WORKSTATION,
    decoration_cost,
    landlord_price_in_force,
    room_stats,
    signed_contracts,
    suite_toilet_counts,
)
from roomrate.sources.literals import city_level_table, denied_suite_ids
from roomrate.sources.tables import RentalTables

# Fixed run dates of the test data (FIXTURES.md): A, C, D and landlord prices
# use AS_OF; the crawl extract uses CRAWL_AS_OF (the crawl ends then).
AS_OF = dt.date(2001, 8, 1)
CRAWL_AS_OF = dt.date(2024, 1, 30)

# fixed values: recency windows (days) and labels of the own-listing extract
OWN_RECENT_DAYS = 150  # the 90-day arm for 北京市/天津市 lies inside this one
OWN_MIN_BEDROOMS = 2
CRAWL_RECENT_DAYS = 7
WHOLE_UNIT_RECENT_DAYS = 180
CRAWL_PRODUCT = "友家合租"
CRAWL_MIN_PRICE = 500
# fixed values: rooms in these states are not priced again
PRICED_STATES = ("可出租", "已出租", "已预定")
# fixed values: cities whose decoration must be finished by as_of + 2 days
DEADLINE_CITIES = ("杭州市", "上海市", "深圳市", "武汉市", "南京市", "广州市")
DEADLINE_DAYS = 2
# fixed values: cities priced whatever the decoration date
OPEN_CITIES = ("北京市", "天津市")
RND_ADDRESS = "研发"
CODE_A = "A"

# fixed values: the standard rooms that listings are compared with
OWN_STANDARD = (
    ("before_room_num_y", 2),
    ("bedroom_num_y", 3),
    ("toilet_num_y", 1),
    ("dw_num_y", 0),
    ("xianfang_days_y", 0),
    ("living_area_y", 12),
    ("fix_area_y", 12),
    ("has_balcony_y", 0),
    ("price_y", ""),
    ("face_y", 3),
    ("has_toilet_y", 0),
)
# fixed values: the standard room of the crawl extract
CRAWL_STANDARD = (
    ("bedroomnum_y", 3),
    ("area_y", 12),
    ("balcony_y", 0),
    ("price_y", 0),
    ("face_y", 3),
    ("bathroom_y", 0),
    ("style_y", 4),
)


def _consts(pairs):
    return [F.lit(v).alias(k) for k, v in pairs]


def recency_filter(ready: F.Column, city: F.Column, as_of: dt.date, absorbed: bool = True) -> F.Column:
    """FLT2: ``(city in (北京市,天津市) and ready >= t-90) or ready >= t-150``.

    The 90-day arm implies the 150-day one, so the predicate equals
    ``ready >= t-150`` for every input, NULLs included; that form is a plain
    range the scan can use. ``absorbed=False`` gives the literal form.
    """
    wide = ready >= F.lit(as_of - dt.timedelta(days=OWN_RECENT_DAYS))
    if absorbed:
        return wide
    narrow = city.isin(*OPEN_CITIES) & (ready >= F.lit(as_of - dt.timedelta(days=90)))
    return narrow | wide


# ------------------------------------------------------------------ JOB_A
def recent_suites(t: RentalTables, as_of: dt.date) -> DataFrame:
    """Ids of the suites that JOB_A can show: more than one bedroom and ready since the recency window."""
    ready = recency_filter(F.col("ready_for_rent_date"), F.lit(None).cast("string"), as_of)
    return t["suites"].where((F.col("bedroom_num") >= OWN_MIN_BEDROOMS) & ready).select(F.col("id").alias("suite_id"))


def _own_standard_pairs(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_A: own listings paired with the standard room (28 columns)."""
    rooms = t["rooms"].where(
        F.col("price").isNotNull()
        & ~F.col("rent_type").contains(E.WHOLE_UNIT)
        & (F.col("lighting") == E.LIGHT_PRIVATE)
        & (F.col("is_small_window") == E.SMALL_WINDOW_NO)
        & (F.col("shape") == E.SHAPE_NORMAL)
        & (F.col("has_storeroom") != E.YES)
        & (F.col("has_terrace") != E.YES)
        & ~F.col("status").isin(DELISTED)
    ).select(
        "suite_id", "living_area", "area", "toilet_area", "has_balcony", "price", "face", "has_toilet", "code", "status"
    )
    suites = t["suites"].where(F.col("bedroom_num") >= OWN_MIN_BEDROOMS).select(
        F.col("id").alias("suite_id"), "xiaoqu_id", "bedroom_num", "toilet_num", "ready_for_rent_date"
    )
    xq = t["xiaoqus"].select(F.col("id").alias("xiaoqu_id"), "city", "block", F.col("name").alias("community"))
    suites = suites.join(xq, "xiaoqu_id").where(recency_filter(F.col("ready_for_rent_date"), F.col("city"), as_of))
    # only the rooms and daily facts of recent suites are aggregated
    recent = recent_suites(t, as_of)
    # daily facts hold one row per suite and day: only the distinct
    # (suite, before_room_num) pairs can reach the DISTINCT output
    daily = reduced(t["f_bi_sfinfor_day"].select("suite_id", "before_room_num"), recent, "suite_id").distinct()
    toilets = suite_toilet_counts(reduced(t["rooms"], recent, "suite_id"))
    joined = join_spread(rooms, suites.join(daily, "suite_id").join(toilets, "suite_id"), "suite_id")
    return joined.select(
        "city",
        "block",
        "community",
        F.col("before_room_num").alias("before_room_num_x"),
        F.col("bedroom_num").alias("bedroom_num_x"),
        F.col("toilet_num").alias("toilet_num_x"),
        F.col("dw_num").alias("dw_num_x"),
        clamp_nonneg(days_since(as_of, "ready_for_rent_date")).alias("xianfang_days_x"),
        F.col("living_area").alias("living_area_x"),
        (F.col("area") - F.col("toilet_area")).alias("fix_area_x"),
        E.yes_flag("has_balcony").alias("has_balcony_x"),
        F.col("price").alias("price_x"),
        E.face_code("face").alias("face_x"),
        E.yes_flag("has_toilet").alias("has_toilet_x"),
        *_consts(OWN_STANDARD),
        "code",
        E.status_code("status").alias("status"),
        E.tier("city", E.TIER_A).alias("city_level"),
    ).distinct()


# ------------------------------------------------------------------ JOB_B
def _crawl_standard_pairs(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_B: last week's competitor crawl paired with its standard room (18 columns)."""
    z = t["archive_ziroom"].where(
        text_date_on_or_after("date_created", as_of - dt.timedelta(days=CRAWL_RECENT_DAYS))
        & (lenient_double("bedroom_num") > 1)
        & (F.col("product_type") == CRAWL_PRODUCT)
        & F.col("style").contains(E.CRAWL_STYLE_4)
        & (lenient_double("price") > CRAWL_MIN_PRICE)
    ).select(
        "city",
        "community_name",
        crawl_block("business_district", "business_district_block").alias("crawl_block"),
        with_city_suffix("city").alias("city_full"),
        "bedroom_num",
        "building_area",
        "independent_balcon",
        "price",
        "orientation",
        "private_bathroom",
        "style",
    )
    # the mapping may hold a row many times; a listing meets each distinct row once, or the rows
    # below the DISTINCT grow with listings times repeats
    rel = t["xiaoqurelations"].select(
        F.col("city").alias("rel_city"), "jingdui", F.col("block").alias("rel_block"), "company"
    ).distinct()
    j = z.join(rel, (z["city_full"] == rel["rel_city"]) & (z["community_name"] == rel["jingdui"]), "left")
    return j.select(
        F.coalesce("rel_city", "city_full").alias("city"),
        E.block_if_mapped("company", "rel_block", "crawl_block").alias("block"),
        F.coalesce("company", "community_name").alias("community"),
        lenient_int("bedroom_num").alias("bedroomnum_x"),
        F.round(lenient_double("building_area"), 0).alias("area_x"),
        E.yes_flag("independent_balcon", E.CRAWL_BALCONY).alias("balcony_x"),
        lenient_int("price").alias("price_x"),
        E.face_code("orientation").alias("face_x"),
        E.yes_flag("private_bathroom", E.CRAWL_BATHROOM).alias("bathroom_x"),
        E.style_code("style").alias("style_x"),
        *_consts(CRAWL_STANDARD),
        E.tier("city", E.TIER_B).alias("city_level"),
    ).distinct()


# ------------------------------------------------------------------ JOB_C
#: The tables that JOB_C reads.
ROOMS_TO_PRICE_TABLES = (
    "rooms", "suites", "xiaoqus", "suite_decorations", "contract_with_landlords", "house_pricing", "landlord_payment_schedules",
)


def suite_room_stats(t: RentalTables) -> DataFrame:
    """The per-suite aggregate of all ``rooms``; extracts A and C aggregate those of their suites only."""
    return t.derived("room_stats", lambda: room_stats(t["rooms"]))


def open_rooms(t: RentalTables) -> DataFrame:
    """Rooms not yet let."""
    return t["rooms"].where(~F.col("status").isin(*PRICED_STATES) & F.col("deleted_at").isNull())


def _suites(t: RentalTables) -> DataFrame:
    return t["suites"].select(
        F.col("id").alias("suite_id"),
        "xiaoqu_id",
        "bedroom_num",
        "toilet_num",
        F.col("area").alias("total_area"),
        "has_lift",
        "heating",
        "floor",
        "ready_for_rent_date",
        "zhuangxiu_end_date",
        "address",
        F.col("status").alias("suite_state"),
    )


def _with_community(t: RentalTables, suites: DataFrame) -> DataFrame:
    xq = t["xiaoqus"].select(F.col("id").alias("xiaoqu_id"), "city", "block", F.col("name").alias("community"))
    return suites.join(xq, "xiaoqu_id")


def suites_with_community(t: RentalTables) -> DataFrame:
    """Suites with their community."""
    return _with_community(t, _suites(t))


def rooms_base(t: RentalTables) -> DataFrame:
    """Rooms not yet let, with their suite and community."""
    return open_rooms(t).join(suites_with_community(t), "suite_id")


def lettable_part(rent: F.Column, code: F.Column, any_case: bool = False) -> F.Column:
    """FLT13: rooms let one by one, and the room of a whole unit that stands for it."""
    whole = rent.contains(E.WHOLE_UNIT)
    return ~whole | (whole & E.has_text(code, CODE_A, any_case))


def _rooms_to_price(t: RentalTables, as_of: dt.date, any_case: bool) -> DataFrame:
    """JOB_C: rooms to price with suite, cost, contract and landlord data (42 columns)."""
    rooms = open_rooms(t).where(
        ~F.col("suite_id").isin(*denied_suite_ids())
        & F.col("price").isNull()
        & F.col("available_date").isNull()
        & lettable_part(F.col("rent_type"), F.col("code"), any_case)
    ).select(
        "suite_id", "code", "area", "living_area", "balcony_area", "terrace_area", "toilet_area", "storeroom_area",
        "has_toilet", "has_balcony", "has_storeroom", "has_terrace", "face", "lighting", "is_small_window", "shape",
        "shape_note", "rent_type", "status", "price",
    )
    icost = decoration_cost(t["suite_decorations"], as_of, ("decoration_cost",)).select("suite_id", "decoration_cost")
    # only the statistics of suites with a room to price are aggregated
    wanted = rooms.select("suite_id").distinct()
    # bb1 (AGG4 over listed suites) and the never-available anti join (JN8)
    # are both read from the one per-suite room aggregate
    in_place = t.in_suite_buckets
    facts = t["rooms"].join(wanted, "suite_id", "left_semi") if in_place else reduced(t["rooms"], wanted, "suite_id")
    bb1 = room_stats(facts).where((F.col("live_rooms") > 0) & (F.col("ever_available_rooms") == 0)).select(
        "suite_id", "dw_num", "dly_num"
    )
    suites = _suites(t).where(
        ~F.col("address").contains(RND_ADDRESS)
        & ~F.col("suite_state").isin(DELISTED)
        & ~F.col("address").contains(WORKSTATION)
        & F.col("ready_for_rent_date").isNotNull()
    )
    # The contract and decoration joins fan out per suite and the extract ends
    # in DISTINCT. Only (origin_bedroom_num, sales wish price) of a contract
    # and the supplier end date of a decoration reach the output, so each side
    # is reduced to its distinct (suite, used columns) first: the same final
    # rows, but a suite with many contracts and decorations no longer emits
    # every contract x decoration pair before the DISTINCT.
    hp = t["house_pricing"].select(
        F.col("id").alias("house_pricing_id"), F.col("sales_wish_sum_price_yuan").alias("pre_total_outpr")
    )
    signed = signed_contracts(t["contract_with_landlords"], as_of).select(
        "suite_id", "origin_bedroom_num", "house_pricing_id"
    )

    def placed(rows: DataFrame) -> DataFrame:
        return _with_community(t, rows).where(F.col("city").isin(*DEADLINE_CITIES, *OPEN_CITIES))

    def wished(rows: DataFrame) -> DataFrame:
        return rows.join(hp, "house_pricing_id", "left").drop("house_pricing_id")

    in_force = landlord_price_in_force(t["landlord_payment_schedules"], t["contract_with_landlords"], as_of)
    mm = t["suite_decorations"].select("suite_id", "supplier_end_date").distinct()
    end_date = F.coalesce(F.col("supplier_end_date"), F.col("zhuangxiu_end_date"))
    due = (
        F.col("city").isin(*DEADLINE_CITIES) & (end_date <= F.lit(as_of + dt.timedelta(days=DEADLINE_DAYS)))
    ) | F.col("city").isin(*OPEN_CITIES)
    chain = (
        (suites if in_place else placed(suites))
        .join(icost, "suite_id")
        .join(bb1, "suite_id")
        .join(in_force, "suite_id", "left")
        .join(mm, "suite_id", "left")
    )
    if in_place:  # lookups by other keys would move the rows out of their buckets, so they come last
        priced_suites = wished(placed(chain.join(signed.distinct(), "suite_id")).where(due))
    else:
        priced_suites = chain.where(due).join(wished(signed).distinct(), "suite_id")
    joined = join_spread(rooms, priced_suites, "suite_id")
    return joined.select(
        "city",
        "block",
        "community",
        "address",
        "origin_bedroom_num",
        "bedroom_num",
        "toilet_num",
        "total_area",
        "dw_num",
        "dly_num",
        E.yes_flag("has_lift").alias("has_lift"),
        E.yes_flag("heating", E.HEATING_CENTRAL).alias("heating"),
        "floor",
        days_since(as_of, "ready_for_rent_date").alias("xianfang_days"),
        "code",
        E.area_by_rent_type("rent_type", "total_area", "area").alias("area"),
        "living_area",
        "balcony_area",
        "terrace_area",
        "toilet_area",
        "storeroom_area",
        E.yes_flag("has_toilet").alias("has_toilet"),
        E.yes_flag("has_balcony").alias("has_balcony"),
        E.yes_flag("has_storeroom").alias("has_storeroom"),
        E.yes_flag("has_terrace").alias("has_terrace"),
        F.col("face").alias("face_old"),
        E.face_code("face").alias("face"),
        E.lighting_code("lighting").alias("lighting"),
        E.small_window_code("is_small_window").alias("is_small_window"),
        E.shape_code("shape", "shape_note", any_case).alias("shape"),
        "rent_type",
        "status",
        "price",
        E.tier("city", E.TIER_C).alias("city_level"),
        F.lit(20).alias("dts"),
        end_date.alias("zhuangxiu_end_date"),
        "pre_total_outpr",
        "decoration_cost",
        "month_price",
        "imonths",
        "free_days",
        "suite_id",
    ).distinct()


# ------------------------------------------------------------------ JOB_D
WHOLE_UNIT_COLUMNS = (
    "city_level", "city", "block", "community", "bedroom_num", "puzu_avg_price", "puzu_avg_area",
    "avg_price_area", "room_avg_price", "room_median_price", "com_avg_price", "com_median_price",
)


def _whole_unit_listings(t: RentalTables, as_of: dt.date) -> DataFrame:
    """SRC3 + JN13 + PRJ9: recent whole-unit listings with tier and per-room ratios."""
    listings = (
        t["community_house_type"]
        .where(on_or_after("data_date", as_of - dt.timedelta(days=WHOLE_UNIT_RECENT_DAYS)) & (F.col("bedroom_num") < 6))
        .select("city", "block", F.col("xiaoqu_name").alias("community"), "bedroom_num", "area", "price")
    )
    with_tier = listings.join(city_level_table(listings.sparkSession), "city", "left")
    beds = F.col("bedroom_num").cast("double")
    return with_tier.select(
        "city_level",
        "city",
        "block",
        "community",
        "bedroom_num",
        "area",
        "price",
        r_div("price", beds).alias("puzu_avg_price"),
        r_div("area", beds).alias("puzu_avg_area"),
        r_div("price", "area").alias("avg_price_area"),
    )


def _ratio_stats(rows: DataFrame, keys: list[str], avg_name: str, median_name: str) -> DataFrame:
    beds = {"__beds": ("sum", "bedroom_num"), "__known": ("count", "bedroom_num"), "__rows": ("count", F.lit(1))}
    sums = group_sums(rows, keys, {"__price": "price"}, beds)
    known_beds = F.when(F.col("__known") == F.col("__rows"), F.col("__beds"))
    sums = sums.select(*keys, r_div(total_of("__price", na_poisons=True), known_beds).alias(avg_name))
    med = group_quantiles(rows, keys, "puzu_avg_price", {median_name: 0.5}, na_poisons=True)
    return attach(sums, med, keys)


def _whole_unit_stats(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_D: whole-unit rent per room by community and bedroom count (WIN4-WIN6)."""
    rows = whole_unit_listings(t, as_of)
    room_keys = ["city_level", "city", "community", "bedroom_num"]
    com_keys = ["city_level", "city", "community"]
    room = _ratio_stats(rows, room_keys, "room_avg_price", "room_median_price")
    com = _ratio_stats(rows, com_keys, "com_avg_price", "com_median_price")
    # the output is a distinct set and the statistics depend only on the keys,
    # so rows are deduplicated before the statistics are attached
    distinct_rows = rows.select(
        "city_level", "city", "block", "community", "bedroom_num", "puzu_avg_price", "puzu_avg_area", "avg_price_area"
    ).distinct()
    return attach(attach(distinct_rows, room, room_keys), com, com_keys).select(*WHOLE_UNIT_COLUMNS)


# ------------------------------------------------------------------ public
# Each job's plan is built once per table set and date and shared by every
# job that consumes it (building is eager analysis on the driver; execution
# still runs the whole plan each time an action is called).
def own_standard_pairs(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_A: own listings paired with the standard room (28 columns)."""
    return t.derived(f"job_a/{as_of}", lambda: _own_standard_pairs(t, as_of))


def crawl_standard_pairs(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_B: last week's competitor crawl paired with its standard room (18 columns)."""
    return t.derived(f"job_b/{as_of}", lambda: _crawl_standard_pairs(t, as_of))


def rooms_to_price(t: RentalTables, as_of: dt.date, any_case: bool = False) -> DataFrame:
    """JOB_C: rooms to price with suite, cost, contract and landlord data (42 columns).

    ``any_case`` matches Latin letters of room codes and shape notes in either case, as a server
    with a case-insensitive collation does.
    """
    return t.derived(f"job_c/{as_of}/{any_case}", lambda: _rooms_to_price(t, as_of, any_case))


def whole_unit_listings(t: RentalTables, as_of: dt.date) -> DataFrame:
    """SRC3 + JN13 + PRJ9: recent whole-unit listings with tier and per-room ratios."""
    return t.derived(f"whole_unit_listings/{as_of}", lambda: _whole_unit_listings(t, as_of))


def whole_unit_stats(t: RentalTables, as_of: dt.date) -> DataFrame:
    """JOB_D: whole-unit rent per room by community and bedroom count (WIN4-WIN6)."""
    return t.derived(f"job_d/{as_of}", lambda: _whole_unit_stats(t, as_of))
