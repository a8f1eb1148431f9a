"""

Each entry takes ``(spark, sf_dir)``, derives the rental tables from the
driver tables in ``sf_dir`` and returns a lazy DataFrame over the whole
tables. The double columns listed with each entry of ``SPECS`` are rounded to
4 places (here and in the oracle SQL, with the same formula) because
interpolation formulas differ in the last bits between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomrate.functions import encode as E
from roomrate.functions.dates import days_since
from roomrate.functions.numeric import clamp_nonneg, lenient_double, lenient_int, snap_price
from roomrate.functions.text import crawl_block, with_city_suffix
from roomrate.operators import suite as SU
from roomrate.operators.scoring import numeric_features, score
from roomrate.plans import extracts as X
from roomrate.plans import pricing as P
from roomrate.plans import standard as S
from roomrate.plans.profile import six_number_summary
from roomrate.session import ensure_checkpoint_dir
from roomrate.sinks.csv import read_dated_csv, write_dated_csv
from roomrate.sources import contract
from roomrate.sources.buckets import store_by_suite
from roomrate.sources.ensemble import CRAWL_MODEL, OWN_MODEL, ROOM_MODEL, demo_model
from roomrate.sources.literals import denied_suite_ids
from roomrate.sources.tables import RentalTables

Query = Callable[[SparkSession, str], DataFrame]
ROUND_PLACES = 4


def _t(spark: SparkSession, sf_dir: str) -> RentalTables:
    return RentalTables.from_driver(spark, sf_dir)


def round_half_up(c: F.Column, places: int = ROUND_PLACES) -> F.Column:
    """floor(x * 10^p + 0.5) / 10^p in plain double arithmetic.

    Written the same way in the oracle SQL so equal doubles round equally in
    both engines (their built-in ``round`` differ on near-ties); infinities and
    NULL pass through.
    """
    scale = 10**places
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), c).otherwise(F.floor(c * scale + 0.5) / scale)


def _round(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    if not cols:
        return df
    return df.withColumns({c: round_half_up(F.col(c)) for c in cols})


# ------------------------------------------------------------ small operators
def q_src_filter_select(spark, sf):
    return X.whole_unit_listings(_t(spark, sf), X.AS_OF).select("city", "block", "community", "bedroom_num", "area", "price")


def q_inline_tier_join(spark, sf):
    return X.whole_unit_listings(_t(spark, sf), X.AS_OF).select("city", "community", "bedroom_num", "city_level")


def q_encode_flags(spark, sf):
    t = _t(spark, sf)
    s = t["suites"].select(F.col("id").alias("suite_id"), "has_lift", "heating")
    return t["rooms"].join(s, "suite_id").select(
        "suite_id",
        "code",
        E.yes_flag("has_toilet").alias("has_toilet"),
        E.yes_flag("has_balcony").alias("has_balcony"),
        E.yes_flag("has_storeroom").alias("has_storeroom"),
        E.yes_flag("has_terrace").alias("has_terrace"),
        E.small_window_code("is_small_window").alias("is_small_window"),
        E.status_code("status").alias("status"),
        E.yes_flag("has_lift").alias("has_lift"),
        E.yes_flag("heating", E.HEATING_CENTRAL).alias("heating"),
    )


def q_encode_face(spark, sf):
    r = _t(spark, sf)["rooms"]
    return r.select("suite_id", "code", F.col("face").alias("face_old"), E.face_code("face").alias("face"))


def q_encode_light_shape(spark, sf):
    r = _t(spark, sf)["rooms"]
    return r.select(
        "suite_id",
        "code",
        E.lighting_code("lighting").alias("lighting"),
        E.shape_code("shape", "shape_note").alias("shape"),
    )


def q_tier_a(spark, sf):
    return _t(spark, sf)["xiaoqus"].select("id", "city", E.tier("city", E.TIER_A).alias("city_level"))


def q_tier_b(spark, sf):
    return _t(spark, sf)["archive_ziroom"].select("event_id", "city", E.tier("city", E.TIER_B).alias("city_level"))


def q_tier_c(spark, sf):
    return _t(spark, sf)["xiaoqus"].select("id", "city", E.tier("city", E.TIER_C).alias("city_level"))


def _crawl_mapped(t: RentalTables) -> DataFrame:
    z = t["archive_ziroom"].select(
        "event_id",
        "city",
        "community_name",
        crawl_block("business_district", "business_district_block").alias("crawl_block"),
        with_city_suffix("city").alias("city_full"),
    )
    rel = t["xiaoqurelations"].select(
        F.col("city").alias("rel_city"), "jingdui", F.col("block").alias("rel_block"), "company"
    )
    return z.join(rel, (z["city_full"] == rel["rel_city"]) & (z["community_name"] == rel["jingdui"]), "left")


def q_coalesce_rules(spark, sf):
    j = _crawl_mapped(_t(spark, sf))
    return j.select(
        "event_id",
        F.coalesce("rel_city", "city_full").alias("city"),
        E.block_if_mapped("company", "rel_block", "crawl_block").alias("block"),
        F.coalesce("company", "community_name").alias("community"),
    )


def q_computed_key_join(spark, sf):
    j = _crawl_mapped(_t(spark, sf))
    return j.select("event_id", "city_full", "rel_city", "jingdui", "company")


def q_clamp_days(spark, sf):
    s = _t(spark, sf)["suites"]
    d = days_since(X.AS_OF, "ready_for_rent_date")
    return s.select("id", d.alias("xianfang_days"), clamp_nonneg(d).alias("xianfang_days_x"))


def q_area_by_rent_type(spark, sf):
    base = X.rooms_base(_t(spark, sf))
    return base.select("suite_id", "code", "rent_type", E.area_by_rent_type("rent_type", "total_area", "area").alias("area"))


def q_block_parser(spark, sf):
    z = _t(spark, sf)["archive_ziroom"]
    return z.select("event_id", crawl_block("business_district", "business_district_block").alias("block"))


def q_numeric_prefix(spark, sf):
    z = _t(spark, sf)["archive_ziroom"]
    return z.select(
        "event_id",
        lenient_int("bedroom_num").alias("bedroomnum_x"),
        lenient_int("price").alias("price_x"),
        F.round(lenient_double("building_area"), 0).alias("area_x"),
    )


def q_recency_filter(spark, sf):
    t = _t(spark, sf)
    xq = t["xiaoqus"].select(F.col("id").alias("xiaoqu_id"), "city")
    s = t["suites"].join(xq, "xiaoqu_id")
    return s.where(X.recency_filter(F.col("ready_for_rent_date"), F.col("city"), X.AS_OF)).select(
        "id", "city", "ready_for_rent_date"
    )


def q_crawl_filter(spark, sf):
    return X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF).select("city", "community", "price_x").distinct()


def q_denylist(spark, sf):
    s = _t(spark, sf)["suites"]
    return s.where(~F.col("id").isin(*denied_suite_ids())).select("id")


def q_contract_filter(spark, sf):
    c = SU.signed_contracts(_t(spark, sf)["contract_with_landlords"], X.AS_OF)
    return c.select("id", "suite_id", "type", "house_pricing_id")


def q_month_in_force(spark, sf):
    t = _t(spark, sf)
    return SU.landlord_price_in_force(t["landlord_payment_schedules"], t["contract_with_landlords"], X.AS_OF)


def q_city_deadline(spark, sf):
    t = _t(spark, sf)
    base = X.rooms_base(t)
    mm = t["suite_decorations"].select("suite_id", "supplier_end_date")
    end_date = F.coalesce(F.col("supplier_end_date"), F.col("zhuangxiu_end_date"))
    rent = F.col("rent_type")
    j = base.join(mm, "suite_id", "left").where(
        (F.col("city").isin(*X.DEADLINE_CITIES) & (end_date <= F.lit(X.AS_OF + X.dt.timedelta(days=X.DEADLINE_DAYS))))
        | F.col("city").isin(*X.OPEN_CITIES)
    ).where(~rent.contains(E.WHOLE_UNIT) | (rent.contains(E.WHOLE_UNIT) & F.col("code").contains(X.CODE_A)))
    return j.select("suite_id", "code", "city", end_date.alias("zhuangxiu_end_date"))


def q_suite_toilets(spark, sf):
    t = _t(spark, sf)
    return SU.suite_toilet_counts(t["rooms"], X.suite_room_stats(t))


def q_decoration_cost(spark, sf):
    return SU.decoration_cost(_t(spark, sf)["suite_decorations"], X.AS_OF)


def q_suite_profile(spark, sf):
    t = _t(spark, sf)
    return SU.suite_profile(t["rooms"], t["suites"], X.suite_room_stats(t))


def q_contract_fanout(spark, sf):
    t = _t(spark, sf)
    c = SU.signed_contracts(t["contract_with_landlords"], X.AS_OF).select("suite_id", "origin_bedroom_num", "house_pricing_id")
    return X.rooms_base(t).join(c, "suite_id").select("suite_id", "code", "origin_bedroom_num", "house_pricing_id").distinct()


def q_lookup_left(spark, sf):
    t = _t(spark, sf)
    c = SU.signed_contracts(t["contract_with_landlords"], X.AS_OF).select("id", "suite_id", "house_pricing_id")
    hp = t["house_pricing"].select(F.col("id").alias("house_pricing_id"), F.col("sales_wish_sum_price_yuan").alias("pre_total_outpr"))
    return c.join(hp, "house_pricing_id", "left").select("id", "suite_id", "pre_total_outpr")


def q_decoration_fanout(spark, sf):
    t = _t(spark, sf)
    mm = t["suite_decorations"].select("suite_id", "supplier_end_date")
    j = X.rooms_base(t).join(mm, "suite_id", "left")
    return j.select(
        "suite_id", "code", "supplier_end_date", F.coalesce("supplier_end_date", "zhuangxiu_end_date").alias("zhuangxiu_end_date")
    )


def q_never_available(spark, sf):
    t = _t(spark, sf)
    ever = SU.ever_available_suites(t["rooms"], X.suite_room_stats(t))
    return X.rooms_base(t).join(ever, "suite_id", "left_anti").select("suite_id").distinct()


def q_std_deviations(spark, sf):
    a = X.own_standard_pairs(_t(spark, sf), X.AS_OF)
    return S.own_deviations(a).select(
        "city", "block", "community", "code", "area_xy_dev", "face_xy_dev", "has_toilet_xy_dev", "has_balcony_xy_dev", "bedroom_xy_dev"
    ).distinct()


def q_crawl_deviations(spark, sf):
    b = X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF)
    return S.crawl_deviations(b).select(
        "city", "block", "community", "price_x", "area_xy_dev", "face_xy_dev", "bathroom_xy_dev", "style_xy_dev",
        "balcony_xy_dev", "bedroomnum_xy_dev",
    ).distinct()


def q_score_own(spark, sf):
    return S.own_scored(X.own_standard_pairs(_t(spark, sf), X.AS_OF), demo_model(OWN_MODEL))


def q_score_crawl(spark, sf):
    return S.crawl_scored(X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF), demo_model(CRAWL_MODEL))


def _groups(t: RentalTables):
    own = t.derived("own_groups", lambda: S.own_group_prices(X.own_standard_pairs(t, X.AS_OF), demo_model(OWN_MODEL)))
    crawl = t.derived("crawl_groups", lambda: S.crawl_group_prices(X.crawl_standard_pairs(t, X.CRAWL_AS_OF), demo_model(CRAWL_MODEL)))
    return own, crawl


def _std_price(t: RentalTables) -> DataFrame:
    return t.derived("std_price", lambda: S.reconcile(*_groups(t)))


def _reconciled_rows(t: RentalTables) -> DataFrame:
    return t.derived("reconciled_rows", lambda: S.reconciled_pairs(*_groups(t)))


def _attached(t: RentalTables) -> DataFrame:
    def build():
        rows = _reconciled_rows(t)
        return P.attach_lookups(X.rooms_to_price(t, X.AS_OF), S.community_prices(rows), S.block_prices(rows))

    return t.derived("attached", build)


def q_score_room(spark, sf):
    priced = _attached(_t(spark, sf)).where(F.col("xiaoqu_std_price_final").isNotNull())
    rows = priced.withColumns(
        {
            "bedroom_num_dev": F.lit(3) - F.col("bedroom_num"),
            "living_area_dev": F.lit(12) - F.col("living_area"),
            "face_dev": F.lit(3) - F.col("face"),
        }
    )
    pred = score(demo_model(ROOM_MODEL), numeric_features(rows, P.ROOM_FEATURES))
    return rows.select("suite_id", "code", "block_std_price", "floor", pred.alias("room_pred"))


def q_own_median(spark, sf):
    return S.own_standard_prices(X.own_standard_pairs(_t(spark, sf), X.AS_OF), demo_model(OWN_MODEL))


def q_crawl_quantile(spark, sf):
    return S.crawl_standard_prices(X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF), demo_model(CRAWL_MODEL))


def q_reconcile_full_join(spark, sf):
    rows = _reconciled_rows(_t(spark, sf))
    return rows.withColumn("xiaoqu_std_price_final", F.coalesce("final_own", "final_crawl"))


def q_block_means(spark, sf):
    return _std_price(_t(spark, sf))


def q_attach_prices(spark, sf):
    return _attached(_t(spark, sf))


def q_coverage_gaps(spark, sf):
    return P.coverage_gaps(_attached(_t(spark, sf)))


def q_snap_price(spark, sf):
    r = _t(spark, sf)["rooms"].where(F.col("price").isNotNull())
    return r.select("suite_id", "code", "price", snap_price("price").alias("snapped"))


def q_unit_ratios(spark, sf):
    return X.whole_unit_listings(_t(spark, sf), X.AS_OF).select(
        "city_level", "city", "community", "bedroom_num", "puzu_avg_price", "puzu_avg_area", "avg_price_area"
    )


def q_group_ratio_median(spark, sf):
    return X.whole_unit_stats(_t(spark, sf), X.AS_OF).select(
        "city_level", "city", "community", "bedroom_num", "room_avg_price", "room_median_price"
    ).distinct()


def q_community_ratio_median(spark, sf):
    return X.whole_unit_stats(_t(spark, sf), X.AS_OF).select("city_level", "city", "community", "com_avg_price", "com_median_price").distinct()


def q_profile(spark, sf):
    return six_number_summary(_t(spark, sf)["community_house_type"], ["bedroom_num", "area", "price"])


def _as_loaded_raw(t: RentalTables) -> dict[str, DataFrame]:
    """Suites and rooms as a lenient server may send them: numbers and dates as text, NaN, zero dates."""
    suite, text = F.col("id"), lambda c: F.col(c).cast("string")
    ready = F.when(suite % 31 == 0, "0000-00-00").when(suite % 37 == 0, "2001-02-30").otherwise(text("ready_for_rent_date"))
    beds = F.when(suite % 41 == 0, F.concat(text("bedroom_num"), F.lit("室"))).otherwise(F.concat(F.lit(" "), text("bedroom_num")))
    key = F.col("suite_id")
    price = F.when(key % 7 == 0, "NaN").when(key % 11 == 0, "n/a").otherwise(text("price"))
    area = F.when(key % 9 == 0, F.lit(float("nan"))).otherwise(F.col("area"))
    return {
        "suites": t["suites"].withColumns({"ready_for_rent_date": ready, "bedroom_num": beds}),
        "rooms": t["rooms"].withColumns({"price": price, "area": area}),
    }


def q_load_violations(spark, sf):
    raw = _as_loaded_raw(_t(spark, sf))
    found = contract.violations(raw["suites"], "suites").union(contract.violations(raw["rooms"], "rooms"))
    return found.where(F.col("rows") > 0)


def q_load_conformed(spark, sf):
    raw = _as_loaded_raw(_t(spark, sf))
    suites = contract.conform(raw["suites"], "suites").select(F.col("id").alias("suite_id"), "bedroom_num", "ready_for_rent_date")
    rooms = contract.conform(raw["rooms"], "rooms").select("suite_id", "code", "price", "area")
    return rooms.join(suites, "suite_id")


def q_match_modes(spark, sf):
    low = lambda c: F.when(F.col("suite_id") % 3 == 0, F.lower(c)).otherwise(F.col(c)).alias(c)
    rooms = _t(spark, sf)["rooms"].select("suite_id", "rent_type", "shape", low("code"), low("shape_note"))
    modes = {"": False, "_any_case": True}
    return rooms.select(
        "suite_id",
        "code",
        *[X.lettable_part(F.col("rent_type"), F.col("code"), m).alias(f"kept{n}") for n, m in modes.items()],
        *[E.shape_code("shape", "shape_note", m).alias(f"shape{n}") for n, m in modes.items()],
    )


def q_quantile_rule(spark, sf):
    city = F.when(F.col("city").startswith(X.OPEN_CITIES[0]), S.QUANTILE_65_CITY).when(~F.col("city").startswith(X.DEADLINE_CITIES[0]), F.col("city"))
    pairs = X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF).withColumn("city", city)
    return S.crawl_group_prices(pairs, demo_model(CRAWL_MODEL))


def q_csv_roundtrip(spark, sf):
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-roundtrip-{uuid.uuid4().hex}"
    rooms = X.rooms_to_price(_t(spark, sf), X.AS_OF)
    write_dated_csv(rooms, root, "rooms", X.AS_OF)
    return read_dated_csv(spark, root, "rooms", X.AS_OF, rooms.schema)


def q_suite_buckets(spark, sf):
    """JOB_C over tables stored in buckets of their suite."""
    database = f"by_suite_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{ensure_checkpoint_dir(spark).rstrip('/')}/{database}'")
    store_by_suite(_t(spark, sf), database, int(spark.conf.get("spark.sql.shuffle.partitions")), X.ROOMS_TO_PRICE_TABLES)
    return X.rooms_to_price(RentalTables.from_catalog(spark, database, X.ROOMS_TO_PRICE_TABLES), X.AS_OF)


# ------------------------------------------------------------------- jobs
def q_job_a(spark, sf):
    return X.own_standard_pairs(_t(spark, sf), X.AS_OF)


def q_job_b(spark, sf):
    return X.crawl_standard_pairs(_t(spark, sf), X.CRAWL_AS_OF)


def q_job_c(spark, sf):
    return X.rooms_to_price(_t(spark, sf), X.AS_OF)


def q_job_d(spark, sf):
    return X.whole_unit_stats(_t(spark, sf), X.AS_OF)


def q_job_e(spark, sf):
    return q_own_median(spark, sf)


def q_job_f(spark, sf):
    return q_crawl_quantile(spark, sf)


def q_job_g(spark, sf):
    return q_block_means(spark, sf)


def q_job_h(spark, sf):
    return q_attach_prices(spark, sf)


def q_job_i(spark, sf):
    return P.price_rooms(_attached(_t(spark, sf)), demo_model(ROOM_MODEL))


# name -> (query, double columns rounded on both sides)
SPECS: dict[str, tuple[Query, tuple[str, ...]]] = {
    "src_filter_select": (q_src_filter_select, ()),
    "inline_tier_join": (q_inline_tier_join, ()),
    "encode_flags": (q_encode_flags, ()),
    "encode_face": (q_encode_face, ()),
    "encode_light_shape": (q_encode_light_shape, ()),
    "tier_a": (q_tier_a, ()),
    "tier_b": (q_tier_b, ()),
    "tier_c": (q_tier_c, ()),
    "coalesce_rules": (q_coalesce_rules, ()),
    "computed_key_join": (q_computed_key_join, ()),
    "clamp_days": (q_clamp_days, ()),
    "area_by_rent_type": (q_area_by_rent_type, ()),
    "block_parser": (q_block_parser, ()),
    "numeric_prefix": (q_numeric_prefix, ()),
    "recency_filter": (q_recency_filter, ()),
    "crawl_filter": (q_crawl_filter, ()),
    "denylist": (q_denylist, ()),
    "contract_filter": (q_contract_filter, ()),
    "month_in_force": (q_month_in_force, ()),
    "city_deadline": (q_city_deadline, ()),
    "suite_toilets": (q_suite_toilets, ()),
    "decoration_cost": (q_decoration_cost, ("decoration_cost", "final_cost", "total_yuan")),
    "suite_profile": (q_suite_profile, ()),
    "contract_fanout": (q_contract_fanout, ()),
    "lookup_left": (q_lookup_left, ()),
    "decoration_fanout": (q_decoration_fanout, ()),
    "never_available": (q_never_available, ()),
    "std_deviations": (q_std_deviations, ()),
    "crawl_deviations": (q_crawl_deviations, ()),
    "score_own": (q_score_own, ("std_room_outprice_pre",)),
    "score_crawl": (q_score_crawl, ("std_room_outprice_pre",)),
    "score_room": (q_score_room, ("block_std_price", "room_pred")),
    "own_median": (q_own_median, ("std_room_outprice_pre", "final_std_room_outprice_pre")),
    "crawl_quantile": (q_crawl_quantile, ("std_room_outprice_pre", "final_std_room_outprice_pre")),
    "reconcile_full_join": (q_reconcile_full_join, ("final_own", "final_crawl", "xiaoqu_std_price_final")),
    "block_means": (q_block_means, ("xiaoqu_std_price_final", "block_std_price")),
    "attach_prices": (q_attach_prices, ("xiaoqu_std_price_final", "block_std_price")),
    "coverage_gaps": (q_coverage_gaps, ()),
    "snap_price": (q_snap_price, ("snapped",)),
    "unit_ratios": (q_unit_ratios, ("puzu_avg_price", "puzu_avg_area", "avg_price_area")),
    "group_ratio_median": (q_group_ratio_median, ("room_avg_price", "room_median_price")),
    "community_ratio_median": (q_community_ratio_median, ("com_avg_price", "com_median_price")),
    "match_modes": (q_match_modes, ()),
    "quantile_rule": (q_quantile_rule, ("final_std_room_outprice_pre",)),
    "load_violations": (q_load_violations, ()),
    "load_conformed": (q_load_conformed, ()),
    "csv_roundtrip": (q_csv_roundtrip, ("decoration_cost",)),
    "suite_buckets": (q_suite_buckets, ("decoration_cost",)),
    "profile": (q_profile, ("min", "q1", "median", "mean", "q3", "max")),
    "job_a": (q_job_a, ()),
    "job_b": (q_job_b, ()),
    "job_c": (q_job_c, ("decoration_cost",)),
    "job_d": (
        q_job_d,
        ("puzu_avg_price", "puzu_avg_area", "avg_price_area", "room_avg_price", "room_median_price", "com_avg_price", "com_median_price"),
    ),
    "job_e": (q_job_e, ("std_room_outprice_pre", "final_std_room_outprice_pre")),
    "job_f": (q_job_f, ("std_room_outprice_pre", "final_std_room_outprice_pre")),
    "job_g": (q_job_g, ("xiaoqu_std_price_final", "block_std_price")),
    "job_h": (q_job_h, ("decoration_cost", "xiaoqu_std_price_final", "block_std_price")),
    "job_i": (q_job_i, ("decoration_cost", "xiaoqu_std_price_final", "block_std_price", "room_outprice_pre", "adj_room_outprice_pre")),
}


def queries() -> dict[str, Query]:
    def wrap(fn: Query, cols: tuple[str, ...]) -> Query:
        return lambda spark, sf_dir: _round(fn(spark, sf_dir), cols)

    return {name: wrap(fn, cols) for name, (fn, cols) in SPECS.items()}
