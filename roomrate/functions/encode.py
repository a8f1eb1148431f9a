"""Categorical encodings of the listing tables (ENC1-ENC13, ENC8 crawl flags).

Every function maps Columns to a Column and stays inside whole-stage codegen.
The Chinese literals are data values of the source tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: category labels as they appear in the source tables
YES = "有"
FACE_NORTH = "北"
FACE_WEST = ("西", "西北")
FACE_EAST = ("东", "东北")
LIGHT_SHARED = "非私有采光"
LIGHT_NONE = "无采光"
LIGHT_PRIVATE = "私有采光"
SMALL_WINDOW_NO = "否"
SHAPE_NARROW = "狭长型"
SHAPE_SLOPED = "斜顶"
SHAPE_OTHER = "其他"
SHAPE_NORMAL = "正常"
SHAPE_IRREGULAR_NOTES = ("不规则", "异型", "异形", "刀把型", "手枪型", "L型", "T字型")
HEATING_CENTRAL = "集中供暖"
STATUS_RENTABLE = "可出租"
WHOLE_UNIT = "整租"
CRAWL_BALCONY = "独立阳台"
CRAWL_BATHROOM = "独卫"
CRAWL_STYLE_4 = "4.0"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def has_text(col: Column | str, part: str, any_case: bool = False) -> Column:
    """``LIKE '%part%'``; with ``any_case`` as under the server's case-insensitive collations."""
    c = _c(col)
    return (F.collate(c, "UTF8_LCASE") if any_case else c).contains(part)


def yes_flag(col: Column | str, yes: str = YES) -> Column:
    """ENC1/ENC6/ENC8: 1 when the label equals ``yes``, else 0 (NULL -> 0)."""
    return F.when(_c(col) == yes, F.lit(1)).otherwise(F.lit(0))


def face_code(col: Column | str) -> Column:
    """ENC2: north 1; west/north-west 2; east/north-east 3; anything else (NULL too) 4."""
    c = _c(col)
    return (
        F.when(c == FACE_NORTH, F.lit(1))
        .when(c.isin(*FACE_WEST), F.lit(2))
        .when(c.isin(*FACE_EAST), F.lit(3))
        .otherwise(F.lit(4))
    )


def lighting_code(col: Column | str) -> Column:
    """ENC3: shared light 0, no light -1, else 1."""
    c = _c(col)
    return F.when(c == LIGHT_SHARED, F.lit(0)).when(c == LIGHT_NONE, F.lit(-1)).otherwise(F.lit(1))


def small_window_code(col: Column | str) -> Column:
    """ENC4: 'not a small window' 1, else 0."""
    return F.when(_c(col) == SMALL_WINDOW_NO, F.lit(1)).otherwise(F.lit(0))


def irregular_note(note: Column | str, any_case: bool = False) -> Column:
    """Any of the irregular-shape notes occurs in the text (LIKE '%x%' OR ...)."""
    n = _c(note)
    cond = None
    for pat in SHAPE_IRREGULAR_NOTES:
        term = has_text(n, pat, any_case)
        cond = term if cond is None else (cond | term)
    return cond


def shape_code(shape: Column | str, note: Column | str, any_case: bool = False) -> Column:
    """ENC5: narrow -1, sloped 0, 'other' with an irregular note -2, else 1."""
    s = _c(shape)
    return (
        F.when(s == SHAPE_NARROW, F.lit(-1))
        .when(s == SHAPE_SLOPED, F.lit(0))
        .when((s == SHAPE_OTHER) & irregular_note(note, any_case), F.lit(-2))
        .otherwise(F.lit(1))
    )


def status_code(col: Column | str) -> Column:
    """ENC7: rentable 0, else 1."""
    return F.when(_c(col) == STATUS_RENTABLE, F.lit(0)).otherwise(F.lit(1))


def style_code(col: Column | str) -> Column:
    """ENC8: crawl style containing '4.0' -> 4, else 0."""
    return F.when(_c(col).contains(CRAWL_STYLE_4), F.lit(4)).otherwise(F.lit(0))


def area_by_rent_type(rent_type: Column | str, total_area: Column | str, room_area: Column | str) -> Column:
    """ENC13: whole-unit lets are priced on the flat's area, shared ones on the room's."""
    return F.when(_c(rent_type).contains(WHOLE_UNIT), _c(total_area)).otherwise(_c(room_area))


def block_if_mapped(company: Column | str, mapped_block: Column | str, own_block: Column | str) -> Column:
    """ENC11: take the mapped block whenever a mapping row exists, even if its block is NULL.

    Not a coalesce: the test is on ``company``, not on the block itself.
    """
    return F.when(_c(company).isNotNull(), _c(mapped_block)).otherwise(_c(own_block))


# ---------------------------------------------------------------- city tiers
# ENC9: four different tier rules are used by the four extracts; they are kept
# apart on purpose (same city, different tier).

# fixed values: tier rule of the own-listing extract (names end in 市)
TIER_A = (("北京市",), ("深圳市", "上海市"), ("杭州市", "广州市"))
# fixed values: tier rule of the crawl extract (names without 市)
TIER_B = (("北京", "上海"), ("深圳",), ("杭州", "广州"))
# fixed values: tier rule of the rooms-to-price extract
TIER_C = (("北京市", "上海市"), ("深圳市",), ("杭州市", "广州市"))
# fixed values: the inline city table of the whole-unit statistics (8 rows)
CITY_LEVEL_ROWS = (
    ("北京市", 1),
    ("上海市", 1),
    ("深圳市", 2),
    ("杭州市", 3),
    ("广州市", 3),
    ("天津市", 4),
    ("南京市", 4),
    ("武汉市", 4),
)


def tier(city: Column | str, rule: tuple[tuple[str, ...], ...]) -> Column:
    """Tier 1..len(rule) by membership, 4 for every other value (NULL too)."""
    c = _c(city)
    expr = None
    for level, names in enumerate(rule, start=1):
        cond = c.isin(*names)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(4))
