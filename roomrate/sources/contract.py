"""SRC1: what the jobs expect of each input table, checked and applied where it is read.

The original takes whatever types the server sends and leaves NaN and zero dates to the steps
behind. Here every table has a declared schema. ``conform`` checks it when the plan is built (a
missing column or a type that cannot be read raises by name) and reads the columns as declared:
text that is no number or date becomes NULL, as do NaN and the server's zero dates, so that the
jobs meet one kind of missing value only. A column that already has its type passes as it is, so
its filters still reach the scan; only floating-point columns are wrapped for NaN.

What a load replaced is counted by ``violations`` (one pass over the raw table) or, in the same
pass as the batch, by ``conform(..., observation=...)``. An observation must see every row, so
filters do not reach a scan below it: it is for audits, not the default.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

_COSTS = ("decoration", "furniture", "appliance", "allocation", "operation", "follow_operation", "construction_material")

# fixed values: columns and types of the input tables
TABLES: dict[str, str] = {
    "xiaoqus": "id long, city string, block string, name string",
    "suites": (
        "id long, xiaoqu_id long, bedroom_num int, toilet_num int, area double, has_lift string, heating string, "
        "floor string, address string, status string, ready_for_rent_date date, zhuangxiu_end_date date"
    ),
    "rooms": (
        "suite_id long, code string, face string, lighting string, is_small_window string, shape string, "
        "shape_note string, rent_type string, status string, has_toilet string, has_shower string, "
        "has_balcony string, has_storeroom string, has_terrace string, area double, living_area double, "
        "balcony_area double, terrace_area double, toilet_area double, storeroom_area double, price double, "
        "available_date date, deleted_at date"
    ),
    "f_bi_sfinfor_day": "suite_id long, before_room_num int",
    "archive_ziroom": (
        "city string, community_name string, business_district string, business_district_block string, "
        "bedroom_num string, building_area string, independent_balcon string, price string, orientation string, "
        "private_bathroom string, style string, product_type string, date_created string"
    ),
    "xiaoqurelations": "city string, jingdui string, block string, company string",
    "suite_decorations": (
        "suite_id long, suite_status string, measure_approve_status string, "
        + ", ".join(f"{c}_{kind} double" for kind in ("budget", "amount") for c in _COSTS)
        + ", total_yuan double, measure_approve_pass_at timestamp, supplier_end_date date"
    ),
    "contract_with_landlords": (
        "id long, suite_id long, house_pricing_id long, status string, type string, sign_date date, "
        "origin_bedroom_num int, months int, free_days int"
    ),
    "landlord_payment_schedules": "contract_id long, monthly_price double, date date, end_date date, deleted_at date",
    "house_pricing": "id long, sales_wish_sum_price_yuan double",
    "community_house_type": "city string, block string, xiaoqu_name string, bedroom_num int, area double, price double, data_date date",
    "city_level": "city string, city_level int",
    "ensemble": "model string, tree int, node int, feature string, split double, yes int, no int, missing int, leaf double",
}
# fixed values: what the server stores for a date it does not have, and what its drivers may make of it
ZERO_DATES = ("0000-00-00", "0001-01-01")

UNREADABLE, NAN, ZERO_DATE = "unreadable", "nan", "zero_date"


class ContractViolation(ValueError):
    """A table that cannot be read as declared."""


@dataclass(frozen=True)
class Rule:
    """How one column is read, and the conditions under which a value is replaced by NULL."""

    column: str
    value: Column
    faults: tuple[tuple[str, Column], ...] = ()


def schema_of(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def _rule(table: str, field: T.StructField, found: T.DataType, zero_dates: bool) -> Rule:
    name, want, raw = field.name, field.dataType, F.col(f"`{field.name}`")
    number = isinstance(want, T.NumericType)
    floating = isinstance(want, (T.DoubleType, T.FloatType))
    dated = isinstance(want, (T.DateType, T.TimestampType, T.TimestampNTZType))
    text = isinstance(found, T.StringType)
    time = isinstance(found, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if isinstance(want, T.StringType) and (text or isinstance(found, T.NumericType) or time):
        return Rule(name, raw if text else raw.cast("string"))
    if not (number and (text or isinstance(found, T.NumericType))) and not (dated and (text or time)):
        raise ContractViolation(f"{table}.{name}: {found.simpleString()} cannot be read as {want.simpleString()}")
    value = raw if found == want else F.trim(raw).try_cast(want) if text else raw.try_cast(want)
    faults = []
    zero = None
    if dated and text:
        zero = F.substring(F.trim(raw), 1, 10).isin(*ZERO_DATES)
    elif dated and zero_dates:
        zero = raw.cast("date") == F.lit(ZERO_DATES[1]).cast("date")
    if zero is not None:
        faults.append((ZERO_DATE, zero))
    if floating and (text or isinstance(found, (T.DoubleType, T.FloatType))):
        faults.append((NAN, F.isnan(value)))
    if found != want:
        unreadable = raw.isNotNull() & value.isNull()
        faults.append((UNREADABLE, unreadable if zero is None else unreadable & ~zero))
    for kind, fault in faults:
        if kind != UNREADABLE:  # its value is NULL as it is
            value = F.when(~fault, value)
    return Rule(name, value, tuple(faults))


def rules(df: DataFrame, name: str, zero_dates: bool = False) -> list[Rule]:
    """A rule per declared column. ``zero_dates``: typed dates may hold the drivers' zero date."""
    found = {f.name: f.dataType for f in df.schema.fields}
    wanted = schema_of(name).fields
    gone = [f.name for f in wanted if f.name not in found]
    if gone:
        raise ContractViolation(f"{name}: missing column{'s' * (len(gone) > 1)} {', '.join(gone)}")
    return [_rule(name, f, found[f.name], zero_dates) for f in wanted]


def _counts(found: list[Rule]) -> list[Column]:
    return [F.count_if(F.coalesce(fault, F.lit(False))).alias(f"{r.column}:{kind}") for r in found for kind, fault in r.faults]


def conform(df: DataFrame, name: str, zero_dates: bool = False, observation: Observation | None = None) -> DataFrame:
    """``df`` with the declared columns of table ``name`` read as declared; other columns as they are.

    With an ``observation``, the replaced values of every column are counted by the action that
    reads the table (``column:kind`` in ``observation.get``).
    """
    found = rules(df, name, zero_dates)
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"), *_counts(found))
    return df.withColumns({r.column: r.value for r in found if r.faults or df.schema[r.column].dataType != schema_of(name)[r.column].dataType})


def violations(df: DataFrame, name: str, zero_dates: bool = False) -> DataFrame:
    """(table, column, rule, rows): how many values of each column a load replaces, by rule; none are left out."""
    counts = _counts(rules(df, name, zero_dates))
    schema = "table string, column string, rule string, rows long"
    if not counts:
        return df.sparkSession.createDataFrame([], schema)
    totals = df.agg(*counts)
    parts = [F.struct(*[F.lit(p).alias(n) for n, p in zip(("column", "rule"), c.split(":"))], F.col(f"`{c}`").alias("rows")) for c in totals.columns]
    return totals.select(F.explode(F.array(*parts)).alias("x")).select(F.lit(name).alias("table"), "x.column", "x.rule", "x.rows")
