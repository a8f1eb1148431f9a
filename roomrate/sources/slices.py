"""Parallel reads of a server's table: key ranges that hold equal numbers of rows.

Even ranges between the smallest and the largest key leave most rows to few tasks when keys are
clustered. Here the server names the keys that cut its rows into equal parts (one row per
part comes back), and each part is one predicate, one task. Rows without a key have a part of
their own, so no row is lost, and a table is never read by a single task because nobody gave it bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

#: Parts of a table when the caller names no number.
SLICES = 32
# fixed values: the indexed key that each warehouse table is read along
KEYS = {
    "xiaoqus": "id", "suites": "id", "rooms": "suite_id", "f_bi_sfinfor_day": "suite_id", "archive_ziroom": "date_created",
    "xiaoqurelations": "jingdui", "suite_decorations": "suite_id", "contract_with_landlords": "id",
    "landlord_payment_schedules": "contract_id", "house_pricing": "id", "community_house_type": "data_date",
}


def bounds_query(table: str, key: str, slices: int = SLICES) -> str:
    """SQL for the server: the smallest key of each of ``slices`` equal parts, at most so many rows."""
    parts = f"select {key} as k, ntile({slices}) over (order by {key}) as part from {table} where {key} is not null"
    return f"(select min(k) as bound from ({parts}) as parts group by part) as bounds"


def _literal(value: object) -> str:
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no key: {value!r}")
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"


def predicates(key: str, bounds: Sequence[object]) -> list[str]:
    """Predicates that together take every row once: the ranges between ``bounds``, the rows below
    the first and from the last on, and the rows without a key.

    Repeated bounds (one key that fills several parts) count once; a key is never divided.
    """
    cuts = sorted({b for b in bounds if b is not None})[1:]  # the smallest key cuts nothing off
    if not cuts:
        return [f"{key} is not null", f"{key} is null"]
    at = [_literal(c) for c in cuts]
    inner = [f"{key} >= {a} and {key} < {b}" for a, b in zip(at, at[1:])]
    return [f"{key} < {at[0]}", *inner, f"{key} >= {at[-1]}", f"{key} is null"]
