"""SRC1-SRC3: the warehouse tables as DataFrames.

``RentalTables`` is a plain mapping of table name -> DataFrame. Nothing is read
until an action runs, so a job only scans the columns and row groups it uses
(Catalyst pushes projections and filters into the Parquet / JDBC scan).

Constructors:

* ``from_driver``   - the test/bench tables derived from the driver's TPC-H-ish
                       Parquet files with the fixture SQL (FIXTURES.md §2);
* ``from_parquet``  - one Parquet folder per table under a root;
* ``from_catalog``  - metastore tables of one database;
* ``from_jdbc``     - the MySQL warehouse itself, read in parallel slices.

The last three read every table by its declared schema (``contract.conform``).
"""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from roomrate.sources.buckets import bucketed
from roomrate.sources.contract import TABLES, conform, rules
from roomrate.sources.fixture_sql import DRIVER_TABLES, FIXTURE_SQL
from roomrate.sources.slices import KEYS, SLICES, bounds_query, predicates

RENTAL_TABLES = tuple(FIXTURE_SQL)

# DataFrames are immutable plans: sharing one analysed fixture plan between
# queries of a session saves re-parsing and re-analysing the fixture SQL.
_DRIVER_CACHE: "weakref.WeakKeyDictionary[SparkSession, dict]" = weakref.WeakKeyDictionary()


class RentalTables(Mapping[str, DataFrame]):
    """Named input tables of the pricing jobs (built lazily, once per name)."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]], in_buckets: Callable[[], frozenset[str]] = frozenset):
        self._frames = dict(frames)
        self._in_buckets = in_buckets
        self._derived: dict[str, DataFrame] = {}

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A plan derived from these tables, built once and shared by every job."""
        if name not in self._derived:
            self._derived[name] = build()
        return self._derived[name]

    @property
    def in_suite_buckets(self) -> bool:
        """Whether rooms and suites are stored in buckets of their suite (``sources.buckets``)."""
        return {"rooms", "suites"} <= self._in_buckets()

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if callable(frame) and not isinstance(frame, DataFrame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self):
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        try:
            return self[name]
        except KeyError as exc:
            raise AttributeError(name) from exc

    # ------------------------------------------------------------ constructors
    @classmethod
    def from_driver(cls, spark: SparkSession, sf_dir: str, names: Iterable[str] = RENTAL_TABLES) -> "RentalTables":
        """Fixture views over the driver tables; one instance per (session, folder)."""
        key = (sf_dir, tuple(names))
        cache = _DRIVER_CACHE.setdefault(spark, {})
        if key not in cache:
            driver: dict[str, DataFrame] = {}

            def table(t: str) -> DataFrame:
                if t not in driver:
                    driver[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
                return driver[t]

            def build(name: str) -> Callable[[], DataFrame]:
                sql = FIXTURE_SQL[name]

                def view() -> DataFrame:
                    found = spark.sql(sql, **{t: table(t) for t in DRIVER_TABLES if "{" + t + "}" in sql})
                    rules(found, name)  # a fixture that departs from the declared columns raises here
                    return found

                return view

            cache[key] = cls({name: build(name) for name in key[1]})
        return cache[key]

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: Iterable[str] = RENTAL_TABLES) -> "RentalTables":
        return cls({n: (lambda n=n: conform(spark.read.parquet(f"{root.rstrip('/')}/{n}"), n)) for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str, names: Iterable[str] = RENTAL_TABLES) -> "RentalTables":
        names = tuple(names)
        frames = {n: (lambda n=n: conform(spark.table(f"{database}.{n}"), n)) for n in names}
        return cls(frames, lambda: bucketed(spark, database, names))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        properties: Mapping[str, str],
        tables: Mapping[str, str],
        slices: Mapping[str, tuple[str, int]] | None = None,
    ) -> "RentalTables":
        """Read warehouse tables over JDBC, each by several tasks.

        ``tables`` maps our name to the server's (``{"rooms": "warehouse.rooms"}``). A table is
        cut along its key (``slices.KEYS``, or ``(column, number)`` in ``slices``) at bounds
        that the server finds; see ``slices``. Credentials come in ``properties`` (never
        prompted).
        """

        def read(name: str, server_name: str) -> DataFrame:
            key, number = (slices or {}).get(name) or (KEYS[name], SLICES)
            bounds = spark.read.jdbc(url, bounds_query(server_name, key, number), properties=dict(properties))
            cuts = [r["bound"] for r in bounds.collect()]  # at most one row per slice
            found = spark.read.jdbc(url, server_name, predicates=predicates(key, cuts), properties=dict(properties))
            return conform(found, name, zero_dates=True) if name in TABLES else found

        return cls({name: (lambda name=name, server=server: read(name, server)) for name, server in tables.items()})
