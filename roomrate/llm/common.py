"""Helpers shared by the operators: words, shared scratch tables, Arrow batch bounds."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word everywhere in this package: ``[^\x20\x09-\x0D]+``. ``bytes.split()`` cuts at
#: exactly these six characters, so ``text.encode().split()`` gives the words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that goes to Python. Documents run to a few hundred kB each,
#: so the default of 10,000 rows could hold gigabytes.
ARROW_ROWS = 500


def bound_arrow(spark: SparkSession) -> None:
    """Bounds the rows that one Arrow batch carries to Python in this session."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting (tests) gets a folder of its own.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="roomrate-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, kept
    when executors are lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_struct(
    df: DataFrame, name: str, column: Column, returns: str, batch: Callable[[pa.Array], pa.Array],
    setup: Callable[[], object] | None = None,
) -> DataFrame:
    """Adds struct column ``name``, computed by ``batch`` from Arrow batches of ``column``.

    ``setup`` runs once per task and its value is passed to ``batch``. Only ``column``
    travels to Python; the other columns stay in the JVM, so rows are never joined back.
    """

    @F.arrow_udf(returns)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        state = (setup(),) if setup else ()
        for b in batches:
            yield batch(b, *state)

    bound_arrow(df.sparkSession)
    return df.withColumn(name, run(column))


def texts(batch: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    return [t or b"" for t in batch.cast(pa.binary()).to_pylist()]
