"""SNK1 / SNK2: dated CSV outputs.

The reference writes one file named after the run date. Spark writes a folder
of part files per run (``<root>/<name>/run_date=YYYY-MM-DD/run-...``), one per
output task, so the write is as parallel as the job; ``_published.json`` of the date
names the run that readers take and its number of rows. A missing value is an empty field and an empty text is ``""``,
so neither can be taken for the text ``NA``; quotes are doubled, blanks and line
breaks inside a text are kept.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: The same options write and read.
OPTIONS = {
    "header": "true", "encoding": "UTF-8", "nullValue": "", "emptyValue": '""', "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


#: Stands for a quoted empty field while reading, where Spark would make it the null value. A text
#: that begins with this mark is written with one more, so no text can be taken for it.
MARK = "\x01"
POINTER = "_published.json"


def dated_path(root: str, name: str, as_of: dt.date) -> str:
    return f"{root.rstrip('/')}/{name}/run_date={as_of.isoformat()}"


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, StringType)]


class _Store:
    """Small files and folders of any store that Spark writes to."""

    def __init__(self, spark: SparkSession, folder: str):
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop
        self._path = lambda *parts: self._hadoop.fs.Path("/".join((folder, *parts)))
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path().getFileSystem(conf)
        self._context = self._hadoop.fs.FileContext.getFileContext(self._files.getUri(), conf)
        self._replace = spark.sparkContext._gateway.new_array(self._hadoop.fs.Options.Rename, 1)
        self._replace[0] = self._hadoop.fs.Options.Rename.OVERWRITE
        self._text = jvm.org.apache.commons.io.IOUtils

    def read(self, name: str) -> str | None:
        if not self._files.exists(self._path(name)):
            return None
        stream = self._files.open(self._path(name))
        try:
            return self._text.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Replaces the file in one step: readers meet the old or the new one."""
        staged = f"{name}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(staged), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._context.rename(self._path(staged), self._path(name), self._replace)

    def folders(self) -> list[str]:
        return [s.getPath().getName() for s in self._files.listStatus(self._path()) if s.isDirectory()]

    def drop(self, name: str) -> None:
        self._files.delete(self._path(name), True)


def write_dated_csv(df: DataFrame, root: str, name: str, as_of: dt.date) -> str:
    """Publishes ``df`` as the run of its date; a rerun of the date replaces it.

    The rows are written to a folder of their own beside what readers see. Only when all of them
    are there, a pointer with their number is put in place in one step, and folders of runs before
    the one that it replaced are dropped (its readers may still be at work). A write that fails
    leaves the run that was published before.
    """
    path, run = dated_path(root, name, as_of), f"run-{uuid.uuid4().hex}"
    spark, counted = df.sparkSession, Observation()
    marked = df.withColumns({c: F.when(F.col(c).startswith(MARK), F.concat(F.lit(MARK), c)).otherwise(F.col(c)) for c in _texts(df.schema)})
    marked.observe(counted, F.count(F.lit(1)).alias("rows")).write.options(**OPTIONS).csv(f"{path}/{run}")
    store = _Store(spark, path)
    before = published(spark, root, name, as_of)
    store.put(POINTER, json.dumps({"run": run, "rows": counted.get["rows"], "columns": df.columns}))
    for old in store.folders():
        if old not in (run, (before or {}).get("run")):
            store.drop(old)
    return path


def published(spark: SparkSession, root: str, name: str, as_of: dt.date) -> dict | None:
    """What is published for a date: ``run`` (its folder), ``rows``, ``columns``; None if nothing is."""
    text = _Store(spark, dated_path(root, name, as_of)).read(POINTER)
    return json.loads(text) if text else None


def read_dated_csv(spark: SparkSession, root: str, name: str, as_of: dt.date, schema: StructType) -> DataFrame:
    """Read the published run back with the writer's schema (no inference)."""
    found = published(spark, root, name, as_of)
    if not found:
        raise FileNotFoundError(f"nothing is published under {dated_path(root, name, as_of)}")
    options = OPTIONS | {"emptyValue": MARK, "multiLine": "true"}
    df = spark.read.options(**options).schema(schema).csv(f"{dated_path(root, name, as_of)}/{found['run']}")
    bare = {
        c: F.when(F.col(c) == MARK, "").when(F.col(c).startswith(MARK), F.expr(f"substring(`{c}`, 2)")).otherwise(F.col(c))
        for c in _texts(schema)
    }
    return df.withColumns(bare)
