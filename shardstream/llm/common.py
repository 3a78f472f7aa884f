"""What the operators share: reading tables, rows mapped in Arrow batches, tables pinned between steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from shardstream.session import new_folder

ROWS_AT_ONCE = 128
#: Rows of whole texts that Spark hands to Python at a time, where all else is at its default of 10 000.
TEXTS_AT_ONCE = 4 * ROWS_AT_ONCE
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pin(table: DataFrame, purpose: str) -> DataFrame:
    """Write a table that several steps read to the shared work folder and go on from the files.

    The files outlive any executor. They are removed when the session's file system is closed.
    """
    spark = table.sparkSession
    path = new_folder(spark, purpose)
    for noted in _NOTED:
        noted.append(path)
    table.write.parquet(path)
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return spark.read.schema(table.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that are started meanwhile hand at most ``TEXTS_AT_ONCE`` rows at a time to Python.

    Executor and worker each hold a batch whole, which for a partition of texts is all of them.
    """
    before = spark.conf.get(BATCH_CONF)
    most = int(before)
    spark.conf.set(BATCH_CONF, str(min(most, TEXTS_AT_ONCE) if most > 0 else TEXTS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


#: Lists that hear of every folder pinned while they are in here.
_NOTED: list[list[str]] = []


@contextmanager
def noted_pins() -> Iterator[list[str]]:
    """A list of the folders that are pinned meanwhile."""
    noted: list[str] = []
    _NOTED.append(noted)
    try:
        yield noted
    finally:
        _NOTED[:] = [n for n in _NOTED if n is not noted]


def drop_pins(spark: SparkSession, folders: list[str], in_use: DataFrame) -> list[str]:
    """Remove pinned folders but those that ``in_use`` reads, which are returned."""
    read = {unquote(urlsplit(file).path) for file in in_use.inputFiles()}
    kept = [f for f in folders if any(file.startswith(f"{urlsplit(f).path}/") for file in read)]
    for folder in set(folders).difference(kept):
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return kept


def map_rows(
    table: DataFrame, columns: list[str], schema: str, start: Callable[[], Callable], many: bool = False
) -> DataFrame:
    """Apply a function to each row, a few rows of an Arrow batch at a time.

    ``start()`` runs once per task and returns the function, which gets the values of ``columns`` and
    returns one output row, or with ``many`` an iterable of rows. Other columns are not read.
    """
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                values = zip(*(c.to_pylist() for c in part.columns), strict=True)
                rows = [r for v in values for r in function(*v)] if many else [function(*v) for v in values]
                if rows:
                    made = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, type=f.type) for v, f in zip(made, out, strict=True)], schema=out
                    )

    return table.select(*columns).mapInArrow(run, schema)


def add_columns(table: DataFrame, columns: list[str], added: str, start: Callable[[], Callable]) -> DataFrame:
    """The table with columns that a function makes from the values of ``columns``, as in ``map_rows``.

    All other columns are passed on; those of the added names are replaced.
    """
    new = StructType.fromDDL(added)
    kept = [f for f in table.schema if f.name not in new.names]
    schema = StructType(kept + list(new))
    out = to_arrow_schema(schema, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                values = zip(*(part.column(c).to_pylist() for c in columns), strict=True)
                made = zip(*(function(*v) for v in values), strict=True)
                old = [part.column(f.name).cast(out.field(f.name).type) for f in kept]
                fresh = [pa.array(v, type=out.field(f.name).type) for v, f in zip(made, new, strict=True)]
                yield pa.RecordBatch.from_arrays(old + fresh, schema=out)

    return table.mapInArrow(run, schema)


class Kept(dict):
    """A table that makes what it lacks, and begins anew when full."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        self[key] = made = self.make(key)
        return made


def arrow_schema(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def labelled_sample(labels: DataFrame, label: str, most: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``most`` labelled ids of each label, 0 and 1, chosen by a hash of the id: (id, label).

    The bound makes it safe to broadcast. Null ids and labels are left out; an id labelled twice counts once,
    with its higher label.
    """
    known = labels.select(F.col(id_col).alias("labelled_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("labelled_id is not null and label in (0, 1)").groupBy("labelled_id").agg(
        F.max("label").alias("label")
    )
    by_hash = [F.xxhash64("labelled_id"), F.col("labelled_id")]
    parts = [known.filter(F.col("label") == k).orderBy(*by_hash).limit(most) for k in (0, 1)]
    return parts[0].unionByName(parts[1])
