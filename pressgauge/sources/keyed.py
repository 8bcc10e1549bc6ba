"""A Parquet table updated by key, copy on write by bucket.

Rows lie in buckets by a hash of their keys, each bucket in the folder of the write that made it, and a commit says
which write that is for each bucket. An update rewrites only the buckets that its changes fall into and commits their
new places; the other files stay as they are. Nothing that is read is overwritten: a failed update is not seen, readers
of the commits before go on for RETAIN commits, and of two writers that meet the later one starts again from the
other's commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgauge.sources import tables

#: Commits after which buckets that were rewritten are deleted.
RETAIN = 10
_BUCKET, _WRITE = "pg_bucket", "pg_write"


def create(rows: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """A new table of ``rows``, one per key. An update costs as many buckets as it touches: take some hundred MB each."""
    if {_BUCKET, _WRITE} & set(rows.columns):
        raise ValueError(f"{_BUCKET} and {_WRITE} are names of the table's own")
    spark = rows.sparkSession
    if tables.commits(spark, path):
        raise FileExistsError(path)
    write = uuid.uuid4().hex
    made = _written(rows.withColumn(_BUCKET, _bucket(keys, buckets)), path, write)
    state = {
        "keys": keys, "buckets": buckets, "schema": json.loads(rows.schema.json()), "at": {str(b): write for b in made}, "gone": [],
    }
    if not tables.publish(spark, path, 1, state):
        raise FileExistsError(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the newest commit, in one scan."""
    _, state = _state(spark, path)
    return _scan(spark, path, state, state["at"]).drop(_BUCKET)


def update(spark: SparkSession, path: str, changes: DataFrame) -> int:
    """Give rows the values of the ``changes`` row of their key, nulls included, and return the number of buckets
    rewritten. ``changes`` has the keys, one row each, and any of the other columns; it is evaluated once. Keys that
    the table does not hold are not inserted."""
    _, state = _state(spark, path)
    staged = f"{path}/staged/{uuid.uuid4().hex}"
    changes.withColumn(_BUCKET, _bucket(state["keys"], state["buckets"])).write.partitionBy(_BUCKET).parquet(staged)
    try:
        while True:
            number, state = _state(spark, path)
            touched = [b for b in _folders(spark, staged) if b in state["at"]]
            if not touched:
                return 0
            new = spark.read.schema(T.StructType([*changes.schema, T.StructField(_BUCKET, T.IntegerType())])).parquet(staged)
            rows = tables.keyed_update(_scan(spark, path, state, touched), new, [*state["keys"], _BUCKET])
            schema = T.StructType.fromJson(state["schema"])
            write = uuid.uuid4().hex
            _written(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema], _BUCKET), path, write)
            gone = [{"bucket": b, "write": state["at"][b], "since": number + 1} for b in touched]
            old = [g for g in state["gone"] if g["since"] <= number + 1 - RETAIN]
            after = {
                **state, "at": {**state["at"], **dict.fromkeys(touched, write)}, "gone": [*(g for g in state["gone"] if g not in old), *gone],
            }
            if tables.publish(spark, path, number + 1, after):
                for g in old:
                    tables.remove(spark, _place(path, g["write"], g["bucket"]))
                tables.forget_commits(spark, path, number + 1 - RETAIN)
                return len(touched)
            tables.remove(spark, f"{path}/data/{_WRITE}={write}")
    finally:
        tables.remove(spark, staged)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _place(path: str, write: str, bucket: str) -> str:
    return f"{path}/data/{_WRITE}={write}/{_BUCKET}={bucket}"


def _folders(spark: SparkSession, path: str) -> list[str]:
    names = tables.names(spark, path)
    return [n.removeprefix(f"{_BUCKET}=") for n in names if n.startswith(f"{_BUCKET}=")]


def _written(rows: DataFrame, path: str, write: str) -> list[str]:
    """Write buckets, as many tasks each as they need, and name them."""
    target = f"{path}/data/{_WRITE}={write}"
    rows.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(target)
    return _folders(rows.sparkSession, target)


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    done = tables.commits(spark, path)
    if not done:
        raise FileNotFoundError(path)
    return done[-1], tables.commit_content(spark, path, done[-1])


def _scan(spark: SparkSession, path: str, state: dict, buckets: list[str] | dict[str, str]) -> DataFrame:
    """The rows of some buckets."""
    fields = T.StructType.fromJson(state["schema"])
    schema = T.StructType([*fields, T.StructField(_WRITE, T.StringType()), T.StructField(_BUCKET, T.IntegerType())])
    if not buckets:
        return spark.createDataFrame([], schema).drop(_WRITE)
    places = [_place(path, state["at"][b], b) for b in buckets]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*places).drop(_WRITE)
