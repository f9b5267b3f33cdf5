"""Shared helpers: input projection, Arrow batches, durable intermediates."""
from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names; any other column of the
    input, whatever its name, is left behind here."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in columns.items()])


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def schema(*fields: tuple[str, T.DataType | str]) -> T.StructType:
    plain = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "binary": T.BinaryType(), "boolean": T.BooleanType(), "double": T.DoubleType()}
    out = T.StructType()
    for name, kind in fields:
        out = out.add(name, plain[kind] if isinstance(kind, str) else kind, True)
    return out


def arrow_schema(struct: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def small_batches(spark: SparkSession, size: str = "2m") -> None:
    """Arrow batches to Python workers hold about ``size`` bytes, so a batch of
    long texts fits in a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Only
    a session without executors of its own may leave it unset (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set")
    return (where or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints").rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage with files in the shared folder, which survive the loss of any executor."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """``df`` written to a fresh path of the shared folder, and read from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete what ``stored`` wrote."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` evaluated once and bound to ``x``."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: str) -> list[bytes]:
    """A-Z lower-cased, cut at space and \\x09-\\x0D, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split()
