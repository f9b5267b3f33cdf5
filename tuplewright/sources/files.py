"""JSON-lines, Parquet and settings files."""
from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dims


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


_SIDE = _texts("source_type", "entity_group", "word")
_META = T.StructType([T.StructField("pair_id", T.StringType()), T.StructField("subject", _SIDE), T.StructField("object", _SIDE)])
RAW = T.StructType(
    [
        *_texts("id", "text").fields,
        T.StructField("candidate_pairs", T.ArrayType(_texts("pair_id", "subject", "object", "relation"))),
        T.StructField("meta_info", T.ArrayType(_META)),
    ]
)
PREDICTION = T.StructType([T.StructField("row_id", T.LongType()), *_texts("full_input", "prediction", "ground_truth").fields])


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: T.StructType, fail_on_broken: bool = True) -> DataFrame:
    """Blank lines are skipped; a broken line fails the job or, if asked, is nulls."""
    return spark.read.schema(schema).option("mode", "FAILFAST" if fail_on_broken else "PERMISSIVE").json(paths)


#: A document as its line holds it: pairs may be objects or, wrongly, plain text.
_LINE = T.StructType([RAW["id"], RAW["text"], T.StructField("candidate_pairs", T.ArrayType(T.StringType())), RAW["meta_info"]])
_PAIR = RAW["candidate_pairs"].dataType.elementType


def read_documents(spark: SparkSession, paths: str | list[str], fallback: str = "all", prefix: str = "", fail_on_broken: bool = True) -> DataFrame:
    """Documents of JSON-lines files, with ids.

    A line without an id becomes ``fallback_{n}``, n its place among all documents
    in the order of the paths given (files of a folder by name); an id that is
    null becomes "None".  A pair that is plain text becomes a negative pair of
    unknown sides.  Blank lines are skipped and not counted.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    parts = []
    for k, path in enumerate(given):
        lines = spark.read.text(path).select("value", F.lit(k).alias("_given"), F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
        parts.append(lines)
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    mode = {"mode": "FAILFAST" if fail_on_broken else "PERMISSIVE"}
    read = whole.where("trim(value) <> ''").withColumn("_at", F.monotonically_increasing_id()).withColumn("d", F.from_json("value", _LINE, mode))
    unknown = F.struct(F.lit("UNK").alias("pair_id"), F.lit("UNKNOWN").alias("subject"), F.lit("UNKNOWN").alias("object"), F.lit("NO_RELATION").alias("relation"))
    pair = F.transform("d.candidate_pairs", lambda p: F.when(p.isNull(), F.lit(None).cast(_PAIR)).otherwise(F.when(F.ltrim(p).startswith("{"), F.from_json(p, _PAIR, mode)).otherwise(unknown)))
    # An id that is null is not one that is missing.
    named = F.coalesce("d.id", F.when(F.array_contains(F.json_object_keys("value"), "id"), F.lit("None")))
    docs = kept(read.select("_given", "_path", "_start", "_at", named.alias("id"), "d.text", pair.alias("candidate_pairs"), "d.meta_info"))
    return _numbered(docs, ["_given", "_path", "_start"], fallback, prefix)


def with_ids(docs: DataFrame, fallback: str = "all", prefix: str = "") -> DataFrame:
    """Ids as text; a missing one becomes ``fallback_{n}``, n its place among all
    rows.  Rows are numbered once, as written, by offsets and not in one task."""
    marked = kept(docs.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftrightunsigned("_at", 33)))
    return _numbered(marked, ["_part"], fallback, prefix)


def _numbered(docs: DataFrame, run: list[str], fallback: str, prefix: str) -> DataFrame:
    """``_at`` counts up by one within a run of rows; runs are ordered by their columns."""
    # One row a file split or partition.
    runs = docs.groupBy(*run).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = runs.select(*run, "_first", F.coalesce(F.sum("_n").over(Window.orderBy(*run).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = (F.col("_before") + F.col("_at") - F.col("_first")).cast("string")
    made = F.concat(F.lit(prefix), F.coalesce(F.col("id").cast("string"), F.concat(F.lit(f"{fallback}_"), place)))
    return docs.join(before, run).withColumn("id", made).drop(*run, "_at", "_first", "_before")


def write_splits(rows: DataFrame, path: str) -> None:
    """``train`` always, even if empty; any other split only if it has rows."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
    rows.where("split = 'train'").drop("split").limit(0).write.mode("append").parquet(f"{path.rstrip('/')}/split=train")


def write_rows(rows: DataFrame, path: str) -> None:
    """One flat table."""
    rows.write.mode("overwrite").parquet(path)


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def cached_path(root: str, settings: dict) -> str:
    """A path that changes with the settings."""
    return f"{root.rstrip('/')}/{hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]}"


def read_or_make(spark: SparkSession, path: str, make) -> DataFrame:
    """The stored result if a complete one is there, else ``make()`` stored and read."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        make().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def settings(text: str) -> dict:
    """Settings from JSON, or from YAML where a YAML reader is installed."""
    try:
        return json.loads(text)
    except ValueError:
        import yaml

        return yaml.safe_load(text)


def signature(template: str, length: int = 250) -> str:
    """What tells a prompt template apart: no comment lines, no white space, its beginning."""
    lines = [x for x in template.split("\n") if not x.lstrip().startswith("#")]
    return re.sub(r"\s+", "", "".join(lines))[:length]


def signatures(prompts: str) -> tuple[tuple[str, str], ...]:
    """(task, signature) of the prompts that YAML settings hold as literal blocks under fixed keys."""
    found = []
    for key, task in dims.PROMPT_KEYS.items():
        at = re.search(rf"{key}[^\S\n]*:\s*\|", prompts)
        if at:
            rest = prompts[at.end() :]
            after = re.search(r"\n\w+\s*:\s*\|", rest, re.A)
            found.append((task, signature(rest[: after.start()] if after else rest)))
    return tuple(found)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Only a session
    without executors of its own may leave it unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set")
    return (where or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints").rstrip("/")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once in the shared folder and read again."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/run-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
