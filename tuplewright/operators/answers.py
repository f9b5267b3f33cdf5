"""Model answers -> relation tuples -> tuples with metadata; scores."""
from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dims, labels, text

_FIELDS = ("task", "pair_id", "subject", "object", "relation", "is_relational")
_ITEMS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in _FIELDS]))
_READ = T.StructType([T.StructField("items", _ITEMS), T.StructField("text", T.StringType())])
# Keys under which an answer lists the pairs of a task.
_KEYS = ("NER-NER", "NER-BEE", "NER-BEE_TRUE_ONLY", "BEE-BEE", "COMBINE_ALL")


def cleaned(answer: Column) -> Column:
    """Without response heading and code fences."""
    return labels.strip(F.regexp_replace(F.replace(answer, F.lit("### Response:"), F.lit("")), "```json\n?|```", ""))


def _word(value) -> str:
    return str(value.get("word", "")) if isinstance(value, dict) else str(value)


def _text(value) -> str | None:
    return None if value is None else str(value)


def _items_of(answer: str, task: str) -> tuple[list[dict] | None, str | None]:
    """The objects of a JSON answer with the task of their key; else the text to search:
    the answer, or the string that it is as JSON."""
    try:
        data = json.loads(answer)
    except (ValueError, RecursionError):
        return None, answer
    if isinstance(data, str):
        return None, data
    if isinstance(data, dict):
        named = [(k, data[k] if isinstance(data[k], list) else []) for k in _KEYS if k in data]
        if not named:
            named = [(task, [data] if "subject" in data and "object" in data else [])]
    else:
        named = [(task, data if isinstance(data, list) else [])]
    items = [
        {"task": k, "pair_id": str(x.get("pair_id", "UNKNOWN")), "subject": _word(x.get("subject", "")), "object": _word(x.get("object", "")), "relation": _text(x.get("relation")), "is_relational": _text(x.get("is_relational"))}
        for k, items in named
        for x in items
        if isinstance(x, dict)
    ]
    return items, None


@F.arrow_udf(_READ)
def json_items(answers: pa.Array, tasks: pa.Array) -> pa.Array:
    kind = pa.struct([("items", pa.list_(pa.struct([(n, pa.string()) for n in _FIELDS]))), ("text", pa.string())])
    read = (_items_of(a, t) if a is not None else (None, None) for a, t in zip(answers.to_pylist(), tasks.to_pylist()))
    return pa.array([{"items": items, "text": text} for items, text in read], kind)


def _without_note(col: Column) -> Column:
    return labels.strip(F.regexp_replace(col, r"(?U)\s*\([^)]*\)$", ""))


def _bare_relation(col: Column) -> Column:
    return F.translate(labels.strip(F.lower(col)), "[]\"'", "")


def canonical(item: Column) -> Column:
    """(pair_id, subject, object, relation) of a JSON object of an answer, lower-cased."""
    def word(c: Column) -> Column:
        return F.lower(F.translate(labels.strip(c), '"\\', ""))

    binary = item["task"].isin("NER-BEE", "NER-BEE_TRUE_ONLY")
    rel = F.coalesce(item["relation"], item["is_relational"], F.try_element_at(labels.literal_map(dims.DEFAULT_RELATION), item["task"]), F.lit("true"))
    bare = _bare_relation(rel)
    return F.struct(
        labels.strip(item["pair_id"]).alias("pair_id"),
        F.when(binary, _without_note(word(item["subject"]))).otherwise(word(item["subject"])).alias("subject"),
        F.when(binary, _without_note(word(item["object"]))).otherwise(word(item["object"])).alias("object"),
        F.when(binary & ~bare.isin("false", "no_relation", "0"), "true").otherwise(bare).alias("relation"),
    )


def recovered(answer: Column, task: Column) -> Column:
    """Tuples scraped from broken JSON by patterns; the relation defaults to true for every task."""
    binary = task.isin("NER-BEE", "NER-BEE_TRUE_ONLY")

    def fields(block: Column) -> Column:
        """Every field of a block, searched for once."""
        def field(name: str, pattern: str = r'"([^"]+)"') -> Column:
            return F.nullif(F.regexp_extract(block, rf'(?U)"{name}"\s*:\s*{pattern}', 1), F.lit("")).alias(name)

        return F.struct(*[field(n) for n in ("pair_id", "subject", "object", "relation")], field("is_relational", r"(true|false|[^,\s\}]+)"))

    def made(f: Column) -> Column:
        def side(c: Column) -> Column:
            word = F.lower(labels.strip(F.replace(F.replace(c, F.lit('\\"'), F.lit('"')), F.lit("\\'"), F.lit("'"))))
            return F.when(binary, _without_note(word)).otherwise(word)

        bare = _bare_relation(F.coalesce(f["relation"], f["is_relational"], F.lit("true")))
        relation = F.when(binary & ~bare.isin("false", "no_relation", "0"), "true").otherwise(bare)
        return F.struct(F.coalesce(f["pair_id"], F.lit("UNKNOWN")).alias("pair_id"), side(f["subject"]).alias("subject"), side(f["object"]).alias("object"), relation.alias("relation"))

    found = F.transform(F.regexp_extract_all(answer, F.lit(r"(?s)\{(.*?)\}"), F.lit(1)), fields)
    return F.transform(F.filter(found, lambda f: f["subject"].isNotNull() & f["object"].isNotNull()), made)


def parse(answers: DataFrame, answer_col: str = "prediction", task_col: str = "task") -> DataFrame:
    """``answers`` with ``tuples``: the distinct relation tuples of each answer.

    Whether an answer is JSON is decided by one Arrow function; canonical forms
    and recovery are native.  A null answer has no tuples.
    """
    found = answers.withColumn("_read", json_items(cleaned(F.col(answer_col)), F.coalesce(F.col(task_col), F.lit("COMBINE_ALL"))))
    good = F.filter(F.transform("_read.items", canonical), lambda t: (t["subject"] != "") & (t["object"] != ""))
    empty = F.array().cast("array<struct<pair_id:string,subject:string,object:string,relation:string>>")
    tuples = F.when(F.col("_read.items").isNotNull(), good).when(F.col("_read.text").isNotNull(), recovered(F.col("_read.text"), F.col(task_col))).otherwise(empty)
    return found.withColumn("tuples", F.array_distinct(tuples)).drop("_read")


def zip_by_row(predictions: DataFrame, rows: DataFrame, key: str = "row_id") -> DataFrame:
    """Predictions joined to their rows by an explicit key; raises unless they match one to one."""
    both = predictions.select(key).withColumn("_p", F.lit(1)).unionByName(rows.select(key).withColumn("_p", F.lit(-1)))
    bad = both.groupBy(key).agg(F.sum("_p").alias("d"), F.count("*").alias("n")).where("d <> 0 or n <> 2")
    if not bad.isEmpty():
        raise ValueError(f"predictions and rows do not match, as at {key} {bad.first()[key]}")
    return predictions.join(rows, key)


def metadata_rows(pairs: DataFrame) -> DataFrame:
    """The build side of the metadata join: pair ids in brackets, the last of
    repeated ids, attribute-attribute pairs left out."""
    bracket = F.when(F.col("pair_id").startswith("["), F.col("pair_id")).otherwise(F.concat(F.lit("["), F.col("pair_id"), F.lit("]")))
    kept = pairs.where("has_meta and not (coalesce(upper(subj_source), '') = 'BEE' and coalesce(upper(obj_source), '') = 'BEE')")
    known = [c for c in ("subj_source", "subj_group", "subj_word", "obj_source", "obj_group", "obj_word") if c in pairs.columns]
    return kept.groupBy("origin_id", bracket.alias("pair_id")).agg(F.max_by(F.struct(*known), "pos").alias("m")).select("origin_id", "pair_id", "m.*")


def merge(parsed: DataFrame, metadata: DataFrame, tuples: str = "tuples") -> DataFrame:
    """One row per tuple with metadata; tuples of unknown pairs are left out."""
    return parsed.select("row_id", "origin_id", "task", F.explode(tuples).alias("t")).select("row_id", "origin_id", "task", "t.*").join(metadata, ["origin_id", "pair_id"])


def merged_records(parsed: DataFrame, metadata: DataFrame, sides: tuple[str, ...] = ("tuples",), names: tuple[str, ...] = ("pred_tuples",)) -> DataFrame:
    """``parsed`` (row_id, origin_id, task and others) with each list of tuples replaced by one
    of (pair_id, subject, object, relation), in order of pair and relation, whose sides come
    from the metadata; a row without any keeps an empty list."""
    record = parsed.drop(*sides)
    for tuples, name in zip(sides, names):
        def side(s: str):
            return F.struct(*[F.col(f"{s}_{have}").alias(want) for have, want in (("source", "source_type"), ("group", "entity_group"), ("word", "word")) if f"{s}_{have}" in metadata.columns])

        one = F.struct("pair_id", side("subj").alias("subject"), side("obj").alias("object"), "relation")
        made = merge(parsed, metadata, tuples).groupBy("row_id").agg(F.array_sort(F.collect_list(one)).alias(name))
        record = record.join(made, "row_id", "left").withColumn(name, F.coalesce(name, F.array().cast(made.schema[name].dataType)))
    return record


def parsed_records(answers: DataFrame, signatures: tuple[tuple[str, str], ...] = (), gold: bool = False) -> DataFrame:
    """row_id, expected_task, pred_tuples, full_input (and ground_truth): each answer parsed
    for the task that its own prompt asks for."""
    told = answers.withColumn("expected_task", text.detect_task(F.col("full_input"), signatures))
    found = parse(told, "prediction", "expected_task").withColumnRenamed("tuples", "pred_tuples")
    columns = ["row_id", "expected_task", "pred_tuples", "full_input"]
    if gold:
        found = parse(found.drop("_gold"), "ground_truth", "expected_task").drop("ground_truth").withColumnRenamed("tuples", "ground_truth")
        columns.append("ground_truth")
    return found.select(*columns)


def audit(records: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` records by row, as indented JSON."""
    return records.orderBy("row_id").limit(n).select("row_id", F.to_json(F.struct(*[c for c in records.columns if c != "row_id"]), {"pretty": "true", "ignoreNullFields": "false"}).alias("record"))


def hit_rate(parsed: DataFrame, metadata: DataFrame, first: int | None = 100) -> DataFrame:
    """tuples, hits, rate, of the first rows or (None) of all."""
    some = parsed if first is None else parsed.where(F.col("row_id") < first)
    long = some.select("origin_id", F.explode("tuples.pair_id").alias("pair_id"))
    seen = long.join(metadata.select("origin_id", "pair_id", F.lit(1).alias("hit")), ["origin_id", "pair_id"], "left")
    return seen.agg(F.count("*").alias("tuples"), F.count("hit").alias("hits")).withColumn("rate", F.try_divide("hits", "tuples"))


def without_unsupported(rows: DataFrame) -> DataFrame:
    return rows.where(~F.lower("task").isin("bee_bee", "ner_bee_true_only"))


def tuple_scores(predicted: DataFrame, gold: DataFrame) -> DataFrame:
    """Exact-match precision, recall and F1 per task (an extension).  Both: task, row_id and the tuple."""
    keys = ["task", "row_id", "pair_id", "subject", "object", "relation"]
    both = predicted.select(*keys).distinct().withColumn("p", F.lit(1)).join(gold.select(*keys).distinct().withColumn("g", F.lit(1)), keys, "full")
    n = both.groupBy("task").agg(F.count("p").alias("predicted"), F.count("g").alias("gold"), F.count_if(F.col("p").isNotNull() & F.col("g").isNotNull()).alias("hits"))
    p, r = F.try_divide("hits", "predicted"), F.try_divide("hits", "gold")
    return n.select("task", "predicted", "gold", "hits", p.alias("precision"), r.alias("recall"), F.try_divide(2 * p * r, p + r).alias("f1"))
