"""Routing of candidate pairs into tasks; chunks; profiles."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims, labels, text


def explode_documents(docs: DataFrame) -> DataFrame:
    """Nested documents -> one row per pair, its metadata found by pair_id in
    the same document; of repeated pair_ids in the metadata the last wins."""
    pair = docs.select("id", F.col("text"), "meta_info", F.posexplode("candidate_pairs").alias("pos", "pair"))
    meta = F.element_at(F.filter(F.coalesce("meta_info", F.array().cast(docs.schema["meta_info"].dataType)), lambda m: m["pair_id"] == F.col("pair.pair_id")), -1)
    return pair.withColumn("meta", F.when(F.exists(F.coalesce("meta_info", F.array().cast(docs.schema["meta_info"].dataType)), lambda m: m["pair_id"] == F.col("pair.pair_id")), meta)).select(
        F.col("id").alias("origin_id"),
        "text",
        "pos",
        "pair.pair_id",
        "pair.subject",
        "pair.object",
        "pair.relation",
        F.col("meta").isNotNull().alias("has_meta"),
        F.when(F.col("meta").isNotNull(), F.col("meta.subject.source_type")).alias("subj_source"),
        F.when(F.col("meta").isNotNull(), F.col("meta.object.source_type")).alias("obj_source"),
        F.col("meta.subject.entity_group").alias("subj_group"),
        F.col("meta.object.entity_group").alias("obj_group"),
        F.col("meta.subject.word").alias("subj_word"),
        F.col("meta.object.word").alias("obj_word"),
    )


def without_negatives(pairs: DataFrame) -> DataFrame:
    return pairs.where(labels.normalize_negative(F.col("relation")) != dims.NEGATIVE)


def _sources():
    return labels.source_of(F.col("has_meta"), F.col("subj_source")), labels.source_of(F.col("has_meta"), F.col("obj_source"))


def classify(pairs: DataFrame) -> DataFrame:
    """Pairs that reach a task, with ``task`` and the routed ``relation``."""
    s, o = _sources()
    return pairs.withColumn("task", labels.bucket(s, o)).withColumn("relation", labels.routed_relation(s, o, F.col("relation"))).where("task is not null and relation is not null")


def classify_counts(pairs: DataFrame) -> DataFrame:
    """mapped, dropped, forced negative and attribute-attribute pairs."""
    s, o = _sources()
    plain = labels.normalize_negative(F.col("relation"))
    between = labels.bucket(s, o) == "ner_ner"
    mapped = plain.isin(*dims.ATTRIBUTE_TO_RELATION)
    return pairs.agg(
        F.count_if(between & mapped).alias("mapped"),
        F.count_if(between & labels.is_attribute(plain) & ~mapped).alias("dropped"),
        F.count_if((s == "BEE") & (o == "NER")).alias("forced_negative"),
        F.count_if((s == "BEE") & (o == "BEE")).alias("bee_bee"),
    )


def true_only(classified: DataFrame) -> DataFrame:
    """The task of attribute pairs that are related."""
    return classified.where((F.col("task") == "ner_bee") & (F.col("relation") != dims.NEGATIVE)).withColumn("task", F.lit("ner_bee_true_only"))


def chunk_fixed(pairs: DataFrame, threshold: int) -> DataFrame:
    """Slices of ``threshold`` pairs by position; a document within it keeps its id."""
    w = Window.partitionBy("task", "origin_id")
    place = F.row_number().over(w.orderBy("pos")) - 1
    k = F.floor(place / threshold).cast("int")
    many = F.count("*").over(w) > threshold
    return pairs.withColumn("_k", k).withColumn("_many", many).withColumn("chunk_id", F.when(F.col("_many"), F.concat(F.col("origin_id"), F.lit("_chunk_"), F.col("_k").cast("string"))).otherwise(F.col("origin_id"))).drop("_k", "_many")


def chunk_adaptive(pairs: DataFrame, thresholds: tuple[int, ...], limit: int, cost) -> DataFrame:
    """Whole if it fits; else the first threshold at which every chunk fits;
    else the last.  ``cost``: column, summed per chunk."""
    w = Window.partitionBy("task", "origin_id")
    placed = pairs.withColumn("_place", F.row_number().over(w.orderBy("pos")) - 1).withColumn("_n", F.count("*").over(w)).withColumn("_cost", cost)
    fits = [(F.sum("_cost").over(w) <= limit, F.lit(None).cast("int"))]
    for t in thresholds:
        per = F.sum("_cost").over(Window.partitionBy("task", "origin_id", F.floor(F.col("_place") / t)))
        placed = placed.withColumn(f"_c{t}", per)
    choice = F.when(fits[0][0], F.lit(0))
    for t in thresholds:
        choice = choice.when(F.max(f"_c{t}").over(w) <= limit, F.lit(t))
    placed = placed.withColumn("threshold", choice.otherwise(F.lit(thresholds[-1])))
    cut = (F.col("threshold") > 0) & (F.col("_n") > F.col("threshold"))
    part = F.floor(F.col("_place") / F.greatest("threshold", F.lit(1))).cast("int").cast("string")
    chunk = F.when(cut, F.concat("origin_id", F.lit("_chunk_"), part)).otherwise(F.col("origin_id"))
    return placed.withColumn("chunk_id", chunk).drop("_place", "_n", "_cost", *[f"_c{t}" for t in thresholds])


def profile_rows(chunks: DataFrame) -> DataFrame:
    """One row per pair with its profile label and groups (metadata, else the tag's name, else UNK)."""
    def group(given: str, tagged: str):
        return F.coalesce(F.when(F.col("has_meta") & (F.col(given) != ""), F.col(given)), F.when(text.tag_name(F.coalesce(F.col(tagged), F.lit(""))) != "", text.tag_name(F.col(tagged))), F.lit("UNK"))

    return chunks.select("task", "origin_id", "chunk_id", labels.profile_label(F.col("task"), F.col("relation")).alias("label"), group("subj_group", "subject").alias("subj_group"), group("obj_group", "object").alias("obj_group"))


def chunk_profile(rows: DataFrame) -> DataFrame:
    return rows.groupBy("task", "chunk_id").agg(
        F.array_sort(F.collect_set("label")).alias("rel_labels"),
        F.array_sort(F.collect_set(F.concat_ws(">", "subj_group", "obj_group"))).alias("group_pairs"),
        F.count("*").alias("pair_count"),
    )


def origin_profile(rows: DataFrame, *more: Column) -> DataFrame:
    """One row per origin; ``more``: further aggregates."""
    return rows.groupBy("task", "origin_id").agg(
        # One aggregate: a distinct count would shuffle twice.
        F.size(F.collect_set("chunk_id")).cast("long").alias("chunk_count"),
        F.array_sort(F.collect_set("label")).alias("rel_labels"),
        F.array_sort(F.collect_set(F.concat_ws(">", "subj_group", "obj_group"))).alias("group_pairs"),
        F.count("*").alias("pair_count"),
        F.bool_or(F.col("label").isin(*dims.RARE)).alias("has_static_rare"),
        *more,
    )


def relation_support(origins: DataFrame) -> DataFrame:
    """Per task and label: origins, and exposure (the sum of their chunk counts)."""
    return origins.select("task", "origin_id", "chunk_count", F.explode("rel_labels").alias("label")).groupBy("task", "label").agg(F.count("*").alias("support"), F.sum("chunk_count").alias("exposure"))


def group_support(origins: DataFrame) -> DataFrame:
    return origins.select("task", F.explode("group_pairs").alias("group_pair")).groupBy("task", "group_pair").agg(F.count("*").alias("support"))


def floor_of(x, low: int, high: int, ratio: float):
    return F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.lit(float(ratio)) * x).cast("int")))


def is_head(task, label):
    found = F.lit(False)
    for name, caps in dims.HEAD_CAPS.items():
        found = found | ((task == name) & label.isin(*caps))
    return found


def relation_floors(support: DataFrame, low: int = 20, high: int = 100, ratio: float = 0.25) -> DataFrame:
    return support.where((F.col("exposure") >= low) & ~is_head(F.col("task"), F.col("label"))).select("task", "label", floor_of(F.col("exposure"), low, high, ratio).alias("floor"))


def group_floors(support: DataFrame, low: int = 10, high: int = 60, ratio: float = 0.15) -> DataFrame:
    return support.where(F.col("support") >= low).select("task", "group_pair", floor_of(F.col("support"), low, high, ratio).alias("floor"))


def dynamic_rare(support: DataFrame, chunks: int = 100, origins: int = 30) -> DataFrame:
    return support.where(((F.col("exposure") < chunks) | (F.col("support") < origins)) & ~is_head(F.col("task"), F.col("label"))).select("task", "label")


def priority_origins(origins: DataFrame, rare: DataFrame) -> DataFrame:
    """Origins with a statically or dynamically rare label."""
    long = origins.select("task", "origin_id", F.explode("rel_labels").alias("label"))
    dynamic = long.join(rare, ["task", "label"], "left_semi").select("task", "origin_id").distinct().withColumn("_hit", F.lit(True))
    return origins.join(dynamic, ["task", "origin_id"], "left").withColumn("priority", F.col("has_static_rare") | F.coalesce("_hit", F.lit(False))).drop("_hit")
