"""The three composed runs: training rows, evaluation rows, merged answers.

Each takes nested documents (``sources.files.RAW``) and ``Settings``; sources and
sinks are in ``sources.files``.  What later steps read more than once (chunks,
the selection, formatted chunks, transcripts) is written to the shared folder and
read again: it is computed once, and plans stay small.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dims, labels, text
from ..operators import answers, ranking, render, routing, sampling
from ..sources import files


@dataclass(frozen=True)
class Template:
    """Texts of one task's prompts."""

    system: str = ""
    detailed: str = ""
    summary: str = ""
    output_format: str = ""
    reasoning_format: str = ""


@dataclass(frozen=True)
class Settings:
    templates: dict[str, Template]
    tasks: tuple[str, ...] = ("ner_ner", "ner_bee")
    keep_negatives: bool = True
    target_train: int | None = 100_000
    max_length: int = 8192
    thresholds: tuple[int, ...] = (12, 10, 8, 6, 4)
    low_pairs: int = 8
    high_pairs: int = 12
    train_only: bool = False
    id_prefix: str = ""
    seed: int = 42
    tokens: str = "bytes4"
    model: str = "gemma-4"
    mode_ratios: tuple[tuple[str, float], ...] = dims.MODE_RATIOS
    limits: dict = field(default_factory=dict)


def _chunks(docs: DataFrame, settings: Settings, buffer: int, fallback: str) -> DataFrame:
    """Routed pairs in chunks that fit, with each cut chunk's text narrowed to its tags."""
    pairs = routing.explode_documents(files.with_ids(docs, fallback, settings.id_prefix))
    classified = routing.classify(pairs if settings.keep_negatives else routing.without_negatives(pairs))
    routed = classified.where(F.col("task").isin(*settings.tasks))
    if "ner_bee_true_only" in settings.tasks:
        routed = routed.unionByName(routing.true_only(classified))
    entry = F.concat_ws(" ", "pair_id", "subject", "object", "relation")
    # The braces, keys and indents of a pair, once in the input and once in the answer.
    cost = 2 * (text.token_len(entry, settings.tokens) + 32)
    room = settings.max_length - buffer - _overhead(docs, settings)
    chunks = routing.chunk_adaptive(routed, settings.thresholds, F.lit(room) - text.token_len(F.coalesce("text", F.lit("")), settings.tokens), cost)
    w = Window.partitionBy("task", "origin_id", "chunk_id")
    tags = F.array_distinct(F.flatten(F.collect_list(F.array_union(text.tag_ids(F.coalesce("subject", F.lit(""))), text.tag_ids(F.coalesce("object", F.lit(""))))).over(w)))
    cut = F.col("chunk_id") != F.col("origin_id")
    return files.kept(chunks.withColumn("_tags", tags).withColumn("text", F.when(cut, text.narrow(F.col("text"), F.col("_tags"))).otherwise(F.col("text"))).drop("_tags"))


def _by_task(settings: Settings, part: str) -> Column:
    found = F.lit("")
    for task in settings.tasks:
        found = F.when(F.col("task") == task, getattr(settings.templates.get(task, Template()), part)).otherwise(found)
    return found


def _rendered(rows: DataFrame, name: str, settings: Settings, mode: Column, fewshot: Column, body: Column, output: Column) -> DataFrame:
    """``rows`` with a chat transcript: system prompt, sections that the mode asks for, answer.
    The messages are a column of their own, so the transcript's expression stays small."""
    def asks(at: int) -> Column:
        return mode.isin(*[m for m, flags in dims.MODES.items() if flags[at]])

    summary = F.when(asks(2), _by_task(settings, "summary")).otherwise(_by_task(settings, "detailed"))
    description = F.when(asks(0), summary).otherwise("")
    form = F.when(asks(3), _by_task(settings, "reasoning_format")).otherwise(_by_task(settings, "output_format"))
    user = render.prompt(description, F.when(asks(1), fewshot).otherwise(""), form, body)
    turns = (("system", F.concat(F.lit("### System Prompt:\n"), _by_task(settings, "system"))), ("user", user), ("assistant", render.answer(output)))
    messages = F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns])
    return rows.withColumn("_messages", messages).withColumn(name, render.chat(F.col("_messages"))).drop("_messages")


def _overhead(docs: DataFrame, settings: Settings) -> int:
    """Tokens of the longest empty rendering, and 20."""
    grid = docs.sparkSession.createDataFrame([(t, m) for t in settings.tasks for m in dims.MODES], "task string, mode string")
    shown = _rendered(grid, "text", settings, F.col("mode"), F.lit(""), F.lit(""), F.lit(""))
    return shown.agg(F.max(text.token_len(F.col("text"), settings.tokens))).first()[0] + 20


def training(docs: DataFrame, settings: Settings, gold: DataFrame | None = None) -> DataFrame:
    """task, origin_id, chunk_id, mode, split, text: rows within the length.

    Quota before split, split before examples (only training origins are shown,
    and none to itself), length last.  ``gold``: documents whose chunks are shown first.
    """
    chunks = _chunks(docs, settings, 1000, "all")
    rows = routing.profile_rows(chunks)
    if settings.target_train is not None:
        quota = sampling.quota(settings.target_train, len(settings.tasks))
        chosen = sampling.diverse_origins(rows, quota, settings.seed, settings.limits)
        chosen = files.kept(chosen.select("task", "origin_id"))
        chunks, rows = chunks.join(chosen, ["task", "origin_id"], "left_semi"), rows.join(chosen, ["task", "origin_id"], "left_semi")
    origins = routing.origin_profile(rows)
    splits = files.kept(sampling.split(origins, settings.seed, train_only=settings.train_only))
    made = files.kept(render.io_json(chunks))
    pool = files.kept(_pool(rows, origins).join(splits.where("split = 'train'"), "origin_id", "left_semi"))
    texts = made.select("task", "chunk_id", "input", "output")
    if gold is None:
        shown = sampling.demonstrations(pool, settings.low_pairs, settings.high_pairs, settings.seed)
    else:
        first = _chunks(gold, settings, 1000, "gold")
        gold_rows = routing.profile_rows(first)
        picked = sampling.gold_first(_pool(gold_rows, routing.origin_profile(gold_rows)), pool, settings.low_pairs, settings.high_pairs, settings.seed)
        texts = texts.withColumn("origin", F.lit("main")).unionByName(render.io_json(first).select("task", "chunk_id", "input", "output", F.lit("gold").alias("origin")))
        shown = picked.withColumn("for_origin", F.lit(None).cast("string"))
    # At most ``high_pairs`` examples a task, and as many picks again: small by construction.
    held = texts.join(F.broadcast(shown), [c for c in ("task", "chunk_id", "origin") if c in shown.columns])
    blocks = held.groupBy("task", "for_origin").agg(F.array_sort(F.collect_list(F.struct("place", "input", "output"))).alias("e")).select("task", "for_origin", render.fewshot_block(F.col("e")).alias("block"))
    blocks = files.kept(blocks)
    common = blocks.where("for_origin is null").select("task", F.col("block").alias("common"))
    own = blocks.where("for_origin is not null").select("task", F.col("for_origin").alias("origin_id"), F.col("block").alias("own"))
    placed = sampling.with_split(sampling.mode_partition(made, seed=settings.seed, ratios=settings.mode_ratios), splits)
    full = placed.join(F.broadcast(common), "task", "left").join(F.broadcast(own), ["task", "origin_id"], "left")
    full = _rendered(full, "text", settings, F.col("mode"), F.coalesce("own", "common", F.lit("")), F.col("input"), F.col("output"))
    return render.within(files.kept(full.select("task", "origin_id", "chunk_id", "mode", "split", "text")), ("text",), settings.max_length, settings.tokens)


def _pool(rows: DataFrame, origins: DataFrame) -> DataFrame:
    rare = routing.dynamic_rare(routing.relation_support(origins))
    marked = routing.priority_origins(origins, rare).select("task", "origin_id", "priority")
    chunks = rows.groupBy("task", "origin_id", "chunk_id").agg(F.count("*").alias("pair_count"), F.collect_set("label").alias("rel_labels"))
    return chunks.join(marked, ["task", "origin_id"])


def evaluation(docs: DataFrame, settings: Settings, task: str, mode: str, allow_empty: bool = False) -> DataFrame:
    """row_id, task, mode, origin_id, chunk_id, prompt, ground_truth of one task and mode, without examples.
    Documents without a pair of the task raise, unless ``allow_empty``."""
    if task in ("ner_bee_true_only", "bee_bee"):
        raise ValueError(f"task {task} has no evaluation")
    if mode not in dims.MODES:
        raise ValueError(f"unknown mode {mode}")
    chunks = _chunks(docs, settings, 2000, "eval").where(F.col("task") == task)
    if not allow_empty and chunks.isEmpty():
        raise ValueError(f"no pair of the documents belongs to task {task}")
    made = files.kept(render.io_json(chunks))
    tag, stop = dims.FORMATS[text.format_of(settings.model)]
    whole = _rendered(made, "_whole", settings, F.lit(mode), F.lit(""), F.col("input"), F.col("output"))
    prompt, reply = text.answer_at(F.col("_whole"), tag)
    rows = whole.select("task", F.lit(mode).alias("mode"), "origin_id", "chunk_id", prompt.alias("prompt"), text.without_stop_tokens(reply, stop).alias("ground_truth"))
    kept = render.within(files.kept(rows), ("prompt", "ground_truth"), settings.max_length, settings.tokens)
    return ranking.positions(kept, "task", "chunk_id", settings.seed, "row_id", "_rows").drop("_rows")


def merged_records(predictions: DataFrame, rows: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """One record per row: origin_id, expected_task, mode, pred_tuples, full_input, ground_truth, the tuples
    with the sides that the documents' metadata has.  ``predictions``: row_id, prediction, full_input, ground_truth."""
    both = answers.zip_by_row(predictions.select("row_id", "prediction", "full_input", "ground_truth"), rows.select("row_id", "task", "mode", "origin_id"))
    named = answers.without_unsupported(both).withColumn("task", labels.task_name(F.col("task")))
    parsed = answers.parse(named.withColumn("prediction", text.without_think_tags(F.col("prediction")))).withColumnRenamed("tuples", "found").drop("prediction")
    parsed = answers.parse(parsed, "ground_truth").withColumnRenamed("tuples", "told").drop("ground_truth")
    known = answers.metadata_rows(routing.explode_documents(files.with_ids(docs, "eval", settings.id_prefix)))
    records = answers.merged_records(files.kept(parsed), files.kept(known), ("found", "told"), ("pred_tuples", "ground_truth"))
    return records.select("row_id", "origin_id", F.col("task").alias("expected_task"), "mode", "pred_tuples", "full_input", "ground_truth")


def merged(predictions: DataFrame, rows: DataFrame, docs: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Relation tuples with their metadata, and the rate of tuples with metadata:
    of all rows and (``first_``) of the first 100.

    ``predictions``: row_id, prediction; one for each of ``rows`` (as from
    ``evaluation``), else this raises.
    """
    both = answers.zip_by_row(predictions.select("row_id", "prediction"), rows.select("row_id", "task", "origin_id"))
    clean = answers.without_unsupported(both).withColumn("prediction", text.without_think_tags(F.col("prediction"))).withColumn("task", labels.task_name(F.col("task")))
    parsed = answers.parse(clean)
    known = answers.metadata_rows(routing.explode_documents(files.with_ids(docs, "eval", settings.id_prefix)))
    first = answers.hit_rate(parsed, known).select(*[F.col(c).alias(f"first_{c}") for c in ("tuples", "hits", "rate")])
    return answers.merge(parsed, known), answers.hit_rate(parsed, known, None).crossJoin(first)
