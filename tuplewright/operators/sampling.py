"""Quota selection of origins, splits, mode partition, few-shot picks, mixing."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dims
from ..sources import files
from . import routing
from .ranking import order_key, positions


def quota(target_train: int, n_tasks: int, train_share: float = 0.7) -> int:
    return int(int(target_train / train_share) / n_tasks)


def skip_greedy(origins: DataFrame, quota_: int, seed: int = 42) -> DataFrame:
    """Origins in keyed order, each taken if it still fits: task, origin_id.

    Once an origin of some size doesn't fit, no later one of that size does, so
    of each size n only the first quota / n in order can be taken.  The fold
    sees those alone: about quota * ln(quota) a task, whatever the corpus.  Sizes
    are thinned in 64 slices first, so no task sorts all of a common size.
    """
    keyed = origins.select("task", "origin_id", F.col("chunk_count").cast("long").alias("n"), order_key(seed, F.col("origin_id")).alias("k"))
    totals = keyed.groupBy("task").agg(F.sum("n").alias("total"))
    over = totals.where(F.col("total") > quota_).select("task")
    whole = keyed.join(F.broadcast(totals.where(F.col("total") <= quota_).select("task")), "task", "left_semi").select("task", "origin_id")
    some = keyed.join(F.broadcast(over), "task", "left_semi").where(F.col("n") <= quota_).withColumn("slice", F.pmod(F.xxhash64("origin_id"), F.lit(64)))
    for by in (("task", "n", "slice"), ("task", "n")):
        some = some.withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("k", "origin_id"))).where(F.col("r") * F.col("n") <= quota_)
    items = some.groupBy("task").agg(F.array_sort(F.collect_list(F.struct("k", "origin_id", "n"))).alias("items"))

    def fits(total, n):
        return F.when(total + n <= quota_, total + n).otherwise(total)

    # In runs, so that no step copies all that were taken before: what a run takes needs its beginning alone.
    def walk(begin, run):
        first = F.struct(begin.alias("sum"), F.array().cast("array<string>").alias("taken"))

        def step(acc, x):
            more = F.concat(acc["taken"], F.array(x["origin_id"]))
            return F.struct(fits(acc["sum"], x["n"]).alias("sum"), F.when(acc["sum"] + x["n"] <= quota_, more).otherwise(acc["taken"]).alias("taken"))

        return F.aggregate(run, first, step, lambda acc: acc["taken"])

    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("items") - 1) / 256).cast("int")), lambda i: F.slice("items", i * 256 + 1, 256))
    cut = items.select("task", runs.alias("runs"))
    begins = F.aggregate("runs", F.array(F.lit(0).cast("long")), lambda acc, run: F.concat(acc, F.array(F.aggregate(run, F.element_at(acc, -1), lambda total, x: fits(total, x["n"])))))
    begun = cut.select("task", "runs", begins.alias("begins"))
    taken = F.flatten(F.transform("runs", lambda run, i: walk(F.get("begins", i), run)))
    folded = begun.select("task", F.explode(taken).alias("origin_id"))
    return whole.unionByName(folded)


class Lists:
    """A list column: ``of[k]`` is the row of value ``code[k]``; ``names[code]`` its text."""

    def __init__(self, column: pa.ListArray):
        encoded = column.flatten().dictionary_encode()
        self.names = encoded.dictionary.to_pylist()
        self.code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        self.end = np.cumsum(sizes)
        self.of = np.repeat(np.arange(len(sizes)), sizes)

    def at(self, row: int) -> np.ndarray:
        return self.code[self.end[row - 1] if row else 0 : self.end[row]]

    def total(self, value: np.ndarray) -> np.ndarray:
        """Per row the sum of a value of each entry."""
        return np.bincount(self.of, value, len(self.end))

    def holds(self, name: str) -> np.ndarray:
        found = np.zeros(len(self.end), bool)
        if name in self.names:
            found[self.of[self.code == self.names.index(name)]] = True
        return found


def distinct_entries(lists: Lists) -> np.ndarray:
    """1.0 at the first of equal neighbours of a row, else 0.0."""
    same = (lists.code[1:] == lists.code[:-1]) & (lists.of[1:] == lists.of[:-1])
    return np.r_[True, ~same].astype(float)[: len(lists.code)]


def select_diverse(origins: pa.Table, room: int, rel_need: dict, grp_need: dict, rare: set, exposure: dict, caps: dict) -> list[tuple[int, str]]:
    """(row, step) of the origins taken: A0 rare carriers, A priority, B coverage, C novelty.

    ``origins`` in keyed order: chunk_count, priority, and the lists rel_labels,
    group_pairs, subjects, objects (sorted; the last two with repeats).  Scores of
    B and C are frozen when their step begins and computed for all origins at
    once; what an origin adds and whether it still gains is looked at in turn.  An
    origin already taken is passed over in every step.
    """
    size, priority = (origins.column(c).to_numpy() for c in ("chunk_count", "priority"))
    rel, grp, subj, obj = (Lists(origins.column(c).combine_chunks()) for c in ("rel_labels", "group_pairs", "subjects", "objects"))
    need = {id(rel): np.array([rel_need.get(x, 0) for x in rel.names], float), id(grp): np.array([grp_need.get(x, 0) for x in grp.names], float)}
    seen = {id(x): np.zeros(len(x.names)) for x in (subj, obj)}
    heads = [(rel.holds(name), cap) for name, cap in caps.items()]
    taken, taken_heads, steps, count = np.zeros(len(size), bool), [0] * len(heads), [], 0

    def add(i: int, step: str) -> None:
        nonlocal count
        n = int(size[i])
        count += n
        taken[i] = True
        steps.append((int(i), step))
        for lists in (rel, grp):
            codes = lists.at(i)
            need[id(lists)][codes] = np.maximum(need[id(lists)][codes] - n, 0)
        for lists in (subj, obj):
            np.add.at(seen[id(lists)], lists.at(i), 1)
        for k, (has, _) in enumerate(heads):
            taken_heads[k] += n * int(has[i])

    def penalty(some):
        """Of a row, or of all (``slice(None)``)."""
        n, total = size[some], 0.0
        for (has, cap), so_far in zip(heads, taken_heads):
            total = total + np.maximum((so_far + n * has[some]) / (count + n) - cap, 0.0)
        return total

    def gains() -> np.ndarray:
        return sum(lists.total(np.minimum(need[id(lists)][lists.code], size[lists.of])) for lists in (rel, grp))

    def gain(i: int) -> float:
        return sum(np.minimum(need[id(lists)][lists.at(i)], size[i]).sum() for lists in (rel, grp))

    def novelty() -> np.ndarray:
        return sum(lists.total(distinct_entries(lists) / np.sqrt(1 + seen[id(lists)][lists.code])) for lists in (subj, obj))

    def ranked(some: np.ndarray, score: np.ndarray) -> list[int]:
        return some[np.argsort(-score[some], kind="stable")].tolist()

    # While a label isn't covered none of its carriers is taken: its smallest is the one to try.
    for label in sorted({*rel_need, *rare}, key=lambda x: (exposure.get(x, 0), x)):
        if count >= room:
            break
        carriers = np.flatnonzero(rel.holds(label))
        if len(carriers) and not taken[carriers].any():
            smallest = carriers[np.argmin(size[carriers])]
            if count + size[smallest] <= room:
                add(smallest, "A0")
    for i in np.flatnonzero(priority & ~taken).tolist():
        if count + size[i] <= room:
            add(i, "A")
    common = np.flatnonzero(~priority & (size <= room))
    if count < room:
        now = gains()
        # Needs only fall: what gains nothing now gains nothing later.
        for i in ranked(common[(now[common] > 0) & ~taken[common]], now - 2 * penalty(slice(None)) * count):
            if count >= room or not any(n.any() for n in need.values()):
                break
            if count + size[i] <= room and gain(i) > 0:
                add(i, "B")
    deferred: list[int] = []
    if count < room:
        for i in ranked(common[~taken[common] & (count + size[common] <= room)], novelty() - 3 * penalty(slice(None)) * max(1, count)):
            if count >= room:
                break
            if count + size[i] <= room:
                over = penalty(i)
                if over <= 0.005:
                    add(i, "C")
                elif over <= 0.01:
                    deferred.append(i)
    for i in deferred:
        if count + size[i] <= room and penalty(i) <= 0.01:
            add(i, "C")
    return steps


_ORIGIN = T.StructType([T.StructField(n, T.StringType()) for n in ("task", "origin_id", "step")])


def diverse_origins(rows: DataFrame, quota_: int, seed: int = 42, limits: dict | None = None) -> DataFrame:
    """task, origin_id, step.  ``rows`` are profile rows.  Profiles are aggregated once and
    written; floors, rarity and priorities are native too.  Only the greedy choice, which
    depends on every earlier choice, runs per task over origin profiles, as arrays."""
    limits = limits or {}
    sides = (F.array_sort(F.collect_list(c)).alias(name) for c, name in (("subj_group", "subjects"), ("obj_group", "objects")))
    origins = files.kept(routing.origin_profile(rows, *sides))
    support = routing.relation_support(origins)
    rare = routing.dynamic_rare(support, **limits.get("rare", {}))
    marked = routing.priority_origins(origins, rare)
    packed = marked.select("task", "origin_id", order_key(seed, F.col("origin_id")).alias("key"), F.col("chunk_count").cast("long").alias("chunk_count"), "priority", "rel_labels", "group_pairs", "subjects", "objects")
    facts = (
        support.join(routing.relation_floors(support, **limits.get("relation", {})), ["task", "label"], "left")
        .join(rare.withColumn("rare", F.lit(True)), ["task", "label"], "left")
        .groupBy("task")
        .agg(F.to_json(F.collect_list(F.struct("label", "exposure", "floor", "rare"))).alias("labels"))
    )
    grp = routing.group_floors(routing.group_support(origins), **limits.get("group", {})).groupBy("task").agg(F.to_json(F.collect_list(F.struct("group_pair", "floor"))).alias("groups"))
    needs = facts.join(grp, "task", "left").select(F.col("task").alias("of_task"), "labels", F.coalesce("groups", F.lit("[]")).alias("groups"))

    def choose(some: pa.Table, need: pa.Table) -> pa.Table:
        import json

        if not some.num_rows:
            return pa.table({n: pa.array([], pa.string()) for n in _ORIGIN.names})
        task = some.column("task")[0].as_py()
        if pc.sum(some.column("chunk_count")).as_py() <= quota_:
            found = [(i, "all") for i in range(some.num_rows)]
        else:
            some = some.sort_by([("key", "ascending"), ("origin_id", "ascending")])
            labels_, groups_ = (json.loads(need.column(c)[0].as_py()) for c in ("labels", "groups"))
            found = select_diverse(
                some,
                quota_,
                {x["label"]: x["floor"] for x in labels_ if x.get("floor") is not None},
                {x["group_pair"]: x["floor"] for x in groups_},
                {x["label"] for x in labels_ if x.get("rare")},
                {x["label"]: x["exposure"] for x in labels_},
                dims.HEAD_CAPS.get(task, {}),
            )
        picked = some.column("origin_id").take(pa.array([i for i, _ in found], pa.int64()))
        return pa.table({"task": pa.array([task] * len(found), pa.string()), "origin_id": picked.cast(pa.string()), "step": pa.array([step for _, step in found], pa.string())})

    return packed.groupBy("task").cogroup(needs.groupBy("of_task")).applyInArrow(choose, _ORIGIN)


def head_shares(rows: DataFrame, selected: DataFrame) -> DataFrame:
    """Share of selected chunks that hold a label with a cap."""
    chunks = rows.join(selected, ["task", "origin_id"], "left_semi").select("task", "chunk_id", "label").distinct()
    total = chunks.groupBy("task").agg(F.countDistinct("chunk_id").alias("chunks"))
    held = chunks.where(routing.is_head(F.col("task"), F.col("label"))).groupBy("task", "label").agg(F.count("*").alias("held"))
    return held.join(F.broadcast(total), "task").select("task", "label", "held", "chunks", (F.col("held") / F.col("chunks")).alias("share"))


def unmet_floors(rows: DataFrame, selected: DataFrame, **limits) -> DataFrame:
    """task, kind (relation or group), name, floor, taken: floors that the chunks of the
    selected origins (task, origin_id) which hold the label or pair do not reach."""
    origins = routing.origin_profile(rows)
    floors = routing.relation_floors(routing.relation_support(origins), **limits.get("relation", {})).select("task", F.lit("relation").alias("kind"), F.col("label").alias("name"), "floor")
    floors = floors.unionByName(routing.group_floors(routing.group_support(origins), **limits.get("group", {})).select("task", F.lit("group").alias("kind"), F.col("group_pair").alias("name"), "floor"))
    chosen = origins.join(selected, ["task", "origin_id"], "left_semi")
    held = [chosen.select("task", F.lit(kind).alias("kind"), F.explode(c).alias("name"), "chunk_count") for kind, c in (("relation", "rel_labels"), ("group", "group_pairs"))]
    taken = held[0].unionByName(held[1]).groupBy("task", "kind", "name").agg(F.sum("chunk_count").alias("taken"))
    return floors.join(taken, ["task", "kind", "name"], "left").withColumn("taken", F.coalesce("taken", F.lit(0))).where("taken < floor")


def first_task(origins: DataFrame, tasks: tuple[str, ...] = dims.TASKS) -> DataFrame:
    """Each origin once, in the first of its tasks: in the order of ``tasks``, others after them by name."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(t) for t in tasks]), F.col("task")), F.lit(0))
    rank = F.struct(F.when(place > 0, place).otherwise(len(tasks) + 1).alias("place"), "task")
    return origins.groupBy("origin_id").agg(F.min(rank)["task"].alias("task"))


def split(origins: DataFrame, seed: int = 42, train: float = 0.7, train_and_validation: float = 0.8, train_only: bool = False, tasks: tuple[str, ...] = dims.TASKS) -> DataFrame:
    """origin_id, task, split: 70/10/20 within the first task of an origin, in double arithmetic."""
    placed = positions(first_task(origins, tasks), "task", "origin_id", seed)
    a, b = F.floor(F.col("size") * F.lit(train)), F.floor(F.col("size") * F.lit(train_and_validation))
    named = F.lit("train") if train_only else F.when(F.col("position") < a, "train").when(F.col("position") < b, "validation").otherwise("test")
    return placed.select("origin_id", "task", named.alias("split"))


def with_split(rows: DataFrame, splits: DataFrame) -> DataFrame:
    return rows.join(splits.select("origin_id", "split"), "origin_id", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def mode_partition(rows: DataFrame, key: str = "chunk_id", seed: int = 42, ratios=dims.MODE_RATIOS, detailed: float = dims.FULL_DETAILED_RATIO) -> DataFrame:
    """Disjoint ranges of one keyed order per task; rows left over get no mode."""
    placed = positions(rows, "task", key, seed)
    start, mode = F.lit(0), F.lit(None).cast("string")
    found = None
    for name, ratio in ratios:
        n = F.floor(F.col("size") * F.lit(float(ratio)))
        parts = [(name, n)]
        if name == "full":
            first = F.floor(n * F.lit(float(detailed)))
            parts = [("full_detailed", first), ("full_summary", n - first)]
        for part, size in parts:
            end = start + size
            test = (F.col("position") >= start) & (F.col("position") < end)
            found = F.when(test, part) if found is None else found.when(test, part)
            start = end
    return placed.withColumn("mode", F.coalesce(found, mode)).where("mode is not null").drop("position", "size")


def pick_examples(pool: DataFrame, low: int = 8, high: int = 12, seed: int = 42) -> DataFrame:
    """task, chunk_id: priority chunks first, each added if the pairs stay within
    ``high``, until ``low`` is reached.  No more than ``high`` + 1 sizes occur
    among what can be added, so per task only the first ``high`` of each
    size and priority are looked at: no later one could be taken."""
    key = order_key(seed, F.col("chunk_id"))
    some = pool.where(F.col("pair_count").between(1, high)).withColumn("k", key)
    w = Window.partitionBy("task", "priority", "pair_count").orderBy("k", "chunk_id")
    some = some.withColumn("r", F.row_number().over(w)).where(F.col("r") <= high)
    items = F.array_sort(F.collect_list(F.struct((~F.col("priority")).alias("late"), "k", "chunk_id", F.col("pair_count").cast("int").alias("n"))))
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<string>").alias("taken"))

    def step(acc, x):
        fits = (acc["sum"] < low) & (acc["sum"] + x["n"] <= high)
        return F.struct(F.when(fits, acc["sum"] + x["n"]).otherwise(acc["sum"]).alias("sum"), F.when(fits, F.concat(acc["taken"], F.array(x["chunk_id"]))).otherwise(acc["taken"]).alias("taken"))

    return some.groupBy("task").agg(items.alias("items")).select("task", F.posexplode(F.aggregate("items", start, step, lambda acc: acc["taken"])).alias("place", "chunk_id"))


def missing_rare(present: DataFrame, rare=dims.RARE) -> DataFrame:
    """task, label: rare labels that no row of ``present`` (task, label) has."""
    every = present.select("task").distinct().select("task", F.explode(F.array(*[F.lit(x) for x in rare])).alias("label"))
    return every.join(present, ["task", "label"], "left_anti")


def interleave(main: DataFrame, extra: DataFrame, share: float = 0.1, seed: int = 3407) -> DataFrame:
    """All of ``main`` and ``extra`` recycled to ``share`` of the result, in keyed
    order (column ``order_key``).  Both have ``row_key``."""
    n_main, n_extra = main.count(), extra.count()
    base = main.withColumn("origin", F.lit("main")).withColumn("copy", F.lit(0))
    if not n_extra:
        return base.withColumn("order_key", order_key(seed, F.concat_ws(":", "origin", "row_key", "copy")))
    want = max(n_extra, round(n_main * share / (1 - share)))
    full, over = divmod(want, n_extra)
    placed = positions(extra.withColumn("_all", F.lit(0)), "_all", "row_key", seed, "_at", "_size")
    copies = F.lit(full) + (F.col("_at") < over).cast("int")
    more = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1))).drop("_at", "_size", "_all").withColumn("origin", F.lit("gold"))
    return base.unionByName(more).withColumn("order_key", order_key(seed, F.concat_ws(":", "origin", "row_key", "copy")))


def gold_first(gold: DataFrame, main: DataFrame, low: int = 8, high: int = 12, seed: int = 42, rare=dims.RARE) -> DataFrame:
    """task, chunk_id, place, origin: examples from ``gold``, then at most one from
    ``main`` that holds a rare label they lack, if it is the first such chunk in
    order and still within ``high`` pairs.  Both have ``rel_labels``."""
    primary = pick_examples(gold, low, high, seed)
    held = gold.join(F.broadcast(primary), ["task", "chunk_id"]).groupBy("task").agg(F.sum("pair_count").alias("used"), F.flatten(F.collect_list("rel_labels")).alias("have"))
    lacking = F.array_except(F.array(*[F.lit(x) for x in rare]), F.coalesce("have", F.array().cast("array<string>")))
    need = main.select("task").distinct().join(held, "task", "left").select("task", F.coalesce("used", F.lit(0)).alias("used"), lacking.alias("lacking"))
    some = main.where("pair_count > 0").join(F.broadcast(need), "task").where(F.arrays_overlap("rel_labels", "lacking"))
    first = some.groupBy("task").agg(F.min(F.struct((~F.col("priority")).alias("late"), order_key(seed, F.col("chunk_id")).alias("k"), "chunk_id", "pair_count", "used")).alias("m"))
    extra = first.where(F.col("m.pair_count") + F.col("m.used") <= high).select("task", F.col("m.chunk_id").alias("chunk_id"), F.lit(high).alias("place"), F.lit("main").alias("origin"))
    return primary.select("task", "chunk_id", "place", F.lit("gold").alias("origin")).unionByName(extra)


def demonstrations(pool: DataFrame, low: int = 8, high: int = 12, seed: int = 42) -> DataFrame:
    """task, for_origin, place, chunk_id: the examples of a task (for_origin null), and for
    each origin among them a fresh pick without it."""
    picked = pick_examples(pool, low, high, seed)
    shown = picked.join(pool.select("task", "chunk_id", "origin_id"), ["task", "chunk_id"]).select("task", F.col("origin_id").alias("for_origin")).distinct()
    # At most ``high`` origins a task are shown, so the pool is read once for each of few.
    pair = F.to_json(F.struct("task", "for_origin"))
    others = pool.join(F.broadcast(shown), "task").where("origin_id <> for_origin").withColumn("task", pair)
    read = F.from_json("task", "task string, for_origin string")
    again = pick_examples(others, low, high, seed).select(read.alias("t"), "place", "chunk_id").select("t.task", "t.for_origin", "place", "chunk_id")
    return picked.select("task", F.lit(None).cast("string").alias("for_origin"), "place", "chunk_id").unionByName(again)
