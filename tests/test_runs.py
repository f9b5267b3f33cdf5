import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tuplewright.functions import dims
from tuplewright.operators import sampling
from tuplewright.plans import runs
from tuplewright.sources import files

TEMPLATES = {t: runs.Template(f"System {t}", "Long description", "Short", "JSON list", "Think, then JSON") for t in ("ner_ner", "ner_bee")}


@pytest.fixture(scope="module")
def docs(spark):
    rng, made = random.Random(3), []
    for i in range(40):
        n = rng.randint(1, 20)
        pairs = [(f"E{k}", f"[PER{k}] Kim {k} [/PER{k}]", f"[PRD{k}]cream {k}[/PRD{k}]", rng.choice(["used_by", "no_relation", "owns"])) for k in range(n)]
        meta = [(f"E{k}", ("NER", "PER", f"Kim {k}"), ("BEE" if k % 3 == 0 else "NER", "PRD", f"cream {k}")) for k in range(n)]
        made.append((f"d{i}", f"Document {i}: " + " ".join(p[1] + " likes " + p[2] for p in pairs), pairs, meta))
    return spark.createDataFrame(made, files.RAW).cache()


def test_training_rows(spark, docs):
    settings = runs.Settings(TEMPLATES, target_train=60, limits={"relation": {"low": 5}})
    rows = runs.training(docs, settings).collect()
    assert rows and {r.mode for r in rows} == {"system_only", "full_detailed", "full_summary", "no_fewshot"}
    by_origin = {}
    for r in rows:
        by_origin.setdefault(r.origin_id, set()).add(r.split)
        assert r.text.startswith("<bos><|turn>system\n### System Prompt:\nSystem ner_")
        assert ("### Few-shot Examples:" in r.text) == r.mode.startswith("full_")
        assert ("Long description" in r.text) == (r.mode in ("full_detailed", "no_fewshot"))
        own = r.text.split("### Input:\n")[-1].split('"candidate_pairs"')[0]
        assert own not in r.text.split("### Input:\n")[0]  # never its own example; every text names its document
    assert all(len(s) == 1 for s in by_origin.values())
    assert len({(r.task, r.chunk_id) for r in rows}) == len(rows)
    gold = docs.limit(5)
    assert runs.training(docs, runs.Settings(TEMPLATES, target_train=None, train_only=True), gold).where("split <> 'train'").count() == 0


def test_evaluation_and_merge(spark, docs):
    settings = runs.Settings(TEMPLATES)
    rows = runs.evaluation(docs, settings, "ner_ner", "no_fewshot").cache()
    assert sorted(r.row_id for r in rows.collect()) == list(range(rows.count()))
    assert rows.where(~F.col("prompt").endswith(dims.FORMATS["gemma4"][0])).count() == 0
    assert rows.where(F.col("ground_truth").contains("<turn|>")).count() == 0
    told = rows.select("row_id", F.concat(F.lit("<think>so</think>"), "ground_truth").alias("prediction"))
    tuples, rate = runs.merged(told, rows, docs, settings)
    want = {(d.id, f"[{p.pair_id}]") for d in docs.collect() for p, m in zip(d.candidate_pairs, d.meta_info) if m.object.source_type == "NER"}
    got = tuples.collect()
    assert {(r.origin_id, r.pair_id) for r in got} == want and len(got) == len(want)
    assert {r.relation for r in got} == {"used_by", "no_relation", "owns"}
    assert rate.first().rate == 1.0
    with pytest.raises(ValueError):
        runs.merged(told.limit(1), rows, docs, settings)
    with pytest.raises(ValueError):
        runs.evaluation(docs, settings, "bee_bee", "no_fewshot")
    with pytest.raises(ValueError):
        runs.evaluation(docs.limit(0), settings, "ner_ner", "no_fewshot")
    answered = told.join(rows.select("row_id", F.col("prompt").alias("full_input"), "ground_truth"), "row_id")
    records = runs.merged_records(answered.withColumn("prediction", F.when(F.col("row_id") % 5 > 0, F.col("prediction")).otherwise("no answer")), rows, docs, settings).collect()
    assert len(records) == rows.count()
    for r in records:
        assert r.expected_task == "NER-NER" and r.mode == "no_fewshot" and r.full_input
        assert r.pred_tuples == (r.ground_truth if r.row_id % 5 else []) and r.ground_truth
        assert all((t.subject.source_type, t.subject.word) == ("NER", f"Kim {t.pair_id[2:-1]}") and t.object.word == f"cream {t.pair_id[2:-1]}" for t in r.ground_truth)


def test_hit_rate_covers_rows_past_the_first_hundred(spark, docs):
    settings = runs.Settings(TEMPLATES)
    rows = runs.evaluation(docs, settings, "ner_bee", "no_fewshot").withColumn("row_id", F.col("row_id") + 100)
    told = rows.select("row_id", F.col("ground_truth").alias("prediction"))
    rate = runs.merged(told, rows, docs, settings)[1].first()
    assert rate.tuples > 0 and rate.rate == 1.0
    assert rate.first_tuples == 0 and rate.first_rate is None


def test_no_documents(spark, docs):
    none = docs.limit(0)
    assert runs.training(none, runs.Settings(TEMPLATES)).count() == 0
    assert runs.evaluation(none, runs.Settings(TEMPLATES), "ner_bee", "reasoning", allow_empty=True).count() == 0


def test_gold_first_equals_a_plain_walk(spark):
    for seed in range(4):
        rng = random.Random(seed)
        rare = ("a", "b", "c")
        pools = [[("t", f"{side}{i}", rng.randint(0, 5), rng.random() < 0.2, rng.sample("abcxyz", 2)) for i in range(30)] for side in "gm"]
        gold, main = (spark.createDataFrame(p, "task string, chunk_id string, pair_count int, priority boolean, rel_labels array<string>") for p in pools)
        got = [(r.origin, r.chunk_id) for r in sampling.gold_first(gold, main, rare=rare).orderBy("place").collect()]
        order = lambda r: (not r[3], hashlib.md5(f"42:{r[1]}".encode()).hexdigest())
        used, want, have = 0, [], set()
        for r in sorted(pools[0], key=order):
            if used >= 8:
                break
            if r[2] and used + r[2] <= 12:
                used += r[2]
                have |= set(r[4])
                want.append(("gold", r[1]))
        lacking = set(rare) - have
        first = next((r for r in sorted(pools[1], key=order) if r[2] and lacking & set(r[4])), None)
        if first and used + first[2] <= 12:
            want.append(("main", first[1]))
        assert got == want


def test_skip_greedy_equals_a_plain_walk(spark):
    rng = random.Random(8)
    rows = [(t, f"{t}{i}", rng.choice([1, 2, 2, 2, 7, 30])) for t in ("p", "q") for i in range(200)] + [("r", "r0", 3)]
    got = {(r.task, r.origin_id) for r in sampling.skip_greedy(spark.createDataFrame(rows, "task string, origin_id string, chunk_count int"), 57).collect()}
    want, total = set(), {}
    for t, name, n in sorted(rows, key=lambda r: hashlib.md5(f"42:{r[1]}".encode()).hexdigest()):
        if total.get(t, 0) + n <= 57:
            total[t] = total.get(t, 0) + n
            want.add((t, name))
    assert got == want
