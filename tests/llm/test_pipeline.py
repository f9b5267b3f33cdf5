"""The pipeline stage by stage against plain forms of each decision."""
from pyspark.sql import functions as F

import corpus_pipeline
from tuplewright.llm import line_crf

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "pii", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        rows = {r.doc_id: r for r in after.collect()}
        assert len(rows) == after.count()
        if name == "quality":
            wrong = [d for d, y in labels.items() if (d in rows) != (y == 1)]
            assert len(wrong) < 0.03 * len(labels)
        if name in ("quality", "near_dedup", "decontaminate"):
            assert after.columns == DOCUMENTS and set(rows) <= set(before)
            assert all(r.text == before[d] for d, r in rows.items())
        if name == "near_dedup":
            assert len({r.text for r in rows.values()}) == len(rows)
        if name == "pii":
            assert set(rows) == set(before) and all(r.n_chars == len(r.text) for r in rows.values())
            assert not any("@mail" in r.text for r in rows.values())
        if name == "bpe":
            assert set(rows) == set(before) and all(r.n_tokens > 0 for r in rows.values() if before[r.doc_id])
        else:
            docs = spark.createDataFrame(after.collect(), after.schema)
            before = {d: r.text for d, r in rows.items()}


def test_run_equals_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    want = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, sf).collect()} == want


def test_stages_on_awkward_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    good = spark.read.parquet(f"{sf}/documents.parquet").where("length(text) between 400 and 2000").select("text").limit(3).collect()
    text, item = good[0].text, spark.read.parquet(f"{sf}/benchmark.parquet").first().text
    rows = [
        (1, text, None, "s", None), (1, text, None, "s", None), (None, text, "en", None, 3), (2, None, "en", "s", 0), (3, "", None, None, None), (None, None, None, None, None),
        (4, good[1].text + " mail a@b.cc", "en", "s", 5), (5, "intro words " + item + " and more", "en", "s", 5), (6, "line of words, and more. " * 8000, "en", "s", 5), (6, good[2].text, "en", "s", 5),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("__row", "row", "id", "digest", "key", "component", "bad_digest", "label", "score"):
        docs = docs.withColumn(name, F.lit(name))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
        after = stage(spark, docs, sf)
        assert name == "bpe" or after.columns == DOCUMENTS
    assert {r.doc_id for r in stages["quality"](spark, docs, sf).collect()} <= {1, 4, 5, 6, None, 2, 3}
    kept = [(r.doc_id, r.text) for r in stages["near_dedup"](spark, docs, sf).collect()]
    assert sorted(d for d, _ in kept) == [1, 2, 4, 5, 6, 6] and dict(kept)[2] is None
    clean = stages["decontaminate"](spark, docs, sf).collect()
    assert len(clean) == 9 and 5 not in {r.doc_id for r in clean}
    safe = stages["pii"](spark, docs, sf).collect()
    assert len(safe) == 10 and all(r.n_chars == len(r.text) for r in safe) and sum(r.text == "" for r in safe) == 3
    assert next(r for r in safe if r.doc_id == 4).text.endswith("mail <EMAIL>")
    coded = stages["bpe"](spark, docs, sf).collect()
    assert sorted(r.n_tokens for r in coded)[:4][:3] == [0, 0, 0] and len(coded) == 10


def test_empty_text_scores(spark):
    model = line_crf.fit([])
    assert model.score("") == 0.5
