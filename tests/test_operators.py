"""Operators on rows that show each rule."""
import hashlib
import json
import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from tuplewright.functions import dims, labels, text
from tuplewright.operators import answers, ranking, render, routing, sampling, tools
from tuplewright.sources import files
from tuplewright.streaming.classified import classified_stream


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", make(F.col("v"))).orderBy("i").collect()]


def test_negative_forms(spark):
    values = [None, "No Relationship", " NO_RELATIONSHIP ", "", " used_by ", " no relation ", "no_relations"]
    assert column(spark, values, labels.normalize_negative) == ["NO_RELATION", "NO_RELATION", "NO_RELATION", "", " used_by ", "NO_RELATION", "no_relations"]


def test_attribute_map(spark):
    assert column(spark, ["Effect", "효과", None, "x"], labels.normalize_attribute) == ["효과", "효과", None, "x"]
    assert len(dims.ATTRIBUTE_LABELS) == 39 and len(dims.RARE) == 41


def doc(i, pairs, metas, body="[PRD1] Glow [/PRD1]"):
    return json.dumps({"id": i, "text": body, "candidate_pairs": [dict(pair_id=p, subject=s, object=o, relation=r) for p, s, o, r in pairs], "meta_info": metas}, ensure_ascii=False)


def side(a, b):
    return {"subject": {"source_type": a, "entity_group": "PRD", "word": "w"}, "object": {"source_type": b, "entity_group": "PER", "word": "v"}}


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("docs")
    pairs = [("E1", "[PRD1]a[/PRD1]", "b", "Effect"), ("E2", "a", "b", "Scent"), ("E3", "a", "b", "Effect"), ("E4", "a", "b", "Effect"), ("E5", "a", "b", None), ("E6", "a", "b", "used_by"), ("E7", "a", "b", "used_by")]
    metas = [dict(pair_id="E1", **side("NER", "ner")), dict(pair_id="E2", **side("NER", "NER")), dict(pair_id="E3", **side("NER", "BEE")), dict(pair_id="E4", **side("BEE", "NER")), dict(pair_id="E5", **side("BEE", "BEE")), dict(pair_id="E7", **side("BEE", "BEE")), dict(pair_id="E7", **side(None, "NER"))]
    lines = [doc(7, pairs, metas), "", doc("x", [], []), json.dumps({"text": "t", "candidate_pairs": [{"pair_id": "E1", "subject": "s", "object": "o"}]}), json.dumps({"text": "u", "candidate_pairs": None})]
    (where / "a.jsonl").write_text("\n".join(lines) + "\n")
    return str(where)


def test_read_route_and_count(spark, documents):
    docs = files.read_documents(spark, documents, prefix="gold_")
    assert {r.id for r in docs.collect()} == {"gold_7", "gold_x", "gold_all_2", "gold_all_3"}
    framed = files.with_ids(files.read_jsonl(spark, documents, files.RAW), "eval")
    assert {r.id for r in framed.collect()} == {"7", "x", "eval_2", "eval_3"} and framed.columns == files.RAW.names
    pairs = routing.explode_documents(docs)
    got = {(r.origin_id, r.pair_id): (r.task, r.relation) for r in routing.classify(pairs).collect()}
    assert got == {
        ("gold_7", "E1"): ("ner_ner", "affects"),
        ("gold_7", "E3"): ("ner_bee", "효과"),
        ("gold_7", "E4"): ("ner_bee", "NO_RELATION"),
        ("gold_7", "E6"): ("ner_ner", "used_by"),
        ("gold_all_2", "E1"): ("ner_ner", "NO_RELATION"),
    }
    assert tuple(routing.classify_counts(pairs).first()) == (1, 1, 1, 1)
    assert {r.pair_id for r in routing.without_negatives(pairs).collect()} == {"E1", "E2", "E3", "E4", "E6", "E7"}


def test_documents_of_several_files_are_numbered_in_order(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2.jsonl").write_text('{"text": "b2"}\n\n{"id": null, "text": "null"}\n{"id": 1.5, "text": "n"}\n')
    (tmp_path / "b" / "1.jsonl").write_text("".join(f'{{"text": "long {i}"}}\n' for i in range(50)))
    (tmp_path / "a.jsonl").write_text('{"text": "a0"}\n{"id": "", "text": "a1"}\n{"text": "a2", "candidate_pairs": ["[A1]x[/A1]", {"pair_id": 5, "subject": "s"}, null]}\n')
    docs = {r.text: r for r in files.read_documents(spark, [str(tmp_path / "b"), str(tmp_path / "a.jsonl")]).collect()}
    assert {t: docs[t].id for t in ("long 0", "long 49", "b2", "null", "n", "a0", "a1", "a2")} == {"long 0": "all_0", "long 49": "all_49", "b2": "all_50", "null": "None", "n": "1.5", "a0": "all_53", "a1": "", "a2": "all_55"}
    assert [p and tuple(p) for p in docs["a2"].candidate_pairs] == [("UNK", "UNKNOWN", "UNKNOWN", "NO_RELATION"), ("5", "s", None, None), None]
    with pytest.raises(Exception):
        (tmp_path / "c.jsonl").write_text('{"id": "1"}\n{broken\n')
        files.read_documents(spark, str(tmp_path / "c.jsonl")).collect()


def test_signatures_of_prompt_settings():
    prompts = """# c
system_prompt_ner_bee_true_only: |
  Only true
  # a note
  pairs.
system_prompt_ner_bee : |
  All   pairs
other: x
system_prompt_ner_ner: |
""" + "  long " * 100
    found = dict(files.signatures(prompts))
    assert found == {"NER-BEE_TRUE_ONLY": "Onlytruepairs.", "NER-BEE": "Allpairsother:x", "NER-NER": ("long" * 100)[:250]}


def test_double_encoded_answers_are_searched_decoded(spark):
    plain = '[{"pair_id": "[E1]" "subject": "A \\"b\\"", "object": "c", "relation": "owns"}]'
    rows = [(1, plain), (2, json.dumps(plain)), (3, json.dumps(json.dumps([{"pair_id": "[E1]", "subject": "a", "object": "c"}]))), (4, json.dumps("no braces")), (5, None)]
    got = {r.row_id: [tuple(t) for t in r.tuples] for r in answers.parse(spark.createDataFrame(rows, "row_id int, prediction string").withColumn("task", F.lit("NER-NER"))).collect()}
    assert got[2] == got[1] and len(got[1]) == 1 and got[3] == [("[E1]", "a", "c", "true")] or got[3] == [], got
    assert got[4] == got[5] == []


def test_parsed_records_and_audit(spark):
    rows = [(2, '[{"pair_id": "E1", "subject": "a", "object": "b", "relation": "owns"}]', "use the NER-NER task", "[]"), (1, None, None, '{"subject": "x (y)", "object": "z", "is_relational": true}')]
    told = spark.createDataFrame(rows, "row_id long, prediction string, full_input string, ground_truth string")
    records = answers.parsed_records(told, gold=True)
    got = {r.row_id: r for r in records.collect()}
    assert got[2].expected_task == "NER-NER" and [tuple(t) for t in got[2].pred_tuples] == [("E1", "a", "b", "owns")] and got[2].ground_truth == []
    assert got[1].expected_task == "COMBINE_ALL" and got[1].pred_tuples == [] and [tuple(t) for t in got[1].ground_truth] == [("UNKNOWN", "x (y)", "z", "true")]
    shown = answers.audit(records, 1).collect()
    assert [r.row_id for r in shown] == [1] and json.loads(shown[0].record)["full_input"] is None


def test_response_spans(spark):
    tag, user = "<|turn>model\n", "<|turn>user\n"
    values = [f"<bos>{user}hi<turn|>\n{tag}yes é<turn|>\n{user}more<turn|>\n{tag}a{tag}b", "none", "", None, tag]
    got = column(spark, values, text.response_spans)
    assert [values[0][b:e] for b, e in got[0]] == ["yes é<turn|>\n", "a", "b"]
    assert got[1:3] == [[], []] and [tuple(s) for s in got[4]] == [(len(tag), len(tag))]


def test_token_length_by_file(spark):
    tokenizers = pytest.importorskip("tokenizers")
    files_of = pytest.importorskip("public_tokenizers")
    path, values = files_of.path("byte_bpe_50k.json"), ["two words", "", None, "é😀   x"]
    tokenizer = tokenizers.Tokenizer.from_file(path)
    want = [None if v is None else len(tokenizer.encode(v, add_special_tokens=False).ids) for v in values]
    assert column(spark, values, lambda c: text.token_len(c, f"file:{path}")) == want


def test_tools_in_transcripts(spark):
    q = '<|"|>'
    weather = {"function": {"name": "weather", "description": "Tells it.", "parameters": {"type": "object", "required": ["city"], "properties": {
        "unit": {"type": "string", "enum": ["C", "F"], "description": "Unit"}, "city": {"type": "string"},
        "days": {"type": "array", "nullable": True, "items": {"type": "integer", "minimum": 1}}, "Area": {"type": "object", "properties": {"lat": {"type": "number"}}, "required": ["lat"]},
    }}, "response": {"type": "object", "description": "A text"}}}
    told = tools.declaration(weather)
    area = "Area:{,properties:{lat:{type:#NUMBER#}},required:[#lat#]type:#OBJECT#}"
    want = f"declaration:weather{{description:#Tells it.#,parameters:{{properties:{{{area},city:{{type:#STRING#}},days:{{nullable:true,items:{{minimum:1,type:#INTEGER#}},type:#ARRAY#}},unit:{{description:#Unit#,enum:[#C#,#F#],type:#STRING#}}}},required:[#city#],type:#OBJECT#}},response:{{description:#A text#,type:#OBJECT#}}}}"
    assert told == want.replace("#", q)
    assert tools.literal({"b": [1, 2.5, None, True], "A": "x"}) == f"{{{q}A{q}:{q}x{q},{q}b{q}:[1,2.5,None,true]}}"
    messages = [
        {"role": "user", "content": [{"type": "text", "text": " look "}, {"type": "image"}, {"type": "audio"}]},
        {"role": "assistant", "tool_calls": [{"function": {"name": "weather", "arguments": {"unit": "C", "city": "Oslo"}}}], "content": "<|channel>hm<channel|> so "},
        {"role": "tool", "tool_responses": [{"name": "weather", "response": {"t": 3}}, {"response": "mild"}]},
    ]
    text_ = f"<bos><|turn>system\n<|tool>{told}<tool|><turn|>\n<|turn>user\nlook\n\n<|image|>\n\n<|audio|><turn|>\n<|turn>model\n<|tool_call>call:weather{{city:{q}Oslo{q},unit:{q}C{q}}}<tool_call|>so<turn|>\n<|turn>tool\n<|tool_response>response:weather{{t:3}}<tool_response|><|tool_response>response:unknown{{value:{q}mild{q}}}<tool_response|>"
    df = spark.createDataFrame([(json.dumps(messages), json.dumps([weather])), (None, None)], "m string, t string")
    assert [r[0] for r in df.select(tools.rich_chat(generation=True)("m", "t")).collect()] == [text_, None]


def test_tool_transcripts_without_tools_equal_the_native_ones(spark):
    talks = [[("system", " be kind "), ("user", "hi\n"), ("assistant", "<|channel>think<channel|>yes<|channel>no")], [("user", "a"), ("assistant", "b"), ("user", "c")], [("developer", "d")]]
    for generation in (False, True):
        for talk in talks:
            df = spark.createDataFrame([([dict(role=r, content=c) for r, c in talk],)], "m array<struct<role:string,content:string>>")
            native = df.select(render.chat(F.col("m"), generation=generation, thinking=generation)).first()[0]
            assert tools.transcript([dict(role=r, content=c) for r, c in talk], (), generation, generation) == native


def test_unmet_floors(spark):
    rows = [("ner_ner", f"o{i}", f"o{i}", "owns" if i < 30 else "rare", "A", "B") for i in range(32)]
    df = spark.createDataFrame(rows, "task string, origin_id string, chunk_id string, label string, subj_group string, obj_group string")
    chosen = df.where("origin_id in ('o1', 'o2', 'o31')").select("task", "origin_id")
    got = {tuple(r) for r in sampling.unmet_floors(df, chosen).collect()}
    assert got == {("ner_ner", "relation", "owns", 20, 2), ("ner_ner", "group", "A>B", 10, 3)}
    assert sampling.unmet_floors(df, df.select("task", "origin_id")).count() == 0


def test_first_task_follows_the_order_of_tasks(spark):
    df = spark.createDataFrame([("a", "ner_bee"), ("a", "ner_ner"), ("b", "ner_bee"), ("c", "zz"), ("c", "aa"), ("c", "ner_bee_true_only")], "origin_id string, task string")
    assert {r.origin_id: r.task for r in sampling.first_task(df).collect()} == {"a": "ner_ner", "b": "ner_bee", "c": "ner_bee_true_only"}
    assert {r.origin_id: r.task for r in sampling.first_task(df, ("zz",)).collect()} == {"a": "ner_bee", "b": "ner_bee", "c": "zz"}


def test_broken_line_fails(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"id": "1"}\n{broken\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "b.jsonl"), files.RAW).collect()


def test_stream_routes_like_batch(spark, documents, tmp_path):
    query = classified_stream(spark, documents).writeStream.format("memory").queryName("routed").option("checkpointLocation", str(tmp_path)).start()
    query.processAllAvailable()
    query.stop()
    batch = routing.classify(routing.explode_documents(files.read_jsonl(spark, documents, files.RAW)))
    assert Counter(map(tuple, spark.table("routed").collect())) == Counter(map(tuple, batch.collect()))


def test_chunks_at_and_over_the_threshold(spark):
    rows = [("t", "a", i, "E%d" % i) for i in range(4)] + [("t", "b", i, "E%d" % i) for i in range(5)]
    got = routing.chunk_fixed(spark.createDataFrame(rows, "task string, origin_id string, pos int, pair_id string"), 4).collect()
    assert Counter(r.chunk_id for r in got) == {"a": 4, "b_chunk_0": 4, "b_chunk_1": 1}


def test_adaptive_falls_to_the_last_threshold(spark):
    rows = [("t", "a", i, 5) for i in range(6)] + [("t", "b", i, 50) for i in range(4)]
    df = spark.createDataFrame(rows, "task string, origin_id string, pos int, n int")
    got = {r.origin_id: r.threshold for r in routing.chunk_adaptive(df, (4, 2), 20, F.col("n")).collect()}
    assert got == {"a": 4, "b": 2}


def test_narrowing(spark):
    long = "x" * 1000 + "[PRD1]😀[/PRD1]" + "y" * 1000
    df = spark.createDataFrame([(long, ["PRD1"]), (long, ["PRD2"]), (long, []), ("[A1]b[/A1]", ["A1"])], "t string, tags array<string>")
    got = [r[0] for r in df.select(text.narrow(F.col("t"), F.col("tags"))).collect()]
    assert got == ["x" * 200 + "[PRD1]😀[/PRD1]" + "y" * 200, long, long, "[A1]b[/A1]"]


def test_tags(spark):
    assert column(spark, ["[PER1] a [/PER1]", '"[P/A_2] x y[/P/A_2]', None], text.tight_tags) == ["[PER1]a[/PER1]", "[P/A_2]x y[/P/A_2]", "UNKNOWN"]
    assert column(spark, ["[PER1]a[/PER1] [AB_3]", ""], lambda c: F.array_join(text.tag_ids(c), ",")) == ["PER1,AB_3", ""]
    assert column(spark, ["x [AB12]", "none"], text.tag_name) == ["AB", ""]


def test_io_json_is_json(spark):
    rows = [("ner_bee", "o", "o", 'say "é"\n', 0, "E1", "[A1] x [/A1]", 'q"r', "효과"), ("ner_ner", "p", "p", None, 0, None, "s", "o", None)]
    df = spark.createDataFrame(rows, "task string, origin_id string, chunk_id string, text string, pos int, pair_id string, subject string, object string, relation string")
    got = {r.task: r for r in render.io_json(df).collect()}
    want = {"text": 'say "é"\n', "candidate_pairs": [{"pair_id": "[E1]", "subject": "[A1]x[/A1]", "is_relational": None, "object": "qr"}]}
    assert got["ner_bee"].input == json.dumps(want, indent=2, ensure_ascii=False)
    want["candidate_pairs"][0]["is_relational"] = "true"
    assert got["ner_bee"].output == json.dumps(want["candidate_pairs"], indent=2, ensure_ascii=False)
    assert json.loads(got["ner_ner"].output) == [{"pair_id": "[UNK]", "subject": "s", "relation": "NO_RELATION", "object": "o"}]


def test_chat(spark):
    turns = [(1, 0, "system", " be kind "), (1, 1, "user", "hi"), (1, 2, "assistant", "<|channel>hm<channel|> yes "), (2, 0, "user", None)]
    df = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    got = {r.conv_id: r.transcript for r in render.chats(df, generation=True).collect()}
    assert got[1] == "<bos><|turn>system\nbe kind<turn|>\n<|turn>user\nhi<turn|>\n<|turn>model\nyes<turn|>\n<|turn>model\n"
    assert got[2] == "<bos><|turn>user\n<turn|>\n<|turn>model\n"
    assert render.chats(df.where("conv_id = 2"), thinking=True).first().transcript.startswith("<bos><|turn>system\n<|think|><turn|>\n")


def parsed(spark, rows):
    df = spark.createDataFrame(rows, "task string, prediction string")
    return [{tuple(t) for t in r.tuples} for r in answers.parse(df.withColumn("k", F.monotonically_increasing_id())).orderBy("k").collect()]


def test_answers(spark):
    got = parsed(
        spark,
        [
            ("NER-NER", '### Response:\n```json\n[{"pair_id": "[E1]", "subject": "A", "object": {"word": "B"}, "relation": "Used_By"}]\n```'),
            ("NER-NER", '[{"pair_id": "[E1]" "subject": "A", "object": "B"}]'),
            ("NER-NER", '[{"pair_id": "[E1]", "subject": "A", "object": "B"}]'),
            ("NER-BEE", '[{"pair_id": "[E1]", "subject": "x (y)", "object": "z", "is_relational": true}]'),
            ("NER-BEE", '{"NER-NER": [{"pair_id": 3, "subject": "a", "object": "b", "relation": "r"}], "NER-BEE": "none"}'),
            ("NER-NER", '[{"pair_id": "1", "subject": "a", "object": "b", "relation": "r"}, {"pair_id": "1", "subject": "a", "object": "b", "relation": "q"}, {"pair_id": "1", "subject": "", "object": "b"}, 7]'),
            ("NER-NER", "7"),
            ("NER-NER", ""),
            ("NER-NER", None),
            ("NER-BEE", '{"pair_id": "1", "subject": "a", "object": "b", "is_relational": [false]} trailing'),
        ],
    )
    assert got == [
        {("[E1]", "a", "b", "used_by")},
        {("[E1]", "a", "b", "true")},
        {("[E1]", "a", "b", "no_relation")},
        {("[E1]", "x", "z", "true")},
        {("3", "a", "b", "r")},
        {("1", "a", "b", "r"), ("1", "a", "b", "q")},
        set(),
        set(),
        set(),
        {("1", "a", "b", "false")},
    ]


def test_row_guard_and_metadata(spark):
    rows = spark.range(3).withColumnRenamed("id", "row_id")
    with pytest.raises(ValueError):
        answers.zip_by_row(rows.where("row_id < 2"), rows.withColumn("x", F.lit(1)))
    with pytest.raises(ValueError):
        answers.zip_by_row(rows.unionByName(rows.limit(1)), rows.withColumn("x", F.lit(1)))
    meta = spark.createDataFrame([("o", "E1", 0, True, "NER", "A", "NER", "B"), ("o", "[E1]", 1, True, "NER", "C", "NER", "D"), ("o", "E2", 2, True, "BEE", "A", "bee", "B")], "origin_id string, pair_id string, pos int, has_meta boolean, subj_source string, subj_group string, obj_source string, obj_group string")
    assert [(r.pair_id, r.subj_group) for r in answers.metadata_rows(meta).collect()] == [("[E1]", "C")]


def test_task_detection(spark):
    values = [None, "", "There are three tasks and three respective descriptions:", "is_relational", "use BEE-BEE or NER-NER", "NER-NER", "?"]
    assert column(spark, values, text.detect_task) == ["COMBINE_ALL", "COMBINE_ALL", "COMBINE_ALL", "NER-BEE", "BEE-BEE", "NER-NER", "COMBINE_ALL"]


def test_split_arithmetic_and_first_task(spark):
    rows = [("a", f"o{i}") for i in range(90)] + [("b", "o1"), ("b", "only")]
    got = sampling.split(spark.createDataFrame(rows, "task string, origin_id string")).collect()
    assert Counter(r.split for r in got if r.task == "a") == {"train": 62, "validation": 10, "test": 18}
    assert len(got) == 91


def test_skip_greedy_is_not_a_running_sum(spark):
    origins = spark.createDataFrame([("t", x, n) for x, n in zip("abc", (3, 4, 2))], "task string, origin_id string, chunk_count int")
    order = sorted("abc", key=lambda x: __import__("hashlib").md5(f"42:{x}".encode()).hexdigest())
    size, left, want = dict(zip("abc", (3, 4, 2))), 5, set()
    for x in order:
        if size[x] <= left:
            want.add(x)
            left -= size[x]
    assert {r.origin_id for r in sampling.skip_greedy(origins, 5).collect()} == want


def taken(origins, *rules):
    """origin -> step, from dicts whose groups are name -> pairs."""
    listed = [dict(o, rel_labels=sorted(o["rel_labels"]), group_pairs=sorted(o["group_pairs"]), **{k: sorted(g for g, n in o[k].items() for _ in range(n)) for k in ("subjects", "objects")}) for o in origins]
    kinds = dict(chunk_count=pa.int64(), priority=pa.bool_(), **{k: pa.list_(pa.string()) for k in ("rel_labels", "group_pairs", "subjects", "objects")})
    table = pa.table({k: pa.array([o[k] for o in listed], t) for k, t in kinds.items()})
    return {origins[i]["origin_id"]: step for i, step in sampling.select_diverse(table, *rules)}


def walked(origins, room, rel_need, grp_need, rare, exposure, caps):
    """The rules one origin at a time, with counters."""
    rel_need, grp_need, count, chosen = Counter(rel_need), Counter(grp_need), 0, {}
    labels_taken, subjects, objects = Counter(), Counter(), Counter()

    def gain(o):
        return sum(min(rel_need[x], o["chunk_count"]) for x in o["rel_labels"]) + sum(min(grp_need[x], o["chunk_count"]) for x in o["group_pairs"])

    def over(o):
        n = o["chunk_count"]
        return sum(max(0.0, (labels_taken[x] + (n if x in o["rel_labels"] else 0)) / (count + n) - cap) for x, cap in caps.items())

    def new(o):
        return sum(1 / math.sqrt(1 + subjects[g]) for g in sorted(o["subjects"])) + sum(1 / math.sqrt(1 + objects[g]) for g in sorted(o["objects"]))

    def take(o, step):
        nonlocal count
        chosen[o["origin_id"]] = step
        count += o["chunk_count"]
        for x in o["rel_labels"]:
            labels_taken[x] += o["chunk_count"]
            rel_need[x] = max(0, rel_need[x] - o["chunk_count"])
        for x in o["group_pairs"]:
            grp_need[x] = max(0, grp_need[x] - o["chunk_count"])
        subjects.update(o["subjects"])
        objects.update(o["objects"])

    def free(o):
        return o["origin_id"] not in chosen and count + o["chunk_count"] <= room

    for label in sorted({*rel_need, *rare}, key=lambda x: (exposure.get(x, 0), x)):
        if not any(label in o["rel_labels"] for o in origins if o["origin_id"] in chosen):
            for o in sorted((o for o in origins if label in o["rel_labels"] and free(o)), key=lambda o: o["chunk_count"])[:1]:
                take(o, "A0")
    for o in origins:
        if o["priority"] and free(o):
            take(o, "A")
    common = [o for o in origins if not o["priority"]]
    for o, _ in sorted([(o, gain(o) - 2 * over(o) * count) for o in common], key=lambda x: -x[1]):
        if free(o) and gain(o) > 0:
            take(o, "B")
            if not any(rel_need.values()) and not any(grp_need.values()):
                break
    later = []
    for o, _ in sorted([(o, new(o) - 3 * over(o) * max(1, count)) for o in common if free(o)], key=lambda x: -x[1]):
        if free(o):
            if over(o) <= 0.005:
                take(o, "C")
            elif over(o) <= 0.01:
                later.append(o)
    for o in later:
        if free(o) and over(o) <= 0.01:
            take(o, "C")
    return chosen


def random_origins(rng, n):
    names = ["r0", "r1", "r2", "r3"]
    for i in range(n):
        held = rng.sample(names, rng.randint(1, 3))
        groups = {g: rng.randint(1, 3) for g in rng.sample("ABC", rng.randint(1, 2))}
        yield dict(origin_id=f"o{i}", chunk_count=rng.randint(1, 6), rel_labels=held, group_pairs=[f"{g}>X" for g in groups], priority="r3" in held and rng.random() < 0.6, subjects=groups, objects={"X": 1})


def test_diverse_selection_equals_a_plain_walk():
    for seed in range(400):
        rng = random.Random(seed)
        origins = list(random_origins(rng, rng.choice((3, 25, 120))))
        caps = {"r1": rng.choice((0.02, 0.2, 0.3)), "r0": rng.choice((0.1, 0.4))} if seed % 5 else {}
        rules = rng.choice((1, 20, 90, 250)), {"r0": 5, "r3": 3, "r2": rng.randint(0, 60)}, {"A>X": rng.randint(0, 40), "C>X": 9}, {"r3"}, {"r0": 50, "r1": 40, "r2": 30, "r3": 5}, caps
        assert taken(origins, *rules) == walked(origins, *rules), seed


def test_diverse_selection_of_nothing():
    assert taken([], 5, {"r": 1}, {}, {"q"}, {}, {"r": 0.1}) == {}


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60))
def test_diverse_selection_keeps_its_promises(seed, room):
    origins = [o | {"priority": "r3" in o["rel_labels"]} for o in random_origins(random.Random(seed), 25)]
    chosen = taken(origins, room, {"r0": 5, "r3": 3}, {"A>X": 4}, {"r3"}, {"r0": 50, "r1": 40, "r2": 30, "r3": 5}, {"r1": 0.3})
    size = {o["origin_id"]: o["chunk_count"] for o in origins}
    total = sum(size[x] for x in chosen)
    assert total <= room and all(step in ("A0", "A", "B", "C") for step in chosen.values())
    carriers = [o for o in origins if "r3" in o["rel_labels"]]
    if carriers and min(o["chunk_count"] for o in carriers) <= room:
        assert any(o["origin_id"] in chosen for o in carriers)
    assert not any(o["priority"] and o["origin_id"] not in chosen and o["chunk_count"] <= room - total for o in origins)


def test_coverage_pass_counts_an_origin_once():
    one = dict(origin_id="a", chunk_count=4, rel_labels=["r"], group_pairs=[], priority=False, subjects={"A": 1}, objects={"B": 1})
    two = dict(one, origin_id="b")
    # "a" is taken as the carrier of "r"; counting it again would leave no room for "b".
    assert taken([one, two], 8, {"r": 8}, {}, set(), {"r": 8}, {}) == {"a": "A0", "b": "B"}


def test_diversity_query_equals_a_plain_walk(spark, sf):
    from tuplewright.plans import catalogue

    rows = [r.asDict() for r in catalogue._rows(spark, sf).collect()]
    want = {}
    for task in sorted({r["task"] for r in rows}):
        origins = {}
        for r in rows:
            if r["task"] == task:
                o = origins.setdefault(r["origin_id"], dict(origin_id=r["origin_id"], chunks=set(), rel_labels=set(), group_pairs=set(), subjects=Counter(), objects=Counter()))
                o["chunks"].add(r["chunk_id"])
                o["rel_labels"].add(r["label"])
                o["group_pairs"].add(f"{r['subj_group']}>{r['obj_group']}")
                o["subjects"][r["subj_group"]] += 1
                o["objects"][r["obj_group"]] += 1
        ordered = sorted(origins.values(), key=lambda o: (hashlib.md5(f"42:{o['origin_id']}".encode()).hexdigest(), o["origin_id"]))
        exposure, support, pairs = Counter(), Counter(), Counter()
        for o in ordered:
            o["chunk_count"] = len(o["chunks"])
            exposure.update({x: o["chunk_count"] for x in o["rel_labels"]})
            support.update(o["rel_labels"])
            pairs.update(o["group_pairs"])
        caps = dims.HEAD_CAPS[task]
        rel_need = {x: max(20, min(100, int(0.25 * n))) for x, n in exposure.items() if n >= 20 and x not in caps}
        grp_need = {x: max(10, min(60, int(0.15 * n))) for x, n in pairs.items() if n >= 10}
        rare = {x for x, n in exposure.items() if (n < 40 or support[x] < 15) and x not in caps}
        for o in ordered:
            o["priority"] = bool(o["rel_labels"] & (rare | set(dims.RARE)))
        if sum(o["chunk_count"] for o in ordered) <= 400:
            want |= {(task, o["origin_id"]): "all" for o in ordered}
        else:
            want |= {(task, x): step for x, step in walked(ordered, 400, rel_need, grp_need, rare, exposure, caps).items()}
    got = {(r.task, r.origin_id): r.step for r in catalogue.diversity_sample(spark, sf).collect()}
    assert got == want and len({*want.values()}) > 1


def test_examples_equal_a_plain_walk(spark):
    rng = random.Random(4)
    rows = [("t", f"c{i}", rng.randint(0, 14), rng.random() < 0.1) for i in range(300)]
    got = {r.chunk_id for r in sampling.pick_examples(spark.createDataFrame(rows, "task string, chunk_id string, pair_count int, priority boolean")).collect()}
    key = lambda r: (not r[3], __import__("hashlib").md5(f"42:{r[1]}".encode()).hexdigest())
    total, want = 0, set()
    for _, name, n, _ in sorted(rows, key=key):
        if total >= 8:
            break
        if n and total + n <= 12:
            total += n
            want.add(name)
    assert got == want


def test_positions_are_a_permutation(spark):
    rows = spark.range(500).select(F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("string").alias("g"))
    got = ranking.positions(rows, "g", "k", 1).collect()
    for g in "01":
        assert sorted(r.position for r in got if r.g == g) == list(range(250))
    keys = {r.k: __import__("hashlib").md5(f"1:{r.k}".encode()).hexdigest() for r in got}
    order = [keys[r.k] for r in sorted((r for r in got if r.g == "0"), key=lambda r: r.position)]
    assert order == sorted(order)


def test_modes_are_disjoint_ranges(spark):
    rows = spark.range(103).select(F.lit("t").alias("task"), F.col("id").cast("string").alias("chunk_id"))
    got = Counter(r.mode for r in sampling.mode_partition(rows).collect())
    full = math.floor(103 * 0.6)
    assert got == {"system_only": 20, "full_detailed": math.floor(full * 0.7), "full_summary": full - math.floor(full * 0.7), "no_fewshot": 20}


def test_interleave_recycles(spark):
    main, gold = spark.range(90).withColumnRenamed("id", "row_key"), spark.range(3).withColumnRenamed("id", "row_key")
    got = Counter(r.origin for r in sampling.interleave(main, gold).collect())
    assert got == {"main": 90, "gold": 10}
    assert sampling.interleave(main, gold.limit(0)).count() == 90


def test_stores(spark, tmp_path):
    rows = spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string")
    files.write_splits(rows, str(tmp_path / "s"))
    files.write_splits(rows.limit(0), str(tmp_path / "none"))
    assert [p.name for p in (tmp_path / "none").iterdir() if p.is_dir()] == ["split=train"]
    assert {r.text for r in spark.read.parquet(str(tmp_path / "s")).where("split = 'test'").collect()} == {"b"}
    path = files.cached_path(str(tmp_path), {"a": 1})
    assert path != files.cached_path(str(tmp_path), {"a": 2})
    assert files.read_or_make(spark, path, lambda: rows).count() == files.read_or_make(spark, path, lambda: 1 / 0).count() == 2
    files.write_jsonl(spark.createDataFrame([(None, 1)], "a string, b int"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":null,"b":1}'
    assert files.signature("# c\nA b\n\n c") == "Abc" and files.settings('{"a": 1}') == {"a": 1}


def test_entry(spark):
    made = __spark_entry__.entry(spark)
    assert made.columns == ["task", "split", "origins", "pairs", "negatives"] and made.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
