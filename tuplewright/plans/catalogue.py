"""Every registered query and its SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims, labels, text
from ..operators import answers, ranking, render, routing, sampling
from ..sources import files
from . import carriers, runs

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _register(sql: str | None):
    def keep(query):
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return keep


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---- SQL pieces -------------------------------------------------------------------
_NEGATIVE = "(relation IS NULL OR replace(lower(trim(relation)), ' ', '_') IN ('no_relation', 'no_relationship'))"
_F1 = f"CASE WHEN {_NEGATIVE} THEN 'NO_RELATION' ELSE relation END"
_KOREAN = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dims.ATTRIBUTE_LABELS.items())
_MAPPED = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in dims.ATTRIBUTE_TO_RELATION.items())
_ATTRIBUTES = _quoted([*dims.ATTRIBUTE_LABELS, *dims.ATTRIBUTE_LABELS.values()])
_PAIRS = f"pairs AS ({carriers.pairs_sql()})"
_SOURCES = f"""{_PAIRS}, sourced AS (
  SELECT *, CASE WHEN has_meta THEN upper(subj_source) ELSE 'NER' END AS s, CASE WHEN has_meta THEN upper(obj_source) ELSE 'NER' END AS o, {_F1} AS plain FROM pairs
)"""
_CLASSIFIED = f"""{_SOURCES}, classified AS (
  SELECT origin_id, pos, pair_id, subject, object, has_meta, subj_group, obj_group, task, rel AS relation FROM (
    SELECT *, CASE WHEN s = 'NER' AND o = 'NER' THEN 'ner_ner' WHEN (s = 'NER' AND o = 'BEE') OR (s = 'BEE' AND o = 'NER') THEN 'ner_bee' END AS task,
      CASE WHEN s = 'NER' AND o = 'NER' THEN CASE plain {_MAPPED} ELSE CASE WHEN plain IN ({_ATTRIBUTES}) THEN NULL ELSE plain END END
           WHEN s = 'BEE' AND o = 'NER' THEN 'NO_RELATION'
           WHEN s = 'NER' AND o = 'BEE' THEN CASE plain {_KOREAN} ELSE plain END END AS rel
    FROM sourced) WHERE task IS NOT NULL AND rel IS NOT NULL
)"""
_CHUNKED = f"""{_CLASSIFIED}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY task, origin_id ORDER BY pos) - 1 AS place, count(*) OVER (PARTITION BY task, origin_id) AS n FROM classified
), chunked AS (
  SELECT *, CASE WHEN n > 2 THEN origin_id || '_chunk_' || CAST(place // 2 AS VARCHAR) ELSE origin_id END AS chunk_id FROM placed
)"""
_ROWS = f"""{_CHUNKED}, rows_ AS (
  SELECT task, origin_id, chunk_id,
    CASE WHEN task = 'ner_bee' THEN CASE WHEN relation = 'NO_RELATION' THEN '__bee_false__' ELSE '__bee_true__' END ELSE relation END AS label,
    coalesce(CASE WHEN has_meta THEN subj_group END, nullif(regexp_extract(subject, '\\[([A-Z_][A-Z_0-9/]*?)([0-9]+)\\]', 1), ''), 'UNK') AS sg,
    coalesce(CASE WHEN has_meta THEN obj_group END, nullif(regexp_extract(object, '\\[([A-Z_][A-Z_0-9/]*?)([0-9]+)\\]', 1), ''), 'UNK') AS og
  FROM chunked
)"""
_ORIGINS = f"""{_ROWS}, origins AS (
  SELECT task, origin_id, count(DISTINCT chunk_id) AS chunk_count, count(*) AS pair_count, bool_or(label IN ({_quoted(dims.RARE)})) AS has_static_rare FROM rows_ GROUP BY ALL
), origin_labels AS (SELECT DISTINCT task, origin_id, label, chunk_count FROM rows_ JOIN origins USING (task, origin_id)),
origin_groups AS (SELECT DISTINCT task, origin_id, sg || '>' || og AS group_pair FROM rows_)"""
_HEAD = "((task = 'ner_ner' AND label IN ('NO_RELATION', 'used_by', 'same_entity')) OR (task = 'ner_bee' AND label = '__bee_false__'))"
_SUPPORT = f"{_ORIGINS}, support AS (SELECT task, label, count(*) AS support, CAST(sum(chunk_count) AS BIGINT) AS exposure FROM origin_labels GROUP BY ALL)"
#: Exposure and origins below which a label of these tables is rare.
_FEW = {"chunks": 4000, "origins": 2400}
_RARE = f"{_SUPPORT}, rare AS (SELECT task, label FROM support WHERE (exposure < {_FEW['chunks']} OR support < {_FEW['origins']}) AND NOT {_HEAD})"
_PRIORITY = f"""{_RARE}, marked AS (
  SELECT o.task, o.origin_id, o.chunk_count, o.pair_count, o.has_static_rare OR EXISTS (SELECT 1 FROM origin_labels l JOIN rare r ON r.task = l.task AND r.label = l.label WHERE l.task = o.task AND l.origin_id = o.origin_id) AS priority FROM origins o
)"""
_SPLIT = f"""{_ORIGINS}, firsts AS (SELECT origin_id, arg_min(task, CASE task WHEN 'ner_ner' THEN 1 WHEN 'ner_bee' THEN 2 ELSE 3 END) AS task FROM origins GROUP BY 1), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY md5('42:' || origin_id), origin_id) - 1 AS position, count(*) OVER (PARTITION BY task) AS size FROM firsts
), split AS (
  SELECT origin_id, task, CASE WHEN position < floor(size * 0.7::DOUBLE) THEN 'train' WHEN position < floor(size * 0.8::DOUBLE) THEN 'validation' ELSE 'test' END AS split FROM ordered
)"""
_CHUNKS = f"{_PRIORITY}, chunk_rows AS (SELECT task, origin_id, chunk_id, count(*) AS pair_count FROM rows_ GROUP BY ALL)"
_MODES = f"""{_CHUNKS}, shuffled AS (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY md5('42:' || chunk_id), chunk_id) - 1 AS position, count(*) OVER (PARTITION BY task) AS size FROM chunk_rows
), cuts AS (SELECT *, floor(size * 0.2::DOUBLE) AS a, floor(size * 0.6::DOUBLE) AS f, floor(floor(size * 0.6::DOUBLE) * 0.7::DOUBLE) AS d FROM shuffled
), modes AS (
  SELECT task, chunk_id, CASE WHEN position < a THEN 'system_only' WHEN position < a + d THEN 'full_detailed' WHEN position < a + f THEN 'full_summary' WHEN position < a + f + a THEN 'no_fewshot' END AS mode FROM cuts
)"""


# ---- Spark pieces -----------------------------------------------------------------
def _classified(spark, sf_dir):
    return routing.classify(carriers.pairs(spark, sf_dir))


def _chunks(spark, sf_dir):
    return routing.chunk_fixed(_classified(spark, sf_dir), 2)


def _rows(spark, sf_dir):
    return routing.profile_rows(_chunks(spark, sf_dir))


def _origins(spark, sf_dir):
    return routing.origin_profile(_rows(spark, sf_dir))


def _support(spark, sf_dir):
    return routing.relation_support(_origins(spark, sf_dir))


def _marked(origins):
    return routing.priority_origins(origins, routing.dynamic_rare(routing.relation_support(origins), **_FEW))


def _priority(spark, sf_dir):
    return _marked(files.kept(_origins(spark, sf_dir)))


def _train_pool(spark, sf_dir):
    """Chunks of training origins; the profiled pairs and the profiles are written once and read by each branch."""
    rows = files.kept(_rows(spark, sf_dir))
    origins = files.kept(routing.origin_profile(rows))
    chunks = rows.groupBy("task", "origin_id", "chunk_id").agg(F.count("*").alias("pair_count"), F.array_sort(F.collect_set("label")).alias("rel_labels"))
    train = sampling.split(origins).where("split = 'train'")
    return files.kept(chunks.join(_marked(origins).select("task", "origin_id", "priority"), ["task", "origin_id"]).join(train, "origin_id", "left_semi"))


# ---- carriers and labels ----------------------------------------------------------
@_register(f"WITH {_PAIRS} SELECT * FROM pairs")
def carrier_pairs(spark, sf_dir):
    return carriers.pairs(spark, sf_dir)


@_register(f"WITH {_PAIRS} SELECT origin_id, pair_id, {_F1} AS relation FROM pairs")
def norm_negative(spark, sf_dir):
    return carriers.pairs(spark, sf_dir).select("origin_id", "pair_id", labels.normalize_negative(F.col("relation")).alias("relation"))


@_register(f"WITH {_PAIRS} SELECT relation, CASE relation {_KOREAN} ELSE relation END AS attribute, count(*) AS n FROM pairs GROUP BY ALL")
def attribute_map(spark, sf_dir):
    return carriers.pairs(spark, sf_dir).groupBy("relation", labels.normalize_attribute(F.col("relation")).alias("attribute")).agg(F.count("*").alias("n"))


@_register(f"WITH {_CLASSIFIED} SELECT task, CASE WHEN task = 'ner_bee' THEN CASE WHEN relation = 'NO_RELATION' THEN 'false' ELSE 'true' END ELSE relation END AS label, count(*) AS n FROM classified GROUP BY ALL")
def binary_label(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("task", labels.binary_label(F.col("task"), F.col("relation")).alias("label")).agg(F.count("*").alias("n"))


@_register("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'NER-NER' WHEN 'O' THEN 'NER-BEE' ELSE 'COMBINE_ALL' END AS task FROM orders")
def task_name_map(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "ner_ner").when(F.col("o_orderstatus") == "O", "NER_BEE").otherwise("else")
    return _read(spark, sf_dir, "orders").select("o_orderkey", labels.task_name(status).alias("task"))


@_register("SELECT * FROM (VALUES " + ", ".join(f"('{k}', {a}, {b}, {c}, {d})" for k, (a, b, c, d) in dims.MODES.items()) + ") v(mode, description, fewshot, summary, reasoning)")
def mode_presets(spark, sf_dir):
    return spark.createDataFrame([(k, *v) for k, v in dims.MODES.items()], "mode string, description boolean, fewshot boolean, summary boolean, reasoning boolean")


# ---- routing ----------------------------------------------------------------------
@_register(f"WITH {_CLASSIFIED} SELECT task, origin_id, pos, pair_id, relation FROM classified")
def classify_pairs(spark, sf_dir):
    return _classified(spark, sf_dir).select("task", "origin_id", "pos", "pair_id", "relation")


@_register(
    f"""WITH {_SOURCES} SELECT count(*) FILTER (s = 'NER' AND o = 'NER' AND plain IN ({_quoted(dims.ATTRIBUTE_TO_RELATION)})) AS mapped,
    count(*) FILTER (s = 'NER' AND o = 'NER' AND plain IN ({_ATTRIBUTES}) AND plain NOT IN ({_quoted(dims.ATTRIBUTE_TO_RELATION)})) AS dropped,
    count(*) FILTER (s = 'BEE' AND o = 'NER') AS forced_negative, count(*) FILTER (s = 'BEE' AND o = 'BEE') AS bee_bee FROM sourced"""
)
def classify_stats(spark, sf_dir):
    return routing.classify_counts(carriers.pairs(spark, sf_dir))


@_register(f"WITH {_PAIRS} SELECT origin_id, pair_id, relation FROM pairs WHERE NOT {_NEGATIVE}")
def remove_negatives(spark, sf_dir):
    return routing.without_negatives(carriers.pairs(spark, sf_dir)).select("origin_id", "pair_id", "relation")


@_register(f"WITH {_CLASSIFIED} SELECT 'ner_bee_true_only' AS task, origin_id, pair_id, relation FROM classified WHERE task = 'ner_bee' AND relation <> 'NO_RELATION'")
def true_only(spark, sf_dir):
    return routing.true_only(_classified(spark, sf_dir)).select("task", "origin_id", "pair_id", "relation")


# ---- chunks, tags, lengths --------------------------------------------------------
@_register(f"WITH {_CHUNKED} SELECT task, origin_id, chunk_id, pair_id FROM chunked")
def chunk_fixed(spark, sf_dir):
    return _chunks(spark, sf_dir).select("task", "origin_id", "chunk_id", "pair_id")


@_register(
    f"""WITH {_CLASSIFIED}, placed AS (
  SELECT *, row_number() OVER (PARTITION BY task, origin_id ORDER BY pos) - 1 AS place, count(*) OVER (PARTITION BY task, origin_id) AS n, length(subject) + length(object) AS cost FROM classified
), per AS (SELECT *, sum(cost) OVER (PARTITION BY task, origin_id) AS c0, sum(cost) OVER (PARTITION BY task, origin_id, place // 3) AS c3, sum(cost) OVER (PARTITION BY task, origin_id, place // 2) AS c2 FROM placed
), most AS (SELECT *, max(c3) OVER (PARTITION BY task, origin_id) AS m3, max(c2) OVER (PARTITION BY task, origin_id) AS m2 FROM per
), chosen AS (SELECT *, CASE WHEN c0 <= 150 THEN 0 WHEN m3 <= 150 THEN 3 WHEN m2 <= 150 THEN 2 ELSE 1 END AS threshold FROM most)
SELECT task, origin_id, pair_id, threshold, CASE WHEN threshold > 0 AND n > threshold THEN origin_id || '_chunk_' || CAST(place // threshold AS VARCHAR) ELSE origin_id END AS chunk_id FROM chosen"""
)
def chunk_adaptive(spark, sf_dir):
    cost = F.length("subject") + F.length("object")
    return routing.chunk_adaptive(_classified(spark, sf_dir), (3, 2, 1), 150, cost).select("task", "origin_id", "pair_id", "threshold", "chunk_id")


@_register(f"""WITH {_PAIRS} SELECT origin_id, pair_id, array_to_string(list_sort(list_distinct(regexp_extract_all(subject || object, '\\[([A-Z_][A-Z_0-9/]*[0-9]+)\\]', 1))), ',') AS tags,
 regexp_extract(object, '\\[([A-Z_][A-Z_0-9/]*?)([0-9]+)\\]', 1) AS name FROM pairs""")
def tag_ids(spark, sf_dir):
    both = text.tag_ids(F.concat("subject", "object"))
    return carriers.pairs(spark, sf_dir).select("origin_id", "pair_id", F.array_join(F.array_sort(both), ",").alias("tags"), text.tag_name(F.col("object")).alias("name"))


def _tagged(docs):
    """The 40th word of a text in tags."""
    words = F.split("text", " ")
    marked = F.transform(words, lambda w, i: F.when(i == 39, F.concat(F.lit("[PRD1]"), w, F.lit("[/PRD1]"))).otherwise(w))
    return docs.select("doc_id", F.array_join(marked, " ").alias("text"))


@_register(
    """WITH tagged AS (SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w, i: CASE WHEN i = 40 THEN '[PRD1]' || w || '[/PRD1]' ELSE w END), ' ') AS text FROM documents),
found AS (SELECT *, strpos(text, '[PRD1]') - 1 AS a, strpos(text, '[/PRD1]') - 1 + 7 AS b, length(text) AS n FROM tagged),
cut AS (SELECT *, greatest(0, a - 200) AS s, least(n, greatest(a + 6, b) + 200) AS e FROM found)
SELECT doc_id, md5(CASE WHEN a < 0 OR e - s >= n * 0.7::DOUBLE THEN text ELSE substr(text, CAST(s + 1 AS BIGINT), CAST(e - s AS BIGINT)) END) AS narrowed FROM cut"""
)
def narrow_text(spark, sf_dir):
    tagged = _tagged(_read(spark, sf_dir, "documents"))
    return tagged.select("doc_id", F.md5(text.narrow(F.col("text"), F.array(F.lit("PRD1")))).alias("narrowed"))


@_register(f"WITH {_PAIRS} SELECT origin_id, '[' || pair_id || ']' AS pair_id, regexp_replace(subject, '(\\[[^\\]]+\\])\\s*(.*?)\\s*(\\[/[^\\]]+\\])', '\\1\\2\\3', 'g') AS subject FROM pairs")
def tight_tags(spark, sf_dir):
    return carriers.pairs(spark, sf_dir).select("origin_id", text.bracketed(F.col("pair_id")).alias("pair_id"), text.tight_tags(F.col("subject")).alias("subject"))


@_register("SELECT lang AS task, CAST(max(ceil(strlen(source || text) / 4.0)) + 20 AS INT) AS overhead, CAST(8192 - (max(ceil(strlen(source || text) / 4.0)) + 20) - 1000 AS INT) AS safe_limit FROM documents GROUP BY 1")
def safe_limit(spark, sf_dir):
    made = _read(spark, sf_dir, "documents").select(F.col("lang").alias("task"), F.concat("source", "text").alias("r"))
    return render.overhead(made, "r", 8192, 1000)


@_register("SELECT doc_id FROM documents WHERE ceil(strlen(coalesce(text, '') || source) / 4.0) <= 512")
def length_prune(spark, sf_dir):
    return render.within(_read(spark, sf_dir, "documents"), ("text", "source"), 512).select("doc_id")


# ---- profiles ---------------------------------------------------------------------
@_register(f"WITH {_ROWS} SELECT task, chunk_id, array_to_string(list_sort(list_distinct(list(label))), ',') AS rel_labels, array_to_string(list_sort(list_distinct(list(sg || '>' || og))), ',') AS group_pairs, count(*) AS pair_count FROM rows_ GROUP BY ALL")
def chunk_profile(spark, sf_dir):
    found = routing.chunk_profile(_rows(spark, sf_dir))
    return found.select("task", "chunk_id", F.array_join("rel_labels", ",").alias("rel_labels"), F.array_join("group_pairs", ",").alias("group_pairs"), "pair_count")


@_register(f"WITH {_ORIGINS} SELECT * FROM origins")
def origin_profile(spark, sf_dir):
    return _origins(spark, sf_dir).select("task", "origin_id", "chunk_count", "pair_count", "has_static_rare")


@_register(f"WITH {_SUPPORT} SELECT * FROM support")
def rel_exposure(spark, sf_dir):
    return _support(spark, sf_dir)


@_register(f"WITH {_ORIGINS} SELECT task, group_pair, count(*) AS support FROM origin_groups GROUP BY ALL")
def group_support(spark, sf_dir):
    return routing.group_support(_origins(spark, sf_dir))


@_register(f"WITH {_SUPPORT} SELECT task, label, CAST(greatest(20, least(100, floor(0.25::DOUBLE * exposure))) AS INT) AS floor FROM support WHERE exposure >= 20 AND NOT {_HEAD}")
def rel_floor(spark, sf_dir):
    return routing.relation_floors(_support(spark, sf_dir))


@_register(f"WITH {_ORIGINS}, g AS (SELECT task, group_pair, count(*) AS support FROM origin_groups GROUP BY ALL) SELECT task, group_pair, CAST(greatest(10, least(60, floor(0.15::DOUBLE * support))) AS INT) AS floor FROM g WHERE support >= 10")
def group_floor(spark, sf_dir):
    return routing.group_floors(routing.group_support(_origins(spark, sf_dir)))


@_register(f"WITH {_RARE} SELECT * FROM rare")
def dynamic_rare(spark, sf_dir):
    return routing.dynamic_rare(_support(spark, sf_dir), **_FEW)


@_register(f"WITH {_PRIORITY} SELECT task, origin_id, priority FROM marked")
def priority_origins(spark, sf_dir):
    return _priority(spark, sf_dir).select("task", "origin_id", "priority")


@_register(f"WITH {_RARE} SELECT task, label FROM (SELECT DISTINCT task FROM rows_), (SELECT unnest([{_quoted(dims.RARE)}]) AS label) EXCEPT SELECT task, label FROM rows_")
def missing_rare(spark, sf_dir):
    return sampling.missing_rare(_rows(spark, sf_dir).select("task", "label").distinct())


@_register(f"WITH {_PRIORITY}, s AS (SELECT task, origin_id FROM marked WHERE priority INTERSECT SELECT task, origin_id FROM origins WHERE chunk_count > 1) SELECT task, count(*) AS n FROM s GROUP BY 1")
def priority_overlap(spark, sf_dir):
    marked = _priority(spark, sf_dir)
    several = marked.where("chunk_count > 1").select("task", "origin_id")
    return marked.where("priority").select("task", "origin_id").intersect(several).groupBy("task").agg(F.count("*").alias("n"))


# ---- selection --------------------------------------------------------------------
@_register(
    f"""WITH RECURSIVE {_ORIGINS}, seated AS (
  SELECT task, origin_id, chunk_count, row_number() OVER (PARTITION BY task ORDER BY md5('42:' || origin_id), origin_id) AS k, sum(chunk_count) OVER (PARTITION BY task) AS total FROM origins
), fold AS (
  SELECT task, 0::BIGINT AS k, 0::BIGINT AS taken, NULL::VARCHAR AS origin_id FROM (SELECT DISTINCT task FROM seated)
  UNION ALL SELECT f.task, f.k + 1, f.taken + CASE WHEN f.taken + s.chunk_count <= 400 THEN s.chunk_count ELSE 0 END, CASE WHEN f.taken + s.chunk_count <= 400 THEN s.origin_id END FROM fold f JOIN seated s ON s.task = f.task AND s.k = f.k + 1 WHERE f.taken < 400
) SELECT task, origin_id FROM seated WHERE total <= 400 UNION ALL SELECT f.task, f.origin_id FROM fold f WHERE f.origin_id IS NOT NULL AND f.task IN (SELECT task FROM seated WHERE total > 400)"""
)
def legacy_sample(spark, sf_dir):
    return sampling.skip_greedy(_origins(spark, sf_dir), 400)


@_register(None)
def diversity_sample(spark, sf_dir):
    return sampling.diverse_origins(_rows(spark, sf_dir), 400, limits={"rare": {"chunks": 40, "origins": 15}})


@_register(f"WITH {_SPLIT}, held AS (SELECT DISTINCT task, chunk_id, label FROM rows_ JOIN (SELECT origin_id FROM split WHERE split = 'train') USING (origin_id)), total AS (SELECT task, count(DISTINCT chunk_id) AS chunks FROM held GROUP BY 1) SELECT task, label, count(*) AS held, any_value(chunks) AS chunks, count(*) / any_value(chunks) AS share FROM held JOIN total USING (task) WHERE {_HEAD} GROUP BY task, label")
def head_shares(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    train = sampling.split(routing.origin_profile(rows)).where("split = 'train'").select("origin_id")
    return sampling.head_shares(rows, rows.select("task", "origin_id").distinct().join(train, "origin_id"))


@_register(f"SELECT * FROM (VALUES (100000, 2, {int(int(100000 / 0.7) / 2)})) v(target, tasks, quota)")
def quota(spark, sf_dir):
    return spark.createDataFrame([(100000, 2, sampling.quota(100000, 2))], "target int, tasks int, quota int")


# ---- splits, modes, few-shot ------------------------------------------------------
@_register(f"WITH {_SPLIT} SELECT * FROM split")
def split_stratified(spark, sf_dir):
    return sampling.split(_origins(spark, sf_dir))


@_register(f"WITH {_SPLIT} SELECT origin_id, task, 'train' AS split FROM split")
def split_train_only(spark, sf_dir):
    return sampling.split(_origins(spark, sf_dir), train_only=True)


@_register(f"WITH {_SPLIT} SELECT o.task, coalesce(s.split, 'train') AS split, s.task <> o.task AS reused, count(*) AS n FROM origins o LEFT JOIN split s USING (origin_id) GROUP BY ALL")
def split_counts(spark, sf_dir):
    origins = _origins(spark, sf_dir)
    splits = sampling.split(origins)
    firsts = splits.select("origin_id", F.col("task").alias("first"))
    return sampling.with_split(origins, splits).join(firsts, "origin_id").groupBy("task", "split", (F.col("first") != F.col("task")).alias("reused")).agg(F.count("*").alias("n"))


@_register(f"WITH {_MODES} SELECT * FROM modes WHERE mode IS NOT NULL")
def mode_partition(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).select("task", "chunk_id").distinct()
    return sampling.mode_partition(chunks).select("task", "chunk_id", "mode")


@_register(f"WITH {_CHUNKS}, {_SPLIT[len(_ORIGINS) + 2:]} SELECT c.task, c.chunk_id, c.pair_count, m.priority FROM chunk_rows c JOIN marked m USING (task, origin_id) WHERE origin_id IN (SELECT origin_id FROM split WHERE split = 'train')")
def fewshot_pool(spark, sf_dir):
    return _train_pool(spark, sf_dir).select("task", "chunk_id", "pair_count", "priority")


def _walk(name: str, pool: str, own: str = "NULL::VARCHAR") -> str:
    """CTEs: ``pool`` (task, own, chunk_id, pair_count, late) walked in order, each chunk taken if the
    pairs stay within 12, until there are 8 -> ``name`` (task, own, k, chunk_id)."""
    return f"""{name}_seats AS (
  SELECT task, {own} AS own, chunk_id, pair_count AS n, row_number() OVER (PARTITION BY task, {own} ORDER BY late, md5('42:' || chunk_id), chunk_id) AS k FROM {pool} WHERE pair_count BETWEEN 1 AND 12
), {name}_fold AS (
  SELECT DISTINCT task, own, 0::BIGINT AS k, 0::BIGINT AS pairs, NULL::VARCHAR AS chunk_id FROM {name}_seats
  UNION ALL SELECT f.task, f.own, s.k, f.pairs + CASE WHEN f.pairs + s.n <= 12 THEN s.n ELSE 0 END, CASE WHEN f.pairs + s.n <= 12 THEN s.chunk_id END
  FROM {name}_fold f JOIN {name}_seats s ON s.task = f.task AND s.own IS NOT DISTINCT FROM f.own AND s.k = f.k + 1 WHERE f.pairs < 8
), {name} AS (SELECT task, own, k, chunk_id FROM {name}_fold WHERE chunk_id IS NOT NULL)"""


_POOL = f"""{_CHUNKS}, {_SPLIT[len(_ORIGINS) + 2:]}, pool AS (
  SELECT c.task, c.origin_id, c.chunk_id, c.pair_count, NOT m.priority AS late FROM chunk_rows c JOIN marked m USING (task, origin_id) WHERE origin_id IN (SELECT origin_id FROM split WHERE split = 'train')
)"""
_SHOWN = """shown AS (SELECT DISTINCT p.task, p.origin_id AS own FROM pool p JOIN picked k ON k.task = p.task AND k.chunk_id = p.chunk_id),
others AS (SELECT p.*, s.own FROM pool p JOIN shown s ON s.task = p.task AND s.own <> p.origin_id)"""
_DEMOS = f"{_POOL}, {_walk('picked', 'pool')}, {_SHOWN}, {_walk('again', 'others', 'own')}"


@_register(f"WITH RECURSIVE {_POOL}, {_walk('picked', 'pool')} SELECT task, CAST(row_number() OVER (PARTITION BY task ORDER BY k) - 1 AS INT) AS place, chunk_id FROM picked")
def fewshot_pick(spark, sf_dir):
    return sampling.pick_examples(_train_pool(spark, sf_dir))


@_register(
    f"""WITH RECURSIVE {_DEMOS}, common AS (SELECT task, string_agg(chunk_id, ',' ORDER BY chunk_id) AS examples FROM picked GROUP BY task),
alternate AS (SELECT task, own, string_agg(chunk_id, ',' ORDER BY chunk_id) AS examples FROM again GROUP BY task, own)
SELECT p.task, p.chunk_id, coalesce(a.examples, c.examples) AS examples FROM pool p JOIN common c USING (task) LEFT JOIN alternate a ON a.task = p.task AND a.own = p.origin_id"""
)
def self_demo_guard(spark, sf_dir):
    """The examples of each row: the common ones, or for an origin among them a pick without it."""
    pool = _train_pool(spark, sf_dir)
    picked = sampling.pick_examples(pool).join(pool.select("task", "chunk_id", "origin_id"), ["task", "chunk_id"])
    shown = F.array_join(F.array_sort(F.collect_list("chunk_id")), ",")
    common = picked.groupBy("task").agg(shown.alias("common"))
    # At most max_pairs origins a task are shown, so the pool is read once for each of few.
    shown_origins = F.broadcast(picked.select("task", F.col("origin_id").alias("own")).distinct())
    others = pool.join(shown_origins, "task").where("origin_id <> own").withColumn("task", F.concat_ws("|", "task", "own"))
    redrawn = sampling.pick_examples(others).groupBy("task").agg(shown.alias("alternate")).select(F.substring_index("task", "|", 1).alias("task"), F.substring_index("task", "|", -1).alias("origin_id"), "alternate")
    rows = pool.select("task", "origin_id", "chunk_id").join(F.broadcast(common), "task").join(F.broadcast(redrawn), ["task", "origin_id"], "left")
    return rows.select("task", "chunk_id", F.coalesce("alternate", "common").alias("examples"))


_GOLD = f"""{_POOL}, gold AS (SELECT task, origin_id, 'g' || chunk_id AS chunk_id, pair_count, late FROM pool WHERE starts_with(md5('1:' || origin_id), '0')),
{_walk('primary_', 'gold')}, have AS (
  SELECT p.task, any_value(p.used) AS used, list(DISTINCT r.label) AS labels FROM (SELECT k.task, k.chunk_id, sum(g.pair_count) OVER (PARTITION BY k.task) AS used FROM primary_ k JOIN gold g ON g.task = k.task AND g.chunk_id = k.chunk_id) p
  JOIN rows_ r ON r.task = p.task AND 'g' || r.chunk_id = p.chunk_id GROUP BY p.task
), lacking AS (
  SELECT p.task, p.chunk_id, p.pair_count, p.late, coalesce(h.used, 0) AS used FROM pool p LEFT JOIN have h USING (task)
  WHERE EXISTS (SELECT 1 FROM rows_ r WHERE r.task = p.task AND r.chunk_id = p.chunk_id AND r.label IN ({_quoted(dims.RARE)}) AND NOT coalesce(list_contains(h.labels, r.label), false))
), first_ AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY late, md5('42:' || chunk_id), chunk_id) AS r FROM lacking)"""


@_register(
    f"""WITH RECURSIVE {_GOLD} SELECT task, chunk_id, CAST(row_number() OVER (PARTITION BY task ORDER BY k) - 1 AS INT) AS place, 'gold' AS origin FROM primary_
UNION ALL SELECT task, chunk_id, 12, 'main' FROM first_ WHERE r = 1 AND pair_count + used <= 12"""
)
def gold_first(spark, sf_dir):
    """Examples from a sixteenth of the origins, then one with a rare label that they lack."""
    main = _train_pool(spark, sf_dir)
    gold = main.where(F.md5(F.concat(F.lit("1:"), "origin_id").cast("binary")).startswith("0")).withColumn("chunk_id", F.concat(F.lit("g"), "chunk_id"))
    return sampling.gold_first(gold, main)


@_register(
    f"""WITH RECURSIVE {_CHUNKED}, origins AS (SELECT task, origin_id, count(DISTINCT chunk_id) AS chunk_count FROM chunked GROUP BY ALL), seated AS (
  SELECT task, origin_id, chunk_count, row_number() OVER (PARTITION BY task ORDER BY md5('42:' || origin_id), origin_id) AS k FROM origins
), fold AS (
  SELECT task, 0::BIGINT AS k, 0::BIGINT AS taken, NULL::VARCHAR AS origin_id FROM (SELECT DISTINCT task FROM seated)
  UNION ALL SELECT f.task, f.k + 1, f.taken + CASE WHEN f.taken + s.chunk_count <= 300 THEN s.chunk_count ELSE 0 END, CASE WHEN f.taken + s.chunk_count <= 300 THEN s.origin_id END FROM fold f JOIN seated s ON s.task = f.task AND s.k = f.k + 1 WHERE f.taken < 300
) SELECT c.task, c.chunk_id, count(*) AS pairs FROM chunked c JOIN fold f ON f.task = c.task AND f.origin_id = c.origin_id GROUP BY ALL"""
)
def selected_chunks(spark, sf_dir):
    chunks = files.kept(_chunks(spark, sf_dir).select("task", "origin_id", "chunk_id"))
    origins = chunks.groupBy("task", "origin_id").agg(F.size(F.collect_set("chunk_id")).alias("chunk_count"))
    return chunks.join(sampling.skip_greedy(origins, 300), ["task", "origin_id"], "left_semi").groupBy("task", "chunk_id").agg(F.count("*").alias("pairs"))


@_register(
    f"""WITH {_SUPPORT}, g AS (SELECT task, group_pair, count(*) AS support FROM origin_groups GROUP BY ALL), chosen AS (SELECT * FROM origins WHERE starts_with(md5('42:' || origin_id), '00')),
floors AS (SELECT task, 'relation' AS kind, label AS name, CAST(greatest(20, least(100, floor(0.25::DOUBLE * exposure))) AS INT) AS floor FROM support WHERE exposure >= 20 AND NOT {_HEAD}
  UNION ALL SELECT task, 'group', group_pair, CAST(greatest(10, least(60, floor(0.15::DOUBLE * support))) AS INT) FROM g WHERE support >= 10),
held AS (SELECT l.task, 'relation' AS kind, l.label AS name, c.chunk_count FROM origin_labels l JOIN chosen c USING (task, origin_id) UNION ALL SELECT o.task, 'group', o.group_pair, c.chunk_count FROM origin_groups o JOIN chosen c USING (task, origin_id)),
taken AS (SELECT task, kind, name, CAST(sum(chunk_count) AS BIGINT) AS taken FROM held GROUP BY ALL)
SELECT f.task, f.kind, f.name, f.floor, coalesce(t.taken, 0) AS taken FROM floors f LEFT JOIN taken t USING (task, kind, name) WHERE coalesce(t.taken, 0) < f.floor"""
)
def unmet_floors(spark, sf_dir):
    rows = files.kept(_rows(spark, sf_dir))
    chosen = rows.select("task", "origin_id").distinct().where(F.md5(F.concat(F.lit("42:"), "origin_id").cast("binary")).startswith("00"))
    return sampling.unmet_floors(rows, chosen)


@_register("WITH m AS (SELECT count(*) AS n FROM documents), g AS (SELECT doc_id, row_number() OVER (ORDER BY md5('3407:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS place, count(*) OVER () AS k FROM labels WHERE quality = 1), w AS (SELECT *, CAST(greatest(k, round_even(n * 0.1::DOUBLE / 0.9::DOUBLE, 0)) AS BIGINT) AS want FROM g, m) SELECT 'main' AS origin, 1 AS copies, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'gold', CAST(want // k + CASE WHEN place < want % k THEN 1 ELSE 0 END AS INT), count(*) FROM w GROUP BY 2")
def interleave_gold(spark, sf_dir):
    main = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_key"))
    gold = _read(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("row_key"))
    mixed = sampling.interleave(main, gold)
    return mixed.groupBy("origin", "row_key").agg(F.count("*").cast("int").alias("copies")).groupBy("origin", "copies").agg(F.count("*").alias("n"))


# ---- rendering --------------------------------------------------------------------
@_register(
    """WITH t AS (SELECT conv_id, turn, role, trim(coalesce(text, ''), E' \\n\\t\\r') AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations)
SELECT conv_id, '<bos>' || string_agg('<|turn>' || CASE WHEN role = 'assistant' THEN 'model' ELSE role END || chr(10) || c || '<turn|>' || chr(10), '' ORDER BY turn) AS transcript FROM t GROUP BY 1"""
)
def chat_render(spark, sf_dir):
    return render.chats(_read(spark, sf_dir, "conversations"))


@_register("SELECT conv_id, turn, trim(coalesce(text, ''), E' \\n\\t\\r') AS reply FROM conversations")
def strip_thinking(spark, sf_dir):
    thought = F.concat(F.lit("<|channel>thought\nhm<channel|>"), F.coalesce("text", F.lit("")), F.lit("<|channel>more"))
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_thinking(thought).alias("reply"))


@_register("SELECT conv_id, turn, trim(text, E' \\n\\t\\r') AS reply FROM conversations")
def think_cleanup(spark, sf_dir):
    noisy = F.concat(F.lit("<think>a\nb</think>"), "text", F.lit("<|think|>x<|/think|> "))
    return _read(spark, sf_dir, "conversations").select("conv_id", "turn", text.without_think_tags(noisy).alias("reply"))


@_register("SELECT doc_id, CASE WHEN strpos(text, ' the ') > 0 THEN substr(text, 1, strpos(text, ' the ') + 4) ELSE text END AS prompt, CASE WHEN strpos(text, ' the ') > 0 THEN substr(text, strpos(text, ' the ') + 5) ELSE '' END AS answer FROM documents")
def prompt_answer_split(spark, sf_dir):
    prompt, answer = text.answer_at(F.col("text"), " the ")
    return _read(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"), answer.alias("answer"))


@_register("SELECT doc_id, trim(text, E' \\n\\t\\r') AS text FROM documents")
def stop_tokens(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", text.without_stop_tokens(F.concat("text", F.lit("<turn|><|im_end|>\n")), ("<turn|>",)).alias("text"))


@_register("SELECT p_partkey, CASE WHEN lower(p_name) LIKE '%a%' THEN 'gemma4' WHEN lower(p_name) LIKE '%e%' THEN 'gemma3' ELSE 'qwen' END AS format FROM part")
def model_format(spark, sf_dir):
    path = F.when(F.lower("p_name").contains("a"), "x/Gemma-4").when(F.lower("p_name").contains("e"), "Gemma-3").otherwise("other")
    return _read(spark, sf_dir, "part").select("p_partkey", text.model_format(path).alias("format"))


_ENTRY = """'{{' || chr(10) || '{i}  "pair_id": "[' || pair_id || ']",' || chr(10) || '{i}  "subject": "' || subj || '",' || chr(10) || '{i}  "' || key || '": ' || {v} || ',' || chr(10) || '{i}  "object": "' || object || '"' || chr(10) || '{i}}}'"""


def _io(text: str) -> str:
    """CTE io (task, origin_id, chunk_id, input, output) of ``chunked``; ``text``: SQL of a chunk's text."""
    return f"""io_pairs AS (
  SELECT task, origin_id, chunk_id, pos, pair_id, object, {text} AS body, CASE WHEN task = 'ner_bee' THEN 'is_relational' ELSE 'relation' END AS key, regexp_replace(subject, '(\\[[^\\]]+\\])\\s*(.*?)\\s*(\\[/[^\\]]+\\])', '\\1\\2\\3', 'g') AS subj,
    CASE WHEN task = 'ner_bee' THEN CASE WHEN {_NEGATIVE} THEN 'false' ELSE 'true' END ELSE {_F1} END AS label FROM chunked
), io AS (SELECT task, origin_id, chunk_id, '{{' || chr(10) || '  "text": ' || to_json(any_value(body)) || ',' || chr(10) || '  "candidate_pairs": [' || chr(10) || string_agg('    ' || {_ENTRY.format(i="    ", v="'null'")}, ',' || chr(10) ORDER BY pos) || chr(10) || '  ]' || chr(10) || '}}' AS input,
  '[' || chr(10) || string_agg('  ' || {_ENTRY.format(i="  ", v="'" + chr(34) + "' || label || '" + chr(34) + "'")}, ',' || chr(10) ORDER BY pos) || chr(10) || ']' AS output
FROM io_pairs GROUP BY task, origin_id, chunk_id)"""


@_register(f"""WITH {_CHUNKED}, {_io("chr(9) || '\"' || origin_id || '\" é' || chr(10) || '\\ [A1]/'")} SELECT task, chunk_id, input, output FROM io""")
def io_json(spark, sf_dir):
    """Texts with quotes, a tab, a line end, a backslash and letters beyond ASCII."""
    body = F.concat(F.lit('\t"'), "origin_id", F.lit('" é\n\\ [A1]/'))
    return render.io_json(_chunks(spark, sf_dir).withColumn("text", body)).select("task", "chunk_id", "input", "output")


@_register("SELECT c_custkey, concat_ws(chr(10) || chr(10), CASE WHEN c_custkey % 2 = 0 THEN '### Description:' || chr(10) || c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN '### Few-shot Examples:' || chr(10) || '### Example 1' || chr(10) || c_name || chr(10) || '### Example 1 Response' || chr(10) || 'x' || chr(10) || repeat('-', 30) END, '### Output Format:' || chr(10) || 'JSON', '### Input:' || chr(10) || c_name) AS prompt, '### Response:' || chr(10) || c_mktsegment AS answer FROM customer")
def prompt_sections(spark, sf_dir):
    example = render.fewshot_block(F.array(F.struct(F.col("c_name").alias("input"), F.lit("x").alias("output"))))
    prompt = render.prompt(F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")), F.when(F.col("c_custkey") % 3 == 0, example), F.lit("JSON"), F.col("c_name"))
    return _read(spark, sf_dir, "customer").select("c_custkey", prompt.alias("prompt"), render.answer(F.col("c_mktsegment")).alias("answer"))


@_register("SELECT doc_id, CAST((length(text) - length(replace(text, 'the', ''))) / 3 AS INT) AS n, regexp_matches(text, 'idiot|scum') AS flagged FROM documents")
def substring_counts(spark, sf_dir):
    return _read(spark, sf_dir, "documents").select("doc_id", text.occurrences(F.col("text"), "the").alias("n"), F.col("text").rlike("idiot|scum").alias("flagged"))


# ---- answers ----------------------------------------------------------------------
def _answers(spark, sf_dir):
    """Answers made from classified pairs: fenced JSON, or broken by a missing comma."""
    rows = _classified(spark, sf_dir).select("task", "origin_id", "pair_id", F.regexp_replace("object", r"\[[^\]]*\]", "").alias("object"), "relation")
    key = F.when(F.col("task") == "ner_bee", "is_relational").otherwise("relation")
    value = labels.binary_label(F.col("task"), F.col("relation"))
    broken = F.length("origin_id") % 2 == 0
    item = F.concat(F.lit('{"pair_id": "['), "pair_id", F.lit(']"'), F.when(broken, F.lit(" ")).otherwise(F.lit(", ")), F.lit('"subject": "Item (x)", "object": "'), "object", F.lit('", "'), key, F.lit('": "'), value, F.lit('"}'))
    made = F.concat(F.lit("### Response:\n```json\n["), item, F.lit("]\n```"))
    return rows.select("origin_id", labels.task_name(F.col("task")).alias("task"), "pair_id", made.alias("prediction")).withColumn("row_id", F.xxhash64("origin_id", "pair_id"))


_TUPLES = f"""{_CLASSIFIED}, tuples AS (
  SELECT origin_id, CASE task WHEN 'ner_bee' THEN 'NER-BEE' ELSE 'NER-NER' END AS task, '[' || pair_id || ']' AS pair_id, CASE WHEN task = 'ner_bee' THEN 'item' ELSE 'item (x)' END AS subject,
    lower(regexp_replace(object, '\\[[^\\]]*\\]', '', 'g')) AS object,
    CASE WHEN task = 'ner_bee' THEN CASE WHEN relation = 'NO_RELATION' THEN 'false' ELSE 'true' END WHEN relation = '' AND length(origin_id) % 2 = 0 THEN 'true' ELSE trim(lower(relation)) END AS relation FROM classified)"""


@_register(f"WITH {_TUPLES} SELECT * FROM tuples")
def parse_tuples(spark, sf_dir):
    return answers.parse(_answers(spark, sf_dir)).select("origin_id", "task", F.explode("tuples").alias("t")).select("origin_id", "task", "t.*")


@_register("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'COMBINE_ALL' WHEN c_custkey % 5 = 1 THEN 'NER-BEE' WHEN c_custkey % 5 = 2 THEN 'NER-NER' WHEN c_custkey % 5 = 3 THEN 'NER-BEE_TRUE_ONLY' ELSE 'BEE-BEE' END AS task FROM customer")
def detect_task(spark, sf_dir):
    k = F.col("c_custkey") % 5
    prompt = F.when(k == 0, "").when(k == 1, "give is_relational please").when(k == 2, "classify the entity pair into one of the relations in the <NER-NER Relation List>").when(k == 3, "my own\nsignature").otherwise("the bee-bee task")
    return _read(spark, sf_dir, "customer").select("c_custkey", text.detect_task(prompt, (("NER-BEE_TRUE_ONLY", "myownsignature"),)).alias("task"))


@_register(f"""WITH {_TUPLES}, meta AS (SELECT origin_id, '[' || pair_id || ']' AS pair_id, subj_source, subj_group, obj_source, obj_group FROM pairs WHERE has_meta AND NOT (coalesce(upper(subj_source), '') = 'BEE' AND coalesce(upper(obj_source), '') = 'BEE'))
SELECT t.task, t.origin_id, t.pair_id, t.relation, subj_group, obj_group FROM tuples t JOIN meta USING (origin_id, pair_id)""")
def merge_predictions(spark, sf_dir):
    parsed = answers.parse(answers.without_unsupported(_answers(spark, sf_dir)))
    merged = answers.merge(parsed, answers.metadata_rows(carriers.pairs(spark, sf_dir)))
    return merged.select("task", "origin_id", "pair_id", "relation", "subj_group", "obj_group")


@_register(f"""WITH {_TUPLES}, meta AS (SELECT origin_id, '[' || pair_id || ']' AS pair_id FROM pairs WHERE has_meta AND NOT (coalesce(upper(subj_source), '') = 'BEE' AND coalesce(upper(obj_source), '') = 'BEE'))
SELECT count(*) AS tuples, count(m.pair_id) AS hits, count(m.pair_id) / count(*) AS rate FROM tuples t LEFT JOIN meta m ON m.origin_id = t.origin_id AND m.pair_id = t.pair_id""")
def metadata_hit_rate(spark, sf_dir):
    return answers.hit_rate(answers.parse(_answers(spark, sf_dir)), answers.metadata_rows(carriers.pairs(spark, sf_dir)), None)


@_register("SELECT o_orderkey AS row_id, o_orderstatus, o_orderpriority FROM orders")
def row_count_guard(spark, sf_dir):
    orders = _read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "row_id")
    return answers.zip_by_row(orders.select("row_id", "o_orderstatus"), orders.select("row_id", "o_orderpriority"))


@_register(f"""WITH {_TUPLES}, p AS (SELECT DISTINCT * FROM tuples WHERE hash(origin_id) IS NOT NULL AND length(pair_id) < 5 AND pair_id <> '[E1]'), g AS (SELECT DISTINCT * FROM tuples WHERE pair_id <> '[E2]')
SELECT task, count(*) FILTER (a) AS predicted, count(*) FILTER (b) AS gold, count(*) FILTER (a AND b) AS hits, count(*) FILTER (a AND b) / count(*) FILTER (a) AS precision, count(*) FILTER (a AND b) / count(*) FILTER (b) AS recall
FROM (SELECT coalesce(p.task, g.task) AS task, p.task IS NOT NULL AS a, g.task IS NOT NULL AS b FROM p FULL JOIN g ON p.origin_id = g.origin_id AND p.pair_id = g.pair_id AND p.task = g.task AND p.subject = g.subject AND p.object = g.object AND p.relation = g.relation) GROUP BY 1""")
def tuple_f1(spark, sf_dir):
    rows = answers.parse(_answers(spark, sf_dir)).select(F.col("origin_id").alias("row_id"), "task", F.explode("tuples").alias("t")).select("row_id", "task", "t.*")
    found = answers.tuple_scores(rows.where("length(pair_id) < 5 and pair_id <> '[E1]'"), rows.where("pair_id <> '[E2]'"))
    return found.select("task", "predicted", "gold", "hits", "precision", "recall")


# ---- pipelines --------------------------------------------------------------------
@_register(f"WITH {_SPLIT} SELECT c.task, coalesce(s.split, 'train') AS split, count(DISTINCT c.origin_id) AS origins, count(*) AS pairs, count(*) FILTER (c.relation = 'NO_RELATION') AS negatives FROM chunked c LEFT JOIN split s USING (origin_id) GROUP BY ALL")
def split_label_summary(spark, sf_dir):
    chunks = _chunks(spark, sf_dir)
    splits = sampling.split(chunks.select("task", "origin_id").distinct())
    return sampling.with_split(chunks, splits).groupBy("task", "split").agg(F.countDistinct("origin_id").alias("origins"), F.count("*").alias("pairs"), F.count_if(F.col("relation") == dims.NEGATIVE).alias("negatives"))


@_register(f"WITH {_MODES}, {_SPLIT[len(_ORIGINS) + 2:]} SELECT m.task, m.mode, coalesce(s.split, 'train') AS split, count(*) AS rows_out FROM modes m JOIN chunk_rows c ON c.task = m.task AND c.chunk_id = m.chunk_id LEFT JOIN split s ON s.origin_id = c.origin_id WHERE m.mode IS NOT NULL GROUP BY ALL")
def train_pipeline_stats(spark, sf_dir):
    chunks = _chunks(spark, sf_dir).select("task", "origin_id", "chunk_id").distinct()
    splits = sampling.split(chunks.select("task", "origin_id").distinct())
    return sampling.with_split(sampling.mode_partition(chunks), splits).groupBy("task", "mode", "split").agg(F.count("*").alias("rows_out"))


# ---- composed runs over nested documents -------------------------------------------
_TEMPLATES = {t: runs.Template(f"Judge {t}.", f"Find the relations of {t}.", "Find them.", "A JSON list", "Think, then a JSON list") for t in ("ner_ner", "ner_bee")}


def _whole(sql: str) -> str:
    """Chunks that are whole documents, and the rarity that the runs assume."""
    cut = "CASE WHEN n > 2 THEN origin_id || '_chunk_' || CAST(place // 2 AS VARCHAR) ELSE origin_id END AS chunk_id"
    few = f"exposure < {_FEW['chunks']} OR support < {_FEW['origins']}"
    return sql.replace(cut, "origin_id AS chunk_id").replace(few, "exposure < 100 OR support < 30")


_TEXTS = "texts AS (SELECT origin_id, string_agg(subject || ' in ' || object, '. ' ORDER BY pos) AS document FROM pairs GROUP BY 1)"
_WHOLE_IO = _io("(SELECT document FROM texts WHERE texts.origin_id = chunked.origin_id)")
_SECTIONS = "'### Output Format:' || chr(10) || 'A JSON list' || chr(10) || chr(10) || '### Input:' || chr(10) || io.input"
_BOS = "'<bos><|turn>system' || chr(10) || '### System Prompt:' || chr(10) || 'Judge ' || io.task || '.<turn|>' || chr(10) || '<|turn>user' || chr(10)"
_MODEL_TURN = "'<turn|>' || chr(10) || '<|turn>model' || chr(10)"
_BLOCK = "string_agg('### Example ' || place || chr(10) || input || chr(10) || '### Example ' || place || ' Response' || chr(10) || output || chr(10) || repeat('-', 30), chr(10) ORDER BY place)"


@_register(
    f"""WITH {_CLASSIFIED} SELECT task, 'n_' || origin_id AS origin_id, pos, pair_id, relation, CASE WHEN has_meta THEN subj_group END AS subj_group, CASE WHEN has_meta THEN object END AS obj_word FROM classified"""
)
def nested_routing(spark, sf_dir):
    docs = files.with_ids(carriers.documents(spark, sf_dir), prefix="n_")
    return routing.classify(routing.explode_documents(docs)).select("task", "origin_id", "pos", "pair_id", "relation", "subj_group", "obj_word")


@_register(
    f"""WITH {_whole(_CHUNKED)}, {_TEXTS}, {_WHOLE_IO}
SELECT row_number() OVER (ORDER BY md5('42:' || chunk_id), chunk_id) - 1 AS row_id, io.task, 'no_fewshot' AS mode, origin_id, chunk_id,
  md5({_BOS} || '### Description:' || chr(10) || 'Find the relations of ner_bee.' || chr(10) || chr(10) || {_SECTIONS} || {_MODEL_TURN}) AS prompt, md5('### Response:' || chr(10) || output) AS ground_truth
FROM io WHERE io.task = 'ner_bee'"""
)
def evaluation_rows(spark, sf_dir):
    rows = runs.evaluation(carriers.documents(spark, sf_dir), runs.Settings(_TEMPLATES), "ner_bee", "no_fewshot")
    return rows.select("row_id", "task", "mode", "origin_id", "chunk_id", F.md5("prompt").alias("prompt"), F.md5("ground_truth").alias("ground_truth"))


@_register(
    f"""WITH RECURSIVE {_whole(_DEMOS)}, {_MODES[len(_CHUNKS) + 2:]}, {_TEXTS}, {_WHOLE_IO}, placed_ AS (
  SELECT task, NULL::VARCHAR AS own, chunk_id, row_number() OVER (PARTITION BY task ORDER BY k) AS place FROM picked
  UNION ALL SELECT task, own, chunk_id, row_number() OVER (PARTITION BY task, own ORDER BY k) FROM again
), blocks AS (SELECT p.task, p.own, {_BLOCK} AS block FROM placed_ p JOIN io ON io.task = p.task AND io.chunk_id = p.chunk_id GROUP BY ALL)
SELECT io.task, io.origin_id, io.chunk_id, m.mode, coalesce(s.split, 'train') AS split, md5({_BOS}
  || CASE m.mode WHEN 'full_summary' THEN '### Description:' || chr(10) || 'Find them.' || chr(10) || chr(10) WHEN 'system_only' THEN '' ELSE '### Description:' || chr(10) || 'Find the relations of ' || io.task || '.' || chr(10) || chr(10) END
  || CASE WHEN m.mode IN ('full_detailed', 'full_summary') THEN '### Few-shot Examples:' || chr(10) || coalesce(own.block, common.block) || chr(10) || chr(10) ELSE '' END
  || {_SECTIONS} || {_MODEL_TURN} || '### Response:' || chr(10) || io.output || '<turn|>' || chr(10)) AS text
FROM io JOIN modes m ON m.task = io.task AND m.chunk_id = io.chunk_id LEFT JOIN split s ON s.origin_id = io.origin_id
LEFT JOIN blocks common ON common.task = io.task AND common.own IS NULL LEFT JOIN blocks own ON own.task = io.task AND own.own = io.origin_id WHERE m.mode IS NOT NULL"""
)
def training_rows(spark, sf_dir):
    rows = runs.training(carriers.documents(spark, sf_dir), runs.Settings(_TEMPLATES, target_train=None))
    return rows.select("task", "origin_id", "chunk_id", "mode", "split", F.md5("text").alias("text"))


def _document_answers(spark, sf_dir):
    """One answer per document and task that lists all its pairs; half of them broken by missing commas."""
    rows = _classified(spark, sf_dir)
    broken = F.length("origin_id") % 2 == 0
    key = F.when(F.col("task") == "ner_bee", "is_relational").otherwise("relation")
    item = F.concat(F.lit('{"pair_id": "'), "pair_id", F.lit('"'), F.when(broken, F.lit(" ")).otherwise(F.lit(", ")), F.lit('"subject": {"word": "W"}, "object": "o", "'), key, F.lit('": "'), labels.binary_label(F.col("task"), F.col("relation")), F.lit('"}'))
    plain = F.replace(item, F.lit('{"word": "W"}'), F.lit('"W"'))
    listed = rows.select("task", "origin_id", "pos", "pair_id", F.when(broken, plain).otherwise(item).alias("item"))
    packed = listed.groupBy("task", "origin_id").agg(F.array_sort(F.collect_list(F.struct("pos", "item"))).alias("p"))
    made = packed.select("origin_id", labels.task_name(F.col("task")).alias("task"), F.concat(F.lit("```json\n["), F.array_join(F.col("p.item"), ", "), F.lit("]```")).alias("prediction"))
    return made.withColumn("row_id", F.xxhash64("task", "origin_id"))


@_register(
    f"""WITH {_CLASSIFIED}, meta AS (SELECT origin_id, '[' || pair_id || ']' AS pair_id, subj_source, subj_group, subject, obj_source, obj_group, object FROM pairs WHERE has_meta AND NOT (coalesce(upper(subj_source), '') = 'BEE' AND coalesce(upper(obj_source), '') = 'BEE')),
told AS (SELECT c.origin_id, CASE c.task WHEN 'ner_bee' THEN 'NER-BEE' ELSE 'NER-NER' END AS expected_task, '[' || c.pair_id || ']' AS pair_id,
  CASE WHEN task = 'ner_bee' THEN CASE WHEN relation = 'NO_RELATION' THEN 'false' ELSE 'true' END WHEN relation = '' AND length(origin_id) % 2 = 0 THEN 'true' ELSE trim(lower(relation)) END AS relation FROM classified c)
SELECT t.origin_id, t.expected_task, coalesce(string_agg(concat_ws('|', m.pair_id, m.subj_source, m.subj_group, m.subject, m.obj_source, m.obj_group, m.object, t.relation), ';' ORDER BY t.pair_id) FILTER (m.pair_id IS NOT NULL), '') AS pred_tuples
FROM told t LEFT JOIN meta m ON m.origin_id = t.origin_id AND m.pair_id = t.pair_id GROUP BY ALL"""
)
def merged_records(spark, sf_dir):
    parsed = answers.parse(_document_answers(spark, sf_dir)).withColumn("tuples", F.transform("tuples", lambda t: t.withField("pair_id", F.concat(F.lit("["), t["pair_id"], F.lit("]"))))).drop("prediction")
    known = answers.metadata_rows(routing.explode_documents(files.with_ids(carriers.documents(spark, sf_dir))))
    records = answers.merged_records(files.kept(parsed), files.kept(known))

    def line(t):
        return F.concat_ws("|", t["pair_id"], *[t[s][f] for s in ("subject", "object") for f in ("source_type", "entity_group", "word")], t["relation"])

    return records.select("origin_id", F.col("task").alias("expected_task"), F.array_join(F.transform("pred_tuples", line), ";").alias("pred_tuples"))


@_register(
    """WITH t AS (SELECT conv_id, turn, role, length(trim(coalesce(text, ''), E' \\n\\t\\r')) + length('<turn|>') + 1 AS n, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM conversations),
spans AS (SELECT conv_id, role, n, sum(CASE WHEN role = 'assistant' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS seen FROM t)
SELECT conv_id, count(*) FILTER (role = 'assistant') AS spans, CAST(coalesce(sum(n) FILTER (role = 'assistant'), 0) AS BIGINT) AS learned FROM spans GROUP BY 1"""
)
def response_spans(spark, sf_dir):
    shown = render.chats(_read(spark, sf_dir, "conversations")).select("conv_id", text.response_spans(F.col("transcript")).alias("spans"))
    learned = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return shown.select("conv_id", F.size("spans").cast("long").alias("spans"), learned.alias("learned"))


@_register(f"WITH {_CHUNKED} SELECT task, chunk_id, bool_or(relation IN ({_quoted(dims.RARE)})) AS rare FROM chunked WHERE task = 'ner_ner' GROUP BY ALL")
def rare_in_output(spark, sf_dir):
    """Chunks whose answer names a rare relation, in quotes."""
    made = render.io_json(_chunks(spark, sf_dir).where("task = 'ner_ner'").withColumn("text", F.lit("")))
    return made.select("task", "chunk_id", text.names_any(F.col("output"), dims.RARE).alias("rare"))
