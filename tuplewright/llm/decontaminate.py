"""Benchmark decontamination by spaced-seed hashing.

Tokens are words between white space, lower-cased, without the punctuation at
their ends (a word of punctuation only stays as it is).  A mask such as ``1101..`` is laid over every
window of tokens of both sides and hashes the tokens under its ones; a changed
token under a zero leaves the hash as it was, so a window with substitutions still
meets its source under one mask or another.  Test hashes are few and training
hashes many, so the training side is first sifted by a bitmap of fixed size
(``BITS`` bits, whatever the size of the benchmark), and what passes is joined
on the full hash.  Around every hit the two token sequences are laid side by
side on the hit's diagonal and the best run is scored: +1 a token that agrees,
``-penalty`` one that differs.  A document is contaminated by an item if its
best run has at least ``min_match`` agreeing tokens, or covers
``min_share`` of a shorter item.

The three masks of five ones hit every alignment that the acceptance rule takes, of
items of ``SHORT`` and more tokens: up to the 13th agreeing token of a run there
are 3876 patterns (no prefix scores below 0), and each contains a mask; the
patterns of 12 to 15 tokens are enumerated too (see the tests).  Shorter items of
s allowed substitutions are cut into s + 2 pieces, of which any two are a mask at
their place.  Limits looser than the defaults use runs of ``penalty`` tokens, with
one of which every best run begins.

Documents are read once: those in which a hash passes the bitmap are written
with their passing hashes, and only they are looked at again.  Runs of one hash
occurring many times in a document yield one hit per (document, item, diagonal).
The hits of a document are verified in order behind its text, so a worker holds one
document, one item and one diagonal, whatever their number.

Defined results: null or wordless texts on either side match nothing; null ids
match but are reported as null; repeated rows are reported once each; of equally
good alignments the shorter span counts, then that of the least diagonal; other
columns are ignored; no rows give no rows.
"""
from __future__ import annotations

import math
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, durable, pick, schema, shuffle_partitions, small_batches, text_or_empty

MASKS = ("11101001", "1110010001", "101100101")
#: From so many tokens on the masks are laid at every place of an item.
SHORT = 12
MIN_MATCH, MIN_SHARE, PENALTY = 13, 0.8, 2.0
#: 2^26 bits: 8 MB in every worker, for any benchmark.
BITS = 26
#: Distinct tokens whose hashes a worker keeps.
KEPT = 250_000
_SALT = 0x9E3779B97F4A7C15


_EDGES = b".,;:!?\"'()[]{}<>%&$#*|/\\-_+=~^`@"


def _words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def _bare(word: bytes) -> bytes:
    return word.strip(_EDGES) or word


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Token hashes, kept per distinct token; the table is emptied when it holds ``KEPT``."""

    def __init__(self):
        self.table: dict[bytes, int] = {}

    def tokens(self, text: str) -> np.ndarray:
        from xxhash import xxh64_intdigest

        words = _words(text)
        table = self.table
        if len(table) > KEPT:
            table.clear()
        for w in {*words}.difference(table):
            table[w] = xxh64_intdigest(_bare(w))
        return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def needed(n: int, min_match: int, min_share: float) -> int:
    """Agreeing tokens that contaminate by an item of ``n`` tokens."""
    return max(1, min(min_match, math.ceil(min_share * n)))


def masks_for(n: int, masks: tuple[str, ...], min_match: int, min_share: float, penalty: float) -> list[tuple[str, int | None]]:
    """The masks for items of ``n`` tokens, each with its place (None: every place)."""
    need = needed(min(n, SHORT), min_match, min_share)
    if min_match < MIN_MATCH or min_share < MIN_SHARE or penalty < PENALTY:
        return [("1" * max(1, min(math.ceil(penalty), need)), None)]
    if n >= SHORT:
        return [(m, None) for m in masks]
    spare = n - need
    if spare < 1:
        return [("1" * n, 0)]
    cuts = [n * k // (spare + 2) for k in range(spare + 3)]
    found = []
    for two in combinations(range(spare + 2), 2):
        ones = [any(cuts[k] <= p < cuts[k + 1] for k in two) for p in range(n)]
        mask = "".join("01"[o] for o in ones)
        found.append((mask.strip("0"), mask.index("1")))
    return found


def seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the mask laid at every position it fits."""
    number = crc32(mask.encode())
    n = len(tokens) - len(mask) + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n <= 0:
        return total
    factor = np.uint64((2 * number + 3) * _SALT & 0xFFFFFFFFFFFFFFFF | 1)
    for p, bit in enumerate(mask):
        if bit == "1":
            total = (total + tokens[p : p + n]) * factor
    return _mix(total + np.uint64(number))


def best_run(agree: np.ndarray, penalty: float) -> tuple[int, int, int]:
    """Start, end and agreeing tokens of the run of highest score (+1, -penalty)."""
    score = np.concatenate([[0.0], np.cumsum(np.where(agree, 1.0, -penalty))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.argmin(score[: end + 1]))
    return start, end, int(agree[start:end].sum())


def _item_seeds(items: DataFrame, rule: tuple) -> DataFrame:
    out = schema(("hash", "long"), ("item", "long"), ("at", "int"))

    def run(batches):
        to, hasher = arrow_schema(out), Hasher()
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                tokens = hasher.tokens(text or "")
                if not len(tokens):
                    continue
                found = []
                for mask, place in masks_for(len(tokens), *rule):
                    all_of = seeds(tokens, mask)
                    places = np.arange(len(all_of), dtype=np.int32) if place is None else np.array([place], np.int32)
                    found.append((all_of[places], places))
                hashes = np.concatenate([f for f, _ in found]).view(np.int64)
                at = np.concatenate([p for _, p in found])
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array([item] * len(at), pa.int64()), pa.array(at)], schema=to)

    return items.select("item", "text").mapInArrow(run, out)


def _bitmap(hashed: DataFrame) -> bytes:
    """One bit per value of the hashes' top bits; at most 2^BITS bits come to the driver."""
    # Bucket b, from 1 on, holds the values 32768 (b - 1) + 1 to 32768 b.
    value = F.shiftrightunsigned("hash", 64 - BITS) + 1
    parts = hashed.groupBy(F.bitmap_bucket_number(value).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")).collect()
    whole = bytearray(1 << BITS - 3)
    for b, bits in parts:
        whole[(b - 1) * 4096 : b * 4096] = bits
    return bytes(whole)


_HITS = T.ArrayType(T.StructType().add("hash", T.LongType()).add("at", T.IntegerType()), False)


def _sift(docs: DataFrame, masks: list[str], bitmap) -> DataFrame:
    """The documents (key, text) in which a hash passes the bitmap, with those hashes and their places."""
    out = schema(("key", docs.schema["key"].dataType), ("text", "string"), ("hits", _HITS))

    def run(batches):
        to, hasher = arrow_schema(out), Hasher()
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            kept, hashes, ats, ends = [], [], [], [0]
            for i, text in enumerate(batch.column("text").to_pylist()):
                tokens, size = hasher.tokens(text or ""), 0
                for mask in masks:
                    found = seeds(tokens, mask)
                    place = found >> np.uint64(64 - BITS)
                    hit = np.flatnonzero(bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1)
                    if len(hit):
                        hashes.append(found[hit].view(np.int64))
                        ats.append(hit.astype(np.int32))
                        size += len(hit)
                if size:
                    kept.append(i)
                    ends.append(ends[-1] + size)
            if kept:
                rows = batch.take(pa.array(kept))
                pairs = pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, ats)], ["hash", "at"])
                hits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip((rows.column("key"), rows.column("text"), hits), to)], schema=to)

    return docs.select("key", "text").mapInArrow(run, out)


def _bare_words(text: str) -> np.ndarray:
    words = np.empty(len(found := [*map(_bare, _words(text))]), object)
    words[:] = found
    return words


def _verify(min_match: int, min_share: float, penalty: float, out):
    """Rows by row, item and diagonal, nulls first: a document's text, then for each item
    its text and then its diagonals -> the overlaps."""

    def run(batches):
        to = arrow_schema(out)
        doc = test = np.empty(0, object)
        now, best = None, (0, 0, 0)
        cols: list[list] = [[] for _ in to]

        def close():
            start, end, n = best
            if now and n and n >= needed(len(test), min_match, min_share):
                for c, v in zip(cols, (*now, start, end, n, len(test))):
                    c.append(v)

        for batch in batches:
            for row, item, diagonal, text in zip(*(batch.column(c).to_pylist() for c in ("row", "item", "diagonal", "text"))):
                if item is None:
                    doc = _bare_words(text or "")
                elif diagonal is None:
                    close()
                    test, now, best = _bare_words(text or ""), (row, item), (0, 0, 0)
                else:
                    low, high = max(0, -diagonal), min(len(test), len(doc) - diagonal)
                    start, end, n = best_run((doc[low + diagonal : high + diagonal] == test[low:high]).astype(bool), penalty)
                    if (n, start - end) > (best[2], best[0] - best[1]):
                        best = (low + diagonal + start, low + diagonal + end, n)
            if len(cols[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, to)], schema=to)
                cols = [[] for _ in to]
        close()
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, to)], schema=to)

    return run


def overlaps_of(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, min_match: int = MIN_MATCH, min_share: float = MIN_SHARE, penalty: float = PENALTY) -> DataFrame:
    """``docs``: key, text; ``items``: item (unique), text ->
    key, item, start, end, n_match, n_item of every row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    rule = masks, min_match, min_share, penalty
    hashed = durable(_item_seeds(items, rule))
    words = F.size(F.filter(F.split("text", r"[ \t\n\x0B\f\r]+"), lambda w: w != ""))
    # At most `SHORT` different values.
    lengths = [r.n for r in items.select(F.least(words, F.lit(SHORT)).alias("n")).where("n > 0").distinct().collect()]
    laid = sorted({mask for n in lengths for mask, _ in masks_for(n, *rule)})
    bitmap = spark.sparkContext.broadcast(_bitmap(hashed))
    passed = durable(_sift(docs, laid, bitmap).withColumn("row", F.monotonically_increasing_id()))
    met = passed.select("row", F.inline("hits")).join(hashed.withColumnRenamed("at", "item_at"), "hash")
    hits = durable(met.select("row", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct())
    none = F.lit(None)
    texts = passed.join(hits.select("row").distinct(), "row", "left_semi").select("row", none.cast("long").alias("item"), none.cast("int").alias("diagonal"), "text")
    passages = hits.select("row", "item").distinct().join(items.select("item", "text"), "item").select("row", "item", none.cast("int").alias("diagonal"), "text")
    stream = texts.unionByName(passages).unionByName(hits.withColumn("text", none.cast("string")))
    out = schema(("row", "long"), ("item", "long"), ("start", "int"), ("end", "int"), ("n_match", "int"), ("n_item", "int"))
    dealt = stream.repartition(shuffle_partitions(spark), "row").sortWithinPartitions("row", F.asc_nulls_first("item"), F.asc_nulls_first("diagonal"))
    found = dealt.mapInArrow(_verify(min_match, min_share, penalty, out), out)
    return found.join(passed.select("row", "key"), "row").select("key", *out.names[1:])


def _named_items(benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    items = pick(benchmark, item_id=item_col, text=item_text_col).withColumn("text", text_or_empty("text"))
    return durable(items.withColumn("item", F.monotonically_increasing_id()))


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **limits) -> DataFrame:
    """``id_col``, ``item_col``, start, end (tokens of the document, end
    exclusive), n_match, n_item: one row per contaminated row and item.
    ``limits`` are those of ``overlaps_of``."""
    # `item` names rows as they were written, so equal or null ids stay apart.
    items = _named_items(benchmark, item_col, item_text_col)
    found = overlaps_of(pick(docs, key=id_col, text=text_col).withColumn("text", text_or_empty("text")), items, **limits)
    return found.join(items.select("item", "item_id"), "item").select(F.col("key").alias(id_col), F.col("item_id").alias(item_col), "start", "end", "n_match", "n_item")


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", **limits) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates.  Whether one does is a
    matter of the text alone, so texts are named by their md5."""
    text = text_or_empty(docs[f"`{text_col}`"])
    base = docs.select(F.md5(text.cast("binary")).alias("key"), text.alias("text"))
    bad = overlaps_of(base, _named_items(benchmark, item_col, item_text_col), **limits).select(F.col("key").alias("bad_digest")).distinct()
    return docs.join(bad, F.md5(text.cast("binary")) == bad["bad_digest"], "left_anti")
