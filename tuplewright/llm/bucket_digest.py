"""Quartile bucket digests of byte triplets, and their bounded difference.

Every window of four bytes gives three triplets (bytes 1-2-3, 1-2-4, 1-3-4),
each hashed into one of 256 buckets.  The digest writes two bits per bucket
(how many quartiles of all bucket counts it exceeds) after one byte for the
length on a logarithmic scale.  The difference of two digests is the sum over
buckets of 0, 1, 2 or, for opposite ends, 6, plus a bounded length term; the
likeness is 1 - difference / greatest difference, so 0 to 1, and 1 for equal
texts.  A text of fewer than four bytes has all counts 0 and differs by length.

Neighbours: rows are range-partitioned and sorted by id once, each task streams
over its rows, and only the first and last row of a task are matched across
tasks.  A null text counts as empty; null ids sort first; rows of one id are
ordered by text, so repeated rows are each other's neighbours; a single row is
its own next; other columns are ignored; no rows give no rows.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, durable, pick, schema, shuffle_partitions, small_batches, text_or_empty

BUCKETS = 256
#: Bytes hashed at once.
SLAB = 1 << 20
LENGTH_STEPS = 24
_COST = np.array([0, 1, 2, 6])
_MOST = BUCKETS * 6 + LENGTH_STEPS


def digest(text: str) -> bytes:
    """One length byte and 64 bytes of quartile codes."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(data) - 3), SLAB):
        b = data[at : at + SLAB + 3].astype(np.uint32)
        head = b[:-3] * np.uint32(0x9E3779B1)
        second, third, fourth = b[1:-2], b[2:-1], b[3:]
        for salt, x, y in ((0x1B873593, second, third), (0x5BD1E995, second, fourth), (0x2545F491, third, fourth)):
            mixed = (head + x * np.uint32(0x85EBCA77) + y * np.uint32(0xC2B2AE3D)) ^ np.uint32(salt)
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
            counts += np.bincount((mixed >> np.uint32(24)).astype(np.uint8), minlength=BUCKETS)
    ordered = np.sort(counts)
    code = sum((counts > ordered[BUCKETS * q // 4 - 1]).astype(np.uint8) for q in (1, 2, 3)).reshape(-1, 4)
    packed = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    length = min(255, round(math.log(len(data) + 1) / math.log(1.1)))
    return bytes([length]) + packed.astype(np.uint8).tobytes()


def _codes(one: bytes) -> np.ndarray:
    packed = np.frombuffer(one, np.uint8, offset=1)
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], axis=1).astype(np.int64)


def likeness(a: bytes, b: bytes) -> float:
    if a == b:
        return 1.0
    apart = int(_COST[np.abs(_codes(a) - _codes(b))].sum()) + min(LENGTH_STEPS, abs(a[0] - b[0]))
    return 1.0 - apart / _MOST


def edit(text: str, after: str) -> str:
    """The last quarter replaced by as many first code points of ``after``, or all it has."""
    k = len(text) // 4
    return text[: len(text) - k] + after[:k]


def _row(key, text: str, own: bytes, after: str, after_digest: bytes) -> tuple:
    edited = edit(text, after)
    changed = digest(edited)
    return (key, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), changed.hex(), likeness(own, changed), likeness(own, after_digest))


def digest_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    small_batches(spark)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    id_type = base.schema["id"].dataType
    made = schema(("id", id_type), ("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double"))
    edge = schema(("task", "int"), ("first", "string"), ("last", "string"))
    out = schema(*[(f.name, f.dataType) for f in made], *[(f.name, f.dataType) for f in edge])

    def batch_of(rows, to):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to)

    def stream(batches):
        from pyspark import TaskContext

        to, task = arrow_schema(out), TaskContext.get().partitionId()
        before, first, rows = None, None, []
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                own = digest(text)
                if before is None:
                    first = text
                else:
                    rows.append((*_row(*before, text, own), None, None, None))
                before = key, text, own
            if rows:
                yield batch_of(rows, to)
                rows = []
        if before is not None:
            yield batch_of([(before[0], *[None] * 6, task, first, before[1])], to)

    def close(batches):
        to = arrow_schema(made)
        for batch in batches:
            rows = [_row(key, text, digest(text), after, digest(after)) for key, text, after in zip(*(batch.column(c).to_pylist() for c in ("id", "last", "after")))]
            if rows:
                yield batch_of(rows, to)

    ordered = base.repartitionByRange(shuffle_partitions(spark), "id").sortWithinPartitions("id", "text")
    rows = durable(ordered.mapInArrow(stream, out))
    # One row per task of the range partitioning; the window sees their numbers alone, the texts are joined.
    ends = rows.where("task is not null")
    w = Window.orderBy("task")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = ends.select("task", F.coalesce(F.lead("task").over(w), F.first("task").over(whole)).alias("next"))
    ends = ends.select("id", "last", "task").join(order, "task").join(ends.select(F.col("task").alias("next"), F.col("first").alias("after")), "next").select("id", "last", "after")
    done = rows.where("task is null").select(*made.names).unionByName(ends.mapInArrow(close, made))
    return done.withColumnRenamed("id", id_col)
