"""Byte-level BPE: encoding by overlapping chunks, decoding by concatenation.

A text is cut into chunks of ``chunk_chars`` code points that overlap; each chunk
is pre-tokenised on its own, and two neighbours are stitched at the first
position in their overlap at which both start a pre-token.  A piece runs from
stitch to stitch; the pieces are encoded in parallel and their ids concatenated in
order.  A text of one chunk is one piece and is encoded where it lies,
without a shuffle.

What a pattern must promise: no look-behind, and a match looks at most one
character past the run (of white space, or of anything else) in which it ends.
Then from a shared boundary on both chunks match alike up to the last run of
the earlier one, and only boundaries up to there are used.  A piece is encoded
together with what follows it in its chunk, and the ids of what follows are
taken off again: a match at its end sees the text's own next characters.  A text
with a seam at which the chunks never agree (say one word longer than the
overlap, or code points that the engines may class differently) is encoded whole,
in one task.

Nulls: a null text counts as empty and yields no ids; a null id is kept.
Repeated rows yield one row each.  An empty table yields an empty one.  Columns
other than the two named are ignored.
"""
from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, durable, pick, schema, shuffle_partitions, small_batches, text_or_empty

@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def _ids(enc, text: str) -> np.ndarray:
    return enc.encode_to_numpy(text, disallowed_special=()).astype(np.int32)


def _id_lists(lists: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(lists) if lists else np.empty(0, np.int32)
    offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _bytes_of(names: list[bytes], ids: np.ndarray) -> bytes:
    """The bytes of the ids, some at a time: no list of all of them is made."""
    get, raw = names.__getitem__, bytearray()
    for at in range(0, len(ids), 65_536):
        raw += b"".join(map(get, ids[at : at + 65_536].tolist()))
    return bytes(raw)


@lru_cache(maxsize=4)
def _names(path: str) -> list[bytes]:
    """id -> bytes; empty where the file has no entry."""
    ranks = read_ranks(path)
    names = [b""] * (1 + max(ranks.values(), default=-1))
    for name, rank in ranks.items():
        names[rank] = name
    return names


class _Coder:
    """ids, and if asked the bytes they stand for, as the last columns of a batch."""

    def __init__(self, path: str, pattern: str, out: T.StructType):
        self.encoding, self.to = encoding(path, pattern), arrow_schema(out)
        self.names = _names(path) if "decoded" in self.to.names else None

    def batch(self, ids: pa.Array, lists: list[np.ndarray]) -> pa.RecordBatch:
        cols = [ids, _id_lists(lists)]
        if self.names is not None:
            cols.append(pa.array([_bytes_of(self.names, x) for x in lists], pa.binary()))
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, self.to)], schema=self.to)


def _encoder(path: str, pattern: str, out: T.StructType):
    """Batches of id and text -> ``out``."""

    def run(batches):
        coder = _Coder(path, pattern, out)
        for batch in batches:
            yield coder.batch(batch.column("id"), [_ids(coder.encoding, x or "") for x in batch.column("text").to_pylist()])

    return run


def _is_space(c: str) -> bool:
    return c.isspace() and not "\x1c" <= c <= "\x1f"


def _last_run(text: str) -> int:
    """Where the last run of white space, or of anything else, begins."""
    kind = _is_space(text[-1:])
    return next((i + 1 for i in range(len(text) - 1, -1, -1) if _is_space(text[i]) != kind), 0)


def _plain(text: str) -> bool:
    """No code point without a category, which engines of another Unicode version may class otherwise."""
    return text.isascii() or not any(unicodedata.category(c) == "Cn" for c in text)


def boundaries(find, text: str, last: bool, chunk: int, overlap: int) -> tuple[list[int], list[int]]:
    """Sure starts of pre-tokens of a chunk, in its first ``overlap`` code points and from
    ``chunk`` on.  ``last``: the text ends with this chunk."""
    sure = len(text) if last else _last_run(text)
    starts = [p for p in (m.start() for m in find(text)) if p <= sure and (p <= overlap or p >= chunk)]
    head, tail = text[: overlap + 2], text[max(chunk - 2, 0) :]
    return [p for p in starts if p <= overlap] if _plain(head) else [], [p for p in starts if p >= chunk] if _plain(tail) else []


def _cutter(pattern: str, chunk: int, overlap: int, out: T.StructType):
    def run(batches):
        to, find = arrow_schema(out), _compiled(pattern).finditer

        def cuts(batch):
            for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text"))):
                n = len(text)
                for k, start in enumerate(range(0, n, chunk)):
                    end = min(n, start + chunk + overlap)
                    part = text[start:end]
                    head, tail = boundaries(find, part, end == n, chunk, overlap)
                    yield row, key, k, start, part, [start + p for p in head], [start + p for p in tail]

        for batch in batches:
            held, size = [], 0
            for cut in cuts(batch):
                held.append(cut)
                size += len(cut[4])
                if size > 1_000_000:
                    yield _rows_as(held, to)
                    held, size = [], 0
            if held:
                yield _rows_as(held, to)

    return run


def _rows_as(rows: list[tuple], to: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), to)], schema=to)


def piece_ids(enc, text: str, begin: int, end: int | None) -> np.ndarray:
    """The ids of text[begin:end] as part of ``text``; both are starts of pre-tokens."""
    ids = _ids(enc, text[begin:])
    return ids if end is None else ids[: len(ids) - len(_ids(enc, text[end:]))]


def _piece_encoder(path: str, pattern: str, chunk: int, out: T.StructType):
    """ids of a piece; of a torn text the plain cut of the text instead."""

    def run(batches):
        to, enc = arrow_schema(out), encoding(path, pattern)
        for batch in batches:
            lists, texts = [], []
            for torn, start, text, a, b in zip(*(batch.column(c).to_pylist() for c in ("torn", "start", "text", "from_at", "to_at"))):
                lists.append(np.empty(0, np.int32) if torn else piece_ids(enc, text, a - start, None if b is None else b - start))
                texts.append(text[:chunk] if torn else None)
            cols = [*(batch.column(c) for c in ("row", "chunk", "id")), _id_lists(lists), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    return run


def _joiner(path: str, pattern: str, out: T.StructType):
    """Pieces of a text, in order -> the text's row."""

    def run(batches):
        coder, at, key, ids, texts = _Coder(path, pattern, out), None, None, [], []

        def whole():
            joined = _ids(coder.encoding, "".join(texts)) if texts else np.concatenate(ids)
            return coder.batch(pa.array([key], coder.to.field(0).type), [joined])

        for batch in batches:
            lists = batch.column("ids")
            for i, (row, name, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text")))):
                if row != at:
                    if at is not None:
                        yield whole()
                    at, key, ids, texts = row, name, [], []
                ids.append(lists[i].values.to_numpy())
                if text is not None:
                    texts.append(text)
        if at is not None:
            yield whole()

    return run


_IDS = T.ArrayType(T.IntegerType(), False)


def _coded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, chunk_chars: int, overlap: int, *more: tuple[str, str]) -> DataFrame:
    assert 0 < overlap <= chunk_chars
    spark = docs.sparkSession
    small_batches(spark)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    key = ("id", base.schema["id"].dataType)
    out = schema(key, ("ids", _IDS), *more)
    short = base.where(F.length("text") <= chunk_chars).mapInArrow(_encoder(ranks_path, pattern, out), out)

    # `row` names a long text; it is written with the chunks, once.
    places = T.ArrayType(T.LongType())
    cut = schema(("row", "long"), key, ("chunk", "int"), ("start", "long"), ("text", "string"), ("head", places), ("tail", places))
    long = base.where(F.length("text") > chunk_chars).select(F.monotonically_increasing_id().alias("row"), "id", "text")
    chunks = durable(long.mapInArrow(_cutter(pattern, chunk_chars, overlap, cut), cut))
    if chunks.isEmpty():
        return short.select(F.col("id").alias(id_col), *out.names[1:])
    w = Window.partitionBy("row").orderBy("chunk")
    seams = (
        chunks.select("row", "chunk", F.when(F.col("chunk") == 0, F.lit(0).cast("long")).otherwise(F.array_min(F.array_intersect(F.lag("tail").over(w), "head"))).alias("from_at"))
        .withColumn("to_at", F.lead("from_at").over(w))
        .withColumn("torn", F.max(F.col("from_at").isNull()).over(Window.partitionBy("row")))
    )
    part = schema(("row", "long"), ("chunk", "int"), key, ("ids", _IDS), ("text", "string"))
    pieces = chunks.drop("head", "tail").join(seams, ["row", "chunk"]).mapInArrow(_piece_encoder(ranks_path, pattern, chunk_chars, part), part)
    joined = pieces.repartition(shuffle_partitions(spark), "row").sortWithinPartitions("row", "chunk").mapInArrow(_joiner(ranks_path, pattern, out), out)
    return short.unionByName(joined).select(F.col("id").alias(id_col), *out.names[1:])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = 32768, overlap: int = 1024) -> DataFrame:
    """``id_col``, ``ids``: the ids the whole text has, without special tokens."""
    return _coded(docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = 32768, overlap: int = 1024) -> DataFrame:
    """``id_col``, ``ids``, ``decoded``: as ``encode`` and then ``decode``, by one worker a task."""
    return _coded(docs, ranks_path, pattern, id_col, text_col, chunk_chars, overlap, ("decoded", "binary"))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """All columns of ``encoded`` and the raw bytes its ids stand for (null ids: empty)."""
    out = T.StructType([f for f in encoded.schema.fields if f.name != out_col]).add(out_col, T.BinaryType(), True)
    names = [f.name for f in out.fields[:-1]]

    def run(batches):
        to = arrow_schema(out)
        coded = _names(ranks_path)
        for batch in batches:
            raw = pa.array([_bytes_of(coded, x.values.to_numpy()) if x.is_valid else b"" for x in batch.column(ids_col)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(n).cast(to.field(n).type) for n in names], raw.cast(to.field(out_col).type)], schema=to)

    return encoded.select(*names).mapInArrow(run, out)


def digests(round_trip: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return round_trip.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
