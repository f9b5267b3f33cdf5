"""Per-document sums over terms, joined by term without long rows.

A *block* is a run of documents inside one input partition (up to
``BLOCK_CHARS`` code points and ``BLOCK_DOCS`` documents).  For every distinct
term of a block one row holds (document number in the block, frequency) as
packed 16-bit pairs, so a term's text is shuffled once per block, not once per
document.  The rows are dealt by (term, salt): a term of many documents is
salted by block, so no task gets all rows of a frequent term.  What is found
for a term is multiplied with the frequencies, summed per document where it
lies, and only those sums are dealt on by block.

Blocks are numbered by partition and order, so a lost task makes the same ones
again.  Header rows (``head``) carry each block's document ids and what is
known of a document without a join.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, schema

BLOCK_CHARS = 16_000_000
BLOCK_DOCS = 60_000
#: A term found in this many documents of one block is salted by block.
OFTEN, SALTS = 64, 64
#: Postings summed at once.
FLUSH = 2_000_000


class Terms:
    """What ``post`` asks of an operator, in the worker."""

    def split(self, text: str) -> tuple[list, tuple]:
        """The terms of a text in order, and header values known from the text."""
        raise NotImplementedError

    def describe(self, terms: list) -> np.ndarray:
        """Per distinct term a row of numbers; the first is 1 if the term needs no join."""
        raise NotImplementedError

    def header(self, ids: np.ndarray, of: np.ndarray, docs: int, table: np.ndarray) -> list[np.ndarray]:
        """Further header columns of a block: ``ids`` are all its terms, ``of`` their documents."""
        raise NotImplementedError


class _Numbers(dict):
    def __missing__(self, term):
        self[term] = n = len(self)
        return n


def _packed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id << 16 | document) keys, repeated -> ids, where their pairs begin, 16-bit pairs."""
    keys, counts = np.unique(keys, return_counts=True)
    times = -(-counts // 65535)
    if (times > 1).any():
        last = np.cumsum(times) - 1
        full = np.full(times.sum(), 65535)
        full[last] = counts - 65535 * (times - 1)
        keys, counts = np.repeat(keys, times), full
    ids = keys >> 16
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, np.int64)
    return ids[first], np.r_[first, len(ids)], np.stack([keys & 0xFFFF, counts], axis=1).astype("<u2")


def post(docs: DataFrame, make: Callable[[], Terms], extra: T.StructType) -> DataFrame:
    """``docs`` has ``id`` and ``text``; ``extra`` names the header values, those of
    ``split`` first.

    Returns head, term, salt, block, postings; a header row has in ``postings``
    an Arrow table of id and the header values, and a term of its own.
    """
    out = schema(("head", "boolean"), ("term", "binary"), ("salt", "int"), ("block", "long"), ("postings", "binary"))
    header = arrow_schema(T.StructType([docs.schema["id"]] + extra.fields))

    def flush(block, keys, values, numbers, ids, lengths, terms, to):
        flat = np.concatenate(ids)
        of = np.repeat(np.arange(len(keys)), lengths)
        names = list(numbers)
        table = terms.describe(names)
        columns = [keys, *zip(*values), *terms.header(flat, of, len(keys), table)]
        block_table = pa.table([pa.array(c, f.type) for c, f in zip(columns, header)], schema=header)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, header) as writer:
            writer.write_table(block_table)
        yield pa.RecordBatch.from_arrays([pa.array([True]), pa.array([b"\0head\0%d" % block], pa.binary()), pa.array([block % SALTS], pa.int32()), pa.array([block], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], schema=to)
        joined = table[flat, 0] == 0
        present, begins, pairs = _packed(flat[joined] << 16 | of[joined])
        salts = np.where(np.diff(begins) >= OFTEN, block % SALTS, 0).astype(np.int32)
        for at in range(0, len(present), 50_000):
            some, cuts = present[at : at + 50_000], begins[at : at + 50_001]
            data = pairs[cuts[0] : cuts[-1]]
            postings = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(((cuts - cuts[0]) * 4).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
            names_of = [names[i] for i in some.tolist()]
            if names_of and isinstance(names_of[0], str):
                names_of = [n.encode() for n in names_of]
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(some), bool)), pa.array(names_of, pa.binary()), pa.array(salts[at : at + 50_000]), pa.array(np.full(len(some), block)), postings], schema=to)

    def run(batches):
        from pyspark import TaskContext

        to, terms = arrow_schema(out), make()
        block = TaskContext.get().partitionId() << 32
        keys, values, numbers, ids, lengths, size = [], [], _Numbers(), [], [], 0
        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found, known = terms.split(text or "")
                keys.append(key)
                values.append(known)
                ids.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
                lengths.append(len(found))
                size += len(text or "")
                if size >= BLOCK_CHARS or len(keys) >= BLOCK_DOCS:
                    yield from flush(block, keys, values, numbers, ids, lengths, terms, to)
                    block, keys, values, numbers, ids, lengths, size = block + 1, [], [], _Numbers(), [], [], 0
        if keys:
            yield from flush(block, keys, values, numbers, ids, lengths, terms, to)

    return docs.select("id", "text").mapInArrow(run, out)


def _sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of ``values`` by key, keys ascending."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(values, first, axis=0) if len(keys) else values


def add_up(rows: DataFrame, look: Callable[[], Callable]) -> DataFrame:
    """Sums per block and document of value x frequency.

    ``rows`` has head, term, block, postings and what ``look`` needs.
    ``look()`` returns in the worker a function: record batch of term rows ->
    float64 array (rows, values).

    Returns block, header (the header rows pass through), docs, sums (packed).
    """
    out = schema(("block", "long"), ("header", "binary"), ("docs", "binary"), ("sums", "binary"))

    def emit(keep, to):
        blocks = np.concatenate([k[0] for k in keep])
        docs = np.concatenate([k[1] for k in keep])
        values = np.concatenate([k[2] for k in keep])
        names, inverse = np.unique(blocks, return_inverse=True)
        keys, sums = _sums(inverse.astype(np.int64) << 16 | docs, values)
        cuts = np.searchsorted(keys >> 16, np.arange(len(names) + 1))
        cols = [[], [], [], []]
        for i, name in enumerate(names.tolist()):
            a, b = cuts[i], cuts[i + 1]
            for c, v in zip(cols, (name, None, (keys[a:b] & 0xFFFF).astype(np.uint16).tobytes(), sums[a:b].tobytes())):
                c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, to)], schema=to)

    def run(batches):
        to = arrow_schema(out)
        find = look()
        keep, held = [], 0
        for batch in batches:
            is_head = batch.column("head").to_numpy(zero_copy_only=False).astype(bool)
            for i in np.flatnonzero(is_head).tolist():
                yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), batch.column("postings").slice(i, 1).cast(pa.binary()), pa.array([None], pa.binary()), pa.array([None], pa.binary())], schema=to)
            rest = batch.filter(pa.array(~is_head))
            if not rest.num_rows:
                continue
            packed = rest.column("postings").to_pylist()
            lengths = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
            pairs = np.frombuffer(b"".join(packed), np.uint16).reshape(-1, 2)
            values = find(rest)
            of = np.repeat(np.arange(len(packed)), lengths)
            keep.append((np.asarray(rest.column("block"))[of], pairs[:, 0].astype(np.int64), values[of] * pairs[:, 1:2]))
            held += len(of)
            if held >= FLUSH:
                yield emit(keep, to)
                keep, held = [], 0
        if keep:
            yield emit(keep, to)

    return rows.mapInArrow(run, out)


def finish(sums: DataFrame, id_type: T.DataType, extra: T.StructType, value_names: list[str], partitions: int) -> DataFrame:
    """One row per document: id, the header values, the sums (0.0 if nothing was joined)."""
    head = T.StructType([T.StructField("id", id_type, True)] + extra.fields)
    out = T.StructType(head.fields + [T.StructField(n, T.DoubleType(), True) for n in value_names])
    width = len(value_names)

    def done(header, parts, to):
        table = pa.ipc.open_stream(header).read_all()
        total = np.zeros((table.num_rows, width))
        for docs, values in parts:
            total[np.frombuffer(docs, np.uint16)] += np.frombuffer(values).reshape(-1, width)
        cols = [c.combine_chunks() for c in table.columns] + [pa.array(total[:, i]) for i in range(width)]
        cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    def run(batches: Iterable[pa.RecordBatch]):
        to = arrow_schema(out)
        at, header, total = None, None, None
        for batch in batches:
            for block, head_, docs, values in zip(*(batch.column(c).to_pylist() for c in ("block", "header", "docs", "sums"))):
                if block != at:
                    if at is not None:
                        yield done(header, total, to)
                    at, header, total = block, None, []
                if head_ is not None:
                    header = head_
                else:
                    total.append((docs, values))
        if at is not None:
            yield done(header, total, to)

    return sums.repartition(partitions, "block").sortWithinPartitions("block", F.col("header").isNull()).mapInArrow(run, out)
