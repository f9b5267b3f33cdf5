"""Brown class-based n-grams: P(word | before) = P(class | class before) P(word | class).

Every word of the training texts is put into one of ``n_classes`` classes by
exchange clustering; the vocabulary grows with the corpus, and no word is left
out.

1. *Blocks.*  Runs of documents become rows of their distinct words and their
   texts as numbers of those words.  Texts are read and split once.
2. *Seeds.*  The ``n_seeds`` most frequent words are exchanged one by one on the
   matrix of their bigrams (each moves to the class that raises the likelihood of
   the bigram class model most) until none moves.
3. *Contexts.*  Every word gets its counts of left and right neighbours by class:
   the seeds' classes, one for all other words, one for the ends of texts.
   That is a sparse row per word, summed over the corpus by word.
4. *Sweeps.*  All other words are put into their best class and then exchanged,
   half of them (by hash) a sweep, against the counts of classes and contexts, a
   matrix of fixed size, which is summed anew after each sweep; until two sweeps
   together raise the log-likelihood by less than ``tolerance`` nats a token.
5. Classes and counts go back to the blocks.  Transitions are counted over all
   training texts; a word that occurs once chose its class by that very place, so
   there it stands for the class of unseen words.

Emissions are smoothed by ``delta`` with one more type a class, transitions by
``epsilon``; unseen words count as one type more than the words that occur once.  The ``n_local`` most frequent words are a table of fixed size in
every worker; all others come by joins on the word, of which no key has more rows
than there are blocks.

A null or wordless text is one end token.  Null ids hash as no text and are
scored, not trained on; repeated rows count each time; other columns are
ignored.  No training documents: c, N and V are 0 and every token is unknown.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, durable, pick, remove, schema, shuffle_partitions, small_batches, stored, text_or_empty, words_of

#: Code points and documents of a block, at most (a longer text is one block).
BLOCK_CHARS, BLOCK_DOCS = 16_000_000, 60_000
#: Words a block proposes as frequent ones.
PROPOSED = 16_384
#: Parts in which contexts of frequent words are summed first.
SALTS = 64
#: Words whose gains are held at once.
SLAB = 4096
#: Marks words that occur once, in a class number.
ONCE = 128


def _pack(array: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(array).tobytes(), codec="zstd", asbytes=True) if len(array) else b""


def _unpack(raw: bytes, size: int, kind) -> np.ndarray:
    """``size``: values."""
    return np.frombuffer(pa.decompress(raw, size * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if size else np.empty(0, kind)


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


_BLOCK = ("block", "long"), ("ids", "binary"), ("lengths", "binary"), ("train", "binary"), ("tokens", "binary"), ("words", "binary")


def blocks(docs: DataFrame) -> DataFrame:
    """``docs``: id, text, train.  Words of a block are joined by spaces; a word's number is its place."""
    out = schema(*_BLOCK)
    kind = arrow_schema(schema(("id", docs.schema["id"].dataType)))

    def run(batches):
        from pyspark import TaskContext

        to = arrow_schema(out)
        block = TaskContext.get().partitionId() << 32
        numbers, keys, train, tokens, size = _Numbers(), [], [], [], 0

        def row():
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, kind) as writer:
                writer.write_table(pa.table([pa.array(keys, kind.field(0).type)], schema=kind))
            lengths = np.array([len(t) for t in tokens], np.int64)
            values = block, sink.getvalue().to_pybytes(), lengths.tobytes(), np.array(train, np.uint8).tobytes(), _pack(np.concatenate(tokens)), b" ".join(numbers)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, to)], schema=to)

        for batch in batches:
            for key, text, used in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "train"))):
                found = words_of(text)
                tokens.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                keys.append(key)
                train.append(used)
                size += len(text)
                if size >= BLOCK_CHARS or len(keys) >= BLOCK_DOCS:
                    yield row()
                    block, numbers, keys, train, tokens, size = block + 1, _Numbers(), [], [], [], 0
        if keys:
            yield row()

    return docs.select("id", "text", "train").mapInArrow(run, out)


class Block:
    """A row of ``blocks``, read again."""

    def __init__(self, block, ids, lengths, train, tokens, words):
        self.block, self.ids, self.lengths = block, ids, np.frombuffer(lengths, np.int64)
        self.train = np.frombuffer(train, np.uint8).astype(bool)
        self.tokens = _unpack(tokens, int(self.lengths.sum()), np.int32)
        self.words = words.split(b" ") if words else []

    def training(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and lengths of the training documents."""
        return self.tokens[np.repeat(self.train, self.lengths)], self.lengths[self.train]


def _read_blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(*(batch.column(n)[i].as_py() for n, _ in _BLOCK))


def _chain(values: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """``end``, the first text, ``end``, the second text ... ``end``."""
    starts = np.cumsum(np.r_[0, lengths[:-1]]) if len(lengths) else np.empty(0, np.int64)
    return np.append(np.insert(values, starts, end), end)


def _places(words: list[bytes], table: pa.Array) -> np.ndarray:
    """Place of each word in ``table``, -1 if it isn't there."""
    return pc.fill_null(pc.index_in(pa.array(words, pa.binary()), table), -1).to_numpy(zero_copy_only=False)


def frequent_words(made: DataFrame, n: int) -> list[bytes]:
    """The ``n`` words of highest training count, ties by word; each block proposes its ``PROPOSED`` most frequent."""
    out = schema(("word", "binary"), ("c", "long"))

    def run(batches):
        to = arrow_schema(out)
        for b in _read_blocks(batches):
            counts = np.bincount(b.training()[0], minlength=len(b.words))
            best = np.argsort(-counts, kind="stable")[:PROPOSED]
            best = best[counts[best] > 0]
            yield pa.RecordBatch.from_arrays([pa.array([b.words[i] for i in best.tolist()], pa.binary()), pa.array(counts[best])], schema=to)

    top = made.mapInArrow(run, out).groupBy("word").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "word").limit(n)
    return [bytes(r.word) for r in top.select("word").collect()]


def bigram_matrix(made: DataFrame, words: list[bytes]) -> np.ndarray:
    """Bigrams among ``words``, all other words and the ends of texts (the last two symbols)."""
    n = len(words) + 2
    out = schema(("left", "int"), ("salt", "int"), ("cells", "binary"))

    def run(batches):
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        to, table, counts = arrow_schema(out), pa.array(words, pa.binary()), np.zeros(n * n, np.int64)
        for b in _read_blocks(batches):
            symbol = _places(b.words, table).astype(np.int64)
            symbol[symbol < 0] = n - 2
            tokens, lengths = b.training()
            if len(lengths):
                chain = _chain(symbol[tokens], lengths, n - 1)
                counts += np.bincount(chain[:-1] * n + chain[1:], minlength=n * n)
        for left in np.flatnonzero(counts.reshape(n, n).any(axis=1)).tolist():
            row = counts[left * n : left * n + n]
            right = np.flatnonzero(row)
            cells = np.stack([right, row[right]], axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([left], pa.int32()), pa.array([salt], pa.int32()), pa.array([cells.tobytes()], pa.binary())], schema=to)

    def merge(batches):
        to, sums = arrow_schema(out), {}
        for batch in batches:
            for left, cells in zip(batch.column("left").to_pylist(), batch.column("cells").to_pylist()):
                cells = np.frombuffer(cells, np.int64).reshape(-1, 2)
                sums.setdefault(left, np.zeros(n, np.int64))[cells[:, 0]] += cells[:, 1]
        for left, row in sums.items():
            right = np.flatnonzero(row)
            cells = np.stack([right, row[right]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([left], pa.int32()), pa.array([0], pa.int32()), pa.array([cells.tobytes()], pa.binary())], schema=to)

    parts = shuffle_partitions(made.sparkSession)
    # The rows of a word come from every task: some tasks' are added up first.
    some = made.mapInArrow(run, out).repartition(parts, "left", "salt").mapInArrow(merge, out)
    matrix = np.zeros((n, n), np.int64)
    # n rows of n counts at most.
    for left, _, cells in some.repartition(min(parts, n), "left").mapInArrow(merge, out).collect():
        cells = np.frombuffer(cells, np.int64).reshape(-1, 2)
        matrix[left, cells[:, 0]] = cells[:, 1]
    return matrix


_CELLS = ("cell", "int"), ("n", "long")


def _nonzero(total: np.ndarray, to: pa.Schema) -> pa.RecordBatch:
    cells = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells].astype(np.int64))], schema=to)


def _summed(cells: DataFrame, size: int) -> np.ndarray:
    """The sums of cells, of which there are ``size``: no more rows come to the driver."""
    total = np.zeros(size, np.int64)
    for cell, n in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        total[cell] = n
    return total


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(bigrams: np.ndarray, n_words: int, n_classes: int) -> np.ndarray:
    """Classes of the first ``n_words`` symbols of a square bigram matrix; every
    other symbol is a class of its own and stays.  Words start by rank modulo
    ``n_classes``; a word moves only if the likelihood rises, until none does."""
    total = len(bigrams)
    of = np.r_[np.arange(n_words) % n_classes, n_classes + np.arange(total - n_words)]
    size = n_classes + total - n_words
    one_hot = np.zeros((total, size))
    one_hot[np.arange(total), of] = 1
    counts = one_hot.T @ bigrams @ one_hot
    big = bigrams.astype(float)
    # Above the error of a gain, so a move does raise the likelihood and no state comes twice.
    rounding = max(1e-6, 1e-13 * float(_plogp(big.sum())))
    moved = 1
    while moved:
        moved = 0
        for w in range(n_words):
            right, left, own = big[w] @ one_hot, big[:, w] @ one_hot, big[w, w]
            old = of[w]
            if right.sum() + left.sum() == 0:
                continue
            right[old] -= own
            left[old] -= own
            counts[old] -= right
            counts[:, old] -= left
            counts[old, old] -= own
            one_hot[w, old] = 0
            c = np.arange(n_classes)
            rows, cols = counts[:n_classes], counts[:, :n_classes].T
            gain = (_plogp(rows + right) - _plogp(rows)).sum(axis=1) + (_plogp(cols + left) - _plogp(cols)).sum(axis=1)
            d, r, l = counts[c, c], right[c], left[c]
            gain += _plogp(d + r + l + own) - _plogp(d) - (_plogp(d + r) - _plogp(d)) - (_plogp(d + l) - _plogp(d))
            # A class's totals have lost its bigrams with the word too, which come back wherever the word goes.
            for side, back, add in ((counts[:n_classes].sum(axis=1), left[c], right.sum() + own), (counts[:, :n_classes].sum(axis=0), right[c], left.sum() + own)):
                gain -= _plogp(side + back + add) - _plogp(side + back)
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + rounding:
                new = old
            moved += new != old
            of[w] = new
            one_hot[w, new] = 1
            counts[new] += right
            counts[:, new] += left
            counts[new, new] += own
    return of


# A context row packs (neighbour's class, count) as count << 8 | class, the right
# neighbours' classes behind those of the left; its left counts add up to the word's.


def contexts(made: DataFrame, seeds: list[bytes], classes: np.ndarray, n_classes: int, local: list[bytes]) -> tuple[list[str], DataFrame]:
    """The paths written, and word, cells of every word of the training texts."""
    spark, size = made.sparkSession, n_classes + 2
    out = schema(("word", "binary"), ("salt", "int"), ("cells", "binary"))
    shared = spark.sparkContext.broadcast((pa.array(seeds, pa.binary()), np.append(classes, n_classes), pa.array(local, pa.binary())))

    def run(batches):
        to = arrow_schema(out)
        table, of, often = shared.value
        for b in _read_blocks(batches):
            tokens, lengths = b.training()
            if not len(tokens):
                continue
            chain = _chain(of[_places(b.words, table)][tokens], lengths, size - 1)
            at = np.flatnonzero(_chain(np.ones(len(tokens), np.int8), lengths, 0))
            keys = tokens.astype(np.int64) * (2 * size)
            keys, counts = np.unique(np.concatenate([keys + chain[at - 1], keys + size + chain[at + 1]]), return_counts=True)
            numbers, cells = keys // (2 * size), (counts.astype(np.int64) << 8 | keys % (2 * size))
            first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
            names = [b.words[i] for i in numbers[first].tolist()]
            salts = np.where(_places(names, often) >= 0, 1 + b.block % SALTS, 0).astype(np.int32)
            yield from _cell_rows(names, [pa.array(salts)], first, cells, to)

    summed = made.mapInArrow(run, out).repartition(shuffle_partitions(spark), "word", "salt").sortWithinPartitions("word", "salt").mapInArrow(_sum_cells(out, size), out)
    path, parts = stored(summed, "contexts")
    # Only the words of the local table were salted, so the others are done.
    again = parts.where("salt > 0").withColumn("salt", F.lit(0)).repartition(shuffle_partitions(spark), "word").sortWithinPartitions("word").mapInArrow(_sum_cells(out, size), out)
    more, rest = stored(again, "contexts")
    return [path, more], parts.where("salt = 0").unionByName(rest).select("word", "cells")


def _cell_rows(names, others, first, cells, to):
    """Rows of a name, other columns and the cells from ``first`` on."""
    cuts = np.append(first, len(cells))
    for at in range(0, len(names), 50_000):
        end = min(at + 50_000, len(names))
        low, high = cuts[at], cuts[end]
        raw = pa.Array.from_buffers(pa.binary(), end - at, [None, pa.py_buffer(((cuts[at : end + 1] - low) * 8).astype(np.int32).tobytes()), pa.py_buffer(cells[low:high].astype("<i8").tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(names[at:end], pa.binary()), *(o.slice(at, end - at) for o in others), raw], schema=to)


def _read_cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and count of all cells of a column."""
    raw = column.to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) >> 3
    cells = np.frombuffer(b"".join(raw), "<i8")
    return np.repeat(np.arange(len(raw)), sizes), cells & 255, cells >> 8


def _sum_cells(out, size: int):
    """Rows sorted by word and salt -> one row for each, its cells added up."""

    def run(batches):
        to, held = arrow_schema(out), None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in to], schema=to)
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            words, salts = batch.column("word").to_pylist(), batch.column("salt").to_numpy()
            new = np.fromiter((a != b for a, b in zip(words[1:], words)), bool, len(words) - 1) | (salts[1:] != salts[:-1])
            group = np.cumsum(np.r_[0, new])
            row, place, count = _read_cells(batch.column("cells"))
            keys = group[row] * (2 * size) + place
            order = np.argsort(keys, kind="stable")
            keys, count = keys[order], count[order]
            at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, count = keys[at], np.add.reduceat(count, at)
            first = np.searchsorted(keys, np.arange(group[-1] + 1) * (2 * size))
            begins = np.flatnonzero(np.r_[True, new])
            made = [*_cell_rows([words[i] for i in begins.tolist()], [pa.array(salts[begins])], first, count << 8 | keys % (2 * size), to)]
            # The last group may go on in the next batch.
            whole = pa.Table.from_batches(made).combine_chunks().to_batches()[0]
            held = whole.slice(whole.num_rows - 1)
            if whole.num_rows > 1:
                yield whole.slice(0, whole.num_rows - 1)
        if held is not None:
            yield held

    return run


class Counts:
    """Counts of (context, class), of fixed size, and what follows from them."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix.astype(float)
        self.mass = self.matrix[: len(matrix) // 2].sum(axis=0)
        self.once = _plogp(self.matrix + 1) - _plogp(self.matrix)

    def likelihood(self) -> float:
        return float(_plogp(self.matrix).sum() - 2 * _plogp(self.mass).sum())


def best_classes(counts: Counts, row: np.ndarray, place: np.ndarray, count: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The class that each word raises the likelihood most in, its own counts taken out of
    its class ``old`` (-1: none yet); ties stay, then the least."""
    n = len(old)
    size = np.bincount(row, np.where(place < len(counts.matrix) // 2, count, 0), n)
    gain = counts.once[place]
    many = np.flatnonzero(count > 1)
    some = counts.matrix[place[many]]
    gain[many] = _plogp(some + count[many, None]) - _plogp(some)
    gain = np.add.reduceat(gain, np.searchsorted(row, np.arange(n)), axis=0)
    gain -= 2 * (_plogp(counts.mass + size[:, None]) - _plogp(counts.mass))
    placed = np.flatnonzero(old >= 0)
    if len(placed):
        cell_class = old[row]
        own = np.maximum(counts.matrix[place, np.maximum(cell_class, 0)], count)
        stay = np.bincount(row, _plogp(own) - _plogp(own - count), n)
        mass = np.maximum(counts.mass[np.maximum(old, 0)], size)
        stay -= 2 * (_plogp(mass) - _plogp(mass - size))
        gain[placed, old[placed]] = stay[placed] + 1e-6
    return np.argmax(gain, axis=1)


_CLASSED = ("word", "binary"), ("cells", "binary"), ("half", "int"), ("fixed", "boolean"), ("class", "int")


def _sweep(words: DataFrame, matrix: np.ndarray, half: int | None) -> DataFrame:
    """Words with the classes of a sweep, and rows without a word: sums of the new counts.
    ``half``: the half that moves; None: all that have no class yet."""
    out = schema(*_CLASSED)
    shared = words.sparkSession.sparkContext.broadcast(matrix)

    def run(batches):
        to, counts = arrow_schema(out), Counts(shared.value)
        total = np.zeros(counts.matrix.size, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, SLAB):
                some = batch.slice(at, SLAB)
                row, place, count = _read_cells(some.column("cells"))
                old = some.column("class").to_numpy()
                free = ~some.column("fixed").to_numpy(zero_copy_only=False)
                moving = free & (old < 0 if half is None else some.column("half").to_numpy() == half)
                new = old.copy()
                if moving.any():
                    kept = moving[row]
                    of = np.cumsum(moving) - 1
                    new[moving] = best_classes(counts, of[row[kept]], place[kept], count[kept], old[moving])
                total += np.bincount(place * counts.matrix.shape[1] + new[row], count, counts.matrix.size).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(some.column(n) for n, _ in _CLASSED[:-1]), pa.array(new, pa.int32())], schema=to)
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((None, total.tobytes(), None, None, None), to)], schema=to)

    return words.select(*[n for n, _ in _CLASSED]).mapInArrow(run, out)


def cluster(words: DataFrame, paths: list[str], seeds: list[bytes], classes: np.ndarray, n_classes: int, tolerance: float) -> tuple[str, DataFrame]:
    """word, cells, class of all words; the seeds keep their classes."""
    spark, size = words.sparkSession, 2 * (n_classes + 2)
    known = spark.createDataFrame([(bytearray(w), int(c)) for w, c in zip(seeds, classes)], schema(("word", "binary"), ("seed_class", "int")))
    # At most `n_seeds` rows.
    rows = words.join(F.broadcast(known), "word", "left").select(
        "word", "cells", F.pmod(F.xxhash64("word"), F.lit(2)).cast("int").alias("half"), F.col("seed_class").isNotNull().alias("fixed"), F.coalesce("seed_class", F.lit(-1)).alias("class")
    )
    matrix = np.zeros((size, n_classes), np.int64)
    for cells, c in rows.where("fixed").select("cells", "class").collect():
        cells = np.frombuffer(cells, "<i8")
        matrix[cells & 255, c] += cells >> 8

    def step(rows, matrix, half):
        path, made = stored(_sweep(rows, matrix, half), "classes")
        out = schema(*_CELLS)

        def totals(batches):
            total = np.zeros(size * n_classes, np.int64)
            for batch in batches:
                for cells in batch.column("cells").to_pylist():
                    total += np.frombuffer(cells, np.int64)
            yield _nonzero(total, arrow_schema(out))

        total = _summed(made.where("word is null").select("cells").mapInArrow(totals, out), size * n_classes)
        return path, made.where("word is not null"), total.reshape(size, n_classes)

    path, rows, matrix = step(rows, matrix, None)
    for old in paths:
        remove(spark, old)
    while matrix.any():
        before = Counts(matrix).likelihood()
        for half in (0, 1):
            new_path, rows, matrix = step(rows, matrix, half)
            remove(spark, path)
            path = new_path
        now = Counts(matrix)
        if now.likelihood() - before < tolerance * now.mass.sum():
            break
    return path, rows


def _with_counts(rows: DataFrame, n_classes: int) -> DataFrame:
    """word, c, class."""
    out = schema(("word", "binary"), ("c", "long"), ("class", "int"))

    def run(batches):
        to = arrow_schema(out)
        for batch in batches:
            row, place, count = _read_cells(batch.column("cells"))
            c = np.bincount(row, np.where(place < n_classes + 2, count, 0), batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(c), batch.column("class")], schema=to)

    return rows.select("word", "cells", "class").mapInArrow(run, out)


class Model:
    """Everything of fixed size that scoring needs but the transitions."""

    def __init__(self, words: DataFrame, local: list[bytes], n_docs: int, n_classes: int, delta: float):
        per = {r["class"]: (r.mass, r.types) for r in words.groupBy("class").agg(F.sum("c").alias("mass"), F.count("*").alias("types")).collect()}
        once = words.where("c = 1").count()
        self.n_docs, self.n_classes, self.delta = n_docs, n_classes, delta
        self.tokens = sum(m for m, _ in per.values()) + n_docs
        self.types = sum(t for _, t in per.values()) + (n_docs > 0)
        mass, types = (np.array([per.get(c, (0, 0))[k] for c in range(n_classes)]) for k in (0, 1))
        #: Per class, the last of unseen words: log10 of its smoothed mass, `delta` for each type.
        self.class_scale = np.log10(np.append(mass + delta * (types + 1), delta * (once + 1)))
        self.base_scale = math.log10(self.tokens + 0.5 * (self.types + 1))
        table = words.join(F.broadcast(words.sparkSession.createDataFrame([(bytearray(w),) for w in local], schema(("word", "binary")))), "word").collect()
        self.local = pa.array([bytes(r.word) for r in table], pa.binary())
        self.local_class = np.array([r["class"] for r in table], np.int64)
        self.local_count = np.array([r.c for r in table], np.int64)


_SCORED = ("ids", "binary"), ("lengths", "binary"), ("train", "binary"), ("sums", "binary"), ("classes", "binary")


def _classified(made: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    """Per block: ids, lengths, training flags, sums per document (known, base, emission) and the classes of its tokens."""
    spark = made.sparkSession
    shared = spark.sparkContext.broadcast(model)
    asked, packed = schema(("word", "binary"), ("block", "long"), ("number", "int")), schema(("block", "long"), ("found", "binary"))

    def ask(batches):
        to = arrow_schema(asked)
        for b in _read_blocks(batches):
            rest = np.flatnonzero(_places(b.words, shared.value.local) < 0)
            for at in range(0, len(rest), 50_000):
                some = rest[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([b.words[i] for i in some.tolist()], pa.binary()), pa.array(np.full(len(some), b.block)), pa.array(some.astype(np.int32))], schema=to)

    def pack(batches):
        """number, class, count of many words of a block in one value."""
        to, held, size = arrow_schema(packed), [], 0

        def rows():
            block, *values = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0, True])
            table = np.stack(values, axis=1)[order]
            parts = [table[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(block[order][cuts[:-1]]), pa.array(parts, pa.binary())], schema=to)

        for batch in batches:
            held.append([batch.column(n).to_numpy().astype(np.int64) for n in ("block", "number", "class", "c")])
            size += batch.num_rows
            if size > 500_000:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    found = made.mapInArrow(ask, asked).join(words, "word").select("block", "number", "class", "c").mapInArrow(pack, packed)
    whole = made.withColumn("found", F.lit(None).cast("binary")).unionByName(found, allowMissingColumns=True)
    out = schema(*_SCORED)

    def run(batches):
        to, model = arrow_schema(out), shared.value
        b, of, counts = None, None, None

        def row():
            known = counts > 0
            docs = np.repeat(np.arange(len(b.lengths)), b.lengths)
            emission = np.log10(counts + model.delta) - model.class_scale[of]
            base = np.log10(counts + 0.5) - model.base_scale
            sums = np.stack([np.bincount(docs, x[b.tokens], len(b.lengths)) for x in (known.astype(float), base, emission)])
            marked = (of + ONCE * (counts == 1)).astype(np.uint8)
            values = b.ids, b.lengths.tobytes(), b.train.astype(np.uint8).tobytes(), sums.tobytes(), _pack(marked[b.tokens])
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, to)], schema=to)

        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("found")[i].as_py()
                if part is not None:
                    number, cls, c = np.frombuffer(part, np.int64).reshape(-1, 3).T
                    of[number], counts[number] = cls, c
                    continue
                if b is not None:
                    yield row()
                b = Block(*(batch.column(n)[i].as_py() for n, _ in _BLOCK))
                place = _places(b.words, model.local)
                of, counts = np.full(len(b.words), model.n_classes, np.int64), np.zeros(len(b.words), np.int64)
                of[place >= 0], counts[place >= 0] = model.local_class[place[place >= 0]], model.local_count[place[place >= 0]]
        if b is not None:
            yield row()

    dealt = whole.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", F.col("found").isNotNull())
    return dealt.mapInArrow(run, out)


def _scored_rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            ids, lengths, train, sums, classes = (batch.column(n)[i].as_py() for n, _ in _SCORED)
            lengths = np.frombuffer(lengths, np.int64)
            yield ids, lengths, np.frombuffer(train, np.uint8).astype(bool), np.frombuffer(sums).reshape(3, -1), _unpack(classes, int(lengths.sum()), np.uint8)


def transitions(scored: DataFrame, n_classes: int, epsilon: float) -> np.ndarray:
    """log10 P(class | class before); the last two are unseen words and the ends of texts."""
    size = n_classes + 2
    out = schema(*_CELLS)

    def run(batches):
        total = np.zeros(size * size, np.int64)
        for _, lengths, train, _, classes in _scored_rows(batches):
            if not train.any():
                continue
            chain = _chain(classes[np.repeat(train, lengths)].astype(np.int64), lengths[train], size - 1)
            of = np.where(chain >= ONCE, n_classes, chain)
            total += np.bincount(of[:-1] * size + of[1:], minlength=size * size)
        yield _nonzero(total, arrow_schema(out))

    pairs = _summed(scored.mapInArrow(run, out), size * size).reshape(size, size).astype(float)
    return np.log10((pairs + epsilon) / (pairs.sum(axis=1, keepdims=True) + epsilon * size))


def held_out(id_col: Column, parts: int = 5, part: int = 1) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(True))


def score(docs: DataFrame, n_seeds: int = 1024, n_local: int = 16384, n_classes: int = 48, delta: float = 0.5, epsilon: float = 0.1, tolerance: float = 0.005, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    assert n_classes + 2 <= ONCE and n_seeds <= n_local
    spark = docs.sparkSession
    small_batches(spark)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text")).withColumn("train", ~held_out(F.col("id")))
    made = durable(blocks(base))
    n_docs = base.where("train").count()
    local = frequent_words(made, n_local)
    seeds = local[:n_seeds]
    classes = exchange(bigram_matrix(made, seeds), len(seeds), n_classes)[: len(seeds)]
    paths, words = contexts(made, seeds, classes, n_classes, local)
    path, rows = cluster(words, paths, seeds, classes, n_classes, tolerance)
    vocabulary = durable(_with_counts(rows, n_classes))
    remove(spark, path)
    model = Model(vocabulary, local, n_docs, n_classes, delta)
    scored = durable(_classified(made, vocabulary, model))
    steps = spark.sparkContext.broadcast(transitions(scored, n_classes, epsilon))
    shared = spark.sparkContext.broadcast((model.tokens, math.log10(n_docs + 0.5) - model.base_scale, int(n_docs > 0)))
    out = schema(("id", base.schema["id"].dataType), ("n_tokens", "long"), ("n_known", "long"), ("base_score", "double"), ("score", "double"))

    def run(batches):
        to, table = arrow_schema(out), steps.value
        _, end_base, end_known = shared.value
        for ids, lengths, _, (known, base, emission), classes in _scored_rows(batches):
            chain = _chain((classes & ~np.uint8(ONCE)).astype(np.int64), lengths, n_classes + 1)
            # A text's steps: one to each of its tokens and one to its end.
            own = np.bincount(np.repeat(np.arange(len(lengths)), lengths + 1), table[chain[:-1], chain[1:]], len(lengths))
            keys = pa.ipc.open_stream(ids).read_all().column(0).combine_chunks()
            keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
            cols = [keys, pa.array(lengths + 1), pa.array(known.astype(np.int64) + end_known), pa.array(base + end_base), pa.array(emission + own)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    return scored.mapInArrow(run, out).select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
