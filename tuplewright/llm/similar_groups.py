"""Groups of near copies by a stated similarity, on wide SimHash fingerprints.

A 64-bit SimHash at radius 3 links texts that are nearly equal; texts whose
five-word shingles have a Jaccard similarity of 0.8 differ in ten bits of 64 on
average, and many in more.  For that similarity this module widens the method
of ``simhash``:

1. A document is the set of its distinct word shingles; documents of one set
   are one class, compared once.  Its fingerprint is a SimHash of ``64 * WORDS``
   bits.
2. Candidates meet under keys of two least shingle hashes each: two sets of
   similarity s share one of ``TABLES`` keys with probability 1 - (1 - s^2)^TABLES
   (for 0.8 and 12 tables all but five in a million).  Large buckets are dealt
   out as cells as in ``simhash``.
3. The bit planes of a cell are compared with carry-save counters, and blocks
   left when all lanes are past the radius, which lies three standard deviations
   beyond the stated similarity.  In sets of up to ``SMALL`` shingles ties of
   the majority add to the distance (four against five shingles differ in 3/16 of
   the bits); pairs with one have ``WIDER`` more bits.  Of each cell the spanning
   forest of least distances is kept.
4. The components of all forests hold every pair that came within the radius
   anywhere.  Their members are dealt out once more as cells, now with their
   shingle sets, and compared again.
5. In a cell the forest of least distances is verified first, on the sets
   themselves; then, as bits do not order pairs by similarity, every pair within
   the radius whose ends verified links do not join yet.  The components of
   all verified links are the groups.

A null or wordless text is the empty set, so such texts form one class; a text
shorter than a shingle is one shingle.  Repeated rows are members of one class.
Texts are named by their md5, never by their place in a scan.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_schema, durable, pick, schema, shuffle_partitions, small_batches, text_or_empty, words_of
from .components import components
from .simhash import CELL, SLAB

WORDS = 4
TABLES = 12
SMALL, WIDER = 8, 23
#: Bytes of shingle sets in a cell's part, where sets are dealt to cells.
SETS = 16_000_000
_ODD = [((2 * i + 1) * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * i) & 0xFFFFFFFFFFFFFFFF | 1 for i in range(1, WORDS + 2 * TABLES + 1)]


def shingle_set(text: str, width: int) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending."""
    from xxhash import xxh64_intdigest

    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([xxh64_intdigest(b" ".join(words))], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter(map(xxh64_intdigest, shingles), np.uint64, len(words) - width + 1))


def _mixed(values: np.ndarray, odd: int) -> np.ndarray:
    x = values * np.uint64(odd)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def wide_fingerprint(values: np.ndarray) -> np.ndarray:
    counts = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(values), SLAB):
        for w in range(WORDS):
            part = _mixed(values[at : at + SLAB], _ODD[w]).astype("<u8").view(np.uint8).reshape(-1, 8)
            counts[w] += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(values), axis=1, bitorder="little").view("<u8")[:, 0]


def keys_of(values: np.ndarray) -> np.ndarray:
    """A key per table from two least hashes."""
    if not len(values):
        return np.arange(TABLES, dtype=np.uint64)
    least = [_mixed(values, odd).min() for odd in _ODD[WORDS:]]
    pairs = np.array(least, np.uint64).reshape(TABLES, 2)
    return _mixed(pairs[:, 0] + pairs[:, 1] * np.uint64(_ODD[0]) + np.arange(TABLES, dtype=np.uint64), _ODD[1])


def radius_for(similarity: float) -> int:
    """Bits that differ at this Jaccard similarity, and three deviations more."""
    bits = 64 * WORDS
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * share + 3 * math.sqrt(bits * share * (1 - share)))


def distances(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Bits that differ between queries and lanes, 255 if over ``radius``.

    planes: (bits, groups, words); queries: (n, groups, WORDS).
    Returns (n, groups, 64 * words).
    """
    bits = (radius + 1).bit_length()
    start = (1 << bits) - 1 - radius
    ones = ~np.uint64(0)
    shape = (len(queries), *planes.shape[1:])
    counters = [np.full(shape, ones if start >> i & 1 else 0, np.uint64) for i in range(bits)]
    over = np.zeros(shape, np.uint64)
    for p in range(len(planes)):
        flip = (np.uint64(0) - ((queries[:, :, p >> 6] >> np.uint64(p & 63)) & np.uint64(1)))[:, :, None]
        carry = planes[p][None] ^ flip
        for i in range(bits):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if p % 32 == 31 and (over == ones).all():
            return np.full((*shape[:2], 64 * shape[2]), 255, np.uint8)

    def spread(x: np.ndarray) -> np.ndarray:
        return np.unpackbits(np.ascontiguousarray(x).astype("<u8").view(np.uint8), axis=-1, bitorder="little")

    total = sum((spread(c).astype(np.int16) << i for i, c in enumerate(counters)), np.int16(-start))
    return np.where(spread(over) == 1, 255, total).astype(np.uint8)


def _planes(fps: np.ndarray) -> np.ndarray:
    """(groups, lanes, WORDS) fingerprints -> (bits, groups, lanes / 64) planes."""
    groups, lanes, _ = fps.shape
    bits = np.unpackbits(np.ascontiguousarray(fps).astype("<u8").view(np.uint8).reshape(groups, lanes, -1), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")


def forest(apart: np.ndarray) -> list[tuple[int, int]]:
    """Prim's forest of least distances of a square matrix; 255 is no link."""
    n = len(apart)
    left = np.ones(n, bool)
    best, via, edges = np.full(n, 255, np.uint8), np.zeros(n, np.int64), []
    for _ in range(n):
        near = np.where(left, best, 255)
        b = int(near.argmin())
        if near[b] == 255:
            b = int(left.argmax())
        else:
            edges.append((int(via[b]), b))
        left[b] = False
        closer = apart[b] < best
        best[closer], via[closer] = apart[b][closer], b
    return edges


def near(apart: np.ndarray, sizes: np.ndarray, radius: int) -> np.ndarray:
    """Distances of pairs, 255 if past the radius that their sizes have."""
    small = sizes <= SMALL
    return np.where((apart > radius) & ~(small[:, None] | small), np.uint8(255), apart)


def matrices(groups: list[np.ndarray], sizes: list[np.ndarray], radius: int):
    """(group, distances of all its pairs); a group is an (n, WORDS) array of fingerprints of sets of ``sizes``."""
    for i, apart in _distances(groups, radius + WIDER):
        yield i, near(apart, sizes[i], radius)


def _distances(groups: list[np.ndarray], radius: int):
    for low, high in ((2, 2), (3, 8), (9, 64)):
        some = [i for i, g in enumerate(groups) if low <= len(g) <= high]
        for at in range(0, len(some), 2048 // high):
            part = some[at : at + 2048 // high]
            padded = np.zeros((len(part), 64, WORDS), np.uint64)
            for k, i in enumerate(part):
                padded[k, : len(groups[i])] = groups[i]
            apart = distances(_planes(padded), padded[:, :high].transpose(1, 0, 2), radius)
            for k, i in enumerate(part):
                n = len(groups[i])
                yield i, apart[:n, k, :n]
    for i, g in enumerate(groups):
        if len(g) > 64:
            padded = np.zeros((1, -(-len(g) // 64) * 64, WORDS), np.uint64)
            padded[0, : len(g)] = g
            planes = _planes(padded)
            yield i, np.concatenate([distances(planes, g[at : at + 64, None], radius)[:, 0, : len(g)] for at in range(0, len(g), 64)])


def links(groups: list[np.ndarray], sizes: list[np.ndarray], radius: int) -> list[tuple[int, int, int]]:
    """(group, a, b) of the forests."""
    found = []
    for i, own in matrices(groups, sizes, radius):
        if len(own) == 2:
            if own[0, 1] < 255:
                found.append((i, 0, 1))
        else:
            found += [(i, a, b) for a, b in forest(own)]
    return found


def joining(apart: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Verified links that join all members of a cell which links within the radius join: first
    those of the forest, then every pair of different labels, of sizes that allow the
    similarity; a link makes two labels one."""
    sizes, found = np.array([len(s) for s in sets]), []
    labels = np.arange(len(sets))
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ids, mark = np.split(flat, np.cumsum(sizes)[:-1]), np.zeros(len(names), bool)

    def tried(a: int, others: list[int]) -> None:
        mark[ids[a]] = True
        for b in others:
            if labels[a] != labels[b]:
                both = int(np.count_nonzero(mark[ids[b]]))
                if both >= similarity * (int(sizes[a]) + int(sizes[b]) - both):
                    labels[labels == labels[b]] = labels[a]
                    found.append((a, b))
        mark[ids[a]] = False

    for a, b in forest(apart):
        tried(a, [b])
    for a in range(len(sets)):
        least, most = np.minimum(sizes[a], sizes[a + 1 :]), np.maximum(sizes[a], sizes[a + 1 :])
        others = np.flatnonzero((apart[a, a + 1 :] < 255) & (labels[a + 1 :] != labels[a]) & (least >= similarity * most))
        if len(others):
            tried(a, (others + a + 1).tolist())
    return found


_CELL = ("bucket", "i", "j")


def _gathered(batches, *columns: str):
    """Lists of whole cells (bucket, part, values of each column), of some 20 000
    rows or 16 MB of the last column, if that is of bytes."""
    held, size, last = [], 0, None
    for batch in batches:
        for *row, value in zip(*(batch.column(c).to_pylist() for c in (*_CELL, *columns))):
            if row[:3] != last:
                if size > 20_000:
                    yield held
                    held, size = [], 0
                held.append((*row[:2], *([] for _ in columns)))
                last = row[:3]
            for to, v in zip(held[-1][2:], (*row[3:], value)):
                to.append(v)
            size += 1 + (len(value) // 800 if isinstance(value, bytes) else 0)
    if held:
        yield held


def _fingerprints(cells) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(c[3]), "<u8").reshape(-1, WORDS) for c in cells]


def _sizes(cells) -> list[np.ndarray]:
    return [np.array(c[4]) for c in cells]


def _compare(radius: int, out: T.StructType):
    def run(batches):
        to = arrow_schema(out)
        for cells in _gathered(batches, "cls", "fp", "n"):
            rows = [sorted((cells[i][2][a], cells[i][2][b])) for i, a, b in links(_fingerprints(cells), _sizes(cells), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(to)], schema=to)

    return run


def _join(radius: int, similarity: float, out: T.StructType):
    def run(batches):
        to = arrow_schema(out)
        for cells in _gathered(batches, "cls", "fp", "n", "shingles"):
            rows = []
            for i, own in matrices(_fingerprints(cells), _sizes(cells), radius):
                sets = [np.frombuffer(s, np.uint64) for s in cells[i][5]]
                rows += [(cells[i][2][a], cells[i][2][b]) for a, b in joining(own, sets, similarity)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(to)], schema=to)

    return run


def _cells(rows: DataFrame, *columns: str, size: str | None = None) -> DataFrame:
    """``rows`` (bucket, cls and the columns) of buckets of two and more, dealt
    out as cells; ``size`` is a column of bytes that bound a part too."""
    parts = F.ceil(F.col("n_rows") / F.lit(CELL))
    if size:
        parts = F.greatest(parts, F.ceil(F.col("n_bytes") / F.lit(SETS)))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n_rows"), F.sum(size or F.lit(0)).alias("n_bytes")).where("n_rows > 1")
    met = rows.join(sizes.select("bucket", parts.cast("int").alias("parts")), "bucket")
    met = met.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != F.col("part")))
    dealt = met.withColumn("other", F.explode(others)).select("bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "cls", *columns)
    return dealt.repartition(shuffle_partitions(rows.sparkSession), *_CELL).sortWithinPartitions(*_CELL, "cls")


def _sets(rows: DataFrame, width: int, out: T.StructType) -> DataFrame:
    """cls, shingles of each class once; of copies a task sends the first of some 100 000 classes."""

    def run(batches):
        to, sent = arrow_schema(out), set()
        for batch in batches:
            names, sets = [], []
            for name, text in zip(batch.column("cls").to_pylist(), batch.column("text").to_pylist()):
                if name not in sent:
                    sent.add(name)
                    names.append(name)
                    sets.append(shingle_set(text or "", width).tobytes())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sets, pa.binary())], schema=to)
            if len(sent) > 100_000:
                sent.clear()

    return rows.select("cls", "text").mapInArrow(run, out).dropDuplicates(["cls"])


def groups(rows: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """``rows``: id, digest (a name of the text), text -> id, digest, cls, component of every
    row: rows are in one group if a chain of links of at least ``similarity`` joins them."""
    spark = rows.sparkSession
    small_batches(spark)
    made = schema(("id", rows.schema["id"].dataType), ("digest", "string"), ("cls", "binary"), ("fp", "binary"), ("n", "int"), ("keys", T.ArrayType(T.LongType(), False)))

    def run(batches):
        from xxhash import xxh128_digest

        to = arrow_schema(made)
        for batch in batches:
            sets = [shingle_set(t or "", width) for t in batch.column("text").to_pylist()]
            keys = [keys_of(s).view(np.int64) for s in sets]
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * TABLES), pa.array(flat))
            cols = [batch.column("id"), batch.column("digest"), pa.array([xxh128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([wide_fingerprint(s).tobytes() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()), lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    marked = durable(rows.select("id", "digest", "text").mapInArrow(run, made))
    classes = marked.groupBy("cls").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.first("keys").alias("keys"), F.min("digest").alias("digest"))
    pair = schema(("u", "binary"), ("v", "binary"))
    radius = radius_for(similarity)
    # A key holds its table, so keys of different tables do not meet.
    placed = classes.select("cls", "fp", "n", F.explode("keys").alias("bucket"))
    proposed = durable(_cells(placed, "fp", "n").mapInArrow(_compare(radius, pair), pair).distinct())
    near_by = components(proposed).withColumnRenamed("node", "cls").withColumnRenamed("component", "bucket")
    met = durable(near_by.join(classes.select("cls", "fp", "n", "digest"), "cls"))
    kept = schema(("cls", "binary"), ("shingles", "binary"))
    sets = _sets(rows.select("digest", "text").join(met.select("cls", "digest"), "digest"), width, kept)
    held = durable(met.select("cls", "fp", "n", "bucket").join(sets, "cls").withColumn("size", F.length("shingles")))
    verified = durable(_cells(held, "fp", "n", "shingles", size="size").mapInArrow(_join(radius, similarity, pair), pair))
    found = components(verified)
    return marked.select("id", "digest", "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").select("id", "digest", "cls", F.coalesce("component", "cls").alias("component"))


def one_of_each(docs: DataFrame, width: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null last), of
    those of the least digest of the text, of those of the least digest of the row."""
    key, text = docs[f"`{id_col}`"], text_or_empty(docs[f"`{text_col}`"])
    digest = F.md5(text.cast("binary"))
    members = groups(docs.select(key.alias("id"), digest.alias("digest"), text.alias("text")), width, similarity)
    named = members.groupBy("component", "id", "digest").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "digest"))
    leaders = durable(named.groupBy("component").agg(first.alias("leader"), F.sum("n").alias("n")).where("n > 1").select("component", "leader"))
    fate = durable(named.join(leaders, "component").select("id", "digest", "n", (F.col("leader.id").eqNullSafe(F.col("id")) & (F.col("leader.digest") == F.col("digest"))).alias("leads")))

    def with_rows(df: DataFrame, some: DataFrame, how: str) -> DataFrame:
        return df.join(some, df[f"`{id_col}`"].eqNullSafe(some["id"]) & (F.md5(text_or_empty(df[f"`{text_col}`"]).cast("binary")) == some["digest"]), how)

    kept = with_rows(docs, fate.where("not leads").select("id", "digest"), "left_anti")
    repeated = fate.where("leads and n > 1").select("id", "digest")
    if repeated.isEmpty():
        return kept
    row = F.struct(*[f"`{c}`" for c in docs.columns])
    same = with_rows(kept, repeated, "left_semi").groupBy(F.col(f"`{id_col}`"), F.md5(text_or_empty(F.col(f"`{text_col}`")).cast("binary"))).agg(F.min_by(row, F.md5(F.to_json(row).cast("binary"))).alias("_row"))
    return with_rows(kept, repeated, "left_anti").unionByName(same.select("_row.*"))
