"""SimHash fingerprints and near-duplicate classes by bit-sliced comparison.

Candidates: the 64 bits are cut into radius + 2 bands; two fingerprints that
differ in at most ``radius`` bits agree in at least two bands, so they meet in
one of the tables keyed by two bands.  Only distinct fingerprints are compared:
copies share one.  A bucket larger than ``CELL`` fingerprints is dealt out as
cells, one for each two of its parts, so no task holds a large bucket and no
pair is lost.

Comparison: the fingerprints of a cell are stored as 64 bit planes.  Against
many fingerprints at once, each plane is xor-ed with the query's bit and added
to carry-save counters held as bit vectors (ones, twos, fours ...); what passes
the radius sets an overflow bit, and a block is left as soon as every lane has
overflowed.  Of the links of a cell only a spanning forest is returned: it has
the same components.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, durable, pick, schema, shuffle_partitions, small_batches, text_or_empty, words_of
from .components import components

#: Fingerprints in a cell's part; a cell holds two parts at most.
CELL = 2048
#: Shingles whose bits are counted at once.
SLAB = 32_768


def fingerprint(text: str, width: int, seed: int = 42) -> int:
    """Bit b is 1 if it is set in over half the hashes of the word shingles,
    repeats included.  No words: 0."""
    from xxhash import xxh64_intdigest

    words = words_of(text)
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) >= width else iter([b" ".join(words)])
    hashes = np.fromiter((xxh64_intdigest(s, seed) for s in shingles), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, SLAB):
        part = hashes[at : at + SLAB].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, fp (64 bits as a long).  A null or wordless text has fingerprint 0."""
    small_batches(docs.sparkSession)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    out = schema((id_col, base.schema["id"].dataType), ("fp", "long"))

    def run(batches):
        to = arrow_schema(out)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            fps = np.fromiter((fingerprint(t or "", width, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(to.field(0).type), pa.array(fps.view(np.int64))], schema=to)

    return base.mapInArrow(run, out)


def _masks(radius: int) -> list[int]:
    """Masks of two bands each, as signed longs."""
    bands = radius + 2
    cuts = [64 * i // bands for i in range(bands + 1)]
    parts = [sum(1 << b for b in range(cuts[i], cuts[i + 1])) for i in range(bands)]
    return [m - (1 << 64) if m >> 63 else m for m in (a | b for a, b in combinations(parts, 2))]


def _planes(fps: np.ndarray, lanes: int) -> np.ndarray:
    """Bit planes of groups of ``lanes`` (a multiple of 64) fingerprints: (64, groups, lanes / 64) words."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, lanes, 8), axis=2, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view("<u8")


def near(planes: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """Lanes within ``radius`` of each query, as bits.

    planes: (64, groups, words); queries: (n, groups) fingerprints, each for
    the lanes of its group.  Returns (n, groups, words).
    """
    bits = (radius + 1).bit_length()
    start = (1 << bits) - 1 - radius  # a count over the radius carries out
    ones = ~np.uint64(0)
    shape = (len(queries), *planes.shape[1:])
    counters = [np.full(shape, ones if start >> i & 1 else 0, np.uint64) for i in range(bits)]
    over = np.zeros(shape, np.uint64)
    for p in range(64):
        flip = (np.uint64(0) - ((queries >> np.uint64(p)) & np.uint64(1)))[:, :, None]
        carry = planes[p][None] ^ flip
        for i in range(bits):
            counters[i], carry = counters[i] ^ carry, counters[i] & carry
        over |= carry
        if p % 8 == 7 and p >= 15 and (over == ones).all():
            break
    return ~over


def _tree(adjacent: list[int], n: int) -> list[tuple[int, int]]:
    """A spanning forest of a graph given as bit sets."""
    left, edges = (1 << n) - 1, []
    while left:
        root = (left & -left).bit_length() - 1
        left &= ~(1 << root)
        stack = [root]
        while stack:
            a = stack.pop()
            new = adjacent[a] & left
            left &= ~new
            while new:
                low = new & -new
                b = low.bit_length() - 1
                new ^= low
                edges.append((a, b))
                stack.append(b)
    return edges


def links(groups: list[np.ndarray], radius: int) -> list[tuple[int, int]]:
    """Spanning links within each group of distinct fingerprints."""
    found: list[tuple[int, int]] = []
    for low, high in ((2, 4), (5, 16), (17, 64)):
        some = [g for g in groups if low <= len(g) <= high]
        for at in range(0, len(some), 4096 // high):
            part = some[at : at + 4096 // high]
            n = np.array([len(g) for g in part])
            padded = np.zeros((len(part), 64), np.uint64)
            for i, g in enumerate(part):
                padded[i, : len(g)] = g
            hit = near(_planes(padded.reshape(-1), 64), padded[:, :high].T, radius)[:, :, 0]
            real = np.where(n == 64, ~np.uint64(0), (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1))
            hit &= real & ~(np.uint64(1) << np.arange(high, dtype=np.uint64))[:, None]
            for i in np.flatnonzero((hit * (np.arange(high)[:, None] < n)).any(axis=0)).tolist():
                g = part[i]
                found += [(int(g[a]), int(g[b])) for a, b in _tree([int(x) for x in hit[: len(g), i]], len(g))]
    for g in groups:
        if len(g) > 64:
            lanes = -(-len(g) // 64) * 64
            padded = np.zeros(lanes, np.uint64)
            padded[: len(g)] = g
            planes, adjacent = _planes(padded, lanes), []
            for at in range(0, len(g), 128):
                hit = near(planes, g[at : at + 128, None], radius)[:, 0, :]
                adjacent += [int.from_bytes(row.tobytes(), "little") for row in hit]
            inside = (1 << len(g)) - 1
            found += [(int(g[a]), int(g[b])) for a, b in _tree([x & inside & ~(1 << i) for i, x in enumerate(adjacent)], len(g))]
    return found


def _compare(radius: int, out):
    def run(batches):
        to = arrow_schema(out)
        held: list[np.ndarray] = []
        size, at, last = 0, [], None

        def done():
            pairs = links(held, radius)
            both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=to)

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(batch.column(c)) for c in ("t", "bucket", "i", "j")]
            fps = np.asarray(batch.column("fp")).view(np.uint64)
            change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
            for a, b in zip(np.r_[0, change].tolist(), np.r_[change, len(fps)].tolist()):
                key = tuple(int(c[a]) for c in cols)
                if key != last and at:
                    held.append(np.concatenate(at))
                    size += len(held[-1])
                    at = []
                    if size > 20_000:
                        yield done()
                        held.clear()
                        size = 0
                last = key
                at.append(fps[a:b])
        if at:
            held.append(np.concatenate(at))
        if held:
            yield done()

    return run


def candidate_cells(fps: DataFrame, radius: int) -> DataFrame:
    """t, bucket, i, j, fp: the distinct fingerprints of each bucket with two or more, by cell."""
    rows = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks(radius)])).alias("t", "bucket"))
    sizes = rows.groupBy("t", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    met = rows.join(sizes, ["t", "bucket"]).withColumn("parts", F.ceil(F.col("n") / F.lit(CELL)).cast("int"))
    met = met.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: k != F.col("part")))
    return met.withColumn("other", F.explode(others)).select("t", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp")


def near_links(fps: DataFrame, radius: int = 3) -> DataFrame:
    """u, v: links between distinct fingerprints that span every class of
    fingerprints reachable in steps of at most ``radius`` bits."""
    out = schema(("u", "long"), ("v", "long"))
    cells = candidate_cells(fps.select("fp").where(F.col("fp").isNotNull()).distinct(), radius)
    dealt = cells.repartition(shuffle_partitions(fps.sparkSession), "t", "bucket", "i", "j").sortWithinPartitions("t", "bucket", "i", "j")
    return dealt.mapInArrow(_compare(radius, out), out)


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, fp, component_id: the smallest id reachable over links, its
    own included (a null id is never smallest unless it is alone).

    Wordless and null texts have fingerprint 0 and are linked like any other;
    repeated rows stay; other columns are ignored; no rows give no rows.
    """
    rows = durable(fingerprints(docs, width, seed, id_col, text_col))
    classes = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    found = components(near_links(rows, radius))
    named = classes.join(found, classes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(id_col, "fp", "component_id")
