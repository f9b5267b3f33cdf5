"""Token counts from pre-token frequencies.

Every distinct pre-token is counted once where its rows meet (see
``docterms``), and a document's count is the sum of frequency x count; ids are
never made.  Pre-tokens that the vocabulary holds whole are one token each and
are counted on the spot: the vocabulary is fixed, so this set is bounded.

For files of the ``tokenizers`` library the text is first split at the special
strings, which count one token each, as the library does by default.  For a
``sentencepiece`` model, which has no pre-tokens of its own, words with their
leading space serve as pre-tokens only if no piece spans a space; the
texts are counted whole instead.

A null text counts as empty; null ids are kept; repeated rows yield one row
each; other columns are ignored; an empty table yields an empty one.
"""
from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import docterms
from .common import arrow_schema, pick, schema, shuffle_partitions, small_batches, text_or_empty


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def _whole(path: str) -> frozenset[str]:
    """Pre-tokens that are one token: entries of a byte-level vocabulary that
    its own merges rebuild, as text."""
    tokenizer = _tokenizer(path)
    back = {c: b for b, c in enumerate(_byte_letters())}
    names = []
    for name in tokenizer.get_vocab(with_added_tokens=False):
        try:
            names.append(bytes(back[c] for c in name).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    counts = [len(x.ids) for x in tokenizer.encode_batch(names, add_special_tokens=False)]
    return frozenset(n for n, c in zip(names, counts) if c == 1)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if
    printable in Latin-1, else the next unused code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class _PreTokens(docterms.Terms):
    def __init__(self, path: str, pattern: str):
        import regex

        self.find, self.whole = regex.compile(pattern).findall, _whole(path)
        with open(path) as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def split(self, text):
        size = (len(text.encode()),)
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return [t for part in parts for t in self.find(part)], (*size, len(parts) - 1)
        return self.find(text), (*size, 0)

    def describe(self, terms):
        return np.fromiter((t in self.whole for t in terms), float, len(terms))[:, None]

    def header(self, ids, of, docs, table):
        return [np.bincount(of, table[ids, 0], docs).astype(np.int64)]


def _look(path: str):
    """Each distinct pre-token of a task is counted once; the table is emptied
    when it holds a million."""

    def make():
        tokenizer, table = _tokenizer(path), {}

        def find(batch: pa.RecordBatch) -> np.ndarray:
            terms = batch.column("term").to_pylist()
            if len(table) > 1_000_000:
                table.clear()
            new = list({t for t in terms if t not in table})
            for at in range(0, len(new), 10_000):
                some = new[at : at + 10_000]
                table.update(zip(some, (len(x.ids) for x in tokenizer.encode_batch([t.decode() for t in some], add_special_tokens=False))))
            return np.fromiter((table[t] for t in terms), np.float64, len(terms))[:, None]

        return find

    return make


def count_tokens(docs: DataFrame, path: str, pattern: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    spark = docs.sparkSession
    small_batches(spark)
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    if path.endswith(".model"):
        return _count_whole(base, path, limit, id_col)
    parts = shuffle_partitions(spark)
    extra = schema(("n_bytes", "long"), ("special", "long"), ("known", "long"))
    posted = docterms.post(base, lambda: _PreTokens(path, pattern), extra).repartition(parts, "term", "salt")
    sums = docterms.add_up(posted, _look(path))
    rows = docterms.finish(sums, base.schema["id"].dataType, extra, ["joined"], parts)
    return rows.select(F.col("id").alias(id_col), "n_bytes", (F.col("special") + F.col("known") + F.col("joined").cast("long")).alias("n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)


def _count_whole(base: DataFrame, path: str, limit: int, id_col: str) -> DataFrame:
    out = schema((id_col, base.schema["id"].dataType), ("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean"))

    def run(batches):
        import sentencepiece

        to, model = arrow_schema(out), sentencepiece.SentencePieceProcessor(model_file=path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = [len(model.encode(t)) for t in texts]
            cols = [batch.column("id"), [len(t.encode()) for t in texts], n, [x > limit for x in n]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c.cast(f.type) for c, f in zip(cols, to)], schema=to)

    return base.mapInArrow(run, out)
