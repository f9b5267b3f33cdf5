"""Tags, chat markup, prompt assembly and JSON text, as column expressions."""
from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import strip

# Fixed value: a tag in a text.
TAG = r"\[([A-Z_][A-Z_0-9/]*\d+)\]"
TAG_PADDING = 200
KEEP_SHARE = 0.7


def tag_ids(col: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(col, F.lit(TAG), F.lit(1)))


def tag_name(col: Column) -> Column:
    """Name of the first tag without its number; '' without a tag."""
    return F.regexp_extract(col, r"\[([A-Z_][A-Z_0-9/]*?)(\d+)\]", 1)


def narrow(text: Column, tags: Column, padding: int = TAG_PADDING) -> Column:
    """The part of ``text`` that holds all tags, with padding; the whole text if a
    tag is missing, there are none, or little would be saved."""
    def at(t: Column, mark: str) -> Column:
        return F.call_function("locate", F.concat(F.lit(f"[{mark}"), t, F.lit("]")), text)

    spots = F.flatten(
        F.transform(
            tags,
            lambda t: F.concat(
                F.array(at(t, "") - 1, at(t, "") - 1 + F.length(t) + 2),
                F.when(at(t, "/") > 0, F.array(at(t, "/") - 1 + F.length(t) + 3)).otherwise(F.array().cast("array<int>")),
            ),
        )
    )
    start = F.greatest(F.array_min(spots) - padding, F.lit(0))
    end = F.least(F.array_max(spots) + padding, F.length(text))
    whole = (F.size(tags) == 0) | F.exists(tags, lambda t: at(t, "") == 0) | (end - start >= F.length(text) * F.lit(KEEP_SHARE))
    return F.when(whole, text).otherwise(F.substr(text, start + 1, end - start))


def tight_tags(col: Column) -> Column:
    """No quotes, no white space between tags and their text."""
    bare = F.replace(F.coalesce(col, F.lit("UNKNOWN")), F.lit('"'), F.lit(""))
    return strip(F.regexp_replace(bare, r"(?Ud)(\[[^\]]+\])\s*(.*?)\s*(\[/[^\]]+\])", "$1$2$3"))


def bracketed(pair_id: Column) -> Column:
    return F.concat(F.lit("["), F.coalesce(pair_id, F.lit("UNK")), F.lit("]"))


def json_string(col: Column) -> Column:
    """A JSON string literal, non-ASCII kept."""
    whole = F.to_json(F.struct(col.alias("s")))
    return F.substr(whole, F.lit(6), F.length(whole) - 6)


def occurrences(col: Column, needle: str) -> Column:
    return ((F.length(col) - F.length(F.replace(col, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def names_any(col: Column, names) -> Column:
    """Whether a text holds one of the names in double quotes."""
    return col.rlike('"(' + "|".join(map(re.escape, names)) + ')"')


def strip_thinking(col: Column) -> Column:
    parts = F.split(col, r"<channel\|>")
    return strip(F.array_join(F.transform(parts, lambda p: F.substring_index(p, "<|channel>", 1)), ""))


def without_think_tags(col: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(col, r"(?s)<\|think\|>.*?<\|/think\|>", ""), r"(?s)<think>.*?</think>", ""))


def without_stop_tokens(col: Column, own: tuple[str, ...] = ()) -> Column:
    # End tokens of any format.
    for token in (*own, "<|im_end|>", "<end_of_turn>", "<turn|>"):
        col = F.replace(col, F.lit(token), F.lit(""))
    return strip(col)


def format_of(path: str) -> str:
    low = path.lower()
    return "gemma4" if "gemma4" in low or "gemma-4" in low else "gemma3" if "gemma" in low else "qwen"


def response_spans(transcript: Column, instruction: str = "<|turn>user\n", response: str = "<|turn>model\n") -> Column:
    """(begin, end) in code points of what a model should learn: from each response tag to
    the next instruction tag, response tag or the end."""
    parts = F.split(transcript, re.escape(response), -1)

    def span(k: Column) -> Column:
        before = F.slice(parts, F.lit(1), k)
        begin = F.aggregate(before, F.lit(0), lambda n, p: n + F.length(p) + len(response))
        return F.struct(begin.alias("begin"), (begin + F.length(F.substring_index(F.get(parts, k), instruction, 1))).alias("end"))

    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), span)).otherwise(F.array().cast("array<struct<begin:int,end:int>>"))


def model_format(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.contains("gemma4") | low.contains("gemma-4"), "gemma4").when(low.contains("gemma"), "gemma3").otherwise("qwen")


def answer_at(col: Column, split_tag: str) -> tuple[Column, Column]:
    """(prompt, answer) at the first split tag, which stays with the prompt; no tag: all prompt."""
    at = F.locate(split_tag, col)
    end = at + len(split_tag) - 1
    return F.when(at > 0, F.substr(col, F.lit(1), end)).otherwise(col), F.when(at > 0, F.substr(col, end + 1)).otherwise(F.lit(""))


def file_tokens(path: str):
    """An Arrow function: tokens of a text by a tokenizer file of the ``tokenizers`` library
    (.json) or of sentencepiece (.model), without special tokens; null: null."""
    @F.arrow_udf("int")
    def count(texts: pa.Array) -> pa.Array:
        known = texts.to_pylist()
        some = [t for t in known if t is not None]
        if path.endswith(".model"):
            import sentencepiece

            sizes = iter([len(ids) for ids in sentencepiece.SentencePieceProcessor(model_file=path).encode(some)])
        else:
            sizes = iter([len(x.ids) for x in _tokenizer(path).encode_batch(some, add_special_tokens=False)])
        return pa.array([None if t is None else next(sizes) for t in known], pa.int32())

    return count


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def token_len(col: Column, kind: str = "bytes4") -> Column:
    """Tokens of a text: ``bytes4`` (UTF-8 bytes over four), ``chars``, ``words`` or
    ``file:<path>``, counted by that tokenizer file."""
    if kind.startswith("file:"):
        return file_tokens(kind.removeprefix("file:"))(col)
    if kind == "chars":
        return F.length(col)
    if kind == "words":
        return F.size(F.filter(F.split(col, r"\s+"), lambda w: w != ""))
    return F.ceil(F.octet_length(col) / F.lit(4)).cast("int")


def detect_task(prompt: Column, signatures: tuple[tuple[str, str], ...] = ()) -> Column:
    """The task a prompt asks for: signatures on the text without white space,
    longest first, then fixed phrases, then keywords, then COMBINE_ALL."""
    bare = F.regexp_replace(prompt, r"(?U)\s+", "")
    upper = F.upper(prompt)
    found = F.when(prompt.isNull() | (prompt == ""), "COMBINE_ALL")
    for task, mark in sorted(signatures, key=lambda s: -len(s[1])):
        found = found.when(F.contains(bare, F.lit(mark)), task)
    # Phrases that tell a task.
    phrases = (
        ("COMBINE_ALL", "Therearethreetasksandthreerespectivedescriptions:"),
        ("NER-BEE_TRUE_ONLY", 'Printonly[true]inthe"is_relational"keyifarelationisdetected'),
        ("NER-BEE", "performabinaryclassificationofwhethertheentitypairhasarelation"),
        ("NER-NER", "classifytheentitypairintooneoftherelationsinthe<NER-NERRelationList>"),
        ("BEE-BEE", "classifytheentitypairin<CANDIDATE_PAIRS>intooneoftherelationsinthe<BEE-BEERelationList>"),
    )
    for task, phrase in phrases:
        found = found.when(F.contains(bare, F.lit(phrase)), task)
    # Keywords that tell a task.
    keywords = (("COMBINE_ALL", "COMBINE_ALL"), ("COMBINE_ALL", "THREE TASKS"), ("NER-BEE_TRUE_ONLY", "NER-BEE_TRUE_ONLY"), ("NER-BEE", "NER-BEE"), ("NER-BEE", "IS_RELATIONAL"), ("BEE-BEE", "BEE-BEE"), ("NER-NER", "NER-NER"))
    for task, word in keywords:
        found = found.when(F.contains(upper, F.lit(word)), task)
    return found.otherwise("COMBINE_ALL")
