"""Model input and output text: JSON pairs, prompt sections, chat transcripts."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text


def _entry(pair: Column, key: str, value: Column, indent: str) -> Column:
    s = F.lit
    inner = indent + "  "
    return F.concat(
        s(f'{indent}{{\n{inner}"pair_id": '), text.json_string(text.bracketed(pair["pair_id"])),
        s(f',\n{inner}"subject": '), text.json_string(text.tight_tags(pair["subject"])),
        s(f',\n{inner}"{key}": '), value,
        s(f',\n{inner}"object": '), text.json_string(text.tight_tags(pair["object"])),
        s(f"\n{indent}}}"),
    )


def _listed(entries: Column, indent: str) -> Column:
    return F.when(F.size(entries) == 0, F.lit("[]")).otherwise(F.concat(F.lit("[\n"), F.array_join(entries, ",\n"), F.lit(f"\n{indent}]")))


def io_json(chunks: DataFrame) -> DataFrame:
    """One row per chunk: ``input`` (text and pairs with a null relation) and
    ``output`` (pairs with labels), indented by two, non-ASCII kept.

    ``chunks``: task, origin_id, chunk_id, text, pos, pair_id, subject, object, relation.
    """
    packed = chunks.groupBy("task", "origin_id", "chunk_id").agg(F.first("text").alias("text"), F.array_sort(F.collect_list(F.struct("pos", "pair_id", "subject", "object", "relation"))).alias("pairs"))
    made = []
    for binary in (True, False):
        key = "is_relational" if binary else "relation"
        task = F.lit("ner_bee" if binary else "ner_ner")
        blank = F.transform("pairs", lambda p: _entry(p, key, F.lit("null"), "    "))
        full = F.transform("pairs", lambda p: _entry(p, key, text.json_string(labels.binary_label(task, labels.normalize_negative(p["relation"]))), "  "))
        made.append((F.concat(F.lit('{\n  "text": '), text.json_string(F.coalesce("text", F.lit(""))), F.lit(',\n  "candidate_pairs": '), _listed(blank, "  "), F.lit("\n}")), _listed(full, "")))
    is_binary = F.col("task").isin("ner_bee", "ner_bee_true_only")
    return packed.select("task", "origin_id", "chunk_id", F.when(is_binary, made[0][0]).otherwise(made[1][0]).alias("input"), F.when(is_binary, made[0][1]).otherwise(made[1][1]).alias("output"))


def fewshot_block(examples: Column) -> Column:
    """Numbered examples of (input, output) structs, each closed by a rule of 30 dashes."""
    return F.array_join(
        F.transform(examples, lambda x, i: F.concat(F.lit("### Example "), (i + 1).cast("string"), F.lit("\n"), x["input"], F.lit("\n### Example "), (i + 1).cast("string"), F.lit(" Response\n"), x["output"], F.lit("\n" + "-" * 30))),
        "\n",
    )


def prompt(description: Column, fewshot: Column, output_format: Column, body: Column) -> Column:
    """Titled sections joined by a blank line; empty ones are left out."""
    def section(title: str, col: Column) -> Column:
        return F.when(F.coalesce(col, F.lit("")) != "", F.concat(F.lit(f"### {title}:\n"), col))

    return F.concat_ws("\n\n", section("Description", description), section("Few-shot Examples", fewshot), section("Output Format", output_format), section("Input", body))


def answer(output: Column) -> Column:
    return F.concat(F.lit("### Response:\n"), output)


def plain_transcript(system: Column, user: Column, reply: Column) -> Column:
    return F.concat(system, F.lit("\n\n"), user, F.lit("\n---\n"), reply)


def chat(messages: Column, generation: bool = False, thinking: bool = False) -> Column:
    """A transcript of (role, content) structs.  A leading system or developer
    message, or thinking, makes a system turn; replies lose their thinking."""
    first = F.try_element_at(messages, F.lit(1))
    leads = F.coalesce(first["role"].isin("system", "developer"), F.lit(False))
    think = "<|think|>" if thinking else ""
    head = F.when(leads | F.lit(thinking), F.concat(F.lit(f"<|turn>system\n{think}"), F.when(leads, labels.strip(first["content"])).otherwise(F.lit("")), F.lit("<turn|>\n"))).otherwise(F.lit(""))
    rest = F.when(leads, F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1)))).otherwise(messages)

    def turn(m: Column) -> Column:
        model = m["role"].isin("assistant", "model")
        return F.concat(F.lit("<|turn>"), F.when(model, "model").otherwise(m["role"]), F.lit("\n"), F.when(model, text.strip_thinking(m["content"])).otherwise(labels.strip(m["content"])), F.lit("<turn|>\n"))

    tail = "<|turn>model\n" if generation else ""
    return F.concat(F.lit("<bos>"), head, F.array_join(F.transform(rest, turn), ""), F.lit(tail))


def chats(turns: DataFrame, **options) -> DataFrame:
    """conv_id, transcript of the turns in order."""
    packed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.coalesce("text", F.lit("")).alias("content")))).alias("m"))
    return packed.select("conv_id", chat(F.transform("m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))), **options).alias("transcript"))


def within(rows: DataFrame, columns: tuple[str, ...], limit: int, kind: str = "bytes4") -> DataFrame:
    """Rows whose texts together have at most ``limit`` tokens."""
    return rows.where(text.token_len(F.concat(*[F.coalesce(c, F.lit("")) for c in columns]), kind) <= limit)


def overhead(rendered: DataFrame, column: str, limit: int, buffer: int, kind: str = "bytes4") -> DataFrame:
    """task, overhead (longest empty rendering + 20) and safe_limit."""
    return rendered.groupBy("task").agg((F.max(text.token_len(F.col(column), kind)) + 20).alias("overhead")).withColumn("safe_limit", F.lit(limit) - F.col("overhead") - buffer)
