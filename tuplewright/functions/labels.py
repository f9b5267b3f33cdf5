"""Label normalisation and routing, as column expressions."""
from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import dims


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def strip(col: Column) -> Column:
    """Unicode-aware trim, as the pattern engine's white space knows it."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def normalize_negative(rel: Column) -> Column:
    """Null and any spelling of a negative -> NO_RELATION; else unchanged, not even trimmed."""
    plain = F.replace(F.lower(strip(rel)), F.lit(" "), F.lit("_"))
    return F.when(rel.isNull() | plain.isin(*dims.NEGATIVE_FORMS), F.lit(dims.NEGATIVE)).otherwise(rel)


def normalize_attribute(rel: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.ATTRIBUTE_LABELS), rel), rel)


def is_attribute(rel: Column) -> Column:
    return rel.isin(*dims.ATTRIBUTE_LABELS, *dims.ATTRIBUTE_LABELS.values())


def source_of(has_meta: Column, source: Column) -> Column:
    """A pair without metadata counts as NER; a null source stays null and routes nowhere."""
    return F.when(has_meta, F.upper(source)).otherwise(F.lit("NER"))


def bucket(subject: Column, object_: Column) -> Column:
    both = F.concat_ws("-", F.coalesce(subject, F.lit("NONE")), F.coalesce(object_, F.lit("NONE")))
    return F.when(both == "NER-NER", "ner_ner").when(both.isin("NER-BEE", "BEE-NER"), "ner_bee")


def routed_relation(subject: Column, object_: Column, rel: Column) -> Column:
    """The relation in its bucket; null if the pair is dropped there."""
    plain = normalize_negative(rel)
    mapped = F.try_element_at(literal_map(dims.ATTRIBUTE_TO_RELATION), plain)
    between = F.coalesce(mapped, F.when(~is_attribute(plain), plain))
    where = bucket(subject, object_)
    return F.when(where == "ner_ner", between).when((where == "ner_bee") & (subject == "BEE"), F.lit(dims.NEGATIVE)).when(where == "ner_bee", normalize_attribute(plain))


def binary_label(task: Column, rel: Column) -> Column:
    return F.when(task.isin("ner_bee", "ner_bee_true_only"), F.when(rel == dims.NEGATIVE, "false").otherwise("true")).otherwise(rel)


def profile_label(task: Column, rel: Column) -> Column:
    return F.when(task.isin("ner_bee", "ner_bee_true_only"), F.when(rel == dims.NEGATIVE, "__bee_false__").otherwise("__bee_true__")).otherwise(rel)


def task_name(task: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(dims.TASK_NAMES), F.lower(task)), F.lit("COMBINE_ALL"))
