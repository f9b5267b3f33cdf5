"""Personal data: patterns propose spans, checksums confirm, context scores.

Only DataFrame functions: no Python runs on the executors.

* Proposals: leftmost non-overlapping matches of one pattern per kind.  Java's
  engine would recurse or rescan on hostile texts, so the patterns are written
  with possessive groups and with look-behinds that forbid starts at which a
  match is impossible because the same run of characters failed before; what
  they match is what the plain patterns match.
* Checks: octets up to 255 (ip), 14 to 19 digits passing Luhn (card), 10 to 15
  digits (phone), mod-97 (iban).  A failing match is dropped, not retried.
* Score: a prior per kind, plus ``CONTEXT_BONUS`` if one of the kind's context
  words stands within ``CONTEXT_CHARS`` code points on either side.  Kinds of
  weak shape (ssn) have a prior below ``min_score`` and need their context.

``find_pii`` returns one row per input row: the id and ``spans``, an array of
(kind, start, end, score) in code points, end exclusive, by start, then kind in
the order of ``KINDS``.  A null text counts as empty and has no spans; null ids
and repeated rows are kept; other columns are ignored; no rows give no rows.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, pick, text_or_empty

CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.35
#: Elements in a run of the two-level prefix sums.
RUN = 512
#: Code points of a block of a text that is redacted.
BLOCK = 4096

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A cheap pattern that every text with a match contains.
    hint: str
    prior: float
    context: tuple[str, ...] = field(default=())


KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, ("mail", "contact", "write")),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, ("ip", "server", "host", "address")),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "", 0.7, ("card", "credit", "visa", "pay")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, ("phone", "call", "tel", "mobile", "fax")),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "", 0.8, ("iban", "bank", "account", "konto")),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, ("ssn", "social security")),
)
BASE_KINDS = ("email", "ip", "card", "phone")
_ORDER = {k.name: i for i, k in enumerate(KINDS)}
_EMPTY = "array<struct<start:int,ord:int,end:int,score:double>>"


def _running(values: Column, combine, into: str = "array<int>") -> Column:
    """Inclusive running sums or maxima of an int array from 0 on, in runs of ``RUN``
    elements so that appending stays cheap for very long arrays."""

    def running(xs: Column, start: Column) -> Column:
        first = F.struct(start.alias("so_far"), F.array().cast(into).alias("all"))
        return F.aggregate(xs, first, lambda a, x: F.struct(combine(a["so_far"], x).alias("so_far"), F.concat(a["all"], F.array(combine(a["so_far"], x))).alias("all")), lambda a: a["all"])

    def by_runs(xs: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / RUN).cast("int")), lambda k: F.slice(xs, k * RUN + 1, RUN))
        return let(runs, lambda rs: let(running(F.transform(rs, lambda r: F.aggregate(r, F.lit(0), combine)), F.lit(0)), lambda ends: F.flatten(F.transform(rs, lambda r, k: running(r, F.when(k == 0, F.lit(0)).otherwise(F.element_at(ends, k)))))))

    return let(values, lambda xs: F.when(F.size(xs) == 0, F.array().cast(into)).otherwise(by_runs(xs)))


def _cumulative(lengths: Column) -> Column:
    return _running(lengths, lambda a, x: a + x)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + let(
            F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"),
            lambda d: F.when(i % 2 == 1, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2),
        ),
    )
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN without spaces has remainder 1: letters count as 10 to 35."""

    def remainder(turned: Column) -> Column:
        return F.aggregate(
            F.filter(F.split(turned, ""), lambda c: c != ""),
            F.lit(0),
            lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
        )

    return let(F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4))), remainder) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return let(_digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return let(F.replace(match, F.lit(" "), F.lit("")), lambda s: F.when(F.length(s).between(15, 34), mod97(s)).otherwise(F.lit(False)))
    return F.lit(True)


def _score(kind: Kind, text: Column, start: Column, end: Column) -> Column:
    if not kind.context:
        return F.lit(kind.prior)
    around = F.lower(F.concat_ws(" ", F.substr(text, F.greatest(start - CONTEXT_CHARS, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT_CHARS))), F.substr(text, end + 1, F.lit(CONTEXT_CHARS))))
    words = "|".join(kind.context)
    return F.when(around.rlike(rf"\b(?:{words})"), F.least(F.lit(1.0), F.lit(kind.prior + CONTEXT_BONUS))).otherwise(F.lit(kind.prior))


def _spans(text: Column, kind: Kind, min_score: float) -> Column:
    rx = F.lit(kind.pattern)
    none = F.array().cast(_EMPTY)

    def placed(matches: Column) -> Column:
        # The parts between matches give the places: end k = sum of parts and matches up to k.
        parts = F.split(text, kind.pattern, -1)
        steps = let(parts, lambda ps: F.zip_with(F.slice(ps, 1, F.size(matches)), matches, lambda p, m: F.length(p) + F.length(m)))
        return let(
            F.filter(F.zip_with(matches, _cumulative(steps), lambda m, e: F.struct(m.alias("m"), e.alias("e"))), lambda s: _confirmed(kind.name, s["m"])),
            lambda good: F.filter(
                F.transform(
                    good,
                    lambda s: F.struct(
                        (s["e"] - F.length(s["m"])).cast("int").alias("start"),
                        F.lit(_ORDER[kind.name]).alias("ord"),
                        s["e"].cast("int").alias("end"),
                        _score(kind, text, s["e"] - F.length(s["m"]), s["e"]).cast("double").alias("score"),
                    ),
                ),
                lambda s: s["score"] >= min_score,
            ),
        )

    found = let(F.regexp_extract_all(text, rx, F.lit(0)), lambda m: F.when(F.exists(m, lambda x: _confirmed(kind.name, x)), placed(m)).otherwise(none))
    return F.when(F.contains(text, F.lit(kind.hint)), found).otherwise(none) if kind.hint else found


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    base = pick(docs, id=id_col, text=text_col).withColumn("text", text_or_empty("text"))
    return base.select(F.col("id").alias(id_col), _named(_all_spans(F.col("text"), min_score)).alias("spans"))


def _all_spans(text: Column, min_score: float) -> Column:
    return F.array_sort(F.concat(*[_spans(text, k, min_score) for k in KINDS]))


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.transform(spans, lambda s: F.struct(F.get(names, s["ord"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["score"].alias("score")))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        id_col,
        *[count(k) for k in BASE_KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redacted(text: Column, min_score: float = 0.5) -> Column:
    """The text with every span replaced by ``<KIND>``; of spans that
    overlap, the first by start names the place and the rest are taken with it.

    The text is cut into blocks once and every piece between spans is taken from its
    own blocks, so the work is in proportion to the text, however many spans it has."""
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(parts: Column, begin: Column, end: Column) -> Column:
        first, last = F.floor(begin / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
        return F.substr(F.array_join(F.slice(parts, first + 1, last - first + 1), ""), begin % BLOCK + 1, end - begin)

    def build(spans: Column, parts: Column, ends: Column) -> Column:
        def placed(s: Column, k: Column) -> Column:
            return F.struct(F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1)).alias("at"), s["start"].alias("start"), s["kind"].alias("kind"))

        kept = F.filter(F.transform(spans, placed), lambda s: s["start"] >= s["at"])
        told = F.transform(kept, lambda s: F.concat(piece(parts, s["at"], s["start"]), F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        return F.concat(F.array_join(told, ""), piece(parts, F.element_at(ends, -1), F.length(text)))

    def made(spans: Column) -> Column:
        ends = _running(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        return F.when(F.size(spans) == 0, text).otherwise(let(blocks, lambda parts: let(ends, lambda es: build(spans, parts, es))))

    return let(_named(_all_spans(text, min_score)), made)
