"""Secret scan with DataFrame functions only (operator 8).

Base kinds are found by fixed patterns: ``assign`` (a credential name, ``=`` or
``:`` and a value of 12 or more characters), ``access`` (``AKIA`` keys of 18 or
more) and ``hex`` (runs of 16 or more). The method adds ``entropy`` spans:
candidate strings are judged by the Shannon entropy of a sliding window of
``WINDOW`` characters, per character class, with the count of each character
and the sum of c*log2(c) updated as one character enters and one leaves; runs
of windows above the threshold of their class are one span. Placeholder words between
separators cut a candidate into segments, segments that an allow-list pattern matches
are not looked at, and spans inside a base span are not added.

Positions come from ``split``: the pieces between the matches of a pattern and
the matches themselves alternate, so running sums of their lengths are the
starts and ends, in code points. Arrays are folded in slices of ``SLICE``, so a text
takes time in proportion to its matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vartab.llm.common import fresh, text_or_empty

# The contract's patterns. A failing (too short) access or hex
# match is a whole run, so the least length can stand in the pattern; a failing
# assign match may swallow the name of a later one, so it is filtered afterwards.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"


@dataclass(frozen=True)
class CharClass:
    """Candidates that match ``pattern`` whole; windows of at least ``bits`` count."""

    name: str
    pattern: str
    alphabet: str
    bits: float


# First matching class wins. Window entropy cannot exceed log2(20) = 4.32.
CLASSES = (
    CharClass("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdefABCDEF", 2.9),
    CharClass("base64", r"^[A-Za-z0-9+/_=-]+$",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.7),
)
# Words that stand for a secret; between separators or ends they cut a candidate.
PLACEHOLDER = (r"(?i:example|sample|placeholder|changeme|your|x{4,}"
               r"|(?:0123456789|abcdef(?:ghijklmnopqrstuvwxyz)?)+[0-9]{0,9})")
_SEP, _ALNUM = "[+/_=-]", "[A-Za-z0-9]"
_PIECE = rf"(?<!{_ALNUM})(?!{PLACEHOLDER}(?!{_ALNUM})){_ALNUM}+"
SEGMENT = rf"{_SEP}*{_PIECE}(?:{_SEP}+{_PIECE})*{_SEP}*"
# Not secrets: numbers, dates and ids of digits, rules of dashes; UUIDs; paths of
# lower-case words and short numbers; and words (no digit), unless the case of their
# letters changes as at random.
ALLOW = (
    r"^[0-9_=+/-]*$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[a-z]+(?:[/_-](?:[a-z]+[0-9]{0,4}|[0-9]{1,8}))+$",
)
WORDS, RANDOM_CASE = r"^[^0-9]*$", r"(?:[A-Z][a-z]{1,2}|[a-z][A-Z]{1,2}){3}"

SLICE = 256

SPANS = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once (what a lambda refers to otherwise is
    evaluated per element)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _slices(items: Column) -> Column:
    """An array as an array of arrays of at most ``SLICE``."""
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / SLICE).cast("int")),
                                                 lambda k: F.slice(items, k * SLICE + 1, F.lit(SLICE)))).otherwise(F.array())


def _fold(items: Column, state: Column, none: Column, step) -> Column:
    """All that ``step(state, item) -> (state, array of outputs)`` puts out over an array,
    in order. Appending copies what is there, so outputs are gathered by slice and the
    slices joined: time in proportion to the array, not to its square."""
    def part(before: Column, xs: Column) -> Column:
        def one(s: Column, x: Column) -> Column:
            after, more = step(s["state"], x)
            return F.struct(after.alias("state"), F.concat(s["out"], more).alias("out"))
        return F.aggregate(xs, F.struct(before.alias("state"), none.alias("out")), one)

    def whole(xs: Column) -> Column:
        return F.aggregate(
            _slices(xs), F.struct(state.alias("state"), F.slice(F.array(none), 1, 0).alias("outs")),
            lambda s, some: _let(part(s["state"], some), lambda p: F.struct(
                p["state"].alias("state"), F.concat(s["outs"], F.array(p["out"])).alias("outs"))),
            lambda s: F.flatten(s["outs"]))
    return _let(items, whole)


def _found(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    zipped = F.filter(F.arrays_zip(gaps.alias("gap"), values.alias("value")), lambda z: z["value"].isNotNull())

    def step(at: Column, m: Column) -> tuple[Column, Column]:
        start = at + m["gap"]
        end = start + F.length(m["value"])
        return end, F.array(F.struct(start.alias("start"), end.alias("end"), m["value"].alias("value")))

    # most texts have no match: one search instead of an extraction and a split
    return F.when(F.regexp_like(text, F.lit(pattern)), _fold(zipped, F.lit(0), none, step)).otherwise(none)


def _of_kind(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def _assign(text: Column) -> Column:
    """Assign spans whose value (group 1 of a second, aligned extraction) is long enough."""
    sizes = F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), F.length)
    zipped = F.arrays_zip(_found(text, ASSIGN).alias("span"), sizes.alias("size"))
    kept = F.filter(zipped, lambda z: z["span"].isNotNull() & (z["size"] >= ASSIGN_LEAST))
    return F.when(F.regexp_like(text, F.lit(ASSIGN)), F.transform(kept, lambda z: z["span"])).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))


def entropy_runs(value: Column, cls: CharClass, window: int = WINDOW) -> Column:
    """array<struct<start, end>> of offsets in ``value``: the unions of touching
    windows with an entropy of at least ``cls.bits``.

    One step per character: the counts of the window change by the character
    that enters and the one that leaves, the sum of c*log2(c) by four look-ups.
    Entropy is log2(w) - sum / w, so the threshold is one on the sum."""
    xlogx = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 1)])
    most = window * (math.log2(window) - cls.bits) + 1e-9
    codes = F.transform(F.slice(F.split(value, ""), 1, F.length(value)),
                        lambda c: F.instr(F.lit(cls.alphabet), c) - 1)
    steps = F.slice(F.arrays_zip(
        F.sequence(F.lit(0), F.length(value) - 1).alias("i"), codes.alias("enters"),
        F.concat(F.array_repeat(F.lit(-1), window), codes).alias("leaves")), 1, F.length(value))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(s: Column, x: Column) -> Column:
        i, enters, leaves = x["i"], x["enters"], x["leaves"]
        same = enters == leaves
        n_in, n_out = F.get(s["counts"], enters), F.get(s["counts"], leaves)
        counts = F.transform(s["counts"], lambda c, j: c + F.when(same, 0).when(j == enters, 1).when(
            j == leaves, -1).otherwise(0))
        total = s["total"] + F.when(same, 0.0).otherwise(
            F.get(xlogx, n_in + 1) - F.get(xlogx, n_in) + F.coalesce(
                F.get(xlogx, n_out - 1) - F.get(xlogx, n_out), F.lit(0.0)))
        first = i - (window - 1)
        touches = F.coalesce(F.get(s["runs"], F.size(s["runs"]) - 1)["end"] >= first, F.lit(False))
        longer = F.concat(
            F.slice(s["runs"], 1, F.greatest(F.size(s["runs"]) - 1, F.lit(0))),
            F.array(F.struct(F.get(s["runs"], F.size(s["runs"]) - 1)["start"].alias("start"), (i + 1).alias("end"))))
        another = F.concat(s["runs"], F.array(F.struct(first.alias("start"), (i + 1).alias("end"))))
        runs = F.when((first < 0) | (total > most), s["runs"]).when(touches, longer).otherwise(another)
        return F.struct(counts.alias("counts"), total.alias("total"), runs.alias("runs"))

    zero = F.struct(F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"),
                    F.lit(0.0).alias("total"), none.alias("runs"))
    return F.aggregate(steps, zero, step, lambda s: s["runs"])


def _entropy(text: Column, base: Column) -> Column:
    """array<struct<start, kind, end>> of the entropy spans that are in no base span."""
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def runs_of(seg: Column) -> Column:
        runs = empty
        for cls in reversed(CLASSES):
            runs = F.when(F.regexp_like(seg["value"], F.lit(cls.pattern)), entropy_runs(seg["value"], cls)).otherwise(runs)
        words = F.regexp_like(seg["value"], F.lit(WORDS)) & ~F.regexp_like(seg["value"], F.lit(RANDOM_CASE))
        for allowed in (words, *(F.regexp_like(seg["value"], F.lit(p)) for p in ALLOW)):
            runs = F.when(allowed, empty).otherwise(runs)
        return F.transform(runs, lambda r: F.struct((seg["start"] + r["start"]).alias("start"), (seg["start"] + r["end"]).alias("end")))

    def spans(m: Column) -> Column:
        segments = F.filter(_found(m["value"], SEGMENT), lambda g: F.length(g["value"]) >= WINDOW)
        return F.transform(F.flatten(F.transform(segments, runs_of)), lambda r: F.struct(
            (m["start"] + r["start"]).alias("start"), F.lit(1).alias("added"), (m["start"] + r["end"]).alias("end")))

    def uncovered(found: Column) -> Column:
        """In order of starts, a span lies in a base span if one that started before it,
        or with it, ends as late."""
        known = F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("added"), b["end"].alias("end")))
        none = F.array().cast(SPANS)

        def step(reach: Column, x: Column) -> tuple[Column, Column]:
            kept = (x["added"] == 1) & (x["end"] > reach)
            span = F.struct(x["start"].alias("start"), F.lit(KINDS.index("entropy")).alias("kind"), x["end"].alias("end"))
            return F.when(x["added"] == 0, F.greatest(reach, x["end"])).otherwise(reach), F.when(kept, F.array(span)).otherwise(none)

        return F.when(F.size(found) > 0, _fold(F.array_sort(F.concat(known, found)), F.lit(-1), none, step)).otherwise(none)

    return _let(F.flatten(F.transform(_found(text, CANDIDATE), spans)), uncovered)


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["kind"]), s["start"], s["end"])))


def with_spans(docs: DataFrame, text_col: str = "text", base_col: str = "base_spans",
               spans_col: str = "spans") -> DataFrame:
    """``docs`` with two arrays of (start, kind, end), sorted: the base spans and
    all spans. ``kind`` is an index into KINDS; positions are code points.

    Defined cases: a null or empty text has no spans; spans of different kinds
    may overlap (a hex value inside an assignment is both); a text may hold any
    number of matches of any length; rows are judged one
    by one, so repeated rows and ids need no rule; an empty table stays empty.
    The two result columns replace columns of the same name."""
    text = text_or_empty(text_col)
    base = F.concat(_of_kind(_assign(text), "assign"), _of_kind(_found(text, ACCESS), "access"),
                    _of_kind(_found(text, HEX), "hex"))
    return (docs.withColumn(base_col, F.array_sort(base.cast(SPANS)))
            .withColumn(spans_col, F.array_sort(F.concat(F.col(base_col), _entropy(text, F.col(base_col)).cast(SPANS)))))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every row: counts per base kind, digest of the base spans, all
    spans as text. Extra columns of the input are dropped, so none can clash."""
    rows = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    count = lambda kind: F.size(F.filter(
        "base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")
    return rows.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), F.sha2(_listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index("entropy"))).cast("long").alias("n_entropy"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span (overlapping ones joined) replaced by ``mark``.
    All columns and their order stay; a text without spans, a null one included,
    is returned as it was."""
    text = text_or_empty(text_col)
    base, spans = fresh(docs, "_secret_base"), fresh(docs, "_secret_spans")
    work = with_spans(docs, text_col, base, spans)
    def cleaned_part(before: Column, some: Column) -> Column:
        """The text from ``before`` to the end of some spans, which lie within it: the
        parts are cut from that stretch alone, as a cut takes time up to its place."""
        stop = F.greatest(before, F.array_max(F.transform(some, lambda x: x["end"])))
        return _let(F.substring(text, before + 1, stop - before), lambda own: F.aggregate(
            some, F.struct(before.alias("at"), F.array().cast("array<string>").alias("parts")),
            lambda s, x: F.struct(
                F.greatest(s["at"], x["end"]).alias("at"),
                F.when((x["start"] < s["at"]) & (s["at"] > 0), s["parts"]).otherwise(F.concat(s["parts"], F.array(
                    F.concat(F.substring(own, s["at"] - before + 1, x["start"] - s["at"]), F.lit(mark))))).alias("parts"))))

    blank = F.aggregate(
        _slices(F.col(spans)), F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda s, some: _let(cleaned_part(s["at"], some), lambda p: F.struct(
            p["at"].alias("at"), F.concat(s["parts"], F.array(F.concat_ws("", p["parts"]))).alias("parts"))),
        lambda s: F.concat(F.concat_ws("", s["parts"]), F.substring(text, s["at"] + 1, F.length(text))))
    cleaned = F.when(F.size(spans) > 0, blank).otherwise(F.col(text_col))
    return work.select(*[cleaned.alias(c) if c == text_col else F.col(c) for c in docs.columns])
