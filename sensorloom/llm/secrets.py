"""Secret scans: three rules, and a sliding-window entropy test for secrets that no rule knows.

Everything is built from DataFrame functions. A rule's spans come from the lengths of what lies between its matches and
of the matches themselves; only rows in which a rule can match at all pay for that.

The entropy test takes candidate strings (long runs of key characters), sorts them into a character class, and slides a
window over each. The window's character counts and the sum of `c * log2(c)` over them are carried from one position to
the next: one character leaves, one enters, the sum changes by two table look-ups each. A candidate is reported from the
first window above its class's threshold to the end of the last. Candidates that overlap a rule's span, and those on the
allow-list (UUIDs, checksums that say so, placeholders), are not reported.
"""

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import quoted, text_of, whole_row

# The rules, in the order in which spans at one place are listed. Kind to pattern; the lengths that a
# match has to reach are part of the pattern, but for `assign`, where a short value uses up its text all the same.
RULES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
MIN_VALUE = 6
KINDS = [*RULES, "entropy"]

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
# Class to (what a candidate of the class matches, all of it; bits per character a window must reach); the first that fits
# counts. A window of 20 holds 4.32 bits at most. Runs of words with marks between them, and names put together from
# words, are in no class: keys without upper case, without lower case or without digits have to look the part.
CLASSES = {
    "hex": (("^[0-9a-fA-F]+$", "[0-9]", "[a-fA-F]"), 3.0),
    "base64": (("[0-9]", "[a-z]", "[A-Z]"), 3.7),
    "lower": (("^[0-9a-z]+$", "([0-9][^0-9]*){3}", "[a-z]"), 3.5),
    "upper": (("^[0-9A-Z]+$", "([0-9][^0-9]*){2}", "[A-Z]"), 3.4),
    "letters": (("^[a-zA-Z]+$", "^[A-Z]*([a-z]+[A-Z]+){4}"), 3.9),
}
ALLOWED = (
    r"(?i)example|sample|dummy|placeholder|changeme|xxxx|0000000"
    r"|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}|^sha(1|256|384|512)-"
)

# Counts of a window in numbers of 64 bits, five bits each.
_BITS, _PER_NUMBER = 5, 12
# Code points of a block of text.
_BLOCK = 1_024

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_SPAN = "array<struct<start:int,rank:int,end:int>>"


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id` and `spans`, an array of (start, kind, end) in code points, end exclusive, by start and then kind.

    A null text is empty and has no span; a null identifier is carried. Repeated rows are scanned one by one, other
    columns are ignored, an empty table gives an empty result.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), _ranked(text_of(text_col)).alias("spans"))
    return found.select("doc_id", F.transform("spans", _named).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[secret]") -> DataFrame:
    """The table with every span of the text, overlapping ones as one, replaced by `mask`; `n_chars`, where there is such
    a column, follows. A null text stays null."""
    text = F.col(quoted(text_col))
    packed = docs.select(whole_row(docs).alias("row"), text.alias("text"), _ranked(F.coalesce(text, F.lit(""))).alias("spans"))
    clean = F.when(F.size("spans") == 0, F.col("text")).otherwise(_without(F.col("text"), F.col("spans"), mask))
    packed = packed.withColumn("clean", clean)
    columns = {c: F.col("row").getField(c) for c in docs.columns}
    columns[text_col] = F.col("clean")
    if "n_chars" in columns and text_col != "n_chars":
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(F.size("spans") == 0, columns["n_chars"]).otherwise(F.length("clean").cast(kind))
    return packed.select(*(column.alias(c) for c, column in columns.items()))


def digests(spans: DataFrame) -> DataFrame:
    """The scan's result as counts per rule and as text: `kind:start:end`, comma-joined, and its checksum for the rules."""
    as_text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return spans.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in RULES),
        F.sha2(F.array_join(F.transform(base, as_text), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", as_text), ",").alias("spans"),
        count("entropy").alias("n_entropy"),
    )


def _named(span: Column) -> Column:
    kind = F.element_at(F.array(*map(F.lit, KINDS)), span["rank"] + 1)
    return F.struct(span["start"].alias("start"), kind.alias("kind"), span["end"].alias("end"))


def _ranked(text: Column) -> Column:
    """All spans by start, then kind, then end."""
    rules = F.concat(*(_rule_spans(text, rank) for rank in range(len(RULES))))
    added = _when(text, CANDIDATE, _entropy_spans(text, rules))
    return F.array_sort(F.concat(rules, added))


def _when(text: Column, pattern: str, spans: Column) -> Column:
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(_SPAN))


def _rule_spans(text: Column, rank: int) -> Column:
    kind, pattern = list(RULES.items())[rank]
    found = _matches(text, pattern, 1 if kind == "assign" else 0)
    if kind == "assign":
        found = F.filter(found, lambda m: F.length(m["value"]) >= MIN_VALUE)
    return _when(text, pattern, F.transform(found, lambda m: _span(m["start"], F.lit(rank), m["end"])))


def _span(start: Column, rank: Column, end: Column) -> Column:
    return F.struct(start.alias("start"), rank.alias("rank"), end.alias("end"))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """Every match's place and one of its groups: array of (start, end, value)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(whole)),
        F.arrays_zip(whole.alias("whole"), value.alias("value")),
        lambda before, m: F.struct(
            F.length(before).alias("gap"), F.length(m["whole"]).alias("length"), m["value"].alias("value")
        ),
    )
    lengths = lambda parts: F.transform(parts, lambda p: p["gap"] + p["length"])
    placed = lambda p, at: F.struct(
        (at + p["gap"]).alias("start"), (at + p["gap"] + p["length"]).alias("end"), p["value"].alias("value")
    )
    return _let(parts, lambda p: F.zip_with(p, _running(lengths(p), lambda x, y: x + y), placed))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is computed once, however often it is named."""
    return F.transform(F.array(value), then)[0]


def _running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What `merge`, of two integers, makes of all values before each, from 0 on. An array grows by copying, so it is done in
    groups: with as many groups as a group has values, the copying of `n` values is `n` to the power of 1.5."""

    def small(array: Column, begin: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(
            array,
            F.struct(begin.alias("total"), none.alias("before")),
            lambda state, x: F.struct(
                merge(state["total"], x).alias("total"), F.concat(state["before"], F.array(state["total"])).alias("before")
            ),
            lambda state: state["before"],
        )

    def grouped(array: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(array))), F.lit(1)).cast("int")
        last = F.floor(F.greatest(F.size(array) - 1, F.lit(0)) / size).cast("int")
        return _let(size, lambda n: F.transform(F.sequence(F.lit(0), last), lambda j: F.slice(array, j * n + 1, n)))

    zero = F.lit(0)
    totals = lambda groups: F.transform(groups, lambda g: F.aggregate(g, zero, merge))
    by_group = lambda groups: F.flatten(F.zip_with(groups, small(totals(groups), zero), small))
    return _let(values, lambda array: _let(grouped(array), by_group))


def _entropy_spans(text: Column, rules: Column) -> Column:
    found = _matches(text, CANDIDATE, 0)
    free = F.filter(
        found,
        lambda m: ~m["value"].rlike(ALLOWED)
        & _threshold(m["value"]).isNotNull()
        & ~F.exists(rules, lambda r: (r["start"] < m["end"]) & (r["end"] > m["start"])),
    )
    rank = F.lit(KINDS.index("entropy"))

    def span(m):
        return F.transform(
            F.array(_noisy(m["value"], _threshold(m["value"]))),
            lambda w: _span(m["start"] + w["first"], rank, m["start"] + w["last"]),
        )

    return F.filter(F.flatten(F.transform(free, span)), lambda s: s["end"] > s["start"])


def _threshold(value: Column) -> Column:
    bits = F.lit(None).cast("double")
    for patterns, least in reversed(CLASSES.values()):
        fits = functools.reduce(Column.__and__, (value.rlike(pattern) for pattern in patterns))
        bits = F.when(fits, F.lit(least)).otherwise(bits)
    return bits


def _noisy(value: Column, least: Column) -> Column:
    """From the first window at or above the threshold to the end of the last: (first, last), (0, 0) for none."""
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(_ALPHABET), c))
    weight = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)))
    of = lambda count: F.get(weight, count)
    moves = F.zip_with(
        codes,
        F.slice(F.concat(F.array_repeat(F.lit(0), WINDOW), codes), 1, F.size(codes)),
        lambda entering, leaving: F.struct(entering.alias("entering"), leaving.alias("leaving")),
    )

    place = lambda code: ((code - 1) / _PER_NUMBER).cast("int")
    shift = lambda code: (code - 1) % _PER_NUMBER * _BITS
    one = lambda code: F.call_function("shiftleft", F.lit(1).cast("bigint"), shift(code))

    def count(state, code):
        number = F.coalesce(F.get(state["counts"], place(code)), F.lit(0).cast("bigint"))
        return F.call_function("shiftright", number, shift(code)).bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def step(state, move):
        leaving, entering = move["leaving"], move["entering"]
        left = count(state, leaving)
        there = count(state, entering) - F.when(leaving == entering, 1).otherwise(0)
        total = (
            state["total"]
            - F.when(leaving > 0, of(left) - of(left - 1)).otherwise(F.lit(0.0))
            + of(there + 1)
            - of(there)
        )
        counts = F.transform(
            state["counts"],
            lambda number, at: number
            + F.when(at == place(entering), one(entering)).otherwise(0)
            - F.when((leaving > 0) & (at == place(leaving)), one(leaving)).otherwise(0),
        )
        at = state["at"] + 1
        high = (at >= WINDOW) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= least)
        return F.struct(
            at.alias("at"),
            counts.alias("counts"),
            total.alias("total"),
            F.when(high & (state["last"] == 0), at - WINDOW).otherwise(state["first"]).alias("first"),
            F.when(high, at).otherwise(state["last"]).alias("last"),
        )

    start = F.struct(
        F.lit(0).alias("at"),
        F.array_repeat(F.lit(0).cast("bigint"), -(-len(_ALPHABET) // _PER_NUMBER)).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0).alias("first"),
        F.lit(0).alias("last"),
    )
    return F.aggregate(moves, start, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def _without(text: Column, spans: Column, mask: str) -> Column:
    """The text between the spans, with one mask for each stretch of overlapping or touching ones. Text is cut from blocks, so
    a cut does not count from the text's beginning."""

    def cut(blocks: Column, begin: Column, end: Column) -> Column:
        first, last = (begin / _BLOCK).cast("int"), (F.greatest(end - 1, F.lit(0)) / _BLOCK).cast("int")
        head = F.substring(F.get(blocks, first), begin % _BLOCK + 1, F.least(end - begin, F.lit(_BLOCK)))
        inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        tail = F.when(last > first, F.substring(F.get(blocks, last), F.lit(1), end - last * _BLOCK)).otherwise("")
        return F.when(end > begin, F.concat(head, inner, tail)).otherwise("")

    def joined(blocks: Column) -> Column:
        # A span that begins where others have reached belongs to their stretch.
        reached = _running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        before = F.zip_with(
            spans,
            reached,
            lambda s, at: F.when((s["start"] > at) | (at == 0), F.concat(cut(blocks, at, s["start"]), F.lit(mask))).otherwise(""),
        )
        end = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(before, ""), cut(blocks, end, F.length(text)))

    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0)), joined)
