"""Audit of filters that are applied one after another: what each removes, in every order.

Five filters judge a document, so everything an audit asks of any order follows from how many documents fail which of
them: counts per part, set of failed filters (a mask of five bits) and label. Those counts add up, whatever the task.

Four filters look at one text. The fifth, "the same text as a smaller identifier's", needs the whole table, but only
texts that occur twice can fail it:

1. *Sketches.* Each task counts its texts' hashes in a counting Bloom filter, in which a counter says 0, 1 or "2 or more".
   Tasks hand on the counters they touched, segment by segment, and sketches merge by adding, saturated.
2. *Prepass.* A text with any counter of 1 is unique for certain. Only the others, true repeats and a few chance ones, are
   shuffled, in full and folded per task, for the smallest identifier of each text.
3. *Counts.* A possible repeat fails unless its text's smallest identifier is its own; flags join labels and are counted.

The sketch takes `COUNTERS` per document, and `MOST_COUNTERS` at most, which bounds what is broadcast. Beyond that bound
more unique texts pass as possible repeats and are shuffled; the result is the same at every size.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import SPACE, stored, text_of

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # percent of words
MAX_CAPITALS = 3  # percent of code points
SYMBOLS = r"[#$%&*|]"

# Counters per document, and probes per text: one unique text in 30 looks like a repeat.
COUNTERS, PROBES = 8, 3
# 32 MB at two bits each.
MOST_COUNTERS = 1 << 27
# Counters per segment: one row of the sketch, 32 to a 64-bit word.
SEGMENT = 1 << 12
_PER_WORD = 32
# Texts whose counters a task gathers before it hands them on.
FOLDED = 500_000


def audit(docs: DataFrame, labels: DataFrame, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """One row per `part` (each `lang`; null is the empty string), `filter_order` and `step`: `kept`, `removed`, `redundant`,
    `unique_fails`, `good_lost`, `toxic_lost`, `shapley`.

    A null text is empty, and so equal to other empty ones. A row with a null `doc_id` never fails E and makes no other row
    fail it, as it is neither smaller nor larger than another; rows that share the smallest identifier of a text all pass E.
    Repeated rows count as often as they occur. Several labels of one document count as one that has any of their ones; a
    null identifier has no label. Other columns are ignored; an empty table gives an empty result.
    """
    return interactions(mask_counts(flagged(docs, most_counters), labels))


def flagged(docs: DataFrame, most_counters: int = MOST_COUNTERS) -> DataFrame:
    """`doc_id`, `part`, `mask` (bit i: filter i fails) and `n` rows alike."""
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_of("text").alias("text"))
    texts = texts.withColumn("hash", F.xxhash64("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    facts = stored(texts.select("doc_id", "part", _own_mask(F.col("text")).alias("mask"), "hash", digest))
    counters = _counters(facts.count(), most_counters)
    sketch = merged_sketch(facts, counters)
    repeated = _asked(texts.where("doc_id is not null"), sketch, counters).where("possible")
    firsts = repeated.groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.select("doc_id", digest, F.lit(True).alias("first"))
    # Of one identifier, a digest says which of its rows' texts is meant.
    asked = _asked(facts, sketch, counters)
    possible = F.when(F.col("possible") & F.col("doc_id").isNotNull(), F.col("digest"))
    rows = asked.groupBy("doc_id", "part", "mask", possible.alias("digest")).agg(F.count("*").alias("n"))
    rows = rows.join(firsts.hint("merge"), ["doc_id", "digest"], "left")
    repeats = F.col("digest").isNotNull() & F.col("first").isNull()
    mask = F.col("mask") + F.when(repeats, 1 << FILTERS.index("E")).otherwise(0)
    return rows.select("doc_id", "part", mask.cast("int").alias("mask"), "n")


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Per `part` and `mask`: documents `n`, and of those `good` and `toxic` ones."""
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic")
    )
    joined = flags.join(marks, "doc_id", "left")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("is_good").alias("good"), of("is_toxic").alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """The audit of all orders from the counts of all masks: 600 rows per part, from at most 32."""
    masks = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    steps = masks.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " ")))
    steps = steps.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bit_of = lambda letter: F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)
    letters = F.split(F.expr("substring(filter_order, 1, step - 1)"), "")
    before = F.aggregate(F.filter(letters, lambda x: x != ""), F.lit(0), lambda total, x: total + bit_of(x))
    steps = steps.withColumns({"bit": bit_of(F.expr("substring(filter_order, step, 1)")), "before": before})

    def total(condition, value="n") -> Column:
        kept = F.filter("masks", lambda m: condition(m["mask"]))
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda s, m: s + (value(m) if callable(value) else m[value]))

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    passed = lambda m: m.bitwiseAND(F.col("before")) == 0
    removed = lambda m: fails(m) & passed(m)
    # Of a document's failed filters, each is the first in an equal share of the orders.
    share = lambda m: m["n"] * (F.lit(len(orders)) / F.bit_count(m["mask"])).cast("bigint")
    return steps.select(
        "part",
        "filter_order",
        "step",
        total(lambda m: passed(m) & ~fails(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & ~passed(m)).alias("redundant"),
        total(lambda m: m == F.col("bit")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        total(fails, share).alias("shapley"),
    )


def _own_mask(text: Column) -> Column:
    """The filters that look at one text."""
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    count = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        count < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * count,
        100 * capitals > MAX_CAPITALS * F.length(text),
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(fails)]
    return sum(bits[1:], bits[0]).cast("int")


# ---------------------------------------------------------------------------------------------------------------------
# The sketch


def _counters(documents: int, most: int) -> int:
    """Whole segments, a power of two of them."""
    segments = 1 << (-(-COUNTERS * max(documents, 1) // SEGMENT) - 1).bit_length()
    while segments > 1 and segments * SEGMENT > most:
        segments //= 2
    return segments * SEGMENT


def _place(value: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """Segment and probes of hashes: all counters of a text lie in one segment. `_asked` takes the same bits."""
    value = value.view(np.uint64)
    segment = (value >> np.uint64(40)).astype(np.int64) % (counters // SEGMENT)
    bits = SEGMENT.bit_length() - 1
    probes = np.stack([(value >> np.uint64(bits * i)) % np.uint64(SEGMENT) for i in range(PROBES)], 1)
    return segment, probes.astype(np.int64)


def merged_sketch(facts: DataFrame, counters: int) -> DataFrame:
    """`segment` and its `counts`, two bits each, over the `hash` of all rows."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch.column("hash").to_numpy())
            size += batch.num_rows
            if size >= FOLDED:
                yield from _touched(np.concatenate(waiting), counters)
                waiting, size = [], 0
        if size:
            yield from _touched(np.concatenate(waiting), counters)

    # A task's rows of one text are one touch of two; its segments are rows of the counters that it touched.
    parts = facts.select("hash").mapInArrow(fold, "segment bigint, touched binary")

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        touched = np.concatenate([np.frombuffer(t.as_buffer(), "<u2") for t in rows.column("touched")])
        counts = np.minimum(np.bincount(touched, minlength=SEGMENT), 2).astype(np.uint64).reshape(-1, _PER_WORD)
        words = (counts << (2 * np.arange(_PER_WORD, dtype=np.uint64))).sum(1, dtype=np.uint64)
        return pa.table({"segment": [key[0].as_py()], "counts": pa.array([words.view(np.int64)], pa.list_(pa.int64()))})

    return stored(parts.groupBy("segment").applyInArrow(merge, "segment bigint, counts array<bigint>"))


def _touched(hashes: np.ndarray, counters: int) -> Iterator[pa.RecordBatch]:
    """Rows of the counters that these hashes touch; one touched more than once is named twice, so merging is adding."""
    values, times = np.unique(hashes, return_counts=True)
    segment, probes = _place(values, counters)
    # A text probes each of its counters once, however its probes fall.
    probes.sort(1)
    fresh = np.ones(probes.shape, bool)
    fresh[:, 1:] = probes[:, 1:] != probes[:, :-1]
    place = (segment[:, None] * SEGMENT + probes)[fresh]
    weight = np.repeat(np.minimum(times, 2), fresh.sum(1))
    place = np.sort(np.concatenate([place, place[weight > 1]]))
    third = np.zeros(len(place), bool)
    third[2:] = place[2:] == place[:-2]
    place = place[~third]
    of = place // SEGMENT
    edges = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    data, stops = (place % SEGMENT).astype("<u2"), np.append(edges[1:], len(place))
    touched = [data[a:b].tobytes() for a, b in zip(edges, stops)]
    yield pa.RecordBatch.from_arrays([pa.array(of[edges]), pa.array(touched, pa.binary())], ["segment", "touched"])


def _asked(rows: DataFrame, sketch: DataFrame, counters: int) -> DataFrame:
    """The rows with `possible`: whether their `hash` may be one that others have, too."""
    bits = SEGMENT.bit_length() - 1
    segment = F.shiftrightunsigned("hash", 40) % (counters // SEGMENT)
    possible = F.lit(True)
    for i in range(PROBES):
        place = F.shiftrightunsigned("hash", bits * i).bitwiseAND(F.lit(SEGMENT - 1))
        word = F.get("counts", F.shiftright(place, _PER_WORD.bit_length() - 1).cast("int"))
        shift = (place.bitwiseAND(F.lit(_PER_WORD - 1)) * 2).cast("int")
        possible &= F.call_function("shiftrightunsigned", word, shift).bitwiseAND(F.lit(2)) != 0
    # At most MOST_COUNTERS of two bits.
    placed = rows.withColumn("segment", segment).join(F.broadcast(sketch), "segment")
    return placed.withColumn("possible", possible).drop("segment", "counts", "hash")
