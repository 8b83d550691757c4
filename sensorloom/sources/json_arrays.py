"""Large JSON arrays, pretty-printed or not, read by many tasks.

A JSON string holds no raw line feed, so wherever a file is cut at a line, reading goes on outside of strings. Spark's text
source makes the cuts. What a cut does not show is how deep in brackets it lies; that follows from sums:

1. The brackets outside of strings step down or up. The steps of a split add up to one number.
2. Over those few numbers, a running sum says how deep each split begins.
3. Each task reads its splits line by line and counts on from there; an object at the depth of the array's elements begins
   an element. Only an element that runs over the end of a split is shuffled, to be put together from its fragments.

A task holds a batch of lines and the element it is in, and no text but those fragments leaves it. The text is read three
times for that. A file that is one long line is one task, as without this reader.
"""

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.schema import READING

# A string, wherever brackets do not count. One that does not end in its line is none.
_STRING = r'"(?:[^"\\]++|\\.)*+"'
_BRACKET = re.compile(r'[{}\[\]]|"(?:[^"\\\n]++|\\.)*+"')
_STEPS = {"{": 1, "[": 1, "}": -1, "]": -1}
_SPLIT = ["file", "block", "length"]


def read_json_array(spark: SparkSession, path: str) -> DataFrame:
    """Readings of files that hold an array of objects (or one object) each, over however many lines.

    Elements that are not objects are skipped, absent fields are NULL, unknown ones ignored; an element that does not convert
    is a row of NULLs as far as it does not. A file's rows come in no order.
    """
    elements = json_elements(spark, path)
    parsed = elements.select(F.from_json("element", READING).alias("r"))
    return parsed.select(*(f"r.{c}" for c in READING.names))


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """The text of each element (`element`)."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    place = (F.col(f"_metadata.file_{c}").alias(a) for c, a in zip(("path", "block_start", "block_length"), _SPLIT))
    lines = lines.select(*place, "value")
    # One row per split, far below what a broadcast takes. Splits follow from settings and cores; should a pass cut the
    # files otherwise than the first, it has to fail, as it would lose lines.
    depths = F.broadcast(_depths(lines))
    lost = F.raise_error(F.lit("the files or the cores changed while an array was read; read it again"))
    lines = lines.join(depths, _SPLIT, "left").select(
        "file", "block", F.coalesce("begins", lost).alias("begins"), "base", "value"
    )
    whole = lines.mapInArrow(_whole, "element string")

    ends = lines.mapInArrow(_ends, "file string, block bigint, head string, tail string")
    # A head belongs to the last element that was left open before it.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.last(F.when(F.col("tail").isNotNull(), F.col("block")), ignorenulls=True).over(before)
    part = lambda to, text: F.struct(to.alias("to"), "block", F.col(text).alias("text"))
    ends = ends.withColumn("opened", opened)
    parts = ends.select("file", F.inline(F.array(part(F.col("opened"), "head"), part(F.col("block"), "tail"))))
    parts = parts.where("`to` is not null and text is not null").groupBy("file", "to")
    parts = parts.agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    return whole.unionByName(parts.select(F.array_join("parts.text", "\n").alias("element")))


def _depths(lines: DataFrame) -> DataFrame:
    """Per split: how deep in brackets it begins (`begins`), and how deep its file's elements lie (`base`)."""
    # Most lines hold no bracket.
    some = F.lit(False)
    for bracket in _STEPS:
        some |= F.col("value").contains(bracket)
    bare = F.when(some, F.regexp_replace("value", _STRING, "")).otherwise("").alias("bare")
    lines = lines.select(*_SPLIT, F.monotonically_increasing_id().alias("line"), bare)
    step = F.length(F.regexp_replace("bare", r"[^{\[]", "")) - F.length(F.regexp_replace("bare", r"[^}\]]", ""))
    first = F.regexp_extract("bare", r"[{}\[\]]", 0)
    # Numbers only, so that the sums are kept by hashing and nothing is sorted: twice the line, and one more if its
    # first bracket opens no array.
    number = F.when(first != "", F.col("line") * 2 + F.when(first == "[", 0).otherwise(1))
    splits = lines.groupBy(*_SPLIT).agg(F.sum(step.cast("bigint")).alias("steps"), F.min(number).alias("opens"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = F.coalesce(F.sum("steps").over(before), F.lit(0)).alias("begins")
    # An array's elements lie in its bracket, a lone object in none.
    base = F.when(F.first("opens", ignorenulls=True).over(whole) % 2 == 0, 1).otherwise(0).alias("base")
    return splits.select(*_SPLIT, begins, base)


class _Split:
    """The elements of one split's lines: `whole` ones, the `head` that ends or covers an earlier one, and the `tail` that
    the split's end leaves open."""

    def __init__(self, file: str, block: int, depth: int, base: int):
        self.file, self.block, self.depth, self.base = file, block, depth, base
        self.whole: list[str] = []
        self.head: str | None = None
        # Text of the element that the next line goes on with.
        self.parts: list[str] | None = [] if depth > base else None
        self.in_head = depth > base

    def add(self, text: str) -> None:
        at = 0
        for found in _BRACKET.finditer(text):
            step = _STEPS.get(found[0])
            if step is None:
                continue
            if step > 0 and self.depth == self.base and self.parts is None and found[0] == "{":
                self.parts, at = [], found.start()
            self.depth += step
            if step < 0 and self.depth <= self.base and self.parts is not None:
                self.parts.append(text[at : found.end()])
                self._end()
        if self.parts is not None:
            self.parts.append(text[at:])

    def _end(self) -> None:
        text = "\n".join(self.parts)
        self.parts = None
        if self.in_head:
            self.head, self.in_head = text, False
        else:
            self.whole.append(text)

    def ends(self) -> tuple[str, int, str | None, str | None]:
        tail = None
        if self.parts is not None:
            if self.in_head:
                self._end()
            else:
                tail = "\n".join(self.parts)
        return self.file, self.block, self.head, tail


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Split, bool]]:
    """Each split after each batch of its lines, and whether that was the last."""
    split = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").dictionary_encode(), batch.column("block").to_numpy()
        changes = np.diff(files.indices.to_numpy()).astype(bool) | np.diff(blocks).astype(bool)
        values = batch.column("value").to_pylist()
        starts = [0, *(np.flatnonzero(changes) + 1).tolist()]
        for start, stop in zip(starts, [*starts[1:], len(values)]):
            file, block, depth, base = (batch.column(c)[start].as_py() for c in ("file", "block", "begins", "base"))
            if split is None or (split.file, split.block) != (file, block):
                if split is not None:
                    yield split, True
                split = _Split(file, block, depth, base)
            split.add("\n".join(values[start:stop]))
            yield split, False
    if split is not None:
        yield split, True


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for split, _ in _splits(batches):
        if split.whole:
            yield pa.RecordBatch.from_arrays([pa.array(split.whole, pa.string())], ["element"])
            split.whole.clear()


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
    for split, last in _splits(batches):
        split.whole.clear()
        if last:
            arrays = [pa.array([value], kind) for value, kind in zip(split.ends(), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["file", "block", "head", "tail"])
