import itertools
import random
import re

import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from sensorloom.llm import filter_audit
from tests.conftest import tuples

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])
LABELS = StructType([StructField(c, t) for c, t in (("doc_id", LongType()), ("quality", IntegerType()), ("toxic", IntegerType()))])
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails_of(docs: list[tuple]) -> list[set[str]]:
    first: dict[str, int] = {}
    for doc, text, _ in docs:
        if doc is not None:
            first[text or ""] = min(doc, first.get(text or "", doc))
    found = []
    for doc, text, _ in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and doc > first[text],
        }
        found.append({f for f, yes in failed.items() if yes})
    return found


def by_hand(docs: list[tuple], labels: list[tuple]) -> list[tuple]:
    """Applies the filters one after another, in every order."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for part in {lang or "" for _, _, lang in docs}:
        own = [(doc, failed) for (doc, _, lang), failed in zip(docs, fails_of(docs)) if (lang or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        part_rows = []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, letter in enumerate(order, 1):
                removed = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                total[letter] += len(removed)
                failing = [x for x in own if letter in x[1]]
                only = [x for x in own if x[1] == {letter}]
                lost = [sum(d in marked for d, _ in removed) for marked in (good, toxic)]
                counts = (len(left), len(removed), len(failing) - len(removed), len(only), *lost)
                part_rows.append((part, "".join(order), step, *counts, letter))
        rows += [(*row[:-1], total[row[-1]]) for row in part_rows]
    return sorted(rows, key=repr)


def texts(rng: random.Random) -> list[str]:
    words = [f"w{i}" for i in range(300)]
    made = ["", " ", "A", "a b c", "x$", "Σ É", " ".join(words), " ".join(words[:100] * 3), "CAPS " * 250]
    return made + [" ".join(rng.choices(words, k=rng.choice([3, 150, 260]))) + rng.choice(["", " #", " ABC DEF"]) for _ in range(25)]


@pytest.mark.parametrize("most", [filter_audit.MOST_COUNTERS, 1])
def test_equals_the_filters_applied_one_by_one(spark, most):
    """Also where the sketch is full and tells nothing."""
    rng = random.Random(8)
    pool = texts(rng)
    docs = [(i, rng.choice([None, *pool]), rng.choice([None, "", "en", "de"])) for i in range(400)]
    docs += [(None, pool[0], "en"), (None, None, None), (7, docs[7][1], "fr"), (7, "other", "en")]
    docs += [(1000 + i, "the same " * 150, "en") for i in range(200)]
    docs += [(5000 + i, f"{'long ' * 30_000}{i}", "de") for i in (0, 0, 1)]
    rng.shuffle(docs)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1200, 2)]
    labels += [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    found = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), most)
    assert found.columns == COLUMNS
    assert tuples(found) == by_hand(docs, labels)


def test_empty_tables(spark):
    none, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, labels).collect() == []
    some = spark.createDataFrame([(1, None, None)], DOCS)
    assert tuples(filter_audit.audit(some, labels)) == by_hand([(1, None, None)], [])


def test_extra_columns_change_nothing(spark):
    docs = [(1, "a", "en"), (2, "a", "en"), (3, "B", None)]
    plain = spark.createDataFrame(docs, DOCS)
    names = ["part", "mask", "hash", "digest", "n", "first", "possible", "segment", "counts", "quality", "a.b"]
    more = plain.selectExpr("*", *(f"'x' as `{c}`" for c in names))
    labels = spark.createDataFrame([(1, 1, 0)], LABELS).selectExpr("*", "'x' as part", "'y' as n")
    assert tuples(filter_audit.audit(more, labels)) == by_hand(docs, [(1, 1, 0)])


def test_sketch_clears_most_unique_texts_and_no_repeat(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "cast(if(id % 10 = 0, id % 1000, id) as string) as text")
    rows = rows.selectExpr("*", "xxhash64(text) as hash")
    counters = filter_audit._counters(20_000, filter_audit.MOST_COUNTERS)
    sketch = filter_audit.merged_sketch(rows.repartition(7), counters)
    asked = filter_audit._asked(rows, sketch, counters)
    assert asked.where("doc_id % 10 = 0 and not possible").isEmpty()
    assert asked.where("doc_id >= 1000 and doc_id % 10 > 0 and possible").count() < 1_500
    assert asked.count() == 20_000


def test_the_sketch_is_bounded():
    assert filter_audit._counters(10**12, 1 << 27) == 1 << 27
    assert filter_audit._counters(0, 1 << 27) == filter_audit.SEGMENT
    assert filter_audit._counters(10**6, 1 << 27) >= 8 * 10**6
