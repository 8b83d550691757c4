import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from sensorloom.llm import phrases
from tests.conftest import tuples

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType())])
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(docs: list[tuple], least: int, top: int = 2_000) -> list[tuple]:
    counts: dict[str, Counter] = {}
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            own = counts.setdefault("und" if lang is None else lang, Counter())
            for size in range(1, 5):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    rows = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(a, inside.get(p[i : i + size], 0))
        kept = []
        for p, a in candidates.items():
            if 100 * inside.get(p, 0) >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def docs() -> list[tuple]:
    rng = random.Random(3)
    words = ["the", "The", "of", "é", "É", "日本", "a\x1cb", "\xa0x", "😀", "ZZ", "zz", "common", "word", "-", "a_b", "'s"]
    joins = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " \x0b", "!?", "\r\n"]
    rows = []
    for i in range(500):
        text = "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.choice([0, 2, 30, 90])))
        rows.append((i, rng.choice([text, text, "one very common passage of many words " + text]), rng.choice(["en", "de", "und", None])))
    rows += [(None, None, "en"), (7, "", None), (8, ".,;", "xx"), (9, "the " * 20_000, "en"), (9, "the " * 20_000, "en")]
    rows += [(10, "x" * 50_000 + " y", "fr")] * 30
    return rows


@pytest.mark.parametrize("per_place", [phrases.PLACE, 2_000, 100])
def test_equals_counting_by_hand(spark, docs, per_place, monkeypatch):
    """With small places, most leads are hot and routed by more words."""
    monkeypatch.setattr(phrases, "REPORTED", 2)
    df = spark.createDataFrame(docs, DOCS).repartition(6)
    found = phrases.collocations(df, per_place=per_place)
    assert found.columns == COLUMNS
    assert tuples(found) == by_hand(docs, 30)


def test_chunks_do_not_show(spark, docs, monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 500)
    rows = spark.createDataFrame(docs[:200], DOCS).coalesce(2).rdd.collect()
    counts = Counter()
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": [r["lang"] or "und" for r in rows], "text": [r["text"] or "" for r in rows]})
    for out in phrases._counted(iter([batch])):
        for row in out.to_pylist():
            if row["size"] == 1:
                counts[row["lang"], row["phrase"]] += row["n"]
    monkeypatch.setattr(phrases, "CHUNK", 10**9)
    whole = Counter()
    for out in phrases._counted(iter([batch])):
        for row in out.to_pylist():
            if row["size"] == 1:
                whole[row["lang"], row["phrase"]] += row["n"]
    assert counts == whole


def test_first_of_each_language(spark, docs):
    df = spark.createDataFrame(docs, DOCS)
    assert tuples(phrases.collocations(df, least=5, top=3)) == by_hand(docs, 5, 3)


def test_sorted_counts_equal_a_counter():
    rng = np.random.default_rng(2)
    columns = [c.copy() for c in rng.integers(0, 5, (4, 3_000))]
    for i in range(1, 4):
        columns[i][columns[i - 1] == 0] = 0
    weight = rng.integers(1, 9, 3_000)
    wanted = Counter()
    for *words, n in zip(*columns, weight):
        for size in range(1, 5):
            if all(words[:size]):
                wanted[tuple(map(int, words[:size]))] += int(n)
    found = dict(phrases.sorted_counts(columns, weight, 40))
    assert found == {p: n for p, n in wanted.items() if n >= 40}
    longer = dict(phrases.sorted_counts(columns, weight, 40, 3))
    assert longer == {p: n for p, n in found.items() if len(p) >= 3}


def test_empty_and_extra_columns(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).collect() == []
    docs = [(i, "Good, good day", "en") for i in range(40)]
    more = spark.createDataFrame(docs, DOCS).selectExpr("*", *(f"'x' as `{c}`" for c in ("phrase", "a", "n", "words", "place", "a.b")))
    assert tuples(phrases.collocations(more)) == by_hand(docs, 30)
