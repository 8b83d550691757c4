import hashlib
import random
import re

import pytest

from sensorloom.llm import exact_dedup
from tests.conftest import plan, tuples


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for norm, ids in groups.items():
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, min(ids), len(ids), i == min(ids), sha) for i in ids]
    return sorted(out, key=repr)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["a", "b", "é"]) for _ in range(rng.randrange(4))]
        text = "".join(w + rng.choice([" ", "  ", "\n", "\t \x0b", "\xa0"]) for w in words)
        rows.append((i * 3 + 1, rng.choice([text, None, "hot text", "hot  text"]) if i % 2 else text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least", [500, 10])
def test_against_brute_force(spark, monkeypatch, least):
    """With 10, most groups here are hot and are split over salts."""
    monkeypatch.setattr(exact_dedup, "MIN_HOT", least)
    rows = random_rows(900, 3)
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, kept string, _norm int")
    assert tuples(exact_dedup.exact_groups(df)) == brute(rows)
    kept = exact_dedup.drop_exact_copies(df)
    assert kept.columns == df.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted({row[1] for row in brute(rows)})


@pytest.mark.parametrize("least", [500, 1])
def test_null_identifiers_and_repeated_rows(spark, monkeypatch, least):
    monkeypatch.setattr(exact_dedup, "MIN_HOT", least)
    rows = [(None, "a"), (5, "a"), (None, "b"), (None, "b"), (7, "c"), (7, "c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [row[:4] for row in tuples(exact_dedup.exact_groups(df))]
    wanted = [(None, 5, 2, False), (5, 5, 2, True), (None, None, 2, False), (None, None, 2, True)]
    assert got == sorted([*wanted, (7, 7, 2, False), (7, 7, 2, True)], key=repr)


def test_empty_table_and_long_texts(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_groups(df).collect() == []
    rows = [(1, "x " * 300_000), (2, "x  " * 300_000)]
    assert tuples(exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string"))) == brute(rows)


def test_one_range_exchange_and_no_python(spark):
    df = spark.range(2).selectExpr("id as doc_id", "cast(id as string) as text")
    text = plan(exact_dedup.exact_groups(df))
    assert text.count("rangepartitioning") >= 1 and "hashpartitioning" not in text and "Python" not in text
