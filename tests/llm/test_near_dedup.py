import random
import re

import numpy as np
import pytest

from sensorloom.llm import near_dedup
from sensorloom.llm.components import components
from tests.conftest import TESTDATA, tuples


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    by_shingle = {}
    for i, s in sets.items():
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    for i, s in sets.items():
        common = {}
        for x in s:
            for j in by_shingle[x]:
                common[j] = common.get(j, 0) + 1
        for j, n in common.items():
            if j < i and 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return sorted(((i, len(sets[i]), root(i), root(i) == i) for i in sets), key=repr)


def families(seed, bases=25, copies=14):
    """Texts and copies of copies, each with some words changed: similarities on both sides of the limit, and members that
    are linked to each other but not to the family's centre."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeÉ") for _ in range(rng.randrange(1, 6)))
    texts = []
    for _ in range(bases):
        made = [[word() for _ in range(rng.choice([1, 3, 5, 7, 12, 60, 150, 400]))]]
        for _ in range(rng.randrange(copies)):
            copy = list(rng.choice(made))
            for _ in range(rng.choice([0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = word()
            made.append(copy[: len(copy) - rng.choice([0, 0, 0, 2])] or copy)
        texts += [rng.choice([" ", "\n", "\t "]).join(m) for m in made]
    texts += [None, "", " \n", "A b", "a B", "É x", "é x", "x\xa0y"]
    rng.shuffle(texts)
    return [(i * 7 + 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,block", [(1, 400_000), (2, 300), (3, 40)])
def test_families_against_all_pairs(spark, monkeypatch, seed, block):
    """Small blocks cut what is left of a star into many."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = families(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, component string, id int")
    assert tuples(near_dedup.near_duplicates(df)) == brute(rows)
    kept = near_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(row[0] for row in kept.collect()) == sorted(r[0] for r in brute(rows) if r[3])


def test_one_large_family_of_loose_copies(spark):
    """A third of the copies is linked to the base, the others are alike to many but linked to few."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(len(copy))] = f"v{rng.randrange(40)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert tuples(near_dedup.near_duplicates(df)) == brute(rows)


def test_given_documents_against_all_pairs(spark):
    df = spark.read.parquet(str(TESTDATA / "sf0.01" / "documents.parquet"))
    rows = [(row["doc_id"], row["text"]) for row in df.select("doc_id", "text").collect()]
    assert tuples(near_dedup.near_duplicates(df)) == brute(rows)


def test_bins_agree_as_sets_are_alike():
    rng = np.random.default_rng(5)
    for size in (6, 20, 100, 2_000):
        agreed = []
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            a, b = pool[: size - size // 8], pool[size // 8 :]
            agreed.append(np.mean(near_dedup.sketch(a) == near_dedup.sketch(b)))
        wanted = (size - 2 * (size // 8)) / size
        assert abs(np.mean(agreed) - wanted) < 0.08


def test_null_identifiers_repeated_rows_and_empty_table(spark):
    text = "a b c d e f g"
    rows = [(None, text), (4, text), (4, text), (6, text), (None, None), (8, None), (9, "x"), (9, "y"), (10, "y"), (7, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [row[0:1] + row[2:] for row in tuples(near_dedup.near_duplicates(df))]
    wanted = [(4, 4, True), (4, 4, True), (6, 4, False), (7, 7, True), (8, 8, True), (9, 7, False), (9, 7, False), (10, 7, False)]
    assert got == sorted([*wanted, (None, None, True), (None, None, True)], key=repr)
    assert near_dedup.near_duplicates(df.where("doc_id > 99")).collect() == []
    assert near_dedup.drop_near_copies(df.where("doc_id > 99")).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    loose = [(rng.randrange(1_000, 1_300), rng.randrange(1_000, 1_300)) for _ in range(150)]
    links = chain + star + loose + [(7, 7)]
    part = {}

    def root(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        part[high] = low
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert tuples(got) == sorted(((x, root(x)) for x in list(part)), key=repr)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_similarity_and_bands_are_the_callers(spark):
    """Of 100 shingles, copies keep 82, 80 and 79; the limit itself is alike."""
    rows = []
    for k, cut in enumerate((18, 20, 21)):
        words = [f"{k}w{i}" for i in range(104)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[: 104 - cut]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = lambda kept: {row["doc_id"] for row in kept.collect()}
    assert ids(near_dedup.drop_near_copies(df, percent=80, n_bands=28, n_rows=4)) == {0, 10, 20, 21}
    assert ids(near_dedup.drop_near_copies(df)) == {0, 1, 10, 11, 20, 21}
    with pytest.raises(ValueError):
        near_dedup.near_duplicates(df, n_bands=33, n_rows=4)
