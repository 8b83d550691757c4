"""The pipeline against its stages done one after the other in plain Python, and the operators' SQL against theirs."""

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from sensorloom.llm import entry
from tests.conftest import TESTDATA, tuples
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_secrets import brute as scan

SF_DIR = str(TESTDATA / "sf0.001")


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_queries_equal_their_sql(spark, name):
    sf_dir = str(TESTDATA / "sf0.01")
    with duckdb.connect() as duck:
        for table in ("documents", "labels", "embeddings", "pages"):
            duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        wanted = duck.sql(entry.oracle_sql()[name])
        df = driver.queries()[name](spark, sf_dir)
        assert sorted(df.columns) == sorted(wanted.columns)
        assert tuples(df.select(*wanted.columns)) == sorted(wanted.fetchall(), key=repr)


def test_all_queries_are_registered(spark):
    names = driver.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def masked(text):
    """The text without its secrets, from the spans that the brute-force scan lists."""
    out, at = [], 0
    for span in filter(None, scan(text)[4].split(",")):
        _, start, end = span.split(":")
        start, end = int(start), int(end)
        if start > at or not out:
            out.append(text[at:start] + "[secret]")
        at = max(at, end)
    return "".join(out) + text[at:]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {row["doc_id"]: row["text"] for row in docs.collect()}
    kept = {}
    for (name, stage), wanted in zip(
        corpus_pipeline.STAGES[:-1],
        [
            None,
            lambda r: {i for i, _, _, k, _ in exact(r.items()) if k},
            lambda r: {i for i, _, _, k in near(r.items(), 80) if k},
            lambda r: set(r),
        ],
    ):
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = {row["doc_id"]: row["text"] for row in docs.collect()}
        if wanted:
            assert got.keys() == wanted(kept), name
        if name == "secret scans":
            assert got == {i: masked(t) for i, t in kept.items()}
        else:
            assert got.items() <= rows.items()
        kept = got
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {p["doc_id"] for p in pieces} == kept.keys()
    for i in kept:
        own = [p for p in pieces if p["doc_id"] == i]
        assert sum(p["length"] for p in own) == own[0]["doc_tokens"]


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).collect() == []


def _odd(spark, key):
    good = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang = 'en' and n_chars > 800").orderBy("doc_id")
    text = [row["text"] for row in good.collect()]
    secret = " token = abcdef123456 "
    long = " ".join(dict.fromkeys(text[5:40])) + secret
    rows = [(1, text[0]), (2, text[0]), (2, text[0]), (3, text[1] + secret), (4, None), (5, ""), (6, " \n"), (None, text[2])]
    rows += [(None, None), (7, long), (8, long + " tail"), (9, text[3].replace(" ", "  ", 5)), (10, text[3]), (11, text[4])]
    rows = [(None if i is None else i if key == "bigint" else f"k{i:03d}", t, "en", "s", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(rows, f"doc_id {key}, text string, lang string, source string, n_chars bigint")
    names = ["_spans", "_clean", "_row", "_text", "_id", "spans", "row", "clean", "a.b", "id", "found", "good", "part"]
    return df.selectExpr("*", *(f"concat('own ', '{n}') as `{n.replace('`', '``')}`" for n in names)), names


def test_stages_on_odd_rows_and_names(spark):
    """Nulls, repeated rows, very long texts, columns that clash with any of our own, names that need quoting."""
    docs, names = _odd(spark, "bigint")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR))
        assert docs.columns == columns, name
        rows = docs.collect()
        assert all(row[n] == f"own {n}" for row in rows for n in names), name
        seen.append(sorted((row["doc_id"] for row in rows), key=repr))
    assert 4 not in seen[0] and 5 not in seen[0] and 6 not in seen[0]  # rejected
    assert seen[1].count(2) == 0 and seen[1].count(1) == 1 and 10 not in seen[1]
    assert 8 not in seen[2] and {1, 3, 7, 9, 11} <= set(seen[2])
    by_id = {row["doc_id"]: row for row in docs.collect()}
    assert "[secret]" in by_id[3]["text"] and "abcdef123456" not in by_id[3]["text"] + by_id[7]["text"]
    assert all(row["n_chars"] == len(row["text"]) for row in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {p["doc_id"] for p in pieces} == set(seen[3])


def test_near_duplicates_by_text_identifiers(spark):
    from sensorloom.llm import near_dedup

    docs, _ = _odd(spark, "string")
    found = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(docs).collect() if r["doc_id"]}
    assert {("k002", "k001"), ("k008", "k007"), ("k010", "k009"), ("k011", "k011"), ("k004", "k004")} <= found
