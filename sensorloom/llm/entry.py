"""The queries over the given tables, one per operator, with their production parameters, and the equivalent SQL."""

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import (
    bpe,
    exact_dedup,
    filter_audit,
    html_extract,
    licenses,
    near_dedup,
    oracles,
    packing,
    phrases,
    quality,
    secrets,
    token_store,
    url_filter,
    vector_dedup,
)
from sensorloom.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

# Where the vocabulary files lie.
_TOKENIZERS = "/opt/tokenizers"

_ROOT = str(Path(__file__).resolve().parents[2])


def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.secret_spans(table(spark, sf_dir, "documents")))


def tokenizer(name: str) -> str:
    try:
        import public_tokenizers
    except ImportError:
        return f"{_TOKENIZERS}/{name}"
    return str(public_tokenizers.path(name))


def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged_urls(table(spark, sf_dir, "pages"))


def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.written_and_read(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _reachable(query: Query) -> Query:
    """Python workers import the package from where the driver did; on a cluster, `--py-files` puts it there."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    found = {
        "op1_secrets": _op1,
        "op2_packing": _op2,
        "op3_url_filter": _op3,
        "op4_exact_dedup": _op4,
        "op5_html_extraction": _op5,
        "op6_near_dedup": _op6,
        "op7_licenses": _op7,
        "op8_bpe": _op8,
        "op9_quality": _op9,
        "op10_token_store": _op10,
        "op11_filter_audit": _op11,
        "op12_phrases": _op12,
        "op13_near_vectors": _op13,
        "pipeline": _pipeline,
    }
    return {name: _reachable(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secrets": oracles.secret_scan(),
        "op4_exact_dedup": oracles.EXACT_DEDUP,
        "op6_near_dedup": oracles.NEAR_DEDUP,
        "op7_licenses": oracles.license_scan(),
        "op11_filter_audit": oracles.FILTER_AUDIT,
        "op12_phrases": oracles.PHRASES,
        "op13_near_vectors": oracles.NEAR_VECTORS,
    }
