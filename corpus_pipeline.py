"""From raw documents to packed sequences: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of `documents`. Between
stages the table is written to the shared folder and read again, so a lost executor repeats one stage at most. Columns
beyond those of `documents` go along, whatever their names; an empty table passes through all stages.
"""

from pyspark.sql import DataFrame, SparkSession

from sensorloom.llm import entry, exact_dedup, near_dedup, packing, quality, secrets
from sensorloom.llm.frames import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or that the forest calls anomalies, go: null, empty and blank texts among them.
    Repeated rows and null identifiers are judged like others."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest identifier stays; of rows that share that, too, one. A null text is the
    empty one; a null identifier stays only where no row with the text has one."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, alike to 80 percent or more, the document with the smallest identifier stays, in all
    its rows. Null and blank texts, and rows with a null identifier, are near to nothing and stay."""
    return near_dedup.drop_near_copies(docs, percent=80, n_bands=28, n_rows=4)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, and `n_chars` follows; their documents stay. A null text stays null."""
    return secrets.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences. A null text is empty: its document is one end token; repeated rows and null
    identifiers are documents of their own."""
    return packing.pack(docs, entry.tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("MinHash near-dedup", near_copies),
    ("secret scans", secret_spans),
    ("packing", packed),
]

# No SQL gives a forest's verdicts or a tokenizer's ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
