"""Exact dedup by content sort.

Rows are range-partitioned by the head of their normalised text, with splitters that Spark samples; each partition is
sorted externally by the whole text, which places equal texts next to each other; a window then walks the sorted rows,
compares each text in full with its neighbour's, and every run of equal texts keeps its smallest identifier. Texts that
begin alike are told apart by a hash before they are compared further, so splitters stay short, however long texts are.

A text that very many rows share would be one run in one task. Such texts are counted first, by hash, and their rows get
a salt, so that they form several runs; the few rows that head these runs are merged afterwards. Texts count as hot from
`max(MIN_HOT, rows / HOT_SHARE)` copies, so there are at most `HOT_SHARE` of them whatever the input: their list and
their merged heads may be broadcast.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.frames import stored, text_of, whole_row

HOT_SHARE = 1_000
MIN_HOT = 500
# Characters of a text that splitters hold.
HEAD = 32

# A run of white space that is not a single space already: what is left alone is most of a text.
_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, _RUN, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, dropped ones too: `doc_id`, `keep_id` (the smallest identifier with an equal text), `group_size`, `kept`
    and `text_sha256` (of the normalised text).

    A null text is the empty text. A null identifier sorts after all others: it is kept only where no row of the group
    has an identifier. Of rows with equal identifier and text, one is kept. Other columns are ignored, whatever their
    names. An empty table gives an empty result.
    """
    runs = _runs(docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")))
    return runs.select(
        F.col("_id").alias("doc_id"),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_kept").alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Nulls and ties as in `exact_groups`."""
    packed = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"), whole_row(docs).alias("_row"))
    return _runs(packed).where("_kept").select("_row.*")


def _runs(rows: DataFrame) -> DataFrame:
    """Adds `_keep`, `_size`, `_kept`, `_sha` to rows with `_id` and `_text`."""
    rows = rows.withColumn("_norm", normalised(F.col("_text"))).drop("_text")
    hash_of = F.xxhash64("_norm").alias("_hash")
    least = max(MIN_HOT, rows.select("_id").count() // HOT_SHARE)
    hot = rows.select(hash_of).groupBy("_hash").agg(F.count("*").alias("_copies")).where(F.col("_copies") >= least)
    salts = {row["_hash"]: -(-row["_copies"] // least) for row in hot.collect()}
    if salts:
        pairs = F.create_map(*(F.lit(x).cast("bigint") for pair in salts.items() for x in pair))
        salt = F.pmod(F.xxhash64("_id"), F.coalesce(F.element_at(pairs, hash_of), F.lit(1).cast("bigint")))
        rows = rows.withColumn("_salt", salt)
    rows = rows.withColumns({"_head": F.left("_norm", F.lit(HEAD)), "_hash": hash_of})
    keys = ["_head", "_hash", *(["_salt"] if salts else [])]
    dealt = rows.repartitionByRange(*keys)
    run = Window.partitionBy(*keys, "_norm")
    ordered = run.orderBy(F.col("_id").asc_nulls_last())
    runs = dealt.select(
        *(c for c in dealt.columns if c not in ("_norm", "_head", "_hash")),
        F.first("_id").over(ordered).alias("_keep"),
        F.count("*").over(run).alias("_size"),
        (F.row_number().over(ordered) == 1).alias("_kept"),
        F.sha2(F.col("_norm").cast("binary"), 256).alias("_sha"),
    )
    return _merged(stored(runs)) if salts else runs


def _merged(runs: DataFrame) -> DataFrame:
    """Puts the runs of a hot text together. Only texts with more than one run are rewritten."""
    heads = runs.where("_kept").groupBy("_sha").agg(
        F.min(F.struct(F.col("_keep").isNull().alias("none"), "_keep", "_salt")).alias("_first"),
        F.sum("_size").alias("_all"),
        F.count("*").alias("_n"),
    )
    several = heads.where("_n > 1").select("_sha", F.col("_first._keep").alias("_least"), "_first._salt", "_all")
    several = F.broadcast(several.withColumnRenamed("_salt", "_winner"))
    joined = runs.join(several, "_sha", "left")
    split = F.col("_all").isNotNull()
    return joined.select(
        *(c for c in runs.columns if c not in ("_keep", "_size", "_kept")),
        F.when(split, F.col("_least")).otherwise(F.col("_keep")).alias("_keep"),
        F.when(split, F.col("_all")).otherwise(F.col("_size")).alias("_size"),
        (F.col("_kept") & (~split | (F.col("_salt") == F.col("_winner")))).alias("_kept"),
    )
