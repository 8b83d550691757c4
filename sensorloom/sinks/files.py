"""Parquet directories under an output root."""

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, root: str, name: str) -> str:
    """Overwrites `<root>/<name>` and returns that path.

    The old files go before the new ones are committed: where readers must never see a gap, use `replace_table`.
    """
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode("overwrite").parquet(path)
    return path
