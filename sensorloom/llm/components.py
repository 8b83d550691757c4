"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """`id` and `component`, the smallest id reachable, for every id in `links` (`a`, `b`).

    Each round gives an id the smallest label among its own and its neighbours', and then that label's label; rounds end
    when nothing changes. Each is written to the shared folder, so that a lost executor repeats one round at most.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        best = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("best"))
        of_best = labels.select(F.col("id").alias("best"), F.col("label").alias("next"))
        moved = stored(best.join(of_best, "best").select("id", "label", F.least("best", "next").alias("next")))
        changed = not moved.where("next < label").isEmpty()
        labels = moved.select("id", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
