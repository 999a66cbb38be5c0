"""Connected components of links between nodes that are numbers."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from opinara.llm.common import scratch_table


def components(links: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node in links (a, b).

    In a round every node takes the least label among its own and those of its neighbours, and then the label which that node has, so
    labels travel twice as far each time. A round is joins and sums with map-side totals and ends in one written table; the rounds
    end when no label changes.
    """
    ends = links.select("a", "b").filter("a <> b").distinct()
    both = ends.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(ends.select(F.col("b").alias("u"), F.col("a").alias("v")))
    edges = scratch_table(both, "edges")
    labels = scratch_table(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        taken = labels.join(near.withColumnRenamed("u", "node"), "node").select("node", "label", F.least("label", "near").alias("to"))
        of_label = labels.select(F.col("node").alias("to"), F.col("label").alias("next"))
        seen = Observation()
        new = taken.join(of_label, "to").select("node", F.least("to", "next").alias("new"), "label")
        new = new.observe(seen, F.count_if(F.col("new") != F.col("label")).alias("changed")).select("node", F.col("new").alias("label"))
        labels = scratch_table(new, "labels")
        if not seen.get["changed"]:
            return labels.withColumnRenamed("label", "component")
