"""Connected components of a graph given as links."""

from pyspark.sql import DataFrame, functions as F

from jobuse.session import cut


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every end of ``links`` (``a``, ``b``); the label is a node of the component.

    Every node takes the least label around it, then that label's own label, so
    labels travel twice as far each round and chains take logarithmically many.
    Rounds go on until none changes, each written to the shared folder. Joins
    are on a node, whose links the caller bounds, or on a label against one row.
    No links give no rows; links given twice or both ways change nothing.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        pulled = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        own = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = cut(pulled.join(own, "label").select("node", "was", F.least("label", "further").alias("label")))
        labels = moved.select("node", "label")
        if moved.where("label <> was").isEmpty():
            return labels
