"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.session import discard, materialize


def connected(edges: DataFrame) -> DataFrame:
    """(digest, label): every end of an edge (a, b) with the smallest end of its component.

    Each round gives a node the smallest label among its neighbours' labels and its
    own, then follows that label once, so that long chains shrink by halves. The
    messages are joins and partial aggregations; rounds are cut by written tables.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = materialize(both, "component-edges")
    labels = materialize(
        both.groupBy("a").agg(F.min("b").alias("near")).select("a", F.least("a", "near").alias("label")),
        "component-labels",
    )
    while True:
        offered = both.join(labels.select(F.col("a").alias("b"), "label"), "b").groupBy("a").agg(
            F.min("label").alias("offer")
        )
        stepped = labels.join(offered, "a").select("a", "label", F.least("label", "offer").alias("lower"))
        followed = stepped.join(labels.select(F.col("a").alias("lower"), F.col("label").alias("far")), "lower")
        fresh = materialize(followed.select("a", "label", F.least("lower", "far").alias("next")), "component-round")
        moved = not fresh.where("next < label").isEmpty()
        discard(labels)
        labels = fresh.select("a", F.col("next").alias("label"))
        if not moved:
            discard(both)
            return labels.withColumnRenamed("a", "digest")
        labels = materialize(labels, "component-labels")
        discard(fresh)
