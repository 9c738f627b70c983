"""Connected components of links that stay distributed: hooking on the smallest label, then pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.storage import materialize


def _jumped(parents: DataFrame) -> DataFrame:
    """Follow ``label -> parent`` until every parent is a root. Takes log2 of the longest chain of passes."""
    while True:
        parents = materialize(parents, "parents")
        above = parents.select(F.col("label").alias("parent"), F.col("parent").alias("above"))
        if parents.join(above, "parent", "left_semi").isEmpty():
            return parents
        parents = parents.join(above, "parent", "left").select("label", F.coalesce("above", "parent").alias("parent"))


def merge_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (``node, label``) after joining along the links (``a, b``): the smallest label of each component.

    ``label`` may be any ordered type. Every round each label hooks to the smallest one it is linked to. Groups are
    reduced by map-side minimum, never collected.
    """
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        crossing = materialize(links.join(of_a, "a").join(of_b, "b").where("la <> lb").select("a", "b", "la", "lb"), "crossing")
        if crossing.isEmpty():
            return labels
        hooks = crossing.groupBy(F.greatest("la", "lb").alias("label")).agg(F.min(F.least("la", "lb")).alias("parent"))
        parents = _jumped(hooks)
        labels = materialize(
            labels.join(parents, "label", "left").select("node", F.coalesce("parent", "label").alias("label")), "labels"
        )
        links = crossing.select("a", "b")
