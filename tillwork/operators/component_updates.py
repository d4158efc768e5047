"""Incremental connected components: stored labels and a batch of inserted and deleted edges.

A deleted edge reopens its own component only: the star rounds run on that component's remaining edges. An inserted edge is
contracted to the labels of its ends, and the rounds run on those labels. All other components are touched
by nothing but the last join, which renames the labels that were merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.components import star_components
from tillwork.operators.keyed import without_matches
from tillwork.session import scratch_folder

_EDGE = ["src", "dst"]


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plain_edges(edges: DataFrame) -> DataFrame:
    """Undirected edges, each once, the smaller end first; null ends and self-links count for nothing."""
    return edges.filter(F.col("src") != F.col("dst")).select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct()


def update_edges(edges: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """The stored plain edges without the deleted and with the inserted ones; an edge that is both stays."""
    return without_matches(edges, plain_edges(deleted), _EDGE).unionByName(plain_edges(inserted)).distinct()


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(*_EDGE)).alias("id")).distinct()


def update_components(labels: DataFrame, edges: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """(id, component_id) after a batch; labels are those of the stored edges (see plain_edges) before it.

    The result is what connected_components gives for the ids of labels and the updated edges: the label of a
    component is its smallest id. An id keeps its row when its last edge is deleted; ends of inserted edges
    without a label get one. Deleted edges that are not stored, and those inserted again, change nothing.
    """
    added = stored(plain_edges(inserted), "inserted")
    gone = without_matches(plain_edges(deleted), added, _EDGE).join(edges, _EDGE, "left_semi")
    # both ends of a stored edge have one label
    reopened = stored(gone.select(F.col("src").alias("id")).join(labels, "id").select("component_id").distinct(), "reopened")
    members = stored(labels.join(reopened, "component_id", "left_semi").select("id"), "members")
    rest = without_matches(edges.join(members.withColumnRenamed("id", "src"), "src", "left_semi"), gone, _EDGE)
    again = members.join(star_components(rest), "id", "left").select("id", F.coalesce("component_id", "id").alias("component_id"))
    again = stored(again, "again")

    ends = stored(_ends(added), "ends")
    untouched = labels.join(reopened, "component_id", "left_anti").select("id", "component_id")
    known = untouched.unionByName(again).join(ends, "id", "left_semi")
    fresh = without_matches(ends, labels.select("id"), ["id"]).select("id", F.col("id").alias("component_id"))
    of_end = stored(known.unionByName(fresh), "of_end")
    one, two = (of_end.select(F.col("id").alias(end), F.col("component_id").alias(f"{end}_component")) for end in _EDGE)
    contracted = added.join(one, "src").join(two, "dst").select(F.col("src_component").alias("src"), F.col("dst_component").alias("dst"))
    merged = star_components(contracted.distinct()).select(F.col("id").alias("component_id"), F.col("component_id").alias("merged_id"))
    current = untouched.unionByName(again).unionByName(fresh)
    return current.join(merged, "component_id", "left").select("id", F.coalesce("merged_id", "component_id").alias("component_id"))
