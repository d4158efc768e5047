"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

A node's smallest neighbour is aggregated before the shuffle and joined back, so the centre of a
giant component is never one task. Each round is a table in the shared folder, deleted when the next
is written; the label of a component is its smallest identity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.operators.keyed import with_group_totals
from tillwork.session import delete_folder, scratch_folder


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour to the smallest of the neighbourhood and the node."""
    both = edges.select(F.inline(F.array(F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    near = with_group_totals(both, ["u"], {"m": ("min", F.col("v"))})
    return near.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the node and its smaller neighbours to the smallest of them; edges have u > v."""
    near = with_group_totals(edges, ["u"], {"m": ("min", F.col("v"))})
    linked = near.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    return linked.filter("u <> v").distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def star_components(edges: DataFrame) -> DataFrame:
    """Edges (src, dst) to (id, component_id): every linked id with the smallest id it is connected to.

    Null ends and self-links count for nothing; an id without links is not in the result. The rounds end when
    one changes nothing; each at least halves the longest chain, so their number grows with the logarithm of
    the largest component and needs no limit.
    """
    spark = edges.sparkSession
    folder = scratch_folder(spark, "edges")

    def written(frame: DataFrame, number: int) -> DataFrame:
        path = f"{folder}/round={number}"
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    first = edges.filter(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    number, stars = 0, written(first.distinct(), 0)
    seen = _fingerprint(stars)
    while seen[0]:
        number, stars = number + 1, written(_small_star(_large_star(stars)), number + 1)
        now = _fingerprint(stars)
        delete_folder(spark, f"{folder}/round={number - 1}")
        if now == seen:
            break
        seen = now
    centre = F.col("v").alias("component_id")
    return stars.select(F.col("u").alias("id"), centre).union(stars.select(F.col("v").alias("id"), centre).distinct())


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """vertices (id) and edges (src, dst) to (id, component_id); lone vertices keep themselves."""
    labels = star_components(edges)
    ids = vertices.select("id").union(edges.select("src")).union(edges.select("dst")).distinct()
    return ids.join(labels, "id", "left").select("id", F.coalesce("component_id", "id").alias("component_id"))
