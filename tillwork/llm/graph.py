"""Connected components of links between nodes of any ordered type, by the library's star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwork.operators.components import star_components


def components(edges: DataFrame) -> DataFrame:
    """Edges (src, dst) to (id, component): every linked id with the smallest id it is connected to.

    Null ends and self-links count for nothing; an id without links is not in the result. DataFrame operations
    only; a hub's rows are split by Spark (see star_components).
    """
    return star_components(edges).withColumnRenamed("component_id", "component")
