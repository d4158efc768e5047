"""Device pings stored by area, so that a run reads the areas around stores only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators.geo import box_half_width, geo_overlap, mercator_x, mercator_y

AREA = "area"
#: Half the extent of the projection, in metres; what lies beyond (the poles) has no area.
_EDGE = 20037508.5


@dataclass(frozen=True)
class PingStore:
    """Pings at a path, partitioned by square areas of `metres` and sorted by cells of `fine` metres inside them.

    Pings without a place on the projection (null, not finite, at a pole) have no area: they are stored, and match no store.
    The list of areas to read is at most the globe's number of areas (160,000 at 100 km, some 4 MB), whatever
    the number of stores and pings, so it may be broadcast; a side below 50 km is refused.
    """

    path: str
    metres: float = 100_000.0
    fine: float = 2_000.0

    def __post_init__(self) -> None:
        if self.metres < 50_000.0:
            raise ValueError("areas below 50 km are too many to be listed")

    def _area(self, x: Column, y: Column) -> Column:
        return F.concat_ws("_", x.cast("bigint"), y.cast("bigint"))

    def write(self, pings: DataFrame, mode: str = "append") -> None:
        """Add pings. They are range-sorted by area, cell and time, so that a hot area or cell is cut into several tasks."""
        x, y = mercator_x(F.col("longitude")), mercator_y(F.col("latitude"))
        inside = (F.abs(x) <= _EDGE) & (F.abs(y) <= _EDGE)
        order = ["_area_x", "_area_y", "_cell_x", "_cell_y", "utc_timestamp"]
        placed = pings.withColumns({
            "_area_x": F.when(inside, F.floor(x / self.metres)), "_area_y": F.when(inside, F.floor(y / self.metres)),
            "_cell_x": F.when(inside, F.floor(x / self.fine)), "_cell_y": F.when(inside, F.floor(y / self.fine)),
        })
        area = F.when(F.col("_area_x").isNotNull(), self._area(F.col("_area_x"), F.col("_area_y")))
        named = placed.repartitionByRange(*order).withColumn(AREA, area)
        # the partition column leads the sort, or the writer would sort once more and lose the cells' order
        named.sortWithinPartitions(AREA, *order[2:]).drop(*order[:4]).write.mode(mode).partitionBy(AREA).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """All pings with their area. The folders are listed here, by a task per core and not by one per folder."""
        setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
        before = spark.conf.get(setting)
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))
        try:
            return spark.read.parquet(self.path)
        finally:
            spark.conf.set(setting, before)

    def areas(self, stores_m: DataFrame, half_width: float) -> DataFrame:
        """The areas that a box around any store touches, one row each."""
        def span(metres: str) -> Column:
            low, high = ((F.col(metres) + side) / self.metres for side in (F.lit(-half_width), F.lit(half_width)))
            return F.explode(F.sequence(F.floor(low), F.floor(high)))

        across = stores_m.filter(F.col("x_m").between(-_EDGE, _EDGE) & F.col("y_m").between(-_EDGE, _EDGE)).select("y_m", span("x_m").alias("ax"))
        both = across.select("ax", span("y_m").alias("ay"))
        return both.select(self._area(F.col("ax"), F.col("ay")).alias(AREA)).distinct()

    def near(self, stores_m: DataFrame, half_width: float) -> DataFrame:
        """All pings inside a store's box, and others of the same areas.

        The areas are broadcast within the query itself, and the same broadcast prunes the scan's partitions at run time:
        there is no job before it, and where every area has a store it costs one lookup per ping.
        """
        wanted = F.broadcast(self.areas(stores_m, half_width))
        return self.read(stores_m.sparkSession).join(wanted, AREA, "left_semi").drop(AREA)

    def overlap(
        self, stores_m: DataFrame, accuracy_max: float, distance_to_store: float, accuracy_multiplier: float, max_gaps: int | None = None
    ) -> DataFrame:
        """geo_overlap on the stored pings; the boxes follow from the same three numbers, so no match is lost."""
        pings = self.near(stores_m, box_half_width(accuracy_max, distance_to_store, accuracy_multiplier))
        return geo_overlap(pings, stores_m, accuracy_max, distance_to_store, accuracy_multiplier, max_gaps)
