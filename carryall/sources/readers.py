"""Reader pairs that are kept up to date from new days of lineage alone."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from carryall import vocabulary as v
from carryall.operators.enrich import readers
from carryall.sources.tables import fresh_path, pin

_PAIRS = "source_name string, downstream_user string"


class ReaderPairs:
    """Distinct (source_name, downstream_user) of all lineage taken in so far.

    ``update`` reads the days that are not closed yet, and adds only pairs that are not
    there; days before ``open_from`` are closed by it and never read again. Pairs are
    written before the days are noted, so an update that is cut off is made once more and
    adds nothing twice. Updates must not run at the same time. Rows without a day belong
    to a day that never closes: they are read every time.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        folder = folder or fresh_path(spark, "reader_pairs")
        self._pairs_path, self._days_path = f"{folder}/pairs", f"{folder}/days"
        spark.createDataFrame([], _PAIRS).write.mode("append").parquet(self._pairs_path)
        spark.createDataFrame([], "day date").write.mode("append").parquet(self._days_path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(_PAIRS).parquet(self._pairs_path)

    def closed_days(self) -> DataFrame:
        return self.spark.read.schema("day date").parquet(self._days_path).distinct()

    def update(
        self, lineage: DataFrame, open_from: datetime.date, day: str = "day", names: v.Naming = v.DEFAULT
    ) -> list[datetime.date]:
        """Takes in lineage(source_name, operation, user_id, day); the days that it closed.

        Where the lineage is partitioned by ``day``, the closed days' files are not listed.
        """
        closed = [r["day"] for r in self.closed_days().collect()]
        column = F.col(f"`{day}`")
        fresh = lineage.filter(column.isNull() | ~column.isin(closed)) if closed else lineage
        # The days come first: one that appears after them stays open.
        ended = fresh.filter(column < F.lit(open_from)).select(column.cast("date").alias("day")).distinct()
        days = sorted(r["day"] for r in ended.collect())
        pairs = readers(fresh, names).select("source_name", "downstream_user")
        added = pin(pairs.join(self.read(), ["source_name", "downstream_user"], "left_anti"), "added_pairs")
        added.write.mode("append").parquet(self._pairs_path)
        if days:
            self.spark.createDataFrame([(d,) for d in days], "day date").write.mode("append").parquet(self._days_path)
        return days
