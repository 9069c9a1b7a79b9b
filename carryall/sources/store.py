"""Control tables that are replaced as a whole, and a journal that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from carryall.functions.times import moment
from carryall.sources.tables import fresh_name, fresh_path


class StoredTable:
    """A table of small or middling size whose versions follow each other.

    A new version is written to a folder of its own, and then the table's name is pointed
    there. Readers see one version or the other, and a write that fails leaves the last.
    """

    def __init__(self, spark: SparkSession, rows: DataFrame, label: str, name: str | None = None) -> None:
        self.spark, self.label, self.name = spark, label, name or fresh_name(label)
        path = fresh_path(spark, label)
        rows.write.parquet(path)
        columns = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
        spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet LOCATION '{path}'")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def replace(self, rows: DataFrame) -> None:
        path = fresh_path(self.spark, self.label)
        rows.select(*self.read().columns).write.parquet(path)
        self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{path}'")
        self.spark.catalog.refreshTable(self.name)


class Journal:
    """What runs did: a row before and a row after every stage of a job."""

    BEGUN, DONE, FAILED = "begun", "done", "failed"
    SCHEMA = T.StructType(
        [
            T.StructField("run_id", T.StringType()),
            T.StructField("task_id", T.LongType()),
            T.StructField("step", T.IntegerType()),
            T.StructField("stage", T.StringType()),
            T.StructField("outcome", T.StringType()),
            T.StructField("detail", T.StringType()),
            T.StructField("at", T.TimestampNTZType()),
        ]
    )

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark, self.path = spark, path or fresh_path(spark, "journal")
        self._add(spark.createDataFrame([], self.SCHEMA))

    def _add(self, rows: DataFrame) -> None:
        rows.select(*self.SCHEMA.names).write.mode("append").parquet(self.path)

    def write(self, rows: DataFrame, run_id: str, outcome: str | None, as_of) -> None:
        """Adds rows(task_id, step, stage, and maybe outcome and detail) in one write."""
        given = rows if outcome is None else rows.withColumn("outcome", F.lit(outcome))
        if "detail" not in given.columns:
            given = given.withColumn("detail", F.lit(None).cast("string"))
        self._add(given.withColumns({"run_id": F.lit(run_id), "at": moment(as_of), "step": F.col("step").cast("int")}))

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def stages(self, run_id: str) -> DataFrame:
        """task_id, step, stage and the last outcome of every stage of a run.

        A stage that was begun and neither done nor failed was cut off. A stage that
        failed and was done when it was tried again counts as done.
        """
        of_run = self.read().filter(F.col("run_id") == run_id)
        rank = F.when(F.col("outcome") == self.DONE, 2).when(F.col("outcome") == self.FAILED, 1).otherwise(0)
        # The detail is that of the last outcome: where a copy is, or why a stage failed.
        last = of_run.groupBy("task_id", "stage").agg(
            F.min("step").alias("step"), F.max(rank).alias("rank"), F.max_by("detail", rank).alias("detail")
        )
        outcome = F.when(F.col("rank") == 2, self.DONE).when(F.col("rank") == 1, self.FAILED).otherwise(self.BEGUN)
        return last.select("task_id", "step", "stage", outcome.alias("outcome"), "detail")
