"""Row shapes of the control tables."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = ["catalog_name", "db_name", "tbl_name"]

_SET = T.ArrayType(T.StringType())

# Timestamps carry no zone: the queue compares them only with an explicit as_of.
JOB = T.StructType(
    [
        T.StructField("task_id", T.LongType()),
        T.StructField("catalog_name", T.StringType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("tbl_name", T.StringType()),
        T.StructField("stg_format", T.StringType()),
        T.StructField("data_category", T.StringType()),
        T.StructField("tbl_owners", _SET),
        T.StructField("downstream_users", _SET),
        T.StructField("to_be_processed", T.IntegerType()),
        T.StructField("in_process", T.IntegerType()),
        T.StructField("state", T.StringType()),
        T.StructField("desired_state", T.StringType()),
        T.StructField("initial_gap_days", T.IntegerType()),
        T.StructField("probation_gap_days", T.IntegerType()),
        T.StructField("comm_level1_date", T.TimestampNTZType()),
        T.StructField("comm_level2_date", T.TimestampNTZType()),
        T.StructField("comm_level3_date", T.TimestampNTZType()),
        T.StructField("shadow_watermark", T.LongType()),
        T.StructField("migration_paused", T.IntegerType()),
        T.StructField("pause_reason", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("shadow_status", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("last_updated_time", T.TimestampNTZType()),
    ]
)

JOB_COLUMNS = JOB.fieldNames()

# Columns an update may change; the key and created_at never move.
MUTABLE_COLUMNS = [
    "stg_format",
    "data_category",
    "tbl_owners",
    "downstream_users",
    "to_be_processed",
    "in_process",
    "state",
    "desired_state",
    "initial_gap_days",
    "probation_gap_days",
    "comm_level1_date",
    "comm_level2_date",
    "comm_level3_date",
    "shadow_watermark",
    "migration_paused",
    "pause_reason",
    "run_id",
    "shadow_status",
]

CATALOG = T.StructType(
    [
        T.StructField("catalog_name", T.StringType()),
        T.StructField("db_name", T.StringType()),
        T.StructField("tbl_name", T.StringType()),
        T.StructField("table_type", T.StringType()),
        T.StructField("serde_uri", T.StringType()),
        T.StructField("output_format", T.StringType()),
        T.StructField("data_uri", T.StringType()),
        T.StructField("data_size", T.LongType()),
        T.StructField("tags", _SET),
        T.StructField("owner_user_id", T.StringType()),
        T.StructField("secure", T.BooleanType()),
        T.StructField("migrated_data_location", T.StringType()),
        T.StructField(
            "fields",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("source_type", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)

# Columns that make up a table's definition metadata (copied on promote).
DEFINITION_COLUMNS = ["data_size", "owner_user_id", "secure", "migrated_data_location"]

LEDGER = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("snapshot_id", T.LongType()),
        T.StructField("committed_at", T.TimestampNTZType()),
        T.StructField("operation", T.StringType()),
        T.StructField("partition_values", T.MapType(T.StringType(), T.StringType())),
        T.StructField("record_count", T.LongType()),
    ]
)
