"""The job queue as a DataFrame: codec, update, ingest, removal, lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.functions.fingerprint import row_hash
from carryall.functions.shards import number_rows
from carryall.functions.times import moment
from carryall.schemas import JOB, KEY, MUTABLE_COLUMNS

_JSON_SET = "array<string>"


def decode_jobs(raw: DataFrame, state_names: dict[str, str] | None = None) -> DataFrame:
    """Raw queue rows to typed jobs: JSON arrays become sets, nulls get defaults.

    Columns the raw table lacks are taken as null. ``state_names`` renames the
    states of a queue kept by another tool.
    """
    have = set(raw.columns)

    def raw_col(name):
        return F.col(name) if name in have else F.lit(None)

    def state(name):
        col = raw_col(name).cast("string")
        if state_names:
            col = _rename(col, state_names)
        return F.coalesce(col, F.lit(v.NEW))

    blank_if_null = {"catalog_name", "db_name", "tbl_name", "stg_format", "data_category"}
    zero_if_null = {
        "to_be_processed",
        "in_process",
        "initial_gap_days",
        "probation_gap_days",
        "migration_paused",
    }
    out = []
    for field in JOB.fields:
        name = field.name
        if name in ("tbl_owners", "downstream_users"):
            col = sets.as_set(F.from_json(raw_col(name).cast("string"), _JSON_SET))
        elif name in ("state", "desired_state"):
            col = state(name)
        else:
            col = raw_col(name).cast(field.dataType)
            if name in blank_if_null:
                col = F.coalesce(col, F.lit(""))
            elif name in zero_if_null:
                col = F.coalesce(col, F.lit(0))
            elif name == "pause_reason":
                col = F.coalesce(col, F.lit(v.NOT_PAUSED))
        out.append(col.alias(name))
    return raw.select(*out)


def _rename(col, names: dict[str, str]):
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), col)


def encode_jobs(jobs: DataFrame) -> DataFrame:
    """Typed jobs to storable rows: sets become JSON arrays, the empty set NULL."""

    def stored(name):
        clean = sets.as_set(F.col(name))
        return F.when(F.size(clean) > 0, F.to_json(clean)).alias(name)

    return jobs.select(
        *[stored(c) if c in ("tbl_owners", "downstream_users") else F.col(c) for c in jobs.columns]
    )


def upsert_jobs(jobs: DataFrame, changes: DataFrame, as_of) -> DataFrame:
    """Write changed jobs back by (task_id, name); unknown keys change nothing.

    One left join carries the new values to the rows they replace. ``changes``
    holds each key once (see ``settle_changes``) and any subset of the mutable
    columns; the others stay as they were. A ``version`` of the queue goes up by one
    in every row that is changed.
    """
    key = ["task_id", *KEY]
    moved = [c for c in MUTABLE_COLUMNS if c in changes.columns and c in jobs.columns]
    new = changes.select(
        *key, F.struct(*[F.col(c) for c in moved]).alias("__new")
    )
    hit = F.col("__new").isNotNull()
    out = []
    for name in jobs.columns:
        if name in moved:
            col = F.when(hit, F.col("__new")[name]).otherwise(F.col(name))
        elif name == "last_updated_time":
            col = F.when(hit, moment(as_of)).otherwise(F.col(name))
        elif name == "version":
            col = F.when(hit, F.coalesce(F.col(name), F.lit(0)) + 1).otherwise(F.col(name))
        else:
            col = F.col(name)
        out.append(col.alias(name))
    return jobs.join(new, key, "left").select(*out)


def settle_changes(
    jobs: DataFrame, changes: DataFrame, at: str = "changed_at", parts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(changes to make, rejects with a reason) of changes by several writers.

    Of the changes to one (task_id, name) the newest by ``at`` is made, the others come
    back as 'superseded'; at equal times the one with the greatest hash counts, and equal
    rows are one change. A change to a name that is not in the queue is 'unknown'. If the
    queue has a ``version``, changes carry that of the row they were made from; where it is
    not the row's any more, the change is 'stale', and does not stand in another's way.
    ``upsert_jobs`` raises the version of each row that it changes.

    The newest change is found by sums of fixed width, so a key that a third of all
    changes have is never in one buffer; the joins leave it to AQE's skew split.

    What a task sorts follows the size of Spark's shuffle partitions, whose number is fixed.
    For very many changes give ``parts``: both inputs are dealt by key to so many. AQE does not
    split a hot key then; its rows are sorted by one task, on disk where they do not fit.
    """
    key = ["task_id", *KEY]
    if parts:
        jobs, changes = jobs.repartition(parts, *key), changes.repartition(parts, *key)
    versioned = "version" in jobs.columns
    facts = [F.lit(True).alias("__known"), *([F.max("version").alias("__now")] if versioned else [])]
    known = jobs.groupBy(*key).agg(*facts)
    held = changes.withColumn("__hash", row_hash(changes)).join(known, key, "left")
    reason = F.when(F.col("__known").isNull(), "unknown")
    if versioned:
        reason = reason.when(~F.col("version").eqNullSafe(F.col("__now")), "stale")
    held = held.withColumn("__reason", reason)
    moment_of = F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(1 << 63)))
    held = held.withColumn("__at", moment_of)
    newest = (
        held.filter("__reason is null")
        .groupBy(*key, "__at")
        .agg(F.max("__hash").alias("__best"))
        .groupBy(*key)
        .agg(F.max("__at").alias("__last"), F.max_by("__best", "__at").alias("__best"))
    )
    judged = held.join(newest, key, "left")
    wins = F.col("__reason").isNull() & (F.col("__at") == F.col("__last")) & (F.col("__hash") == F.col("__best"))
    made = judged.filter(wins).select(*changes.columns).distinct()
    why = F.coalesce("__reason", F.lit("superseded")).alias("reason")
    return made, judged.filter(~F.coalesce(wins, F.lit(False))).select(*changes.columns, why)


def duplicate_keys(jobs: DataFrame) -> DataFrame:
    """Names that occur more than once in the queue (should be none)."""
    return jobs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def ingest_tables(lines: DataFrame, jobs: DataFrame, as_of) -> tuple[DataFrame, DataFrame]:
    """(new queue rows, rejected lines) for a text list of ``catalog/db/table``.

    New names are the distinct listed ones not yet queued; ids go on from the
    highest one in the queue.
    """
    line = F.col("value")
    parts = _split_name(line, "/")
    good = F.size(parts) == 3
    rejects = lines.filter(~good | line.isNull()).select(line.alias("line"))
    listed = lines.filter(good).select(*_as_key(parts)).distinct()
    fresh = listed.join(jobs.select(*KEY), KEY, "left_anti")
    numbered = number_rows(fresh, [], KEY, "__n")
    top = jobs.agg(F.max("task_id")).scalar()
    at = moment(as_of)
    values = {
        "task_id": F.coalesce(top, F.lit(0)) + F.col("__n"),
        "data_category": F.lit(v.UNKNOWN),
        "tbl_owners": sets.empty_set(),
        "downstream_users": sets.empty_set(),
        "to_be_processed": F.lit(0),
        "in_process": F.lit(0),
        "state": F.lit(v.NEW),
        "desired_state": F.lit(v.NEW),
        "initial_gap_days": F.lit(v.DEFAULT_INITIAL_GAP_DAYS),
        "probation_gap_days": F.lit(v.DEFAULT_PROBATION_GAP_DAYS),
        "migration_paused": F.lit(0),
        "pause_reason": F.lit(v.NOT_PAUSED),
        "created_at": at,
        "last_updated_time": at,
    }
    new_rows = numbered.select(
        *[
            (F.col(f.name) if f.name in KEY else values.get(f.name, F.lit(None)))
            .cast(f.dataType)
            .alias(f.name)
            for f in JOB.fields
        ]
    )
    return new_rows, rejects


def remove_jobs(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """The queue without the named tables."""
    return jobs.join(keys.select(*KEY).distinct(), KEY, "left_anti")


def lookup_jobs(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """Queue rows of the named tables; names not queued give no row."""
    return jobs.join(keys.select(*KEY).distinct(), KEY, "left_semi")


def missing_keys(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    """Named tables that are not in the queue."""
    return keys.select(*KEY).distinct().join(jobs.select(*KEY), KEY, "left_anti")


def read_table_list(lines: DataFrame, sep: str = ".") -> tuple[DataFrame, DataFrame]:
    """(keys, rejected lines) for qualified names separated by ``sep``.

    Names written with dots are trimmed and lower-cased, several to a line when
    separated by commas; names with slashes stand one to a line, as written.
    """
    line = F.col("line")
    if sep == ".":
        names = lines.select(F.explode_outer(F.split("value", ",")).alias("line"))
        parts = _split_name(F.lower(F.trim(line)), sep)
    else:
        names = lines.select(F.col("value").alias("line"))
        parts = _split_name(line, sep)
    good = F.size(parts) == 3
    keys = names.filter(good).select(*_as_key(parts)).distinct()
    rejects = names.filter(~good | line.isNull())
    return keys, rejects


def _split_name(name: Column, sep: str) -> Column:
    """Parts of a qualified name; separators at the end open no further part."""
    return F.split(F.regexp_replace(name, f"[{sep}]+$", ""), f"[{sep}]")


def _as_key(parts: Column) -> list[Column]:
    return [F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(KEY)]
