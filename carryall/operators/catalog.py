"""Changes to the table catalogue, for all affected tables at once.

Renames and tag changes are first written down as *edits*, one row per affected
table, and then applied by a single left join. The edits double as the plan of
the physical renames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.operators.enrich import source_format
from carryall.schemas import DEFINITION_COLUMNS, KEY

_EDIT_TYPE = (
    "array<struct<tbl_name:string,new_name:string,drop_tags:array<string>,"
    "add_tags:array<string>,only_if_tagged:boolean,removed:boolean,secure:boolean>>"
)


# ---------------------------------------------------------------- helpers


def table_family(catalog: DataFrame, suffixes: dict[str, str], *facts: Column) -> DataFrame:
    """One row per base name with a struct column for each suffixed relative.

    ``suffixes`` maps a column label to a table-name suffix ("" is the table
    itself); a relative the catalogue lacks is null. Every catalogue row is read
    once and counts both as a table of its own and as a relative of its base.
    Without ``facts`` the columns are plain flags.
    """
    tbl = F.col("tbl_name")
    found = F.struct(*facts) if facts else F.lit(True)
    rows = catalog.select(*KEY, found.alias("__facts"))
    roles = []
    for label, suffix in suffixes.items():
        stem = F.expr(f"substring(tbl_name, 1, length(tbl_name) - {len(suffix)})")
        base = tbl if not suffix else F.when(F.endswith(tbl, F.lit(suffix)), stem)
        roles.append(F.struct(F.lit(label).alias("role"), base.alias("base")))
    by_role = (
        rows.select("*", F.explode(F.array(*roles)).alias("__r"))
        .filter(F.col("__r.base").isNotNull())
        .select(
            KEY[0],
            KEY[1],
            F.col("__r.base").alias(KEY[2]),
            F.col("__r.role").alias("__role"),
            "__facts",
        )
    )
    one = F.max if not facts else (lambda col: F.any_value(col, True))
    return by_role.groupBy(*KEY).agg(
        *[one(F.when(F.col("__role") == label, F.col("__facts"))).alias(label) for label in suffixes]
    )


def edit(
    tbl: Column,
    new_name: Column | None = None,
    drop_tags: Column | None = None,
    add_tags: Column | None = None,
    only_if_tagged: bool = False,
    removed: bool = False,
    secure: bool = False,
) -> Column:
    """One edit of a table; ``only_if_tagged`` adds tags only where a tag list exists."""
    none = F.lit(None)
    return F.struct(
        tbl.alias("tbl_name"),
        (none if new_name is None else new_name).cast("string").alias("new_name"),
        (sets.empty_set() if drop_tags is None else drop_tags).alias("drop_tags"),
        (sets.empty_set() if add_tags is None else add_tags).alias("add_tags"),
        F.lit(only_if_tagged).alias("only_if_tagged"),
        F.lit(removed).alias("removed"),
        F.lit(secure).alias("secure"),
    )


def _edits(rows: DataFrame, *conditional: Column) -> DataFrame:
    """Edits of each row that are not null, as rows keyed by the edited table.

    ``base`` is the table of the job that an edit belongs to.
    """
    listed = F.array_compact(F.array(*conditional)).cast(_EDIT_TYPE)
    return rows.select(KEY[0], KEY[1], F.col(KEY[2]).alias("base"), F.inline(listed))


def apply_edits(catalog: DataFrame, edits: DataFrame) -> DataFrame:
    """The catalogue after the edits.

    Tag edits of one table (a queued table may be another one's kept source) are
    merged; the grouping has the key of the join, so it costs no extra shuffle.
    """
    merged = edits.groupBy(*KEY).agg(
        F.max("new_name").alias("new_name"),
        F.flatten(F.collect_list("drop_tags")).alias("drop_tags"),
        F.flatten(F.collect_list("add_tags")).alias("add_tags"),
        F.bool_and("only_if_tagged").alias("only_if_tagged"),
        F.bool_or("removed").alias("removed"),
        F.bool_or("secure").alias("secure"),
    )
    change = merged.select(
        *KEY,
        F.struct("new_name", "drop_tags", "add_tags", "only_if_tagged", "removed", "secure").alias(
            "__e"
        ),
    )
    e = F.col("__e")
    dropped = F.array_except(sets.as_set(F.col("tags")), e["drop_tags"])
    tagged = F.array_sort(F.array_union(dropped, e["add_tags"]))
    adds, drops = F.size(e["add_tags"]) > 0, F.size(e["drop_tags"]) > 0
    untouched = F.when(F.col("tags").isNull(), e["only_if_tagged"] | ~adds).otherwise(~adds & ~drops)
    new = {
        "tbl_name": F.coalesce(e["new_name"], F.col("tbl_name")),
        "tags": F.when(e.isNull() | untouched, F.col("tags")).otherwise(tagged),
        "secure": F.when(e["secure"], F.lit(True)).otherwise(F.col("secure")),
    }
    return (
        catalog.join(change, KEY, "left")
        .filter(e.isNull() | ~e["removed"])
        .select(*[new.get(c, F.col(c)).alias(c) for c in catalog.columns])
    )


def rename_plan(edits: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Physical renames, each with the protective tags to lift before and put back after."""
    held = F.array_intersect(sets.as_set(F.col("tags")), sets.literal_set(names.protected_tags))
    moves = edits.filter(F.col("new_name").isNotNull()).select(*KEY, "new_name")
    return moves.join(catalog.select(*KEY, "tags"), KEY).select(
        *KEY, "new_name", F.array_sort(held).alias("held_tags")
    )


def physical_steps(edits: DataFrame) -> DataFrame:
    """What has to be done to the real tables of every job: (catalog, db, base, drops, renames).

    A job has a handful of relatives, so both lists are short. Renames are in no order:
    one waits until the name it takes is free.
    """
    rename = F.when(F.col("new_name").isNotNull(), F.struct("tbl_name", "new_name"))
    return edits.groupBy(KEY[0], KEY[1], "base").agg(
        F.collect_set(F.when(F.col("removed"), F.col("tbl_name"))).alias("drops"),
        F.collect_set(rename).alias("renames"),
    )


def target_entries(
    copied: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> DataFrame:
    """The catalogue with entries for new targets: copied(key, location) of the queued tables.

    A target has the fields of its table and is in target format; it starts without tags.
    An entry that an earlier try left is replaced.
    """
    none = F.lit(None)
    source = catalog.join(copied.select(*KEY, F.col("location").alias("__at")), KEY)
    known = {
        "tbl_name": F.concat("tbl_name", F.lit(names.target_suffix)),
        "table_type": F.lit(names.target_marker.upper()),
        "data_uri": F.col("__at"),
        **{c: none for c in ("serde_uri", "data_size", "tags", "secure", "migrated_data_location")},
    }
    types = dict(catalog.dtypes)
    new = source.select(*[known.get(c, F.col(c)).cast(types[c]).alias(c) for c in catalog.columns])
    return catalog.join(new.select(*KEY), KEY, "left_anti").unionByName(new)


def drop_plan(edits: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Physical drops, to be done before the renames, with the protective tags to lift first."""
    held = F.array_intersect(sets.as_set(F.col("tags")), sets.literal_set(names.protected_tags))
    gone = edits.filter("removed").select(*KEY).distinct()
    return gone.join(catalog.select(*KEY, "tags"), KEY).select(*KEY, F.array_sort(held).alias("held_tags"))


# ---------------------------------------------------------------- tags


def add_tags(catalog: DataFrame, changes: DataFrame, mode: str = "append") -> DataFrame:
    """Tags from changes(key, tags) put on the named tables.

    append adds to the present tags; add does so only where a tag list exists;
    replace drops what was there. Unknown tables and (but for replace) empty
    sets change nothing.
    """
    wanted = changes.select(*KEY, sets.as_set(F.transform("tags", lambda t: F.trim(t))).alias("__new"))
    old, new = F.col("tags"), F.col("__new")
    joined = F.array_sort(F.array_union(sets.as_set(old), new))
    if mode == "append":
        tags = F.when(F.size(new) > 0, joined).otherwise(old)
    elif mode == "add":
        tags = F.when((F.size(new) > 0) & old.isNotNull(), joined).otherwise(old)
    elif mode == "replace":
        tags = F.when(new.isNotNull(), new).otherwise(old)
    else:
        raise ValueError(f"unknown tag mode: {mode}")
    return catalog.join(wanted, KEY, "left").select(
        *[tags.alias(c) if c == "tags" else F.col(c) for c in catalog.columns]
    )


def remove_tags(catalog: DataFrame, changes: DataFrame) -> DataFrame:
    """The named tables without the tags of changes(key, tags)."""
    unwanted = changes.select(*KEY, sets.as_set(F.col("tags")).alias("__gone"))
    old = F.col("tags")
    kept = F.array_except(old, F.coalesce("__gone", sets.empty_set()))
    tags = F.when(F.col("__gone").isNotNull() & old.isNotNull(), kept).otherwise(old)
    return catalog.join(unwanted, KEY, "left").select(
        *[tags.alias(c) if c == "tags" else F.col(c) for c in catalog.columns]
    )


# ---------------------------------------------------------------- locks


def lock_edits(jobs: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Marks the jobs' tables as not to be modified (where they have a tag list)."""
    tag = sets.literal_set([names.lock_tag])
    return _edits(jobs, edit(F.col("tbl_name"), add_tags=tag, only_if_tagged=True))


def unlock_edits(jobs: DataFrame, names: v.Naming = v.DEFAULT, production: bool = False) -> DataFrame:
    """Takes the lock off a job's table and its kept source, and tags the latter.

    In production the table itself is also marked secure.
    """
    lock = sets.literal_set([names.lock_tag])
    tbl = F.col("tbl_name")
    return _edits(
        jobs,
        edit(tbl, drop_tags=lock, secure=production),
        edit(
            F.concat(tbl, F.lit(names.source_suffix)),
            drop_tags=lock,
            add_tags=sets.literal_set([names.archived_tag]),
            only_if_tagged=True,
        ),
    )


def lock_tables(catalog: DataFrame, jobs: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    return apply_edits(catalog, lock_edits(jobs, names))


def unlock_tables(
    catalog: DataFrame, jobs: DataFrame, names: v.Naming = v.DEFAULT, production: bool = False
) -> DataFrame:
    return apply_edits(catalog, unlock_edits(jobs, names, production))


def writable_tables(catalog: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Tables that do not carry the lock tag."""
    locked = F.coalesce(F.array_contains("tags", names.lock_tag), F.lit(False))
    return catalog.filter(~locked)


# ---------------------------------------------------------------- renames


def _with_family(jobs: DataFrame, catalog: DataFrame, suffixes: dict[str, str], *facts) -> DataFrame:
    # A table queued twice is handled once; the join has the same key.
    return jobs.select(*KEY).distinct().join(table_family(catalog, suffixes, *facts), KEY, "left")


def _rejects(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.select(*KEY, reason.alias("reason")).filter(F.col("reason").isNotNull())


def promote(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): the table steps aside and its copy takes the name.

    Either rename is left out when it was done before, so a retry is harmless.
    """
    rows = _with_family(
        jobs, catalog, {"base": "", "kept": names.source_suffix, "copy": names.target_suffix}
    )
    has = {c: F.col(c).isNotNull() for c in ("base", "kept", "copy")}
    tbl = F.col("tbl_name")
    reason = F.when(~has["base"] & ~has["kept"], "table not found").when(
        has["base"] & has["kept"] & has["copy"], "name already taken"
    )
    fine = reason.isNull()
    edits = _edits(
        rows,
        F.when(
            fine & has["base"] & ~has["kept"],
            edit(tbl, new_name=F.concat(tbl, F.lit(names.source_suffix))),
        ),
        F.when(
            fine & has["copy"], edit(F.concat(tbl, F.lit(names.target_suffix)), new_name=tbl)
        ),
    )
    return edits, _rejects(rows, reason)


def restore(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): the target steps aside and the kept source gets its name back."""
    rows = _with_family(
        jobs, catalog, {"base": "", "kept": names.source_suffix, "copy": names.target_suffix}
    )
    has = {c: F.col(c).isNotNull() for c in ("base", "kept", "copy")}
    tbl = F.col("tbl_name")
    reason = (
        F.when(~has["base"], "table not found")
        .when(~has["kept"], "no source to restore")
        .when(has["copy"], "name already taken")
    )
    fine = reason.isNull()
    edits = _edits(
        rows,
        F.when(fine, edit(tbl, new_name=F.concat(tbl, F.lit(names.target_suffix)))),
        F.when(fine, edit(F.concat(tbl, F.lit(names.source_suffix)), new_name=tbl)),
    )
    return edits, _rejects(rows, reason)


def _set_aside(
    jobs: DataFrame, catalog: DataFrame, suffix: str, further: str, lock: str, tags: Column | None
) -> tuple[DataFrame, DataFrame]:
    """Renames <t><suffix> to <t><suffix><further>, unlocked, unless that name exists."""
    rows = _with_family(jobs, catalog, {"here": suffix, "there": suffix + further})
    here, there = F.col("here").isNotNull(), F.col("there").isNotNull()
    old = F.concat(F.col("tbl_name"), F.lit(suffix))
    edits = _edits(
        rows,
        F.when(
            here & ~there,
            edit(
                old,
                new_name=F.concat(old, F.lit(further)),
                drop_tags=sets.literal_set([lock]),
                add_tags=tags,
            ),
        ),
    )
    return edits, _rejects(rows, F.when(~here & ~there, "table not found"))


def archive_source(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): the kept source is archived and protected."""
    tags = sets.literal_set([names.archived_tag, *names.protected_tags])
    return _set_aside(
        jobs, catalog, names.source_suffix, names.archived_suffix, names.lock_tag, tags
    )


def retire_target(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): a reverted target is set aside under the retired suffix."""
    return _set_aside(
        jobs, catalog, names.target_suffix, names.retired_suffix, names.lock_tag, None
    )


def swap_back_finalized(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, outcome): archived sources of finished migrations take their names back.

    The target table goes to its archive name, replacing what was there; the
    source loses its protection and gets the target's tags. The outcome has a
    row per job with ``swapped`` and the reason where it could not be done.
    """
    old_source = names.source_suffix + names.archived_suffix
    old_target = names.target_suffix + names.archived_suffix
    rows = _with_family(
        jobs,
        catalog,
        {"base": "", "stored": old_source, "former": old_target},
        source_format(names).alias("src"),
        sets.as_set(F.col("tags")).alias("tags"),
    )
    tbl = F.col("tbl_name")
    reason = (
        F.when(F.col("base").isNull(), "table not found")
        .when(F.col("base.src"), "already in source format")
        .when(F.col("stored").isNull(), "migration not finalized")
    )
    fine = reason.isNull()
    edits = _edits(
        rows,
        F.when(fine, edit(tbl, new_name=F.concat(tbl, F.lit(old_target)))),
        F.when(
            fine,
            edit(
                F.concat(tbl, F.lit(old_source)),
                new_name=tbl,
                drop_tags=sets.literal_set(names.protected_tags),
                add_tags=F.coalesce(F.col("base.tags"), sets.empty_set()),
            ),
        ),
        F.when(
            fine & F.col("former").isNotNull(),
            edit(F.concat(tbl, F.lit(old_target)), removed=True),
        ),
    )
    outcome = rows.select(*KEY, fine.alias("swapped"), reason.alias("reason"))
    return edits, outcome


def unarchive_source(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(edits, rejects): archived sources go back to the kept name before a revert."""
    stored = names.source_suffix + names.archived_suffix
    rows = _with_family(jobs, catalog, {"stored": stored, "kept": names.source_suffix})
    tbl = F.col("tbl_name")
    here, taken = F.col("stored").isNotNull(), F.col("kept").isNotNull()
    edits = _edits(
        rows,
        F.when(
            here & ~taken,
            edit(
                F.concat(tbl, F.lit(stored)),
                new_name=F.concat(tbl, F.lit(names.source_suffix)),
                drop_tags=sets.literal_set(names.protected_tags),
            ),
        ),
    )
    return edits, _rejects(rows, F.when(here & taken, "name already taken"))


# ---------------------------------------------------------------- metadata


def merge_definitions(source: Column, target: Column, names: v.Naming = v.DEFAULT) -> Column:
    """The definition document of a target: the source's, but for the keys that are its own.

    Keys that nobody here knows go along. A key that the side it is taken from lacks, or
    has as null, is left out; a missing document counts as an empty one.
    """
    none = F.create_map().cast("map<string,string>")
    own = list(names.own_definition_keys)

    def rule(key, ours, theirs):
        return F.when(key.isin(own), theirs).otherwise(ours) if own else ours

    both = F.map_zip_with(F.coalesce(source, none), F.coalesce(target, none), rule)
    return F.map_filter(both, lambda _, value: value.isNotNull())


def copy_definition(
    jobs: DataFrame, catalog: DataFrame, names: v.Naming = v.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """(catalogue, rejects): definition metadata of the kept source put on the target.

    The target also learns where the data came from (unless the source says so
    already) and is tagged as migrated. Where the catalogue has a ``definition`` column,
    a map of whatever else defines a table, all of the source's keys go along. Nothing
    changes when either table is missing or the target is locked; a source without a
    location is rejected.
    """
    document = ["definition"] if "definition" in catalog.columns else []
    family = table_family(
        catalog,
        {"__to": "", "__from": names.source_suffix},
        *[F.col(c) for c in [*DEFINITION_COLUMNS, *document]],
        F.col("data_uri"),
        sets.as_set(F.col("tags")).alias("tags"),
    )
    pairs = jobs.select(*KEY).distinct().join(family, KEY).filter(
        F.col("__to").isNotNull()
        & F.col("__from").isNotNull()
        & ~F.array_contains("__to.tags", names.lock_tag)
    )
    location = F.coalesce("__from.migrated_data_location", "__from.data_uri")
    tags = F.array_sort(F.array_union("__from.tags", sets.literal_set([names.migrated_tag])))
    moved = [F.col(f"__from.{c}") for c in DEFINITION_COLUMNS if c != "migrated_data_location"]
    if document:
        merged = merge_definitions(F.col("__from.definition"), F.col("__to.definition"), names)
        moved.append(merged.alias("definition"))
    updates = pairs.filter(location.isNotNull()).select(
        *KEY, F.struct(*moved, location.alias("migrated_data_location"), tags.alias("tags")).alias("__new")
    )
    changed = {*DEFINITION_COLUMNS, *document, "tags"}
    new_catalog = catalog.join(updates, KEY, "left").select(
        *[
            F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in catalog.columns
        ]
    )
    return new_catalog, _rejects(pairs, F.when(location.isNull(), "source has no location"))


# What a target keeps of its own data-catalogue record.
_OWN_RECORD_COLUMNS = ("id", "location", "source_link")


def copy_classification(
    jobs: DataFrame, records: DataFrame, names: v.Naming = v.DEFAULT
) -> DataFrame:
    """Data-catalogue records with those of kept sources copied to their targets.

    A target keeps its id, name, location and link; one without a record of its
    own is left alone, and so is one whose source has none.
    """
    payload = [c for c in records.columns if c not in (*KEY, *_OWN_RECORD_COLUMNS)]
    family = table_family(
        records, {"__to": "", "__from": names.source_suffix}, *[F.col(c) for c in payload]
    )
    updates = (
        jobs.select(*KEY)
        .distinct()
        .join(family, KEY)
        .filter(F.col("__to").isNotNull() & F.col("__from").isNotNull())
        .select(*KEY, F.col("__from").alias("__new"))
    )
    return records.join(updates, KEY, "left").select(
        *[
            F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c)
            if c in payload
            else F.col(c)
            for c in records.columns
        ]
    )


def set_secure(catalog: DataFrame, keys: DataFrame) -> DataFrame:
    """The named tables marked secure."""
    hit = keys.select(*KEY).distinct().withColumn("__hit", F.lit(True))
    value = F.when(F.col("__hit"), F.lit(True)).otherwise(F.col("secure"))
    return catalog.join(hit, KEY, "left").select(
        *[value.alias(c) if c == "secure" else F.col(c) for c in catalog.columns]
    )


def set_owner(catalog: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner ids from owners(key, owner_user_id) put on the named tables."""
    given = owners.select(*KEY, F.col("owner_user_id").alias("__owner"))
    value = F.coalesce("__owner", "owner_user_id")
    return catalog.join(given, KEY, "left").select(
        *[value.alias(c) if c == "owner_user_id" else F.col(c) for c in catalog.columns]
    )
