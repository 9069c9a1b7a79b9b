"""Names and settings shared by all operators.

Everything a deployment may want to spell its own way (suffixes, tags, mail
domain, markers) is a field of ``Naming`` and is passed in, never looked up.
"""

from __future__ import annotations

from dataclasses import dataclass

# Job states.
NEW = "NEW"
READY = "READY"
LOCKED = "LOCKED"
COPIED = "COPIED"
TARGET_PRIMARY = "TARGET_PRIMARY"
OPEN = "OPEN"
SOURCE_ARCHIVED = "SOURCE_ARCHIVED"
SYNCED_BACK = "SYNCED_BACK"
SOURCE_PRIMARY = "SOURCE_PRIMARY"
TARGET_RETIRED = "TARGET_RETIRED"

STATES = (
    NEW,
    READY,
    LOCKED,
    COPIED,
    TARGET_PRIMARY,
    OPEN,
    SOURCE_ARCHIVED,
    SYNCED_BACK,
    SOURCE_PRIMARY,
    TARGET_RETIRED,
)

# Why a job is paused.
NOT_PAUSED = "None"
TABLE_NOT_FOUND = "TABLE_NOT_FOUND"
ALREADY_TARGET = "ALREADY_TARGET"
TEXT_FORMAT = "TEXT_FORMAT"
REVERTED = "REVERTED"

# Storage formats, data categories, mirror status.
PARQUET = "parquet"
TEXT = "csv/text"
CORE_PI = "CORE_PI"
PI = "PI"
NO_PI = "NO_PI"
UNKNOWN = "UNKNOWN"
MIRRORING = "MIRRORING"

# The two ways a job can be walked through its states.
FORWARD = "forward"
REVERT = "revert"

# Fixed values: (state, desired) -> action, then the (state, desired) the action
# leaves behind when walking forward and when reverting.
TRANSITIONS = (
    (READY, LOCKED, "lock", (LOCKED, COPIED), (LOCKED, SYNCED_BACK)),
    (LOCKED, COPIED, "copy", (COPIED, TARGET_PRIMARY), (COPIED, TARGET_PRIMARY)),
    (COPIED, TARGET_PRIMARY, "promote", (TARGET_PRIMARY, OPEN), (TARGET_PRIMARY, OPEN)),
    (TARGET_PRIMARY, OPEN, "unlock", (OPEN, OPEN), (OPEN, TARGET_RETIRED)),
    (OPEN, LOCKED, "lock", (LOCKED, COPIED), (LOCKED, SYNCED_BACK)),
    (LOCKED, SYNCED_BACK, "mirror_back", (SYNCED_BACK, SOURCE_PRIMARY), (SYNCED_BACK, SOURCE_PRIMARY)),
    (SYNCED_BACK, SOURCE_PRIMARY, "restore", (SOURCE_PRIMARY, OPEN), (SOURCE_PRIMARY, OPEN)),
    (SOURCE_PRIMARY, OPEN, "unlock", (OPEN, OPEN), (OPEN, TARGET_RETIRED)),
    (OPEN, TARGET_RETIRED, "retire_target", (TARGET_RETIRED, TARGET_RETIRED), (TARGET_RETIRED, TARGET_RETIRED)),
    (OPEN, SOURCE_ARCHIVED, "archive_source", (SOURCE_ARCHIVED, SOURCE_ARCHIVED), (SOURCE_ARCHIVED, SOURCE_ARCHIVED)),
)

# Queue defaults of a freshly ingested table.
DEFAULT_INITIAL_GAP_DAYS = 14
DEFAULT_PROBATION_GAP_DAYS = 0

# Fixed value: most addresses one mail may carry.
RECIPIENTS_PER_MAIL = 50
# Tables listed in one owner digest.
TABLES_PER_MAIL = 1000


@dataclass(frozen=True)
class Naming:
    """Spelling of table suffixes, tags and markers in one deployment."""

    source_suffix: str = "_source"
    target_suffix: str = "_target"
    archived_suffix: str = "_archived"
    retired_suffix: str = "_revert"
    # Substrings that tell the two table formats apart in catalogue entries.
    source_marker: str = "hive"
    target_marker: str = "iceberg"
    # Databases whose tables are always rewritten, never snapshotted.
    rewrite_db_prefixes: tuple[str, ...] = ()
    lock_tag: str = "migration_do_not_modify"
    no_rename_tag: str = "do_not_rename"
    no_drop_tag: str = "do_not_drop"
    archived_tag: str = "archived_source"
    migrated_tag: str = "migrated_from_source"
    # Keys of the definition document that a target keeps of its own.
    own_definition_keys: tuple[str, ...] = ()
    mail_domain: str = "@example.com"
    service_account: str = "table_scanner@example.com"
    support_channel: str = "the data platform desk"
    docs_url: str = "https://docs.example.com/table-migration"

    @property
    def protected_tags(self) -> tuple[str, str]:
        return (self.no_rename_tag, self.no_drop_tag)


DEFAULT = Naming()
