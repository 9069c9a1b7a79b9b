"""Notifications: who is due which mail, and the rendered mails as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carryall import vocabulary as v
from carryall.functions import sets
from carryall.functions.names import qualified
from carryall.functions.shards import number_rows
from carryall.functions.times import days, moment
from carryall.operators.enrich import mark_empty, owner_tables, source_format
from carryall.schemas import KEY

# Fixed value: pattern of the long date in mails.
LONG_DATE = "EEEE, MMMM d, yyyy"


def _in_domain(arr: Column, names: v.Naming) -> Column:
    return F.filter(sets.as_set(arr), lambda x: x.contains(names.mail_domain))


def recipients(jobs: DataFrame, names: v.Naming = v.DEFAULT) -> DataFrame:
    """Adds owner_mails and reader_mails.

    Only addresses with the mail domain get mail; readers who own the table and
    the service account get none.
    """
    readers = F.array_except(
        F.array_except(sets.as_set(F.col("downstream_users")), sets.as_set(F.col("tbl_owners"))),
        sets.literal_set([names.service_account]),
    )
    return jobs.withColumns(
        {
            "owner_mails": _in_domain(F.col("tbl_owners"), names),
            "reader_mails": F.filter(readers, lambda x: x.contains(names.mail_domain)),
        }
    )


def recipient_batches(
    rows: DataFrame, addresses: str, key: list[str], size: int = v.RECIPIENTS_PER_MAIL
) -> DataFrame:
    """One row per mail: (…, batch, recipients) from a set column; rows without addresses vanish.

    Groups are those of the pairs; ``key`` tells the rows apart.
    """
    pairs = rows.select(*key, F.explode(addresses).alias("__to"))
    cut = recipient_batches_of_pairs(pairs, key, "__to", size)
    return rows.drop(addresses).join(cut, key)


def recipient_batches_of_pairs(
    pairs: DataFrame, key: list[str], member: str, size: int = v.RECIPIENTS_PER_MAIL
) -> DataFrame:
    """One row per mail from (key, member) pairs: (key, batch, recipients).

    Members are numbered without bringing a set together; only the finished
    groups of at most ``size`` addresses are.
    """
    numbered = number_rows(pairs.select(*key, member).distinct(), key, [member], "__n")
    return (
        numbered.withColumn("batch", F.floor((F.col("__n") - 1) / F.lit(size)).cast("int"))
        .groupBy(*key, "batch")
        .agg(F.array_sort(F.collect_list(member)).alias("recipients"))
    )


def notify_gate(
    jobs: DataFrame,
    catalog: DataFrame,
    empty: DataFrame | None,
    as_of,
    names: v.Naming = v.DEFAULT,
) -> DataFrame:
    """Next version of the jobs plus due_level (1, 2, 3 or null) and send_mail.

    A due job is stamped even when nobody needs a mail; a first notice that finds
    the table missing, moved or not copyable pauses the job instead.
    """
    now = moment(as_of)
    facts = catalog.select(*KEY, source_format(names).alias("__src"))
    rows = mark_empty(jobs, empty).join(facts, KEY, "left")

    def rest(state):
        return (F.col("state") == state) & (F.col("desired_state") == state)

    first = (F.col("to_be_processed") == 1) & F.col("comm_level1_date").isNull()
    second = (
        ~first
        & (F.col("in_process") == 1)
        & rest(v.OPEN)
        & F.col("comm_level2_date").isNull()
        & F.coalesce(
            F.col("comm_level1_date") + days("initial_gap_days") <= now, F.lit(False)
        )
    )
    third = (
        ~first
        & (F.col("in_process") == 0)
        & rest(v.SOURCE_ARCHIVED)
        & F.col("comm_level3_date").isNull()
        & F.coalesce(
            F.col("comm_level2_date") + days("probation_gap_days") <= now, F.lit(False)
        )
    )
    missing = first & F.col("__src").isNull()
    moved = first & ~F.col("__src")
    copyable = F.coalesce(F.col("stg_format") == v.PARQUET, F.lit(False)) | F.col("is_empty")
    text = first & F.col("__src") & ~copyable
    announce = first & F.col("__src") & copyable
    pause = missing | F.coalesce(moved, F.lit(False)) | F.coalesce(text, F.lit(False))
    level = F.when(announce, 1).when(second, 2).when(third, 3)
    has_owner = F.size(_in_domain(F.col("tbl_owners"), names)) > 0
    mail = (
        F.when(level == 1, has_owner & (F.col("initial_gap_days") > 0))
        .when(level == 2, F.col("probation_gap_days") > 0)
        .when(level == 3, (F.col("initial_gap_days") > 0) | (F.col("probation_gap_days") > 0))
        .otherwise(False)
    )

    def stamp(name, n):
        return F.when(level == n, now).otherwise(F.col(name))

    new = {
        "comm_level1_date": stamp("comm_level1_date", 1),
        "comm_level2_date": stamp("comm_level2_date", 2),
        "comm_level3_date": stamp("comm_level3_date", 3),
        "migration_paused": F.when(pause, 1).otherwise(F.col("migration_paused")),
        "pause_reason": F.when(missing, v.TABLE_NOT_FOUND)
        .when(moved, v.ALREADY_TARGET)
        .when(text, v.TEXT_FORMAT)
        .otherwise(F.col("pause_reason")),
    }
    return rows.select(
        *[new.get(c, F.col(c)).alias(c) for c in jobs.columns],
        level.alias("due_level"),
        mail.alias("send_mail"),
    )


# ---------------------------------------------------------------- wording


def day_phrase(n: Column) -> Column:
    """"Shortly", "1 Day" or "n Days"."""
    return (
        F.when(n > 1, F.format_string("%d Days", n)).when(n == 1, "1 Day").otherwise("Shortly")
    )


def long_date(as_of, n: Column) -> Column:
    """The day ``n`` days ahead, such as Monday, July 6, 1998."""
    return F.date_format(F.date_add(moment(as_of).cast("date"), n), LONG_DATE)


def to_html(text: Column) -> Column:
    """Plain text as mail HTML; list items first, as they eat a line end."""
    out = F.regexp_replace(text, r"\*", "<li>")
    out = F.regexp_replace(out, "[.] \n", "</li>")
    out = F.regexp_replace(out, "\n\n", "<br><br>")
    out = F.regexp_replace(out, "\n", "<br>")
    return F.concat(F.lit("<html><body><p>"), out, F.lit("</p></body></html>"))


def _first_notice_reader(as_of, names: v.Naming) -> tuple[Column, Column]:
    table, when = qualified("."), long_date(as_of, F.col("initial_gap_days"))
    owners = F.array_join("owner_mails", ", ")
    subject = F.concat(
        F.lit("Table migration: "), table, F.lit(" will change its format on "), when
    )
    body = F.concat(
        F.lit("Hello,\n\nyou have read the table "),
        table,
        F.lit(" before. It will be moved to the new table format on "),
        when,
        F.lit(" ("),
        F.lower(day_phrase(F.col("initial_gap_days"))),
        F.lit(" from now).\n\nAfterwards the owners ("),
        owners,
        F.lit(
            ") may narrow down who can read it; until then access stays as it is. "
            f"Your queries need no change. More at {names.docs_url}.\n\n"
            f"To delay the move, please write to {names.support_channel} before that day."
        ),
    )
    return subject, body


def _probation_notice(names: v.Naming) -> tuple[Column, Column]:
    table, gap = qualified("."), F.col("probation_gap_days")
    period = F.when(gap > 0, F.format_string(" for %d Days", gap)).otherwise("")
    subject = F.concat(F.lit("Table migration: "), table, F.lit(" is on probation"), period)
    body = F.concat(
        F.lit("The table "),
        table,
        F.lit(" is now kept in the new table format.\n\nIf it troubles you"),
        F.when(gap > 0, F.format_string(" within the next %d Days", gap)).otherwise(""),
        F.lit(f", see {names.docs_url} on how to go back, or write to {names.support_channel}."),
    )
    return subject, body


def _done_notice() -> tuple[Column, Column]:
    table = qualified(".")
    subject = F.concat(F.lit("Table migration: "), table, F.lit(" is complete"))
    body = F.concat(
        F.lit("You own or have read the table "),
        table,
        F.lit(". Its move to the new table format is complete.\n\nThere is nothing left to do."),
    )
    return subject, body


def owner_digest(
    gated: DataFrame,
    as_of,
    names: v.Naming = v.DEFAULT,
    tables_per_mail: int = v.TABLES_PER_MAIL,
) -> DataFrame:
    """First notice to owners: (owner, part, parts, task_id, tables, subject, body).

    ``gated`` holds all jobs of the run. An owner of at least one job announced
    with a mail is told all of their tables in the run. The day comes from their
    announced job with the lowest task id. Like the number of recipients, a mail's
    number of tables is fixed; every digest says which part of how many it is.
    """
    announced = recipients(gated.filter((F.col("due_level") == 1) & F.col("send_mail")), names)
    triggers = (
        announced.select(
            F.explode("owner_mails").alias("owner"), "task_id", F.col("initial_gap_days").alias("gap")
        )
        .groupBy("owner")
        .agg(F.min(F.struct("task_id", "gap")).alias("first"))
    )
    pairs = owner_tables(gated).join(triggers, "owner")
    numbered = number_rows(pairs, ["owner"], ["table"], "__n", total="__tables")

    def page(n):
        return F.ceil(F.col(n) / F.lit(tables_per_mail)).cast("int")

    rows = (
        numbered.groupBy("owner", page("__n").alias("part"), page("__tables").alias("parts"), "first")
        .agg(F.array_sort(F.collect_list("table")).alias("tables"))
    )
    when = long_date(as_of, F.col("first.gap"))
    items = F.array_join(F.transform("tables", lambda t: F.concat(F.lit("* "), t, F.lit(". "))), "\n")
    subject = F.concat(
        F.lit("Table migration: tables you own will change their format on "),
        when,
        F.format_string(" (part %d of %d)", F.col("part"), F.col("parts")),
    )
    text = F.concat(
        F.lit("You own these tables:\n"),
        items,
        F.lit("\nThey will be moved to the new table format on "),
        when,
        F.lit(", which is "),
        F.lower(day_phrase(F.col("first.gap"))),
        F.lit(
            " from now.\n\nYou can narrow down who may read them afterwards. "
            f"What is not supported yet is listed at {names.docs_url}.\n"
            f"Please write to {names.support_channel} before that day to delay the move."
        ),
    )
    return rows.select(
        "owner",
        "part",
        "parts",
        F.col("first.task_id").alias("task_id"),
        "tables",
        subject.alias("subject"),
        to_html(text).alias("body"),
    )


def addressed_readers(
    due: DataFrame, readers: DataFrame | None = None, names: v.Naming = v.DEFAULT
) -> DataFrame:
    """(task_id, address) of the readers who get mail, any number of them.

    ``readers``(task_id, downstream_user) are the stored pairs; without them the
    queue's column is taken apart. Owners, the service account and addresses
    outside the mail domain get none.
    """
    if readers is None:
        readers = due.select("task_id", F.explode("downstream_users").alias("downstream_user"))
    user = F.col("downstream_user")
    return (
        readers.join(due.select("task_id", "tbl_owners"), "task_id")
        .filter(
            user.contains(names.mail_domain)
            & (user != names.service_account)
            & ~F.coalesce(F.array_contains("tbl_owners", user), F.lit(False))
        )
        .select("task_id", user.alias("address"))
        .distinct()
    )


def render_outbox(
    gated: DataFrame,
    as_of,
    names: v.Naming = v.DEFAULT,
    readers: DataFrame | None = None,
    tables_per_mail: int = v.TABLES_PER_MAIL,
) -> DataFrame:
    """All mails of a run: (level, audience, task_id, batch, recipients, subject, body, content_type).

    ``readers``: see ``addressed_readers``.
    """
    due = recipients(gated.filter("send_mail"), names)
    first = F.col("due_level") == 1
    s1, b1 = _first_notice_reader(as_of, names)
    s2, b2 = _probation_notice(names)
    s3, b3 = _done_notice()
    rows = due.select(
        F.col("due_level").alias("level"),
        F.when(first, "readers").otherwise("readers and owners").alias("audience"),
        "task_id",
        F.when(first, s1).when(F.col("due_level") == 2, s2).otherwise(s3).alias("subject"),
        F.when(first, b1).when(F.col("due_level") == 2, b2).otherwise(b3).alias("body"),
    )
    owners = due.filter(~first).select("task_id", F.explode("owner_mails").alias("address"))
    people = addressed_readers(due, readers, names).unionByName(owners)
    columns = ["level", "audience", "task_id", "batch", "recipients", "subject", "body"]
    batches = recipient_batches_of_pairs(people, ["task_id"], "address")
    mails = rows.join(batches, "task_id").select(*columns)
    digest = owner_digest(gated, as_of, names, tables_per_mail).select(
        F.lit(1).alias("level"),
        F.lit("owner").alias("audience"),
        "task_id",
        (F.col("part") - 1).alias("batch"),
        F.array("owner").alias("recipients"),
        "subject",
        "body",
    )
    text = mails.withColumn("content_type", F.lit("text"))
    return text.unionByName(digest.withColumn("content_type", F.lit("html")))
