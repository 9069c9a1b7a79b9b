"""Lifecycle, catalogue and outbox on small hand-made inputs."""

from __future__ import annotations

from dataclasses import replace

import itertools

from pyspark.sql import functions as F

from carryall import vocabulary as v
from carryall.operators import catalog as cat
from carryall.operators import lifecycle, outbox
from carryall.schemas import CATALOG, KEY
from test_queue import AS_OF, job, jobs


def entry(tbl, **over):
    row = {f.name: None for f in CATALOG.fields} | {
        "catalog_name": "cat",
        "db_name": "db",
        "tbl_name": tbl,
        "table_type": "EXTERNAL_TABLE",
        "output_format": "x.ParquetOutput",
        "data_size": 5,
        "data_uri": f"file:/{tbl}",
    }
    return tuple((row | over).values())


def catalog(spark, *rows):
    return spark.createDataFrame(list(rows), CATALOG)


def names(df):
    return sorted(r.tbl_name for r in df.collect())


def test_every_pair_of_states_comes_to_rest(spark):
    starts = [job(i, state=s, desired_state=d) for i, (s, d) in enumerate(itertools.product(v.STATES, v.STATES))]
    for flow in (v.FORWARD, v.REVERT):
        for is_source in (True, False):
            queue = jobs(spark, *starts).withColumn("is_source", F.lit(is_source))
            done = lifecycle.advance_jobs(queue, flow)
            assert done.count() == len(starts)
            # A second walk finds nothing to do, but for refused copies.
            rest = lifecycle.advance_jobs(done.drop("actions"), flow).filter(
                (F.size("actions") > 0) & (F.col("migration_paused") == 0)
            )
            assert rest.count() == 0
            assert done.agg(F.max(F.size("actions"))).first()[0] <= 5


def test_step_by_step_equals_the_walk(spark):
    pairs = [(s, d) for s, d, *_ in v.TRANSITIONS]
    queue = jobs(spark, *[job(i, state=s, desired_state=d) for i, (s, d) in enumerate(pairs)])
    for flow in (v.FORWARD, v.REVERT):
        walked = {r.task_id: (r.state, r.desired_state, r.actions) for r in lifecycle.advance_jobs(queue, flow).collect()}
        at, taken = queue, {i: [] for i in range(len(pairs))}
        for _ in range(6):
            step = lifecycle.next_action(at, flow)
            for r in step.collect():
                if r.action:
                    taken[r.task_id].append(r.action)
            at = step.withColumns(
                {"state": F.coalesce("next_state", "state"), "desired_state": F.coalesce("next_desired", "desired_state")}
            ).select(*queue.columns)
        ends = {r.task_id: (r.state, r.desired_state, taken[r.task_id]) for r in at.collect()}
        assert ends == walked


def test_held_jobs_take_no_step(spark):
    queue = jobs(spark, job(1, state=v.READY, desired_state=v.LOCKED)).withColumn("gate", F.lit("hold"))
    done = lifecycle.advance_jobs(queue, only=F.col("gate") == "go").first()
    assert (done.state, done.desired_state, done.actions) == (v.READY, v.LOCKED, [])


def test_promote_is_idempotent(spark):
    queue = jobs(spark, job(1))
    start = catalog(spark, entry("t1", tags=["do_not_drop"]), entry("t1_target"), entry("other"))
    edits, rejects = cat.promote(queue, start)
    once = cat.apply_edits(start, edits)
    assert names(once) == ["other", "t1", "t1_source"] and rejects.count() == 0
    assert once.filter("tbl_name = 't1_source'").first().tags == ["do_not_drop"]
    plan = cat.rename_plan(edits, start)
    assert {r.tbl_name: r.held_tags for r in plan.collect()} == {"t1": ["do_not_drop"], "t1_target": []}
    edits, rejects = cat.promote(queue, once)
    assert edits.count() == 0 and rejects.count() == 0
    # A run that broke off between the two renames is finished by the next one.
    half = catalog(spark, entry("t1_source"), entry("t1_target"))
    edits, _ = cat.promote(queue, half)
    assert names(cat.apply_edits(half, edits)) == ["t1", "t1_source"]


def test_archive_is_idempotent(spark):
    queue = jobs(spark, job(1))
    start = catalog(spark, entry("t1"), entry("t1_source", tags=["migration_do_not_modify", "mine"]))
    edits, _ = cat.archive_source(queue, start)
    once = cat.apply_edits(start, edits)
    stored = once.filter("tbl_name = 't1_source_archived'").first()
    assert stored.tags == ["archived_source", "do_not_drop", "do_not_rename", "mine"]
    edits, rejects = cat.archive_source(queue, once)
    assert edits.count() == 0 and rejects.count() == 0
    edits, rejects = cat.archive_source(jobs(spark, job(2)), once)
    assert edits.count() == 0 and [r.reason for r in rejects.collect()] == ["table not found"]


def test_a_table_may_be_queued_and_be_a_kept_source(spark):
    queue = jobs(spark, job(1), job(2, tbl_name="t1_source"))
    start = catalog(spark, entry("t1", tags=["a"]), entry("t1_source", tags=["migration_do_not_modify"]))
    after = cat.unlock_tables(start, queue)
    assert after.count() == 2
    assert after.filter("tbl_name = 't1_source'").first().tags == ["archived_source"]


def test_lock_hides_a_table_from_the_writable_ones(spark):
    start = catalog(spark, entry("t1", tags=[]), entry("t2", tags=None))
    locked = cat.lock_tables(start, jobs(spark, job(1), job(2), job(3)))
    # Without a tag list the tag cannot be set.
    assert names(cat.writable_tables(locked)) == ["t2"]
    again = cat.unlock_tables(locked, jobs(spark, job(1)))
    assert names(cat.writable_tables(again)) == ["t1", "t2"]


def test_wildcards_in_names_are_plain_letters(spark):
    queue = jobs(spark, job(1, tbl_name="a_b"))
    start = catalog(spark, entry("a_b"), entry("axb_source"), entry("a_bXsource"))
    edits, _ = cat.promote(queue, start)
    assert names(cat.apply_edits(start, edits)) == ["a_bXsource", "a_b_source", "axb_source"]
    aex = jobs(spark, job(1, db_name="aex1"), job(2, db_name="ae_1")).withColumn("is_empty", F.lit(False))
    own = replace(v.DEFAULT, rewrite_db_prefixes=("ae_",))
    got = {r.task_id: r.strategy for r in lifecycle.copy_strategy(aex, start, names=own).collect()}
    assert got == {1: "SNAPSHOT", 2: "REWRITE"}
    assert {r.strategy for r in lifecycle.copy_strategy(aex, start).collect()} == {"SNAPSHOT"}


def test_mail_bounds_are_inclusive(spark):
    queue = jobs(spark, *[job(i, in_process=1, state=v.OPEN, desired_state=v.OPEN) for i in (1, 2)])
    when = F.when(F.col("task_id") == 1, "2024-02-16 12:00:00").otherwise("2024-02-16 12:00:01")
    queue = queue.withColumn("comm_level1_date", when.cast("timestamp_ntz")).withColumn("is_empty", F.lit(False))
    gated = outbox.notify_gate(queue, catalog(spark, entry("t1")), None, AS_OF)
    assert {r.task_id: r.due_level for r in gated.collect()} == {1: 2, 2: None}


def test_first_notice_is_stamped_without_owners_and_paused_without_table(spark):
    first = dict(to_be_processed=1, state=v.READY, desired_state=v.LOCKED)
    queue = jobs(spark, job(1, **first), job(2, **first), job(3, **first), job(4, stg_format="csv/text", **first))
    entries = catalog(spark, entry("t1"), entry("t3", table_type="ICEBERG"), entry("t4"))
    gated = outbox.notify_gate(queue.withColumn("is_empty", F.lit(False)), entries, None, AS_OF)
    got = {r.task_id: (r.due_level, r.send_mail, r.pause_reason, r.comm_level1_date is not None) for r in gated.collect()}
    assert got == {
        1: (1, False, "None", True),
        2: (None, False, v.TABLE_NOT_FOUND, False),
        3: (None, False, v.ALREADY_TARGET, False),
        4: (None, False, v.TEXT_FORMAT, False),
    }


def _announced(spark, n, **over):
    first = dict(to_be_processed=1, state=v.READY, desired_state=v.LOCKED, tbl_owners=["o@example.com", "x@else.org"])
    queue = jobs(spark, *[job(i, **(first | over)) for i in range(1, n + 1)]).withColumn("is_empty", F.lit(False))
    return outbox.notify_gate(queue, catalog(spark, *[entry(f"t{i}") for i in range(1, n + 1)]), None, AS_OF)


def test_an_owner_gets_one_digest_of_all_tables(spark):
    mails = outbox.render_outbox(_announced(spark, 7), AS_OF).collect()
    assert len(mails) == 1
    mail = mails[0]
    assert (mail.recipients, mail.content_type, mail.task_id) == (["o@example.com"], "html", 1)
    assert mail.body.count("<li>") == 7 and "Friday, March 15, 2024" in mail.subject


def test_a_long_digest_goes_on_in_parts(spark):
    parts = outbox.owner_digest(_announced(spark, 7), AS_OF, tables_per_mail=3).collect()
    assert sorted(len(r.tables) for r in parts) == [1, 3, 3]
    assert {r.parts for r in parts} == {3} and sorted(r.part for r in parts) == [1, 2, 3]
    assert sorted(t for r in parts for t in r.tables) == [f"cat.db.t{i}" for i in range(1, 8)]


def test_stored_readers_are_mailed_however_many(spark):
    gated = _announced(spark, 1)
    people = [f"r{i}@example.com" for i in range(10_130)]
    more = ["o@example.com", "table_scanner@example.com", "nobody"]
    readers = spark.createDataFrame([(1, u) for u in people + more], "task_id bigint, downstream_user string")
    mails = outbox.render_outbox(gated, AS_OF, readers=readers).filter("audience = 'readers'").collect()
    assert sorted(r.batch for r in mails) == list(range(203))
    assert sorted(len(r.recipients) for r in mails) == [30] + [50] * 202
    assert sorted(u for r in mails for u in r.recipients) == sorted(people)


def test_readers_of_the_queue_are_grouped_like_stored_ones(spark):
    people = [f"r{i}@example.com" for i in range(60)]
    gated = _announced(spark, 1, downstream_users=people)
    readers = spark.createDataFrame([(1, u) for u in people], "task_id bigint, downstream_user string")
    listed = lambda df: sorted((r.batch, r.recipients) for r in df.filter("audience = 'readers'").collect())
    assert listed(outbox.render_outbox(gated, AS_OF)) == listed(outbox.render_outbox(_announced(spark, 1), AS_OF, readers=readers))


def test_html_order(spark):
    text = "* a. \n* b. \n\nend\n\nx\ny"
    got = spark.range(1).select(outbox.to_html(F.lit(text))).first()[0]
    assert got == "<html><body><p><li> a</li><li> b</li><br>end<br><br>x<br>y</p></body></html>"


def test_day_phrases(spark):
    got = spark.createDataFrame([(0,), (1,), (2,)], "n int").select(outbox.day_phrase(F.col("n")))
    assert [r[0] for r in got.collect()] == ["Shortly", "1 Day", "2 Days"]


def test_key_columns():
    assert KEY == ["catalog_name", "db_name", "tbl_name"]


def test_definition_documents_are_merged_by_key(spark):
    from dataclasses import replace

    from carryall import vocabulary as v
    from carryall.operators.catalog import merge_definitions

    names = replace(v.DEFAULT, own_definition_keys=("link", "absent"))
    rows = [
        (1, {"a": "s", "link": "s", "gone": None}, {"b": "t", "link": "t"}),
        (2, {"a": "s", "link": "s"}, None),
        (3, None, {"b": "t", "link": "t"}),
        (4, None, None),
    ]
    df = spark.createDataFrame(rows, "n int, s map<string,string>, t map<string,string>")
    got = {r.n: r.d for r in df.select("n", merge_definitions(df.s, df.t, names).alias("d")).collect()}
    assert got == {1: {"a": "s", "link": "t"}, 2: {"a": "s"}, 3: {"link": "t"}, 4: {}}
    assert df.select(merge_definitions(df.s, df.t).alias("d")).first().d == {"a": "s", "link": "s"}
