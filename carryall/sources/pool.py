"""Work on many tables at once, each apart from the others."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Any, NamedTuple

from pyspark.sql import SparkSession

# Tables worked on at the same time.
WIDTH = 8


class Outcome(NamedTuple):
    """What became of one item: its value, or the error that ended it."""

    item: Any
    value: Any
    error: str | None


def own_session(spark: SparkSession) -> SparkSession:
    """A session over the same catalogue whose settings are its own.

    Writers change settings (the name of new files, the overwrite mode), which would
    reach every other writer of a shared session.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    return session


def error_text(problem: Exception) -> str:
    """The class and the first line of an error, for a table of outcomes."""
    lines = str(problem).strip().splitlines()
    return f"{type(problem).__name__}: {lines[0] if lines else ''}"[:500]


def each(
    spark: SparkSession,
    items: Iterable,
    work: Callable[[SparkSession, Any], Any],
    width: int = WIDTH,
    pool: str = "tables",
) -> Iterator[Outcome]:
    """Calls ``work(session, item)`` for every item, some at a time, in any order.

    Every thread has a session and a scheduler pool of its own, so that under
    ``spark.scheduler.mode=FAIR`` a small table does not wait for a big one. An item
    that fails gives its error and leaves the others alone. Items are taken as threads
    get free: no more than twice ``width`` are held at a time.
    """
    local = threading.local()
    serial = iter(range(width))

    def begin() -> None:
        local.session = own_session(spark)
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{pool}-{next(serial)}")

    def run(item) -> Outcome:
        try:
            return Outcome(item, work(local.session, item), None)
        except Exception as problem:  # noqa: BLE001
            return Outcome(item, None, error_text(problem))

    source = iter(items)
    with ThreadPoolExecutor(max_workers=width, initializer=begin) as threads:
        running = set()
        while True:
            for item in source:
                running.add(threads.submit(run, item))
                if len(running) >= 2 * width:
                    break
            if not running:
                return
            done, running = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                yield future.result()
