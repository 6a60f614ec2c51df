"""Dedup across runs as keyed state: one date and one timer a posting's id.

Each micro-batch is a run.  Postings and the ids that a sink has treated come as
one stream of events; a run's treated ids are marked before its postings are
split.  Only treated ids are remembered, so what a sink put off is new again in
the next run; an id is forgotten once its retention is over.  State is one date
an id, in the state store of its task, and no run reads what it does not touch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from siftworks.operators.dedup import NEW, REPEAT, SEEN
from siftworks.session import ship_package

DAY = 86_400_000
TREATED = "treated_mark"


def split(key, frames, state, *, columns: list[str], order: list[str], retention: int | None) -> Iterator:
    """Status of each posting of an id: the first one in order is ``seen`` where
    the id is remembered, else ``new``; later ones are ``repeat``.

    One pass, whatever the number of an id's rows: only the first one in order
    so far is held back.
    """
    import pandas as pd

    if state.hasTimedOut:  # the timer of its retention
        state.remove()
        return
    now = state.getCurrentProcessingTimeMs()
    # a timer fires after a batch's rows, so a late one is not waited for
    since = state.get[0] if state.exists else None
    known = since is not None and (retention is None or since + retention > now)
    marked, held = False, None
    for frame in frames:
        treated = frame[TREATED].astype(bool)
        marked |= bool(treated.any())
        frame = frame[~treated]
        if not len(frame):
            continue
        if held is not None:
            frame = pd.concat([held, frame])
        frame = frame.sort_values(order, kind="stable", na_position="first")
        held, rest = frame.iloc[:1], frame.iloc[1:]
        if len(rest):
            yield rest[columns].assign(status=REPEAT)
    if marked and not known:
        since = now
        state.update((now,))
    elif not known and state.exists:
        state.remove()
    if retention is not None and (known or marked):
        state.setTimeoutDuration(max(1, since + retention - now))
    if held is not None:
        yield held[columns].assign(status=SEEN if known or marked else NEW)


def split_stream(postings: DataFrame, treated: DataFrame, *order: str, key: str = "stable_id", retention_days: float | None = None) -> DataFrame:
    """The postings of a stream with ``status``, as :func:`dedup.split_status`
    gives it for each run.

    ``treated`` is a stream with the ids whose postings a sink has dealt with;
    ids from outside (a first load of a seen store) may come there too.  Nulls
    in ``order`` come first, ties go by arrival.  A null id is a key like any.

    With a retention, batches without data are turned off in the session: Spark
    would go on with them for the timers' sake, and no run would end.  A timer
    that is due fires in the next run.
    """
    ship_package(postings.sparkSession)
    if retention_days is not None:
        postings.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    columns = [c for c in postings.columns if c != "status"]
    marks = treated.select(F.col(key).cast("string").alias(key)).withColumn(TREATED, F.lit(True))
    events = postings.select(columns).withColumn(key, F.col(key).cast("string")).withColumn(TREATED, F.lit(False)).unionByName(marks, allowMissingColumns=True)
    kind = StructType([StructField(f.name, StringType() if f.name == key else f.dataType) for f in postings.schema if f.name != "status"] + [StructField("status", StringType())])
    retention = None if retention_days is None else int(retention_days * DAY)
    return events.groupBy(key).applyInPandasWithState(partial(split, columns=columns, order=list(order), retention=retention), kind, "first_seen long", "append", "NoTimeout" if retention is None else "ProcessingTimeTimeout")
