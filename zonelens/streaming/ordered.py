"""Per-key streams in event-time order, with state that ends.

Rows wait in the state of their key until the watermark has passed them, are then taken in the order of
:func:`zonelens.operators.resolve.newest_order` (time, outcome, lifetime, sorted answers), and change the key's stored
value one after the other.  So the result does not depend on the order in which files arrive, as long as no row is later
than ``delay``; rows later than that are counted by Spark as dropped by the watermark.  An event-time timeout wakes the
state at the earliest waiting row, or at the end of a stored answer, which is then removed, as the state of names that
nobody asks for any more.

A call of a stateful Python function costs far more than a row, so keys lie in ``buckets`` hash buckets and a bucket has
one state: the values and waiting rows of its keys, as JSON text.  Memory holds what waits for one bucket, and a bucket
that gets rows writes its state anew: few buckets suit large triggers, many suit few rows among very many keys.

Rows newer than the watermark wait, so the last ``delay`` of a stream comes out when later rows arrive, or with a
closing mark (:func:`closing_mark`) at the end of a bounded one.

The functions are defined inside their operator and travel with the job; executors need no copy of this package.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from zonelens.operators.resolve import KEY, normal_names
from zonelens.schemas import OBSERVATIONS

# Names of closing marks; no observation has this record type.
MARK = "__mark"
# Hash buckets of keys, one state each.
BUCKETS = 1 << 16


def closing_mark(spark: SparkSession, at: datetime) -> DataFrame:
    """One observation row that lets the watermark pass everything before ``at`` less the delay; it gives no output."""
    return spark.createDataFrame([("", MARK, None, None, None, at)], OBSERVATIONS)


def _compact(obs: DataFrame, delay: str) -> DataFrame:
    """The columns that the fold needs, names as batch joins expect them, with a watermark."""
    timed = normal_names(obs).withColumn("observed_ts", F.col("observed_ts").cast("timestamp"))
    answers = F.sort_array(F.coalesce("answers", F.array().cast("array<string>")))
    return timed.withWatermark("observed_ts", delay).select(
        *KEY,
        "observed_ts",
        F.unix_micros("observed_ts").alias("ts_us"),
        "rcode",
        F.coalesce("ttl", F.lit(0)).cast("bigint").alias("ttl"),
        F.to_json(answers).alias("answers_json"),
    )


def in_order(
    obs: DataFrame, delay: str, output: str,
    step: Callable[[tuple | None, tuple], tuple[tuple, tuple | None]], ends: Callable[[tuple], int | None], buckets: int,
) -> DataFrame:
    """Fold every key's rows in event-time order.

    ``step`` takes the stored value (or None) and the next row (ts_us, rcode, ttl, answers_json) and gives the new value
    and an output row (or None).  ``ends`` tells from which microsecond on a value is as good as none, or None for never.
    """
    columns = [part.split()[0] for part in output.split(", ")]

    def order(row: list) -> tuple:
        answers = [(x is not None, x or "") for x in json.loads(row[3])]
        return row[0], row[1] is not None, row[1] or "", row[2], answers

    def fold(bucket: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs() * 1000
        # A key's stored value, or None, and its waiting rows.
        held = {(rtype, name): [value, rows] for rtype, name, value, rows in json.loads(state.get[0])} if state.exists else {}
        if not state.hasTimedOut:
            for part in chunks:
                for rtype, name, ts, rcode, ttl, answers in zip(*[part[c].tolist() for c in ("rtype", "name", "ts_us", "rcode", "ttl", "answers_json")]):
                    if rtype != MARK:
                        row = [int(ts), None if rcode is None or rcode != rcode else rcode, int(ttl), answers]
                        held.setdefault((rtype, name), [None, []])[1].append(row)
        out, left, wake = [], [], None
        for key, (value, rows) in held.items():
            ready = [row for row in rows if row[0] <= passed]
            rest = [row for row in rows if row[0] > passed] if ready else rows
            if len(ready) > 1:
                ready.sort(key=order)
            value = None if value is None else tuple(value)
            for row in ready:
                value, found = step(value, tuple(row))
                if found is not None:
                    out.append((*key, *found))
            end = None if value is None else ends(value)
            if end is not None and end <= passed:
                value = end = None
            if value is None and not rest:
                continue
            left.append((*key, value, rest))
            due = min((row[0] for row in rest), default=end) if end is None else min([end, *[row[0] for row in rest]])
            if due is not None:
                wake = due if wake is None else min(wake, due)
        if left:
            state.update((json.dumps(left),))
            if wake is not None:
                state.setTimeoutTimestamp(-(-wake // 1000))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(dict(zip(columns, map(list, zip(*out)))), columns=columns)

    rows = _compact(obs, delay).withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)))
    return rows.groupBy("bucket").applyInPandasWithState(
        fold, output, "held string", "append", GroupStateTimeout.EventTimeTimeout
    )


def ttl_answers(obs: DataFrame, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Answer every lookup from the stored answer while that is valid, else store the new one.

    Output per observation: the answer served, whether it came from the store, and its age.  A stored answer is removed
    once the watermark has passed its lifetime.
    """

    def serve(value: tuple | None, row: tuple) -> tuple[tuple, tuple]:
        ts, rcode, ttl, answers = row
        valid = value is not None and ts - value[0] < value[2] * 1_000_000
        kept = tuple(value) if valid else (ts, rcode, ttl, answers)
        return kept, (ts, kept[1], kept[3], valid, ts - kept[0])

    output = "rtype string, name string, ts_us bigint, rcode string, answers_json string, from_cache boolean, age_us bigint"
    return in_order(obs, delay, output, serve, lambda value: value[0] + value[2] * 1_000_000, buckets)


def changes(obs: DataFrame, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """Observations that differ from the one before for their key, the first one included.

    Equals :func:`zonelens.operators.change.change_history` over the same rows, ties included.  A key's last answer stays.
    """

    def compare(value: tuple | None, row: tuple) -> tuple[tuple, tuple | None]:
        ts, rcode, _, answers = row
        if value is None:
            return (rcode, answers), (ts, rcode, None, True)
        found = (ts, rcode, value[0], False) if (rcode, answers) != tuple(value) else None
        return (rcode, answers), found

    output = "rtype string, name string, ts_us bigint, rcode string, prev_rcode string, is_new boolean"
    return in_order(obs, delay, output, compare, lambda value: None, buckets)


def first_lookups(obs: DataFrame, horizon_seconds: int, delay: str = "1 hour", buckets: int = BUCKETS) -> DataFrame:
    """The lookups that go out when a key is asked at most once within a horizon (I1): rtype, name, ts_us.

    A row goes out unless one of its key went out less than ``horizon_seconds`` before; what went out longer ago is
    forgotten.
    """

    def once(value: tuple | None, row: tuple) -> tuple[tuple, tuple | None]:
        held = value is not None and row[0] - value[0] < horizon_seconds * 1_000_000
        return (tuple(value), None) if held else ((row[0],), (row[0],))

    output = "rtype string, name string, ts_us bigint"
    return in_order(obs, delay, output, once, lambda value: value[0] + horizon_seconds * 1_000_000, buckets)
