"""Refine as a stream.

``refine_stream`` takes landed prompts; each micro-batch goes through the hook (U3) and is written by epoch.

``refine_rows_stream`` takes landed posts and does the whole refine flow.  Posts are dealt by a hash of their id into ``lanes``; a
lane is a key with state: the number of its next batch and the posts that do not fill a batch yet.  Posts are numbered
across micro-batches, and a batch is emitted when it is full, so it lies in one epoch whole.  A short last batch is closed
by an end mark (a row without id whose ``end`` is true) or, in a stream that goes on (``trigger``), when the lane has had no post for
``wait_ms`` (a processing-time timer; a drained stream has none, as Spark would wait for its timers without end).  Each epoch builds prompts, calls the hook for batches whose reply is not stored yet, stores the
replies, then parses, aligns and writes refined rows and rejects.

Output folders are partitioned by epoch and an epoch overwrites only its own folder.  After a failure Spark replays the epoch
from the checkpoint with the same state: the lanes number the same rows as before, and stored replies are not asked for again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from boardsmith.operators import batches as B
from boardsmith.operators import replies as R
from boardsmith.operators.enrich import RESPONSES_SCHEMA, enrich_batches
from boardsmith.session import materialize
from boardsmith.sources.sinks import append_batches, append_epoch


def refine_stream(prompts_stream: DataFrame, fn: Callable[[int, str], str], out_path: str, checkpoint: str) -> None:
    def each(batch: DataFrame, epoch_id: int) -> None:
        append_batches(enrich_batches(batch, fn), out_path)

    q = prompts_stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


POST = ("post_id", "title", "contents", "comments", "views", "date_text")
LANDED = "post_id bigint, title string, contents string, comments string, views bigint, date_text string, end boolean"
_NUMBERED = "batch_id bigint, row_idx bigint, post_id bigint, title string, contents string, comments string, views bigint, date_text string"


FRAME_ROWS = 1000  # numbered posts handed on at once


def _lane(size: int, lanes: int, wait_ms: int | None):
    """Numbers the posts of one lane; state: (its next batch, posts that wait as JSON rows)."""

    def run(key, frames, state: GroupState):
        lane = int(key[0])
        number, waiting = (state.get[0], json.loads(state.get[1])) if state.exists else (0, [])
        ended = state.hasTimedOut

        def emitted(rows):
            nonlocal number
            batch = number * lanes + lane
            number += 1
            return [(batch, batch * size + k, *r) for k, r in enumerate(rows)]

        def frame(out):
            return pd.DataFrame(out, columns=["batch_id", "row_idx", *POST]).astype({"batch_id": "int64", "row_idx": "int64", "post_id": "Int64", "views": "Int64"})

        arrived = []
        for pdf in frames:
            ended = ended or bool(pdf["end"].fillna(False).any())
            arrived += [[None if pd.isna(v) else (int(v) if c in ("post_id", "views") else v) for c, v in zip(POST, r, strict=True)]
                        for r in pdf.loc[~pdf["end"].fillna(False).astype(bool), list(POST)].itertuples(index=False)]
        # One order for any order of arrival inside the micro-batch, so a replay numbers alike.
        arrived.sort(key=lambda r: [(v is not None, v if v is not None else 0) for v in r])
        waiting += arrived
        del arrived
        full, out = len(waiting) // size * size, []
        for at in range(0, full, size):
            out += emitted(waiting[at:at + size])
            waiting[at:at + size] = [None] * size  # handed on: a lane's texts are held once
            if len(out) >= FRAME_ROWS:
                yield frame(out)
                out = []
        waiting = waiting[full:]
        if ended and waiting:
            out += emitted(waiting)
            waiting = []
        state.update((number, json.dumps(waiting, ensure_ascii=False)))
        if waiting and wait_ms is not None:
            state.setTimeoutDuration(wait_ms)
        yield frame(out)

    return run


def numbered_stream(posts: DataFrame, size: int, lanes: int, wait_ms: int | None = None) -> DataFrame:
    """Landed posts (``LANDED``; ids not null) -> numbered rows, each batch whole."""
    ended = F.coalesce("end", F.lit(False))
    own = F.array(F.pmod(F.xxhash64("post_id"), F.lit(lanes)).cast("int"))
    dealt = posts.withColumn("lane", F.explode(F.when(ended, F.sequence(F.lit(0), F.lit(lanes - 1))).otherwise(own)))
    return dealt.groupBy("lane").applyInPandasWithState(
        _lane(size, lanes, wait_ms), _NUMBERED, "number bigint, waiting string", "append",
        GroupStateTimeout.NoTimeout if wait_ms is None else GroupStateTimeout.ProcessingTimeTimeout)


def stored(spark, path: str, schema: str) -> DataFrame:
    """A table written by epoch, empty where nothing has been written yet."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    there = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def refine_rows_stream(posts: DataFrame, fn: Callable[[int, str], str], out_path: str, checkpoint: str, size: int = 10, lanes: int = 8, wait_ms: int = 60_000,
                       mode: str = "text", strict_position: bool = False, trigger: dict | None = None):
    """Runs the stream over landed posts; returns the query (drained and stopped with the default trigger).

    Written under ``out_path``: ``responses``, ``refined`` and ``rejects``, each by epoch.
    """
    named = posts.where("post_id IS NOT NULL OR coalesce(end, false)")

    def each(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        numbered = materialize(batch, "stream-numbered")
        if numbered.isEmpty():
            return
        prompts = B.build_prompts(numbered)
        earlier = stored(spark, f"{out_path}/responses", RESPONSES_SCHEMA + ", epoch bigint").where(F.col("epoch") == epoch).drop("epoch")
        earlier = materialize(earlier.where("response IS NOT NULL"), "stored-replies")
        asked = enrich_batches(prompts.join(earlier, "batch_id", "left_anti"), fn)
        append_epoch(asked.unionByName(earlier), f"{out_path}/responses", epoch)
        responses = stored(spark, f"{out_path}/responses", RESPONSES_SCHEMA + ", epoch bigint").where(F.col("epoch") == epoch).drop("epoch")
        parsed = materialize(R.parse_text_replies(responses, size, strict_position) if mode == "text" else R.parse_json_replies(responses, size), "stream-parsed")
        aligned = R.align(parsed, numbered.select("row_idx", "post_id", "views", "date_text")).withColumn("reject_reason", R.validation_reason())
        kept = aligned.where(F.col("reject_reason").isNull() | (F.col("reject_reason") != "missing_key"))
        append_epoch(R.to_refined_rows(kept, keep=["batch_id"]), f"{out_path}/refined", epoch)
        append_epoch(R.reject_table(parsed, numbered, responses), f"{out_path}/rejects", epoch)

    stream = numbered_stream(named, size, lanes, None if trigger is None else wait_ms)
    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    if trigger is None:
        q.awaitTermination()
    return q
