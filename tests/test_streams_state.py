"""S2 with state against the batch flow, over several files, with restarts; C5 as a stream."""

import datetime as dt
import os
import time

import pytest

from boardsmith import workflows as W
from boardsmith.plans.streams import titled_reply
from boardsmith.streaming.ingest import read_landed, run_to_table
from boardsmith.streaming.missing import missing_ids_stream
from boardsmith.streaming.refine import LANDED, POST, refine_rows_stream

END = (None, None, None, None, None, None, True)


def post(i):
    return (i, f"src{i % 5}-{i}", f"text {i}", None if i % 3 else "c", None if i % 4 else i, "2025-01-01", False)


def land(spark, folder, rows):
    spark.createDataFrame(rows, LANDED).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)  # distinct modification times keep the file order


def told(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


REFINED = ("id", "content", "comments", "keywords", "tendency", "views", "date")


def test_equals_the_batch_flow_and_goes_on_after_a_restart(spark, tmp):
    landing, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    rows = [post(i) for i in range(57)] + [(None, "src1-0", "no id", None, None, None, False)]

    run = lambda: refine_rows_stream(read_landed(spark, landing, LANDED, max_files=1), titled_reply, out, ck, size=5, lanes=2)
    land(spark, landing, rows[:12])
    run()
    first = spark.read.parquet(f"{out}/refined").count()
    assert 0 < first < 12 and first % 5 == 0  # only whole batches yet
    land(spark, landing, rows[12:30])
    land(spark, landing, rows[30:])
    run()  # the posts that waited are numbered with the new ones
    land(spark, landing, [END])
    run()
    batch = W.refine_posts(spark.createDataFrame(rows, LANDED).select(*POST), titled_reply, size=5)
    assert told(spark.read.parquet(f"{out}/refined"), *REFINED) == told(batch.refined, *REFINED)
    assert told(spark.read.parquet(f"{out}/rejects"), "id", "reject_reason") == told(batch.rejects.where("reject_reason <> 'null_id'"), "id", "reject_reason")
    sizes = [r["count"] for r in spark.read.parquet(f"{out}/refined").groupBy("batch_id").count().collect()]
    assert sorted(sizes)[2:] == [5] * (len(sizes) - 2) and sum(sizes) == 57  # at most the last batch of each lane is short


def test_a_failed_epoch_is_replayed_without_asking_again(spark, tmp, monkeypatch):
    from boardsmith.streaming import refine as S

    landing, out, ck, log = (os.path.join(tmp, x) for x in ("in", "out", "ck", "log"))
    os.makedirs(log)

    def hook(batch_id, prompt):
        with open(os.path.join(log, str(batch_id)), "a") as f:
            f.write("x")
        return titled_reply(batch_id, prompt)

    land(spark, landing, [post(i) for i in range(40)] + [END])
    run = lambda: refine_rows_stream(read_landed(spark, landing, LANDED), hook, out, ck, size=5, lanes=2)
    real, left = S.append_epoch, [1]

    def breaks(df, path, epoch, fmt="parquet"):
        if path.endswith("refined") and left:
            left.clear()
            raise RuntimeError("killed after the replies were stored")
        real(df, path, epoch, fmt)

    monkeypatch.setattr(S, "append_epoch", breaks)
    with pytest.raises(Exception, match="killed"):
        run()
    run()
    assert {i for (i,) in told(spark.read.parquet(f"{out}/refined"), "id")} == set(range(40))
    assert all(open(os.path.join(log, f)).read() == "x" for f in os.listdir(log))  # each batch asked for once


def test_a_short_batch_is_closed_by_its_timer(spark, tmp):
    landing, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    land(spark, landing, [post(i) for i in range(3)])
    q = refine_rows_stream(read_landed(spark, landing, LANDED), titled_reply, out, ck, size=5, lanes=1, wait_ms=500, trigger={"processingTime": "500 milliseconds"})
    try:
        for _ in range(120):
            if os.path.exists(f"{out}/refined/epoch=1") or os.path.exists(f"{out}/refined/epoch=2"):
                break
            time.sleep(0.5)
    finally:
        q.stop()
    assert told(spark.read.parquet(f"{out}/refined"), "id") == [(0,), (1,), (2,)]


def test_missing_ids_by_event_time(spark, tmp):
    t = dt.datetime(2025, 1, 1)
    at = lambda minutes: t + dt.timedelta(minutes=minutes)
    schema = "id bigint, at timestamp"

    def put(name, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(os.path.join(tmp, name))
        time.sleep(1.1)

    def run():
        read = lambda n: read_landed(spark, os.path.join(tmp, n), schema, max_files=1)
        run_to_table(missing_ids_stream(read("asked"), read("posts"), "10 MINUTES", "5 minutes", asked_at="at", post_col="id", arrived_at="at"), os.path.join(tmp, "out"), os.path.join(tmp, "ck"))

    put("asked", [(1, at(0)), (2, at(0)), (3, at(0)), (4, at(1)), (5, at(2)), (5, at(30)), (None, at(0))])
    put("posts", [(1, at(5)), (1, at(6)), (2, at(11)), (3, at(10)), (9, at(1)), (5, at(3))])  # 1 twice, 2 too late, 3 on the edge
    run()
    put("asked", [(6, at(1000)), (7, at(1))])  # 7 was asked for long before the watermark: dropped as late once it has moved
    put("posts", [(8, at(1000)), (4, at(2))])
    run()
    put("asked", [(99, at(9000))])
    put("posts", [(99, at(9000))])
    run()
    got = told(spark.read.parquet(os.path.join(tmp, "out")), "id", "asked_at")
    assert (2, at(0)) in got and (5, at(30)) in got and (6, at(1000)) in got
    assert not {1, 3} & {i for i, _ in got} and (5, at(2)) not in got
