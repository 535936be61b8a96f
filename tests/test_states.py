from __future__ import annotations

import time

from stratawork.streaming import states

SCHEMA = "scan string, state string, rows bigint, seq bigint"


def _put(spark, folder, k, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/b{k}")


def _start(spark, folder, out, checkpoint, idle):
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(folder)
    q = states.scan_states(stream, idle)
    return q.writeStream.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/n={n}")).outputMode("update").option("checkpointLocation", checkpoint)


def _rows(spark, out):
    return sorted((tuple(r) for r in spark.read.parquet(out).select("scan", "state", "rows", "accepted", "reason").collect()), key=str)


def test_transitions_and_idle_end_over_a_restart(spark, tmp_path):
    """What may follow follows, what may not changes nothing, and a restart from the checkpoint goes on with the same states and timers."""
    folder, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        _put(spark, folder, 0, [("a", "queued", 0, 1), ("a", "running", 10, 2), ("b", "running", 5, 1), ("c", "queued", 0, 1), ("c", "running", 1, 2), ("c", "done", 0, 3)])
        q = _start(spark, folder, out, ck, 3600).trigger(availableNow=True).start()
        q.awaitTermination(200)
        assert _rows(spark, out) == sorted([
            ("a", "queued", 0, True, None), ("a", "running", 10, True, None), ("b", None, 0, False, "running may not follow None"),
            ("c", "done", 1, True, None), ("c", "queued", 0, True, None), ("c", "running", 1, True, None),
        ], key=str)
        _put(spark, folder, 1, [("a", "running", 7, 3), ("c", "running", 1, 4), ("b", "queued", 0, 2), ("b", "stopped", 0, 3), ("b", "queued", 0, 4), ("b", "running", 2, 5)])
        q = _start(spark, folder, out, ck, 2).start()  # a shorter idle time from now on
        end = time.monotonic() + 120
        while time.monotonic() < end and sum(r[4] == "idle" for r in _rows(spark, out)) < 2:
            time.sleep(1)
        q.stop()
        late = [r for r in _rows(spark, out) if r[4] == "idle"]
        assert late == [("a", "done", 17, True, "idle"), ("b", "done", 2, True, "idle")]
        assert ("c", "done", 1, False, "running may not follow done") in _rows(spark, out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset(states.PROVIDER[0])
