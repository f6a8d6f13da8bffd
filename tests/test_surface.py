"""Significance, mergeable aggregates, compaction, scorers, clocks and progress."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.functions import scorers, stats
from quarryline.operators import context, mergeable, significance
from quarryline.streaming import clocks, listener, telemetry


def single_machine_p(rows, blocks, draws, seed, spark):
    """The same counters, block after block in one loop."""
    hashed = spark.createDataFrame([(k,) for k, _, _ in rows], "k long").select("k", F.pmod(F.xxhash64("k"), F.lit(blocks)).alias("b"))
    of = {r.k: r.b for r in hashed.collect()}
    values = [np.array([v for k, v, _ in sorted(rows) if of[k] == b]) for b in range(blocks)]
    sizes, treated = np.array([len(v) for v in values]), sum(t for *_, t in rows)
    sums, dealt = np.zeros(draws), np.zeros(draws, int)
    for b in range(blocks):
        labels = significance.labels_of_block(sizes, b, treated, draws, seed)
        assert (labels <= sizes[b]).all() and (labels >= 0).all()
        dealt += labels
        sums += significance.treated_sums(values[b], labels, b, seed)
    assert (dealt == treated).all()
    total, own = sum(v for _, v, _ in rows), sum(v for _, v, t in rows if t)
    mean = lambda a: a / treated - (total - a) / (len(rows) - treated)
    return np.mean(mean(sums) >= mean(own) - 1e-9)


def test_permutations_of_real_values_equal_a_single_machine(spark):
    rng = random.Random(3)
    rows = [(k, rng.gauss(0.12 * (k % 3 == 0), 1.0), k % 3 == 0) for k in range(900)]
    table = spark.createDataFrame(rows, "k long, v double, t boolean")
    results = []
    for parts in (1, 5):
        r = significance.permutation_test(table.repartition(parts), "k", "v", F.col("t"), draws=3000, block=100).first()
        results.append(tuple(r))
        assert abs(r.p - single_machine_p(rows, 9, 3000, 42, spark)) < 1e-12
    assert results[0][3] == results[1][3] and abs(results[0][2] - results[1][2]) < 1e-12 and 0 < results[0][3] < 0.6


def test_permutations_agree_with_the_exact_tail(spark):
    rows = [(k, float((k * 7) % 10 < (6 if k < 150 else 5)), k < 150) for k in range(400)]
    table = spark.createDataFrame(rows, "k long, v double, t boolean")
    p = significance.permutation_test(table, "k", "v", F.col("t"), block=64).first().p
    a, b = sum(int(v) for _, v, t in rows if t), sum(int(v) for _, v, t in rows if not t)
    exact = spark.range(1).select(stats.permutation_p(*(F.lit(x) for x in (a, 150, b, 250)))).first()[0]
    assert abs(p - exact) < 4 * (exact * (1 - exact) / 10_000) ** 0.5


def test_permutations_of_odd_samples(spark):
    schema = "k long, v double, t boolean"
    test = lambda rows: tuple(significance.permutation_test(spark.createDataFrame(rows, schema), "k", "v", F.col("t"), draws=200).first())
    assert test([]) == (0, 0, None, None, False)
    assert test([(1, 1.0, True), (2, None, False), (3, 1.0, None)]) == (1, 0, None, None, False)
    assert test([(1, 1.0, True), (2, 2.0, False)]) == (1, 1, -1.0, None, False)
    assert test([(1, 2.0, True), (2, 2.0, False)])[2:] == (0.0, None, False)


def test_moments_merge_whatever_the_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), k % 2, None if k % 11 == 0 else rng.lognormvariate(0, 1)) for k in range(4000)] + [("lone", 0, 2.0), ("none", 1, None)]
    table = spark.createDataFrame(rows, "g string, h long, x double")
    exact = {}
    for g, h, x in rows:
        exact.setdefault((g, h), []).extend([] if x is None else [x])
    for parts in (1, 7):
        out = mergeable.aggregated(table.repartition(parts), ["g", "h"], ["x"], mergeable.Moments()).collect()
        assert {(r.g, r.h) for r in out} == set(exact) and len(out) == len(exact)
        for r in out:
            x = np.array(exact[r.g, r.h])
            assert r.n == len(x) and (r.mean is None if not len(x) else abs(r.mean - x.mean()) < 1e-9)
            assert r.variance is None if len(x) < 2 else abs(r.variance / x.var(ddof=1) - 1) < 1e-9
            if len(x) > 2:
                assert abs(r.skewness - ((x - x.mean()) ** 3).mean() / x.std() ** 3) < 1e-9
    whole = mergeable.aggregated(table, [], ["x"], mergeable.Moments()).collect()
    assert len(whole) == 1 and whole[0].n == sum(map(len, exact.values()))
    assert mergeable.aggregated(table.limit(0), ["g"], ["x"], mergeable.Moments()).collect() == []


def brute_compactions(tokens, interval, overlap, threshold, retain):
    out, done = [], 0
    for k in range(1, len(tokens) + 1):
        fresh, live = k - done, sum(tokens[done:k])
        cause = "threshold" if live > threshold and fresh > retain else "interval" if fresh >= interval else None
        if cause:
            end = k - retain if cause == "threshold" else k
            out.append((len(out) + 1, k, max(1, done + 1 - overlap) if out else 1, end, cause, sum(tokens[end:k])))
            done = end
    return out


@pytest.mark.parametrize("settings", [(5, 2, 14336, 5), (4, 1, 50, 2), (7, 3, 20, 1), (3, 0, 10, 0)])
def test_compactions_against_brute_force(spark, settings):
    rng = random.Random(settings[2])
    convs = {c: [rng.randrange(1, 30) for _ in range(rng.randrange(0, 25))] for c in range(30)} | {99: [7] * 3000}
    rows = [(c, k, t) for c, tokens in convs.items() for k, t in enumerate(tokens, 1)] + [(None, 1, 5)]
    random.Random(2).shuffle(rows)
    got = context.compactions(spark.createDataFrame(rows, "conv_id long, turn long, tokens long"), *settings).collect()
    assert sorted(map(tuple, got)) == sorted((c, *x) for c, tokens in convs.items() for x in brute_compactions(tokens, *settings))


def test_scorers_join_laterally(spark):
    scorers.register_scorers(spark, "reward", {"syntax": scorers.call_syntax, "brevity": scorers.brevity(10), "broken": lambda text: 1 / 0})
    texts = ['<tool_call>{"a": 1}</tool_call> <tool_call>[1]</tool_call>', None, "x" * 20]
    spark.createDataFrame(list(enumerate(texts)), "k long, t string").createOrReplaceTempView("scored")
    got = spark.sql("SELECT k, s.* FROM scored, LATERAL reward(t) s").collect()
    assert {(r.k, r.scorer): (r.score, r.error) for r in got} == {
        (0, "syntax"): (0.5, None), (0, "brevity"): (10 / 58, None), (0, "broken"): (None, "ZeroDivisionError"), (1, "syntax"): (None, None), (1, "brevity"): (1.0, None),
        (1, "broken"): (None, "ZeroDivisionError"), (2, "syntax"): (None, None), (2, "brevity"): (0.5, None), (2, "broken"): (None, "ZeroDivisionError"),
    }


def waited(ready, seconds=60):
    end = time.time() + seconds
    while time.time() < end:
        if ready():
            return True
        time.sleep(0.3)
    return False


def test_timers_end_users_without_events_and_outlast_restarts(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1,), (1,), (2,)], "user_id long").write.parquet(source)
    events = spark.readStream.schema("user_id long").parquet(source)
    keep = spark.conf.get("spark.sql.streaming.stateStore.providerClass")

    def start(limit_ms):
        stream = clocks.time_limits(events, limit_ms).writeStream.outputMode("update").option("checkpointLocation", state).trigger(processingTime="300 milliseconds")
        return stream.foreachBatch(lambda batch, _: batch.write.mode("append").parquet(out)).start()

    def rows():
        try:
            return sorted((r.user_id, r.status, r.n) for r in spark.read.schema(clocks.OUT).parquet(out).collect())
        except Exception:  # noqa: BLE001  the folder is not there yet
            return []

    try:
        query = start(3000)
        assert waited(lambda: len(rows()) >= 4), rows()  # the timers need no new events
        assert rows() == [(1, "running", 2), (1, "timed out", 2), (2, "running", 1), (2, "timed out", 1)]
        spark.createDataFrame([(2,), (3,)], "user_id long").write.mode("append").parquet(source)
        assert waited(lambda: len(rows()) >= 6)
        query.stop()
        assert {(2, "late", 1), (3, "running", 1)} <= set(rows())
        time.sleep(3)
        query = start(3000)  # from its checkpoint: user 3 has its timer, user 2 its end
        spark.createDataFrame([(2,), (4,)], "user_id long").write.mode("append").parquet(source)
        assert waited(lambda: {(3, "timed out", 1), (4, "running", 1)} <= set(rows())), rows()
        assert rows().count((2, "late", 1)) == 2
        query.stop()
    finally:
        for q in spark.streams.active:
            q.stop()
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", keep)


def test_progress_rows_match_batches(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    for k in range(3):
        spark.range(10 * (k + 1)).selectExpr("id as event_id", "timestamp_seconds(id) as ts", "id % 3 as user_id", "'a' as event_type", "1.0D as value", "'' as props").coalesce(1).write.mode("append").parquet(source)
    table = listener.ProgressTable(spark, on_batch=lambda row: seen.append(row["batch_id"]) or (1 / 0 if row["batch_id"] == 1 else None))
    spark.streams.addListener(table)
    try:
        stream = spark.readStream.schema(telemetry.EVENT).option("maxFilesPerTrigger", 1).parquet(source)
        counts = []
        query = stream.groupBy("user_id").count().writeStream.outputMode("update").trigger(availableNow=True).foreachBatch(lambda b, k: counts.append((k, b.count()))).start()
        query.awaitTermination()
        assert waited(lambda: table.rows().where("event = 'end'").count() == 1)
        rows = listener.batches(table.rows()).where(F.col("query_id") == str(query.id)).orderBy("batch_id").collect()
        assert [(r.batch_id, r.input_rows) for r in rows] and sorted(r.input_rows for r in rows) == [10, 20, 30] and [r.batch_id for r in rows] == [0, 1, 2]
        assert sorted(seen) == [0, 1, 2] and table.rows().where("error like 'ZeroDivisionError%'").count() == 1
        assert table.rows().where("event = 'start'").count() == 1
    finally:
        spark.streams.removeListener(table)


def test_late_streams_take_every_id(spark, tmp_path):
    import duckdb

    from quarryline.plans import surface

    rows = [(k, f"2024-01-{d:02d} 05:{k % 60:02d}:00", 1, "view", 1.0, "") for d in (1, 20, 29, 30) for k in (-3, -2, 2, 3)]
    rows += [(None, "2024-01-20 05:30:00", 1, "view", 2.0, "")]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = surface.stream_late(spark, str(tmp_path)).select("start", "event_type", "n", "total").collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(surface.ORACLE["stream_late"]).fetchall()
    plain = lambda rows: sorted((str(r[0])[:19], *r[1:]) for r in rows)
    assert want and plain(got) == plain(want)


def test_late_streams_whatever_the_files(spark, tmp_path):
    """A part's rows are one batch, though a session that limits the rows of a file writes them as several; without even ids nothing old counts."""
    import duckdb

    from quarryline.plans import surface

    limit = "spark.sql.files.maxRecordsPerFile"
    plain = lambda rows: sorted((str(r[0])[:19], *r[1:]) for r in rows)
    for name, ids in (("even", (1, 2, 3, 4)), ("odd", (1, 3))):
        rows = [(k, f"2024-01-{d:02d} 05:{k:02d}:00", 1, "view", 1.0, "") for d in (30, 29, 20, 28, 1) for k in ids]
        events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
        events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/{name}/events.parquet")
        keep = spark.conf.get(limit)
        spark.conf.set(limit, "1")
        try:
            got = surface.stream_late(spark, f"{tmp_path}/{name}").select("start", "event_type", "n", "total").collect()
        finally:
            spark.conf.set(limit, keep)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/{name}/events.parquet/*.parquet'")
        want = con.execute(surface.ORACLE["stream_late"]).fetchall()
        assert want and plain(got) == plain(want), name
