import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from sorrel.operators import store as st
from sorrel.session import new_folder
from sorrel.sources.tables import bucket_number, online_commits, online_shape, read_online
from sorrel.streaming import sinks, steps as ss, windows as sw

LOG = T.StructType().add("id", T.LongType()).add("ts", T.TimestampType()).add("target", T.StringType()).add("status", T.IntegerType()).add("latency_ms", T.DoubleType())
START = datetime(2024, 1, 1)


def log(spark, path, parts):
    """Write each part as one file, in order, and return (stream, batch)."""
    for i, part in enumerate(parts):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(f"{path}/p{i}")
    return sinks.read_stream(spark, f"{path}/p*", LOG, max_files=1), spark.read.schema(LOG).parquet(*[f"{path}/p{i}" for i in range(len(parts))])


def at(minutes, i=0, **kw):
    row = {"target": "a", "status": 200, "latency_ms": 10.0} | kw
    return (i, START + timedelta(minutes=minutes), row["target"], row["status"], row["latency_ms"])


def kept(spark, stream, spec, folder=None, **kw):
    """Run the stream to the end and return its stored steps."""
    path = folder or new_folder(spark, "steps")
    ss.keep(stream, spec, path, f"{path}/checkpoint", **kw).awaitTermination()
    return ss.kept(spark, path, spec, ss.summarise(stream, spec).schema)


def test_windows_equal_their_batch_twin(spark, tmp_path, rows):
    data = [at(m * 0.7, m, latency_ms=float(m % 13)) for m in range(600)]
    stream, batch = log(spark, str(tmp_path), [data[:300], data[300:]])
    scores = lambda df: df.withColumn("score", F.col("latency_ms") / 12)
    bins = sw.reference_bins(scores(batch))
    for prepare, spec, build in (
        (lambda df: sw.with_bin(scores(df), "score"), sw.score_steps("10 minutes"), lambda st: sw.score_windows(st, "30 minutes")),
        (lambda df: sw.with_bin(df, "latency_ms"), sw.request_steps(endpoint="target"), lambda st: sw.request_windows(st, "target")),
        (lambda df: sw.with_reference_bin(scores(df), bins), sw.psi_steps("30 minutes"), lambda st: sw.psi_windows(st, bins, "1 hour")),
        (lambda df: df, sw.target_steps("30 seconds"), lambda st: sw.silences(st, gap_seconds=30)),
    ):
        want = rows(build(ss.summarise(prepare(batch), spec)))
        assert want and rows(build(kept(spark, prepare(stream), spec))) == want
    # the window that holds the newest event is there, and is not final
    last = sw.request_windows(ss.summarise(sw.with_bin(batch, "latency_ms"), sw.request_steps(endpoint="target")), "target").orderBy("window_start").collect()
    assert last[-1].window_end > data[-1][1] and not last[-1].final and last[0].final


def test_late_rows_correct_their_window_and_replays_count_once(spark, tmp_path):
    first = [at(m, m) for m in range(300)]
    replay = first[-20:] + [at(400, 400)] * 2
    late = [at(5, 999), at(700, 700), first[3]]
    stream, _ = log(spark, str(tmp_path), [first, replay, late])
    steps = kept(spark, sw.with_bin(stream, "latency_ms"), sw.request_steps(endpoint="target"), key=["id"])
    counts = {r.window_start: r.n for r in sw.request_windows(steps, "target", "10 minutes").collect()}
    assert counts[START] == 11
    assert counts[START + timedelta(minutes=290)] == 10
    assert counts[START + timedelta(minutes=400)] == counts[START + timedelta(minutes=700)] == 1


def test_batches_run_again_change_nothing_and_folds_keep_all(spark, tmp_path, rows):
    stream, batch = log(spark, str(tmp_path), [[at(m, m, latency_ms=float(m)) for m in range(k, 100, 7)] for k in range(7)])
    spec, path = sw.request_steps("10 minutes", endpoint="target"), new_folder(spark, "steps")
    stream, batch = (sw.with_bin(df, "latency_ms") for df in (stream, batch))
    want = rows(sw.request_windows(ss.summarise(batch, spec), "target", "10 minutes"))
    got = lambda **kw: rows(sw.request_windows(kept(spark, stream, spec, path, key=["id"], **kw), "target", "10 minutes"))
    assert got(fold_every=3) == want
    assert len(os.listdir(f"{path.removeprefix('file:')}/parts/{os.listdir(path.removeprefix('file:') + '/parts')[0]}")) == 1
    # the commit of the last batch is lost, so it runs again
    for lost in ("6", ".6.crc"):
        os.unlink(f"{path.removeprefix('file:')}/checkpoint/commits/{lost}")
    assert got(fold_every=3) == want
    # another stream over the same files brings nothing new, then everything is folded twice
    ss.keep(stream, spec, path, new_folder(spark, "ck"), key=["id"], fold_every=2).awaitTermination()
    schema = ss.summarise(batch, spec).schema
    ss.fold(spark, path, spec, schema)
    ss.fold(spark, path, spec, schema)
    assert rows(sw.request_windows(ss.kept(spark, path, spec, schema), "target", "10 minutes")) == want


def test_percentiles_have_one_error_at_every_size(spark):
    for n in (1, 3, 40_000):
        values = [0.001 * (i * 7919 % n + 1) ** 1.7 for i in range(n)]
        df = spark.createDataFrame([(START, "a", 200, v) for v in values], "ts timestamp, endpoint string, status int, latency_ms double")
        got = sw.request_windows(ss.summarise(sw.with_bin(df, "latency_ms"), sw.request_steps()), size="1 hour").first()
        exact = sorted(values)[-(-99 * n // 100) - 1]
        assert got.n == n and abs(got.p99 - exact) <= exact / 128


def test_bins_of_odd_values(spark):
    values = [0.0, -0.0, 1.0, 2.0, 4.0, 0.5, 1e-300, 5e-324, 1e300, 2**53 + 0.0, 2**53 - 1.0, 1.0 - 2**-53, -3.7, 3.7, float("nan"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").withColumn("b", ss.value_bin(F.col("v")))
    got = [(r.v, r.b, r.m) for r in df.withColumn("m", ss.bin_value(F.col("b"))).orderBy("i").collect()]
    known = sorted(((v, b, m) for v, b, m in got if b is not None), key=lambda t: t[0])
    assert len(known) == len(values) - 2
    assert [b for _, b, _ in known] == sorted(b for _, b, _ in known)
    assert all(abs(m - v) <= abs(v) / 128 for v, _, m in known if abs(v) > 1e-307)
    assert all(b == 0 and m == 0 for v, b, m in known if v == 0)


def test_windows_without_values_or_rows(spark):
    empty = spark.createDataFrame([], LOG)
    spec = sw.request_steps(endpoint="target")
    assert sw.request_windows(ss.summarise(sw.with_bin(empty, "latency_ms"), spec), "target").count() == 0
    assert sw.silences(ss.summarise(empty, sw.target_steps())).count() == 0
    some = spark.createDataFrame([at(1, latency_ms=None), (2, None, "a", 200, 3.0), at(1, target=None, status=None)], LOG)
    got = sw.request_windows(ss.summarise(sw.with_bin(some, "latency_ms"), spec), "target").orderBy("target").collect()
    assert [(r.target, r.n, r.mean, r.p99) for r in got] == [(None, 1, 10.0, got[0].p99), ("a", 1, None, None)]
    path = new_folder(spark, "none")
    assert ss.kept(spark, path, spec, ss.summarise(sw.with_bin(empty, "latency_ms"), spec).schema).count() == 0


@pytest.mark.parametrize("minutes,fires", [(4, False), (5, True), (6, True)])
def test_latency_alert_needs_the_whole_hold(spark, minutes, fires):
    data = spark.createDataFrame([at(m, latency_ms=900.0 if 10 <= m < 10 + minutes else 20.0) for m in range(40)], LOG)
    exact = sw.exact_latency_breaches(data).orderBy("window_start").collect()
    got = sw.latency_breaches(ss.summarise(sw.with_bin(data, "latency_ms"), sw.request_steps(endpoint="target"))).orderBy("window_start").collect()
    assert len(got) == len(exact) == max(0, minutes - 4) and [r.window_start for r in got] == [r.window_start for r in exact]
    if fires:
        assert exact[0].value == 900.0 and abs(got[0].value - 900) < 900 / 128


def test_an_alert_is_seen_while_it_is_open(spark):
    """The last five minutes of the log breach: the alert is there, not final."""
    data = spark.createDataFrame([at(m, latency_ms=900.0 if m >= 35 else 20.0) for m in range(40)], LOG)
    got = sw.latency_breaches(ss.summarise(sw.with_bin(data, "latency_ms"), sw.request_steps(endpoint="target"))).collect()
    assert [(r.window_start, r.final) for r in got] == [(START + timedelta(minutes=35), False)]


def test_error_rate_alert(spark):
    # twenty errors in one minute: above 0.05 per second in every five-minute window that holds it
    found = lambda data: sw.error_rate_breaches(ss.summarise(sw.with_bin(spark.createDataFrame(data, LOG), "latency_ms"), sw.request_steps(endpoint="target")))
    got = found([at(20 + i / 60, status=503) for i in range(20)] + [at(m) for m in range(60)]).orderBy("window_end").collect()
    assert len(got) == 4 and all(r.severity == "critical" for r in got)
    assert found([at(20 + i / 60, status=503) for i in range(15)]).isEmpty()


def test_silence_batch_and_stream(spark, tmp_path):
    data = [at(m * 0.5, target="a") for m in range(20)] + [at(30 + m * 0.5, target="a") for m in range(400)]
    data += [at(m * 0.5, target="b") for m in range(460)]
    data.sort(key=lambda r: r[1])
    found = lambda steps: sorted((r.target, r.silent_from, r.back_at) for r in sw.silences(steps).collect())
    stream, batch = log(spark, str(tmp_path), [data[:30], data[30:]])
    # c never comes back, b stops within the gap before the end
    down = spark.createDataFrame([at(3, target="c")], LOG).unionByName(batch)
    a = ("a", START + timedelta(minutes=10.5), START + timedelta(minutes=30))
    assert found(ss.summarise(down, sw.target_steps())) == [a, ("c", START + timedelta(minutes=4), None)]
    assert found(ss.summarise(batch, sw.target_steps())) == [a] == found(kept(spark, stream, sw.target_steps()))
    # before a is back, its silence is open
    early = spark.createDataFrame([r for r in data if r[1] < START + timedelta(minutes=20)], LOG)
    assert found(ss.summarise(early, sw.target_steps())) == [(a[0], a[1], None)]


def test_stream_upsert_is_idempotent(spark, tmp_path, rows):
    schema = T.StructType().add("user_id", T.LongType()).add("x", T.DoubleType()).add("event_timestamp", T.TimestampType()).add("created", T.TimestampType())
    view = st.FeatureView("v", "user_id", (("x", T.DoubleType()),), timedelta(days=7))
    parts = [[(i, 1.0, START, START) for i in range(30)], [(3, 2.0, START + timedelta(days=1), START), (4, 0.5, START - timedelta(days=1), START)]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/p{i}")
    rows_in = sinks.read_stream(spark, f"{tmp_path}/in/p*", schema, max_files=1)
    table = new_folder(spark, "upsert")
    plain = T.StructType([f for f in schema.fields if f.name != "created"])

    def run(checkpoint):
        sinks.stream_materialize(rows_in, view, table, checkpoint, buckets=4).awaitTermination()
        return dict(rows(read_online(spark, table, plain), "user_id", "x"))

    first = run(new_folder(spark, "ck"))
    assert first == {**{i: 1.0 for i in range(30)}, 3: 2.0}
    # the same batches again, as after a lost checkpoint
    assert run(new_folder(spark, "ck")) == first


def test_stream_upsert_goes_on_with_fresh_checkpoints_and_repeats(spark, tmp_path, rows):
    schema = T.StructType().add("user_id", T.LongType()).add("x", T.DoubleType()).add("event_timestamp", T.TimestampType()).add("created", T.TimestampType())
    view = st.FeatureView("v", "user_id", (("x", T.DoubleType()),), timedelta(days=7))
    table = new_folder(spark, "upsert")

    def run(name, data, checkpoint):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}/p{len(data)}")
        sinks.stream_materialize(sinks.read_stream(spark, f"{tmp_path}/{name}/p*", schema), view, table, checkpoint, buckets=2).awaitTermination()
        return dict(rows(read_online(spark, table, schema), "user_id", "x"))

    later = START + timedelta(hours=1)
    assert run("a", [(1, 50.0, START, START)], new_folder(spark, "ck")) == {1: 50.0}
    assert run("b", [(2, 7.0, START, START), (3, 8.0, START, START)], new_folder(spark, "ck")) == {1: 50.0, 2: 7.0, 3: 8.0}
    checkpoint = new_folder(spark, "ck")
    # the same event time, created later: the correction counts, although its value is smaller
    want = {1: 20.0, 2: 7.0, 3: 8.0}
    assert run("c", [(1, 20.0, START, later)], checkpoint) == want
    # the batch's own commit is lost, so it runs again and replaces its own version
    folder = checkpoint.removeprefix("file:")
    for lost in ("0", ".0.crc"):
        os.unlink(f"{folder}/commits/{lost}")
    assert run("c", [(4, 1.0, START, START)] * 2, checkpoint) == {**want, 4: 1.0}
    versions = [c.version for c in online_commits(spark, table)]
    assert len(versions) == len(set(versions)) and len([c for c in online_commits(spark, table) if c.writer.endswith("/0")]) <= 3


def test_buckets_split_as_the_table_grows(spark, tmp_path, rows):
    """From 4 buckets to 64 between streams, each with its own checkpoint; every key stays readable all the time."""
    schema = T.StructType().add("user_id", T.LongType()).add("x", T.DoubleType()).add("event_timestamp", T.TimestampType())
    view = st.FeatureView("v", "user_id", (("x", T.DoubleType()),), timedelta(days=7))
    table, want, seen = new_folder(spark, "grow"), {}, []
    for k, n in enumerate((40, 300, 10, 700, 1200, 5, 5, 5)):
        new = {(i * 13 + k) % 2000: float(k * 10_000 + i) for i in range(n)}
        want |= new
        spark.createDataFrame([(i, x, START + timedelta(hours=k)) for i, x in new.items()], schema).coalesce(1).write.parquet(f"{tmp_path}/in{k}/p0")
        source, checkpoint = sinks.read_stream(spark, f"{tmp_path}/in{k}/p*", schema), new_folder(spark, "ck")
        sinks.stream_materialize(source, view, table, checkpoint, buckets=4, rows_per_bucket=20).awaitTermination()
        assert dict(rows(read_online(spark, table, schema), "user_id", "x")) == want
        n_buckets, n_rows = online_shape(online_commits(spark, table))
        assert n_rows == len(want)
        seen.append(n_buckets)
        if k == 4:
            # the same batch again, after its commit was lost, splits nothing twice
            os.unlink(f"{checkpoint.removeprefix('file:')}/commits/0")
            os.unlink(f"{checkpoint.removeprefix('file:')}/commits/.0.crc")
            sinks.stream_materialize(source, view, table, checkpoint, buckets=4, rows_per_bucket=20).awaitTermination()
            assert dict(rows(read_online(spark, table, schema), "user_id", "x")) == want and online_shape(online_commits(spark, table))[0] == n_buckets
    assert seen == sorted(seen) and seen[0] == 4 and seen[-1] >= 64


def test_linear_buckets_only_move_to_new_ones():
    for n in range(1, 70):
        for h in range(300):
            a, b = bucket_number(h, n), bucket_number(h, n + 1)
            assert a == b or (b == n and a == bucket_number(n, n))
