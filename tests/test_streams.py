import datetime
import random

from pyspark.sql import functions as F

from orgmill.operators import records
from orgmill.shared import listed
from orgmill.streaming import report, store, transitions

SCHEMA = "user string, at timestamp, seq long, state string, note string"


def run(spark, source, target, marks, delay, idle):
    stream = transitions.stream_log(spark.readStream.schema(SCHEMA).parquet(source), "user", delay, idle)
    query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", marks).trigger(availableNow=True).start(target)
    query.awaitTermination()
    return query.lastProgress


def test_log_of_late_rows_over_restarts_equals_the_batch_form(spark, tmp_path):
    """Rows come out of order within the delay, in four runs that go on from the checkpoint; states end after the idle time."""
    rng = random.Random(1)
    start = datetime.datetime(2024, 1, 1)
    states = [*transitions.RANKS, "ELSEWHERE"]
    rows = [(f"u{rng.randint(0, 5)}", start + datetime.timedelta(minutes=rng.randint(0, 6000), microseconds=rng.randint(0, 10**6)), i, rng.choice(states), None if i % 7 == 0 else f"n{i}") for i in range(260)]
    rows.append(("end", start + datetime.timedelta(days=9), 999, "VERIFIED", "moves the watermark"))
    rows.sort(key=lambda r: r[1] + datetime.timedelta(minutes=rng.randint(0, 100)))
    source, target, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    idle = datetime.timedelta(hours=3)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, transitions.PROVIDER)
    try:
        for k in range(4):
            spark.createDataFrame(rows[k * len(rows) // 4 : (k + 1) * len(rows) // 4], SCHEMA).coalesce(1).write.mode("append").parquet(source)
            progress = run(spark, source, target, marks, "2 hours", idle)
    finally:
        spark.conf.set(provider, before)
    got = {tuple(r) for r in spark.read.schema(transitions.LOG).parquet(target).collect()}
    past = spark.createDataFrame([r for r in rows if r[0] != "end"], SCHEMA)
    want = {tuple(r) for r in transitions.batch_log(past, "user", idle).collect()}
    assert got == want and len(want) > 60
    assert sum(r[2] == r[2] and r[3] == "DISCOVERED" for r in got) > 6  # some began anew
    assert progress.stateOperators[0].numRowsTotal < 10  # what has ended is gone: only the last key waits
    plain, now = [], {}
    for user, at, _, state, note in sorted((r for r in rows if r[0] != "end"), key=lambda r: (r[0], r[1], r[2])):
        rank, n, last = now.get(user, (None, 0, None))
        if last is None or at - last > idle + datetime.timedelta(milliseconds=1):
            rank, n = 0, 1
            plain.append((user, 0, at, "DISCOVERED", None))
        if transitions.RANKS.get(state, 0) > rank:
            rank = transitions.RANKS[state]
            plain.append((user, n, at, state, note))
            n += 1
        now[user] = rank, n, at
    assert set(plain) == want


def test_state_of_many_entities_is_kept_by_parts(spark, tmp_path):
    """Six thousand entities wait: the state has some rows for each part, not for each entity. Null keys and seqs count, too."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(f"u{i}" if i else None, start + datetime.timedelta(seconds=k * i), None if i % 5 == 0 else i * k, state, None) for i in range(6000) for k, state in ((1, "VERIFIED"), (2, "APPROVED"))]
    source, target, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, transitions.PROVIDER)
    try:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        progress = run(spark, source, target, marks, "2 days", datetime.timedelta(hours=3))
        assert 0 < progress.stateOperators[0].numRowsTotal <= 5 * 1024
        spark.createDataFrame([("end", start + datetime.timedelta(days=9), 1, "VERIFIED", None)], SCHEMA).write.mode("append").parquet(source)
        run(spark, source, target, marks, "2 days", datetime.timedelta(hours=3))
    finally:
        spark.conf.set(provider, before)
    got = sorted(map(repr, spark.read.schema(transitions.LOG).parquet(target).collect()))
    assert got == sorted(map(repr, transitions.batch_log(spark.createDataFrame(rows, SCHEMA), "user", datetime.timedelta(hours=3)).collect()))
    assert len(got) == 18_000


def test_batch_form_of_an_empty_table(spark):
    assert transitions.batch_log(spark.createDataFrame([], SCHEMA), "user", datetime.timedelta(hours=1)).where(F.lit(True)).count() == 0


def test_store_reads_only_touched_buckets_and_replays_add_nothing(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    target, schema, paths = str(tmp_path / "store"), "user long, kind string, seq long, value double", []
    first = store.read

    def watched(spark_, target_, schema_, buckets=None):
        paths.append(buckets)
        return first(spark_, target_, schema_, buckets)

    monkeypatch.setattr(store, "read", watched)
    rows = [(rng.randint(0, 300), rng.choice(["a", "b", None]), i, i / 2) for i in range(900)]
    want = {}
    for k in range(3):
        part = rows[k * 300 : (k + 1) * 300]
        touched = store.add_batch(spark.createDataFrame(part, schema), k, target, ["user", "kind"], "seq", buckets=16)
        assert (not touched) == (k == 0) and (not touched or paths[-1] == touched)
        for user, kind, seq, value in part:
            if kind is not None:
                want.setdefault((user, kind), (seq, value))
    got = {(r["user"], r["kind"]): (r["seq"], r["value"]) for r in first(spark, target, schema).where("kind is not null").collect()}
    assert got == want
    # one key alone: one bucket at most is read, and a key that is new to its filter reads nothing
    paths.clear()
    assert len(store.add_batch(spark.createDataFrame([rows[0]], schema), 3, target, ["user", "kind"], "seq", buckets=16)) == (rows[0][1] is not None) or rows[0][1] is None
    assert store.add_batch(spark.createDataFrame([(10**9, "new", 1, 1.0)], schema), 4, target, ["user", "kind"], "seq", buckets=16) == []
    before = first(spark, target, schema).count()
    assert store.add_batch(spark.createDataFrame([(77, "again", 1, 1.0)], schema), 4, target, ["user", "kind"], "seq", buckets=16) == []
    assert first(spark, target, schema).count() == before
    # a batch that broke off before its manifest has left rows: they are not read, and not kept
    spark.createDataFrame([(55, "left", 1, 1.0)], schema).withColumn("bucket", F.lit(3)).write.partitionBy("bucket").parquet(f"{target}/data/batch=5")
    assert first(spark, target, schema).count() == before
    store.add_batch(spark.createDataFrame([(56, "done", 1, 1.0)], schema), 5, target, ["user", "kind"], "seq", buckets=16)
    assert {r["kind"] for r in first(spark, target, schema).where("user in (55, 56) and seq = 1").collect()} == {"done"}


def test_totals_after_each_micro_batch_equal_the_batch_report(spark, tmp_path):
    rng = random.Random(8)
    schema = "id string, version long, state string, last_error string, completeness long, source_confidence long"
    source, target, marks = (str(tmp_path / x) for x in ("in", "out", "marks"))
    provider = "spark.sql.streaming.stateStore.providerClass"
    before, now = spark.conf.get(provider), {}
    spark.conf.set(provider, transitions.PROVIDER)
    try:
        for k in range(4):
            rows = [(f"e{rng.randint(0, 30)}", k * 100 + i, rng.choice(["APPROVED", "NEEDS_REVIEW", "REJECTED", "JSON_READY", "VERIFIED"]), rng.choice([None, "duplicate", "x"]), rng.choice([None, 40, 91]), rng.choice([None, 13, 66])) for i in range(25)]
            rows.append(("e1", -5, "APPROVED", None, 1, 1))  # older than what is there
            for r in rows:
                if r[0] not in now or r[1] > now[r[0]][1]:
                    now[r[0]] = r
            spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
            changed = report.changes(spark.readStream.schema(schema).parquet(source))
            changed.writeStream.outputMode("update").foreachBatch(report.keep_totals(target)).option("checkpointLocation", marks).trigger(availableNow=True).start().awaitTermination()
            want = records.run_report(spark.createDataFrame(list(now.values()), schema), "s").drop("generated_at").first()
            assert report.report(spark, target, "s").first() == want
    finally:
        spark.conf.set(provider, before)
    # a micro-batch that runs again adds nothing twice
    last = max(listed(spark, target))
    delta = spark.createDataFrame([(1,) + (0,) * 9], report.DELTA)
    report.keep_totals(target)(delta, last + 1)
    report.keep_totals(target)(delta, last + 1)
    assert report.report(spark, target).first()["discovered"] == len(now) + 1
