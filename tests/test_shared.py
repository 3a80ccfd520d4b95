import threading
from pathlib import Path

from pyspark.sql import functions as F

from orgmill import shared


def test_scratch_folders_of_two_threads_stay_apart(spark):
    """One block ends while the other one still reads what it has stored."""
    stored, ended, found = threading.Event(), threading.Event(), {}

    def first():
        with shared.scratch(spark):
            df = shared.stored(spark.range(100), "first")
            stored.set()
            assert ended.wait(60)
            found["first"] = df.count()

    def second():
        assert stored.wait(60)
        with shared.scratch(spark):
            found["second"] = shared.stored(spark.range(7), "second").count()
            found["path"] = shared.shared_path(spark, "x")
        ended.set()

    threads = [threading.Thread(target=f) for f in (first, second)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert found["first"] == 100 and found["second"] == 7 and "scratch-" in found["path"]
    assert "scratch-" not in shared.shared_path(spark, "y")


def test_nested_scratch_blocks_and_listed_batches(spark, tmp_path):
    with shared.scratch(spark):
        outer = shared.stored(spark.range(5), "outer")
        with shared.scratch(spark):
            inner = shared.stored(spark.range(3), "inner")
            assert inner.count() == 3
        assert outer.count() == 5
    at = str(tmp_path / "t")
    assert shared.listed(spark, at) == []
    for k in (10, 2):
        spark.range(1).write.parquet(f"{at}/batch={k}")
    assert shared.listed(spark, at) == [2, 10]


def shuffled(spark):
    """Files of shuffles on this machine."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*.data")}


def test_what_a_stored_table_has_shuffled_is_deleted_with_it(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(spark), spark.conf.get(key)
    for k in range(2):
        df = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
        table = shared.stored(df, "counts") if k else shared.settled(spark, "counts", lambda df=df: df)
        for _ in range(50):  # files are deleted beside the driver's next steps
            if not (left := shuffled(spark) - before):
                break
            threading.Event().wait(0.1)
        else:
            raise AssertionError(left)
        assert len(rows := table.collect()) == 100 and sum(r["count"] for r in rows) == 10_000  # without a shuffle
    assert spark.conf.get(key) == setting
    assert df.count() == 100  # a table can be written again


def test_the_setting_is_put_back_by_the_last_of_two_writes(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    first, second = shared._cleaning(spark), shared._cleaning(spark)
    setting = spark.conf.get(key)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == setting
