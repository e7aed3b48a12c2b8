"""Session helpers: shuffle sizing and the checkpoint folder."""

from tillpoint.session import checkpoint_dir, configure_for_input, shuffle_partitions_for


def test_shuffle_partitions_for():
    assert shuffle_partitions_for(0) == 200
    assert shuffle_partitions_for(10 << 30) == 200            # 10 GiB -> minimum
    assert shuffle_partitions_for(100 << 40) == 409600        # 100 TiB -> 256 MiB each


def test_configure_and_checkpoint(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        configure_for_input(spark, 1 << 40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    d = checkpoint_dir(spark)
    assert d and spark.conf.get("spark.checkpoint.dir") == d


def test_scratch_blocks_belong_to_their_thread(spark):
    """A table written while another thread has a block open outlives that block."""
    from threading import Event, Thread

    from tillpoint.session import materialize, scratch
    opened, written, inner = Event(), Event(), []

    def other():
        with scratch():
            inner.append(materialize(spark.range(2), "inner"))
            opened.set()
            written.wait(60)

    t = Thread(target=other)
    t.start()
    assert opened.wait(60)
    mine = materialize(spark.range(5), "outer")
    written.set()
    t.join()
    assert mine.count() == 5 and len(inner) == 1


def _shuffles(spark):
    """Shuffles whose output is still kept."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


def test_settle_releases_the_shuffles_behind_a_table(spark):
    import gc
    import time

    from tillpoint.session import release_shuffles, settle
    gc.collect()
    release_shuffles(spark)
    time.sleep(2)
    before = _shuffles(spark)
    t = settle(spark.range(2000).repartition(3).selectExpr("id % 7 AS k").groupBy("k").count(), "settled")
    assert sorted(r["count"] for r in t.collect()) == [285] * 2 + [286] * 5
    until = time.time() + 30
    while _shuffles(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert _shuffles(spark) <= before
