"""Session helpers: shared checkpoint folder and cluster sizing."""

from landlens.session import checkpoint_dir, clear_scratch, scale_conf, scratch_mark, scratch_path


def test_scale_conf_sizes_partitions():
    big = scale_conf(100 * 10**12, total_cores=8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (512 << 20))
    assert int(scale_conf(100 * 10**12, 8000, max_partitions=50_000)["spark.sql.shuffle.partitions"]) == 50_000
    small = scale_conf(10**9, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24                              # 3 waves
    mid = scale_conf(10 * 10**12, total_cores=800, target_partition_bytes=1 << 30)
    assert int(mid["spark.sql.shuffle.partitions"]) == -(-10 * 10**12 // (1 << 30))
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))


def test_scratch_is_removed_since_a_mark(spark):
    old = scratch_path(spark, "old")
    spark.range(3).write.parquet(old)
    mark = scratch_mark()
    spark.range(3).write.parquet(scratch_path(spark, "new"))
    assert clear_scratch(spark, since=mark) == 1 and scratch_mark() == mark
    assert spark.read.parquet(old).count() == 3


def test_settings_of_a_running_session_and_what_it_can_not_change(spark):
    from landlens.session import apply_conf

    before = spark.conf.get("spark.sql.shuffle.partitions")
    fixed = apply_conf(spark, {"spark.sql.shuffle.partitions": "77", "spark.driver.memory": "1g"})
    assert fixed == ["spark.driver.memory"] and spark.conf.get("spark.sql.shuffle.partitions") == "77"
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_partitions_are_refused_on_a_cluster_only(spark):
    from landlens import session

    class Cluster:
        class sparkContext:
            master = "spark://host"

        def __init__(self, partitions, initial=None):
            settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.enabled": "true",
                        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": initial}
            self.conf = type("Conf", (), {"get": lambda _, k, d=None: settings.get(k, d)})()

    tb = 1 << 40
    assert "8 shuffle partitions for 1024 GiB" in session.too_few_partitions(Cluster(8), tb)
    assert session.too_few_partitions(Cluster(2000), tb) is None and session.too_few_partitions(Cluster(8, "2000"), tb) is None
    assert session.too_few_partitions(spark, tb) is None


def test_input_size_is_the_listing(spark, tmp_path):
    from landlens.session import input_size

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_bytes(b"12345")
    (tmp_path / "b.csv").write_bytes(b"123")
    assert input_size(spark, str(tmp_path / "a"), f"{tmp_path}/*.csv") == 8 and input_size(spark, f"{tmp_path}/none*") == 0
