import pytest
from pyspark.sql import functions as F

from conftest import SF001
from storepulse.plans import registry
from storepulse.plans.session import checkpoint_dir, stage
from storepulse.sinks.writers import publish, read_published, write_report


def test_write_and_read_back(spark, tmp_out):
    df = registry.category_achieved(spark, SF001)
    for fmt in ("parquet", "csv", "json"):
        path = write_report(df, f"{tmp_out}/cat_{fmt}", fmt)
        back = spark.read.format(fmt).option("header", True).option("inferSchema", True).load(path)
        assert back.count() == df.count()


def test_publish_batch(spark, tmp_out):
    reports = {"a": registry.customers_total(spark, SF001), "b": registry.category_achieved(spark, SF001)}
    publish(reports, tmp_out)
    assert read_published(spark, tmp_out, "a").first().customers > 0
    back = [(r.window_seq, r.category) for r in read_published(spark, tmp_out, "b").collect()]
    assert len(back) == reports["b"].count() and back == sorted(back)


def test_failed_batch_leaves_the_former_one(spark, tmp_out):
    one = registry.customers_total(spark, SF001)
    publish({"a": one}, tmp_out)
    before = read_published(spark, tmp_out, "a").first()
    broken = one.select(F.raise_error(F.lit("lost")).cast("long").alias("customers"))
    with pytest.raises(Exception, match="lost"):
        publish({"a": one.select((F.col("customers") + 1).alias("customers")), "b": broken}, tmp_out)
    assert read_published(spark, tmp_out, "a").first() == before
    with pytest.raises(ValueError):
        read_published(spark, tmp_out, "b")
    publish({"a": one.select((F.col("customers") + 1).alias("customers"))}, tmp_out)
    assert read_published(spark, tmp_out, "a").first().customers == before.customers + 1


def test_small_reports_are_aggregated_in_parallel(spark, tmp_out):
    path = write_report(registry.category_achieved(spark, SF001), f"{tmp_out}/one")
    assert len(spark.read.parquet(path).inputFiles()) == 1


def test_staging_needs_a_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_stage_uses_checkpoint_folder(spark):
    base = checkpoint_dir(spark)
    staged = stage(registry.lot_values(spark, SF001), "lot_values_test")
    assert staged.count() > 0
    assert any(base.rstrip("/").split(":")[-1] in f for f in staged.inputFiles())


def test_large_reports_are_several_files_in_order(spark, tmp_out):
    rows = spark.range(20_000).selectExpr("cast(id % 3 + 1 as int) window_seq", "concat('S', lpad(cast(id * 7919 % 20000 as string), 6, '0')) store", "id v")
    path = write_report(rows, f"{tmp_out}/big", files=7, sort_by=["window_seq", "store"])
    files = sorted(f for f in spark.read.parquet(path).inputFiles())
    assert len(files) == 7
    whole = []
    for f in files:  # in the order of their names
        whole += [(r.window_seq, r.store) for r in spark.read.parquet(f).collect()]
    assert whole == sorted(whole) and len(whole) == 20_000


def test_report_size_decides_the_number_of_files(spark, tmp_out):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    rows = spark.range(60_000).selectExpr("1 window_seq", "cast(id * 7919 % 60000 as int) k", "cast(id as string) v")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "50k")
        publish({"r": rows}, tmp_out)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(read_published(spark, tmp_out, "r").inputFiles()) > 1
    assert [r.k for r in read_published(spark, tmp_out, "r", ordered=True).collect()] == list(range(60_000))


def test_only_the_manifests_needed_are_read(spark, tmp_out):
    from storepulse.sinks.writers import published_runs

    one = registry.customers_total(spark, SF001)
    publish({"a": one}, tmp_out, run_id="1")
    publish({"b": one}, tmp_out, run_id="2")
    assert [r.rsplit("/", 1)[-1] for r in published_runs(spark, tmp_out)] == ["2", "1"]
    assert read_published(spark, tmp_out, "a").count() == 1
    assert published_runs(spark, f"{tmp_out}/none") == []
