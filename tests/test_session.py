"""Files that a session leaves behind."""

import time

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import functions as F

from reelspark.session import batches_of, short_lived_shuffles


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def shuffle_once(spark, path):
    spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(str(path))


def test_shuffles_of_a_stage_go_when_it_is_written(spark, tmp_path, monkeypatch):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    held = shuffle_files(spark)

    def stage(spark, docs, sf_dir):
        shuffle_once(spark, tmp_path / "side")
        return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))

    spark.range(500).select(F.col("id").alias("doc_id")).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage)])
    made = corpus_pipeline.run(spark, str(tmp_path))
    # Removal is told to the executors and not waited for.
    time.sleep(1)
    assert not shuffle_files(spark) - held
    assert made.count() == 500
    assert spark.conf.get(setting, None) == before


def test_files_stay_outside_of_it(spark, tmp_path):
    held = shuffle_files(spark)
    with short_lived_shuffles(spark):
        shuffle_once(spark, tmp_path / "in")
    shuffle_once(spark, tmp_path / "out")
    assert shuffle_files(spark) - held


def test_batches_follow_bytes_not_rows(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = spark.range(8_000, numPartitions=1).selectExpr("repeat('x', 1000) AS text").mapInArrow(sizes, "n LONG")
    with batches_of(spark, 1 << 20):
        inside = [r["n"] for r in found.collect()]
    assert sum(inside) == 8_000 and max(inside) <= 1_100
    assert [r["n"] for r in found.filter("n > 0").collect()] == [8_000]
