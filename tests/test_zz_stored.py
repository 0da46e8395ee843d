"""Removal of stored intermediates. Last by name: it deletes what other tests of the session have stored."""

import os

from pyspark.sql import functions as F

from textloom.session import clear_stored, materialize, shared_dir, store_by_doc, stored_root


def test_only_the_own_folder_is_cleared(spark):
    other = f"{shared_dir(spark)}/textloom/another-application/kept"
    spark.range(3).write.mode("overwrite").parquet(other)
    materialize(spark.range(3), "mine")
    stored = store_by_doc(spark.range(5).select(F.col("id").alias("doc_id")), "mine")
    assert stored.count() == 5
    root = stored_root(spark).removeprefix("file:")
    assert os.path.isdir(root)
    clear_stored(spark)
    assert not os.path.isdir(root)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("textloom_mine")]
    assert spark.read.parquet(other).count() == 3
