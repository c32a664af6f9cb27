"""Stores are kept for an input as long as its files stay as they are."""

from slotcast.session import delete, source_stamp, store_path


def test_a_store_follows_its_source(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.range(3).coalesce(1).write.parquet(f"{folder}/events.parquet")
    first = store_path(spark, "readings", folder)
    assert store_path(spark, "readings", folder) == first
    spark.range(4).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    assert store_path(spark, "readings", folder) != first
    delete(spark, f"{folder}/events.parquet")
    assert source_stamp(spark, folder) == "none"
