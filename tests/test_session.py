import pytest
from pyspark.sql import functions as F

from tally.session import shared_folder, store, together


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(f"{root}/tally/x-") and first != second


def test_stored_rows_do_not_change(spark):
    stored = store(spark.range(100).withColumn("r", F.rand()), "random")
    assert stored.collect() == stored.collect()
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()


def test_jobs_run_together_and_errors_surface(spark):
    assert together([lambda n=n: spark.range(n).count() for n in (3, 1, 2)]) == [3, 1, 2]
    with pytest.raises(ValueError):
        together([lambda: 1, lambda: int("x")])
