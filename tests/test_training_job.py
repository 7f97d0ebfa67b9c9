"""The work of the job on training tables."""

from jobs import training_tables
from tests.test_jobs import SF, TRAINING


def test_observations_are_summed_once(spark):
    """Keys are nearly all different: a sum by key would take as much room and time as the observations, and then be summed again."""
    seen = training_tables.observed(spark.read.parquet(f"{SF}/lineitem.parquet"), TRAINING["observations"])
    assert "Aggregate" not in seen._jdf.queryExecution().optimizedPlan().toString()


def test_no_variants(spark, tmp_path):
    """Observations of which no variant is known give empty tables."""
    spark.read.parquet(f"{SF}/lineitem.parquet").write.parquet(f"{tmp_path}/t/lineitem.parquet")
    spark.read.parquet(f"{SF}/part.parquet").where("false").write.parquet(f"{tmp_path}/t/part.parquet")
    assert training_tables.run(spark, f"{tmp_path}/t", f"{tmp_path}/out", TRAINING).count() == 0
