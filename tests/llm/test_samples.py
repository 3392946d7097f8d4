import pytest
from pyspark.sql import functions as F

from gridpulse.llm.common import labelled_sample, thinned


@pytest.mark.parametrize("hot", ["cast(null as long)", "cast(5 as long)"])
@pytest.mark.parametrize("text", ["cast(id as string)", "'the same'"])
def test_a_third_of_the_rows_under_one_id_stays_within_the_bound(spark, hot, text):
    rows = spark.range(30_000).selectExpr(f"if(id % 3 = 0, {hot}, id) as k", f"if(id % 3 = 0, {text}, cast(id as string)) as t", "'x' as y")
    n = labelled_sample(rows, "y", ["k", "t"], 300).count()
    assert 150 < n <= 500


def test_a_hot_id_after_the_join_is_thinned(spark):
    rows = spark.range(9000).select(F.lit(7).alias("id"), F.when(F.col("id") < 60, 1).otherwise(0).alias("y"))
    got = {r["y"]: r["count"] for r in thinned(rows, "y", {0: 500, 1: 100}).groupBy("y").count().collect()}
    assert got[1] == 60 and 350 < got[0] < 650
