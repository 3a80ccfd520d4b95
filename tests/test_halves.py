"""Scores on the edge: halves go up, in the query and in its SQL."""

import duckdb
from pyspark.sql import functions as F

from orgmill.plans import queries


def test_confidence_of_balances_in_cents(spark, tmp_path):
    """Every balance of whole tens (2850 / 10000 is 0.285, whose double is below it) with 0 to 4 orders."""
    k = F.col("id")
    spark.range(5000).select(k.alias("c_custkey"), F.lit("n").alias("c_name"), ((F.floor(k / 5) * 10).cast("double") * F.when(k % 10 < 5, 1).otherwise(-1)).alias("c_acctbal")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(20000).where("id % 5 > floor(id / 5000)").select(k.alias("o_orderkey"), (k % 5000).alias("o_custkey")).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    for name in ("source_confidence", "quality_band", "top_quality"):
        df = queries.QUERIES[name](spark, str(tmp_path))
        want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLES[name]})").fetchall()
        assert sorted(map(tuple, df.collect())) == sorted(want) and want
