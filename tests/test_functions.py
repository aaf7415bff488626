"""The hash that cuts hot groups into parts is the same in Spark and in SQL."""

import duckdb
from pyspark.sql import functions as F

from bigraph.functions import n_parts, part_of
from bigraph.plans.oracle import md5_part


def test_part_of_matches_sql(spark):
    values = [f"w{i}" for i in range(300)] + ["", "the", "zzzz"]
    df = spark.createDataFrame([(v, 7) for v in values], "v string, parts int")
    got = {r.v: r.p for r in df.select("v", part_of(F.col("v"), F.col("parts")).alias("p")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (v VARCHAR, parts INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(v, 7) for v in values])
    want = dict(con.execute(f"SELECT v, {md5_part('v', 'parts')} FROM t").fetchall())
    assert got == want
    assert set(got.values()) == set(range(7))


def test_part_of_bigint(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "v bigint")
    got = [r.p for r in df.select(part_of(F.col("v"), F.lit(3)).alias("p")).orderBy("v").collect()]
    con = duckdb.connect()
    want = [r[0] for r in con.execute(f"SELECT {md5_part('v', '3')} FROM range(50) t(v) ORDER BY v").fetchall()]
    assert got == want


def test_n_parts(spark):
    df = spark.createDataFrame([(1,), (10,), (11,), (25,)], "s bigint")
    assert [r.p for r in df.select(n_parts(F.col("s"), 10).alias("p")).collect()] == [1, 1, 2, 3]
