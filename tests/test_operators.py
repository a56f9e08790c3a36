import duckdb
import pytest

import __spark_entry__ as entry
from cairnspark.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    a = plans.QUERIES[name](spark, SF).toPandas()
    assert len(a)
    if name in plans.ORACLES:
        b = duck.execute(plans.ORACLES[name]).df()
        cols = sorted(a.columns)
        assert cols == sorted(b.columns)
        a, b = (x[cols].sort_values(cols).reset_index(drop=True) for x in (a, b))
        assert len(a) == len(b)
        for c in cols:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_one_shuffle_for_all_face_tests(spark):
    from cairnspark.operators.voxel import exposed_faces

    cells = spark.createDataFrame([(0, 0, 0)], "gx long, gy long, gz long")
    plan = exposed_faces(cells, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_size_text_rounds_as_sql(spark, duck):
    from pyspark.sql import functions as F

    from cairnspark.functions.scalar import size_text

    sizes = [0, 5, 999, 1000, 1005, 1015, 1125, 1375, 999_995, 999_999, 1_005_000, 1_125_000, 2_625_000, 2_835_000, 3_255_000, 999_995_000, 1_005_000_000, 1_125_000_000, 7 * 10**15 + 5 * 10**6]
    sizes += [1500 * k for k in range(600, 4000, 10)]
    got = [r.s for r in spark.createDataFrame([(i, b) for i, b in enumerate(sizes)], "i int, b long").select("i", size_text(F.col("b")).alias("s")).orderBy("i").collect()]
    sql = "CASE WHEN b >= 1e9 THEN printf('%.2f GB', b / 1e9) WHEN b >= 1e6 THEN printf('%.2f MB', b / 1e6) WHEN b >= 1e3 THEN printf('%.2f KB', b / 1e3) ELSE b || ' bytes' END"
    assert got == [r[0] for r in duck.execute(f"SELECT {sql} FROM (SELECT unnest(?::BIGINT[]) AS b)", [sizes]).fetchall()]
    assert got == [f"{b} bytes" if b < 1e3 else f"{b / 1e3:.2f} KB" if b < 1e6 else f"{b / 1e6:.2f} MB" if b < 1e9 else f"{b / 1e9:.2f} GB" for b in sizes]


def test_stride_sample_over_several_ranges(spark, tmp_path):
    n = 250_003
    con = duckdb.connect()  # keys in no order, with gaps, negative ones and one null
    con.execute(f"create table orders as select case when i = 7 then null else (i * 7919 % {n}) * 3 - 1000 end as o_orderkey, i as o_custkey from range({n}) t(i)")
    con.execute(f"copy orders to '{tmp_path}/orders.parquet'")
    want = sorted(con.execute(plans.ORACLES["stride_sample"]).fetchall(), key=str)
    got = plans.QUERIES["stride_sample"](spark, str(tmp_path))
    for _ in range(2):
        assert sorted((tuple(r) for r in got.collect()), key=str) == want


@pytest.mark.parametrize("keys", [[], [None, None], [5]])
def test_stride_sample_of_few_rows(spark, tmp_path, keys):
    spark.createDataFrame([(k, 1) for k in keys], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    assert [r.o_orderkey for r in plans.QUERIES["stride_sample"](spark, str(tmp_path)).collect()] == keys


def test_range_of_bounds(spark):
    from cairnspark.functions.scalar import range_of

    df = spark.createDataFrame([(k,) for k in (None, -9, 1, 2, 3, 7, 8)], "k long")
    assert [r.p for r in df.select(range_of(df["k"], [1, 3, 7]).alias("p")).collect()] == [3, 0, 0, 1, 1, 2, 3]
    assert [r.p for r in df.select(range_of(df["k"], []).alias("p")).collect()] == [0] * 7
