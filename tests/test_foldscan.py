"""Running folds of the user's own, against a plain loop."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eddy.plans import foldscan

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(-9, 9), st.one_of(st.none(), st.integers(0, 9))),
                     min_size=1, max_size=40), fan=st.sampled_from([2, 3]))
def test_folds_equal_a_loop(spark, rows, fan):
    """Maps do not commute; names like the scan's own are kept."""
    data = [(k, i, m, v, f"r{i}") for i, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "key string, i long, v long, folds long, `a.b` string")
    got = foldscan.affine_scan(df, ["i"], F.col("v"), F.col("i"), F.lit(1), "x", ["key"], modulus=101, fan=fan)
    got = foldscan.fold(got, ["i"], F.col("folds"), foldscan.last_non_null, "seen", fan=fan)
    state, seen, want = {}, None, []
    for k, i, m, v, name in data:
        state[k] = (m * state.get(k, 1) + i) % 101
        seen = seen if v is None else v
        want.append((k, i, m, v, name, state[k], seen))
    assert got.columns == [*df.columns, "x", "seen"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == want


def test_levels_and_empty(spark):
    """Four levels of blocks; text as the element, which shows the order."""
    df = spark.range(70).withColumn("t", F.chr(F.lit(65) + F.col("id") % 26))
    got = foldscan.fold(df, ["id"], F.col("t"), lambda a, b: F.concat(a, b), "s", fan=3).orderBy("id").collect()
    whole = "".join(chr(65 + i % 26) for i in range(70))
    assert [r.s for r in got] == [whole[:i + 1] for i in range(70)]
    assert foldscan.fold(df.limit(0), ["id"], F.col("t"), foldscan.last_non_null, "s").count() == 0


def test_no_python(spark):
    df = spark.range(50).withColumn("v", F.col("id") % 3)
    out = foldscan.fold(df, ["id"], F.col("v"), lambda a, b: F.greatest(a, b), "m", fan=4)
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()
