"""A dimension's broadcast: proven by rows and by bytes, the rows of the join the same either way."""

from skyledger.operators.joins import bounded_size, dim_join
from skyledger.session import session_key


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().logical().toString()


def test_broadcast_is_bounded_by_rows_and_bytes(spark):
    fact = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("z", 4), (None, 5)], "location_id string, v int")
    dim = spark.createDataFrame([("a", "x" * 1000, ["p", "q"]), ("b", None, None), ("c", "é", [])],
                                "location_id string, name string, tags array<string>")
    rows, size = bounded_size(dim)
    assert rows == 3 and 1000 < size < 2000
    assert bounded_size(dim, max_rows=1)[0] == 2            # stops one row beyond the bound
    assert bounded_size(dim.limit(0)) == (0, 0)
    by = {"hint": dim_join(fact, dim), "rows": dim_join(fact, dim, max_rows=2), "bytes": dim_join(fact, dim, max_bytes=1000)}
    assert {k: "strategy=broadcast" in plan(d) for k, d in by.items()} == {"hint": True, "rows": False, "bytes": False}
    got = [sorted(map(str, d.collect())) for d in by.values()]
    assert got[0] == got[1] == got[2] and len(got[0]) == 5


def test_sessions_are_told_apart(spark):
    other = spark.newSession()
    assert session_key(spark) == session_key(spark) != session_key(other)
    assert session_key(spark)[0] == session_key(other)[0] == spark.sparkContext.applicationId
