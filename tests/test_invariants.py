
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from result_rows import rows
from lakeload.operators import dedup, windows

D = dt.datetime

row = st.tuples(st.one_of(st.none(), st.integers(0, 3)),                 # key, NULLs allowed
                st.one_of(st.none(), st.integers(0, 5)),                 # order value, NULLs allowed
                st.text(alphabet="abc", max_size=2))


@settings(max_examples=12, deadline=None)
@given(st.lists(row, min_size=1, max_size=30))
def test_latest_by_agg_equals_latest_by_window(spark, data):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(data)], "k int, o int, v string, uid int")
    order = ["o", "uid"]  # uid makes the order total
    assert rows(dedup.latest_by_agg(df, ["k"], order)) == rows(dedup.latest_by_window(df, ["k"], order, None))


def test_pending_and_done_cover_the_grid(spark):
    req = spark.createDataFrame([(k, 4, 2, 30, "20240115", "DAILY", None) for k in range(1, 6)],
                                "job_key bigint, seq_max int, seq_num int, refresh int, run_date string, "
                                "schedule string, run_id_format string")
    grid = windows.window_grid(req)
    ids = {r["job_key"]: [x["run_id"] for x in grid.where(f"job_key = {r['job_key']}").orderBy("seq").collect()]
           for r in req.collect()}
    last = spark.createDataFrame([(k, "COMPLETED", ids[k][k]) for k in range(1, 6)],
                                 "job_key bigint, status string, last_run_id string")
    pending = windows.pending_windows(grid, last)
    for k in range(1, 6):
        got = sorted(r["run_id"] for r in pending.where(f"job_key = {k}").collect())
        done = ids[k][: k + 1]
        assert sorted(got + done) == sorted(ids[k]) and not set(got) & set(done)
