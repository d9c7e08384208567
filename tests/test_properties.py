"""Property tests: merge and roll against plain-Python statements of the rules."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from netpulse.operators import forecast as fc
from netpulse.operators.merge import forecast_merge

from test_forecast import GRID_SCHEMA, MERGE_SCHEMA, expected_roll

H = dt.timedelta(hours=1)
T0 = dt.datetime(2024, 1, 1)

rows = st.dictionaries(st.integers(0, 30), st.tuples(st.one_of(st.none(), st.integers(0, 50)), st.integers(0, 50)),
                       max_size=12)


def merge_rule(old, new):
    """The merge written row by row."""
    out = []
    for ds, (y, yhat) in old.items():
        if y is None and ds in new and new[ds][0] is not None:
            y = new[ds][0]
        out.append((ds, y, yhat))
    out += [(ds, None, yhat) for ds, (y, yhat) in new.items() if y is None]
    return sorted(out, key=repr)


def _df(spark, d):
    data = [("a", T0 + k * H, None if y is None else float(y), float(yh)) for k, (y, yh) in d.items()]
    return spark.createDataFrame(data, MERGE_SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows, new=rows)
def test_merge_matches_rule(spark, old, new):
    got = forecast_merge(_df(spark, old), _df(spark, new)).collect()
    got = [(int((r.ds - T0) / H), None if r.y is None else int(r.y), int(r.yhat)) for r in got]
    assert sorted(got, key=repr) == merge_rule(old, new)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cases=st.lists(st.tuples(st.integers(0, 23), st.integers(0, 59), st.integers(1, 40)), min_size=1, max_size=20))
def test_roll_matches_listed_slots(spark, cases):
    data, expected = [], {}
    for i, (hour, minute, interval) in enumerate(cases):
        last = dt.datetime(2024, 3, 1, hour, minute)
        fut = [last + k * H for k in range(1, interval + 1)]
        data.append((f"k{i}", last, 1.0, False))
        data += [(f"k{i}", d, None, True) for d in fut]
        expected[f"k{i}"] = sorted(expected_roll(fut))
    got = {}
    for r in fc.business_hours_roll(spark.createDataFrame(data, GRID_SCHEMA), "ip", 8).where("is_future").collect():
        got.setdefault(r.ip, []).append(r.ds)
    assert {k: sorted(v) for k, v in got.items()} == expected
