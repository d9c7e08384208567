import contextlib
import datetime
import io
import math

import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        return datetime.datetime(v.year, v.month, v.day)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(df: pd.DataFrame):
    cols = sorted(df.columns)
    rows = [tuple(norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return cols, sorted(rows, key=key)


def plan_text(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
