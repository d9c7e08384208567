"""Public per-key hooks: user code applied to each key's rows, in three forms.

* ``per_key``: a pandas function of the key's whole frame, for groups that are bounded
  by construction (an hourly series has one row per hour and source).
* ``per_key_batches``: a function of the key's rows as a stream of Arrow batches; a group
  of any size, in one task, in the memory of a batch.
* ``per_key_fold``: a mergeable summary.  Every partition folds its own rows of a frequent
  key into a state, and only states of it travel, so a key that holds a third of all rows
  is spread over all tasks that hold its rows.  Rows of rare keys travel as they are and
  are folded where all rows of their key meet.

The built-in forecast does not use them; it fits from per-key sums.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Tuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: States a task folds side by side before it sends them on and starts anew.
MAX_STATES = 100_000
#: Rows of a key in a batch from which they are folded at once; a state of fewer rows would cost more than the rows.
FOLD_ROWS = 32


def per_key(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
            schema: T.StructType | str) -> DataFrame:
    """``groupBy(keys).applyInPandas(fn, schema)``.

    A grouped map holds a whole group in one Python worker, so ``df`` must bound its
    groups by construction; an hourly series has one row per hour and source.
    """
    return df.groupBy(*keys).applyInPandas(fn, schema)


def per_key_batches(df: DataFrame, keys: list[str], fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                    schema: T.StructType | str) -> DataFrame:
    """``fn(key, batches)`` of each key: its rows as frames of at most one Arrow batch, in no particular order.

    ``fn`` yields frames of ``schema`` and must read the batches to the end.  The worker holds a
    batch at a time, however large the group; the group still is one task.
    """
    def body(key: Tuple[Any, ...], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(key, batches)

    body.__annotations__ = {"key": Tuple[Any, ...], "batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return df.groupBy(*keys).applyInPandas(body, schema)


@dataclass(frozen=True)
class Fold:
    """A mergeable summary of a key's rows.

    ``start()`` gives an empty state, ``add(state, frame)`` a state with the frame's rows,
    ``merge(a, b)`` one state of two, ``finish(key, state)`` the frame of the key.  States are
    pickled between tasks and should stay small; rows and states come in any order.
    """

    start: Callable[[], Any]
    add: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[tuple, Any], pd.DataFrame]


def _key_value(v, kind: T.DataType):
    if v is None or v != v or v is pd.NaT:
        return None
    return int(v) if isinstance(kind, T.IntegralType) else v


def _rare(pdf: pd.DataFrame, keys: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the rows of keys that are rare in a batch, and of the rows of each other key."""
    group = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
    counts = np.bincount(group, minlength=1)
    often = counts >= min(FOLD_ROWS, max(2, len(pdf) // 16))
    if not often.any():
        return np.arange(len(pdf)), []
    turn = np.argsort(group, kind="stable")
    ends = np.cumsum(counts)
    return np.flatnonzero(~often[group]), [turn[ends[g] - counts[g]:ends[g]] for g in np.flatnonzero(often)]


def _together(frames: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames as one, unless that would change the type of a column."""
    kinds = {(tuple(f.columns), tuple(f.dtypes)) for f in frames}
    if len(kinds) == 1:
        yield pd.concat(frames, ignore_index=True)
    else:
        yield from frames


def per_key_fold(df: DataFrame, keys: list[str], fold: Fold, schema: T.StructType | str) -> DataFrame:
    """One ``fold.finish`` frame per key, folded where the rows are and merged per key.

    What crosses the shuffle of a key is a state per input partition (and per ``MAX_STATES``
    keys that a partition meets at once), and the rows of those batches that hold fewer than
    ``FOLD_ROWS`` of it.  So a key with few rows per partition costs one ``add`` per batch
    where its rows meet, and not one per row.  A null key is a key.
    """
    kinds = [df.schema[k].dataType for k in keys]
    names = [f"key{i}" for i in range(len(keys))]
    values = [c for c in df.columns if c not in keys]
    held = [f"value{i}" for i in range(len(values))]
    partial = T.StructType([*[T.StructField(n, kind) for n, kind in zip(names, kinds, strict=True)],
                            *[T.StructField(h, df.schema[c].dataType) for h, c in zip(held, values, strict=True)],
                            T.StructField("state", T.BinaryType())])
    columns = dict(zip([*keys, *values], [*names, *held], strict=True))
    back = {n: c for c, n in columns.items()}
    order = list(df.columns)

    def key_of(key) -> tuple:
        return tuple(_key_value(v, kind) for v, kind in zip(key, kinds, strict=True))

    def send(states: dict, some: pd.DataFrame) -> pd.DataFrame:
        # the values beside a state are those of any row: nulls would turn whole numbers to fractions where rows meet
        out = some.iloc[[0] * len(states)].reset_index(drop=True).rename(columns=columns)
        for i, name in enumerate(names):
            out[name] = pd.Series([k[i] for k in states], dtype=object)
        return out.assign(state=pd.Series([pickle.dumps(s) for s in states.values()], dtype=object))

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states: dict = {}
        last = None
        for pdf in batches:
            if not len(pdf):
                continue
            last = pdf
            rare, often = _rare(pdf, keys)
            for at in often:
                part = pdf.iloc[at]
                key = key_of(part[k].iloc[0] for k in keys)
                states[key] = fold.add(states[key] if key in states else fold.start(), part)
            if len(rare):
                yield pdf.iloc[rare].rename(columns=columns).assign(state=pd.Series([None] * len(rare), dtype=object, index=rare))
            if len(states) > MAX_STATES:
                yield send(states, pdf)
                states = {}
        if states:
            yield send(states, last)

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, empty = None, None, True  # the key whose rows may go on in the next batch
        for pdf in batches:
            done = []
            for at, part in pdf.groupby(names, dropna=False, sort=False):
                at = key_of(at)
                if key != at:
                    if key is not None:
                        done.append(fold.finish(key, state))
                    key, state, empty = at, None, True
                new = [pickle.loads(s) for s in part["state"] if s is not None]
                rows = part[part["state"].isnull()]
                if len(rows):
                    new.append(fold.add(fold.start(), rows.rename(columns=back)[order]))
                for s in new:
                    state, empty = (s if empty else fold.merge(state, s)), False
            yield from _together(done) if done else ()
        if key is not None:
            yield fold.finish(key, state)

    dealt = df.mapInPandas(summarise, partial).repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInPandas(combine, schema)


SUMMARY_SCHEMA = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("y_sum", T.DoubleType()),
    T.StructField("y_max", T.DoubleType()),
    T.StructField("first_ds", T.TimestampNTZType()),
    T.StructField("last_ds", T.TimestampNTZType()),
])


def series_summary(pdf: pd.DataFrame) -> pd.DataFrame:
    """Example body: size, total, peak and span of one key's hourly series."""
    return pd.DataFrame({
        "ip": [pdf["ip"].iloc[0]],
        "n": [len(pdf)],
        "y_sum": [float(pdf["y"].sum())],
        "y_max": [float(pdf["y"].max())],
        "first_ds": [pdf["ds"].min()],
        "last_ds": [pdf["ds"].max()],
    })


#: The same summary as a fold: states of five numbers instead of whole series.
SUMMARY_FOLD = Fold(
    start=lambda: (0, 0.0, None, None, None),
    add=lambda s, pdf: _merged(s, (len(pdf), float(pdf["y"].sum()), pdf["y"].max(), pdf["ds"].min(), pdf["ds"].max())),
    merge=lambda a, b: _merged(a, b),
    finish=lambda key, s: pd.DataFrame({"ip": pd.Series([key[0]], dtype=object), "n": [s[0]], "y_sum": [s[1]],
                                        "y_max": pd.Series([s[2]], dtype="float64"), "first_ds": pd.Series([s[3]], dtype="datetime64[us]"),
                                        "last_ds": pd.Series([s[4]], dtype="datetime64[us]")}))


def _merged(a: tuple, b: tuple) -> tuple:
    def best(pick, x, y):
        there = [v for v in (x, y) if v is not None and v == v]
        return pick(there) if there else None

    return a[0] + b[0], a[1] + b[1], best(max, a[2], b[2]), best(min, a[3], b[3]), best(max, a[4], b[4])
