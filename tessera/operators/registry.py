"""User operators: a registry of DataFrame transforms, and user code per
row batch, per group or per conversation (Arrow batches via pandas)."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Operator = Callable[[DataFrame, dict], DataFrame]

_BUILTIN: set[str] = {
    "set", "filter", "switch", "aggregate", "sort", "limit", "split_out", "summarize", "remove_duplicates",
    "datetime", "condition", "loop", "router", "merge", "field_selector", "prompt_template", "answer",
    "variable", "model_selector", "embed", "retriever", "reranker", "vector_store",
}
_USER: dict[str, Operator] = {}


def register_operator(name: str, fn: Operator) -> None:
    """Add a user operator; built-in names are refused."""
    if name in _BUILTIN:
        raise ValueError(f"cannot override built-in operator {name!r}")
    _USER[name] = fn


def unregister_operator(name: str) -> bool:
    return _USER.pop(name, None) is not None


def has_operator(name: str) -> bool:
    return name in _USER or name in _BUILTIN


def apply_operator(df: DataFrame, name: str, config: dict | None = None) -> DataFrame:
    """Run a registered user operator through ``DataFrame.transform``."""
    if name not in _USER:
        raise KeyError(f"no user operator {name!r}")
    return df.transform(_USER[name], config or {})


def code_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | Any) -> DataFrame:
    """User code per Arrow batch of rows (trusted code only)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    return df.mapInPandas(run, schema)


#: numpy types of columns whose pandas type depends on whether a frame holds nulls
_NULLABLE = {T.ByteType(): "int8", T.ShortType(): "int16", T.IntegerType(): "int32", T.LongType(): "int64", T.BooleanType(): "bool"}
#: types of group keys that are equal if their Python values are
_KEYS = {*_NULLABLE, T.StringType(), T.DateType()}
_PLAIN = {*_KEYS, T.FloatType(), T.DoubleType()}
#: rows of results that leave a task together
RESULT_ROWS = 10_000


def code_groups(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema: str | Any) -> DataFrame:
    """User code per group: the whole group is one pandas frame in one task, so
    use it for bounded groups.

    ``applyInPandas`` sends every group by itself, which costs more than the
    user code where groups are small. Rows sorted by the keys are sent in
    batches instead and cut into groups by the task; a group that goes on in the
    next batch is kept until it ends. Columns of other than plain types, and
    code that asks for the key too, go through ``applyInPandas``.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    plain = len(types) == len(df.columns) and all(t in _PLAIN for t in types.values())
    if not plain or not keys or len(inspect.signature(fn).parameters) != 1 or any(types.get(k) not in _KEYS for k in keys):
        return df.groupBy(*keys).applyInPandas(fn, schema)
    # a column of whole numbers with a null would become one of floats for all groups of a batch: nulls are sent beside it
    whole = {i: _NULLABLE[f.dataType] for i, f in enumerate(df.schema.fields) if f.dataType in _NULLABLE}
    names, at = df.columns, [df.columns.index(k) for k in keys]
    cols = [F.col(f"`{c}`") for c in names]
    sent = [(F.coalesce(c, F.lit(False if whole[i] == "bool" else 0).cast(types[names[i]])) if i in whole else c).alias(f"c{i}") for i, c in enumerate(cols)]
    flags = [cols[i].isNull().alias(f"n{i}") for i in whole]
    keyed = df.repartition(*[cols[i] for i in at]).sortWithinPartitions(*[cols[i] for i in at]).select(*sent, *flags)
    flag_of = {i: len(names) + j for j, i in enumerate(whole)}

    def starts(arrays: list[np.ndarray], n: int) -> np.ndarray:
        """Rows whose key is not that of the row before."""
        new = np.zeros(n, dtype=bool)
        new[0] = True
        for i in [*at, *(flag_of[i] for i in at if i in flag_of)]:
            a = arrays[i]
            if a.dtype == object:
                null = pd.isna(a)
                a = np.where(null, None, a)
            new[1:] |= np.asarray(a[1:] != a[:-1], dtype=bool)
        return np.flatnonzero(new)

    def frames(arrays: list[np.ndarray], bounds: np.ndarray) -> Iterator[pd.DataFrame]:
        """The frames between row numbers ``bounds``, copies that user code may change."""
        both = pd.DataFrame(dict(zip(names, arrays)), copy=False)
        holes = {i: arrays[j] for i, j in flag_of.items() if arrays[j].any()}
        for a, b in zip(bounds[:-1], bounds[1:]):
            out = both.iloc[a:b].reset_index(drop=True)
            for i, nulls in holes.items():
                null = nulls[a:b]
                if null.any():
                    x = arrays[i][a:b].astype(object if whole[i] == "bool" else np.float64)
                    x[null] = None if whole[i] == "bool" else np.nan
                    out[names[i]] = x
            yield out

    def results(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n, kind = 0, None
        for f in parts:
            r = fn(f)
            if not isinstance(r, pd.DataFrame):
                raise TypeError(f"the code of a group returns a pandas frame, not {type(r).__name__}")
            if not len(r):
                continue
            # only frames of the same columns and types go together, so that none is converted
            own = (list(r.columns), r.dtypes.tolist())
            if held and (own != kind or n >= RESULT_ROWS):
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
            kind = own
            held.append(r)
            n += len(r)
        if held:
            yield pd.concat(held, ignore_index=True)

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[list[np.ndarray]] = []  # of the group that may go on

        def last() -> Iterator[pd.DataFrame]:
            arrays = [np.concatenate(p) for p in zip(*parts)]
            yield from frames(arrays, np.array([0, len(arrays[0])]))

        for pdf in batches:
            if not len(pdf):
                continue
            arrays = [pdf.iloc[:, i].to_numpy() for i in range(pdf.shape[1])]
            first = starts(arrays, len(pdf))
            if parts:
                edge = [np.concatenate((p[-1:], a[:1])) for p, a in zip(parts[-1], arrays)]
                if len(starts(edge, 2)) == 1:  # the first group of the batch is that of the last one
                    end = first[1] if len(first) > 1 else len(pdf)
                    parts.append([a[:end] for a in arrays])
                    first = first[1:]
                    if not len(first):
                        continue
                yield from last()
            yield from frames(arrays, first)
            parts = [[a[first[-1]:].copy() for a in arrays]]
        if parts:
            yield from last()

    return keyed.mapInPandas(lambda batches: results(groups(batches)), schema)


def transform_context(conv: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str | Any,
                      session_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """A user hook over each conversation's messages, in turn order."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return fn(pdf.sort_values(order_col).reset_index(drop=True))

    return code_groups(conv, [session_col], run, schema)
