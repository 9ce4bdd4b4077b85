"""The hook through which a user brings a model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def score_with(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str, *,
    batch_size: int = 1_000, retries: int = 2, is_empty: Callable[[pd.DataFrame], pd.Series] | None = None,
    failed: str | None = None,
) -> DataFrame:
    """``df`` with the columns of ``schema`` that ``fn`` computes batch by batch.

    ``fn`` gets a pandas frame of at most ``batch_size`` rows and returns one with as many
    rows and the new columns; another number of rows is an error. A failing batch is tried again
    ``retries`` times; then the error ends the task, and Spark decides about running that again.
    ``is_empty`` says which scored rows hold no answer: those are asked again by themselves, ``retries``
    times at most. Those that stay empty have failed: ``failed`` names a column that says so (false without ``is_empty``).
    """
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = added.fieldNames()

    def attempt(part: pd.DataFrame) -> pd.DataFrame:
        for left in range(retries, -1, -1):
            try:
                scored = fn(part.copy())  # a model may write into what it gets
                if len(scored) != len(part):
                    raise ValueError(f"{len(part)} rows were scored as {len(scored)}")
                return scored.reset_index(drop=True)
            except Exception:
                if not left:
                    raise
        raise AssertionError("unreachable")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                part = frame.iloc[start : start + batch_size].reset_index(drop=True)
                scored = attempt(part)
                for _ in range(retries if is_empty is not None else 0):
                    empty = is_empty(scored).to_numpy(dtype=bool)
                    if not empty.any():
                        break
                    again = attempt(part[empty].reset_index(drop=True))
                    scored = scored.astype(object)
                    scored.loc[empty, names] = again[names].to_numpy(dtype=object)
                out = pd.concat([part, scored[names]], axis=1)
                if failed:
                    out[failed] = is_empty(scored).to_numpy(dtype=bool) if is_empty is not None else False
                yield out

    mark = [T.StructField(failed, T.BooleanType())] if failed else []
    return df.mapInPandas(run, T.StructType([*df.schema.fields, *added.fields, *mark]))
