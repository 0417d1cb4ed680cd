"""A line's position followed from night to night as a stream: each key's position is the state between batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def tracked(stream: DataFrame, key: str, step: str, value: str, start: str, tolerance: float) -> DataFrame:
    """key, step, position and met for each step of a key; the steps of a key come in order over the batches.

    A position goes to the nearest value of a step, the smaller of two equally near, if that is within the tolerance.
    The first one is the column start of the key's first row.  The state of a key is one number, and only the rows of
    one batch are held.
    """
    schema = T.StructType([stream.schema[key], stream.schema[step], T.StructField("position", T.DoubleType()), T.StructField("met", T.BooleanType())])

    def follow(which: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).dropna(subset=[step, value]).sort_values([step, value], kind="stable")
        position = state.get[0] if state.exists else None
        out = []
        for s, values in rows.groupby(step, sort=True):
            if position is None:
                position = float(values[start].iloc[0])
            nearest = values[value].iloc[(values[value] - position).abs().to_numpy().argmin()]
            met = bool(abs(nearest - position) <= tolerance)
            position = float(nearest) if met else position
            out.append((which[0], s, position, met))
        if position is not None:
            state.update((position,))
        yield pd.DataFrame(out, columns=[key, step, "position", "met"])

    return stream.groupBy(key).applyInPandasWithState(follow, schema, "position double", "append", GroupStateTimeout.NoTimeout)
