"""Aggregates of one's own with a mergeable state, which Spark's grouped Python functions lack.

States are made per partition while rows pass, merged in two steps (spread, then by key) and finished. A group is never
held in one task: what is shuffled is a state per key and task, and a hot key's states are first merged in FANOUT parts.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FANOUT, KEYS_AT_ONCE = 64, 50_000


class Aggregate(ABC):
    """How to aggregate columns: a state is a vector of doubles of fixed length."""

    #: The columns of the result, as a schema.
    result: str

    @abstractmethod
    def zero(self) -> np.ndarray:
        """The state of no rows."""

    @abstractmethod
    def update(self, state: np.ndarray, *columns: np.ndarray) -> np.ndarray:
        """The state with some rows more, whose columns are given as arrays."""

    @abstractmethod
    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The state of the rows of both."""

    @abstractmethod
    def finish(self, state: np.ndarray) -> tuple:
        """The result's values."""


class Moments(Aggregate):
    """Rows, mean, sample variance and skewness of a column without nulls, from central moments that merge exactly."""

    result = "n long, mean double, variance double, skewness double"

    def zero(self) -> np.ndarray:
        return np.zeros(4)

    def update(self, state: np.ndarray, *columns: np.ndarray) -> np.ndarray:
        x = columns[0][~np.isnan(columns[0])]
        if not len(x):
            return state
        d = x - x.mean()
        return self.merge(state, np.array([len(x), x.mean(), (d**2).sum(), (d**3).sum()]))

    def merge(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if not a[0] or not b[0]:
            return a if a[0] else b
        (na, ma, a2, a3), (nb, mb, b2, b3) = a, b
        n, d = na + nb, mb - ma
        third = a3 + b3 + d**3 * na * nb * (na - nb) / n**2 + 3 * d * (na * b2 - nb * a2) / n
        return np.array([n, ma + d * nb / n, a2 + b2 + d**2 * na * nb / n, third])

    def finish(self, state: np.ndarray) -> tuple:
        n, mean, second, third = state
        return int(n), mean if n else None, second / (n - 1) if n > 1 else None, third / n / (second / n) ** 1.5 if second > 0 else None


def aggregated(df: DataFrame, keys: list[str], columns: list[str], how: Aggregate) -> DataFrame:
    """keys and how's result columns: one row for each key (nulls are a key) of df; of no rows one for no keys, else none."""
    named = df.select(*(F.col(k) for k in keys), *(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)))
    kinds = "".join(f"`{k}` {named.schema[k].dataType.simpleString()}, " for k in keys)
    plain = {k: df.select(k).schema[k].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint") for k in keys}
    inputs = [f"_{i}" for i in range(len(columns))]

    def frame(states: dict[tuple, np.ndarray]) -> pd.DataFrame:
        data = {k: pd.array([key[i] for key in states], dtype="Int64") if plain[k] else pd.Series([key[i] for key in states], dtype=object) for i, k in enumerate(keys)}
        return pd.DataFrame(data | {"state": list(states.values())})

    def groups(batch: pd.DataFrame) -> Iterator[tuple[tuple, pd.DataFrame]]:
        if not keys:
            yield (), batch
            return
        for key, part in batch.groupby(keys, dropna=False, sort=False):
            yield tuple(None if pd.isna(x) else x for x in key), part

    def folded(add: Callable[[np.ndarray, pd.DataFrame], np.ndarray]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            states: dict[tuple, np.ndarray] = {}
            for batch in batches:
                for key, part in groups(batch):
                    states[key] = add(states.get(key, how.zero()), part)
                if len(states) > KEYS_AT_ONCE:  # states of one key may come more than once; the next step merges them
                    yield frame(states)
                    states = {}
            if states:
                yield frame(states)

        return run

    def joined(state: np.ndarray, part: pd.DataFrame) -> np.ndarray:
        for other in part.state:
            state = how.merge(state, np.asarray(other))
        return state

    schema = f"{kinds}state array<double>"
    states = named.mapInPandas(folded(lambda state, part: how.update(state, *(part[c].to_numpy(np.float64) for c in inputs))), schema)
    spread = states.withColumn("_spread", F.pmod(F.xxhash64("state"), F.lit(FANOUT)))
    states = spread.repartition(*keys, "_spread").select(*keys, "state").mapInPandas(folded(joined), schema)

    def finished(group: pd.DataFrame) -> pd.DataFrame:
        key, whole = next(groups(group)), joined(how.zero(), group)
        out = frame({key[0]: whole}).drop(columns="state")
        names = [x.split()[0] for x in how.result.split(",")]
        return pd.concat([out, pd.DataFrame([how.finish(whole)], columns=names)], axis=1)

    return states.groupBy(*keys).applyInPandas(finished, f"{kinds}{how.result}")
