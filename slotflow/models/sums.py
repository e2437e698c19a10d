"""Sums over training rows for many fits at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Measure = Callable[[np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray]]]


def problem_sums(rows: DataFrame, measure: Measure, conclude: Callable[[int, np.ndarray], np.ndarray] = lambda _, total: total) -> dict[int, np.ndarray]:
    """For each problem its arrays added up over all rows, and what ``conclude`` makes of the total.

    ``rows`` are [x, label, held]; ``measure`` takes a batch's columns and yields (problem, array). Each task adds up its own rows and
    sends an array per problem; those of a problem are added one after the other and concluded there, so the driver gets the
    conclusions alone.
    """

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if len(batch):
                x, held = np.stack(batch["x"].to_numpy()).astype(float), np.stack(batch["held"].to_numpy())
                for problem, array in measure(x, batch["label"].to_numpy(float), held):
                    sums[problem] = sums[problem] + array if problem in sums else array
        for problem, array in sums.items():
            yield pd.DataFrame({"problem": [problem], "cells": [array]})

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for problem, cells in zip(batch["problem"], batch["cells"]):
                sums[problem] = sums[problem] + cells if problem in sums else np.array(cells)
        for problem, cells in sums.items():
            yield pd.DataFrame({"problem": [problem], "cells": [conclude(int(problem), cells)]})

    schema = "problem int, cells array<double>"
    partial = rows.select("x", "label", "held").mapInPandas(add_up, schema)
    found = partial.repartition("problem").mapInPandas(meet, schema).collect()
    return {row.problem: np.array(row.cells) for row in found}
