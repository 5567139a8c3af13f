"""Rows that meet the shard they were sent to: each shard arrives once, whatever is asked of it streams past.

Candidates (``kind`` 0) and asking rows (``kind`` 1) carry the name of their ``part``.  A partition is sorted by part
and kind, so a task holds one shard at a time and a chunk of asking rows; neither depends on how many rows ask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def met(candidates: DataFrame, asking: DataFrame, prepare: Callable, answer: Callable, schema: str, chunk: int,
        order: str = "rid") -> DataFrame:
    """``answer(prepare(rows of the part), chunk of asking rows)`` for every part that is asked.

    Both frames need the columns ``part`` (string) and ``order``; columns that one lacks are null there.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held, state = None, [], None
        for batch in batches:
            if not len(batch):
                continue
            name, kind = batch["part"].to_numpy(), batch["kind"].to_numpy()
            cuts = np.flatnonzero((name[1:] != name[:-1]) | (kind[1:] != kind[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)]):
                if name[lo] != part:
                    part, held, state = name[lo], [], None
                rows = batch.iloc[lo:hi]
                if kind[lo] == 0:
                    held.append(rows)
                    continue
                if held:
                    state, held = prepare(pd.concat(held, ignore_index=True)), []
                if state is None:  # nothing to be found in this part
                    continue
                for at in range(0, len(rows), chunk):
                    out = answer(state, rows.iloc[at:at + chunk])
                    if len(out):
                        yield out

    both = candidates.selectExpr("*", "0 AS kind").unionByName(asking.selectExpr("*", "1 AS kind"), allowMissingColumns=True)
    return both.repartition("part").sortWithinPartitions("part", "kind", order).mapInPandas(run, schema)
