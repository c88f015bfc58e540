"""Sums over the points below and left of each of many places in the plane, without comparing all pairs.

Points and places are numbered by either coordinate, which cuts the plane into columns and rows of equally many of them,
whatever their ties. What lies in earlier columns and rows comes from running sums over the cells; what is left lies in
the place's own column, or in its own row and an earlier column, and each of these is one bounded group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import numbered

#: Columns and rows of the grid at most, so that the cells of one kind are a bounded matrix.
MOST_STRIPES = 1_000


def dominated(p: np.ndarray, q: np.ndarray, asks: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each row that asks, the sums of values (an array each) over the rows that don't and have a smaller p and q; of
    equal p, those are not smaller. q has no ties. By halves of halves in the order of p: each level takes running sums
    of the left halves' points, by q, to the right halves' places."""
    n = len(p)
    place = np.empty(n, dtype=np.int64)
    place[np.lexsort((~asks, p))] = np.arange(n)
    by_q = np.argsort(q)
    place, asking, held = place[by_q], asks[by_q], np.where(asks[by_q], 0.0, values[:, by_q])
    sums = np.zeros_like(held)
    for bit in range(max(n - 1, 0).bit_length()):
        half = place >> bit
        order = np.argsort(half >> 1, kind="stable")
        right = half[order] & 1 == 1
        so_far = np.cumsum(np.where(right, 0.0, held[:, order]), axis=1)
        node = half[order] >> 1
        first = np.searchsorted(node, node)  # where the node begins
        before = np.where(first > 0, so_far[:, first - 1], 0.0)
        take = right & asking[order]
        sums[:, order[take]] += (so_far - before)[:, take]
    out = np.empty_like(sums)
    out[:, by_q] = sums
    return out


def dominance_sums(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """keys and total: for every place, the sum of a + m * b over the points of its kind with a smaller p and q.

    rows: kind, asks (a place, else a point), p, p_turn, q, q_turn, a, b (of points), m (of places) and keys, which tell
    rows of a kind and side apart; of equal coordinates the lower turn comes first. A place's totals add up over kinds.
    Groups hold block rows, or the thousandth part of a kind if that is more.
    """
    at = numbered(rows, [F.col("kind"), F.col("p"), F.col("p_turn"), *map(F.col, keys)], "p_at")
    at = numbered(at, [F.col("kind"), F.col("q"), F.col("q_turn"), *map(F.col, keys)], "q_at")
    most = at.groupBy("kind").count().agg(F.max("count")).first()[0] or 0
    width = max(block, -(-most // MOST_STRIPES))
    at = at.withColumns({"col": F.floor(F.col("p_at") / width), "row": F.floor(F.col("q_at") / width)})
    types = dict(rows.dtypes)
    shape = ", ".join(f"{k} {types[k]}" for k in keys) + ", total double"

    def found(df: pd.DataFrame, p: str) -> pd.DataFrame:
        asks = df["asks"].to_numpy(bool)
        a, b = dominated(df[p].to_numpy(), df["q_at"].to_numpy(), asks, df[["a", "b"]].to_numpy(float).T)
        return df[keys].assign(total=a + df["m"].to_numpy() * b)[asks]

    def in_column(df: pd.DataFrame) -> pd.DataFrame:
        return found(df, "p_at")

    def in_row(df: pd.DataFrame) -> pd.DataFrame:
        return found(df, "col")

    def before_cell(df: pd.DataFrame) -> pd.DataFrame:
        c, r = (df[x].to_numpy() - df[x].min() for x in ("col", "row"))
        out = df[["kind", "col", "row"]].copy()
        for x in ("a", "b"):
            grid = np.zeros((c.max() + 2, r.max() + 2))
            grid[c + 1, r + 1] = df[x]
            out[f"{x}_before"] = grid.cumsum(axis=0).cumsum(axis=1)[c, r]
        return out

    slim = at.select("kind", "asks", "p_at", "q_at", "col", "row", "a", "b", "m", *keys)
    near = slim.groupBy("kind", "col").applyInPandas(in_column, shape).unionByName(slim.groupBy("kind", "row").applyInPandas(in_row, shape))
    cells = slim.groupBy("kind", "col", "row").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    cells = cells.groupBy("kind").applyInPandas(before_cell, "kind int, col long, row long, a_before double, b_before double")
    far = slim.where("asks").join(cells, ["kind", "col", "row"]).select(*keys, (F.col("a_before") + F.col("m") * F.col("b_before")).alias("total"))
    return near.unionByName(far).groupBy(*keys).agg(F.sum("total").alias("total"))
