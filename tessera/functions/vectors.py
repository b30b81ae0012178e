"""Vector helpers: per-dimension sums as aggregates, nearest cluster as an Arrow UDF."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# Keeps a dimension without spread from dividing by zero.
MIN_STD = 1e-9


def dimension(df: DataFrame, features: str = "features") -> int:
    row = df.select(F.size(features)).first()
    return 0 if row is None else int(row[0])


def moment_aggregates(features: str, dim: int) -> list[Column]:
    """Count, and per dimension the mean and the sum of squares about it (M2). Tasks combine their
    rows to (n, mean, M2), and these are merged pairwise, so points far from zero lose no digits."""
    x = [F.col(features)[j] for j in range(dim)]
    n = F.count(F.lit(1))
    return [
        n.alias("n"),
        F.array(*[F.avg(v) for v in x]).alias("mean"),
        F.array(*[F.var_pop(v) * n for v in x]).alias("m2"),
    ]


def mahalanobis(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    """Distance of every row of x from one cluster with per-dimension spread."""
    return np.sqrt((((x - mean) / std) ** 2).sum(axis=1))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    sizes = pc.list_value_length(column)
    if column.null_count or pc.any(pc.not_equal(sizes, dim)).as_py() or column.flatten().null_count:
        raise ValueError(f"every point needs {dim} features without nulls")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def nearest(features: Column, ids: np.ndarray, means: np.ndarray, stds: np.ndarray) -> Column:
    """struct(distance, cluster) of the closest cluster, the first listed on a tie.

    The cluster table travels with the task: it has a row per cluster, not per point.
    """
    stds = np.maximum(stds, MIN_STD)
    dim = means.shape[1]

    @F.arrow_udf("struct<distance: double, cluster: bigint>")
    def near(column: pa.Array) -> pa.Array:
        x = _matrix(column, dim)
        best = np.full(len(x), np.inf)
        which = np.full(len(x), -1, dtype=np.int64)
        for cid, mean, std in zip(ids, means, stds):
            dist = mahalanobis(x, mean, std)
            closer = dist < best
            best[closer] = dist[closer]
            which[closer] = cid
        return pa.StructArray.from_arrays(
            [pa.array(best), pa.array(which)], names=["distance", "cluster"]
        )

    return near(features)


def distance(mean: Column, std: Column, other: Column) -> Column:
    """From a cluster to another one's mean, by its own spread."""
    steps = F.transform(
        F.arrays_zip(mean.alias("m"), std.alias("s"), other.alias("o")),
        lambda z: F.pow((z["m"] - z["o"]) / F.greatest(z["s"], F.lit(MIN_STD)), 2),
    )
    return F.sqrt(F.aggregate(steps, F.lit(0.0), lambda a, x: a + x))
