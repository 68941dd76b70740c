"""Embedding near-duplicates by an epsilon grid order join.

On unit vectors cosine >= c means a Euclidean distance <= eps = sqrt(2 - 2c). Vectors are rotated to their principal
axes and put into grid cells of side eps on the leading ones; the epsilon grid order sorts by cell, axis after axis. The
sequence is cut into intervals, and pairs of intervals are joined recursively, halves against halves, skipping
pairs whose bounding boxes are further apart than eps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from bedwatch.llm.common import components, stage

AXES = 8  # leading principal axes of the grid
LEAF = 256  # rows below which an interval is not halved further
SIDE = 1 / 256  # least side of a grid cell: for cosines near 1 cells may be wider than eps, never so many that listing them hurts
SLACK = 1e-6  # added to eps when skipping, against rounding of the rotation


def usable(vector: str) -> "F.Column":
    """Not null, no null or non-finite component, not all zero, and of a finite positive norm."""
    fits = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(fits, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def principal_axes(classes: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length: centre and leading axes, from at most ``sample`` vectors. They order rows, nothing else."""
    rows = classes.orderBy(F.xxhash64("rep"), "rep").select("v").limit(sample).collect()
    by_length: dict[int, list] = {}
    for r in rows:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for length, vectors in by_length.items():
        x = np.asarray(vectors, float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        centre = x.mean(0)
        _, _, axes = np.linalg.svd(x - centre, full_matrices=False)
        out[length] = (centre, axes[:AXES].T)
    return out


def _placed(classes: DataFrame, axes: dict, eps: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = []
            for v in batch["v"]:
                x = np.asarray(v, float)
                x = x / np.linalg.norm(x)
                centre, basis = axes.get(len(x), (np.zeros(len(x)), np.eye(len(x))[:, :AXES]))
                place = (x - centre) @ basis
                at.append(np.pad(place, (0, AXES - len(place))))
            place = np.array(at).reshape(-1, AXES)
            yield pd.DataFrame({"rep": batch["rep"], "n": batch["n"], "length": [len(v) for v in batch["v"]],
                                "v": batch["v"], "cell": list(np.floor(place / eps).astype(np.int64))})

    kind = "float" if "float" in classes.schema["v"].dataType.simpleString() else "double"
    return classes.mapInPandas(run, f"rep long, n long, length int, v array<{kind}>, cell array<long>")


def _intervals(placed: DataFrame, axes: dict, rows: int) -> DataFrame:
    """Blocks of up to ``rows`` consecutive vectors of the epsilon grid order, with their bounding boxes."""
    width = "f4" if "float" in placed.schema["v"].dataType.simpleString() else "f8"

    def packed(part: int, k: int, length: int, pdf: pd.DataFrame) -> dict:
        x = np.stack(pdf["v"].to_numpy()).astype(width)
        unit = x.astype(float)
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        centre, basis = axes.get(length, (np.zeros(length), np.eye(length)[:, :AXES]))
        place = (unit - centre) @ basis
        cells = np.stack(pdf["cell"].to_numpy())[:, 0]
        return {"block": (part << 32) + k, "length": length, "reps": pdf["rep"].to_numpy(np.int64).tobytes(),
                "counts": pdf["n"].to_numpy(np.int64).tobytes(), "vectors": x.tobytes(),
                "low": place.min(0).tolist(), "high": place.max(0).tolist(),
                "first": int(cells.min()), "last": int(cells.max())}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, k, held = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) and (len(held) > rows or held["length"].iloc[0] != held["length"].iloc[-1]):
                same = int((held["length"] == held["length"].iloc[0]).sum())
                take = min(rows, same)
                yield pd.DataFrame([packed(part, k, int(held["length"].iloc[0]), held.iloc[:take])])
                held, k = held.iloc[take:].reset_index(drop=True), k + 1
        if held is not None and len(held):
            yield pd.DataFrame([packed(part, k, int(held["length"].iloc[0]), held)])

    ordered = placed.repartitionByRange("length", "cell", "rep").sortWithinPartitions("length", "cell", "rep")
    return ordered.mapInPandas(run, "block long, length int, reps binary, counts binary, vectors binary, "
                                    "low array<double>, high array<double>, first long, last long")


def _apart(low_a, high_a, low_b, high_b) -> float:
    gap = np.maximum(0.0, np.maximum(low_a - high_b, low_b - high_a))
    return float(np.sqrt((gap ** 2).sum()))


def _joiner(least: float, eps: float, axes: dict, width: str):
    def forest(parent: dict, a: int, b: int) -> bool:
        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        a, b = root(a), root(b)
        if a == b:
            return False
        parent[max(a, b)] = min(a, b)
        return True

    def join_pair(row) -> pd.DataFrame:
        length = int(row.length)
        centre, basis = axes.get(length, (np.zeros(length), np.eye(length)[:, :AXES]))

        def side(vectors, reps, counts):
            x = np.frombuffer(vectors, width).reshape(-1, length).astype(float)
            norm = np.sqrt((x * x).sum(1))
            return x, norm, (x / norm[:, None] - centre) @ basis, np.frombuffer(reps, np.int64), np.frombuffer(counts, np.int64)

        left = side(row.vectors_l, row.reps_l, row.counts_l)
        own = row.block_l == row.block_r
        right = left if own else side(row.vectors_r, row.reps_r, row.counts_r)
        links_l, links_r = np.zeros(len(left[0]), np.int64), np.zeros(len(right[0]), np.int64)
        parent: dict[int, int] = {}
        edges: list[tuple[int, int]] = []

        def recurse(a0, a1, b0, b1):
            pa, pb = left[2][a0:a1], right[2][b0:b1]
            if _apart(pa.min(0), pa.max(0), pb.min(0), pb.max(0)) > eps + SLACK:
                return
            if a1 - a0 <= LEAF and b1 - b0 <= LEAF:
                cosine = (left[0][a0:a1] @ right[0][b0:b1].T) / np.outer(left[1][a0:a1], right[1][b0:b1])
                hit = cosine >= least
                if own and a0 == b0:
                    np.fill_diagonal(hit, False)
                i, j = np.nonzero(hit)
                if not len(i):
                    return
                np.add.at(links_l, i + a0, right[4][j + b0])
                if not (own and a0 == b0):
                    np.add.at(links_r, j + b0, left[4][i + a0])
                for x, y in zip(left[3][i + a0].tolist(), right[3][j + b0].tolist()):
                    if forest(parent, x, y):
                        edges.append((x, y))
                return
            halves_a = [(a0, a1)] if a1 - a0 <= LEAF else [(a0, (a0 + a1) // 2), ((a0 + a1) // 2, a1)]
            halves_b = [(b0, b1)] if b1 - b0 <= LEAF else [(b0, (b0 + b1) // 2), ((b0 + b1) // 2, b1)]
            for p in halves_a:
                for q in halves_b:
                    if not own or p[0] <= q[0]:
                        recurse(*p, *q)

        recurse(0, len(left[0]), 0, len(right[0]))
        if own:
            links_l, links_r = links_l + links_r, links_l[:0]
        both = np.concatenate([links_l, links_r])
        reps = np.concatenate([left[3], right[3][:len(links_r)]])
        some = both > 0
        counted = pd.DataFrame({"a": reps[some], "b": -1, "n": both[some]})
        tied = pd.DataFrame(edges, columns=["a", "b"], dtype="int64").assign(n=-1)
        return pd.concat([counted, tied], ignore_index=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield join_pair(row).astype("int64")

    return run


def near_vectors(vectors: DataFrame, least: float = 0.95, block_rows: int = 4096, sample: int = 4096,
                 id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Links pairs of rows with cosine >= ``least`` in double precision; vectors of different lengths are not linked.
    Vectors that are null, empty or zero, or hold null or non-finite components have no links and are their own
    component. Equal vectors are joined once: their class has a weight, and its smallest id stands for it, so copies
    are never expanded into pairs. Rows with a null id count in no link. Inside a dense group links are counted,
    and only a spanning forest of each pair of intervals leaves its task.
    """
    if not isinstance(vectors.schema[vector_col].dataType, ArrayType):
        raise TypeError(f"{vector_col} is not an array")
    kind = vectors.schema[vector_col].dataType.elementType
    cast = vector_col if kind.simpleString() in ("float", "double") else F.col(vector_col).cast(ArrayType(DoubleType()))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(cast).alias("v") if isinstance(cast, str) else cast.alias("v"))
    good = rows.filter(F.col("vec_id").isNotNull() & usable("v"))
    classes = stage(good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "vectors")
    eps = float(np.sqrt(max(0.0, 2 - 2 * least)))
    axes = principal_axes(classes, sample)
    width = "f4" if "float" in classes.schema["v"].dataType.simpleString() else "f8"
    blocks = stage(_intervals(_placed(classes, axes, max(eps, SIDE)), axes, block_rows), "intervals")

    # intervals that meet in the first axis: neighbours hold the same or the next cell; then their boxes are compared
    boxes = blocks.select("block", "length", "low", "high", "first", "last")
    a = boxes.select(F.col("block").alias("l"), "length", F.col("low").alias("low_l"), F.col("high").alias("high_l"),
                     F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell"))
    b = boxes.select(F.col("block").alias("r"), "length", F.col("low").alias("low_r"), F.col("high").alias("high_r"),
                     F.explode(F.sequence("first", "last")).alias("cell"))
    gap = F.aggregate(
        F.transform(F.arrays_zip("low_l", "high_l", "low_r", "high_r"), lambda z: F.pow(F.greatest(
            F.lit(0.0), z["low_l"] - z["high_r"], z["low_r"] - z["high_l"]), F.lit(2.0))),
        F.lit(0.0), lambda s, x: s + x)
    pairs = a.join(b, ["length", "cell"]).filter((F.col("l") <= F.col("r")) & (F.sqrt(gap) <= eps + SLACK))
    pairs = pairs.select("l", "r").distinct()

    def of(side):
        return blocks.select(F.col("block").alias(f"block_{side}"), *(["length"] if side == "l" else []),
                             *[F.col(c).alias(f"{c}_{side}") for c in ("vectors", "reps", "counts")])

    met = pairs.join(of("l"), F.col("l") == F.col("block_l")).join(of("r"), F.col("r") == F.col("block_r"))
    found = stage(met.mapInPandas(_joiner(least, eps, axes, width), "a long, b long, n long"), "vector-links")

    counts = found.filter("n >= 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("linked"))
    tied = components(found.filter("n = -1").select("a", "b"))
    summary = classes.join(counts, "rep", "left").join(tied.withColumnRenamed("node", "rep"), "rep", "left").select(
        F.col("v").alias("__v"), (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    fit = F.when(F.col("vec_id").isNotNull() & usable("v"), F.col("v"))
    joined = rows.select("vec_id", fit.alias("v")).join(summary, F.col("v") == F.col("__v"), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
