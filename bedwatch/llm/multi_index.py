"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors have a codebook of k centroids of their own; a row belongs to the cell of its two nearest
centroids, k x k cells in all. A query orders the cells by the sum of its two squared centroid distances, taking them
from a heap until the cells taken hold enough rows, and ranks the rows of those cells by their exact distance.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from bedwatch.llm.common import stage
from bedwatch.llm.epsilon_join import usable


class Codebooks(NamedTuple):
    halves: tuple[np.ndarray, np.ndarray]

    @property
    def k(self) -> int:
        return max(1, len(self.halves[0]))

    def squared(self, vectors: np.ndarray) -> list[np.ndarray]:
        cut = self.halves[0].shape[1]
        return [((x[:, None, :] - c[None, :, :]) ** 2).sum(2)
                for x, c in zip((vectors[:, :cut], vectors[:, cut:]), self.halves)]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        first, second = (d.argmin(1) for d in self.squared(vectors))
        return first * self.k + second


def kmeans(x: np.ndarray, k: int, rounds: int = 15, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = ((x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)[None]).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def traverse(first: np.ndarray, second: np.ndarray, counts: np.ndarray, need: int) -> list[int]:
    """Cells by ascending first[i] + second[j] until they hold ``need`` rows: the multi-sequence algorithm.

    A pair enters the heap once both its predecessors in the two sorted lists have left it.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    k, heap, gone, out, held = len(second), [(first[a[0]] + second[b[0]], 0, 0)], set(), [], 0
    while heap and held < need:
        _, i, j = heapq.heappop(heap)
        gone.add((i, j))
        cell = int(a[i]) * k + int(b[j])
        if counts[cell]:
            out.append(cell)
            held += int(counts[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p == 0 or (p - 1, q) in gone) and (q == 0 or (p, q - 1) in gone):
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))
    return out


def nearest(vectors: DataFrame, queries: DataFrame | None = None, top: int = 10, every: int = 100, k: int = 16,
            share: float = 0.75, sample: int = 20_000, chunk: int = 4096, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``top`` nearest rows found, score the Euclidean distance.

    Queries are the rows of ``queries``, or those of ``vectors`` whose id is divisible by ``every``; a row with the
    query's own id is no candidate. Ties go to the smaller id. Vectors that are null, empty or zero, or hold null or
    non-finite components, have a null id, or another length than most, take no part; repeated rows are candidates each. A
    query row that is repeated is asked once; different vectors under one id are queries of their own, each with its ranks.

    The codebooks are fitted on at most ``sample`` vectors; every row is indexed. A query looks at cells holding at least
    ``share`` of all rows, and never at fewer than ``top`` + 1. (Test vectors are close to isotropic, where no cell order
    saves much; on clustered data a small share does.) Rows of a cell and the queries that look at it are dealt
    into chunks of ``chunk`` rows, so a cell that holds a third of all rows is split.
    """
    def typed(df):
        return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
                         ).filter(F.col("vec_id").isNotNull() & usable("v"))

    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = typed(vectors)
    usual = rows.groupBy(F.size("v").alias("length")).count().orderBy(F.desc("count"), "length").first()
    if usual is None:
        return spark.createDataFrame([], out)
    length = usual["length"]
    rows = rows.filter(F.size("v") == length)
    asked = typed(queries).filter(F.size("v") == length) if queries is not None else rows.filter(F.col("vec_id") % every == 0)
    asked = asked.distinct().withColumn("query_key", F.xxhash64("vec_id", "v"))

    fitted = np.array([r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()], float)
    cut = (length + 1) // 2
    books = Codebooks((kmeans(fitted[:, :cut], k), kmeans(fitted[:, cut:], k)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=books.cells(np.stack(batch["v"].to_numpy())).astype(np.int32))

    index = stage(rows.mapInPandas(place, "vec_id long, v array<double>, cell int"), "multi-index")
    counts = np.zeros(books.k ** 2, np.int64)
    for r in index.groupBy("cell").count().collect():  # k x k cells at most
        counts[r["cell"]] = r["count"]
    chunks = np.maximum(1, -(-counts // chunk)).astype(np.int32)
    need = max(top + 1, int(np.ceil(share * counts.sum())))
    query_chunks = max(1, -(-asked.count() // chunk))

    def spread(ids: np.ndarray) -> np.ndarray:
        return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(query_chunks)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                some = batch.iloc[at:at + 64]
                first, second = books.squared(np.stack(some["v"].to_numpy()))
                lists = [traverse(f, s, counts, need) for f, s in zip(first, second)]
                sizes = [int(chunks[c].sum()) for c in lists]
                cells = np.concatenate([np.repeat(c, chunks[c]) for c in lists]).astype(np.int32)
                parts = np.concatenate([np.arange(n) for c in lists for n in chunks[c]]).astype(np.int32)
                yield pd.DataFrame({"cell": cells, "part": parts, "ask": np.repeat(
                    spread(some["vec_id"].to_numpy()), sizes).astype(np.int32),
                    "query_id": np.repeat(some["vec_id"].to_numpy(), sizes),
                    "query_key": np.repeat(some["query_key"].to_numpy(), sizes),
                    "q": [v for v, n in zip(some["v"], sizes) for _ in range(n)]})

    looked = asked.select("vec_id", "query_key", "v").mapInPandas(
        look, "cell int, part int, ask int, query_id long, query_key long, q array<double>")
    per_cell = F.element_at(F.array(*[F.lit(int(c)) for c in chunks]), F.col("cell") + 1)
    held = index.withColumn("part", F.pmod(F.xxhash64("vec_id"), per_cell).cast("int"))
    held = held.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(query_chunks - 1))))

    def rank(queries_: pd.DataFrame, rows_: pd.DataFrame) -> pd.DataFrame:
        if not len(queries_) or not len(rows_):
            return pd.DataFrame({"query_id": [], "query_key": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "query_key": "int64", "vec_id": "int64", "score": "float64"})
        q, x = np.stack(queries_["q"].to_numpy()), np.stack(rows_["v"].to_numpy())
        ids, norms = rows_["vec_id"].to_numpy(), (x ** 2).sum(1)
        found = []
        for at in range(0, len(q), 256):
            part, names = q[at:at + 256], queries_["query_id"].to_numpy()[at:at + 256]
            keys = queries_["query_key"].to_numpy()[at:at + 256]
            own = (part ** 2).sum(1)
            rough = own[:, None] + norms[None] - 2 * part @ x.T
            rough[names[:, None] == ids[None]] = np.inf
            last = np.partition(rough, min(top, len(ids)) - 1, axis=1)[:, min(top, len(ids)) - 1]
            for i, name in enumerate(names):
                slack = 1e-9 * (own[i] + norms.max() + 1)
                near = np.nonzero((rough[i] <= last[i] + slack) & (rough[i] < np.inf))[0]
                exact = np.sqrt(((x[near] - part[i]) ** 2).sum(1))
                best = np.lexsort((ids[near], exact))[:top]
                found.append(pd.DataFrame({"query_id": name, "query_key": keys[i], "vec_id": ids[near][best], "score": exact[best]}))
        return pd.concat(found, ignore_index=True)

    keys = ["cell", "part", "ask"]
    ranked = looked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(
        rank, "query_id long, query_key long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_key").orderBy("score", "vec_id")
    return ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
