"""Resharding by minimum-cost flow: the fewest bytes move, and only what moves is dealt anew.

The flow runs from old shards (their bytes) to new shards (their capacities); a byte that stays costs nothing, a byte
that moves costs one. Every positive flow between different shards becomes a transfer: whole blocks of rows while they
fit, then part of one more block, its largest rows first, so that the capacities are met to within about one short row.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from bedwatch.llm.common import whole_text
from bedwatch.session import new_folder


def min_cost_flow(supply: Sequence[int], demand: Sequence[int],
                  cost: Sequence[Sequence[float]] | None = None) -> list[list[int]]:
    """Cheapest flow from supplies to demands (equal totals) by successive shortest paths with potentials.

    ``cost[i][j]`` is the price of a byte from i to j; without it 0 where i = j and 1 elsewhere. Shards are few: the
    graph has their number of nodes, whatever the number of rows.
    """
    if sum(supply) != sum(demand):
        raise ValueError("supplies and demands differ in total")
    n, m = len(supply), len(demand)
    price = cost or [[float(i != j) for j in range(m)] for i in range(n)]
    source, sink = n + m, n + m + 1
    graph: list[list[list]] = [[] for _ in range(n + m + 2)]  # [to, room, price, index of the reverse edge]

    def edge(a, b, room, c):
        graph[a].append([b, room, c, len(graph[b])])
        graph[b].append([a, 0, -c, len(graph[a]) - 1])

    for i, s in enumerate(supply):
        edge(source, i, s, 0.0)
    for j, d in enumerate(demand):
        edge(n + j, sink, d, 0.0)
    for i in range(n):
        for j in range(m):
            edge(i, n + j, supply[i], price[i][j])
    potential, left = [0.0] * len(graph), sum(supply)
    while left:
        far = [float("inf")] * len(graph)
        far[source], came, queue = 0.0, {}, [(0.0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for k, (b, room, c, _) in enumerate(graph[a]):
                if room and d + c + potential[a] - potential[b] < far[b] - 1e-12:
                    far[b] = d + c + potential[a] - potential[b]
                    came[b] = (a, k)
                    heapq.heappush(queue, (far[b], b))
        potential = [p + (d if d < float("inf") else 0.0) for p, d in zip(potential, far)]
        path, at = [], sink
        while at != source:
            a, k = came[at]
            path.append(graph[a][k])
            at = a
        step = min(left, *(e[1] for e in path))
        for e in path:
            e[1] -= step
            graph[e[0]][e[3]][1] += step
        left -= step
    flow = [[0] * m for _ in range(n)]
    for i in range(n):
        for b, _, _, back in graph[i]:
            if n <= b < n + m:
                flow[i][b - n] = graph[b][back][1]
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


#: (old, block, target, cuts, cut_target): whole blocks go to target, rows inside a cut to cut_target
_RULES = "old int, block int, target int, cuts array<struct<lo:struct<s:long,i:long,c:long>,hi:struct<s:long,i:long,c:long>>>, cut_target int"
_CUT = "old int, block int, los long, loi long, loc long, his long, hii long, hic long"


def sized_rows(docs: DataFrame, old_shard: Column, blocks: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with __id, __size, __crc, __old and __block; all other columns stay."""
    text = whole_text(text_col)
    sized = docs.withColumns({
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))),
        "__size": (F.octet_length(text) + 1).cast("long"), "__crc": F.crc32(text.cast("binary")),
        "__old": F.coalesce(old_shard.cast("int"), F.lit(0))})
    return sized.withColumn("__block", F.pmod(F.xxhash64("__id", "__crc"), F.lit(blocks)).cast("int"))


def transfers(sized: DataFrame, capacities: Sequence[int] | int) -> DataFrame:
    """The rules by which every row finds its new shard; at most old shards x blocks of them.

    Reaching the driver: one total per old shard and block, and the ends of the cuts. The rows of a block that is
    cut (one per transfer at most) are ordered in a task of their own.
    """
    spark = sized.sparkSession
    sums = sized.groupBy("__old", "__block").agg(F.sum("__size").alias("size"), F.count("*").alias("n")).collect()
    olds = max([0, *(r["__old"] for r in sums)]) + 1
    held: list[list] = [[] for _ in range(olds)]
    for r in sums:
        held[r["__old"]].append((r["size"], r["n"], r["__block"]))
    supply = [sum(b[0] for b in blocks) for blocks in held]
    demand = equal_capacities(sum(supply), capacities) if isinstance(capacities, int) else list(capacities)
    flow = min_cost_flow(supply, demand)

    goes: dict[tuple[int, int], int] = {}
    cut: dict[tuple[int, int], tuple[int, int]] = {}  # block -> (bytes, new shard)
    for i, blocks in enumerate(held):
        stays = i < len(demand) and flow[i][i] > 0
        home = i if stays else max(range(len(demand)), key=lambda j: flow[i][j])
        waiting = sorted(blocks, key=lambda b: (-b[0], b[2]))
        for j, amount in enumerate(flow[i]):
            if j == home or not amount:
                continue
            later = []
            for size, n, block in waiting:
                if size <= amount:
                    goes[i, block] = j
                    amount -= size
                else:
                    later.append((size, n, block))
            waiting = later
            if amount and waiting:  # the block with most rows has the finest choice
                size, n, block = max(waiting, key=lambda b: (b[1], -b[2]))
                waiting.remove((size, n, block))
                cut[i, block] = (amount, j)
        for _, _, block in [*waiting, *((0, 0, b) for k, b in cut if k == i)]:
            goes[i, block] = home

    ends: dict[tuple[int, int], list] = {}
    if cut:
        wanted = spark.createDataFrame([(i, b, amount) for (i, b), (amount, _) in cut.items()],
                                       "old int, block int, amount long")

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            left, out, run = int(pdf["amount"].iloc[0]), [], None
            rows = pdf.groupby(["__size", "__id", "__crc"], as_index=False).size()
            rows = rows.sort_values(["__size", "__id", "__crc"], ascending=[False, True, True])
            for size, i, c, n in rows.itertuples(index=False, name=None):
                if size * n <= left:
                    left -= size * n
                    run = (run[0], (-size, i, c)) if run else ((-size, i, c), (-size, i, c))
                elif run:
                    out.append(run)
                    run = None
            out += [run] if run else []
            first = pdf.iloc[0]
            return pd.DataFrame([(first["old"], first["block"], *lo, *hi) for lo, hi in out],
                                columns=[c.split()[0] for c in _CUT.split(", ")])

        inside = sized.select("__old", "__block", "__size", "__id", "__crc").join(
            F.broadcast(wanted),  # a row per transfer
            (F.col("__old") == F.col("old")) & (F.col("__block") == F.col("block")))
        for r in inside.groupBy("old", "block").applyInPandas(choose, _CUT).collect():
            ends.setdefault((r["old"], r["block"]), []).append(
                ((r["los"], r["loi"], r["loc"]), (r["his"], r["hii"], r["hic"])))
    rows = [(i, b, j, ends.get((i, b), []), cut.get((i, b), (0, j))[1]) for (i, b), j in goes.items()]
    return spark.createDataFrame(rows, _RULES)


def assign(sized: DataFrame, rules: DataFrame) -> DataFrame:
    """``sized`` with its new __shard. The rules are a bounded table (shards x blocks), so no row is shuffled."""
    at = F.struct((-F.col("__size")).alias("s"), F.col("__id").alias("i"), F.col("__crc").alias("c"))
    moved = F.exists("cuts", lambda x: (at >= x["lo"]) & (at <= x["hi"]))
    joined = sized.join(F.broadcast(rules), (F.col("__old") == F.col("old")) & (F.col("__block") == F.col("block")))
    return joined.withColumn("__shard", F.when(moved, F.col("cut_target")).otherwise(F.col("target"))).drop(
        "old", "block", "target", "cuts", "cut_target")


def reshard(docs: DataFrame, old_shard: Column, shards: int | Sequence[int] = 8, blocks: int = 1024,
            id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
            unchanged_from: str | None = None) -> str:
    """Write the new shards as ``path``/shard=k and return ``path`` (one in the shared folder unless given).

    ``shards`` is a number of equal shards or their byte capacities. A row's bytes are those of its UTF-8 text plus one;
    a null text has none. Null old shards count as shard 0; repeated rows move together; a null doc_id is the
    smallest. If ``unchanged_from`` names the folder of the old shards (laid out alike), shards that neither gain
    nor lose a row are not written again; ``read_shards`` takes them from there.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "shards")
    sized = sized_rows(docs, old_shard, blocks, id_col, text_col)
    dealt = assign(sized, transfers(sized, shards))
    if unchanged_from:
        moved = dealt.filter("__old <> __shard").select("__old", "__shard").distinct().collect()
        affected = {x for r in moved for x in r}  # at most one row per transfer
        dealt = dealt.filter(F.col("__shard").isin(sorted(affected)) if affected else F.lit(False))
    kept = dealt.select(F.col("__shard").alias("shard"), F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"),
                        *[F.col(c) for c in docs.columns if c not in (id_col, text_col, "shard", "doc_id", "text")])
    kept.write.partitionBy("shard").parquet(path)
    return path


def read_shards(spark, path: str, blocks: int = 1024, schema: str = "doc_id long, text string, shard int") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) from shard files; slot counts a shard's rows from 0 without gaps.

    Rows are numbered inside blocks and the blocks' counts are added up, so no shard is ordered in one task.
    """
    text = whole_text()
    rows = spark.read.schema(schema).parquet(path).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.col("shard").cast("int").alias("shard"))
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("shard", "__block").agg(F.count("*").alias("n"))
    before = counts.select(F.col("shard").alias("__shard"), F.col("__block").alias("__b"), (F.sum("n").over(
        Window.partitionBy("shard").orderBy("__block")) - F.col("n")).alias("__before"))
    joined = rows.join(F.broadcast(before), (F.col("shard") == F.col("__shard")) & (F.col("__block") == F.col("__b")))
    number = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("doc_id", "text_crc32"))
    return joined.select("doc_id", "size", "text_crc32", "shard", (F.col("__before") + number - 1).alias("slot"))
