"""Hard negatives by segment summary filtering.

A vector is cut into equal segments, of which the mean and the deviation are stored. The inner product of two segments
of d components lies within d * (product of the means +- product of the deviations), so the sums over the segments bound
the score of two vectors. One segment is tried first, then 2, 4 and so on: at every level the rows that cannot be among an
anchor's results leave, and only those left after the finest level are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from bedwatch.llm.common import discard, stage

#: anchors bounded together; the rows left are those that one of them may need
TOGETHER = 64
#: rows that the first results are taken from
FEW = 512
#: no score, and no limit: less than every score; its negative is more than every score
NONE = -np.iinfo(np.int64).max
#: whole numbers below this are exact in single precision
SINGLE = 2.0 ** 24
#: components are counted in 1/256 and rounded down
SCALE = 256
#: groups of blocks of rows that anchors meet, at least; clusters of many cores get more
GROUPS = 24
BLOCK = "block long, length int, n int, keys binary, labels binary, vectors binary"


def _levels(length: int) -> list[int]:
    """Numbers of segments, coarse to fine: 1, 2, 4 ... while a segment has four components or more."""
    out, n = [], 1
    while length and (n == 1 or length / n >= 4):
        out.append(n)
        n *= 2
    return out


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(d) * mean and sqrt(d) * deviation of each segment of d components, one row per vector."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    sizes = np.diff(edges)
    means = np.add.reduceat(vectors, edges[:-1], axis=1) / sizes
    apart = (vectors - np.repeat(means, sizes, axis=1)) ** 2
    return means * np.sqrt(sizes), np.sqrt(np.add.reduceat(apart, edges[:-1], axis=1))


class Rows(NamedTuple):
    keys: np.ndarray  # ascending ids
    labels: np.ndarray
    vectors: np.ndarray  # whole numbers as int64
    floats: np.ndarray  # the same, as float32 if that holds them exactly
    levels: list[tuple[np.ndarray, np.ndarray]]
    scale: float  # the longest vector, for the slack of bounds

    @classmethod
    def read(cls, length: int, keys: bytes, labels: bytes, vectors: bytes) -> "Rows":
        names = np.frombuffer(keys, np.int64)
        width = len(vectors) // max(1, len(names) * length)
        v = np.frombuffer(vectors, f"i{width or 8}").reshape(len(names), length).astype(np.int64)
        f = v.astype(np.float64)
        scale = float(np.sqrt((f ** 2).sum(1).max(initial=0.0)))
        kind = np.float32 if scale < SINGLE else np.float64
        return cls(names, np.frombuffer(labels, np.int64), v, f.astype(kind),
                   [tuple(x.astype(kind) for x in summaries(f, n)) for n in _levels(length)], scale)

    def part(self, rows: np.ndarray | slice) -> "Rows":
        return Rows(self.keys[rows], self.labels[rows], self.vectors[rows], self.floats[rows],
                    [(m[rows], d[rows]) for m, d in self.levels], self.scale)

    def exact(self, mine: np.ndarray | slice, other: "Rows", rows: np.ndarray | slice) -> np.ndarray:
        """Scores as whole numbers, of the smallest type that holds them."""
        most = self.scale * other.scale  # no partial sum is larger than the product of the lengths
        if most < 2.0 ** 52:
            kind = np.float32 if most < SINGLE else np.float64
            return self.floats[mine].astype(kind, copy=False) @ other.floats[rows].astype(kind, copy=False).T
        return self.vectors[mine] @ other.vectors[rows].T


def _left(anchors: Rows, mine: np.ndarray | slice, rows: Rows, able: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(rows that some anchor of ``mine`` may need, which anchor may need them, rows left after each level).

    ``able`` says which pairs may be results at all. ``needed(able, low, high)`` gets bounds of the scores and says which
    of the pairs are still open; it has to keep every pair whose true score could be a result.
    """
    at, left = np.arange(able.shape[1]), []

    def only(stays: np.ndarray):
        return (at, able) if stays.all() else (at[stays], able[:, stays])

    at, able = only(able.any(axis=0))
    for (own_means, own_deviations), (means, deviations) in zip(anchors.levels, rows.levels):
        if not len(at):
            break
        here = slice(None) if len(at) == len(means) else at
        middle = own_means[mine] @ means[here].T
        # what the sums of so many segments may be off by
        error = max(1e-9, 2 * max(np.finfo(x.dtype).eps for x in (own_means, means)) * (means.shape[1] + 8))
        reach = own_deviations[mine] @ deviations[here].T + middle.dtype.type(error * (anchors.scale * rows.scale + 1))
        able = able & needed(able, middle - reach, middle + reach)
        at, able = only(able.any(axis=0))
        left.append(len(at))
    return at, able, left


class Found:
    """The best rows so far of each anchor in each range of scores (``least`` to ``most``): higher scores first, ties by id.

    It takes rows in any order and any portions. What has been found says what later rows have to reach, so the more rows
    were seen, the fewer are looked at again. Its size is that of the results, whatever the number of rows.
    """

    def __init__(self, least: np.ndarray, most: np.ndarray, top: int):
        self.least, self.most = least, most  # (anchors, ranges)
        self.scores = np.full((*least.shape, top), NONE)
        self.keys = np.full((*least.shape, top), -NONE)

    def meet(self, anchors: Rows, mine: np.ndarray, rows: Rows, able: np.ndarray) -> None:
        """The rows for the anchors ``mine``, where ``able`` holds."""
        lowest = np.maximum(self.least[mine], self.scores[mine, :, -1]).min(axis=1, keepdims=True)
        highest = self.most[mine].max(axis=1, keepdims=True)
        bounds: dict = {}

        def among(kind) -> tuple[np.ndarray, np.ndarray]:
            # scores that a kind of float holds exactly are on the same side of a rounded limit
            if kind not in bounds:
                bounds[kind] = lowest.astype(kind), highest.astype(kind)
            return bounds[kind]

        def needed(able, low, high):
            least, most = among(low.dtype)
            return (high >= least) & (low <= most)

        at, able, _ = _left(anchors, mine, rows, able, needed)
        scores = anchors.exact(mine, rows, slice(None) if len(at) == len(rows.keys) else at)
        least, most = among(scores.dtype)
        a, r = np.nonzero(able & (scores >= least) & (scores <= most))
        if len(a):
            self._add(mine[a], scores[a, r].astype(np.int64), rows.keys[at[r]])

    def _add(self, anchors: np.ndarray, scores: np.ndarray, keys: np.ndarray) -> None:
        s, k, last = scores[:, None], keys[:, None], self.scores[anchors, :, -1]
        better = (s > last) | ((s == last) & (k < self.keys[anchors, :, -1]))
        i, p = np.nonzero(better & (s >= self.least[anchors]) & (s <= self.most[anchors]))
        top = self.scores.shape[2]
        slots = anchors[i] * self.scores.shape[1] + p
        touched = np.unique(slots)
        all_scores, all_keys = self.scores.reshape(-1, top), self.keys.reshape(-1, top)
        slot = np.concatenate([np.repeat(touched, top), slots])
        score = np.concatenate([all_scores[touched].ravel(), scores[i]])
        key = np.concatenate([all_keys[touched].ravel(), keys[i]])
        order = np.lexsort((key, -score, slot))
        first = np.searchsorted(slot[order], touched)
        kept = order[first[:, None] + np.arange(top)]  # a slot has ``top`` places, filled or not
        all_scores[touched], all_keys[touched] = score[kept], key[kept]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, range, id, score)"""
        a, p, k = np.nonzero(self.scores != NONE)
        return a, p, self.keys[a, p, k], self.scores[a, p, k]


def _portions(n: int, size: int) -> Iterator[slice]:
    return (slice(begin, min(begin + size, n)) for begin in range(0, n, size))


def any_score(n: int, top: int) -> Found:
    """For ``n`` anchors, no result yet; every score will do."""
    return Found(np.full((n, 1), NONE), np.full((n, 1), -NONE), top)


def best(found: Found, anchors: Rows, rows: Rows) -> None:
    """Each anchor meets the rows of its own label but those with its own id."""
    order = np.argsort(rows.labels, kind="stable")
    ordered = rows.labels[order]
    for label in np.unique(anchors.labels):
        own = order[np.searchsorted(ordered, label, "left"):np.searchsorted(ordered, label, "right")]
        if not len(own):
            continue
        some, asking = rows.part(own), np.nonzero(anchors.labels == label)[0]
        for portion in _portions(len(asking), TOGETHER):
            mine = asking[portion]
            for few in _few_first(found, mine, some):
                found.meet(anchors, mine, few, anchors.keys[mine, None] != few.keys[None])


def wanted(scores: list[np.ndarray], share: tuple[int, int], top: int) -> Found:
    """Ranges by the scores of each anchor's positives: share[0] * positive <= 100 * score <= share[1] * positive."""
    places = max([1, *map(len, scores)])
    least, most = np.full((len(scores), places), -NONE), np.full((len(scores), places), NONE)
    for k, x in enumerate(scores):
        least[k, :len(x)], most[k, :len(x)] = -(-share[0] * x // 100), share[1] * x // 100  # rounded up, rounded down
    return Found(least, most, top)


def negatives(found: Found, anchors: Rows, rows: Rows) -> None:
    """Each anchor meets the rows of other labels."""
    for portion in _portions(len(anchors.keys), TOGETHER):
        mine = np.arange(portion.start, portion.stop)
        for few in _few_first(found, mine, rows):
            found.meet(anchors, mine, few, anchors.labels[mine, None] != few.labels[None])


def _few_first(found: Found, mine: np.ndarray, rows: Rows) -> list[Rows]:
    """The rows; where most results are still missing, some of them first, so that the others have something to reach."""
    if len(rows.keys) <= FEW or np.mean(found.scores[mine, :, -1] != NONE) > 0.5:
        return [rows]
    return [rows.part(slice(0, FEW)), rows.part(slice(FEW, None))]


def _blocks(rows: DataFrame, size: int, label: str) -> tuple[DataFrame, int]:
    """Rows dealt evenly into blocks of about ``size``; no key decides where a row goes. And the number of blocks."""
    n = max(1, -(-rows.count() // size))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def row(block: int, length: int) -> pa.RecordBatch:
            keys, labels, vectors = (np.concatenate(x) for x in zip(*held.pop((block, length))))
            order = np.argsort(keys, kind="stable")
            keys, labels, vectors = keys[order], labels[order], vectors[order]
            width = next(w for w in ("i2", "i4", "i8") if w == "i8" or np.abs(vectors).max(initial=0) <= np.iinfo(w).max)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([length], pa.int32()), pa.array([len(keys)], pa.int32()),
                 *[pa.array([x.tobytes()], pa.binary()) for x in (keys, labels, vectors.astype(width))]],
                names=["block", "length", "n", "keys", "labels", "vectors"])

        for batch in batches:
            at = batch.column(0).to_numpy()
            keys, labels = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            starts, values = batch.column(3).offsets.to_numpy(), batch.column(3).values.to_numpy(zero_copy_only=False)
            lengths = np.diff(starts)
            for block, length in sorted(set(zip(at.tolist(), lengths.tolist()))):
                own = np.nonzero((at == block) & (lengths == length))[0]
                vectors = np.floor(values[starts[own][:, None] + np.arange(length)] * SCALE).astype(np.int64)
                held.setdefault((block, length), []).append((keys[own], labels[own], vectors))
            for block, length in [k for k in held if k[0] < at[-1]]:  # batches come by block
                yield row(block, length)
        for block, length in list(held):
            yield row(block, length)

    dealt = rows.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(n))).repartition("block").sortWithinPartitions("block")
    return stage(dealt.select("block", "key", "label", "v").mapInArrow(pack, BLOCK), label), n


def mine_negatives(vectors: DataFrame, anchors: Column | None = None, positives: int = 5, top: int = 10,
                   share: tuple[int, int] = (30, 90), rows_per_block: int = 4096, anchors_per_block: int = 1024,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    The score of two rows is the inner product of their components, each as floor(256 * x). Anchors are the rows where
    ``anchors`` holds (by default: id divisible by 100). An anchor's positives are its ``positives`` best other rows of its
    label; for each, the ``top`` best rows of other labels whose score is share[0] to share[1] per cent of the positive's
    are returned by rank. Higher scores come first, ties by smaller id; fewer rows if there are fewer.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part. An empty or zero vector
    scores 0. Rows of another vector length than the anchor's do not meet it. Rows are rows: repeated ones are candidates
    each, a repeated anchor is mined as often as it occurs, and a positive that occurs twice is listed twice; a row
    with the anchor's own id is never its positive. Labels are whole numbers; scores have to fit a long.

    All rows and all anchors are dealt into blocks whatever their labels; every block of anchors meets every block of rows.
    Blocks of rows form groups, and a group gives at most ``positives`` (then ``positives`` * ``top``) rows per anchor. A
    task holds one block of anchors with its results and one block of rows; nothing is broadcast.
    """
    spark = vectors.sparkSession
    fits = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    chosen = F.col(id_col) % 100 == 0 if anchors is None else anchors
    rows = vectors.select(F.col(id_col).cast("long").alias("key"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(chosen, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("key").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
                       & F.coalesce(fits, F.lit(False)))
    row_blocks, n_blocks = _blocks(rows, rows_per_block, "row-blocks")
    anchor_blocks, _ = _blocks(rows.filter("anchor"), anchors_per_block, "anchor-blocks")

    # a task meets all anchors with the blocks of its groups
    groups = min(n_blocks, max(GROUPS, 3 * spark.sparkContext.defaultParallelism))

    def met(asked: DataFrame) -> DataFrame:
        """Every block of anchors beside every block of rows of its length: anchors travel to each group of blocks, rows are
        shuffled once. Merged and never broadcast, since all anchors together may be large; the blocks of a group follow one
        another for each block of anchors.
        """
        mine = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "length",
                            *[F.col(c).alias(f"own_{c}") for c in asked.columns if c != "length"])
        theirs = row_blocks.select(F.pmod("block", F.lit(groups)).cast("int").alias("group"), "length", "keys", "labels", "vectors")
        # by number, as few bytes are much work: several parts a group, so that few parts get two groups
        dealt = [x.repartition(4 * groups, "group", "length") for x in (mine, theirs)]
        return dealt[0].join(dealt[1].hint("merge"), ["group", "length"])

    def each(begin, meet, names: list[str]):
        """A function over Arrow batches that meets every pair of blocks, and gives columns for each run of one block of anchors.

        begin(row) -> (anchors, results so far, columns of the results); what a block of anchors has found in a block of rows
        says what the next one has to reach, so the results of a run are no more than those of one block.
        """
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = anchors = found = columns = None

            def ended() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns()], names=names)

            for batch in batches:
                for k in range(batch.num_rows):
                    value = lambda c: batch.column(c)[k].as_py()
                    one = value("own_block"), value("length")
                    if one != held:
                        if held is not None:
                            yield ended()
                        held = one
                        anchors, found, columns = begin({c: value(c) for c in batch.schema.names if c not in ("keys", "labels", "vectors")})
                    meet(found, anchors, Rows.read(value("length"), value("keys"), value("labels"), value("vectors")))
            if held is not None:
                yield ended()
        return work

    def begin_positives(row: dict):
        mine = Rows.read(row["length"], row["own_keys"], row["own_labels"], row["own_vectors"])
        found = any_score(len(mine.keys), positives)

        def columns():
            a, _, key, score = found.results()
            return np.full(len(a), row["own_block"]), np.full(len(a), row["length"]), a, key, score

        return mine, found, columns

    names = ["own_block", "length", "at", "positive_id", "positive_score"]
    near = met(anchor_blocks).mapInArrow(each(begin_positives, best, names), ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("own_block", "length", "at").orderBy(F.desc("positive_score"), "positive_id")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    # the positives of a block of anchors: at most ``positives`` per anchor
    per_block = near.groupBy("own_block", "length").agg(F.array_sort(F.collect_list(F.struct(
        "at", "place", "positive_id", "positive_score"))).alias("positives"))
    asked = stage(anchor_blocks.join(per_block.select(
        F.col("own_block").alias("block"), F.col("length").cast("int").alias("length"), "positives").hint("merge"), ["block", "length"]),
        "anchors-with-positives")

    def begin_negatives(row: dict):
        mine = Rows.read(row["length"], row["own_keys"], row["own_labels"], row["own_vectors"])
        listed: list[list] = [[] for _ in mine.keys]
        for p in row["own_positives"]:
            listed[p["at"]].append((p["positive_id"], p["positive_score"]))
        found = wanted([np.array([s for _, s in x], np.int64) for x in listed], share, top)

        def columns():
            a, p, key, score = found.results()
            pairs = [listed[i][k] for i, k in zip(a.tolist(), p.tolist())]
            return (np.full(len(a), row["own_block"]), np.full(len(a), row["length"]), a, p, mine.keys[a],
                    np.array([x for x, _ in pairs], np.int64), key, np.array([x for _, x in pairs], np.int64), score)

        return mine, found, columns

    discard(anchor_blocks)

    names = ["own_block", "length", "at", "place", "anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    hard = met(asked).mapInArrow(each(begin_negatives, negatives, names), ", ".join(f"{c} long" for c in names))
    order = Window.partitionBy("own_block", "length", "at", "place").orderBy(F.desc("negative_score"), "negative_id")
    return hard.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= top).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: DuckDB SQL for ``mine_negatives`` over the table ``embeddings``, its labels turned where vec_id is divisible by 7
ORACLE = """
WITH r AS (
    SELECT vec_id::BIGINT AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id, r.label, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM r a JOIN r ON len(a.v) = len(r.v) AND a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s
    WHERE label = anchor_label AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
