"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprints that differ in at most ``tau`` bits are linked. The 64 bits are dealt into m parts, correlated bits
together, and part i gets a threshold t_i >= -1 with sum(t_i) = tau - m + 1: two fingerprints within tau then differ
by at most t_i bits in some part (t_i = -1: the part is left out), else their distance would be at least
sum(t_i + 1) = tau + 1. Unequal thresholds come from dynamic programming over estimated numbers of candidates.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from bedwatch.llm.common import components, per_text, stage, whole_text

BITS = 64
DENSE_ROWS = BITS + 1  # rows a fingerprint of a full bucket writes


def fingerprint_of(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of one text; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined, take = b" ".join(words), min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: len(words) - take + 1].tolist()
    stops = (ends - 1)[take - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), "<u8", len(starts))
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; fp is the fingerprint as a signed long."""

    def make():
        return lambda ids, texts: [np.fromiter(map(fingerprint_of, texts), np.uint64, len(texts)).view(np.int64)]

    return per_text(docs, make, [("fp", "long", pa.int64())], id_col, text_col)


def as_bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(np.int64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlated_parts(bits: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bit positions into m parts of almost equal width, each bit to the part it is most correlated with.

    Dependent bits in one part make that part uneven and leave the others close to random, which is where
    few candidates arise.
    """
    x = bits - bits.mean(0)
    spread = np.sqrt((x ** 2).sum(0))
    corr = np.abs(x.T @ x) / np.maximum(np.outer(spread, spread), 1e-12)
    left, parts = list(range(BITS)), []
    for k in range(m):
        width = -(-len(left) // (m - k))
        part = [left.pop(int(np.argmax([corr[i, left].sum() for i in left])))]
        while len(part) < width:
            part.append(left.pop(int(np.argmax(corr[np.ix_(left, part)].sum(1)))))
        parts.append(sorted(part))
    return parts


def thresholds(bits: np.ndarray, parts: list[list[int]], tau: int, n: int) -> tuple[list[int], float]:
    """Thresholds per part with the least estimated work for ``n`` fingerprints, and that work.

    The work of threshold t in a part is the rows it writes (index and probes) and the candidates it meets. Candidates
    are estimated per fingerprint of a sample, from its distances to the others, and count at most what the way for
    full buckets costs instead; dynamic programming over the parts allocates the total.
    """
    m, half = len(parts), len(bits) // 2
    cost = []
    for part in parts:
        one = bits[:, part].astype(np.int32)
        apart = (one[:half, None, :] != one[None, half:2 * half, :]).sum(2)
        spent = {-1: 0.0}
        for t in range(tau + 1):
            ways = sum(_choose(len(part), k) for k in range(t + 1))
            met = (apart <= t).sum(1) * (n / max(1, half)) + n * ways * 2.0 ** -len(part)
            spent[t] = n * ways + n * (float(np.minimum(met, DENSE_ROWS).mean()) if half else 0.0)
        cost.append(spent)
    goal = tau - m + 1
    best = {0: (0.0, [])}
    for k in range(m):
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (spent, chosen) in best.items():
            for t in range(-1, tau + 1):
                found = (spent + cost[k][t], [*chosen, t])
                if total + t not in following or found < following[total + t]:
                    following[total + t] = found
        best = following
    spent, chosen = best[goal]
    return chosen, spent


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _mask(positions) -> int:
    value = sum(1 << p for p in positions)
    return value - (1 << 64) if value >> 63 else value


def links(fps: DataFrame, tau: int = 2, sample: int = 2000, bucket: int = 256, most_parts: int = 5) -> DataFrame:
    """Edges (a, b) that connect exactly the fingerprints (column fp, distinct) that are linked within ``tau``.

    Every part writes one index row per fingerprint and one probe row per value within its threshold; rows of one
    value form a bucket. Buckets of up to ``bucket`` rows are verified pair by pair inside the JVM. In a larger
    bucket (a dense group of near copies) pairs are not listed: its members are linked through the values within
    one bit of them, two fingerprints being within 2 bits exactly if they share such a value; each such value
    ties its members to the smallest. That is linear in the members and loses no link; it needs ``tau`` <= 2.

    ``sample`` bounds the fingerprints looked at for the correlations and estimates; it moves cost, never results.
    """
    if tau > 2:
        raise ValueError("full buckets are linked through one-bit neighbours, which covers tau <= 2")
    n = fps.count()
    schema = "a long, b long"
    if n < 2:
        return fps.sparkSession.createDataFrame([], schema)
    seen = np.array([r["fp"] for r in fps.orderBy(F.xxhash64("fp", F.lit(7)), "fp").limit(sample).collect()], np.int64)
    bits = as_bits(seen)
    plans = []
    for m in range(1, most_parts + 1):
        parts = correlated_parts(bits, m)
        chosen, spent = thresholds(bits[:1000], parts, tau, n)
        plans.append((spent, m, parts, chosen))
    _, _, parts, chosen = min(plans, key=lambda p: p[:2])

    keys = []
    for k, (part, t) in enumerate(zip(parts, chosen)):
        if t < 0:
            continue
        own = F.col("fp").bitwiseAND(F.lit(_mask(part)))
        keys.append(F.struct(F.lit(k).alias("part"), own.alias("value"), F.lit(False).alias("probe")))
        keys += [F.struct(F.lit(k).alias("part"), own.bitwiseXOR(F.lit(_mask(flip))).alias("value"),
                          F.lit(True).alias("probe"))
                 for size in range(1, t + 1) for flip in combinations(part, size)]
    rows = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.*", "fp")
    sizes = rows.groupBy("part", "value").agg(
        F.count("*").alias("n"), F.bool_or(~F.col("probe")).alias("indexed"))
    rows = rows.join(sizes.filter("n > 1 and indexed"), ["part", "value"])
    small = rows.filter(F.col("n") <= bucket).groupBy("part", "value").agg(
        F.collect_set("fp").alias("fps"), F.collect_set(F.when(~F.col("probe"), F.col("fp"))).alias("held"))

    def near(x):
        return F.transform(F.filter("fps", lambda y: (y < x) & (F.bit_count(y.bitwiseXOR(x)) <= tau)
                                    | (y > x) & (F.bit_count(y.bitwiseXOR(x)) <= tau) & ~F.array_contains("held", y)),
                           lambda y: F.struct(x.alias("a"), y.alias("b")))

    verified = small.select(F.explode(F.flatten(F.transform("held", near))).alias("e")).select("e.a", "e.b")
    dense = rows.filter(F.col("n") > bucket).select("fp").distinct()
    around = dense.select("fp", F.explode(F.array(
        F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_mask([i]))) for i in range(BITS)])).alias("near"))
    if tau < 2:  # within one bit: the shared value has to be one of the two
        met = around.join(dense.select(F.col("fp").alias("near")), "near").filter("fp <> near")
        tied = met.select(F.col("fp").alias("a"), F.col("near").alias("b")) if tau == 1 else met.select(
            F.col("fp").alias("a"), F.col("near").alias("b")).limit(0)
    else:
        least = around.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("k")).filter("k > 1")
        tied = around.join(least.select("near", "b"), "near").filter("fp <> b").select(F.col("fp").alias("a"), "b")
    return verified.unionByName(tied).distinct()


def near_duplicates(docs: DataFrame, tau: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``tau`` bits. A null text is the empty one;
    texts without words have fingerprint zero and are linked like any other. A null doc_id is never the smallest
    unless its whole component has none (then null). Repeated rows come out repeated. Equal texts share a
    fingerprint and are linked through it, so that copies never form pairs.
    """
    rows = stage(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes.select("fp"), tau))
    grouped = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fp"))
    ids = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    named = grouped.join(ids, "component").select("fp", "component_id")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, tau: int = 2) -> DataFrame:
    """One row of ``docs`` (all its columns) per component: the smallest doc_id, of equal ones the smallest text hash.

    Of repeated rows (same doc_id and text) one stays. Rows without a doc_id stay only if a component holds no id.
    Texts are told apart by a 64-bit hash, and components are named by it, since ids may be missing or repeated.
    """
    own = docs.withColumn("__text", F.xxhash64(whole_text()))
    found = near_duplicates(own, tau, "__text").select(
        F.col("doc_id").alias("__text"), F.col("component_id").alias("__component")).distinct()
    least = own.groupBy("__text").agg(F.min(F.col("doc_id").cast("long")).alias("__id"))
    kept = found.join(least, "__text").groupBy("__component").agg(F.min(F.struct(
        F.col("__id").isNull().alias("none"), "__id", "__text")).alias("k")).select(
        F.col("k.__id").alias("__id"), F.col("k.__text").alias("__kept"))
    out = own.join(kept, (F.col("__text") == F.col("__kept"))
                   & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi")
    return out.dropDuplicates(["doc_id", "__text"]).drop("__text")
