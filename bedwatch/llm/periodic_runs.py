"""Periodic runs of words by longest common extensions in suffix trees.

A run is a maximal stretch of words with a smallest period q that is at least twice as long as q. Each run
holds a Lyndon word of length q that is the longest one at its place, for one of the two orders of the alphabet; so at most
two roots per word have to be tried. Longest Lyndon words follow from the order of the suffixes, and a root is extended
to both sides by longest common extensions: those of the text to the right, those of its reversal to the left. Both are
depths of lowest common ancestors in Ukkonen's suffix trees, taken as range minima over Euler tours.
"""

from __future__ import annotations

from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bedwatch.llm.common import per_text

#: end of a sequence; smaller than every word in both orders
END = -1


class SuffixTree:
    """Ukkonen's tree of a sequence of integers >= 0, with an end mark behind it.

    ``starts`` and ``ends`` are the sequence's positions on the edge to a node, ``kids`` the children by first symbol, None
    for leaves. Leaves are made in the order of the suffixes they stand for.
    """

    def __init__(self, sequence: list[int]):
        s = [*sequence, END]
        n = len(s)
        starts, ends, links, kids = [0], [0], [0], [{}]
        node = edge = length = waiting = 0  # active point, and suffixes not yet in the tree
        for i, symbol in enumerate(s):
            waiting += 1
            fresh = 0  # inner node made last, whose suffix link is still open
            while waiting:
                if not length:
                    edge = i
                around = kids[node]
                child = around.get(s[edge])
                if child is None:
                    around[s[edge]] = len(starts)
                    starts.append(i), ends.append(n), links.append(0), kids.append(None)
                    if fresh:
                        links[fresh] = node
                        fresh = 0
                else:
                    at = starts[child]
                    span = ends[child] - at
                    if length >= span and kids[child] is not None:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if s[at + length] == symbol:
                        length += 1
                        if fresh:
                            links[fresh] = node
                        break
                    split = len(starts)
                    starts.append(at), ends.append(at + length), links.append(0), kids.append({s[at + length]: child, symbol: split + 1})
                    around[s[edge]] = split
                    starts[child] = at + length
                    starts.append(i), ends.append(n), links.append(0), kids.append(None)
                    if fresh:
                        links[fresh] = split
                    fresh = split
                waiting -= 1
                if node:
                    node = links[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.n, self.starts, self.ends, self.kids = n, starts, ends, kids

    def tour(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Euler tour as depths in symbols, each suffix's place in it, and the suffixes in ascending order."""
        starts, ends, kids, n = self.starts, self.ends, self.kids, self.n
        depths, places, order = [], [0] * n, []
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if node >= 0:
                around = kids[node]
                if around is None:
                    suffix = starts[node] - depth  # a leaf's edge begins where the path above it ends
                    places[suffix] = len(depths)
                    order.append(suffix)
                    depths.append(n - suffix)
                    continue
                for symbol in sorted(around, reverse=True):
                    child = around[symbol]
                    stack.append((~node, depth))  # back at this node after the child
                    stack.append((child, depth if kids[child] is None else depth + ends[child] - starts[child]))
            depths.append(depth)
        return np.array(depths, np.int32), np.array(places, np.int64), np.array(order, np.int64)

    def descending(self) -> np.ndarray:
        """The suffixes in the order of the reversed alphabet; the end mark stays the smallest."""
        starts, ends, kids = self.starts, self.ends, self.kids
        order, stack = [], [(0, 0)]
        while stack:
            node, depth = stack.pop()
            around = kids[node]
            if around is None:
                order.append(starts[node] - depth)
                continue
            for symbol in sorted(around, key=lambda c: (c != END, -c), reverse=True):
                child = around[symbol]
                stack.append((child, depth if kids[child] is None else depth + ends[child] - starts[child]))
        return np.array(order, np.int64)


def range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(values[low:high + 1]) for all pairs: two entries of a sparse table each.

    The table's rows are made one after the other and only the present one is held: memory is linear.
    """
    out = np.zeros(len(low), values.dtype)
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    row, width = values, 1
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            row, width = np.minimum(row[:-width], row[width:]), 2 * width
        asked = np.nonzero(level == k)[0]
        out[asked] = np.minimum(row[low[asked]], row[high[asked] - width + 1])
    return out


def extensions(tour: np.ndarray, places: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b, a <> b: the depth of the leaves' common ancestor."""
    x, y = places[a], places[b]
    return range_minima(tour, np.minimum(x, y), np.maximum(x, y)).astype(np.int64)


def lyndon_ends(order: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word that begins at each position ends: at the next smaller suffix."""
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ranks, ends = rank.tolist(), [0] * len(order)
    for i in range(len(ranks) - 2, -1, -1):  # the last suffix is the end mark alone
        j, own = i + 1, ranks[i]
        while ranks[j] > own:
            j = ends[j]
        ends[i] = j
    return np.array(ends[:-1], np.int64)


def runs_of(sequence: list[int], least: int) -> np.ndarray:
    """(start, end, period) of every run of at least ``least`` symbols, by start, then period."""
    n = len(sequence)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree = SuffixTree(sequence)
    tour, places, ascending = tree.tour()
    orders = (ascending, tree.descending())
    del tree
    back_tour, back_places, _ = SuffixTree(sequence[::-1]).tour()
    found = []
    for order in orders:
        i, j = np.arange(n), lyndon_ends(order)
        right = extensions(tour, places, i, j)
        left = extensions(back_tour, back_places, n - i, n - j)
        period = j - i
        run = np.stack([i - left, j + right, period], axis=1)
        found.append(run[run[:, 1] - run[:, 0] >= np.maximum(least, 2 * period)])
    found = np.unique(np.concatenate(found), axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repetitive(words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Stretches outside which no run of ``least`` words has a word.

    The first length - q words of a run stand again q places on; these two stretches cover the run and have at least
    k = least / 2 words, rounded up, each. So every word of a run is within a k-gram that occurs twice in the text. Two
    k-grams with one hash only make a stretch longer than it needs to be.
    """
    n, k = len(words), max(1, (least + 1) // 2)
    if n < max(least, k + 1):
        return []
    grams = np.zeros(n - k + 1, np.uint64)
    for x in range(k):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + words[x:n - k + 1 + x]
        grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    same = np.nonzero(grams[order][1:] == grams[order][:-1])[0]
    if not len(same):
        return []
    step = np.zeros(n + 1, np.int32)
    again = np.union1d(order[same], order[same + 1])
    step[again] += 1
    step[again + k] -= 1
    inside = np.concatenate([[0], np.cumsum(step)[:-1] > 0, [0]]).astype(np.int8)
    edges = np.nonzero(np.diff(inside))[0].reshape(-1, 2)
    return [(a, b) for a, b in edges.tolist() if b - a >= least]


class Repetition(NamedTuple):
    runs: np.ndarray  # start, length, period
    kept: np.ndarray  # boolean per word


def find(words: list[bytes], least: int = 12) -> Repetition:
    """All runs of a sequence of words, and which words stay if of every run only the first period is kept."""
    known: dict[bytes, int] = {}
    codes = np.fromiter(map(known.setdefault, words, count()), np.uint64, len(words))
    parts = []
    for a, b in repetitive(codes, least):
        part = runs_of(codes[a:b].tolist(), least)
        parts.append(part + [a, a, 0])
    found = np.concatenate([np.zeros((0, 3), np.int64), *parts])
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, found[:, 0] + found[:, 2], 1)
    np.add.at(drop, found[:, 1], -1)
    runs = np.stack([found[:, 0], found[:, 1] - found[:, 0], found[:, 2]], axis=1)
    return Repetition(runs, np.cumsum(drop)[:-1] == 0)


def find_runs(docs: DataFrame, least: int = 12, change=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed), one row per row of ``docs``.

    Words are what ASCII white space separates in the whole text; a null or empty text has none. ``runs`` are all runs of at
    least ``least`` words as (start, length, period) by start, then period, none being an empty list. ``collapsed`` has the
    words that no run contains behind its first period, joined by blanks. ``change(doc_id, words)`` may give other words
    to look at. Ids pass through, null ones too; repeated rows give repeated rows; other columns are not looked at.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def make():
        def work(ids, texts):
            sizes, runs, collapsed = [], [], []
            for doc_id, text in zip(ids, texts):
                words = text.encode("utf-8").split()
                if change:
                    words = change(doc_id, words)
                found = find(words, least)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found.runs.tolist()])
                if len(found.runs):
                    words = [w for w, stays in zip(words, found.kept.tolist()) if stays]
                collapsed.append(b" ".join(words).decode("utf-8"))
            return [sizes, runs, collapsed]
        return work

    return per_text(docs, make, [
        ("n_words", "long", pa.int64()), ("runs", "array<struct<start: long, length: long, period: long>>", kind),
        ("collapsed", "string", pa.string())], id_col, text_col)


def digest(found: DataFrame) -> DataFrame:
    """Per document the longest run (ties: smallest start, then period), their number and the two digests."""
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"], r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        (-F.col("best.minus")).alias("length"), F.col("best.period").alias("period"),
        F.expr("(-1000 * best.minus) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
