"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from bedwatch.llm import periodic_runs
from bedwatch.llm.periodic_runs import SuffixTree, extensions, find, find_runs, repetitive, runs_of
from bedwatch.llm.queries import QUERIES, repeat_tail


def brute_runs(w, least):
    """Every period tried at every place; equal words q apart, stretched as far as they go."""
    n, found = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(least, 2 * q) and not any(
                    all(w[x] == w[x + p] for x in range(start, end - p)) for p in range(1, q)):
                found.add((start, end - start, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng, most):
    kinds, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, most)
    w = [str(rng.randrange(kinds)).encode() for _ in range(n)]
    if n and rng.random() < 0.5:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 6)
        w = w[:a] + [w[a + k % p] for k in range(n - a)]
    return w


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(1500):
        w = some_words(rng, 60)
        want = brute_runs(w, least)
        got = find(w, least)
        assert [tuple(r) for r in got.runs.tolist()] == want, w
        assert got.kept.tolist() == [not any(s + q <= i < s + n for s, n, q in want) for i in range(len(w))]


def test_narrowing_to_repetitive_stretches_loses_nothing():
    """The stretches are a shortcut only: trees of the whole sequence give the same runs."""
    rng = random.Random(9)
    for _ in range(400):
        w = [int(x) for x in some_words(rng, 120)]
        whole = [(s, e - s, q) for s, e, q in runs_of(w, 12).tolist()]
        assert [tuple(r) for r in find([str(x).encode() for x in w], 12).runs.tolist()] == whole
        for s, n, _ in whole:
            assert any(a <= s and s + n <= b for a, b in repetitive(np.array(w, np.uint64), 12))


def test_longest_common_extensions():
    rng = random.Random(4)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randint(2, 50))]
        tree = SuffixTree(s)
        tour, places, order = tree.tour()
        key = lambda i: s[i:]
        assert order.tolist() == [len(s), *sorted(range(len(s)), key=key)]
        assert tree.descending().tolist() == [len(s), *sorted(range(len(s)), key=lambda i: [-x for x in s[i:]])]
        pairs = [(a, b) for a in range(len(s)) for b in range(len(s) + 1) if a != b]
        a, b = np.array(pairs).T
        got = extensions(tour, places, a, b)
        for (x, y), n in zip(pairs, got.tolist()):
            want = 0
            while x + want < len(s) and y + want < len(s) and s[x + want] == s[y + want]:
                want += 1
            assert n == want


def test_query_equals_brute_force_on_all_documents(spark, sf, documents):
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert len(got) == len(documents)
    changed = with_runs = 0
    for doc_id, text, _ in documents:
        plain = (text or "").encode().split()
        hashed, n = zlib.crc32(str(doc_id).encode()), len(plain)
        w = list(plain)
        if hashed % 10 == 0 and n:
            a = (hashed // 10) % n
            p = 1 + (n - a) // (3 + (hashed // 10) % 8)
            w = [plain[i] if i < a else plain[a + (i - a) % p] for i in range(n)]
            changed += 1
        r = got[doc_id]
        want = quick_runs(w) if n > 300 else brute_runs(w, 12)
        with_runs += bool(want)
        assert r["n_runs"] == len(want)
        if want:
            s, length, q = min(want, key=lambda x: (-x[1], x[0], x[2]))
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (s, length, q, 1000 * length // q)
        else:
            assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == (None,) * 4
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in want)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + length for s, length, q in want)]
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(kept)).hexdigest()
    assert changed > 50 and with_runs >= changed * 0.8


def quick_runs(w):
    """Brute force over periods with numpy comparisons, for longer texts."""
    codes = {}
    x = np.array([codes.setdefault(t, len(codes)) for t in w])
    found = []
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], (x[q:] == x[:-q]).astype(np.int8), [0]])
        begins, ends = np.nonzero(np.diff(same) == 1)[0], np.nonzero(np.diff(same) == -1)[0]
        for s, e in zip(begins.tolist(), (ends + q).tolist()):
            if e - s >= max(12, 2 * q) and not any((x[s + p:e] == x[s:e - p]).all() for p in range(1, q)):
                found.append((s, e - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_one_very_long_text():
    """Two hundred thousand words of one period, and as many of one word: linear, no recursion."""
    w = [str(k % 5000).encode() for k in range(200_000)]
    got = find(w)
    assert got.runs.tolist() == [[0, 200_000, 5000]] and got.kept.sum() == 5000
    got = find([b"x"] * 200_000)
    assert got.runs.tolist() == [[0, 200_000, 1]] and got.kept.sum() == 1


def test_odd_rows(spark, odd_docs, no_docs):
    rows = find_runs(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for k in (2, 3, 5):
        assert (by_id[k]["n_words"], by_id[k]["runs"], by_id[k]["collapsed"]) == (0, [], "")
    assert [tuple(r) for r in by_id[4]["runs"]] == [(0, 7 * 4000, 7)]
    assert by_id[4]["collapsed"] == "the quick brown fox token = abcdefghijkl0123"
    assert by_id[1]["collapsed"] == by_id[None]["collapsed"] == "Hello World again"
    got = {r["doc_id"]: r for r in periodic_runs.digest(find_runs(odd_docs, change=repeat_tail)).collect()}
    assert got[2]["n_runs"] == 0 and got[2]["start"] is None
    assert got[2]["runs_sha256"] == got[2]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert periodic_runs.digest(find_runs(no_docs)).count() == 0
