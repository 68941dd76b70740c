"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The pieces and scores of a SentencePiece BPE model are applied by agenda: neighbouring symbols that form a piece are
candidates, the best scored one (leftmost of equals) is taken first. With dropout every candidate taken from the
agenda is skipped with a fixed probability, every occurrence of a word for itself: a keyed hash of seed, document and
place gives how many candidates are taken before the next one is skipped (geometric gaps, by integer arithmetic), never
a random generator: the same seed gives the same ids on any machine and in any order. What a word gives without a
skip, and with one or two at given candidates, is remembered; which of these an occurrence gets is always drawn.

Words are taken through their agendas many at a time: a row of arrays per word, its neighbouring pairs looked up in a hash
table, one candidate of every word a step. Chunks of more than SHORT symbols have a heap of their own.

Lossless by construction: no normalisation, a space is the marker, and what the vocabulary lacks (a marker that
stands in the text itself included) is written as UTF-8 bytes, for which the model has 256 pieces.
"""

from __future__ import annotations

import heapq
import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from bedwatch.llm.common import per_text

MARK = "▁"
#: leading spaces with the word behind them, no piece reaches over the start of a word
CHUNK = re.compile(r" *[^ ]+| +")
#: longest gap told apart; a chunk of SHORT symbols never takes so many candidates (63 merges, 2 new ones each, 63 first)
GAPS, SHORT = 192, 64
BLOCK = 1 << 14  # chunks encoded at once
ROWS = 2048  # words whose agendas are run at once
DRAWN = 5  # skips of an occurrence drawn beforehand; the few that may have more are run again
_NEVER = "\ud800"  # in no piece
_MASK, _STEP = (1 << 64) - 1, 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class Pairs:
    """The pairs of symbols that form a piece, each with its place in the agenda and the piece; looked up in arrays.

    Symbols are numbers: the pieces, then single characters that only pieces are made of, then one for everything else.
    """

    NONE = np.iinfo(np.int32).max  # no candidate; a candidate is its score's rank and, in six bits, its column

    def __init__(self, scores: dict[str, float]):
        pieces = list(scores)
        symbols = dict(zip(pieces, range(len(pieces))))
        for c in {c for p in pieces for c in p}:
            symbols.setdefault(c, len(symbols))
        self.pieces, self.other = len(pieces), len(symbols)
        self.symbol = np.full(0x110000, self.other, np.int32)  # by character
        for c, number in symbols.items():
            if len(c) == 1:
                self.symbol[ord(c)] = number
        self.symbol[ord(" ")], self.symbol[ord(MARK)] = self.symbol[ord(MARK)], self.other
        number, made = symbols.get, {}
        for p in pieces:
            for cut in range(1, len(p)):
                a, b = number(p[:cut]), number(p[cut:])
                if a is not None and b is not None:
                    made[a * (self.other + 1) + b] = symbols[p]
        self.keys = np.array([*sorted(made), -1], np.int64)  # the last stands for no pair
        self.merged = np.array([*(made[k] for k in self.keys[:-1].tolist()), 0], np.int32)
        rank = np.unique([scores[p] for p in pieces], return_inverse=True)[1].astype(np.int32)
        self.agenda = np.append(rank[self.merged[:-1]] << 6, self.NONE).astype(np.int32)
        at, none = self._slot(self.keys[:-1]), len(made)
        self.none = none
        self.at = np.full(1 << 20, none, np.int32)
        self.at[at] = np.arange(none)
        self.crowded = np.bincount(at, minlength=1 << 20) > 1

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(_STEP) >> np.uint64(44)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where the pairs stand in ``agenda`` and ``merged``; the last place if they form no piece."""
        key = left.astype(np.int64) * (self.other + 1) + right
        slot = self._slot(key)
        found = self.at[slot]
        wrong = self.keys[found] != key
        shared = np.nonzero(wrong & self.crowded[slot])[0]
        found[wrong] = self.none
        if len(shared):
            near = np.searchsorted(self.keys[:-1], key[shared])
            near[near == self.none] = 0
            good = self.keys[near] == key[shared]
            found[shared[good]] = near[good]
        return found


class Encoder:
    """Encode and decode with one model. ``dropout`` 0 gives the model's own segmentation.

    ``variants`` 0: every occurrence is drawn for itself; above, a word has so many segmentations at most.
    """

    def __init__(self, model_file: str, dropout: float = 0.1, seed: int = 0, variants: int = 0,
                 remembered: int = 300_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_of = [model.is_byte(i) for i in range(len(pieces))]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) for i in range(len(pieces))]
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.scores = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.byte_ids = [0] * 256
        for i, p in enumerate(pieces):
            if self.bytes_of[i]:
                self.byte_ids[int(p[3:5], 16)] = i
        self.raw = [bytes([int(p[3:5], 16)]) if self.bytes_of[i] else
                    p.replace(MARK, " ").encode("utf-8") if plain[i] else b"" for i, p in enumerate(pieces)]
        self.skip = round(dropout * (1 << 32))  # of 2 ** 32
        reached, left = [], 1 << 53
        for _ in range(GAPS if self.skip else 0):
            left = left * ((1 << 32) - self.skip) >> 32
            reached.append(left)
        self.reached = np.array(reached[::-1], np.uint64)  # of 2 ** 53, how often a gap is j or longer; from j = GAPS
        self.seed, self.variants, self.remembered = seed, variants if self.skip else 0, remembered
        # by word, (word, skip) or (word, skip, skip): (candidates taken, ids as bytes); what is met again in ``older``
        # goes back to ``known``, the rest is forgotten
        self.known: dict = {}
        self.older: dict = {}
        self.pairs = Pairs(self.scores)
        self.numbers = np.array(list(self.ids.values()), "<i4")

    def gaps(self, key, places, numbers) -> np.ndarray:
        """How many candidates are taken before the next skip, by place and number of the skip; GAPS: so many or more."""
        step = np.uint64(_STEP)
        at = _mixed(np.asarray(places, np.uint64) * step + np.asarray(key, np.uint64))
        at = _mixed(np.asarray(numbers, np.uint64) * step + at)
        return GAPS - np.searchsorted(self.reached, at >> np.uint64(11), "right")

    def skips(self, key: int, place: int):
        """Which candidates one occurrence skips, counted as they are taken from the agenda; without end."""
        at, number = -1, 0
        while self.skip:
            for gap in self.gaps(key & _MASK, [place & _MASK], np.arange(number, number + 16)).tolist():
                at += gap
                if gap < GAPS:
                    at += 1
                    yield at
            number += 16

    def segment(self, word: str, skips) -> tuple[int, list[int]]:
        """Number of candidates taken from the agenda, and ids of one chunk; ``skips`` are those to skip."""
        if MARK in word:  # such a character is no marker: it may not take part in a merge
            symbols = [_NEVER if c == MARK else MARK if c == " " else c for c in word]
        else:
            symbols = list(word.replace(" ", MARK))
        taken, symbols = (self._short if len(symbols) <= SHORT else self._long)(symbols, iter(skips))
        out, ids, at = [], self.ids, 0
        for symbol in symbols:
            found = ids.get(symbol)
            if found is None:  # a single character
                out += [self.byte_ids[b] for b in word[at].encode("utf-8", "surrogatepass")]
                at += 1
            else:
                out.append(found)
                at += len(symbol)
        return taken, out

    def word(self, word: str, variant: int) -> list[int]:
        """Ids of one chunk by draws of its own for every ``variant``."""
        key = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"), self.seed & _MASK)
        return self.segment(word, self.skips(key, variant))[1]

    def _runs(self, words: list[str], skips: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """What ``segment`` gives for each of many short words and its skips, ids as bytes.

        An array row per word, a column per symbol's first character. Every step takes the best candidate of each word.
        """
        pairs, n, width = self.pairs, len(words), max(map(len, words))
        none, other, rows = pairs.NONE, pairs.other, np.arange(len(words))
        letters = "".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le", "surrogatepass")
        size = np.fromiter(map(len, words), np.int64, n)
        # columns first, so that the least of every word is found along whole rows; the last row stands for no symbol.
        # All arrays are addressed flat: column x n + word
        column, last = np.arange(width + 1)[:, None], width * n + rows
        outside = column >= size
        symbol = np.full((width + 1, n), other, np.int32)
        symbol[:width] = pairs.symbol[np.frombuffer(letters, "<u4").reshape(n, width)].T
        symbol[outside] = other
        after = np.where(column + 1 < size, (column + 1) * n + rows, last).ravel()
        before = np.where(column > 0, (column - 1) * n + rows, last).ravel()
        found = pairs.find(symbol[:-1].ravel(), symbol[1:].ravel())
        agenda, gives = np.full((width + 1) * n, none, np.int32), np.zeros((width + 1) * n, np.int32)
        agenda[:width * n] = np.where(found < pairs.none, pairs.agenda[found] | np.repeat(column[:width, 0], n), none)
        gives[:width * n] = pairs.merged[found]
        symbol, alive = symbol.ravel(), ~outside.ravel()
        taken, used, limit = np.zeros(n, np.int64), np.zeros(n, np.int64), skips[:, 0].copy()
        skips = np.column_stack([skips, np.full(n, 1 << 40)])
        by_word = agenda.reshape(width + 1, n)
        while True:
            best = np.minimum.reduce(by_word, axis=0)
            row = np.flatnonzero(best != none)
            if not len(row):
                break
            column = (best[row] & 63).astype(np.int64)
            at = column * n + row
            agenda[at] = none
            skipped = taken[row] == limit[row]
            taken[row] += 1
            if skipped.any():
                some = row[skipped]
                used[some] += 1
                limit[some] = skips[some, used[some]]
                row, column, at = row[~skipped], column[~skipped], at[~skipped]
            mid, left, new = after[at], before[at], gives[at]
            end = after[mid]
            symbol[at], alive[mid], agenda[mid] = new, False, none
            after[at], before[end] = end, at
            found = pairs.find(np.concatenate([new, symbol[left]]), np.concatenate([symbol[end], new]))
            place = np.concatenate([at, left])
            agenda[place] = np.where(found < pairs.none, pairs.agenda[found] | np.concatenate([column, left // n]), none)
            gives[place] = pairs.merged[found]
        alive, symbol = alive.reshape(-1, n).T, symbol.reshape(-1, n).T
        flat, ends = symbol[alive], np.cumsum(alive.sum(axis=1))
        lettered = flat >= pairs.pieces  # written as bytes
        raw = self.numbers[np.where(lettered, 0, flat)].tobytes()
        out = [raw[a:b] for a, b in zip([0, *(4 * ends[:-1]).tolist()], (4 * ends).tolist())]
        for k in np.unique(np.searchsorted(ends, np.nonzero(lettered)[0], "right")).tolist():
            ids: list[int] = []
            for c in np.nonzero(alive[k])[0].tolist():
                if symbol[k, c] < pairs.pieces:
                    ids.append(self.numbers[symbol[k, c]])
                else:
                    ids += [self.byte_ids[b] for b in words[k][c].encode("utf-8", "surrogatepass")]
            out[k] = np.array(ids, "<i4").tobytes()
        return taken, out

    def _recall(self, keys: list) -> list:
        """What is remembered under these keys, or None."""
        found = list(map(self.known.get, keys))
        if self.older:
            for at, known in enumerate(found):
                if known is None:
                    known = self.older.get(keys[at])
                    if known is not None:
                        found[at] = self.known[keys[at]] = known
        return found

    def _learn(self, words: list[str], skips: np.ndarray) -> tuple[list[int], list[bytes]]:
        """``_runs`` of any number of words, remembered under the skips that mattered."""
        every, ids = np.zeros(len(words), np.int64), [b""] * len(words)
        by_length = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
        for start in range(0, len(words), ROWS):  # words of a length end together
            some = by_length[start:start + ROWS]
            texts, drawn = [words[k] for k in some.tolist()], skips[some]
            taken, found = self._runs(texts, drawn)
            every[some] = taken
            for k, value in zip(some.tolist(), found):
                ids[k] = value
            kept, needed = list(zip(taken.tolist(), found)), (drawn[:, :3] < taken[:, None]).sum(axis=1)
            for level in range(3):
                those = np.flatnonzero(needed == level).tolist()
                keys = [texts[k] for k in those]
                if level:
                    keys = zip(keys, *drawn[those, :level].T.tolist())
                self.known.update(zip(keys, [kept[k] for k in those]))
        return every.tolist(), ids

    def _short(self, symbols: list[str], skips) -> tuple[int, list[str]]:
        """The agenda as a list with a score per neighbouring pair, its least the next candidate."""
        score, none, taken, skip = self.scores.get, float("inf"), 0, next(skips, -1)
        agenda = [score(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            taken += 1
            if taken > skip >= 0:
                agenda[i], skip = none, next(skips, -1)
                continue
            merged = symbols[i] = symbols[i] + symbols.pop(i + 1)
            agenda.pop(i)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + merged, none)
            if i < len(agenda):
                agenda[i] = score(merged + symbols[i + 1], none)
        return taken, symbols

    def _long(self, symbols: list[str], skips) -> tuple[int, list[str]]:
        """The same with a heap, for chunks in which looking through all pairs would not do."""
        n, score, taken, skip = len(symbols), self.scores.get, 0, next(skips, -1)
        stop = list(range(1, n + 1))  # end of the symbol that starts here; 0 once merged into its left neighbour
        before = list(range(-1, n - 1))
        agenda = []

        def offer(start: int, mid: int, end: int) -> None:
            found = score(symbols[start] + symbols[mid])
            if found is not None:
                heapq.heappush(agenda, (found, start, mid, end))

        for i in range(n - 1):
            offer(i, i + 1, i + 2)
        while agenda:
            _, start, mid, end = heapq.heappop(agenda)
            if stop[start] != mid or stop[mid] != end:
                continue
            taken += 1
            if taken > skip >= 0:
                skip = next(skips, -1)
                continue
            symbols[start] += symbols[mid]
            symbols[mid], stop[start], stop[mid] = "", end, 0
            if end < n:
                before[end] = start
                offer(start, end, stop[end])
            if before[start] >= 0:
                offer(before[start], start, end)
        return taken, [symbols[i] for i in range(n) if stop[i]]

    def _block(self, some: list[tuple], out: list[list[bytes]]) -> None:
        """Append the ids of chunks, given as (text's number, key, place of the first one, chunks), to their texts'."""
        n = self.variants
        words = [w for _, _, _, chunks in some for w in chunks]
        sizes = [len(chunks) for _, _, _, chunks in some]
        keys = np.repeat(np.array([key for _, key, _, _ in some], np.uint64), sizes)
        places = np.concatenate([np.arange(start, start + len(chunks)) for _, _, start, chunks in some])
        gaps = np.full((DRAWN, len(words)), GAPS)
        if self.skip and not n:
            gaps = self.gaps(keys, places, np.arange(DRAWN)[:, None])
        gaps[1:] += 1
        skips = np.cumsum(gaps, axis=0).T
        if len(self.known) + len(words) > self.remembered:  # bounded memory; forgetting costs time, never results
            self.known, self.older = {}, self.known
        ids: list = [None] * len(words)
        waiting, missing, wanted = list(range(len(words))), [], words
        for level in range(3):
            if level:
                wanted = list(zip([words[at] for at in waiting], *skips[waiting, :level].T.tolist()))
            following = []
            for at, known, skip in zip(waiting, self._recall(wanted), skips[waiting, level].tolist()):
                if known is None:
                    missing.append(at)
                elif skip >= known[0]:
                    ids[at] = known[1]
                else:
                    following.append(at)
            waiting = following
        missing += waiting
        plain = [at for at in missing if not n and len(words[at]) <= SHORT]
        for at, taken, found, last in zip(plain, *self._learn([words[at] for at in plain], skips[plain]),
                                          skips[plain, -1].tolist()):
            if last < taken:  # there may be more skips
                found = self.segment(words[at], self.skips(int(keys[at]), int(places[at])))[1]
                found = np.array(found, "<i4").tobytes()
            ids[at] = found
        for at in missing:
            if ids[at] is None:
                key = int(keys[at]) + int(places[at])
                ids[at] = np.array(self.word(words[at], key % n if n else key), "<i4").tobytes()
        at = 0
        for (number, _, _, _), size in zip(some, sizes):
            out[number].append(b"".join(ids[at:at + size]))
            at += size

    def encode_many(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of whole texts. A text's key (a document's hash), the text and a word's place decide what is skipped."""
        out: list[list[bytes]] = [[] for _ in texts]
        some, held = [], 0
        for number, (text, key) in enumerate(zip(texts, keys)):
            chunks = CHUNK.findall(text)
            key = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), key + self.seed * _STEP & _MASK)
            for start in range(0, len(chunks), BLOCK):
                some.append((number, key, start, chunks[start:start + BLOCK]))
                held += len(some[-1][3])
                if held >= BLOCK:
                    self._block(some, out)
                    some, held = [], 0
        if some:
            self._block(some, out)
        return [np.frombuffer(b"".join(parts), "<i4") for parts in out]

    def encode(self, text: str, key: int = 0) -> list[int]:
        return self.encode_many([text], [key])[0].tolist()

    def decode(self, ids) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "surrogatepass")


def encode_documents(docs: DataFrame, model_file: str, dropout: float = 0.1, seed: int = 0, variants: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens, n_chars, text_crc32, lossless), one row per row of ``docs``.

    ``ids`` is decoded again in the same task; text_crc32 is the unsigned checksum of the decoded UTF-8 and lossless
    says that it equals the text. A null text counts as empty: no ids. Repeated rows get equal ids (the hash is
    keyed by doc_id, a null one as the empty id, and the text). ``model_file`` has to be readable by executors.
    """
    def make():
        encoder = Encoder(model_file, dropout, seed, variants)

        def work(ids, texts):
            keys = [xxhash.xxh64_intdigest(b"" if i is None else str(i).encode(), seed) & 0xFFFFFFFF for i in ids]
            rows = []
            for text, found in zip(texts, encoder.encode_many(texts, keys)):
                back = encoder.decode(found.tolist())
                rows.append((found, len(found), len(text),
                             zlib.crc32(back.encode("utf-8", "surrogatepass")), back == text))
            return list(zip(*rows))
        return work

    return per_text(docs, make, [
        ("ids", "array<int>", pa.list_(pa.int32())), ("n_tokens", "long", pa.int64()),
        ("n_chars", "long", pa.int64()), ("text_crc32", "long", pa.int64()), ("lossless", "boolean", pa.bool_())],
        id_col, text_col)
