"""Byte-level BPE with forced boundaries.

Two neighbouring bytes that stand side by side in no token of the vocabulary can never end up in one token: between them
is a certain cut. All certain cuts of a text, and those of the tokenizer's word pattern, are found at once on arrays; the
fragments between them are merged independently of each other, so a fragment seen before is looked up, and the
ids of the fragments are joined.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bedwatch.llm.common import per_text

#: fragments up to this many bytes are merged by scanning, longer ones through an agenda
SHORT = 24
NEVER = 1 << 62
LETTER, NUMBER, OTHER, SPACE = 1, 2, 3, 4
#: fixed values: the endings that the word pattern takes off, with the number of their characters
ENDINGS = {"'s": 2, "'t": 2, "'re": 3, "'ve": 3, "'m": 2, "'ll": 3, "'d": 2}


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(0x100 + k) for k, b in enumerate(others)}}


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file; other kinds of files are refused, not guessed at."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        added = spec.get("added_tokens") or []
        refused = [name for name, wrong in {
            "model": model.get("type") != "BPE", "normalizer": spec.get("normalizer") is not None,
            "pre_tokenizer": split.get("type") != "ByteLevel" or split.get("use_regex") is False,
            "prefix space": split.get("add_prefix_space"), "decoder": (spec.get("decoder") or {}).get("type") != "ByteLevel",
            "affixes": model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"),
            "dropout": model.get("dropout"), "ignore_merges": model.get("ignore_merges"),
            "added_tokens": any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)}.items() if wrong]
        if refused:
            raise ValueError(f"not a plain byte-level BPE file: {', '.join(refused)}")
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        ids = model["vocab"]
        self.byte_ids = [ids[letters[b]] for b in range(256)]
        merges = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        self.rank_of = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(merges)}.get
        self.made = [ids[a + b] for a, b in merges]
        self.special = {t["content"]: t["id"] for t in added}
        spelled = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.raw = [b""] * (max(spelled) + 1)
        for i, token in spelled.items():
            known = all(c in byte_of for c in token)
            self.raw[i] = bytes(byte_of[c] for c in token) if known else token.encode("utf-8")
        self.inside = np.zeros(1 << 16, bool)
        for i in ids.values():
            self.inside[[a << 8 | b for a, b in zip(self.raw[i], self.raw[i][1:])]] = True


class Encoder:
    def __init__(self, file: str, remembered: int = 300_000):
        from tokenizers.pre_tokenizers import ByteLevel

        self.vocabulary = v = Vocabulary(file)
        self.known: dict[bytes, bytes] = {}
        self.remembered = remembered
        self.forced = ~v.inside
        self.kinds = np.zeros(0x110000, np.uint8)  # filled in as characters are met
        self._words = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        longest_first = sorted(v.special, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if v.special else None

    # ---- cuts

    def _kind(self, letter: str) -> int:
        """What the library takes a character for: it joins letters, digits or marks, or is space."""
        for probe, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            if len(self._words(probe + letter)) == 1:
                return kind
        return SPACE

    def cuts(self, text: str, data: bytes) -> np.ndarray:
        """Byte positions, 0 and the end among them, between which ``text`` (``data`` in UTF-8) is encoded in pieces."""
        raw = np.frombuffer(data, np.uint8)
        cut = np.zeros(len(raw) + 1, bool)
        cut[[0, -1]] = True
        cut[1:-1] = self.forced[raw[:-1].astype(np.uint16) << 8 | raw[1:]]  # certain cuts
        if len(data) == len(text):
            points, at = raw, None
        else:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            at = np.nonzero(raw & 0xC0 != 0x80)[0]  # the byte each character begins at
        kinds = self.kinds[points]
        if not kinds.all():
            for p in np.unique(points[kinds == 0]).tolist():
                self.kinds[p] = self._kind(chr(p))
            kinds = self.kinds[points]
        word = self._word_starts(text, points, kinds)
        cut[:-1][word if at is None else at[word]] = True
        return np.nonzero(cut)[0]

    @staticmethod
    def _word_starts(text: str, points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Characters that begin a unit of the word pattern.

        Units are runs of one kind, each with one blank before it. Of a run of space the last character stands
        alone if something else follows (or is the blank of what follows); ``'s`` and the like are units of their own
        where a unit begins with the apostrophe.
        """
        space = kinds == SPACE
        start = np.ones(len(kinds), bool)
        start[1:] = kinds[1:] != kinds[:-1]
        ends = np.nonzero(space[:-1] & ~space[1:])[0]  # last character of a run of space, something follows
        start[ends] = True
        start[ends[points[ends] == 0x20] + 1] = False
        marks = np.nonzero((points == 0x27) & start)[0]  # not behind a blank or another mark
        done = -1
        for k in marks.tolist():
            if k < done:
                continue
            n = ENDINGS.get(text[k:k + 2]) or ENDINGS.get(text[k:k + 3])
            if n:
                done = k + n
                start[k + 1:done] = False
                start[done:done + 1] = True
        return np.nonzero(start)[0]

    # ---- merges

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the pair of the lowest rank is merged, the leftmost first, until none is left."""
        ids = [self.vocabulary.byte_ids[b] for b in fragment]
        return self._scan(ids) if len(ids) <= SHORT else self._agenda(ids)

    def _scan(self, ids: list[int]) -> list[int]:
        rank_of, made = self.vocabulary.rank_of, self.vocabulary.made
        ranks = [rank_of(p, NEVER) for p in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            ids[at:at + 2] = [made[best]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of((ids[at - 1], ids[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank_of((ids[at], ids[at + 1]), NEVER)
        return ids

    def _agenda(self, ids: list[int]) -> list[int]:
        """The same through a heap of candidate merges and a linked list of symbols, n log n for any length."""
        rank_of, made, n = self.vocabulary.rank_of, self.vocabulary.made, len(ids)
        before, after = array("l", range(-1, n - 1)), array("l", range(1, n + 1))
        heap = [(rank, k) for k, p in enumerate(zip(ids, ids[1:])) if (rank := rank_of(p, NEVER)) < NEVER]
        heapq.heapify(heap)
        while heap:
            rank, a = heapq.heappop(heap)
            b = after[a]
            if b >= n or rank_of((ids[a], ids[b]), NEVER) != rank:
                continue  # one of the two has been merged meanwhile
            ids[a], ids[b], after[a] = made[rank], -1, after[b]
            if after[a] < n:
                before[after[a]] = a
            for x, y in ((before[a], a), (a, after[a])):
                if x >= 0 and y < n and (rank := rank_of((ids[x], ids[y]), NEVER)) < NEVER:
                    heapq.heappush(heap, (rank, x))
        return [i for i in ids if i >= 0]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        parts = self.marks.split(text) if self.marks else [text]
        special, known, out = self.vocabulary.special, self.known, []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(array("I", [special[part]]).tobytes())
            elif part:
                data = part.encode("utf-8")
                edges = self.cuts(part, data).tolist()
                pieces = [data[a:b] for a, b in zip(edges, edges[1:])]
                new = set(pieces).difference(known)
                if new and len(known) > self.remembered:
                    known.clear()  # bounded memory; forgetting costs time, never results
                    new = set(pieces)
                for piece in new:
                    known[piece] = array("I", self.merge(piece)).tobytes()
                out.extend(map(known.__getitem__, pieces))
        return np.frombuffer(b"".join(out), np.uint32).astype(np.int32)


def encode_documents(docs: DataFrame, file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids), one row per row of ``docs``: the ids of the whole text, a null text counting as empty.

    ``file`` is a tokenizers JSON file of a byte-level BPE that executors can read; special tokens spelled out in a text get
    their ids. Ids pass through, null ones too; repeated rows give repeated rows; other columns are not looked at.
    """
    def make():
        encoder = Encoder(file)
        return lambda ids, texts: [[encoder.encode(t) for t in texts]]

    return per_text(docs, make, [("ids", "array<int>", pa.list_(pa.int32()))], id_col, text_col)


def decode_documents(encoded: DataFrame, file: str) -> DataFrame:
    """(doc_id, ids, text): the text that the ids spell, special tokens included; bytes that are no UTF-8 become U+FFFD.

    Null ids count as none. An id that the vocabulary does not have is left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = Vocabulary(file).raw
        n = len(raw)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = []
                for ids in some.column(1):
                    values = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, np.int32)
                    if len(values) and (values.min() < 0 or values.max() >= n):
                        values = values[(values >= 0) & (values < n)]
                    texts.append(b"".join(map(raw.__getitem__, values.tolist())).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded documents."""
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return decoded.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("text"), 256).alias("decoded_sha256"))
