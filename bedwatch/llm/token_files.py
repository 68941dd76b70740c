"""Token ids in files: frequency-ranked ids in byte-aligned variable-length coding, control bytes kept apart.

The most frequent id is written as 0, the next as 1 and so on, in as few bytes as it needs (1 to 4). The lengths, two bits
each, stand in control bytes of their own before the data bytes, so a reader finds every id by looking lengths up
in a table of 256 control bytes and adding them up; there is no loop over ids.

A folder of the format holds ``blocks`` (Parquet; each row a run of whole documents in ascending doc_id order, numbered by
file part and block) and ``ranks`` (the ids by rank).
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from bedwatch.llm.common import discard, stage, whole_text
from bedwatch.session import new_folder

MAGIC = b"FVB1"
#: lengths of the four ids of each control byte
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    four = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    four[:len(values)] = extra
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(4)[None] <= extra[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values of ``pack``."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    raw = np.frombuffer(data, np.uint8)
    values = raw[starts].astype(np.uint32)
    for k in (1, 2, 3):
        at = np.nonzero(lengths > k)[0]
        if len(at):
            values[at] |= raw[starts[at] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


def write_block(lengths: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = np.array([len(lengths), len(ranks), len(control)], "<u4").tobytes()
    return MAGIC + head + lengths.astype("<u4").tobytes() + control + data


def read_block(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of each document, ranks)."""
    if block[:4] != MAGIC:
        raise ValueError("not a block of this format")
    docs, n, size = (int(x) for x in np.frombuffer(block, "<u4", 3, 4))
    body = 16 + 4 * docs
    return np.frombuffer(block, "<u4", docs, 16), unpack(block[body:body + size], block[body + size:], n)


# The normaliser and the word split of the tokenizers for which ``WordIds`` takes texts apart, as their files spell them.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class WordIds:
    """Ids of whole texts, encoding each distinct word once.

    That holds for tokenizers with the normaliser and word split above, and special tokens spelled ``<|...|>``; the file
    says so. With any other tokenizer whole texts are encoded by it. The known one drops white space and never joins across it, so a text's ids are those of its words in a row; words
    are split at ASCII white space only, which every such tokenizer treats as white space. It also lower-cases, and
    parts letters and digits from the punctuation behind them, so a word is looked up in small letters and without
    its last marks (ASCII ones behind an ASCII letter or digit are one piece of their own) before it is encoded. Texts are split, and their words counted as distinct ones and put
    in place, as Arrow columns; only distinct words pass through Python. A word of Latin letters only is one unit that no normaliser changes but for its
    case: it goes to the tokenizer's model at once, if samples show that this gives the ids of the whole tokenizer.
    """

    MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    SAMPLES = ("a", "licence", "internationalisation", "étaient", "straße", "añosćž")

    def __init__(self, file: str, remembered: int = 400_000):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer, self.known, self.remembered = Tokenizer.from_file(file), {}, remembered
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_words = (
            self._spelled(self.tokenizer.normalizer) == NORMALIZER and self._spelled(self.tokenizer.pre_tokenizer) == SPLIT
            and isinstance(self.tokenizer.model, BPE) and not self.tokenizer.model.dropout
            and all(t.content.startswith("<|") and not any(c.isspace() for c in t.content)
                    and not (t.single_word or t.lstrip or t.rstrip or t.normalized)
                    for t in self.tokenizer.get_added_tokens_decoder().values()))
        if not self.by_words:
            return
        from tokenizers.pre_tokenizers import ByteLevel

        self.model, plain = self.tokenizer.model, ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {c: plain.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x250)}
        self.direct = all(self._unit(w) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in self.SAMPLES)

    @staticmethod
    def _spelled(part) -> dict | None:
        """A part of the tokenizer as its file spells it, without reading the vocabulary again."""
        return None if part is None else json.loads(part.__getstate__())

    def _unit(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.bytes_of))]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if not self.by_words:
            texts = texts if isinstance(texts, list) else texts.to_pylist()
            return [np.array(found.ids, "<u4").tobytes()
                    for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string())
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = pa.array(self._word_ids(words.dictionary), pa.large_binary()).take(words.indices)
        # the ids of a text's words lie behind each other: its own begin and end where its words do
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        bounds = ends[np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())])].tolist()
        data = ids.buffers()[2]
        data = memoryview(data) if data is not None else b""
        return [bytes(data[low:high]) for low, high in zip(bounds, bounds[1:])]

    def _word_ids(self, words: pa.Array) -> list[bytes]:
        """The ids of each of these words: those of its core, then those of the marks behind it."""
        special = pc.match_substring(words, "<|")  # a special token is told by its case
        small = pc.if_else(special, words, pc.ascii_lower(words))
        core = pc.ascii_rtrim(small, characters=self.MARKS)
        parted = pc.and_(pc.match_substring_regex(core, "[0-9a-z]$"), pc.invert(special))
        cores = pc.if_else(parted, core, small).dictionary_encode()
        units = self._known(_listed(cores.dictionary))
        found = [units[k] for k in _listed(cores.indices)]
        marked = np.nonzero(pc.and_(parted, pc.not_equal(core, small)).to_numpy(zero_copy_only=False))[0]
        marks = [w[n:] for w, n in zip(_listed(small.take(marked)), _listed(pc.utf8_length(core.take(marked))))]
        kinds = list(set(marks))
        ids_of = dict(zip(kinds, self._known(kinds)))
        for k, mark in zip(marked.tolist(), marks):
            found[k] += ids_of[mark]
        return found

    def _known(self, words: list[str]) -> list[bytes]:
        """The ids of each of these distinct words, remembered ones or new ones."""
        if len(self.known) > self.remembered:
            self.known.clear()  # bounded memory; forgetting costs time, never results
        self._learn([w for w in words if w not in self.known])
        return [self.known[w] for w in words]

    def _learn(self, words: list[str]) -> None:
        others, known = [], self.known
        for word in words:
            if self.direct and word.isalpha() and (
                    word.isascii() or max(word) < "\u0250" and word.lower().isalpha()):
                known[word] = array("I", self._unit(word.lower())).tobytes()
            else:
                others.append(word)
        for at in range(0, len(others), 2048):
            some = others[at:at + 2048]
            for word, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                known[word] = array("I", found.ids).tobytes()


def _listed(values: pa.Array) -> list:
    """``to_pylist`` of values without nulls, several times as fast."""
    return values.to_numpy(zero_copy_only=False).tolist()


def by_size(texts: pa.Array, size: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of texts of about ``size`` bytes together, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        n = max(1, int(np.searchsorted(ends, before + size, "right")) - at)
        yield at, n
        at += n


def encoded_blocks(docs: DataFrame, file: str, end_id: int, block_ids: int, id_col: str, text_col: str) -> DataFrame:
    """Runs of documents in ascending order of id (then text): part, block, doc_ids, lengths and ids as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        encoder, end = WordIds(file), np.array([end_id], "<u4").tobytes()
        part, block, names, parts, held = TaskContext.get().partitionId(), 0, [], [], 0

        def row():
            lengths = np.array([len(p) // 4 for p in parts], "<u4")
            ids = np.frombuffer(b"".join(parts), "<u4")
            small = ids.astype("<u2") if len(ids) and ids.max() < 1 << 16 else ids
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([names], pa.list_(pa.int64())),
                pa.array([lengths.tobytes()], pa.binary()), pa.array([small.itemsize], pa.int32()),
                pa.array([small.tobytes()], pa.binary())],
                names=["part", "block", "doc_ids", "lengths", "width", "ids"])

        for batch in batches:
            for at, n in by_size(batch.column(1)):
                some = batch.slice(at, n)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1))):
                    names.append(doc_id)
                    parts.append(ids + end)
                    held += len(parts[-1]) // 4
                    if held >= block_ids:
                        yield row()
                        block, names, parts, held = block + 1, [], [], 0
        if names:
            yield row()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(run, "part int, block int, doc_ids array<long>, lengths binary, width int, ids binary")


def _ids(lengths: bytes, width: int, ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype("<u4")


def frequencies(blocks: DataFrame) -> DataFrame:
    """(id, n) over all documents: every task counts its own blocks, then a row per id is added up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for lengths, width, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = np.bincount(_ids(lengths, width, ids))
                if len(found) > len(total):
                    total = np.pad(total, (0, len(found) - len(total)))
                total[:len(found)] += found
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())], names=["id", "n"])

    return blocks.select("lengths", "width", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(
        F.sum("n").alias("n"))


def write_token_files(docs: DataFrame, file: str, end_id: int = 1, path: str | None = None, block_ids: int = 1 << 18,
                      id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every whole text, append ``end_id`` and write all ids; returns the folder.

    Documents are written in ascending doc_id order, a null id first, rows with equal ids by text; a null text counts
    as empty and is its end id alone. ``file`` is a tokenizers JSON file that executors can read.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark, "token-files")
    blocks = stage(encoded_blocks(docs, file, end_id, block_ids, id_col, text_col), "token-blocks")
    counted = frequencies(blocks).collect()  # at most one row per id of the vocabulary
    ranked = [r["id"] for r in sorted(counted, key=lambda r: (-r["n"], r["id"]))]
    spark.createDataFrame(list(enumerate(ranked)), "rank int, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max([0, *ranked]) + 1, "<u4")
    rank_of[ranked] = np.arange(len(ranked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            for k in range(batch.num_rows):
                ids = _ids(None, c["width"][k].as_py(), c["ids"][k].as_py())
                packed = write_block(np.frombuffer(c["lengths"][k].as_py(), "<u4"), rank_of[ids])
                yield pa.RecordBatch.from_arrays(
                    [c["part"].slice(k, 1), c["block"].slice(k, 1), c["doc_ids"].slice(k, 1),
                     pa.array([len(ids)], pa.int64()), pa.array([packed], pa.binary())],
                    names=["part", "block", "doc_ids", "n_ids", "payload"])

    blocks.mapInArrow(run, "part int, block int, doc_ids array<long>, n_ids long, payload binary").write.option(
        "compression", "none").parquet(f"{path}/blocks")
    discard(blocks)
    return path


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    ranked = spark.read.schema("rank int, id long").parquet(f"{path}/ranks").collect()  # the vocabulary at most
    id_of = np.zeros(len(ranked), "<u4")
    for r in ranked:
        id_of[r["rank"]] = r["id"]
    blocks = spark.read.schema("part int, block int, doc_ids array<long>, n_ids long, payload binary").parquet(f"{path}/blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {name: batch.column(name) for name in batch.schema.names}
            for k in range(batch.num_rows):
                lengths, ranks = read_block(c["payload"][k].as_py())
                raw = id_of[ranks].tobytes()
                ends = np.cumsum(lengths, dtype=np.int64)
                sums = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c["part"][k].as_py()] * n, pa.int32()), pa.array([c["block"][k].as_py()] * n, pa.int32()),
                     pa.array(c["doc_ids"][k].as_py(), pa.int64()), pa.array(ends - lengths, pa.int64()),
                     pa.array(lengths.astype(np.int64), pa.int64()), pa.array(sums, pa.int64())],
                    names=["part", "block", "doc_id", "inside", "n_tokens", "ids_crc32"])

    rows = blocks.select("part", "block", "doc_ids", "payload").mapInArrow(
        run, "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # blocks are added up within their part, parts (one per task that wrote) among each other
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select(F.col("part").alias("p"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("parts_before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block")) - F.col("n_ids")
    offsets = sizes.withColumn("blocks_before", within).join(F.broadcast(parts), F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("block").alias("b"), (F.col("parts_before") + F.col("blocks_before")).alias("offset"))
    joined = rows.join(offsets, (F.col("part") == F.col("p")) & (F.col("block") == F.col("b")))
    return joined.select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
