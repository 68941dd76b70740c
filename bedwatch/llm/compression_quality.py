"""Quality by compression: zstandard dictionaries of good and of bad text, and the difference between them.

A text is compressed twice in short pieces, once with each dictionary. What the bad dictionary needs more, per byte of
text, is its evidence of quality; logistic regression on labelled texts the dictionaries have not seen turns that into
a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from bedwatch.llm.common import whole_text

PIECE = 1024  # bytes compressed at a time: in a longer text the dictionary would matter at its start only


def pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


def dictionary(texts: list[str], common: set[str], size: int) -> bytes:
    """A dictionary of these texts without their ``common`` lines, which tell nothing about either class."""
    samples = [p for t in texts for p in pieces("\n".join(x for x in t.split("\n") if x not in common))]
    samples += [b"\n" * 8] * max(0, 16 - len(samples))
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 4)), samples, k=64, d=8, f=20).as_bytes()
    except zstandard.ZstdError:  # too little text to choose from: its tail serves as it is
        return b"".join(samples)[-size:]


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration (intercept, weight of the difference, weight of the log length)."""

    good: bytes
    bad: bytes
    calibration: tuple[float, float, float]
    constant: float | None = None  # the score of every text if one of the classes had no labels
    level: int = 3

    def features(self, texts) -> np.ndarray:
        """Per text: bytes saved by the good dictionary per byte of text, and the logarithm of its length."""
        def compressor(content):
            held = zstandard.ZstdCompressionDict(content)
            held.precompute_compress(level=self.level)
            return zstandard.ZstdCompressor(level=self.level, dict_data=held, write_checksum=False,
                                            write_content_size=False, write_dict_id=False).compress

        good, bad = compressor(self.good), compressor(self.bad)
        out = np.zeros((len(texts), 2))
        for i, text in enumerate(texts):
            cut = pieces(text)
            size = sum(map(len, cut))
            gain = sum(len(bad(p)) - len(good(p)) for p in cut)
            out[i] = gain / (size + 1), np.log1p(size)
        return out

    def scores(self, texts) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        a, b, c = self.calibration
        x = self.features(texts)
        return 1 / (1 + np.exp(-np.clip(a + b * x[:, 0] + c * x[:, 1], -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression with an intercept, by Newton steps on standardised columns."""
    centre, spread = x.mean(0), np.maximum(x.std(0), 1e-12)
    z = np.column_stack([np.ones(len(x)), (x - centre) / spread])
    w = np.zeros(z.shape[1])
    ridge = penalty * len(x) * np.diag([0.0, *[1.0] * x.shape[1]])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w)), z.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / spread
    return np.array([w[0] - (slopes * centre).sum(), *slopes])


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learned from. A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, longest: int = 65_536, size: int = 112_640,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Learn from at most ``per_class`` labelled texts of each class, of at most ``longest`` bytes.

    These bound what reaches the driver; which rows they are is fixed by a hash of the id. Held out rows, null labels
    and ids whose labels disagree are not used. Half of the texts make the dictionaries, the other half the
    calibration, whose odds are set to those of all usable labels. Without labels of both classes every text gets 1.0, or 0.0 if all labels are 0.
    """
    known = labels.select(F.col(id_col).cast("long").alias("__id"), F.col(label_col).cast("int").alias("__y"))
    known = known.filter("__id IS NOT NULL AND __y IN (0, 1)").filter(~held_out(F.col("__id")))
    known = known.groupBy("__id").agg(F.min("__y").alias("__y"), F.max("__y").alias("__z")).filter("__y = __z")
    order = (F.xxhash64("__id"), F.col("__id"))
    chosen = known.filter("__y = 1").orderBy(*order).limit(per_class).unionByName(
        known.filter("__y = 0").orderBy(*order).limit(per_class)).select("__id", "__y")
    read = docs.select(F.col(id_col).cast("long").alias("__doc"), whole_text(text_col).alias("__text"))
    rows = read.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).filter(  # 2 x per_class rows at most
        F.octet_length("__text") <= longest).dropDuplicates(["__doc"]).select("__doc", "__y", "__text").collect()
    rows = sorted((r["__doc"], r["__y"], r["__text"]) for r in rows)
    texts = {y: [t for _, z, t in rows if z == y] for y in (0, 1)}
    if not texts[0] or not texts[1]:
        return QualityModel(b"", b"", (0.0, 0.0, 0.0), 0.0 if texts[0] else 1.0)
    lines = Counter(x for t in [*texts[0], *texts[1]] for x in set(t.split("\n")))
    common = {x for x, n in lines.items() if n > 1}
    made = {y: dictionary(t[::2], common, size) for y, t in texts.items()}
    model = QualityModel(made[1], made[0], (0.0, 0.0, 0.0))
    rest = {y: t[1::2] or t for y, t in texts.items()}
    x = model.features([*rest[1], *rest[0]])
    y = np.array([1.0] * len(rest[1]) + [0.0] * len(rest[0]))
    weights = logistic(x, y)
    # the sample holds the classes about evenly; the odds are those of all labels
    total = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    weights[0] += np.log(total[1] / total[0]) - np.log(len(rest[1]) / len(rest[0]))
    return QualityModel(made[1], made[0], tuple(map(float, weights)))


def score(model: QualityModel, text: Column) -> Column:
    """The score of each whole text, 0 to 1; a null text counts as empty, which has no evidence but its length."""
    @pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist()))

    return run(whole_text(text))


def score_documents(docs: DataFrame, model: QualityModel, threshold: float = 0.7, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``; predicted is 1 from ``threshold`` on."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(model, F.col(text_col)).alias("score"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` (all its columns) whose text is not rejected."""
    return docs.withColumn("__score", score(model, F.col("text"))).filter(
        F.col("__score") >= threshold).select(docs.columns)
