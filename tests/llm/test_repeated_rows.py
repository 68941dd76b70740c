"""Repeated rows, repeated ids and other tokenizers, against SQL, brute force and the library."""

import json
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from bedwatch.llm import mixing
from bedwatch.llm.multi_index import nearest
from bedwatch.llm.queries import vocabulary
from bedwatch.llm.token_files import WordIds

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def doc(i, words, source):
    text = " ".join(f"w{k}" for k in range(words))
    return (i, text, "en", source, len(text))


@pytest.fixture(scope="module")
def repeated_docs(spark):
    rows = [doc(1, 8, "a")] * 1000 + [doc(100 + k, 5 + k % 7, "b") for k in range(1500)]
    rows += [(7, "one two three", "en", "c", 13), (7, "four five six", "fr", "c", 13), (7, None, None, None, None)] * 40
    return spark.createDataFrame(rows, DOCS).repartition(5)


def test_mix_of_repeated_rows_equals_sql(spark, repeated_docs, tmp_path):
    repeated_docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = Counter((i, n, t) for i, n, _, _, t in con.execute(mixing.ORACLE).fetchall())
    rows = mixing.mix(repeated_docs).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in rows) == want
    for source in ("a", "b", "c"):
        own = [r for r in rows if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 12, source


def test_texts_under_one_id_come_as_often_as_each_is_taken(spark, repeated_docs):
    mixed = mixing.mix(repeated_docs)
    want = Counter()
    for r in mixed.collect():
        if r["size"]:
            want[r["doc_id"], r["text_hash"]] += r["taken"] // r["size"]
    from pyspark.sql import functions as F

    out = mixing.repeated(repeated_docs, mixed)
    got = Counter((r["doc_id"], r["h"]) for r in out.select("doc_id", F.xxhash64("text").alias("h")).collect())
    assert got == +want and out.columns == repeated_docs.columns
    two = spark.createDataFrame([(7, "one two three", "en", "c", 13), (7, "four five six", "en", "c", 13)], DOCS)
    assert mixing.repeated(two, mixing.mix(two)).count() == 2  # all of a single source, once


def test_a_repeated_query_row_is_asked_once(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(41, 6))
    rows = [(int(i), x[i % 41].tolist()) for i in range(100, 141)] + [(100, x[100 % 41].tolist())]
    other = rng.normal(size=6).tolist()
    rows.append((100, other))  # another vector under the same id
    got = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), share=1.0).collect()
    def ranked(q):
        near = sorted((float(np.sqrt(((np.array(v) - q) ** 2).sum())), i) for i, v in rows if i != 100)[:10]
        return [(k, i, round(s, 9)) for k, (s, i) in enumerate(near, 1)]
    want = sorted(ranked(x[100 % 41]) + ranked(np.array(other)))
    assert sorted((r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == want and len(got) == 20


def test_other_tokenizers_encode_whole_texts(tmp_path):
    spec = json.load(open(vocabulary("word_bpe_49k.json")))
    texts = ["Hello World, again.", "hello  world\n 12 it's", "", "<|endoftext|> ÀÉ straße"]
    cased = spec | {"normalizer": {"type": "NFC"}}
    words = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None, "decoder": None,
             "post_processor": None, "pre_tokenizer": {"type": "Whitespace"},
             "model": {"type": "WordLevel", "vocab": {"[UNK]": 0, "hello": 1, "Hello": 2, "World": 3}, "unk_token": "[UNK]"}}
    short = spec | {"truncation": {"direction": "Right", "max_length": 2, "strategy": "LongestFirst", "stride": 0}}
    for name, other, apart in (("same", spec, True), ("cased", cased, False), ("words", words, False), ("short", short, True)):
        file = tmp_path / f"{name}.json"
        file.write_text(json.dumps(other))
        encoder, library = WordIds(str(file)), Tokenizer.from_file(str(file))
        library.no_truncation()
        assert encoder.by_words == apart
        got = [np.frombuffer(b, "<u4").tolist() for b in encoder.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts], name


@pytest.mark.parametrize("least", [1.0, 0.999999, 0.99])
def test_near_vectors_up_to_equal_directions(spark, least):
    """Cosines up to 1 need few cells; copies, scaled copies and vectors a little apart are linked as brute force says."""
    from bedwatch.llm.epsilon_join import near_vectors

    rng = np.random.default_rng(2)
    x = rng.integers(-8, 9, size=(150, 5)).astype(float)
    x[0] = 1
    apart = x.copy()
    apart[:, 0] += 1e-4
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, x, 4 * x, apart]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(df, least=least, block_rows=64).collect()}
    v = np.array([r[1] for r in rows])
    norm = np.linalg.norm(v, axis=1)
    cos = (v @ v.T) / np.maximum(norm[:, None] * norm[None], 1e-300)
    sure, open_ = cos >= least + 1e-12, np.abs(cos - least) < 1e-12  # either answer is right within rounding
    usable = norm > 0
    for k in range(len(v)):
        low = sum(sure[k][j] for j in range(len(v)) if j != k and usable[j]) if usable[k] else 0
        high = low + sum(open_[k][j] for j in range(len(v)) if j != k and usable[j] and not sure[k][j]) if usable[k] else 0
        assert low <= got[k][0] <= high, k
    assert got[0][0] >= 1 and got[150][1] == got[0][1] == 0
