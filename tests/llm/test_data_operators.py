"""Vectors, shards, mix, encoding, classifier and pipeline against brute force, round trips and held out labels."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from bedwatch.llm import compression_quality as cq
from bedwatch.llm import mixing, resharding
from bedwatch.llm.epsilon_join import near_vectors
from bedwatch.llm.merge_dropout import CHUNK, Encoder, encode_documents
from bedwatch.llm.multi_index import nearest, traverse
from bedwatch.llm.queries import QUERIES, vocabulary

MODEL = vocabulary("piece_bpe_32k.model")


# ---- vectors

def brute_links(ids, x, least=0.95):
    norm = np.linalg.norm(x, axis=1)
    hit = (x @ x.T) / np.outer(norm, norm) >= least
    np.fill_diagonal(hit, False)
    component = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            low = min([component[i], *(component[j] for j in np.nonzero(hit[i])[0])], key=lambda k: ids[k])
            if ids[low] < ids[component[i]]:
                component[i], changed = low, True
    return {i: (int(h.sum()), ids[c]) for i, h, c in zip(ids, hit, component)}


def clustered(n=900, dims=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dims))
    x = centres[rng.integers(0, 30, n)] + rng.normal(size=(n, dims)) * rng.choice([0.02, 0.12, 0.3], n)[:, None]
    x[100:160] = x[100] + rng.normal(size=(60, dims)) * 0.01  # a dense group
    x[200:240] = x[200]  # copies
    return np.arange(n) * 3 + 5, (x * rng.uniform(0.5, 4, n)[:, None]).astype(np.float32)


@pytest.mark.parametrize("block_rows", [4096, 37])
def test_near_vectors_equal_brute_force(spark, block_rows):
    ids, x = clustered()
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors(df, block_rows=block_rows).collect()}
    want = brute_links([int(i) for i in ids], x.astype(float))
    assert got == want
    assert max(n for n, _ in want.values()) >= 39


def test_near_vectors_over_the_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in QUERIES["op2_embedding_near_dedup"](spark, sf).collect()}
    assert got == brute_links([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], float))


ODD = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, None, 0), (4, [0.0, 0.0], 0), (5, [float("nan"), 1.0], 0),
       (6, [float("inf"), 1.0], 0), (7, [None, 1.0], 0), (8, [], 0), (None, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [0.0, -2.0], 0),
       (100, [2.0, 0.1], 0)]
ODD_SCHEMA = "vec_id long, embedding array<float>, score int"


def test_near_vectors_odd_rows(spark):
    rows = near_vectors(spark.createDataFrame(ODD, ODD_SCHEMA)).collect()
    assert len(rows) == len(ODD)
    got = defaultdict(set)
    for r in rows:
        got[r["vec_id"]].add((r["n_links"], r["component_id"], r["kept"]))
    assert got[1] == {(3, 1, True)} and got[2] == {(3, 1, False)} and got[100] == {(3, 1, False)}
    for lone in (3, 4, 5, 6, 7, 8, 9, 10):
        assert got[lone] == {(0, lone, True)}
    assert got[None] == {(0, None, True)}
    assert near_vectors(spark.createDataFrame([], ODD_SCHEMA)).count() == 0


def brute_nearest(ids, x, every=100, top=10):
    out = {}
    for i, q in zip(ids, x):
        if i % every == 0:
            d = np.sqrt(((x - q) ** 2).sum(1))
            order = [k for k in np.lexsort((ids, d)) if ids[k] != i][:top]
            out[int(i)] = [(int(ids[k]), d[k]) for k in order]
    return out


def recall(rows, want):
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    return hits / sum(map(len, want.values())), got


def test_nearest_recall_on_the_given_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    share, got = recall(QUERIES["op7_nearest_vectors"](spark, sf).collect(), brute_nearest(ids, x))
    assert share >= 0.9
    at = dict(zip(ids.tolist(), x))
    for q, found in got.items():
        assert [s for _, s in found] == [float(np.sqrt(((at[v] - at[q]) ** 2).sum())) for v, _ in found]
        assert found == sorted(found, key=lambda f: (f[1], f[0])) and len(found) == 10


def test_nearest_on_clusters_needs_few_cells_and_is_exact_with_all(spark):
    ids, x = clustered()
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    want = brute_nearest(ids, x.astype(float), every=10)
    few, _ = recall(nearest(df, every=10, share=0.3, k=8, chunk=50).collect(), want)
    all_, got = recall(nearest(df, every=10, share=1.0, k=8, chunk=50).collect(), want)
    assert few >= 0.9 and all_ == 1.0
    assert all([v for v, _ in got[q]] == [v for v, _ in want[q]] for q in want)


def test_cells_come_by_ascending_sum():
    rng = np.random.default_rng(0)
    a, b = rng.random(6), rng.random(6)
    cells = traverse(a, b, np.ones(36, int), 36)
    sums = [a[c // 6] + b[c % 6] for c in cells]
    assert sorted(cells) == list(range(36)) and sums == sorted(sums)


def test_nearest_odd_rows(spark):
    rows = nearest(spark.createDataFrame(ODD, ODD_SCHEMA)).collect()
    assert [(r["query_id"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (100, 1), (100, 2), (100, 2), (100, 10)]
    assert nearest(spark.createDataFrame([], ODD_SCHEMA)).count() == 0


# ---- shards

def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(0)
    for n, m in ((3, 8), (8, 3), (5, 5), (1, 4)):
        supply = [int(v) for v in rng.integers(0, 1000, n)]
        demand = resharding.equal_capacities(sum(supply), m)
        flow = resharding.min_cost_flow(supply, demand)
        assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow)] == demand
        stays = sum(flow[i][i] for i in range(min(n, m)))
        assert stays == sum(min(supply[i], demand[i]) for i in range(min(n, m)))


def test_shards_hold_every_text_in_equal_bytes(spark, sf, documents):
    rows = QUERIES["op3_sharding"](spark, sf).collect()
    texts = {d: t or "" for d, t, _ in documents}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    size, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(size) == list(range(8))
    assert max(size.values()) - min(size.values()) < 0.01 * sum(size.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_only_affected_shards_are_written(spark, folder_of):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, "x" * (i % 17)) for i in range(400)], "doc_id long, text string")
    old = F.when(F.col("doc_id") < 100, 0).when(F.col("doc_id") < 300, 1).otherwise(2)
    sizes = [sum(i % 17 + 1 for i in r) for r in (range(100), range(100, 300), range(300, 400))]
    capacities = [sizes[0], sizes[1] - 300, sizes[2] + 300]
    path = resharding.reshard(docs, old, capacities, path=folder_of("new"), unchanged_from=folder_of("old"))
    rows = spark.read.schema("doc_id long, text string, shard int").parquet(path).collect()
    assert {r["shard"] for r in rows} == {1, 2}
    moved = [r for r in rows if r["shard"] == 2 and r["doc_id"] < 300]
    assert abs(sum(len(r["text"]) + 1 for r in moved) - 300) <= 2
    assert sorted(r["doc_id"] for r in rows) == list(range(100, 400))


@pytest.fixture
def folder_of(tmp_path):
    return lambda name: str(tmp_path / name)


def test_shards_odd_rows(spark, odd_docs, no_docs):
    from pyspark.sql import functions as F

    rows = resharding.read_shards(spark, resharding.reshard(odd_docs, F.length("source"), 3)).collect()
    assert len(rows) == 9 and {r["size"] for r in rows if r["doc_id"] in (2, 3)} == {1}
    gone = resharding.read_shards(spark, resharding.reshard(odd_docs, F.col("doc_id").cast("int"), 2)).collect()
    assert len(gone) == 9 and {r["shard"] for r in gone} <= {0, 1}
    assert resharding.read_shards(spark, resharding.reshard(no_docs, F.lit(0), 3)).count() == 0


# ---- mix

def test_mix_follows_its_law(spark, sf):
    rows = QUERIES["op4_source_mix"](spark, sf).collect()
    of = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    sizes, goal, taken = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        source = of[r["doc_id"]]
        sizes[source] += r["size"]
        goal[source] = r["target"]
        taken[source] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
    assert all(sizes[of[r["doc_id"]]] == r["source_size"] for r in rows)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    want, full = {}, set()
    while True:  # deal out, stop at three times the size, deal the rest again
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        want = {s: 3 * sizes[s] if s in full else left * weight[s] / sum(weight[o] for o in open_) for s in names}
        over = {s for s in open_ if want[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    for s in names:
        assert abs(goal[s] - want[s]) < 1e-6 * want[s]
        largest = max(r["size"] for r in rows if of[r["doc_id"]] == s)
        assert abs(taken[s] - goal[s]) <= largest
    again = {r["doc_id"]: r["taken"] for r in QUERIES["op4_source_mix"](spark, sf).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_targets_stop_at_three_times_the_size(spark):
    df = spark.createDataFrame([("a", 1), ("b", 10), ("c", 1000), (None, 5)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got["a"] == 3 and got["b"] == 30 and got[None] == 15
    assert abs(got["c"] - (1016 - 48)) < 1e-9


def test_heavier_documents_are_drawn_more_often(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("w"),
                                  mixing.sampling_key(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(1.0)).otherwise(0.25), "s").alias("k"))
    first = df.orderBy("k").limit(500).agg(F.avg("w").alias("w")).first()["w"]
    assert first > 0.8


def test_mix_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == 9 and {r["taken"] for r in rows if r["doc_id"] in (2, 3, 5)} == {0}
    out = mixing.repeated(odd_docs, mixing.mix(odd_docs))
    assert out.columns == odd_docs.columns
    assert out.count() == sum(r["taken"] // r["size"] for r in rows if r["size"])
    assert mixing.mix(no_docs).count() == 0 and mixing.repeated(no_docs, mixing.mix(no_docs)).count() == 0


# ---- SentencePiece

def test_without_dropout_it_is_the_models_own_segmentation(documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = Encoder(MODEL, dropout=0)
    for _, text, _ in documents[:200]:
        clean = " ".join((text or "").replace("\n", " ").split())
        if model.normalize(clean) == "▁" + clean.replace(" ", "▁"):
            assert encoder.encode(" " + clean) == model.encode(clean)


def test_dropout_varies_and_decodes_losslessly(documents):
    encoder = Encoder(MODEL, dropout=0.2, seed=3)
    plain = Encoder(MODEL, dropout=0)
    differ = 0
    for doc_id, text, _ in documents:
        ids = encoder.encode(text, doc_id)
        assert encoder.decode(ids) == text
        assert ids == Encoder(MODEL, dropout=0.2, seed=3).encode(text, doc_id) if doc_id < 5 else True
        differ += ids != plain.encode(text)
    assert differ > 0.9 * len(documents)
    assert len(plain.encode(documents[0][1])) < len(encoder.encode(documents[0][1]))
    assert Encoder(MODEL, dropout=1.0, variants=1).decode(Encoder(MODEL, dropout=1.0).encode("abc ▁é")) == "abc ▁é"
    word = " international"
    assert len({tuple(encoder.word(word, v)) for v in range(16)}) > 3


def test_every_occurrence_is_drawn_for_itself():
    encoder, rng = Encoder(MODEL, dropout=0.1), np.random.default_rng(2)
    for word in (" the", " of", " international"):
        own = encoder.segment(word, ())[1]
        found = [encoder.encode(word, key) for key in range(4000)]
        want = [encoder.segment(word, np.nonzero(rng.random(99) < 0.1)[0].tolist())[1] for _ in range(4000)]
        assert own in found and found.count(own) < 4000
        assert abs(found.count(own) - want.count(own)) < 0.03 * 4000
        for text in (encoder.encode(word * 4000, 1), sum(found, [])):
            assert abs(len(text) - len(sum(want, []))) < 0.1 * 4000
    assert len({*map(tuple, found)}) > 20


def test_what_is_remembered_never_decides_the_draw():
    text = "".join(f" word{i % 7} international the" for i in range(300))
    forgetful, other = Encoder(MODEL, dropout=0.3, remembered=1), Encoder(MODEL, dropout=0.3)
    other.encode(text, 4)
    assert forgetful.encode(text, 5) == other.encode(text, 5)
    text = " internationalization" * 500
    assert other.encode(text, 9) == [i for ids in occurrences(other, text, 9) for i in ids]


def occurrences(encoder, text, key):
    """The ids of each chunk, run by itself with all its skips."""
    key = xxhash.xxh3_64_intdigest(text.encode(), key + encoder.seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for place, word in enumerate(CHUNK.findall(text)):
        yield encoder.segment(word, encoder.skips(key, place))[1] if len(word) <= 64 else encoder.word(word, key + place)


def plain_agenda(model, scores, word, skips):
    """Merge the best scored neighbours, leftmost of equals, but for the candidates in ``skips``; every step looks at all pairs."""
    parts, dead, taken = [(c, k) for k, c in enumerate(word.replace("▁", "\ud800").replace(" ", "▁"))], set(), 0
    while True:
        found = [(-scores[a[0] + b[0]], k) for k, (a, b) in enumerate(zip(parts, parts[1:]))
                 if a[0] + b[0] in scores and (a, b) not in dead]
        if not found:
            break
        at = min(found)[1]
        if taken in skips:
            dead.add((parts[at], parts[at + 1]))
        else:
            parts[at:at + 2] = [(parts[at][0] + parts[at + 1][0], parts[at][1])]
        taken += 1
    ids = []
    for part, start in parts:
        ids += [model.piece_to_id(part)] if part in scores else [
            model.piece_to_id(f"<0x{b:02X}>") for b in word[start].encode()]
    return taken, ids


def test_agenda_equals_one_that_looks_at_all_pairs(documents):
    import sentencepiece

    model, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), np.random.default_rng(5)
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    encoder = Encoder(MODEL, dropout=0.2, seed=1)
    words = [" the", " ▁ab▁", "  é漢字🙂x", " \x00\ta\x00", " internationalization", "aaaaaaaa", " ", "   ", " straße\n\nin"]
    words += [w for _, text, _ in documents[:3] for w in CHUNK.findall(text)[:40]]
    draws = np.sort(rng.integers(0, 14, (len(words), 5)) + np.arange(5) * 3, axis=1)
    taken, ids = encoder._runs(words, draws)
    for k, word in enumerate(words):
        want = plain_agenda(model, scores, word, set(draws[k].tolist()))
        assert want == encoder.segment(word, sorted({*draws[k].tolist()}))
        if len({*draws[k].tolist()}) == 5:
            assert want == (taken[k], np.frombuffer(ids[k], "<i4").tolist())


def test_whole_texts_equal_their_occurrences_one_by_one(documents):
    texts = [text or "" for _, text, _ in documents[:60]] + ["", " ", "▁ ▁▁ a▁b", "🙂 漢字 x" * 50, "z" * 200, " the" * 17_000]
    for dropout in (0.0, 0.1, 0.6):
        encoder = Encoder(MODEL, dropout=dropout, seed=2, remembered=3000)
        for key, (text, got) in enumerate(zip(texts, encoder.encode_many(texts, list(range(len(texts)))))):
            assert got.tolist() == [i for ids in occurrences(encoder, text, key) for i in ids], (dropout, key)
            assert encoder.decode(got.tolist()) == text


def test_long_chunks_skip_at_the_given_rate():
    encoder = Encoder(MODEL, dropout=0.1)
    text, rates = "internationalhousekeepingofunderstatements" * 40, []
    for key in range(40):
        seen = []
        skips = encoder.skips(key, 0)
        taken, ids = encoder.segment(text, (seen.append(at) or at for at in skips))
        assert encoder.decode(ids) == text
        rates.append(sum(at < taken for at in seen) / taken)
        assert len({tuple(encoder.word(text, v)) for v in (key, key + 1)}) == 2
    assert taken > 1000 and abs(np.mean(rates) - 0.1) < 0.005 and np.std(rates) < 0.015
    lengths = [len(encoder.word(text, v)) for v in range(40)]
    assert np.std(lengths) < 0.03 * np.mean(lengths)  # by 32 values per chunk it was 0.092
    some = ("▁ab éinternational house" * 2)[:60]  # the heap and the list are one method
    for key in range(50):
        short, long = list(some.replace(" ", "▁")), list(some.replace(" ", "▁"))
        assert encoder._short(short, encoder.skips(key, 1)) == encoder._long(long, encoder.skips(key, 1))


def test_encoding_odd_rows(odd_docs, no_docs):
    rows = encode_documents(odd_docs, MODEL).collect()
    assert len(rows) == 9 and all(r["lossless"] for r in rows)
    assert {len(r["ids"]) for r in rows if r["doc_id"] in (2, 3)} == {0}
    ids = [tuple(r["ids"]) for r in rows if r["doc_id"] == 1]
    assert len(ids) == 2 and ids[0] == ids[1]
    assert encode_documents(no_docs, MODEL).count() == 0


# ---- classifier

def test_held_out_labels_are_predicted(spark, sf):
    got = {r["doc_id"]: r for r in QUERIES["op10_quality_score"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for d, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(labels[d], got[d]["predicted"]) for d in labels if d in got and got[d]["held_out"]]
    assert len(held) > 50 and np.mean([a == b for a, b in held]) >= 0.9


def test_held_out_labels_are_never_learned_from(spark, sf):
    from pyspark.sql import functions as F

    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(cq.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert cq.fit(docs, labels) == cq.fit(docs, flipped)


def test_classifier_odd_rows(spark, sf, odd_docs, no_docs):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = cq.fit(docs, labels)
    rows = cq.score_documents(odd_docs, model).collect()
    assert len(rows) == 9 and all(0 <= r["score"] <= 1 for r in rows)
    assert cq.score_documents(no_docs, model).count() == 0
    assert cq.keep_good(odd_docs, model).columns == odd_docs.columns
    none = cq.fit(no_docs, labels)
    assert {r["score"] for r in cq.score_documents(odd_docs, none).collect()} == {1.0}
    tiny = cq.fit(odd_docs, spark.createDataFrame([(1, 1), (3, 0), (4, 0), (6, 1), (None, 1), (7, None)], "doc_id long, quality int"))
    assert all(0 <= r["score"] <= 1 for r in cq.score_documents(odd_docs, tiny).collect())


# ---- pipeline

def test_pipeline_follows_its_stages(spark, sf):
    from tests.llm.test_text_operators import brute_components, brute_fingerprint

    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    columns = docs.columns
    model = cq.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    scores = {r["doc_id"]: r["predicted"] for r in cq.score_documents(docs, model).collect()}
    good = corpus_pipeline.keep_quality(spark, docs, sf).cache()
    assert good.columns == columns
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    assert set(texts) == {d for d, p in scores.items() if p}
    unique = corpus_pipeline.drop_near_duplicates(spark, good, sf).cache()
    assert unique.columns == columns
    want = brute_components({d: brute_fingerprint(t) for d, t in texts.items()})
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted({*want.values()})
    clean = corpus_pipeline.redact_secrets(spark, unique, sf).cache()
    assert clean.columns == columns and clean.count() == unique.count()
    mixed = corpus_pipeline.mix_sources(spark, clean, sf)
    assert mixed.columns == columns
    times = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(clean).collect() if r["size"]}
    found = defaultdict(int)
    for r in mixed.select("doc_id").collect():
        found[r["doc_id"]] += 1
    assert dict(found) == {d: n for d, n in times.items() if n}
    out = corpus_pipeline.run(spark, sf).collect()
    assert len(out) == sum(found.values()) and all(r["lossless"] for r in out)
