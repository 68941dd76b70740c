"""Byte-level BPE with forced boundaries against the tokenizers library."""

import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from bedwatch.llm.byte_merges import Encoder, Vocabulary, decode_documents, digest, encode_documents
from bedwatch.llm.queries import QUERIES, vocabulary


@pytest.fixture(scope="module")
def file():
    return vocabulary("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library(file):
    return Tokenizer.from_file(file)


@pytest.fixture(scope="module")
def encoder(file):
    return Encoder(file)


def test_query_equals_the_library_on_all_documents(spark, sf, documents, library):
    got = {r["doc_id"]: r for r in QUERIES["op12_byte_bpe"](spark, sf).collect()}
    assert len(got) == len(documents)
    for doc_id, text, _ in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        r = got[doc_id]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


PARTS = ["'", "s", "t", "re", "ve", "m", "ll", "d", "'s", " ", "  ", "\n", "\t", "\r\n", "a", "B", "é", "ß", "1", "²", "½", "Ⅷ", "!",
         "…", "中", "文", "🙂", "　", "́", "‍", "<|endoftext|>", "<|", "ا", "\x00", "\x85", "​", "’", "the", " quick",
         "՘", "₏", "\U000107bb"]


def test_nasty_strings_equal_the_library(encoder, library):
    rng = random.Random(3)
    for _ in range(8000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        ids = encoder.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        spelled = b"".join(encoder.vocabulary.raw[i] for i in ids).decode("utf-8", "replace")
        assert spelled == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["ab" * 20000, "a" * 3000, " " * 5001 + "x", "'" * 999, "中文字典" * 2000,
                                  "".join(random.Random(1).choices("abcdefgh", k=9000))])
def test_long_units_are_merged_by_the_agenda(encoder, library, text):
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_scan_and_agenda_agree(encoder):
    rng = random.Random(5)
    for _ in range(3000):
        ids = [encoder.vocabulary.byte_ids[b] for b in rng.choices(b"thequickanders ", k=rng.randint(0, 24))]
        assert encoder._scan(list(ids)) == encoder._agenda(list(ids))


def test_no_token_spans_a_certain_cut(encoder):
    v = encoder.vocabulary
    assert encoder.forced.any() and v.inside.any()
    assert encoder.forced[ord("e") << 8 | ord(" ")] and not encoder.forced[ord("t") << 8 | ord("h")]
    for token in v.raw[:50256]:
        assert not any(encoder.forced[a << 8 | b] for a, b in zip(token, token[1:]))


def test_certain_cuts_bound_the_fragments_of_long_units(encoder):
    """A unit without blanks is cut where the vocabulary has no token across, so fragments do not grow with it."""
    text = "".join(random.Random(2).choices("的一是不了人我在有他这", k=4000))
    edges = encoder.cuts(text, text.encode())
    assert max(edges[1:] - edges[:-1]) < 200


def test_forgetting_changes_nothing(file, encoder, documents):
    small = Encoder(file, remembered=50)
    for _, text, _ in documents[:60]:
        assert small.encode(text).tolist() == encoder.encode(text).tolist()


def test_odd_rows(spark, odd_docs, no_docs, file, library):
    rows = decode_documents(encode_documents(odd_docs, file), file).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["ids"] == library.encode(r["text"], add_special_tokens=False).ids
    assert sorted(r["text"] for r in rows) == sorted(r["text"] or "" for r in odd_docs.collect())
    got = {r["doc_id"]: r for r in digest(decode_documents(encode_documents(odd_docs, file), file)).collect()}
    assert got[2]["n_tokens"] == got[3]["n_tokens"] == 0
    assert got[2]["ids_sha256"] == got[2]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert digest(decode_documents(encode_documents(no_docs, file), file)).count() == 0


def test_decoding_any_ids(spark, file, library):
    rows = [(1, None), (2, []), (3, [50256, 198, 162]), (4, [162, 162, 50256]), (5, [-3, 40, 99_999])]
    got = {r["doc_id"]: r["text"] for r in
           decode_documents(spark.createDataFrame(rows, "doc_id long, ids array<int>"), file).collect()}
    assert got[1] == got[2] == ""
    assert got[3] == library.decode([50256, 198, 162], skip_special_tokens=False)
    assert got[4] == library.decode([162, 162, 50256], skip_special_tokens=False)
    assert got[5] == library.decode([40], skip_special_tokens=False)


@pytest.mark.parametrize("change", [{"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None},
                                    {"model": {"type": "WordLevel", "vocab": {}}}])
def test_other_tokenizers_are_refused(tmp_path, file, change):
    spec = json.load(open(file)) | change
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="byte-level"):
        Vocabulary(str(other))
