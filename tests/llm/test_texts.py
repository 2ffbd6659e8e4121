"""Word hashing, byte-level BPE and edit-aware counts against plain versions."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from postloom.llm import bpe, queries, textops, token_counts
from postloom.llm.queries import RANKS

PATH, PATTERN = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
PARTS = ["hello", " ", "  ", "\n", "'s", "'", "re", "It's", " 12", ",", "!!", "é", "日本", "🙂", "\t", " word", "\x00", "ǅ", "　", "́"]


@pytest.fixture(scope="module")
def plain():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def model():
    return bpe.codec(PATH, PATTERN)


def texts(n, seed, longest=60):
    r = random.Random(seed)
    return ["".join(r.choice(PARTS) for _ in range(r.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [16, 1 << 20])
def test_words_are_those_of_split(monkeypatch, chunk):
    known = {}
    samples = [None, "", " ", "a", "A b", "x" * 50 + " y", *texts(300, 1)]
    monkeypatch.setattr(textops, "CHUNK_BYTES", chunk)
    seen = 0
    for group in textops.words(pa.array(samples)):
        for i in range(len(group)):
            expected = (samples[group.first + i] or "").encode().lower().split()
            found = group.hashes[group.bounds[i] : group.bounds[i + 1]]
            assert len(found) == len(expected)
            for word, h in zip(expected, found):
                assert known.setdefault(word, int(h)) == int(h)
            seen += 1
    assert seen == len(samples)
    assert len(set(known.values())) == len(known)


def test_sliced_column_and_no_rows():
    column = pa.array(["a b", "c", "d e f"]).slice(1, 2)
    assert [list(np.diff(g.bounds)) for g in textops.words(column)] == [[1, 3]]
    assert list(textops.words(pa.array([], pa.string()))) == []


def test_short_texts_are_one_shingle():
    (group,) = textops.words(pa.array(["a b", "a b c", "a b c a b c"]))
    sets = [textops.shingle_set(group.hashes[group.bounds[i] : group.bounds[i + 1]], 3) for i in range(3)]
    assert [len(s) for s in sets] == [1, 1, 3]
    assert sets[0][0] != sets[1][0] and sets[1][0] in sets[2]


def test_encodes_as_tiktoken(model, plain):
    for text in texts(3000, 2):
        ids = model.encode(text)
        assert ids == plain.encode_ordinary(text)
        assert model.decode(ids) == text.encode()
        assert model.ends(ids) == np.cumsum([len(plain.decode_single_token_bytes(i)) for i in ids]).tolist()


def test_long_text_is_read_in_parts(model, plain, monkeypatch):
    text = "".join(texts(200, 3))
    monkeypatch.setattr(bpe, "SHORT", 10)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 7)
    assert model.encode(text) == plain.encode_ordinary(text)


def test_encoding_cases(spark, plain):
    rows = [(1, None, "x"), (2, "", "x"), (None, "null id", "x"), (3, "same", "x"), (3, "same", "x"), (4, "word " * 30000, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    found = bpe.encode_digests(docs, PATH, PATTERN).collect()
    assert len(found) == 6
    for (i, text, _), r in zip(sorted(rows, key=str), sorted(found, key=lambda r: str((r.doc_id, None)))):
        assert r.round_trip
    by_id = {r.doc_id: r for r in found}
    nothing = hashlib.sha256(b"").hexdigest()
    assert (by_id[1].n_tokens, by_id[1].ids_sha256, by_id[1].decoded_sha256) == (0, nothing, nothing)
    ids = plain.encode_ordinary("word " * 30000)
    assert by_id[4].n_tokens == len(ids)
    assert by_id[4].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    encoded = bpe.encode(docs, PATH, PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(encoded, PATH, PATTERN).collect()}
    assert back[None] == b"null id" and back[1] == b""
    assert bpe.encode_digests(docs.limit(0), PATH, PATTERN).count() == 0


def test_op9_whole_table(spark, sf_dir, plain):
    texts_of = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op9_byte_bpe(spark, sf_dir).collect()
    assert len(found) == len(texts_of)
    for r in found:
        ids = plain.encode_ordinary(texts_of[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts_of[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("leaf", [1, 3, 32])
def test_edits_count_as_a_fresh_encoding(model, plain, monkeypatch, leaf):
    monkeypatch.setattr(token_counts, "LEAF_PIECES", leaf)
    r = random.Random(leaf)
    for text in texts(300, leaf):
        tree = token_counts.build_tree(text, model)
        for insert in texts(4, r.random(), 12):
            start, removed = r.randint(0, len(text) + 2), r.randint(0, 9)
            expected = text[: min(start, len(text))] + insert + text[min(start, len(text)) + removed :]
            text, tree, _ = token_counts.apply_edit(text, tree, model, start, removed, insert)
            assert text == expected
            assert tree.tokens[1] == len(plain.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_an_edit_encodes_only_its_surroundings(model):
    text = "some words, and more of them " * 5000
    tree = token_counts.build_tree(text, model)
    _, _, encoded = token_counts.apply_edit(text, tree, model, 70000, 3, "changed")
    assert 0 < encoded < 4 * token_counts.LEAF_PIECES


def test_edit_cases(spark, plain):
    edits = "array<struct<start:bigint,removed:bigint,inserted:string>>"
    rows = [
        (1, None, [(0, 0, "new text")]), (2, "", None), (3, "stay", [(None, 1, "x"), (2, None, None)]),
        (None, "abc", [(1, 99, "z")]), (4, "same", []), (4, "same", []),
    ]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, changes {edits}")
    from pyspark.sql import functions as F

    found = token_counts.edit(docs, PATH, PATTERN, F.col("changes"), texts=True).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == [("1", "new text"), ("2", ""), ("3", "stay"), ("4", "same"), ("4", "same"), ("None", "az")]
    for r in found:
        assert r.n_tokens == len(plain.encode_ordinary(r.text))
    trees = token_counts.build(docs.select("doc_id", "text").filter("doc_id < 4"), PATH, PATTERN)
    stored = docs.filter("doc_id < 4").join(trees, "doc_id")
    again = token_counts.edit(stored, PATH, PATTERN, F.col("changes"), stored_trees=True).collect()
    assert {r.doc_id: r.n_tokens for r in again} == {r.doc_id: r.n_tokens for r in found if r.doc_id in (1, 2, 3)}
    assert token_counts.edit(docs.limit(0), PATH, PATTERN, F.col("changes")).count() == 0


def test_op5_whole_table(spark, sf_dir, plain):
    """Every document's counts equal those of a fresh encoding of the edited text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prepared = docs.select("doc_id", "text", queries.sample_edits().alias("changes")).collect()
    expected = {}
    for r in prepared:
        text = r.text
        for e in r.changes:
            at = min(e.start, len(text))
            text = text[:at] + e.inserted + text[at + e.removed :]
        expected[r.doc_id] = (len(plain.encode_ordinary(r.text)), len(plain.encode_ordinary(text)))
    found = {r.doc_id: (r.n_tokens_before, r.n_tokens) for r in queries.op5_token_counts(spark, sf_dir).collect()}
    assert found == expected
