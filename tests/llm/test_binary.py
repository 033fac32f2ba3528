import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import binary, queries, wavelet

MODEL = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(MODEL)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1000, 2), (70_000, 50_257), (200_001, 70_000), (65_536, 1)])
def test_wavelet_answers_equal_the_array(n, top):
    ids = np.random.default_rng(n).zipf(1.3, n) % top if n else np.empty(0, np.int64)
    shard = wavelet.Shard(wavelet.write_shard([7, None], np.array([n - n // 3, n // 3]), ids.astype(np.uint32)))
    assert (shard.tokens() == ids).all() and shard.n == n and shard.doc_ids() == [7, None]
    assert shard.ends().tolist() == [n - n // 3, n]
    for at in [0, n // 2, n - 1] if n else []:
        token = int(ids[at])
        assert shard.access(at) == token and shard.rank(token, at) == int((ids[:at] == token).sum())
        places = np.flatnonzero(ids == token)
        assert shard.count(token) == len(places)
        assert [shard.select(token, k) for k in (0, len(places) - 1)] == [places[0], places[-1]]
    assert shard.count(1 << 20) == 0
    with pytest.raises(IndexError):
        shard.access(n)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), max_size=300))
def test_wavelet_on_any_sequence(ids):
    shard = wavelet.Shard(wavelet.write_shard([1], np.array([len(ids)]), np.array(ids, np.uint32)))
    assert shard.tokens().tolist() == ids == [shard.access(k) for k in range(len(ids))]
    for token in set(ids):
        places = [k for k, x in enumerate(ids) if x == token]
        assert [shard.select(token, k) for k in range(len(places))] == places


def test_planes_of_text_are_shorter_than_their_ids():
    ids = np.array(ids_of("the cat sat on the mat and the dog ran to the park . " * 4000), np.uint32)
    assert len(wavelet.write_shard([1], np.array([len(ids)]), ids)) < len(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\r\x0b\x1c\x85\xa0 　abé'1s.<|>日😀"), max_size=40))
def test_segments_encode_as_the_whole_text(text):
    code = binary.encoder(open(MODEL).read())
    for coded, t in zip(code.encode([text, text + " a", ""]), [text, text + " a", ""]):
        assert np.frombuffer(coded, "<u4").tolist() == ids_of(t)[:-1]


def test_special_tokens_and_other_vocabularies():
    text = "a <|endoftext|> b<|endoftext|>c  <|endoftext|>"
    assert np.frombuffer(binary.SegmentEncoder(open(MODEL).read()).encode([text])[0], "<u4").tolist() == ids_of(text)[:-1]
    words = public_tokenizers.path("word_bpe_49k.json")
    other = binary.SegmentEncoder(open(words).read())
    assert not other.cuts
    whole = Tokenizer.from_file(words).encode("Some WORDS  here", add_special_tokens=False).ids
    assert np.frombuffer(other.encode(["Some WORDS  here"])[0], "<u4").tolist() == whole


def test_segments_of_many_texts_are_looked_up_once(monkeypatch):
    """Cost follows the different segments of a slice, not all its segments, and texts do not run into each other."""
    code, seen = binary.SegmentEncoder(open(MODEL).read()), []
    looked_up = code._looked_up
    monkeypatch.setattr(code, "_looked_up", lambda segments: seen.extend(segments) or looked_up(segments))
    texts = ["one two, three.\nFour", "", "two, three", ".\n", "\nfour three", "\u2003 \u00e9 ,a"] * 500
    for coded, t in zip(code.encode(texts), texts, strict=True):
        assert np.frombuffer(coded, "<u4").tolist() == ids_of(t)[:-1]
    assert len(seen) == len(set(seen)) < 20 and {" two", ",", " three"} <= set(seen)


def test_added_tokens_are_not_cut():
    given = Tokenizer.from_file(MODEL)
    given.add_tokens(["a.b"])
    code = binary.SegmentEncoder(given.to_str())
    for t in ["a.b", "x a.b a. b", "aa.bb"]:
        assert np.frombuffer(code.encode([t])[0], "<u4").tolist() == given.encode(t, add_special_tokens=False).ids


def test_generations_stay_bounded(monkeypatch):
    monkeypatch.setattr(binary, "CACHED_SEGMENTS", 50)
    code = binary.SegmentEncoder(open(MODEL).read())
    for n in range(200):
        text = f"common words and rare{n} one{n * 7}"
        assert np.frombuffer(code.encode([text])[0], "<u4").tolist() == ids_of(text)[:-1]
        assert len(code.young) <= 60 and len(code.old) <= 60


@pytest.mark.parametrize("shard_tokens", [1 << 22, 50])
def test_documents_in_order(spark, monkeypatch, shard_tokens):
    rows = [(n * 7 % 101, f"text {n} " * (n % 9), "x") for n in range(101)]
    rows += [(None, "no id", "x"), (None, None, "x"), (5, None, "y"), (6, "", None), (500, "very long words " * 40_000, "x"), (7, "b", "x"), (7, "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string")
    real = binary._write

    def small(*given):
        monkeypatch.setattr(binary, "SHARD_TOKENS", shard_tokens)
        run = real(*given)

        def bounded(batches):
            binary.SHARD_TOKENS = shard_tokens
            yield from run(batches)
            binary.SHARD_TOKENS = 1 << 22
        return bounded

    monkeypatch.setattr(binary, "_write", small)
    folder, shards = binary.write_tokens(docs, MODEL)
    got = sorted(binary.read_documents(folder, shards, with_ids=True).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) and [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda d: -1 if d is None else d)
    want = sorted((repr(i), len(ids_of(t)), zlib.crc32(np.array(ids_of(t), "<u4").tobytes())) for i, t, _ in rows)
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    assert {r.token: r.n for r in binary.count_tokens(folder, shards, [0, 5239, 50_000]).collect()} == {
        t: int((every == t).sum()) for t in (0, 5239, 50_000)}
    found = binary.find_token(folder, shards, 0).collect()
    assert sorted(r.place for r in found) == np.flatnonzero(every == 0).tolist()
    assert sorted(repr(r.doc_id) for r in found) == sorted(repr(r[0]) for r in rows)


def test_a_missing_shard_ends_the_job(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    folder, shards = binary.write_tokens(docs, MODEL)
    with pytest.raises(Exception, match="No such file|FileNotFound"):
        binary.read_documents(folder + "-gone", shards).collect()
    folder, shards = binary.write_tokens(docs.limit(0), MODEL)
    assert binary.read_documents(folder, shards).count() == 0


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    at, want = 0, set()
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = ids_of(r.text)
        want.add((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert {tuple(r) for r in queries.op13_token_output(spark, folder).collect()} == want
