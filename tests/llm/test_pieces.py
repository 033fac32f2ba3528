import hashlib

import numpy as np
import public_tokenizers
import sentencepiece

from millrace.llm import pieces, queries

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CASES = [None, "", " ", "  a  b ", "\n\n", "a\x00b", "日本語テキスト" * 50, "😀x", "▁▁a ▁", "<s></s> <0x41>", "\t\t x", "x" * 3000,
         " " * 500 + "y", "a\r\nb", "  \n  z", "don't stop, x² . e.g. 3.14 (s) :-) _a_b", "word " * 60_000,
         " ".join(f"w{n}é" for n in range(120_000)), "ﬁ Å ñ हिन्दी ภาษาไทย"]


def test_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.createDataFrame([(n, t, 0) for n, t in enumerate(CASES)] + [(None, "a b", 1), (3, "  a  b ", 1)],
                                 "doc_id long, text string, ids int")
    got = pieces.encode_decode(docs, MODEL).collect()
    assert len(got) == len(CASES) + 2
    texts = dict(enumerate(CASES)) | {None: "a b"}
    for row in got:
        want = sp.encode(texts[row.doc_id] or "", add_bos=True, add_eos=True)
        assert np.frombuffer(row.ids, "<u4").tolist() == want and row.n_tokens == len(want)
        assert row.decoded == sp.decode(want)
    assert pieces.encode_decode(docs.limit(0), MODEL).count() == 0


def test_generations_stay_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_SEGMENTS", 50)
    encoder = pieces.MergeEncoder(open(MODEL, "rb").read())
    for n in range(300):
        text = f"common words and rare{n} one{n * 7}"
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == encoder.library.encode(
            text, add_bos=True, add_eos=True)
        assert len(encoder.young) <= 60 and len(encoder.old) <= 60


def test_query_on_the_table(spark):
    folder = "/root/testdata/sf0.001"
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = sp.encode(r.text or "", add_bos=True, add_eos=True)
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                          hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in queries.op6_sentencepiece(spark, folder).collect()} == want
