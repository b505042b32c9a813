import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rollscore.llm import tokenfiles
from rollscore.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def expected(rows):
    tok, out, at = Tokenizer.from_file(tokenfiles.tokenizer_file()), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_query_against_whole_text_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert got(QUERIES["op7_token_files"](spark, SF)) == expected([(r.doc_id, r.text) for r in docs.collect()])


ODD = ["", None, "   \n", "it's they'LL 'd don't", "a<|endoftext|>b c<|startoftext|>", "é e ́x", "ÀÉÎ ß Straße ÿ", "x\x1cy\x0bz\x0c w v",
       "１２ ²³ ½ 10,000.50", "ΣΑΣ İstanbul ﬁ ǅ", "日本語 テスト 한국어", "a_b __ ++--", "\x00\x01 ok", "🙂👍🏽 fin", "w" * 5000, "ab " * 60000]


@pytest.mark.parametrize("kind", [1, 8])
def test_odd_texts_ties_and_nulls(spark, kind):
    rows = [(i % 13 or None, t, "x") for i, t in enumerate(ODD * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)
    assert got(tokenfiles.report(df, kind=kind, block_ids=1000)) == expected([r[:2] for r in rows])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfiles.report(df).collect() == []


@pytest.mark.parametrize("kind", [1, 8])
@pytest.mark.parametrize("n", [1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    assert (tokenfiles.from_planes(tokenfiles.to_planes(ids, kind), n, kind) == ids).all()


def test_chunks_are_numbered_over_many_texts():
    """A chunk is encoded once for all texts of a batch; contractions and null texts agree with the whole tokenizer."""
    tok, encoder = Tokenizer.from_file(tokenfiles.tokenizer_file()), tokenfiles.Encoder(tokenfiles.tokenizer_file())
    texts = ["", None, "can't CAN'T 'tis x''s !'s a's'll", "re\x0bad\x0c it", "a<b <|endoftext|>", "été 3,5", *["same words, same"] * 50]
    seen, fill = [], encoder._chunk
    encoder._chunk = lambda chunk: seen.append(chunk) or fill(chunk)
    got = [list(np.frombuffer(x, "<u4")) for x in encoder.encode_all(pa.array(texts))]
    assert got == [tok.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(seen) == len(set(seen))
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
    assert [len(x) for x in encoder.encode_all(pa.array(["skip this", "", " \n", None, "a"])[1:])] == [0, 0, 0, 4]
