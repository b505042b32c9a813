"""The pipeline's stages and its final rows against plain versions of each."""

import re
import zlib

import numpy as np
from test_decontaminate import _brute
from tokenizers import Tokenizer

import corpus_pipeline
from rollscore.llm import mixing, tokenfiles, toxicity

SF = "/root/testdata/sf0.001"


def _first_of_near_copies(rows, size=5, percent=80):
    """The rows that stay: blank ones and the smallest doc_id of each component."""
    sets = {}
    for i, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets[i] = {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            same = len(sets[i] & sets[j]) if i < j else 0
            if same and 100 * same >= percent * (len(sets[i]) + len(sets[j]) - same):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return [(i, t) for i, t in rows if label[i] == i]


def _plain_rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_every_stage_against_a_plain_version(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)

    rejected = {r.doc_id for r in toxicity.report(documents, labels).where("predicted = 1").select("doc_id").collect()}
    clean = documents.where(~documents.doc_id.isin(rejected)) if rejected else documents
    got = stages["toxicity"](spark, documents, SF)
    assert got.columns == documents.columns
    assert rejected and _plain_rows(got) == _plain_rows(clean)

    alone = _first_of_near_copies(_plain_rows(clean))
    got = stages["near_duplicates"](spark, clean, SF)
    assert got.columns == documents.columns
    assert _plain_rows(got) == alone

    kept = [r for r in alone if not _brute([r], items)[0][2]]
    single = clean.where(clean.doc_id.isin([i for i, _ in alone]))
    got = stages["decontaminate"](spark, single, SF)
    assert got.columns == documents.columns
    assert len(kept) < len(alone) and _plain_rows(got) == kept

    # run() gives the token rows of what the plain versions keep, in the order of the mixture.
    texts, tok, at, wanted = dict(kept), Tokenizer.from_file(tokenfiles.tokenizer_file()), 0, []
    order = mixing.report(documents.where(documents.doc_id.isin(list(texts)))).orderBy("position").collect()
    assert {r.doc_id for r in order} == set(texts)
    for r in order:
        ids = np.array([*tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        wanted.append((r.doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    rows = corpus_pipeline.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted((tuple(r) for r in rows), key=lambda r: r[1]) == wanted


def test_nulls_repeats_further_columns_and_empty_tables(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "a"), (1, long, "a"), (2, long + " end", "a"), (3, None, None), (None, None, None), (4, "", "b"),
            (5, "own words here", "b"), (None, "own words here", "b"), (6, "x " * 30_000, "a")]
    names = "doc_id long, text string, source string, __copies int, __row string, __hash int, __score long"
    docs = spark.createDataFrame([(*r, 1, "w", 2, 3) for r in rows], names)
    docs = docs.selectExpr("*", "cast('en' as string) as lang", "cast(0 as long) as n_chars")
    for case, table in (("full", docs), ("empty", docs.where("false"))):
        sf = f"{tmp_path}/{case}"
        table.write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame([(1, 0)], "doc_id long, toxic long").where("false").write.parquet(f"{sf}/labels.parquet")
        spark.createDataFrame([(1, "never seen words")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
        got = corpus_pipeline.run(spark, sf).collect()
        ids = {r.doc_id for r in got}
        assert ids == ({1, 3, None, 4, 5, 6} if case == "full" else set())
