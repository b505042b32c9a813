"""op6's chain against enumeration, scores that depend on the text alone, samples, and components with a giant hub."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollscore.llm import graph, language, secrets, tokenfiles, toxicity
from rollscore.llm.storage import Workspace

SF001 = "/root/testdata/sf0.001"


def enumerated(e, starts, moves, start):
    """Marginals by summing over all assignments of each document."""
    bounds = [*np.flatnonzero(starts).tolist(), len(e)]
    out = np.zeros(len(e))
    for a, b in zip(bounds, bounds[1:]):
        total, hit = 0.0, np.zeros(b - a)
        for states in itertools.product((0, 1), repeat=b - a):
            s = start[states[0]] + sum(moves[i, j] for i, j in zip(states, states[1:])) + sum(e[a + k] for k in range(b - a) if states[k])
            total += np.exp(s)
            hit += np.exp(s) * np.array(states)
        out[a:b] = hit / total
    return out


@pytest.mark.parametrize("seed", range(60))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 9, rng.integers(1, 6))
    starts = toxicity._first_words(lengths)
    e, moves, start = rng.normal(0, 2, lengths.sum()), rng.normal(0, 1.5, (2, 2)), rng.normal(0, 1, 2)
    chain = toxicity.Chain(None, None, None, 0.0, moves, start, np.zeros(3))
    assert np.allclose(toxicity.marginals(e, starts, chain), enumerated(e, starts, moves, start), atol=1e-12)


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    return toxicity.fit(docs, labels)


def test_a_text_scores_the_same_alone_and_in_any_batch(spark, model):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = [r.text or "" for r in docs.select("text").collect()] + ["", " ", "one", "word " * 5000]
    alone = [float(toxicity.score_texts([t], toxicity.Lexicon(model))[0][0]) for t in texts]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    together = toxicity.score_texts([texts[i] for i in order], toxicity.Lexicon(model))[0]
    assert np.allclose([alone[i] for i in order], together, atol=1e-9, rtol=0)
    by_parts = [{tuple(r) for r in toxicity.score(docs.repartition(n), model, ["doc_id"]).select(
        "doc_id", F.round("__score", 8)).collect()} for n in (3, 17)]
    assert by_parts[0] == by_parts[1]


def test_offsets_name_the_offending_words(spark, model):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = toxicity.report(docs, labels).join(docs, "doc_id").where("n_spans > 0").collect()
    assert rows
    for r in rows:
        assert len(r.spans) == r.n_spans
        for s in r.spans:
            assert r.text[s.start:s.stop].strip() == r.text[s.start:s.stop] != ""


@pytest.mark.parametrize("rows", [
    [], [(1, "only clean", 0)], [(1, "only bad", 1), (3, "also bad", 1)], [(1, "torn", 0), (1, "torn", 1)]])
def test_labels_of_one_class_or_none(spark, rows):
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(d, t, 9) for d, t, _ in rows] + [(2, None, 9), (2, "", 9), (4, "x" * 300_000, 9)],
                                 "doc_id long, text string, score int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == len(rows) + 3 and all(0 <= r.score <= 1 for r in got)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.report(docs, labels).count() == 0 and language.report(docs).count() == 0


def test_long_texts_are_learned_from(spark):
    """A text is in the sample whatever its length; the sample ends once its bytes are reached."""
    rows = [(i, i % 2, i, 3 << 20 if i < 4 else 10) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, toxic int, h long, size int")
    got = toxicity._first(df, 0, 100).collect()
    sizes = {r.doc_id: dict((x[0], x[3]) for x in rows)[r.doc_id] for r in got}
    assert 2 <= len(got) <= 100 and sum(sizes.values()) <= toxicity.TRAIN_BYTES + (3 << 20)
    assert toxicity._first(df.where("size > 10"), 1, 100).count() == 2


def test_language_sample_is_that_of_one_plain_ranking(spark):
    rows = [(i, "ab"[i % 3 == 0], i, 100) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, h long, size int")
    got = {(r.doc_id, r.lang) for r in language._chosen(df, 700).collect()}
    keyed = df.withColumn("k", F.xxhash64("doc_id")).collect()
    want = {(r.doc_id, r.lang) for c in "ab" for r in sorted((x for x in keyed if x.lang == c), key=lambda x: (x.k, x.doc_id))[:700]}
    assert got == want


def test_language_rows_of_words_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    model = language.Model(["a", "b"], rng.normal(size=(language.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    text = "Ein Haus, das 12 -- (Haus) 3x ... straße"
    plain = sum((model.table[language.subwords(t)].sum(axis=0, dtype="f8") for t in text.split()), np.zeros(2))
    grams = sum(len(language.subwords(t)) for t in text.split())
    words = language.Words(model)
    words.totals("viele andere Worte zuvor 5".split())
    assert np.allclose(words.totals(text.split()), [*plain, grams], atol=1e-4)
    assert words.totals([]).tolist() == [0, 0, 0]


def test_components_of_a_giant_hub_and_a_long_path(spark):
    edges = [(0, i) for i in range(1, 3000)] + [(10_000 + i, 10_001 + i) for i in range(200)] + [(2999, 50_000), (60_000, 60_000)]
    random.Random(2).shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {(r.a, r.b) for r in graph.components(Workspace(spark, "graph-test"), df, "c").collect()}
    want = {(i, 0) for i in range(1, 3000)} | {(50_000, 0)} | {(10_000 + i, 10_000) for i in range(1, 201)}
    assert got == want


def test_piece_counts_are_of_distinct_texts(spark):
    text = "the harbour lights were seen from the harbour wall"
    copies = [(i, text) for i in range(500)] + [(1000 + i, f"harbour number{i} wall") for i in range(6)] + [(None, None)]
    docs = spark.createDataFrame(copies, "doc_id long, text string").withColumn("piece", F.lit("clash"))
    found = spark.createDataFrame([("harbourwall_lights_0", 1)], "candidate string, n int")
    got = secrets.coverage(found, docs, Workspace(spark, "secrets-test")).collect()
    assert got == []  # "harbourwall" is no word, "lights" stands in one distinct text only
    found = spark.createDataFrame([("harbour_wall_lights_0", 1)], "candidate string, n int")
    got = secrets.coverage(found, docs, Workspace(spark, "secrets-test")).collect()
    assert [(r.candidate, r.covered) for r in got] == [("harbour_wall_lights_0", len("harbour") + len("wall"))]


def test_other_tokenizers_encode_whole_texts():
    import os

    path = os.path.join(os.path.dirname(tokenfiles.tokenizer_file()), "byte_bpe_50k.json")
    encoder = tokenfiles.Encoder(path)
    text = "It's  a\n\ttest of 123 words"
    assert not encoder.by_words and tokenfiles.Encoder(tokenfiles.tokenizer_file()).by_words
    assert encoder.encode(text) == np.array(encoder.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_the_memory_of_words_keeps_frequent_ones(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CACHE_ENTRIES", 10)
    asked = []
    memo = tokenfiles._Memo(lambda k: asked.append(k) or k.encode())
    for i in range(200):
        assert memo["often"] == b"often" and memo[f"rare{i}"] == f"rare{i}".encode()
    assert asked.count("often") == 1 and len(memo) + len(memo.old) <= 20
