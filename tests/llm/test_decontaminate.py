"""Benchmark decontamination against its SQL and a plain search of every window."""

import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest

from rollscore.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def _words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def _brute(documents, items):
    windows = {}
    for item, text in items:
        words = _words(text)
        n = min(len(words), 10)
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in documents:
        words, hit, found = _words(text), set(), set()
        for n in range(1, 11):
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(words[i : i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def _rows(seed):
    rng = random.Random(seed)
    plain = lambda n: " ".join(rng.choice("alpha Beta gamma, delta été 7x n° Ω".split()) for _ in range(n))
    passages = [plain(n) for n in (10, 14, 15, 30, 9, 3, 1, 200)]
    items = [(i, p) for i, p in enumerate(passages)]
    items += [(0, passages[0]), (2, "a second text under one item of eleven words and no more"), (None, passages[3]),
              (90, None), (91, ""), (92, " ,;- "), (93, "same " * 40), (10, passages[1]), (9, passages[1])]
    docs = [(i, " ".join([plain(rng.randrange(20)), rng.choice(passages).upper(), plain(5)])) for i in range(60)]
    docs += [(i, " ".join(p.split()[k : k + rng.choice((9, 10, 11))])) for i, p in enumerate(passages, 100) for k in (0, 2)]
    docs += [docs[0], docs[0], (0, "same " * 25), (None, passages[3]), (None, passages[3]), (None, None),
             (300, None), (301, ""), (302, "..."), (303, "same " * 9), (304, plain(20_000) + " " + passages[3]),
             (305, " -- ".join(passages[1].split())), (306, "no such words " * 400)]
    return docs, items


def _frames(spark, docs, items):
    # Names that the operator uses itself come along as further columns.
    d = [(i, t, "x", 1, [0], "y") for i, t in docs]
    b = [(i, t, "x", 1, "z") for i, t in items]
    return (
        spark.createDataFrame(d, "doc_id long, text string, words string, pos int, grams array<int>, fp string").repartition(4),
        spark.createDataFrame(b, "item_id long, text string, words string, fp int, icontext string"),
    )


@pytest.mark.parametrize("seed,broadcast_bytes", [(0, decontaminate.BROADCAST_BYTES), (1, 0)])
def test_against_every_window(spark, seed, broadcast_bytes):
    docs, items = _rows(seed)
    documents, benchmark = _frames(spark, docs, items)
    found = decontaminate.decontaminate(documents, benchmark, broadcast_bytes).collect()
    got = [
        (r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0) for r in found
    ]
    assert sorted(got, key=repr) == _brute(docs, items)
    assert sorted((tuple(r) for r in decontaminate.report(documents, benchmark).select(COLUMNS).collect()), key=repr) == _brute(docs, items)


def test_sql_gives_the_same_rows(spark):
    docs, items = _rows(2)
    docs = [r for r in docs if r[0] is not None and len(r[1] or "") < 10_000]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame([r for r in items if r[0] is not None], columns=["item_id", "text"]))
    got = con.sql(decontaminate.ORACLE).df()[COLUMNS].itertuples(index=False, name=None)
    assert sorted(got, key=repr) == _brute(docs, [r for r in items if r[0] is not None])


def test_clean_keeps_the_other_rows(spark):
    docs, items = _rows(3)
    documents, benchmark = _frames(spark, docs, items)
    hit = {(r[0], t) for (i, t) in docs for r in _brute([(i, t)], items) if r[2]}
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted((r for r in docs if r not in hit), key=repr)


def test_empty_tables(spark):
    docs, items = _rows(4)
    documents, benchmark = _frames(spark, docs, items)
    assert decontaminate.report(documents.where("false"), benchmark).count() == 0
    assert sorted((tuple(r) for r in decontaminate.report(documents, benchmark.where("false")).collect()), key=repr) == _brute(docs, [])
    assert decontaminate.clean(documents, benchmark.where("false")).count() == len(docs)
