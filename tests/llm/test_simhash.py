"""op13: fingerprints by hand and components against comparing all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from rollscore.llm import simhash
from rollscore.llm.storage import Workspace

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def plain_print(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    fps = np.array(prints, dtype="u8")
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 3) + i + 1:
            root[find(i)] = find(int(j))
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


def expected(rows):
    prints = [plain_print(t) for _, t in rows]
    low = components(prints, [d for d, _ in rows])
    return sorted(((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints, low)), key=str)


@pytest.mark.parametrize("folder", [SF001, SF01])
def test_whole_table_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in simhash.report(docs).collect()), key=str) == want


def test_defined_cases(spark):
    long = " ".join(f"w{i % 977} q{i % 1009}" for i in range(200_000))
    rows = [(1, None), (2, ""), (3, " \t\x0b"), (4, "Ein"), (5, "ein"), (5, "ein"), (6, "A b cÄ D e"), (7, long),
            (8, long), (None, "ein"), (None, "only null"), (9, "zwei wörter"), (9, "other text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS fp", "1 AS part", "2 AS cell")
    got = sorted((tuple(r) for r in simhash.report(docs).collect()), key=str)
    assert got == expected(rows)
    assert [r[2] for r in got if r[0] == 2] == [1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = simhash.report(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.collect() == []


def _links(spark, prints, **kw):
    fps = spark.createDataFrame([(int(p),) for p in np.unique(np.array(prints, "u8")).view("i8")], "fp long")
    ws = Workspace(spark, "simhash-test")
    return [(r.a, r.b) for r in simhash.links(ws, fps, **kw).collect()]


def _reached(prints, pairs):
    root = {int(p): int(p) for p in np.array(prints, "u8").view("i8")}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        assert a in root and b in root
        root[find(a)] = find(b)
    return [find(int(p)) for p in np.array(prints, "u8").view("i8")]


def test_dense_ball_through_split_cells(spark):
    """Thousands of prints around one centre: cells are split down to single segments, then compared in blocks."""
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    ball = {centre}
    while len(ball) < 700:
        p = rnd.choice((centre, rnd.choice(tuple(ball)))) if len(ball) % 3 == 0 else centre
        for b in rnd.sample(range(64), rnd.randint(1, 5)):
            p ^= 1 << b
        ball.add(p)
    prints = sorted(ball) + [rnd.getrandbits(64) for _ in range(300)]
    want = components(prints, list(range(len(prints))))
    for rows in (48, 300):
        got = _reached(prints, _links(spark, prints, cell_rows=rows))
        assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_equal_segment_counts_are_compared_in_blocks(spark):
    """Every two-bit segment holds one bit: no grid can tell these prints apart."""
    rnd = random.Random(4)
    prints = sorted({sum(1 << (2 * s + (rnd.random() < 0.03)) for s in range(32)) for _ in range(400)})
    want = components(prints, list(range(len(prints))))
    got = _reached(prints, _links(spark, prints, cell_rows=16))
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))


def test_distance_bound():
    rnd = np.random.default_rng(1)
    a, b = rnd.integers(0, 1 << 63, 2000, dtype="u8"), rnd.integers(0, 1 << 63, 2000, dtype="u8")
    manhattan = np.abs(simhash.popcounts(a).astype(int) - simhash.popcounts(b)).sum(axis=1)
    assert (manhattan <= np.bitwise_count(a ^ b)).all()
