"""op11: nodes against a plain dictionary of prefixes, and the double arrays by themselves."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from rollscore.llm import turntrie

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    plain = {c: [k[2:] for k in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = plain.get(base, [])[:h] + own[h:]
    members = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children, ends = {}, {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    for c, path in built.items():
        ends.setdefault(tuple(path), []).append(c)
    out, sums = set(), {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves = sum(sums[k][0] for k in kids) if kids else 1
        saved = sum(sums[k][1] for k in kids) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        sums[p] = leaves, saved
        text = ",".join(map(str, sorted(ends.get(p, []))))
        out.add((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves, saved,
                 hashlib.sha256(text.encode()).hexdigest()))
    return out


def check(spark, rows, **kw):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 AS depth", "'x' AS low", "2 AS n")
    got = [tuple(r) for r in turntrie.trie(table, **kw).collect()]
    want = brute(rows)
    assert len(got) == len(want) and set(got) == want


def test_whole_table_against_sql_and_dictionary(spark):
    table = spark.read.parquet(f"{SF01}/conversations.parquet")
    got = turntrie.trie(table)
    rows = [tuple(r) for r in got.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF01}/conversations.parquet'")
    sql = con.execute(turntrie.ORACLE)
    assert [d[0] for d in sql.description] == got.columns
    assert set(sql.fetchall()) == set(rows) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_defined_cases(spark):
    rows = [(0, 0, "user", "a"), (0, 1, None, None), (0, None, "system", "first"), (1, 5, "user", "own"), (2, 2, "user", "b"),
            (2, 2, "user", "a"), (2, 2, "user", "a"), (7, 1, "user", "ä" * 3000), (None, 1, "user", "lost"), (-3, 1, "user", "neg"),
            (11, 1, "user", ""), (11, 2, "", "user"), (13, 1, "user", "x"), (2**62, 1, "user", "far")]
    rows += [(9, t, "user", f"t{t}") for t in range(40)]
    check(spark, rows)


def test_hot_prefix_copies_and_a_long_conversation(spark):
    """Shards of a few turns and bands of four: every kind of shared node occurs."""
    rnd = random.Random(11)
    rows = [(c, t, "user", "hello" if t == 0 else rnd.choice("abc")) for c in range(0, 400, 5) for t in range(rnd.randint(1, 14))]
    rows += [(1000 + 5 * c, t, "user", f"copy{t}") for c in range(60) for t in range(9)]
    rows += [(7, t, "user", str(t % 3)) for t in range(700)]
    rows += [(c, t, "assistant", rnd.choice("xy")) for c in range(401, 500) for t in range(rnd.randint(1, 12))]
    check(spark, rows, band=4, turns=50)
    check(spark, rows, band=256, turns=1 << 17)


def test_without_conversations(spark):
    check(spark, [])
    check(spark, [(None, 1, "user", "x")])
    check(spark, [(1, 1, "user", "short")])  # rebuilt without turns: only the root


@pytest.mark.parametrize("seed", range(20))
def test_double_arrays(seed):
    """Every edge is found, and no other one."""
    rnd = np.random.default_rng(seed)
    alphabet = int(rnd.integers(1, 400))
    level, parent, code, made = list(range(3)), [], [], 3
    for _ in range(int(rnd.integers(0, 6))):
        below = []
        for node in level:
            for c in sorted(rnd.choice(alphabet, min(alphabet, int(rnd.geometric(0.3)) - 1), replace=False).tolist()):
                parent.append(node)
                code.append(c)
                below.append(made)
                made += 1
        level = below
    parent, code = np.array(parent, "i8"), np.array(code, "i8")
    base, check, slot = turntrie.pack(3, parent, code)
    assert len(set(slot.tolist())) == made and (slot >= 0).all()
    edges = {(int(slot[p]), c): int(slot[3 + i]) for i, (p, c) in enumerate(zip(parent, code.tolist()))}
    states = np.repeat(slot, alphabet)
    codes = np.tile(np.arange(alphabet), made)
    found = turntrie.step(base, check, states, codes)
    leaves = set(range(made)) - set(parent.tolist())
    for s, c, f in zip(states.tolist(), codes.tolist(), found.tolist()):
        assert f == edges.get((s, c), -1)
    assert len(leaves) + len(set(parent.tolist())) == made
