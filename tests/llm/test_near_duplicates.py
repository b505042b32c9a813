"""Near-duplicate components of a whole table against comparing all pairs by hand."""

import re

from rollscore.llm import neardup


def _shingles(text, size):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_components_against_all_pairs(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows] + [(10_000, None), (10_001, ""), (10_002, "two words"), (10_003, "Two  words")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, nid int, sig string")
    sets = {i: _shingles(t, 3) for i, t in rows}
    label = {i: i for i, _ in rows}
    for i, _ in rows:
        for j, _ in rows:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.report(docs).collect()}
    assert got == {i: (len(sets[i]), label[i], label[i] == i) for i, _ in rows}
    assert neardup.report(docs.where("false")).count() == 0


def test_deduplicate_keeps_blank_rows_and_one_of_each_component(spark):
    long = "one two three four five six seven eight nine ten " * 6
    other = " ".join(f"w{i}" for i in range(60))
    rows = [(None, None, "a"), (None, None, "b"), (1, "", "c"), (1, "", "d"), (1, " ", "e"),  # blank: all stay
            (2, long + "x", "f"), (2, long + "y", "g"), (3, long, "h"), (None, long, "i"),  # near, two under the naming doc_id
            (2, other, "j"), (4, other, "k"), (4, other, "l"),  # another component named by the same doc_id
            (None, "alone without an id", "m"), (None, "alone without an id", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string").repartition(3)
    got = neardup.deduplicate(docs)
    assert got.columns == docs.columns
    kept = sorted(r.extra for r in got.collect())
    assert [x for x in kept if x <= "e"] == list("abcde")
    assert len([x for x in kept if x in "fghi"]) == 1 and set(kept) & set("fg")
    assert [x for x in kept if x in "jkl"] == ["j"]
    assert len([x for x in kept if x in "mn"]) == 1
    assert neardup.deduplicate(docs.where("false")).count() == 0
