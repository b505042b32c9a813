"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts become word lists; every run of ``GRAM`` words gets a hash, and of each
``SPAN`` neighbouring hashes the smallest is kept as a fingerprint. Two texts
that share ``GRAM + SPAN - 1`` words in a row keep at least one common
fingerprint, so with ``GRAM + SPAN - 1 = window`` no shared window is missed.
Documents and benchmark are joined on fingerprints, and every match is
extended word by word to both sides, as far as a window around it can reach;
hashes only propose, words decide. Overlapping runs are united per document.

Defined cases
* null or wordless text: no words, nothing is hit; a wordless item never occurs;
* an item shorter than the window is one window of its own length (found with
  a single hash per position of that length);
* every document row gives one result row, repeated rows equal ones; two texts under
  one doc_id are judged apart; a null doc_id is a key like any other;
* repeated items count once; of several texts under one item_id, any may occur;
* an item with a null item_id marks words but is not listed among the items;
* further columns of either table are ignored; empty tables give no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import whole_row

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5
# A benchmark whose fingerprints (with their items' words) take no more than
# this is sent to every executor; a larger one is joined by shuffle.
BROADCAST_BYTES = 32 << 20


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does it where it leaves all else alone."""
    rest = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(F.lower(rest) == rest, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_list(text: Column) -> Column:
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), GAP), ""), F.array().cast("array<string>"))


def word_total(text: Column) -> Column:
    """Number of words: parts between gaps, without the empty ones at the ends."""
    first, last = F.substring(text, 1, 1), F.right(text, F.lit(1))
    blank_ends = F.when((first == "") | first.rlike(GAP_ANY_CASE), 1).otherwise(0) + F.when(last.rlike(GAP_ANY_CASE), 1).otherwise(0)
    return F.coalesce(F.size(F.split(text, GAP_ANY_CASE)) - blank_ends, F.lit(0)).cast("long")


def _gram_hashes(hashes: str, length: int) -> Column:
    """Hash of every run of ``length`` words, by start; null for shorter lists."""
    starts = F.sequence(F.lit(0), F.size(hashes) - length)
    return F.when(
        F.size(hashes) >= length,
        F.transform(starts, lambda i: F.xxhash64(F.lit(length), *[F.get(F.col(hashes), i + j) for j in range(length)])),
    )


def _run(step: int, span: int) -> Column:
    """How many neighbours on one side are not smaller, up to ``span - 1``."""
    out = F.lit(span - 1)
    for n in range(span - 2, -1, -1):
        out = F.when(F.get("grams", F.col("pos") + step * (n + 1)) >= F.col("fp"), out).otherwise(F.lit(n))
    return out


def _winnowed(lists: DataFrame, gram: int, span: int, context: str) -> DataFrame:
    """One row per kept hash: ``pos``, ``fp``, and as ``context`` the words that a window holding it can reach.

    A hash is the smallest of some window of ``span`` if its not-smaller
    neighbours on both sides reach that far; with ``span`` 1 all are kept.
    Words beyond the ends are null.
    """
    reach = span - 1
    nothing = F.array_repeat(F.lit(None).cast("string"), reach)
    hashed = lists.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("grams", _gram_hashes("hashes", gram)).withColumn("words", F.concat(nothing, "words", nothing)).drop("hashes")
    # The outer form: the plain one would have its input computed a second time for a size filter.
    rows = hashed.select("*", F.posexplode_outer("grams").alias("pos", "fp")).where(F.col("fp").isNotNull())
    if span > 1:
        rows = rows.where(_run(-1, span) + _run(1, span) >= span - 1)
    return rows.withColumn(context, F.slice("words", F.col("pos") + 1, gram + 2 * reach)).drop("grams", "words")


def _equal_runs(found: DataFrame, gram: int, reach: int) -> DataFrame:
    """The run of equal words around each match, as words [start, stop) of the document."""
    places = F.array(*[F.lit(j) for j in range(gram + 2 * reach)])
    same = lambda j: F.coalesce(F.get("context", j) == F.get("icontext", j), F.lit(False))
    found = found.withColumn("differ", F.filter(places, lambda j: ~same(j)))
    left = F.coalesce(F.array_max(F.filter("differ", lambda j: j < reach)) + 1, F.lit(0))
    right = F.coalesce(F.array_min(F.filter("differ", lambda j: j >= reach)), F.lit(gram + 2 * reach))
    return found.select(
        "doc_id", "text_hash", "item_id", (F.col("pos") - reach + left).alias("start"), (F.col("pos") - reach + right).alias("stop")
    ).where(F.col("stop") - F.col("start") >= gram + reach)


def _document_lists(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.xxhash64("text").alias("text_hash"), word_list(F.col("text")).alias("words"))


def _runs(documents: DataFrame, items: DataFrame, gram: int, span: int, broadcast_bytes: int) -> DataFrame:
    reach = span - 1
    prints = _winnowed(items, gram, span, "icontext").drop("pos")
    docs = _winnowed(_document_lists(documents), gram, span, "context")
    size = prints.select(F.sum(F.length(F.concat_ws(" ", "icontext")) * 4 + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        prints = F.broadcast(prints)
    return _equal_runs(docs.join(prints, "fp"), gram, reach)


def occurrences(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Word runs ``[start, stop)`` of documents that repeat item windows; their union is all that is hit.

    Columns: doc_id, text_hash, item_id, start, stop.
    """
    items = benchmark.select("item_id", word_list(F.col("text")).alias("words")).where(F.size("words") > 0).distinct()
    lengths = items.select(F.least(F.size("words"), F.lit(WINDOW)).alias("n")).distinct().collect()  # at most WINDOW rows
    out = None
    for n in sorted(r.n for r in lengths):
        if n == WINDOW:
            part = _runs(documents, items.where(F.size("words") >= WINDOW), GRAM, WINDOW - GRAM + 1, broadcast_bytes)
        else:
            part = _runs(documents, items.where(F.size("words") == n), n, 1, broadcast_bytes)
        out = part if out is None else out.unionByName(part)
    if out is None:
        ids = benchmark.select("item_id").schema["item_id"].dataType
        out = documents.select(
            "doc_id", F.xxhash64("text").alias("text_hash"), F.lit(None).cast(ids).alias("item_id"),
            F.lit(0).alias("start"), F.lit(0).alias("stop"),
        ).where(F.lit(False))
    return out


def decontaminate(documents: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, items (sorted ids as text)."""
    runs = occurrences(documents, benchmark, broadcast_bytes)
    key = ["doc_id", "text_hash"]
    runs = runs.groupBy(*key, "start").agg(F.max("stop").alias("stop"), F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    before = Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(before), F.lit(0))))
    hits = (
        runs.withColumn("fresh", fresh)
        .groupBy(*key)
        .agg(F.sum("fresh").cast("long").alias("n_hit"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"))
    )
    docs = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), word_total(F.col("text")).alias("n_words"))
    return (
        docs.alias("d")
        .join(hits.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")), "left")
        .select(
            "d.doc_id", "d.text_hash", "d.n_words",
            F.coalesce("h.n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("h.items", F.array().cast("array<string>")).alias("items"),
        )
    )


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(documents, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that no benchmark window occurs in, all columns kept."""
    hit = decontaminate(documents, benchmark).where("n_hit > 0").select("doc_id", "text_hash")
    d = documents.select("doc_id", F.xxhash64("text").alias("text_hash"), whole_row(documents)).alias("d")
    return d.join(
        hit.alias("h"), F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.text_hash") == F.col("h.text_hash")), "left_anti"
    ).select("__all.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT nr, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT nr, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT nr, dw.n, i, item_id FROM dw JOIN iw USING (n, g)),
pos AS (SELECT DISTINCT nr, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT nr, n, i FROM hit)),
np AS (SELECT nr, count(*) AS n_hit FROM pos GROUP BY 1),
ni AS (SELECT nr, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items FROM hit GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN np USING (nr) LEFT JOIN ni USING (nr)
"""
