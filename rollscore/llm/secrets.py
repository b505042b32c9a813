"""Secret scan: candidate strings judged by a random forest, with DataFrame functions only.

1. Candidates are runs of ``MIN_LENGTH`` or more key characters inside blank-separated words.
2. Each gets features of its length and alphabet, of its character transitions,
   of its dictionary coverage (share of its letters in pieces that are also words
   of at least ``FREQUENT_RATE`` of the distinct texts, and of ``FREQUENT``, counted
   over all documents outside of candidates with digits or signs), of the path or
   address it stands in, and of the neighbouring words.
3. A random forest, grown in numpy from a bounded sample of labelled findings
   (``TRAIN_FINDINGS`` of each class), removes false positives. Its trees are
   written as nested conditions, so the scan stays in DataFrame expressions.

Labels are an input of ``fit``. The tables hold none, so the query takes those of
``assigned``: a candidate that a credential's name is assigned to is a finding;
beside the name of a harmless identifier, in a path or as a plain word or number
it is none. All others are unlabelled (null) and not in the sample.

Defined cases
* null or blank text has no candidates; a text without any gives no rows;
* a word may hold several candidates; repeated rows give repeated findings;
* with labels of one class only, every score is that class;
* other columns, clashing names included, are never read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import Workspace

MIN_LENGTH = 16
CANDIDATE = r"[A-Za-z0-9+/_=\-]{16,}"
#: Names that credentials are assigned to, and names of harmless identifiers.
CREDENTIAL = r"(?i)(secret|token|passw|pwd|api[_-]?key|access[_-]?key|private|credential|auth|bearer)"
HARMLESS = r"(?i)(commit|sha1|sha256|md5|hash|digest|uuid|guid|checksum|phone|card|isbn)"
#: What ends before an assigned value: a name, quoted or not, a sign, opening quotes or brackets, and an authorisation scheme.
ASSIGNED = r"""([A-Za-z0-9_.\-]+)["'`\])]*\s*(?:[=:]{1,3}>?)\s*["'`(\[{<]*(?:(?i:bearer|basic|token)\s+)?["'`(\[{<]*$"""
OWN_NAME = r"^([A-Za-z0-9_\-]+=+)[^=]"
PATH = r"://|^[./~]|\.[a-z]{2,4}(/|$)"
PLAIN = r"^([A-Za-z]?[a-z]+(-[a-z]+)*|[0-9]+)$"
CONTEXT = 200
TRAIN_FINDINGS = 2000
TREES = 15
DEPTH = 5
FREQUENT = 3
FREQUENT_RATE = 0.001
#: Candidates that are not letters only; each starts where a run of key characters does.
KEYLIKE = r"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z]*+[0-9+/_=\-])" + CANDIDATE
PIECE = 4
SALTS = 32


def candidates(documents: DataFrame) -> DataFrame:
    """doc_id, word (its index), nth (in the word), candidate, lead (what stands before it in the word, from the previous one on),
    and the words around: before, name, inside, after."""
    words = F.split("text", r"\s+")
    docs = documents.select("doc_id", "text").where(F.col("text").rlike(CANDIDATE)).select("doc_id", words.alias("words"))
    hits = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("w"))), lambda s: s["w"].rlike(CANDIDATE)
    )
    rows = docs.select("doc_id", "words", F.explode(hits).alias("hit")).select(
        "doc_id", F.col("hit.i").alias("word"), F.col("hit.w").alias("inside"),
        F.coalesce(F.get("words", F.col("hit.i") - 1), F.lit("")).alias("before"),
        F.coalesce(F.get("words", F.col("hit.i") - 2), F.lit("")).alias("name"),
        F.coalesce(F.get("words", F.col("hit.i") + 1), F.lit("")).alias("after"),
    )
    runs, between = F.regexp_extract_all("inside", F.lit(CANDIDATE), F.lit(0)), F.split("inside", CANDIDATE)
    leads = F.zip_with(F.concat(F.array(F.lit("")), runs), between, lambda previous, text: F.concat(previous, text))
    found = F.zip_with(runs, leads, lambda c, lead: F.struct(c.alias("candidate"), lead.alias("lead")))
    rows = rows.select("*", F.posexplode(found).alias("nth", "hit")).where(F.col("hit.candidate").isNotNull())
    return rows.select("*", "hit.candidate", "hit.lead").drop("hit")


def _pieces(text: str | Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z]+"), lambda p: F.length(p) >= PIECE)


def coverage(found: DataFrame, documents: DataFrame, ws: Workspace) -> DataFrame:
    """candidate, covered: letters in pieces that are words of the corpus. Counts are of distinct texts, over all documents."""
    distinct = found.select("candidate").distinct()
    pieces = ws.save(distinct.select("candidate", F.explode(_pieces("candidate")).alias("piece")), "pieces")
    texts = documents.where("text is not null").select(F.xxhash64("text").alias("h"), "text")
    once = texts.groupBy("h").agg(F.first("text").alias("text"))  # copies meet in the partial aggregation
    least = max(FREQUENT, FREQUENT_RATE * texts.agg(F.count_distinct("h")).first()[0])
    words = once.select(F.explode(F.array_distinct(_pieces(F.regexp_replace("text", KEYLIKE, " ")))).alias("piece"))
    counts = words.groupBy("piece").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    covered = pieces.join(ws.save(counts, "counts"), "piece").groupBy("candidate").agg(F.sum(F.length("piece")).alias("covered"))
    return ws.save(covered, "covered")


def _count(text: str, pattern: str) -> Column:
    return F.length(F.col(text)) - F.length(F.regexp_replace(text, pattern, ""))


def features() -> dict[str, Column]:
    """Feature columns over a finding with ``covered``."""
    size = F.length("candidate").cast("double")
    share = lambda pattern: _count("candidate", pattern) / size
    # Lookaheads, so that overlapping neighbours are all counted.
    turns = lambda a, b: F.size(F.regexp_extract_all("candidate", F.lit(f"[{a}](?=[{b}])"), F.lit(0))) / size
    flag = lambda c: c.cast("double")
    return {
        "length": size,
        "digits": share("[0-9]"), "uppers": share("[A-Z]"), "signs": share("[^A-Za-z0-9]"), "vowels": share("[aeiouAEIOU]"),
        "hex": share("[0-9a-fA-F]"), "kinds": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "digit_letter": turns("0-9", "A-Za-z"), "letter_digit": turns("A-Za-z", "0-9"), "case_turns": turns("a-z", "A-Z"),
        "vowel_turns": turns("aeiou", "b-df-hj-np-tv-z"),
        "covered": F.coalesce("covered", F.lit(0)) / size,
        "path": flag(F.col("inside").rlike(PATH)), "slashes": _count("inside", "/") / F.length("inside"),
        "quoted": flag(F.col("inside").rlike("[\"'`]")), "assigned": flag(F.concat("before", "inside").rlike("[=:]")),
        "credential": flag(F.concat_ws(" ", "name", "before", F.regexp_replace("inside", CANDIDATE, "")).rlike(CREDENTIAL)),
        "harmless": flag(F.concat_ws(" ", "name", "before", "after").rlike(HARMLESS)),
    }


def described(documents: DataFrame, ws: Workspace) -> DataFrame:
    """Findings with their features, stored."""
    found = ws.save(candidates(documents), "candidates")
    covered = coverage(found, documents, ws).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "word"), F.lit(SALTS)).cast("int"))
    wide = salted.join(covered, ["candidate", "salt"], "left").drop("salt")
    return ws.save(wide.select("*", *[c.alias(f"f_{n}") for n, c in features().items()]), "described")


def assigned() -> Column:
    """Label of a finding by its context: 1, 0, or null where that does not tell."""
    own = F.regexp_extract("candidate", OWN_NAME, 1)
    context = F.right(F.concat(F.concat_ws(" ", "name", "before", "lead"), own), F.lit(CONTEXT))
    to = F.regexp_extract(context, ASSIGNED, 1)
    named, harmless = context.rlike(CREDENTIAL), context.rlike(HARMLESS)
    other = harmless | F.col("inside").rlike(PATH) | F.col("candidate").rlike(PLAIN)
    return F.when(to.rlike(CREDENTIAL) & ~to.rlike(HARMLESS), 1).when(~named & other, 0).cast("int")


@dataclass(frozen=True)
class Node:
    share: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


def _grow(x: np.ndarray, y: np.ndarray, depth: int, rng: np.random.Generator) -> Node:
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 4:
        return Node(share)
    best = (1e-9, -1, 0.0)
    impurity = share * (1 - share) * len(y)
    for f in rng.choice(x.shape[1], max(1, round(x.shape[1] ** 0.5)), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        cuts = np.flatnonzero(v[1:] > v[:-1])
        if not len(cuts):
            continue
        n, p = cuts + 1.0, ones[cuts]
        m, q = len(y) - n, ones[-1] - p
        gain = impurity - (p * (1 - p / n) + q * (1 - q / m))
        i = int(gain.argmax())
        if gain[i] > best[0]:
            best = (float(gain[i]), int(f), float((v[cuts[i]] + v[cuts[i] + 1]) / 2))
    _, f, cut = best
    if f < 0:
        return Node(share)
    low = x[:, f] <= cut
    return Node(share, f, cut, _grow(x[low], y[low], depth - 1, rng), _grow(x[~low], y[~low], depth - 1, rng))


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 3) -> list[Node]:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        out.append(_grow(x[rows], y[rows], depth, rng))
    return out


def fit(labelled: DataFrame, label: str = "label", per_class: int = TRAIN_FINDINGS) -> list[Node]:
    """The forest of labelled findings (``described`` and a 0/1 column), by a sample of at most ``per_class`` distinct ones of each class.
    Those without a label (null) are left out."""
    names = [f"f_{n}" for n in features()]
    rows = labelled.select(F.col(label).alias("label"), *names, F.xxhash64("candidate", "before", "name").alias("h")).dropDuplicates(["h", "label"])
    sample = [r for c in (0, 1) for r in rows.where(F.col("label") == c).orderBy("h").limit(per_class).collect()]
    if not sample:
        return [Node(0.0)]
    x = np.array([[r[n] for n in names] for r in sample], float)
    return grow_forest(x, np.array([r.label for r in sample], float))


def _condition(node: Node, names: list[str]) -> Column:
    if node.feature < 0:
        return F.lit(node.share)
    low, high = _condition(node.low, names), _condition(node.high, names)
    return F.when(F.col(f"f_{names[node.feature]}") <= F.lit(node.cut), low).otherwise(high)


def judged(described_: DataFrame, forest: list[Node]) -> DataFrame:
    names = list(features())
    votes = sum((_condition(t, names) for t in forest), F.lit(0.0))
    return described_.withColumn("score", F.round(votes / len(forest), 9)).withColumn("secret", F.col("score") >= 0.5)


def scan(documents: DataFrame, forest: list[Node] | None = None) -> DataFrame:
    """One row per candidate: doc_id, word, nth, candidate, score, secret (and the features)."""
    ws = Workspace(documents.sparkSession, "secrets")
    found = described(documents, ws)
    return judged(found, forest or fit(found.withColumn("label", assigned())))


def report(documents: DataFrame) -> DataFrame:
    return scan(documents).select(
        "doc_id", "word", "nth", F.length("candidate").cast("long").alias("length"), F.sha2("candidate", 256).alias("candidate_sha256"), "score", "secret"
    )
