"""Near-duplicate classes: MinHash signatures joined by coordinate, links confirmed on full shingle sets.

1. Every document gets the set of its word shingles (64-bit hashes) and a
   signature of ``coordinates`` minima. Equal sets form one class at once.
2. Classes are posted under each (coordinate, value). Two sets at the
   similarity threshold agree on at least ``least_matches`` coordinates (five
   standard deviations below the mean), so each class needs postings only under
   its ``coordinates - least_matches + 1`` rarest pairs (the prefix); values
   that occur once cannot collide, and long lists are skipped because they come last.
3. Lists are merged without emitting their pairs. Rounds of star candidates
   (member against one hub of its list) link most of a group; then members of
   lists that still hold several components are compared in blocks: collision
   counts on signatures first, full sets for those at or above the threshold.
   Pairs already in one component are skipped, no other pair of a list is.

Every group handed to one task is bounded (a hub or block against a block).

Defined cases
* null, empty or blank text: empty set, linked with nothing, its own component;
* fewer words than a shingle: the whole sequence is the one shingle;
* repeated rows are documents of their own with equal sets; rows that share a
  doc_id share nothing else; a null doc_id never names a component unless no
  member has an id;
* further columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .graph import components
from .storage import Workspace, whole_row

BLOCK = 256
HUB_ROUNDS = 2
# Key lists up to this many rows (16 bytes each) are broadcast to fetch the texts
# of contested classes; longer ones are joined by shuffle.
BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class Plan:
    shingle: int = 5
    percent: int = 80
    coordinates: int = 64
    seed: int = 7

    @property
    def least_matches(self) -> int:
        p, n = self.percent / 100, self.coordinates
        return max(1, math.floor(n * p - 5 * math.sqrt(n * p * (1 - p))))


class WordHashes(dict):
    """64-bit hash of each word, remembered for frequent short ones."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 48:
            if len(self) >= 1 << 19:
                self.clear()
            self[word] = value
        return value


def shingle_set(text: bytes | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text; words are runs of non-blank ASCII-lowered bytes."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(size, n)
    mixed = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        mixed ^= codes[j : n - width + 1 + j]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def _permutations(plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(plan.seed)
    draw = lambda: rng.integers(0, 1 << 63, (plan.coordinates, 1), dtype=np.uint64) * np.uint64(2)
    return draw(), draw() + np.uint64(1)


def signature(shingles: np.ndarray, xors: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(xors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        block = shingles[None, i : i + 2048] ^ xors
        block *= factors
        np.minimum(low, block.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signatures(plan: Plan):
    def run(batches):
        xors, factors = _permutations(plan)
        hashes = WordHashes()
        for batch in batches:
            sets, sizes, sigs = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py(), plan.shingle, hashes)
                sizes.append(len(shingles))
                sets.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None)
                sigs.append(signature(shingles, xors, factors) if len(shingles) else np.empty(0, np.int32))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sigs])]).astype(np.int32)
            flat = np.concatenate(sigs) if sigs else np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(sets, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["doc_id", "row_key", "set_key", "n_shingles", "sig"],
            )

    return run


def _sets(plan: Plan):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(text.as_py(), plan.shingle, hashes).tobytes() for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("nid"), pa.array(sets, pa.binary())], names=["nid", "shingles"])

    return run


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, width)


def _candidates(rows: pa.Table, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of one cell, left (side 0) against right (side 1), or all against all (side 2),
    of different components that can reach the threshold by size and collision count."""
    side, comp, n = (rows.column(c).to_numpy() for c in ("side", "comp", "n_shingles"))
    sig = _matrix(rows.column("sig"), plan.coordinates)
    if (side == 2).any():
        left = right = np.flatnonzero(side == 2)
    else:
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    apart = comp[left][:, None] != comp[right][None, :]
    if left is right:
        apart &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    a, b = n[left][:, None], n[right][None, :]
    apart &= 100 * np.minimum(a, b) >= plan.percent * np.maximum(a, b)
    i, j = np.nonzero(apart)
    i, j = left[i], right[j]
    keep = np.empty(len(i), bool)
    for s in range(0, len(i), 1 << 14):  # bounded blocks of signature pairs
        e = s + (1 << 14)
        keep[s:e] = (sig[i[s:e]] == sig[j[s:e]]).sum(axis=1) >= plan.least_matches
    return i[keep], j[keep]


def _involved(plan: Plan):
    """Members of a cell that have a candidate partner there (signatures only)."""

    def run(rows: pa.Table) -> pa.Table:
        i, j = _candidates(rows, plan)
        return rows.take(pa.array(np.unique(np.concatenate([i, j])))).select(["cell_a", "cell_b", "side", "nid"])

    return run


def _links(plan: Plan):
    """Confirmed links of a cell; a pair that the cell's links already connect is skipped."""

    def run(rows: pa.Table) -> pa.Table:
        i, j = _candidates(rows, plan)
        nid, sets = rows.column("nid").to_numpy(), rows.column("shingles")
        arrays, parent, out = {}, {}, []

        def root(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def members(x):
            if x not in arrays:
                arrays[x] = np.frombuffer(sets[x].as_py(), np.uint64)
            return arrays[x]

        for x, y in zip(i.tolist(), j.tolist()):
            if root(x) == root(y):
                continue
            a, b = members(x), members(y)
            same = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * same >= plan.percent * (len(a) + len(b) - same):
                parent[root(x)] = root(y)
                out.append((nid[x], nid[y]))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _best_hubs(lists: DataFrame, turn: int) -> DataFrame:
    """(nid, comp, hub): each member's most frequent hub among its lists, where in another component."""
    hubs = lists.groupBy("key").agg(
        F.min(F.struct(F.xxhash64("nid", F.lit(turn)).alias("h"), "nid", "comp")).alias("hub"),
        F.min("comp").alias("low"), F.max("comp").alias("high"),
    ).where("low != high")
    edges = lists.join(hubs, "key").where("comp != hub.comp").groupBy("nid", F.col("hub.nid").alias("hub")).agg(F.count("*").alias("n"))
    return edges.groupBy("nid").agg(F.max(F.struct("n", "hub")).alias("best")).select("nid", F.col("best.hub").alias("hub"))


def _star_cells(edges: DataFrame) -> DataFrame:
    """(cell_a, cell_b, side, nid): each hub against at most about ``BLOCK`` of its members at a time."""
    chunks = edges.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    right = edges.join(chunks, "hub").select(
        F.col("hub").alias("cell_a"), F.pmod(F.xxhash64("nid"), F.col("chunks")).cast("long").alias("cell_b"), F.lit(1).alias("side"), "nid"
    )
    left = right.select("cell_a", "cell_b", F.lit(0).alias("side"), F.col("cell_a").alias("nid")).distinct()
    return left.union(right)


def _block_cells(ws: Workspace, lists: DataFrame) -> DataFrame:
    """Cells that hold every pair, from different components, of members of one list.

    Lists that share members form a cluster. Components larger than a block are
    cut into blocks of their own, smaller ones share blocks; two blocks of one
    large component need no cell.
    """
    mixed = lists.groupBy("key").agg(F.min("nid").alias("head"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high")
    members = lists.join(mixed.select("key", "head"), "key").select("nid", "comp", "head")
    members = ws.save(members.distinct(), "members")
    roots = components(ws, members.select(F.col("nid").alias("a"), F.col("head").alias("b")), "clusters")
    nodes = members.select("nid", "comp").distinct().join(roots.select(F.col("a").alias("nid"), "b"), "nid", "left")
    nodes = ws.save(nodes.select("nid", "comp", F.coalesce("b", "nid").alias("cluster")), "nodes")
    sizes = nodes.groupBy("cluster", "comp").agg(F.count("*").alias("size"))
    small = sizes.where(F.col("size") <= BLOCK).groupBy("cluster").agg(F.sum("size").alias("small"))
    placed = nodes.join(sizes, ["cluster", "comp"]).join(small, "cluster", "left")
    large = F.col("size") > BLOCK
    # A block's number: chunk of its component, or share of the small components.
    owner = F.when(large, F.col("comp"))
    chunk = F.when(large, F.pmod(F.xxhash64("nid"), F.ceil(F.col("size") / BLOCK))).otherwise(
        F.pmod(F.xxhash64("comp"), F.ceil(F.col("small") / BLOCK))
    )
    placed = ws.save(placed.select("nid", "cluster", owner.alias("owner"), F.xxhash64("cluster", owner, chunk.cast("long")).alias("block")), "placed")
    blocks = placed.select("cluster", "owner", "block").distinct()
    other = blocks.select("cluster", F.col("owner").alias("owner2"), F.col("block").alias("block2"))
    pairs = blocks.join(other, "cluster").where("block <= block2 and (owner is null or owner2 is null or owner != owner2)")
    pairs = ws.save(pairs.select("block", "block2"), "cells")
    place = placed.select("nid", "block")
    left = pairs.join(place, "block").select(
        F.col("block").alias("cell_a"), F.col("block2").alias("cell_b"), F.when(F.col("block") == F.col("block2"), 2).otherwise(0).alias("side"), "nid"
    )
    right = pairs.where("block != block2").join(place.withColumnRenamed("block", "block2"), "block2").select(
        F.col("block").alias("cell_a"), F.col("block2").alias("cell_b"), F.lit(1).alias("side"), "nid"
    )
    return left.union(right)


def _confirmed(cells: DataFrame, sets: DataFrame, comp: DataFrame, plan: Plan) -> DataFrame:
    rows = cells.join(comp, "nid").join(sets, "nid").select("cell_a", "cell_b", "side", "nid", "comp", "n_shingles", "sig", "shingles")
    return rows.groupBy("cell_a", "cell_b").applyInArrow(_links(plan), "a long, b long")


def _merged(ws: Workspace, comp: DataFrame, links: DataFrame, name: str) -> DataFrame:
    """Components after the links; their labels are the smallest node of each."""
    a = links.join(comp.select(F.col("nid").alias("a"), F.col("comp").alias("ca")), "a")
    ab = a.join(comp.select(F.col("nid").alias("b"), F.col("comp").alias("cb")), "b")
    roots = components(ws, ab.select(F.col("ca").alias("a"), F.col("cb").alias("b")), f"{name}-edges")
    new = comp.join(roots.select(F.col("a").alias("comp"), F.col("b").alias("root")), "comp", "left")
    return ws.save(new.select("nid", F.coalesce("root", "comp").alias("comp")), f"{name}-comp")


def near_duplicates(documents: DataFrame, plan: Plan = Plan(), row_key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, row_key, set_key, n_shingles, comp (the component; null for an empty set) and
    component_id (smallest doc_id reachable, which several components can share)."""
    spark = documents.sparkSession
    ws = Workspace(spark, "neardup")
    id_type = documents.schema["doc_id"].dataType
    docs = documents.select("doc_id", (F.xxhash64("doc_id", "text") if row_key is None else row_key).alias("row_key"), F.col("text").cast("binary").alias("text"))
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("row_key", T.LongType()), T.StructField("set_key", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()), T.StructField("sig", T.ArrayType(T.IntegerType())),
    ])
    signed = ws.save(docs.mapInArrow(_signatures(plan), schema), "signed")
    classes = signed.where("set_key is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("low_doc"), F.min("row_key").alias("row_key"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")
    )
    classes = ws.save(classes.withColumn("nid", F.monotonically_increasing_id()), "classes")

    tokens = classes.select("nid", F.posexplode("sig").alias("c", "v")).select(
        "nid", F.shiftleft(F.col("c").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(0xFFFFFFFF)).alias("key")
    )
    counts = tokens.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = tokens.join(counts, "key")
    by_rarity = Window.partitionBy("nid").orderBy("df", "key")
    whole = Window.partitionBy("nid")  # at most one row per coordinate
    ranked = shared.withColumn("r", F.row_number().over(by_rarity)).withColumn("n", F.count("*").over(whole))
    postings = ws.save(ranked.where(F.col("r") <= F.col("n") - plan.least_matches + 1).select("nid", "key"), "postings")

    nodes = ws.save(postings.select("nid").distinct().join(classes, "nid").select("nid", "row_key", "n_shingles", "sig"), "contested")
    wanted = nodes.select("row_key", "nid")
    if nodes.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "row_key").select("nid", "text")
    sets = texts.mapInArrow(_sets(plan), "nid long, shingles binary").dropDuplicates(["nid"])
    sets = ws.save(nodes.join(sets, "nid").select("nid", "n_shingles", "sig", "shingles"), "sets")

    comp = nodes.select("nid", F.col("nid").alias("comp"))
    for turn in range(HUB_ROUNDS):
        edges = ws.save(_best_hubs(postings.join(comp, "nid"), turn), f"hubs{turn}")
        if edges.isEmpty():
            break
        links = ws.save(_confirmed(_star_cells(edges), sets, comp, plan), f"links{turn}")
        comp = _merged(ws, comp, links, f"round{turn}")
    cells = ws.save(_block_cells(ws, postings.join(comp, "nid")), "block-cells")
    sigs = sets.select("nid", "n_shingles", "sig")
    near = cells.join(comp, "nid").join(sigs, "nid").select("cell_a", "cell_b", "side", "nid", "comp", "n_shingles", "sig")
    near = near.groupBy("cell_a", "cell_b").applyInArrow(_involved(plan), "cell_a long, cell_b long, side int, nid long")
    links = ws.save(_confirmed(ws.save(near, "near"), sets, comp, plan), "links-last")
    comp = _merged(ws, comp, links, "last")
    ws.drop("sets", "postings", "near", "block-cells")

    low = classes.select("nid", "low_doc").join(comp, "nid")
    group = low.groupBy("comp").agg(F.min("low_doc").alias("component_id"))
    named = low.join(group, "comp").select("nid", "comp", "component_id")
    named = classes.select("nid", "set_key", "low_doc").join(named, "nid", "left").select(
        "set_key", F.coalesce("comp", "nid").alias("comp"), F.coalesce("component_id", "low_doc").alias("component_id")
    )
    return signed.select("doc_id", "row_key", "set_key", "n_shingles").join(named, "set_key", "left").select(
        "doc_id", "row_key", "set_key", "n_shingles", "comp", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def report(documents: DataFrame) -> DataFrame:
    found = near_duplicates(documents, Plan(shingle=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(documents: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """All columns of one row of each component (smallest doc_id, null last, then smallest row), and of every row with an empty set."""
    ws = Workspace(documents.sparkSession, "neardup-rows")
    rows = ws.save(documents.select(whole_row(documents), F.monotonically_increasing_id().alias("__row")), "rows")
    found = near_duplicates(rows.select("__all.doc_id", "__all.text", "__row"), plan, F.col("__row")).select("doc_id", "row_key", "set_key", "comp")
    found = ws.save(found, "found")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "set_key", "row_key"))
    kept = found.where("set_key is not null").groupBy("comp").agg(first.alias("first")).select(F.col("first.row_key").alias("__row"))
    kept = kept.union(found.where("set_key is null").select("row_key"))
    return rows.join(ws.save(kept, "kept"), "__row", "left_semi").select("__all.*")
