"""Prefix trie of rebuilt conversations, in double arrays.

1. Turns are ordered by a range partitioning and numbered by each task for its own run of a conversation; the
   offsets of the runs (one row per task that holds a part of it) are added afterwards, so a conversation of any
   length is spread over tasks. A turn travels as a 128-bit key of (role, text) and its size in bytes.
2. Conversations are rebuilt (contract of ``op11``) and cut into bands of ``BAND`` turns. A node is named by its depth
   and the exclusive-or of 128-bit hashes of its (depth, turn) pairs, which needs no order among tasks. Equal bands
   behind the same prefix are counted once, with partial aggregation.
3. The distinct sequences are range-partitioned in lexicographic order. Each prefix shard, a block of at most
   ``TURNS`` turns, numbers its turns densely, packs BASE and CHECK arrays and walks its sequences through them. A
   hot prefix is split over shards by its next turns.
4. A node on the first or last path of a shard, or above a band that goes on, may be shared with other shards: their
   parts are added up by node name, and sums over subtrees of these upper nodes follow by pointer doubling. All
   other nodes are complete within their shard.
5. The ids that end in a node are joined in order piece by piece, and the pieces hashed in one pass.

Defined cases
* a null role or text is empty; a null turn comes first; rows of one turn number come in the order of role and text;
  repeated rows are turns of their own;
* rows with a null conv_id belong to no conversation and are left out;
* a conversation may be rebuilt without turns: it ends in the root; a table without conversations has no root;
* other columns are never read; texts of any length are hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import Workspace

BAND = 256
TURNS = 1 << 17
TRIES = 256
IDS_AT_ONCE = 1 << 14
COPIES = 16
GROUP, HEADS = 5, 9  # fixed by the contract: siblings share a head of crc32 % 9 turns of conversation c - c % 5

NODE = ["depth", "x1", "x2"]
NODES = (
    "shared boolean, depth int, x1 bigint, x2 bigint, n bigint, low bigint, size bigint, children bigint, "
    "leaves bigint, saved bigint, p1 bigint, p2 bigint, plow bigint"
)


# ---------------------------------------------------------------- order and rebuild

def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of every turn in its task's run of the conversation, from 1."""
    pid = TaskContext.get().partitionId()
    last, held = None, 0
    for batch in batches:
        conv = _column(batch, "conv_id")
        if not len(conv):
            continue
        index = np.arange(len(conv))
        first = np.concatenate([[True], conv[1:] != conv[:-1]])
        at = index - np.maximum.accumulate(np.where(first, index, 0)) + 1
        if last is not None and conv[0] == last:
            at[conv == last] += held
        last, held = conv[-1], at[-1]
        keep = [batch.column(batch.schema.get_field_index(c)) for c in ("k1", "k2", "size")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv), pa.array(np.full(len(conv), pid, "i4")), pa.array(at.astype("i8")), *keep],
            names=["conv_id", "pid", "at", "k1", "k2", "size"])


def numbered(ws: Workspace, conversations: DataFrame) -> DataFrame:
    """(conv_id, pid, at, k1, k2, size) of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text"),
        F.monotonically_increasing_id().alias("__row"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "__row"]
    ordered = turns.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit(1), "role", "text").alias("k2"),
        F.octet_length("text").cast("bigint").alias("size"))
    out = ordered.mapInArrow(_number, "conv_id bigint, pid int, at bigint, k1 bigint, k2 bigint, size bigint")
    return ws.save(out, "numbered")


def rebuilt(ws: Workspace, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id) and their rebuilt turns (conv_id, depth, k1, k2, size)."""
    runs = turns.groupBy("conv_id", "pid").agg(F.max("at").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = ws.save(runs.withColumn("carry", F.coalesce(F.sum("n").over(before), F.lit(0))), "runs")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    convs = runs.groupBy("conv_id").agg(F.sum("n").alias("n")).select(
        "conv_id", "n", head.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    convs = ws.save(convs, "convs")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("found"))
    gap = F.when(F.col("conv_id") == F.col("base"), 0).otherwise(F.greatest(F.col("h") - F.coalesce("found", F.lit(0)), F.lit(0)))
    known = convs.join(bases, "base", "left").select("conv_id", "base", "h", gap.alias("gap"))
    placed = turns.join(runs.select("conv_id", "pid", "carry").join(known, "conv_id"), ["conv_id", "pid"])
    own = ws.save(placed.select("conv_id", "base", "h", "gap", (F.col("at") + F.col("carry")).alias("pos"), "k1", "k2", "size"), "own")
    mine = own.where("conv_id = base OR pos > h").select("conv_id", (F.col("pos") - F.col("gap")).alias("depth"), "k1", "k2", "size")
    heads = own.where((F.col("conv_id") == F.col("base")) & (F.col("pos") < HEADS)).select("base", "pos", "k1", "k2", "size")
    others = convs.where("conv_id != base").select("conv_id", "base", "h")
    taken = others.join(heads, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "size")
    return convs.select("conv_id"), mine.union(taken)


def segments(ws: Workspace, turns: DataFrame, band: int) -> DataFrame:
    """(conv_id, band, p1, p2, s1, s2, len, path): one row per conversation and band; p names the node before the band."""
    turn = F.struct("k1", "k2", "f1", "f2", "size")
    hashed = turns.select(
        "conv_id", F.floor((F.col("depth") - 1) / band).cast("int").alias("band"), "depth", "k1", "k2",
        F.xxhash64("depth", "k1", "k2").alias("f1"), F.xxhash64("k2", "depth", "k1").alias("f2"), "size")
    grouped = hashed.groupBy("conv_id", "band").agg(
        F.bit_xor("f1").alias("s1"), F.bit_xor("f2").alias("s2"), F.count(F.lit(1)).cast("int").alias("len"),
        F.sort_array(F.collect_list(F.struct("depth", turn.alias("turn")))).alias("path"))
    stored = ws.save(grouped.withColumn("path", F.col("path.turn")), "segments")
    names = stored.select("conv_id", "band", "s1", "s2")
    long = names.join(names.where("band = 1").select("conv_id"), "conv_id", "left_semi")
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    prefix = long.select("conv_id", "band", F.bit_xor("s1").over(before).alias("p1"), F.bit_xor("s2").over(before).alias("p2"))
    zero = F.lit(0).cast("bigint")
    out = stored.join(prefix, ["conv_id", "band"], "left")
    return out.withColumns({"p1": F.coalesce("p1", zero), "p2": F.coalesce("p2", zero)})


# ---------------------------------------------------------------- one shard

def dense(k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Ids 0, 1, ... of the distinct turns, in the order of their keys."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    new = np.concatenate([[False], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    codes = np.empty(len(k1), dtype="i8")
    codes[order] = np.cumsum(new)
    return codes


def pack(roots: int, parent: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BASE, CHECK and the slot of every node. Nodes 0..roots-1 are roots; the other ones have a parent of a smaller
    number, stand together by parent and ascend by code there. A child lies at BASE[parent] + code, and CHECK names
    its parent there; nodes with several children are fitted first, single children fill the gaps."""
    count = roots + len(parent)
    slot = np.full(count, -1, dtype="i8")
    slot[:roots] = np.arange(roots)
    used = np.zeros(2 * count + int(code.max(initial=0)) + 2, dtype=bool)
    used[:roots] = True
    starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.empty(0, "i8")
    sizes = np.diff(np.concatenate([starts, [len(parent)]]))
    top = free = roots
    for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        codes = code[start:start + size] - code[start]
        span = int(codes[-1]) + 1
        if top + span + TRIES >= len(used):
            used = np.concatenate([used, np.zeros(len(used) + span, dtype=bool)])
        at = top
        if size <= 64:
            while used[free]:
                free += 1
            places = free + np.flatnonzero(~used[free:min(free + TRIES, top)])
            for c in codes[1:].tolist():
                places = places[~used[places + c]]
            if len(places):
                at = int(places[0])
        slot[roots + start:roots + start + size] = at + codes
        used[at + codes] = True
        top = max(top, at + span)
    single = roots + starts[sizes == 1]
    gaps = np.flatnonzero(~used[:top])[:len(single)]
    gaps = np.concatenate([gaps, top + np.arange(len(single) - len(gaps))])
    slot[single] = gaps
    length = int(slot.max(initial=0)) + 1
    base, check = np.zeros(length, dtype="i8"), np.full(length, -1, dtype="i8")
    base[slot[parent]] = slot[roots:] - code
    check[slot[roots:]] = slot[parent]
    return base, check, slot


def step(base: np.ndarray, check: np.ndarray, state: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The children of the states by code; -1 where there is none."""
    to = base[state] + code
    there = (to >= 0) & (to < len(check))
    return np.where(there & (check[np.where(there, to, 0)] == state), to, -1)


def _levels(offsets: np.ndarray):
    """(d, sequences longer than d, place of their turn d) for d = 0, 1, ..."""
    length = np.diff(offsets)
    alive, d = np.flatnonzero(length > 0), 0
    while len(alive):
        yield d, alive, offsets[alive] + d
        d += 1
        alive = alive[length[alive] > d]


def shard_nodes(block: dict[str, np.ndarray], band_turns: int) -> pa.RecordBatch:
    """All nodes of one block of sequences (sorted by band, prefix and path) with their local sums."""
    offsets, band = block["offsets"], block["band"]
    count = len(band)
    code = dense(block["k1"], block["k2"])
    name = np.stack([band.astype("i8"), block["p1"], block["p2"]])
    first = np.concatenate([[True], (name[:, 1:] != name[:, :-1]).any(axis=0)])
    root = np.cumsum(first) - 1
    roots = int(root[-1]) + 1

    node, parents, codes, made = root.copy(), [], [], roots
    for _, alive, place in _levels(offsets):
        above, here = node[alive], code[place]
        new = np.concatenate([[True], (above[1:] != above[:-1]) | (here[1:] != here[:-1])])
        node[alive] = made + np.cumsum(new) - 1
        parents.append(above[new])
        codes.append(here[new])
        made += int(new.sum())
    empty = np.empty(0, "i8")
    base, check, _ = pack(roots, np.concatenate([empty, *parents]), np.concatenate([empty, *codes]))

    slots = len(base)
    n, low, depth, size, x1, x2 = (np.zeros(slots, "i8") for _ in range(6))
    low[:] = np.iinfo("i8").max
    shared = np.zeros(slots, dtype=bool)
    shared[:roots] = True
    depth[:roots], x1[:roots], x2[:roots] = band[first] * band_turns, block["p1"][first], block["p2"][first]
    depth[roots:] = -1  # gaps keep it
    top = root[band == 0]
    np.add.at(n, top, block["n"][band == 0])
    np.minimum.at(low, top, block["low"][band == 0])
    state, c1, c2 = root.copy(), block["p1"].copy(), block["p2"].copy()
    levels = []
    for d, alive, place in _levels(offsets):
        at = step(base, check, state[alive], code[place])
        if (at < 0).any():
            raise RuntimeError("a sequence leaves its double array")
        state[alive] = at
        c1[alive] ^= block["f1"][place]
        c2[alive] ^= block["f2"][place]
        np.add.at(n, at, block["n"][alive])
        np.minimum.at(low, at, block["low"][alive])
        depth[at], size[at] = band[alive] * band_turns + d + 1, block["size"][place]
        x1[at], x2[at] = c1[alive], c2[alive]
        shared[at] |= (alive == 0) | (alive == count - 1) | (d + 1 == band_turns)
        levels.append(np.unique(at))

    children, whole_children, leaves, saved = (np.zeros(slots, "i8") for _ in range(4))
    for at in reversed(levels):
        above = check[at]
        whole = ~shared[at]
        leaves[at] += whole & (children[at] == 0)
        saved[at] += np.where(whole, (n[at] - 1) * size[at], 0)
        np.logical_or.at(shared, above, shared[at])
        np.add.at(children, above, 1)
        np.add.at(whole_children, above, whole.astype("i8"))
        np.add.at(leaves, above, np.where(whole, leaves[at], 0))
        np.add.at(saved, above, np.where(whole, saved[at], 0))
    real = np.flatnonzero(depth >= 0)
    above = np.maximum(check[real], 0)
    is_root = check[real] < 0
    arrays = [
        pa.array(shared[real]), pa.array(depth[real].astype("i4")), pa.array(x1[real]), pa.array(x2[real]), pa.array(n[real]),
        pa.array(low[real], mask=n[real] == 0), pa.array(size[real]), pa.array(whole_children[real]), pa.array(leaves[real]),
        pa.array(saved[real]), pa.array(x1[above], mask=is_root), pa.array(x2[above], mask=is_root),
        pa.array(low[above], mask=is_root | shared[above]),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in NODES.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch], turns: int) -> Iterator[dict[str, np.ndarray]]:
    """Neighbouring sequences of about ``turns`` turns in all (one sequence has at most a band of them)."""
    held, size = [], 0
    for batch in batches:
        path = batch.column(batch.schema.get_field_index("path"))
        ends = np.concatenate([[0], np.cumsum(path.value_lengths().to_numpy(zero_copy_only=False))])
        at = 0
        while at < len(batch):
            stop = int(np.searchsorted(ends, ends[at] + max(turns - size, 1), side="left"))
            stop = min(max(stop, at + 1), len(batch))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop] - ends[at])
            at = stop
            if size >= turns:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def _block(parts: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    out = {c: np.concatenate([_column(p, c) for p in parts]) for c in ("band", "p1", "p2", "n", "low")}
    paths = [p.column(p.schema.get_field_index("path")) for p in parts]
    turns = [p.flatten() for p in paths]
    for i, c in enumerate(("k1", "k2", "f1", "f2", "size")):
        out[c] = np.concatenate([t.field(i).to_numpy(zero_copy_only=False) for t in turns])
    lengths = np.concatenate([p.value_lengths().to_numpy(zero_copy_only=False) for p in paths])
    out["offsets"] = np.concatenate([[0], np.cumsum(lengths)]).astype("i8")
    return out


def shards(found: DataFrame, band: int, turns: int) -> DataFrame:
    """Nodes of all shards; those marked ``shared`` hold one shard's part."""
    distinct = found.groupBy("band", "p1", "p2", "s1", "s2", "len").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.first("path").alias("path"))
    order = ["band", "p1", "p2", "path"]
    dealt = distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("band", "p1", "p2", "n", "low", "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, turns):
            yield shard_nodes(block, band)

    return dealt.mapInArrow(run, NODES)


# ---------------------------------------------------------------- shared nodes, ends

def merged(ws: Workspace, parts: DataFrame) -> DataFrame:
    """Shared nodes added up: (depth, x1, x2, n, low, p1, p2, n_children, leaves, saved) over whole subtrees."""
    total = parts.groupBy(*NODE).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("size").alias("size"), F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    total = ws.save(total, "upper")
    below = total.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
    count = F.col("children") + F.coalesce("more", F.lit(0))
    tree = total.join(below.agg(F.count(F.lit(1)).alias("more")), NODE, "left").select(
        *NODE, "n", "low", "p1", "p2", count.alias("n_children"),
        (F.col("leaves") + F.when(count == 0, 1).otherwise(0)).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("size")).alias("saved"),
        F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))).alias("up"))
    level = 0
    while True:
        tree = ws.save(tree, f"sums-{level}")
        if tree.where("up IS NOT NULL").limit(1).count() == 0:
            return tree.drop("up")
        add = tree.where("up IS NOT NULL").groupBy("up").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).select("up.*", "l", "s")
        higher = tree.where("up IS NOT NULL").select(F.struct(*NODE).alias("up"), F.col("up").alias("next"))
        tree = tree.join(add, NODE, "left").join(higher, "up", "left").select(
            *NODE, "n", "low", "p1", "p2", "n_children", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), F.col("next").alias("up"))
        level += 1


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not len(batch):
            continue
        name = np.stack([_column(batch, c).astype("i8") for c in NODE])
        conv = _column(batch, "conv_id")
        new = np.concatenate([[True], (name[:, 1:] != name[:, :-1]).any(axis=0)])
        starts = np.flatnonzero(new)
        ids = conv.tolist()
        ends = [*starts[1:].tolist(), len(ids)]
        text = [",".join(map(str, ids[a:b])) for a, b in zip(starts.tolist(), ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[0][starts].astype("i4")), pa.array(name[1][starts]), pa.array(name[2][starts]), pa.array(conv[starts]),
             pa.array(text)], names=[*NODE, "first", "ids"])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, digest = None, None
    for batch in batches:
        out = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if row[:3] == last:
                digest.update(b",")
            else:
                if last is not None:
                    out.append((*last, digest.hexdigest()))
                last, digest = row[:3], hashlib.sha256()
            digest.update(row[4].encode())
        yield _named(out)
    if last is not None:
        yield _named([(*last, digest.hexdigest())])


def _named(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], [], []]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[*NODE, "ends_sha256"])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(depth, x1, x2, ends_sha256) of the nodes in which conversations end; ids in numeric order, joined by commas."""
    order = [*NODE, "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _pieces, "depth int, x1 bigint, x2 bigint, first bigint, ids string")
    dealt = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.mapInArrow(_hash_pieces, "depth int, x1 bigint, x2 bigint, ends_sha256 string")


# ---------------------------------------------------------------- the whole

def trie(conversations: DataFrame, band: int = BAND, turns: int = TURNS) -> DataFrame:
    """One row per node (contract of ``op11``)."""
    ws = Workspace(conversations.sparkSession, "turntrie")
    convs, all_turns = rebuilt(ws, numbered(ws, conversations))
    found = segments(ws, all_turns, band)
    nodes = ws.save(shards(found, band, turns), "nodes")

    stops = found.groupBy("conv_id").agg(F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"), F.sum("len").alias("depth"))
    zero = F.lit(0).cast("bigint")
    ends = ws.save(convs.join(stops, "conv_id", "left").select(
        F.coalesce("depth", zero).cast("int").alias("depth"), F.coalesce("x1", zero).alias("x1"), F.coalesce("x2", zero).alias("x2"),
        "conv_id"), "ends")
    bare = ends.where("depth = 0").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low")).where("n > 0")
    columns = {"shared": F.lit(True), "depth": F.lit(0), "n": F.col("n"), "low": F.col("low")}
    blank = F.lit(None).cast("bigint")
    names = [c.split()[0] for c in NODES.split(", ")]
    bare = bare.select(*[columns.get(c, blank if c in ("p1", "p2", "plow") else zero).alias(c) for c in names])
    upper = merged(ws, nodes.where("shared").union(bare))

    tops = upper.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("low").alias("parent"))
    spread = tops.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    copy = F.pmod(F.xxhash64("x1", "x2"), F.lit(COPIES)).cast("int")
    columns = [*NODE, "low", "n", "n_children", "leaves", "saved", "parent"]
    whole = nodes.where("NOT shared").withColumnRenamed("children", "n_children")
    inner = whole.where("plow IS NOT NULL").withColumnRenamed("plow", "parent").select(columns)
    rest = whole.where("plow IS NULL").unionByName(upper.where("depth > 0"), allowMissingColumns=True)
    rest = rest.withColumn("copy", copy).join(spread, ["depth", "p1", "p2", "copy"]).select(columns)
    root = upper.where("depth = 0").withColumn("parent", blank).select(columns)
    every = inner.union(rest).union(root)
    nothing = hashlib.sha256(b"").hexdigest()
    return every.join(end_hashes(ends), NODE, "left").select(
        F.col("low").alias("conv_id"), F.col("depth").cast("bigint").alias("depth"), F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))


ORACLE = """
WITH tables AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, z: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))) AS crc),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
    lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT c FROM turns), tables),
placed AS (
  SELECT v.c, t.pos, t.r, t.x FROM convs v JOIN turns t ON t.c = v.c - v.c % 5 AND t.pos <= v.h
  UNION ALL
  SELECT v.c, t.pos, t.r, t.x FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
prefixes AS (
  SELECT c, row_number() OVER w AS depth, strlen(x) AS bytes,
    md5(string_agg(md5(length(r) || ':' || r || x), ',') OVER w) AS k
  FROM placed WINDOW w AS (PARTITION BY c ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  UNION ALL
  SELECT c, 0, 0, 'root' FROM convs),
linked AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY depth) AS pk FROM prefixes),
nodes AS (SELECT depth, k, max(pk) AS pk, min(c) AS conv_id, count(*) AS n, max(bytes) AS bytes FROM linked GROUP BY depth, k),
below AS (SELECT depth - 1 AS depth, pk AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN below USING (depth, k)),
sums AS (
  SELECT p.depth, p.k, sum((m.n - 1) * m.bytes) AS saved, count(*) FILTER (m.n_children = 0) AS leaves
  FROM counted m JOIN prefixes p ON p.c = m.conv_id AND p.depth <= m.depth GROUP BY p.depth, p.k),
ends AS (
  SELECT p.depth, p.k, string_agg(p.c::VARCHAR, ',' ORDER BY p.c) AS ids
  FROM prefixes p JOIN (SELECT c, max(depth) AS depth FROM prefixes GROUP BY c) USING (c, depth) GROUP BY p.depth, p.k)
SELECT a.conv_id, a.depth, b.conv_id AS parent_conv_id, a.n AS n_convs, a.n_children, s.leaves AS n_leaves,
  s.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted a JOIN sums s USING (depth, k) LEFT JOIN ends e USING (depth, k)
LEFT JOIN nodes b ON b.depth = a.depth - 1 AND b.k = a.pk
"""
