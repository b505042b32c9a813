"""Repeated byte strings: suffixes of shared places ordered by deep-shallow sorting, all but the first occurrence cut.

A byte goes if some ``length``-byte string over it also starts earlier (in a
document of smaller id, or before it in the same one).

1. Different texts are laid out once, in files bucketed by their digest; later steps join narrow rows to that
   layout. Of equal texts the first is searched, the others repeat it whole.
2. Every string of ``length`` bytes has an anchor: the leftmost of its
   ``GRAM``-byte grams with the smallest hash. Neighbouring strings share theirs,
   so a text is a row of regions, one per anchor. Equal strings have equal anchors
   in equal places: only regions whose anchor occurs again can repeat.
3. Equal regions repeat their first occurrence whole (found by 128 bits of hash).
   What is left, the first occurrences of different regions around one anchor, differ at the edges of copies.
4. These are dealt by further bytes: the strings of a region whose anchor stands within the same ``STEP`` places
   share the bytes around it, their core. Cores that occur once hold no repeat. The strings of the others are sorted
   in buckets of bounded size: multikey quicksort over 8-byte words to ``SHALLOW`` words, then a blind trie for each
   group that still agrees. Strings that end in one leaf are equal over the whole length; all but the first repeat.
5. A core with more rows than a bucket takes is sorted in several; the first strings of each are sorted once more, dealt by
   their whole content.

Counts and minima over keys come from partial aggregates; rows of a heavy key are salted when those go back to them.

Defined cases
* null text is empty text; texts shorter than ``length`` bytes keep everything;
* rows equal in doc_id and text are one document, each gets the result; rows
  of one doc_id with different texts are ordered by text hash; a null doc_id comes first;
* other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stores import bucket_names
from .storage import Workspace

LENGTH = 100
GRAM = 32
SHALLOW = 3
#: Places of the anchor in a string that are dealt together.
STEP = 24
BUCKET_ROWS = 2000
#: Parts that multikey quicksort no longer splits.
SMALL = 256
#: Texts are searched in pieces of this many string starts.
PIECE = 1 << 19
HEAVY = 1024
SALTS = 32
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE2 = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64."""

    def __init__(self, base: np.uint64, n: int):
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b)]), dtype=np.uint64) for b in (base, inverse))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        return np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], dtype=np.uint64)])

    def hashes(self, prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((prefix[stop] - prefix[start]) * self.down[start])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _lowest(keys: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours."""
    out, width = keys, 1
    while 2 * width <= span:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    return out if width == span else np.minimum(out[: len(keys) - span + 1], out[span - width :])


def regions(data: bytes, length: int, powers: tuple[_Powers, _Powers]):
    """(start, before, after, anchor hash, region hash) arrays: the strings that start from ``start`` on have their
    anchor ``before`` bytes after it, down to ``after`` bytes after the last one's start."""
    whole = np.frombuffer(data, np.uint8)
    span = length - GRAM + 1
    out = []
    for base in range(0, len(whole) - length + 1, PIECE):
        piece = whole[base : base + PIECE + length - 1]
        first = powers[0].prefix(piece)
        at = np.arange(len(piece) - GRAM + 1)
        grams = _mixed((first[GRAM:] - first[:-GRAM]) * powers[0].down[: len(at)])
        keys = (grams & ~np.uint64(0xFFFFF)) | at.astype(np.uint64)  # equal hashes: the left one
        anchor = (_lowest(keys, span) & np.uint64(0xFFFFF)).astype(np.int64)
        edges = np.flatnonzero(np.diff(anchor)) + 1
        left = np.concatenate([[0], edges])
        right = np.concatenate([edges, [len(anchor)]]) - 1
        a = anchor[left]
        content = powers[1].hashes(powers[1].prefix(piece), left, right + length)
        shape = ((a - left) * 1024 + (a - right)).astype(np.uint64)
        out.append((left + base, a - left, a - right, grams[a].view(np.int64), _mixed(content + shape * BASE).view(np.int64)))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5


def _anchors(length: int):
    def run(batches):
        powers = tuple(_Powers(b, PIECE + length) for b in (BASE, BASE2))
        for batch in batches:
            for i, text in enumerate(batch.column("text")):
                start, before, after, gram, region = regions(text.as_py() or b"", length, powers)
                if len(start):
                    doc = pa.array(np.full(len(start), batch.column("doc")[i].as_py(), np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [doc, *map(pa.array, (start, before.astype(np.int32), after.astype(np.int32), gram, region))],
                        names=["doc", "start", "before", "after", "gram", "region"],
                    )

    return run


def _pieces(length: int):
    """Strings of the wanted regions of a text, a row for each run of them that shares a core; ``key`` names the core."""

    def run(batches):
        for batch in batches:
            for text, rows in zip(batch.column("text"), batch.column("wanted")):
                data, out = text.as_py(), []
                for r in rows.as_py():
                    doc, at, before, after = r["doc"], r["start"] + r["before"], r["before"], r["after"]
                    for low in range(after // STEP * STEP, before + 1, STEP):
                        high = min(low + STEP - 1, length - GRAM)
                        core = hashlib.blake2b(data[at - low : at - high + length], digest_size=8, key=bytes([low])).digest()
                        start, last = at - min(high, before), at - max(low, after)
                        out.append((int.from_bytes(core, "big", signed=True), doc, start, data[start : last + length]))
                    if len(out) >= 8192:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)

    return run


PIECES = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECES)], schema=PIECES)


def shallow_groups(words: np.ndarray, depth: int) -> list[np.ndarray]:
    """Multikey quicksort of rows by their first ``depth`` words; groups of rows that agree on them, in order."""
    out, stack = [], [(np.arange(len(words)), 0)]
    while stack:
        rows, d = stack.pop()
        if len(rows) < 2 or d == depth:
            out.append(rows)
            continue
        column = words[rows, d]
        if len(rows) <= SMALL:  # small parts: the remaining words at once
            order = np.lexsort([words[rows, k] for k in range(depth - 1, d - 1, -1)])
            part = words[rows[order], d:depth]
            cuts = np.flatnonzero((part[1:] != part[:-1]).any(axis=1)) + 1
            rows, cuts = rows[order], cuts.tolist()
            out.extend(rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)]))
            continue
        pivot = np.partition(column, len(column) // 2)[len(column) // 2]
        for test, deeper in ((column > pivot, 0), (column == pivot, 1), (column < pivot, 0)):
            if test.any():
                stack.append((rows[test], d + deeper))
    return out


class BlindTrie:
    """Strings of one length in order; a branch knows its depth and next bytes only, a leaf one string and all who equal it."""

    def __init__(self):
        self.root = None

    def add(self, string: bytes, who: int) -> None:
        if self.root is None:
            self.root = (string, [who])
            return
        node = self.root
        while len(node) == 3:  # blind descent: skipped bytes are not compared
            node = node[1].get(string[node[0]]) or node[2]
        other = node[0]
        if other == string:
            node[1].append(who)
            return
        differ = (int.from_bytes(string, "big") ^ int.from_bytes(other, "big")).bit_length()
        depth = len(string) - (differ + 7) // 8
        node, holder, byte = self.root, None, None
        while len(node) == 3 and node[0] < depth:
            holder, byte = node, string[node[0]]
            node = node[1][byte]
        leaf = (string, [who])
        if len(node) == 3 and node[0] == depth:
            node[1][string[depth]] = leaf
            return
        branch = (depth, {string[depth]: leaf, other[depth]: node}, node)
        if holder is None:
            self.root = branch
        else:
            holder[1][byte] = branch

    def leaves(self):
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if len(node) == 3:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node


def deep_shallow(suffixes: np.ndarray, length: int) -> list[list[int]]:
    """Groups of equal rows of a byte matrix, in lexicographic order; the rows of a group ascend."""
    padded = np.zeros((len(suffixes), -(-length // 8) * 8), np.uint8)
    padded[:, :length] = suffixes
    words, out = padded.view(">u8").astype(np.uint64), []
    if not len(words):
        return out
    groups = shallow_groups(words, min(SHALLOW, words.shape[1]))
    order, sizes = np.concatenate(groups), np.array([len(g) for g in groups])
    first = np.cumsum(sizes) - sizes
    same = np.concatenate([[True], (words[order[1:]] == words[order[:-1]]).all(axis=1)])
    same[first] = True
    for rows, copies in zip(groups, np.logical_and.reduceat(same, first).tolist()):
        if copies:  # equal over the whole length: they need no trie
            out.append(rows.tolist())
            continue
        trie = BlindTrie()
        for i in rows.tolist():
            trie.add(suffixes[i].tobytes(), i)
        out.extend(who for _, who in trie.leaves())
    return out


def _sorted_repeats(length: int):
    """Runs of strings that repeat an earlier one of the bucket, and, of rows marked ``again``, the first ones with their bytes."""

    def run(rows: pa.Table) -> pa.Table:
        views, docs, starts, merge = [], [], [], []
        for doc, at, again, data in zip(*(rows.column(c).to_pylist() for c in ("doc", "start", "again", "bytes"))):
            view = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, np.uint8), length)
            views.append(view)
            docs.append(np.full(len(view), doc))
            starts.append(np.arange(len(view)) + at)
            merge.append(np.full(len(view), again))
        doc, start, merge = (np.concatenate(c) for c in (docs, starts, merge))
        order = np.lexsort([start, doc])  # the first row of a group is the first occurrence
        doc, start, merge, strings = doc[order], start[order], merge[order], np.concatenate(views)[order]
        gone, kept = [], []
        for group in deep_shallow(strings, length):
            gone.extend(group[1:])
            if merge[group[0]]:
                kept.append(group[0])
        gone, kept = np.sort(np.array(gone, np.int64)), np.array(kept, np.int64)
        d, s = doc[gone], start[gone]
        fresh = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + length)]) if len(gone) else np.empty(0, bool)
        last = np.concatenate([fresh[1:], [True]]) if len(gone) else fresh
        columns = [
            pa.array(np.concatenate([d[fresh], doc[kept]]).astype(np.int64)),
            pa.array(np.concatenate([s[fresh], start[kept]]).astype(np.int64)),
            pa.array(np.concatenate([s[last], start[kept]]).astype(np.int64) + length),
            pa.array([None] * int(fresh.sum()) + [strings[i].tobytes() for i in kept], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, names=["doc", "start", "stop", "bytes"])

    return run


def _sorted(rows: DataFrame, bucket: Column, length: int) -> DataFrame:
    dealt = rows.select("doc", "start", "bytes", "again", bucket.alias("bucket"))
    return dealt.groupBy("bucket").applyInArrow(_sorted_repeats(length), "doc long, start long, stop long, bytes binary")


def _buckets(n: int, size: int) -> Column:
    return F.lit(max(1, -(-n // size)))


def _joined(rows: DataFrame, keys: list[str], totals: DataFrame) -> DataFrame:
    """``rows`` with the totals of their key (a row per key, ``n`` its number of rows; keys without a row there go).

    A key with more than 1/``HEAVY`` of all rows is heavy. There are fewer than ``HEAVY`` of them, so they
    are broadcast, and their rows are dealt over ``SALTS`` tasks."""
    least = rows.count() / HEAVY
    heavy = totals.where(F.col("n") > least).select(*keys, F.lit(True).alias("heavy"))
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("doc", "start"), F.lit(SALTS)).cast("int")).otherwise(0)
    dealt = rows.join(F.broadcast(heavy), keys, "left").withColumn("salt", salt).drop("heavy")
    salts = F.when(F.col("n") > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(totals.withColumn("salt", F.explode(salts)), [*keys, "salt"]).drop("salt")


def _layout(ws: Workspace, docs: DataFrame) -> DataFrame:
    """digest, text: one row of each text, in as many buckets as a shuffle has partitions, so that joins by digest leave it in place.
    Copies meet in the partial aggregates."""
    spark = docs.sparkSession
    texts = docs.groupBy("digest").agg(F.first("text").alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with bucket_names(spark, "texts") as (name,):
        writer = texts.write.format("parquet").option("path", ws.folder("texts")).option("compression", "zstd")
        writer.bucketBy(buckets, "digest").sortBy("digest").saveAsTable(name)
        return spark.table(name)


def _cut(spans: list[dict], n: int) -> tuple[list[tuple[int, int]], int]:
    merged = []
    for s in sorted((r["start"], r["stop"]) for r in spans):
        if merged and s[0] <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], s[1]))
        else:
            merged.append(s)
    return merged, sum(b - a for a, b in merged)


def _kept(batches):
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans")):
            data = text.as_py()
            merged, removed = _cut(spans.as_py(), len(data))
            at, parts = 0, []
            for a, b in merged:
                parts.append(data[at:a])
                at = b
            parts.append(data[at:])
            flat = [x for span in merged for x in span]
            out.append((removed, len(merged), hashlib.sha256(b"".join(parts)).hexdigest(), flat))
        columns = list(zip(*out)) if out else [()] * 4
        types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), *(pa.array(c, t) for c, t in zip(columns, types))],
            names=["doc", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def _spans(ws: Workspace, texts: DataFrame, leads: DataFrame, length: int) -> DataFrame:
    """doc, start, stop of repeats in the texts of ``leads`` (digest, doc)."""
    anchors = texts.join(leads, "digest").select("doc", "text")
    anchors = ws.save(anchors.mapInArrow(_anchors(length), "doc long, start long, before int, after int, gram long, region long"), "anchors")
    count = F.count("*").alias("n")
    grams = ws.save(anchors.groupBy("gram").agg(count).where("n > 1"), "grams")
    hits = ws.save(_joined(anchors, ["gram"], grams).drop("n"), "hits")
    ws.drop("anchors")

    place = F.min(F.struct("doc", "start", "before", "after")).alias("f")
    regions = ws.save(hits.groupBy("gram", "region").agg(place, count), "regions")
    again = regions.where("n > 1").select("gram", "region", "n", F.col("f.doc").alias("fd"), F.col("f.start").alias("fs"))
    equal = _joined(hits, ["gram", "region"], again).where("doc != fd or start != fs").select(
        "doc", "start", (F.col("start") + F.col("before") - F.col("after") + length).alias("stop")
    )
    first = regions.select("gram", "f.*")
    several = ws.save(first.groupBy("gram").agg(count).where("n > 1"), "several")
    wanted = _joined(first, ["gram"], several)
    lists = wanted.groupBy("doc").agg(F.collect_list(F.struct("doc", "start", "before", "after")).alias("wanted"))  # of one document
    places = lists.join(leads, "doc").select("digest", "wanted")
    pieces = texts.join(places, "digest").select("text", "wanted")
    pieces = ws.save(pieces.mapInArrow(_pieces(length), "key long, doc long, start long, bytes binary"), "pieces")

    cores = ws.save(pieces.groupBy("key").agg(count).where("n > 1"), "cores")
    sharing = ws.save(_joined(pieces, ["key"], cores), "sharing")
    ws.drop("pieces")
    width = F.ceil(F.col("n") / BUCKET_ROWS)
    bucket = F.pmod(F.xxhash64("key", F.pmod(F.xxhash64("start", "doc"), width)), _buckets(sharing.count(), BUCKET_ROWS))
    near = ws.save(_sorted(sharing.withColumn("again", width > 1), bucket, length), "sorted")
    left = near.where("bytes is not null").withColumn("again", F.lit(False))
    bucket = F.pmod(F.xxhash64("bytes"), _buckets(left.count(), BUCKET_ROWS * STEP))
    return equal.unionByName(near.where("bytes is null").drop("bytes")).unionByName(_sorted(left, bucket, length).drop("bytes"))


def repeated(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (starts and stops of the cut runs)."""
    ws = Workspace(documents.sparkSession, "repeats")
    docs = documents.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    docs = docs.withColumn("digest", F.sha2("text", 256))
    rows = ws.save(docs.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "rows")
    # One row per document, numbered in order of doc_id: ranges first, then positions within each.
    keys = rows.distinct().repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest")
    keys = ws.save(keys.withColumn("doc", F.monotonically_increasing_id()), "keys")
    long = keys.where(F.col("n_bytes") >= length).withColumn("start", F.lit(0))
    firsts = ws.save(long.groupBy("digest").agg(F.min("doc").alias("lead"), F.count("*").alias("n")), "firsts")
    leads = firsts.select("digest", F.col("lead").alias("doc"))
    texts = _layout(ws, docs.where(F.octet_length("text") >= length))
    spans = _spans(ws, texts, leads, length).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    spans = ws.save(spans.join(leads, "doc"), "spans")
    cut = texts.join(spans, "digest").select("doc", "text", "spans")
    cut = cut.mapInArrow(_kept, "doc long, n_removed long, n_spans long, kept_sha256 string, removed array<bigint>")
    # Only documents with something to cut carry an entry; the others are untouched, later copies are cut whole.
    none = [F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(hashlib.sha256(b"").hexdigest()).alias("kept_sha256")]
    copies = _joined(long, ["digest"], firsts.where("n > 1")).where("doc != lead")
    copies = copies.select("doc", *none, F.array(F.lit(0).cast("long"), "n_bytes").alias("removed"))
    marks = ws.save(cut.unionByName(copies).join(keys.drop("n_bytes"), "doc").drop("doc"), "marks")
    same = F.col("r.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("r.digest") == F.col("m.digest"))
    return rows.alias("r").join(marks.alias("m"), same, "left").select(
        "r.doc_id", "r.n_bytes",
        *(F.coalesce(f"m.{c}", F.lit(0)).alias(c) for c in ("n_removed", "n_spans")),
        F.coalesce("m.kept_sha256", "r.digest").alias("kept_sha256"),
        F.coalesce("m.removed", F.array().cast("array<bigint>")).alias("removed"),
    )


def report(documents: DataFrame) -> DataFrame:
    return repeated(documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
