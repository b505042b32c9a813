"""Near-duplicates by 64-bit similarity hashes and a segment-popcount embedding.

A fingerprint is cut into segments; the vector of their bit counts is an
embedding whose Manhattan distance never exceeds the number of differing bits.
Fingerprints at most ``max_bits`` apart are therefore found by a range join in
that space. If two vectors of segments are at most 3 apart, one of their halves
is at most 1 apart, so each distinct fingerprint is posted, for either half, in
its own grid cell and in the cells one step up along each axis: two vectors one
step apart meet in the upper one's cell. A cell with more members than
``cell_rows`` is split by the halves of the segments not used yet (the bound of 3
still holds for those), down to single segments; what is left then is compared
in pairs of bounded blocks. Everything that meets in a cell is verified on the
whole fingerprints. A cell reports a spanning star of each group that it links,
not all pairs, and components are joined over all cells.

Copies share one fingerprint and are collapsed before the join (map-side
aggregation); documents get their component back by fingerprint and one of 64
parts, so a fingerprint that a third of the documents share is spread out.

Defined cases
* words are `[^\\x20\\x09-\\x0D]+` of the whole text, A-Z lower-cased; with fewer words than a
  shingle has, the whole sequence is the shingle;
* null and empty texts have no shingles and fingerprint zero, which links like any other;
* a null doc_id keeps its row and is never the smallest of a component unless all are null;
* repeated rows keep their rows; one doc_id with two texts has a row (and component) for each;
* other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .storage import Workspace

SHINGLE = 3
SEED = 42
MAX_BITS = 3
SEGMENT = 2
CELL_ROWS = 4096
LINKS_AT_ONCE = 1 << 20
PARTS = 64
SHINGLES_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The similarity hash of one whole text in UTF-8; bit i is set where over half of the hashes set it."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(width, len(words))
    total = len(words) - width + 1
    starts, ends = starts[:total].tolist(), ends[width - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, dtype="int64")
    for at in range(0, total, SHINGLES_AT_ONCE):
        stop = min(at + SHINGLES_AT_ONCE, total)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:stop], ends[at:stop])), "<u8", stop - at)
        counts += np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="int64")
    bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty(len(batch), dtype="<u8")
            for i, text in enumerate(batch.column(1)):
                out[i] = fingerprint(text.as_buffer().to_pybytes() if text.is_valid else b"", width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view("<i8"))], names=["doc_id", "fp"])

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, "doc_id bigint, fp bigint")


def popcounts(fps: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Bit counts of the segments of unsigned fingerprints, one row each."""
    bits = np.unpackbits(fps.astype("<u8").view("u1").reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(fps), 64 // segment, segment).sum(axis=2, dtype="u1")


def _mix(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a key and a value (fixed constants of the splitmix64 generator)."""
    with np.errstate(over="ignore"):
        z = key * np.uint64(0x9E3779B97F4A7C15) + value
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


POST = "cell bigint, fp bigint, lo int, hi int, up boolean"


def posted(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Deal (cell, fp, lo, hi): for both halves of the segments lo to hi, a row in the own cell of that half and one in
    every cell one step up (``up``). Returns (cell, fp, lo, hi, up), lo to hi being the other half."""
    largest = segment

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                cell, fp, lo, hi = (part.column(i).to_numpy(zero_copy_only=False) for i in range(4))
                counts = popcounts(fp.view("u8"), segment)
                for low, high in {(int(a), int(b)) for a, b in zip(lo, hi)}:
                    mine = np.flatnonzero((lo == low) & (hi == high))
                    middle = (low + high) // 2
                    for first, last, rest in ((low, middle, (middle, high)), (middle, high, (low, middle))):
                        yield from _cells(cell[mine].view("u8"), fp[mine], counts[mine, first:last], first, rest)

    def _cells(cell, fp, counts, first, rest):
        size = counts.shape[1]
        weights = np.uint64(largest + 1) ** np.arange(size, dtype="u8")
        place = counts.astype("u8") @ weights
        base = _mix(cell, np.full(len(cell), first + 1, dtype="u8"))
        yield _post(_mix(base, place), fp, rest, False)
        for axis in range(size):
            rises = counts[:, axis] < largest
            yield _post(_mix(base[rises], place[rises] + weights[axis]), fp[rises], rest, True)

    def _post(cells, fp, rest, up):
        n = len(fp)
        return pa.RecordBatch.from_arrays(
            [pa.array(cells.view("i8")), pa.array(fp), pa.array(np.full(n, rest[0], "i4")), pa.array(np.full(n, rest[1], "i4")),
             pa.array(np.full(n, up))], names=["cell", "fp", "lo", "hi", "up"])

    return rows.select("cell", "fp", "lo", "hi").mapInArrow(deal, POST)


def _near(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Unsigned, since numpy counts the bits of a signed number's absolute value."""
    return np.bitwise_count((a ^ b).view("u8")) <= max_bits


def _stars(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index reached from each of 0..count-1 over the links."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links_in_cells(cell: np.ndarray, fp: np.ndarray, up: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by cell: compare every row with the later ones of its cell, return stars as pairs of fingerprints."""
    left, right = np.empty(0, "i8"), np.empty(0, "i8")
    new, size = [], 0
    alive = np.arange(len(cell))
    step = 1
    while True:
        alive = alive[alive + step < len(cell)]
        alive = alive[cell[alive] == cell[alive + step]]
        if size > LINKS_AT_ONCE or not len(alive):
            label = _stars(len(fp), *(np.concatenate(part) for part in zip((left, right), *new)))
            left = np.flatnonzero(label != np.arange(len(fp)))
            right = label[left]
            new, size = [], 0
        if not len(alive):
            return fp[left], fp[right]
        other = alive + step
        hit = _near(fp[alive], fp[other], max_bits) & ~(up[alive] & up[other])
        new.append((alive[hit], other[hit]))
        size += len(new[-1][0])
        step += 1


def _cell_links(members: DataFrame, max_bits: int) -> DataFrame:
    """Links of the cells of bounded size, streamed in the order of the cells."""

    def emit(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                columns = [np.concatenate([a, b]) for a, b in zip(held, columns)]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            held = [c[cut:] for c in columns]
            yield emit(*_links_in_cells(*[c[:cut] for c in columns], max_bits))
        if held is not None:
            yield emit(*_links_in_cells(*held, max_bits))

    dealt = members.select("cell", "fp", "up").repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def _block_links(members: DataFrame, max_bits: int, cell_rows: int) -> DataFrame:
    """The exact way for cells that no segment splits further: each pair of bounded blocks of a cell in a task of its own."""
    known = members.withColumn("blocks", F.ceil(F.col("n") / cell_rows))
    mine = known.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    pairs = mine.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    task = pairs.select(
        F.xxhash64("cell", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"), "fp", "up")
    return _cell_links(task, max_bits)


def links(ws: Workspace, distinct: DataFrame, max_bits: int = MAX_BITS, segment: int = SEGMENT,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b) pairs of fingerprints whose components are those of all pairs at most ``max_bits`` apart."""
    if max_bits > 3:
        raise ValueError("halves at most one step apart cover up to 3 differing bits")
    todo = distinct.select(F.lit(0).cast("bigint").alias("cell"), "fp", F.lit(0).alias("lo"), F.lit(64 // segment).alias("hi"))
    found, level = None, 0
    while True:
        members = ws.save(posted(todo, segment), f"posted-{level}")
        size = members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("up")).alias("homes"))
        counts = ws.save(size.where(F.col("n") > cell_rows), f"large-{level}")
        if not counts.head(1):
            part = _cell_links(members, max_bits)
            return part if found is None else found.union(part)
        part = _cell_links(members.join(counts, "cell", "left_anti"), max_bits)
        met = counts.where("homes > 0")  # no two rows one step up of a cell are compared there
        large = members.join(met, "cell")
        part = part.union(_block_links(large.where("hi - lo < 2"), max_bits, cell_rows))
        found = part if found is None else found.union(part)
        todo = large.where("hi - lo >= 2").select("cell", "fp", "lo", "hi").distinct()
        level += 1


def _part(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(PARTS)).cast("int")


def _parts() -> Column:
    """Aggregate: a bit for every part that a group's rows lie in."""
    return F.bit_or(F.expr("shiftleft(1L, part)"))


def _each(parts: str) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit(parts, p) == 1)


def cluster(docs: DataFrame, max_bits: int = MAX_BITS, width: int = SHINGLE, segment: int = SEGMENT,
            cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    ws = Workspace(docs.sparkSession, "simhash")
    prints = ws.save(fingerprints(docs, width), "prints")
    rows = prints.withColumn("part", _part("doc_id"))
    distinct = ws.save(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), _parts().alias("parts")), "distinct")
    edges = ws.save(links(ws, distinct, max_bits, segment, cell_rows), "links")
    rooted = components(ws, edges, "components")
    known = distinct.join(rooted.select(F.col("a").alias("fp"), F.col("b").alias("root")), "fp", "left").select(
        "fp", "low", F.col("parts").alias("held"), F.coalesce("root", "fp").alias("root"), _part("fp").alias("part"))
    lowest = known.groupBy("root").agg(F.min("low").alias("component_id"), _parts().alias("parts"))
    lowest = lowest.select("root", "component_id", F.explode(_each("parts")).alias("part"))
    named = known.join(lowest, ["root", "part"]).select("fp", "component_id", F.explode(_each("held")).alias("part"))
    return rows.join(named, ["fp", "part"]).select("doc_id", "fp", "component_id")


def _hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def report(docs: DataFrame) -> DataFrame:
    return cluster(docs).select("doc_id", _hex(F.col("fp")).alias("fingerprint"), "component_id")
