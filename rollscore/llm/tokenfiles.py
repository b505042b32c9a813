"""Token-id files with bit-plane shuffled, zstandard-compressed blocks.

Documents are range-partitioned by doc_id, or by another column that orders them
(``order``); each partition is encoded and streamed to one file, so the files in
partition order hold all ids in ascending order of it. Ids are cut into blocks of a fixed size, a block's 32-bit ids are
transposed into byte or bit planes, and each plane is compressed on its own
(high planes of small ids vanish). File layout, integers little-endian:

    b"IDPLANE1"
    planes of block 0, planes of block 1, ...
    Arrow stream, zstandard-compressed: doc_id, n_tokens of each document
    Arrow stream, zstandard-compressed: the chunk index (offset of the block,
        number of ids, compressed length of each plane)
    3 x uint64: offset of the documents, offset of the index, kind (8 byte planes, 1 bit planes)
    b"IDPLANE1"

A file is written under a temporary name and renamed, so a task that runs again
replaces it whole; the manifest (one row per file) is stored before it is read.

Defined cases
* null text is empty text: only the end id;
* equal doc_ids stay apart, ordered by text; null doc_ids come first;
* other columns are ignored; an empty table gives no files and no rows;
* a text of any length is encoded whole, chunk by chunk.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .storage import Workspace

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
END_ID = 2
CACHE_ENTRIES = 200_000
#: Parts of a tokenizer file for which words may be encoded one at a time: blanks only separate, letter runs, digits and
#: sign runs are encoded by themselves, and case and spacing do not reach the vocabulary. Other files encode whole texts.
BY_WORDS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pre_tokenizer": ["Split", "ByteLevel"],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: Texts are encoded together up to so many bytes; a longer one alone.
TEXT_BYTES = 1 << 24


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of whole texts as little-endian uint32 bytes, by a vocabulary that drops blanks.

    The blank-separated chunks of many texts are numbered in Arrow, each different one is
    encoded once, and the ids are gathered by number. A chunk of
    plain Latin letters, digits and signs is cut into its letter runs, digits
    and sign runs, as the tokenizer's own pattern does, and each is looked up in
    the vocabulary model; every other chunk goes through the whole tokenizer. Both are remembered.
    """

    #: Printable ASCII and the letters of Latin-1.
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    #: The pattern of ``BY_WORDS`` for lower-case plain chunks.
    PIECES = re.compile("'(?:[stmd]|re|ve|ll)|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.by_words = _encodes_by_words(json.loads(self.whole.to_str()))
        self.model = self.whole.model
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # The model spells bytes as printable characters; the fixed rule of byte-level vocabularies.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.spelling = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        #: A chunk without the first character of any special holds no special.
        self.firsts = re.compile("[" + re.escape("".join({s[0] for s in self.specials})) + "]") if self.specials else None
        self.pieces, self.others = _Memo(self._piece), _Memo(self._other)

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() else "".join([self.spelling[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _other(self, chunk: str) -> bytes:
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        if not self.PLAIN.fullmatch(chunk) or self.firsts and self.firsts.search(chunk):
            return self.others[chunk]
        chunk = chunk.lower()
        if chunk.isalpha():
            return self.pieces[chunk]
        return b"".join(map(self.pieces.__getitem__, self.PIECES.findall(chunk)))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all(pa.array([text])))

    def encode_all(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, null being empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_words:
            for text in texts:
                yield self._other(text.as_py())
            return
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(texts):
            most = (sizes[at - 1] if at else 0) + TEXT_BYTES
            stop = max(at + 1, int(np.searchsorted(sizes, most, "right")))
            yield from self._encoded(texts.slice(at, stop - at))
            at = stop

    def _encoded(self, texts: pa.Array) -> Iterator[bytes]:
        chunks = pc.ascii_split_whitespace(texts)
        coded = chunks.flatten().dictionary_encode()
        ids = [self._chunk(c) for c in _strings(coded.dictionary)]
        ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
        pool = pa.LargeListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<u4"))
        found = pool.take(coded.indices)
        data = memoryview(found.flatten().to_numpy().tobytes())
        counts = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).to_numpy())])
        edges = 4 * (found.offsets.to_numpy() - found.offsets[0].as_py())[counts]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield bytes(data[a:b])


def _strings(chunks: pa.Array) -> list[str]:
    """The chunks, which hold no blanks."""
    whole = pa.LargeListArray.from_arrays([0, len(chunks)], chunks.cast(pa.large_string()))
    return pc.binary_join(whole, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ") if len(chunks) else []


def _encodes_by_words(parts: dict) -> bool:
    """Whether a tokenizer file has the parts of ``BY_WORDS``."""
    normal = (parts.get("normalizer") or {}).get("normalizers") or []
    cut = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [n["type"] for n in normal] != BY_WORDS["normalizer"] or [c["type"] for c in cut] != BY_WORDS["pre_tokenizer"]:
        return False
    blanks = normal[1]["pattern"].get("Regex") == r"\s+" and normal[1]["content"] == " "
    split = cut[0]["pattern"].get("Regex") == BY_WORDS["split"] and cut[0]["behavior"] == "Removed" and cut[0]["invert"]
    plain = not cut[1]["add_prefix_space"] and not cut[1]["use_regex"] and not any(
        t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in parts["added_tokens"])
    return blanks and split and plain and parts["model"]["type"] == "BPE" and not parts["model"]["dropout"]


class _Memo(dict):
    """Remembers what was used lately: a full generation of entries becomes the old one, and an old entry that is used
    again comes back, so that frequent words survive any number of rare ones."""

    def __init__(self, fill):
        super().__init__()
        self.fill, self.old = fill, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.fill(key)
        if len(key) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def to_planes(ids: np.ndarray, kind: int) -> list[bytes]:
    """Planes of a block: kind 8 gives 4 byte planes, kind 1 gives 32 bit planes, least significant first."""
    octets = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4))
    if kind == 8:
        return [p.tobytes() for p in octets.T]
    return [p.tobytes() for p in np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], count: int, kind: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if kind == 1:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=count, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.ZstdCompressor().compress(sink.getvalue().to_pybytes())


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


class FileWriter:
    """Streams documents into one file; holds one block of ids at a time."""

    def __init__(self, out, id_type: pa.DataType, kind: int, block_ids: int):
        self.out, self.id_type, self.kind, self.block_bytes = out, id_type, kind, 4 * block_ids
        self.zstd = zstandard.ZstdCompressor(level=3)
        self.at, self.pending, self.size = 0, [], 0
        self.docs, self.counts, self.index = [], [], []
        self._put(MAGIC)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id, ids: bytes) -> None:
        self.docs.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.pending.append(ids)
        self.size += len(ids)
        if self.size >= self.block_bytes:
            data = b"".join(self.pending)
            whole = len(data) - len(data) % self.block_bytes
            for i in range(0, whole, self.block_bytes):
                self._block(data[i : i + self.block_bytes])
            self.pending, self.size = [data[whole:]], len(data) - whole

    def _block(self, data: bytes) -> None:
        planes = [self.zstd.compress(p) for p in to_planes(np.frombuffer(data, "<u4"), self.kind)]
        self.index.append((self.at, len(data) // 4, [len(p) for p in planes]))
        self._put(b"".join(planes))

    def close(self) -> None:
        if self.size:
            self._block(b"".join(self.pending))
        docs_at = self.at
        self._put(_packed(pa.table({"doc_id": pa.array(self.docs, self.id_type), "n_tokens": pa.array(self.counts, pa.int64())})))
        index_at = self.at
        offset, ids, lengths = zip(*self.index) if self.index else ((), (), ())
        index = {"offset": pa.array(offset, pa.int64()), "n_ids": pa.array(ids, pa.int32()), "lengths": pa.array(lengths, pa.list_(pa.int32()))}
        self._put(_packed(pa.table(index)))
        self._put(struct.pack("<3Q", docs_at, index_at, self.kind) + MAGIC)


def read_file(source):
    """Yields (doc_id, ids as bytes) of a file open for random access, block by block."""
    size = source.size()
    tail = source.read_at(32, size - 32)
    docs_at, index_at, kind = struct.unpack("<3Q", tail[:24])
    if tail[24:] != MAGIC or source.read_at(8, 0) != MAGIC:
        raise ValueError("not a token file")
    docs = _unpacked(source.read_at(index_at - docs_at, docs_at))
    index = _unpacked(source.read_at(size - 32 - index_at, index_at))
    zstd = zstandard.ZstdDecompressor()

    def blocks():
        for row in zip(*(index.column(c).to_pylist() for c in ("offset", "n_ids", "lengths"))):
            data, planes, at = source.read_at(sum(row[2]), row[0]), [], 0
            for n in row[2]:
                planes.append(zstd.decompress(data[at : at + n]))
                at += n
            yield from_planes(planes, row[1], kind).tobytes()

    stream, held, at = blocks(), b"", 0
    for doc_id, count in zip(docs.column("doc_id").to_pylist(), docs.column("n_tokens").to_pylist()):
        need, parts = 4 * count, []
        while need:
            if at == len(held):
                held, at = next(stream), 0
            part = held[at : at + need]
            parts.append(part)
            need -= len(part)
            at += len(part)
        yield doc_id, b"".join(parts)


def _write(folder: str, tokenizer: str, end_id: int, kind: int, block_ids: int):
    def run(batches):
        encoder, end = Encoder(tokenizer), struct.pack("<I", end_id)
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base)
        part = TaskContext.get().partitionId()
        path, writer, out = f"{base}/part-{part:06d}.ids", None, None
        draft = f"{base}/_draft-{part:06d}-{uuid.uuid4().hex}"
        docs = ids = 0
        for batch in batches:
            column = batch.column("doc_id")
            for i, found in enumerate(encoder.encode_all(batch.column("text"))):
                if writer is None:
                    out = fs.open_output_stream(draft)
                    writer = FileWriter(out, column.type, kind, block_ids)
                data = found + end
                writer.add(column[i].as_py(), data)
                docs, ids = docs + 1, ids + len(data) // 4
        if writer is not None:
            writer.close()
            out.close()
            fs.move(draft, path)
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "n_docs": [docs], "n_ids": [ids]}, schema=MANIFEST)

    return run


MANIFEST = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])


def write_token_files(documents: DataFrame, folder: str, manifest_to: Workspace, tokenizer: str | None = None, end_id: int = END_ID,
                      kind: int = 8, block_ids: int = BLOCK_IDS, order: str = "doc_id") -> DataFrame:
    """Writes the files below ``folder`` (any address pyarrow opens) and returns the stored manifest."""
    keys = list(dict.fromkeys([order, "doc_id", "text"]))
    docs = documents.select(*keys).repartitionByRange(order).sortWithinPartitions(*keys).select("doc_id", "text")
    rows = docs.mapInArrow(_write(folder, tokenizer or tokenizer_file(), end_id, kind, block_ids), "part int, path string, n_docs long, n_ids long")
    return manifest_to.save(rows, "manifest")


def _documents(folder: str):
    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at, out = row["start"], []
                with fs.open_input_file(row["path"]) as source:
                    for doc_id, ids in read_file(source):
                        out.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
                        at += len(ids) // 4
                        if len(out) == 8192:
                            yield _rows(out)
                            out = []
                if out:
                    yield _rows(out)

    def _rows(out):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read_token_files(manifest: DataFrame, folder: str, id_type: T.DataType) -> DataFrame:
    """One row per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = manifest.select("part", "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long").alias("start"))
    schema = T.StructType([T.StructField("doc_id", id_type), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens", "ids_crc32"))])
    return files.select("path", "start").repartition(max(1, manifest.count())).mapInArrow(_documents(folder), schema)


def report(documents: DataFrame, kind: int = 8, block_ids: int = BLOCK_IDS, order: str = "doc_id") -> DataFrame:
    ws = Workspace(documents.sparkSession, "tokens")
    folder = ws.folder("files")
    address = folder if re.match(r"[a-z0-9]+:", folder) else f"file://{os.path.abspath(folder)}"
    manifest = write_token_files(documents, address, ws, kind=kind, block_ids=block_ids, order=order)
    return read_token_files(manifest, address, documents.schema["doc_id"].dataType)
