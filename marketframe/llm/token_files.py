"""Token ids in bit-plane files.

A file holds the ids of consecutive documents. It is cut into blocks of a fixed number of ids; each
block is transposed into 4 byte planes (plane b has byte b of every id) or 32 bit planes, and each
plane is compressed by itself with zstandard, so that the high planes, nearly constant, cost next to
nothing. Byte planes are the default: on the test texts they pack smaller, in a quarter of the time.
After the planes come the chunk index (per block: where each plane starts and how long it is) and the
document index, then their sizes, so that one block can be read without the rest:

    b"BPL1" | planes ... | chunk index | document index | footer

    chunk index     per block: first id (u8), ids (u4), per plane offset (u8) and size (u4)
    document index  zstandard over doc_ids (i8) then ends (u8), and a bit for null doc_ids
    footer          planes (u4), block ids (u4), blocks (u8), documents (u8), place of the chunk
                    index (u8), place and size of the document index (u8, u8), b"BPL1"

A task writes each file under a name of its own and returns that name; only names in the written
manifest count. A repeated or lost task therefore leaves at most an unlisted file behind.
"""

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.common import all_slices, ship, spill
from marketframe.session import scratch_dir

MAGIC, BLOCK_IDS, END_ID = b"BPL1", 1 << 16, 0
BYTE_PLANES, BIT_PLANES = 4, 32
FOOTER = struct.Struct("<IIQQQQQ4s")
FILE_IDS, FILE_DOCS = 64 << 20, 1 << 20  # after either, a task begins another file
MANIFEST = "file string, first long, number long, docs long, ids long"


def open_store(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system and path of a shared folder: local, S3, GCS or HDFS."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    if "://" not in uri and not uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), uri
    return arrow_fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


# ---- encoding -------------------------------------------------------------------------------


class Encoder:
    """Encodes texts with a tokenizers file, each distinct piece once.

    A piece is a run of white space and the run of other characters after it. Byte-level
    pre-tokens never reach over a place where white space follows another character, so that the
    ids of a text are those of its pieces, one after the other. Texts with characters that are
    white space to Python but not to the tokenizer are encoded whole.
    """

    PIECE, ODD, HELD = re.compile(r"\s*\S+|\s+"), re.compile("[\x1c-\x1f]"), 1_000_000
    TOGETHER, AT_ONCE = 256, 64  # pieces to a text, texts to a call

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        vocabulary = self.tokenizer.get_vocab()
        # Byte-level tokens are written with one character for each byte.
        self.widths = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, id_ in vocabulary.items():
            self.widths[id_] = len(token)

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in encoded]

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of distinct pieces. Those that begin with white space and end without can follow one
        another in one text; where its tokens' widths do not end where the pieces do (a tokenizer that
        changes the text), they are encoded one by one."""
        joint = [p for p in pieces if p[0].isspace() and not p[-1].isspace() and not self.ODD.search(p)]
        alone = list(set(pieces).difference(joint))
        found: dict[str, bytes] = {}
        size = self.TOGETHER * self.AT_ONCE
        for at in range(0, len(joint), size):
            call = joint[at : at + size]
            parts = [call[k : k + self.TOGETHER] for k in range(0, len(call), self.TOGETHER)]
            for part, ids in zip(parts, self.encode_texts(["".join(p) for p in parts]), strict=True):
                ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in part])
                reached = np.cumsum(self.widths[ids])
                cuts = np.searchsorted(reached, ends) + 1
                if cuts[-1] != len(ids) or not np.array_equal(reached[cuts - 1], ends):
                    alone += part
                    continue
                raw, cuts = ids.tobytes(), (4 * cuts).tolist()
                found.update(zip(part, map(raw.__getitem__, map(slice, [0, *cuts], cuts)), strict=False))
        for at in range(0, len(alone), 4096):
            part = alone[at : at + 4096]
            found.update(zip(part, (ids.tobytes() for ids in self.encode_texts(part)), strict=True))
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.HELD:  # about 200 MB; what came first is what is frequent
            self.known = dict(islice(self.known.items(), self.HELD // 2))
        cut = [[t] if self.ODD.search(t) else self.PIECE.findall(t) for t in texts]
        missing = list(set(chain.from_iterable(cut)).difference(self.known))
        self.known.update(self.encode_pieces(missing))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- file format ----------------------------------------------------------------------------


def to_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == BYTE_PLANES:
        return [raw[:, b].tobytes() for b in range(BYTE_PLANES)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, b], bitorder="little").tobytes() for b in range(BIT_PLANES)]


def from_planes(planes: list[bytes], count: int) -> np.ndarray:
    if len(planes) == BYTE_PLANES:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        rows = [np.unpackbits(np.frombuffer(p, np.uint8), count=count, bitorder="little") for p in planes]
        raw = np.packbits(np.stack(rows, axis=1), axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class FileWriter:
    """Writes one file; holds at most one block and the document index."""

    def __init__(self, out, planes: int = BYTE_PLANES, block_ids: int = BLOCK_IDS) -> None:
        self.out, self.planes, self.block_ids = out, planes, block_ids
        self.at, self.ids, self.left, self.held = len(MAGIC), 0, [], 0
        self.chunks, self.doc_ids, self.ends = [], [], []
        self.pack = zstandard.ZstdCompressor(level=3)
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.left.append(ids)
        self.held += len(ids) // 4
        self.ids += len(ids) // 4
        self.doc_ids.append(doc_id)
        self.ends.append(self.ids)
        if self.held >= self.block_ids:
            flat = np.frombuffer(b"".join(self.left), dtype="<u4")
            whole = len(flat) // self.block_ids * self.block_ids
            for start in range(0, whole, self.block_ids):
                self._block(flat[start : start + self.block_ids])
            self.left, self.held = [flat[whole:].tobytes()], len(flat) - whole

    def _block(self, ids: np.ndarray) -> None:
        first = self.chunks[-1][0] + self.chunks[-1][1] if self.chunks else 0
        places = []
        for plane in to_planes(ids, self.planes):
            packed = self.pack.compress(plane)
            self.out.write(packed)
            places += [self.at, len(packed)]
            self.at += len(packed)
        self.chunks.append((first, len(ids), *places))

    def close(self) -> tuple[int, int]:
        """(documents, ids) of the file."""
        rest = np.frombuffer(b"".join(self.left), dtype="<u4")
        if len(rest):
            self._block(rest)
        chunk = struct.Struct("<QI" + "QI" * self.planes)
        index = b"".join(chunk.pack(*c) for c in self.chunks)
        doc_ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes()
        nulls = np.packbits(np.array([d is None for d in self.doc_ids], dtype=bool)).tobytes()
        documents = self.pack.compress(doc_ids + np.array(self.ends, dtype="<u8").tobytes() + nulls)
        self.out.write(index + documents)
        place = self.at + len(index)
        self.out.write(
            FOOTER.pack(self.planes, self.block_ids, len(self.chunks), len(self.ends), self.at,
                        place, len(documents), MAGIC)
        )
        self.out.close()
        return len(self.ends), self.ids


class FileReader:
    """Random access to one file."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        foot = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if foot[-1] != MAGIC:
            raise ValueError("not a bit-plane file, or cut short")
        self.planes, self.block_ids, blocks, docs, place, documents, length = foot[:-1]
        chunk = struct.Struct("<QI" + "QI" * self.planes)
        self.chunks = list(chunk.iter_unpack(self._at(place, chunk.size * blocks)))
        raw = zstandard.ZstdDecompressor().decompress(self._at(documents, length))
        self.doc_ids = np.frombuffer(raw, "<i8", docs)
        self.ends = np.frombuffer(raw, "<u8", docs, 8 * docs).astype(np.int64)
        self.null = np.unpackbits(np.frombuffer(raw, np.uint8, offset=16 * docs), count=docs)

    def _at(self, place: int, length: int) -> bytes:
        self.source.seek(place)
        return self.source.read(length)

    def block(self, number: int) -> np.ndarray:
        chunk, unpack = self.chunks[number], zstandard.ZstdDecompressor()
        # The planes of a block lie one after the other: one read.
        start, sizes = chunk[2], chunk[3::2]
        raw, at, planes = self._at(start, sum(sizes)), 0, []
        for size in sizes:
            planes.append(unpack.decompress(raw[at : at + size]))
            at += size
        return from_planes(planes, chunk[1])

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the file, ids) of each document, one block at a time in memory."""
        number, held, base = 0, np.zeros(0, "<u4"), 0
        for i, end in enumerate(self.ends.tolist()):
            start, parts = (int(self.ends[i - 1]) if i else 0), [held]
            have = base + len(held)
            while have < end:
                parts.append(self.block(number))
                have, number = have + len(parts[-1]), number + 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            ids, held, base = held[start - base : end - base], held[end - base :], end
            yield None if self.null[i] else int(self.doc_ids[i]), start, ids


# ---- Spark ----------------------------------------------------------------------------------


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, planes: int = BYTE_PLANES, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``path``; returns the written manifest.

    Files follow the order of (doc_id, text), nulls first; a null or empty text is the end id alone.
    Repeated rows are repeated in the file. An empty table writes no file. ``path`` must be shared
    by all executors. Other columns are not read. ``tokenizer`` is a file that executors can open.
    """
    ship(docs.sparkSession)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, (store, folder) = encoder(tokenizer), open_store(path)
        writer, rows = None, []

        def close() -> None:
            count, ids = writer.close()
            rows.append({"file": name, "first": first, "number": len(rows), "docs": count, "ids": ids})

        for batch in all_slices(batches, "text"):
            texts = ["" if t is None else t for t in batch["text"].to_pylist()]
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encode(texts), strict=True):
                if writer is None or writer.ids >= FILE_IDS or len(writer.ends) >= FILE_DOCS:
                    if writer is not None:
                        close()
                    name, first = f"{uuid.uuid4().hex}.bpl", doc_id
                    store.create_dir(folder, recursive=True)
                    writer = FileWriter(store.open_output_stream(f"{folder}/{name}"), planes, block_ids)
                writer.add(doc_id, ids + end)
        if writer is not None:
            close()
        numbers = [(n, pa.int64()) for n in ("first", "number", "docs", "ids")]
        kind = pa.schema([("file", pa.string()), *numbers])
        yield pa.RecordBatch.from_pylist(rows, schema=kind)

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    return spill(ordered.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files themselves.

    ``start`` counts the ids of all documents before. Each file is a task's work, its length bounded
    by the writer. The order of files is a window over the manifest: one row per file.
    """
    ship(manifest.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(path)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{folder}/{row['file']}") as source:
                    found = [
                        (d, row["base"] + start, len(ids), zlib.crc32(ids.tobytes()))
                        for d, start, ids in FileReader(source).documents()
                    ]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    order = Window.orderBy(F.asc_nulls_first("first"), "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    based = spill(based.select("file", "base"), "bases")
    spread = based.repartition(max(1, based.count()), "file")
    return spread.mapInArrow(read, ", ".join(f"{n} long" for n in names))


def tokenise(
    spark: SparkSession, docs: DataFrame, tokenizer: str, planes: int = BYTE_PLANES
) -> DataFrame:
    """Write token files to the shared scratch folder and describe each document from them."""
    path = f"{scratch_dir(spark, 'tokens')}/files"
    return read_token_files(write_token_files(docs, path, tokenizer, planes), path)
