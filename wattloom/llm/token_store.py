"""Token ids in binary files: one zstandard dictionary for all, one frame per document.

The ids of a document are written as little-endian 16-bit numbers (32-bit for vocabularies above
65,536) and compressed alone, so a short document can be read without its neighbours. Alone it is
too short to compress well; therefore a dictionary is trained on the serialized ids of a bounded
sample of documents and shared by all files. A file holds

    magic 8 bytes | id width, 1 byte | SHA-256 of the dictionary, 32 bytes
    one frame per document
    index: (has_id, doc_id, offset, length, n_tokens) per document, 33 bytes each
    offset of the index, number of documents, CRC-32 of the index | magic

and the dictionary lies beside the files under its hash. A reader checks the hash before it
decompresses. Documents are in ascending id order over all files; a manifest lists the files.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import file_system, fresh_folder, saved, write_once

MAGIC = b"TOKSTOR1"
HEADER = struct.Struct("<8sB32s")
TRAILER = struct.Struct("<QQI8s")
INDEX = np.dtype(
    [("has_id", "u1"), ("doc_id", "<i8"), ("offset", "<u8"), ("length", "<u8"), ("n_tokens", "<u8")]
)
#: The dictionary: its size, and the documents it may be trained on (whole ones up to a length).
DICTIONARY_BYTES = 64 * 1024
SAMPLE_DOCUMENTS = 512
SAMPLE_CHARS = 16_384
LEVEL = 3
KNOWN_PIECES = 250_000
#: Rows that are encoded before their frames are handed on.
SLICE = 512
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Encoder:
    """Ids of whole texts, as serialized bytes.

    A tokenizer that cuts a lower-cased text into pieces by a pattern and then encodes each piece
    alone gives a piece the same ids everywhere, so ids are kept per piece (a bounded number). What
    that shortcut is not known to hold for goes through the whole tokenizer: other kinds of
    tokenizers, special tokens in a text, and words with characters beyond Latin-1.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.special = [token["content"] for token in spec.get("added_tokens") or []]
        self.pattern = piece_pattern(spec)
        self.pieces: dict[str, bytes] = {}
        self.byte_chars = byte_characters()

    def packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=f"<u{self.width}").tobytes()

    def by_library(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def by_pieces(self, text: str) -> bytes:
        found = self.pattern.findall(text.lower())
        known = self.pieces
        new = [piece for piece in set(found) if piece not in known]
        if new:
            if len(known) + len(new) > KNOWN_PIECES:
                known.clear()
                new = list(set(found))
            tokenize, chars, packed = self.tokenizer.model.tokenize, self.byte_chars, self.packed
            for piece in new:
                symbols = piece.encode().decode("latin-1").translate(chars)
                known[piece] = packed([token.id for token in tokenize(symbols)])
        return b"".join(map(known.__getitem__, found))

    def encode(self, text: str) -> bytes:
        plain = self.pattern is not None and not any(s in text for s in self.special)
        if not plain or any(s in text for s in SEPARATORS):
            return self.by_library(text)
        if is_latin(text):
            return self.by_pieces(text)
        # ASCII white space ends every piece, so words can go different ways.
        return b"".join(
            self.by_pieces(word) if is_latin(word) else self.by_library(word)
            for word in map(bytes.decode, text.encode().split())
        )


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


# What the classes of a pattern hold within Latin-1, for use inside brackets.
LATIN_CLASSES = {
    r"\p{L}": "A-Za-zªµºÀ-ÖØ-öø-ÿ",
    r"\p{N}": "0-9²³¹¼-¾",
    r"\s": "\t-\r \x85\xa0",
}


def piece_pattern(spec: dict):
    """The pattern that cuts a text of Latin-1 into pieces, if the tokenizer does just that."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    steps = cut.get("pretokenizers") or []
    changes = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers") or []]
    simple = (
        model.get("type") == "BPE"
        and not model.get("dropout")
        and changes == ["NFC", "Replace", "Lowercase"]
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
        and spec.get("post_processor") is None
    )
    if not simple:
        return None
    pattern = steps[0]["pattern"]["Regex"]
    for name, members in LATIN_CLASSES.items():
        pattern = pattern.replace(name, members)
    return re.compile(pattern)


def byte_characters() -> dict[int, str]:
    """The character by which a byte-level tokenizer writes each byte: printable ones of Latin-1
    stand for themselves, the others for characters from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    other = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    return Encoder(path)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary from serialized ids; too few samples to train on are used as they are."""
    import zstandard

    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def sample_ids(docs: DataFrame, id: str, text: str, path: str, end_id: int) -> list[bytes]:
    """Serialized ids of the documents with the smallest hashes, at most SAMPLE_DOCUMENTS."""
    short = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(id).alias("id"))
    short = short.where(F.length("text") <= SAMPLE_CHARS)
    texts = short.orderBy(F.xxhash64("id", "text"), "id").limit(SAMPLE_DOCUMENTS).select("text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        end = own.packed([end_id])
        for batch in batches:
            rows = [own.encode(t) + end for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["ids"])

    return [bytes(row.ids) for row in texts.mapInArrow(encode, "ids binary").collect()]


class Store(NamedTuple):
    """A folder of token files and its manifest: (part, file, n_docs, n_tokens, start)."""

    folder: str
    manifest: DataFrame


def frames(
    docs: DataFrame, id: str, text: str, path: str, end_id: int, dictionary: bytes
) -> DataFrame:
    """Rows (doc_id, n_tokens, frame): the compressed ids of each document and the end id."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        own = encoder(path)
        end = own.packed([end_id])
        known = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts, packed = [], []
                for value in part.column(1):
                    ids = own.encode(value.as_py() or "") + end
                    counts.append(len(ids) // own.width)
                    packed.append(packer.compress(ids))
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "frame"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, frame binary")


def file_chunks(batches: Iterator[pa.RecordBatch], width: int, digest: bytes, totals: list[int]):
    """The bytes of one file, frame by frame; ``totals`` gets documents and tokens."""
    index = []
    offset = HEADER.size
    yield HEADER.pack(MAGIC, width, digest)
    for batch in batches:
        for doc_id, n_tokens, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            index.append((doc_id is not None, doc_id or 0, offset, len(frame), n_tokens))
            offset += len(frame)
            yield frame
    table = np.array(index, dtype=INDEX)
    packed = table.tobytes()
    totals[:] = [len(index), int(table["n_tokens"].sum())]
    yield packed
    yield TRAILER.pack(offset, len(index), zlib.crc32(packed), MAGIC)


def write_store(
    docs: DataFrame, tokenizer: str, end_id: int, id: str = "doc_id", text: str = "text",
    folder: str | None = None,
) -> Store:
    """Encode all documents and write them in ascending id order, NULL ids first.

    Texts are encoded next to where they are read; what is shuffled into id order is compressed.
    NULL texts are empty and have the end id only. Rows of equal id follow each other in no fixed
    order. An empty table gives no file. Only the two named columns are read.
    """
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "token-store")
    dictionary = train_dictionary(sample_ids(docs, id, text, tokenizer, end_id))
    digest = hashlib.sha256(dictionary).digest()
    files, place = file_system(folder)
    files.create_dir(place, recursive=True)
    with files.open_output_stream(f"{place}/{digest.hex()}.dictionary") as out:
        out.write(dictionary)
    packed = saved(frames(docs, id, text, tokenizer, end_id, dictionary), "token-frames")
    width = encoder(tokenizer).width

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder.cache_clear()  # a worker that has encoded before needs it no more
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        totals: list[int] = []

        def all_batches():
            yield first
            yield from batches

        name = write_once(folder, ".tokens", file_chunks(all_batches(), width, digest, totals))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {"part": [part], "file": [name], "n_docs": totals[:1], "n_tokens": totals[1:]}
        )

    ordered = packed.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    written = ordered.mapInArrow(write, "part long, file string, n_docs long, n_tokens long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: a running sum over files, not over documents.
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start")
    manifest = saved(written, "token-files").select("*", start)
    return Store(folder, saved(manifest, "token-manifest"))


class TokenFile:
    """Random access to one file: ``len``, ``doc_id(i)`` and ``ids(i)``."""

    def __init__(self, folder: str, name: str):
        import zstandard

        files, place = file_system(folder)
        self.source = files.open_input_file(f"{place}/{name}")
        size = self.source.size()
        magic, self.width, digest = HEADER.unpack(self.source.read_at(HEADER.size, 0))
        at, n_docs, checksum, end = TRAILER.unpack(
            self.source.read_at(TRAILER.size, size - TRAILER.size)
        )
        packed = self.source.read_at(size - TRAILER.size - at, at)
        if magic != MAGIC or end != MAGIC or zlib.crc32(packed) != checksum:
            raise ValueError(f"{name} is not a whole token file")
        with files.open_input_stream(f"{place}/{digest.hex()}.dictionary") as stream:
            dictionary = stream.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{name} was written with another dictionary")
        self.index = np.frombuffer(packed, dtype=INDEX, count=n_docs)
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.unpacker = zstandard.ZstdDecompressor(dict_data=known)

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, i: int) -> int | None:
        row = self.index[i]
        return int(row["doc_id"]) if row["has_id"] else None

    def ids(self, i: int) -> np.ndarray:
        row = self.index[i]
        frame = self.source.read_at(int(row["length"]), int(row["offset"]))
        ids = np.frombuffer(self.unpacker.decompress(frame), dtype=f"<u{self.width}")
        if len(ids) != row["n_tokens"]:
            raise ValueError("the index disagrees with a frame")
        return ids


def read_store(store: Store) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, file, position) read back from the files."""
    folder = store.folder
    found = "doc_id long, start long, n_tokens long, ids_crc32 long, file string, position long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()
        for batch in batches:
            for row in batch.to_pylist():
                tokens = TokenFile(folder, row["file"])
                at, rows = row["start"], []
                for i in range(len(tokens)):
                    ids = tokens.ids(i).astype("<u4")
                    rows.append((tokens.doc_id(i), at, len(ids), zlib.crc32(ids.tobytes()), row["file"], i))
                    at += len(ids)
                names = [f.split()[0] for f in found.split(", ")]
                columns = [list(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    dict(zip(names, columns, strict=True)),
                    schema=pa.schema(
                        [(n, pa.string() if n == "file" else pa.int64()) for n in names]
                    ),
                )

    manifest = store.manifest.select("file", "start")
    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, found)
