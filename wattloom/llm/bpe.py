"""Byte-level BPE: encoding by a segment tree over adjacent pairs, and decoding.

A text is cut at the tokenizer's added tokens, then by its pattern into pieces, and each piece is
encoded alone. A piece starts as its bytes. The leaves of a segment tree hold the rank of each
adjacent pair, with its position below it, and an inner node the least of its two children; the root
is the leftmost pair of lowest rank. That pair becomes one symbol, at most three leaves change, and
each change walks up the tree, until the root holds no pair that merges. A piece of n bytes takes
n log n steps, so a text without a space is no special case.

Equal pieces have equal ids, so a worker keeps those of a bounded number of pieces. Short pieces that
it does not know yet are merged together, a tree in each row of a matrix.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KNOWN_PIECES = 300_000
#: Pieces up to so many bytes are merged in matrices of this and of smaller widths, and kept.
WIDTHS = (8, 16, 32)
#: Rows of such a matrix, and rows of documents encoded before their ids are handed on.
ROWS = 4_096
SLICE = 512

# The classes of the byte-level pattern within Latin-1.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\\t-\\r \\x85\\xa0"
PIECE = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)


def byte_characters() -> list[str]:
    """The character by which a byte-level vocabulary writes each byte: visible ones of Latin-1 stand
    for themselves, the others for the characters from U+0100 on, in order."""
    written, next_free = [], 256
    for byte in range(256):
        visible = 33 <= byte <= 126 or (byte >= 161 and byte != 173)
        written.append(chr(byte if visible else next_free))
        next_free += not visible
    return written


class PairTree:
    """The least of ``n`` keys under point updates; ``none`` stands for no key."""

    def __init__(self, keys: list[int], none: int):
        self.leaves = 1 << max(0, len(keys) - 1).bit_length()
        self.least = [none] * self.leaves + keys + [none] * (self.leaves - len(keys))
        for node in range(self.leaves - 1, 0, -1):
            self.least[node] = min(self.least[2 * node], self.least[2 * node + 1])

    def root(self) -> int:
        return self.least[1]

    def set(self, at: int, key: int) -> None:
        least, node = self.least, at + self.leaves
        least[node] = key
        while node > 1:
            node >>= 1
            left, right = least[2 * node], least[2 * node + 1]
            low = left if left < right else right
            if least[node] == low:
                return  # nothing changes above
            least[node] = low


class ByteBpe:
    """Encoder and decoder of a byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        refuse_others(spec)
        vocabulary = spec["model"]["vocab"]
        self.byte_ids = [vocabulary[c] for c in byte_characters()]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merged: list[int] = []
        self.ranks: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] << 32 | vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        pairs = np.array(sorted(self.ranks), dtype=np.int64)
        self.pairs, self.pair_ranks = pairs, np.array([self.ranks[p] for p in pairs.tolist()], np.int64)
        self.merged_ids = np.array(self.merged, dtype=np.int64)
        self.byte_table = np.array(self.byte_ids, dtype=np.int64)
        bytes_2d = self.byte_table[:, None] << 32 | self.byte_table
        self.byte_pair_ranks = self.rank_of(bytes_2d.ravel()).reshape(256, 256)
        byte_of = {c: byte for byte, c in enumerate(byte_characters())}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocabulary.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        self.pieces: dict[str, bytes] = {}
        self.splitter = None

    def merge(self, data: bytes) -> list[int]:
        """The ids of one piece."""
        n = len(data)
        symbols = [self.byte_ids[b] for b in data]
        if n < 2:
            return symbols
        ranks, merged = self.ranks, self.merged
        bits = n.bit_length()
        here = (1 << bits) - 1
        none = len(merged) << bits

        def key(left: int, right: int) -> int:
            rank = ranks.get(symbols[left] << 32 | symbols[right])
            return none if rank is None else rank << bits | left

        tree = PairTree([key(i, i + 1) for i in range(n - 1)], none)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree.root()) != none:
            left = least & here
            gone = after[left]
            right = after[left] = after[gone]
            symbols[left] = merged[least >> bits]
            if gone < n - 1:
                tree.set(gone, none)
            if right < n:
                before[right] = left
                tree.set(left, key(left, right))
            else:
                tree.set(left, none)
            if before[left] >= 0:
                tree.set(before[left], key(before[left], left))
        ids, at = [], 0
        while at < n:
            ids.append(symbols[at])
            at = after[at]
        return ids

    def rank_of(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair; the number of merges stands for none."""
        at = np.minimum(self.pairs.searchsorted(pairs), len(self.pairs) - 1)
        return np.where(self.pairs.take(at) == pairs, self.pair_ranks.take(at), len(self.merged))

    def merge_rows(self, data: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per row, for rows of n bytes, zeros after: ``merge`` for all at once.

        ``data`` has a power of two of columns. Cells are addressed by their place in the flat arrays.
        """
        width = data.shape[1]
        high = len(self.merged) * width  # the key of no pair
        rows = np.arange(len(data), dtype=np.int32)
        symbols = self.byte_table.take(data)
        alive = np.arange(width) < n[:, None]
        trees = np.full((len(data), 2 * width), high, dtype=np.int32)
        leaves = self.byte_pair_ranks[data[:, :-1], data[:, 1:]] * width + np.arange(width - 1)
        trees[:, width:-1] = np.where(alive[:, 1:], np.minimum(leaves, high), high)
        level = width
        while level > 1:
            below = trees[:, level : 2 * level]
            level //= 2
            trees[:, level : 2 * level] = np.minimum(below[:, ::2], below[:, 1::2])
        cells = np.arange(data.size, dtype=np.int32)
        after, before = cells + 1, cells - 1
        ends = (rows * width + n).astype(np.int32)
        tree, symbol, flat_alive = trees.ravel(), symbols.ravel(), alive.ravel()

        def set_keys(cell: np.ndarray, key: np.ndarray) -> None:
            start = cell // width * (2 * width)
            node = cell % width + width
            tree[start + node] = key
            for _ in range(width.bit_length() - 1):
                node >>= 1
                children = start + 2 * node
                tree[start + node] = np.minimum(tree.take(children), tree.take(children + 1))

        def keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            rank = self.rank_of(symbol.take(left) << 32 | symbol.take(right))
            return np.minimum(rank * width + left % width, high)

        while True:
            least = tree.take(rows * (2 * width) + 1)
            open_rows = least != high
            rows, least = rows[open_rows], least[open_rows]
            if not rows.size:
                break
            left = rows * width + least % width
            symbol[left] = self.merged_ids.take(least // width)
            gone = after.take(left)
            right = after.take(gone)
            after[left] = right
            flat_alive[gone] = False
            more = right < ends.take(rows)
            before[right[more]] = left[more]
            key = np.full(len(left), high, dtype=np.int64)
            key[more] = keys(left[more], right[more])
            back = before.take(left)
            some = back >= rows * width
            none = np.full(len(gone), high, dtype=np.int64)
            set_keys(
                np.concatenate([gone, left, back[some]]),
                np.concatenate([none, key, keys(back[some], left[some])]),
            )
        return symbols[alive].astype("<u4"), alive.sum(1)

    def merge_all(self, pieces: list[str]) -> dict[str, bytes]:
        """The serialized ids of different pieces."""
        found: dict[str, bytes] = {}
        data = [piece.encode() for piece in pieces]
        n = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
        least = 0
        for width in WIDTHS:
            own = np.flatnonzero((n > least) & (n <= width))
            least = width
            for at in range(0, len(own), ROWS):
                part = own[at : at + ROWS]
                padded = np.zeros((len(part), width), dtype=np.uint8)
                text = b"".join([data[i] for i in part.tolist()])
                padded[np.arange(width) < n[part][:, None]] = np.frombuffer(text, np.uint8)
                ids, counts = self.merge_rows(padded, n[part])
                packed, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
                start = 0
                for i, end in zip(part.tolist(), ends, strict=True):
                    found[pieces[i]] = packed[start:end]
                    start = end
        for i in np.flatnonzero(n > least).tolist():
            found[pieces[i]] = np.array(self.merge(data[i]), dtype="<u4").tobytes()
        return found

    def pieces_of(self, text: str) -> list[str]:
        """The library's own cut where a text has characters beyond Latin-1."""
        if is_latin(text):
            return PIECE.findall(text)
        if self.splitter is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self.splitter = ByteLevel(add_prefix_space=False)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of texts without added tokens."""
        cut = [self.pieces_of(part) for part in parts]
        known = self.pieces
        new = set().union(*cut).difference(known)
        if len(known) + len(new) > KNOWN_PIECES:
            known.clear()
            new = set().union(*cut)
        own = self.merge_all(list(new))
        known.update(own)
        ids = [b"".join(map(known.__getitem__, found)) for found in cut]
        if len(known) > KNOWN_PIECES:
            known.clear()
        for piece in new:
            if len(piece) > WIDTHS[-1]:
                known.pop(piece, None)
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        cut = [
            self.cut.split(text) if any(s in text for s in self.special) else [text] for text in texts
        ]
        ids = iter(self.encode_parts([p for parts in cut for p in parts if p not in self.special]))
        return [
            b"".join(
                np.array([self.special[p]], dtype="<u4").tobytes() if p in self.special else next(ids)
                for p in parts
            )
            for parts in cut
        ]

    def decode(self, ids: bytes) -> str:
        """Bytes that are no UTF-8 become U+FFFD; an unknown id stands for nothing."""
        parts = map(self.bytes_of.get, np.frombuffer(ids, dtype="<u4").tolist())
        try:
            return b"".join(parts).decode("utf-8", "replace")
        except TypeError:
            known = (self.bytes_of.get(i, b"") for i in np.frombuffer(ids, dtype="<u4").tolist())
            return b"".join(known).decode("utf-8", "replace")


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def refuse_others(spec: dict) -> None:
    """Raise ValueError for a tokenizer that does more than byte-level BPE."""
    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    plain = (
        model.get("type") == "BPE"
        and not any(
            model.get(k)
            for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                      "byte_fallback", "ignore_merges")
        )
        and len(set(merges)) == len(merges)
        and spec.get("normalizer") is None
        and spec.get("post_processor") is None
        and cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space")
        and (spec.get("decoder") or {}).get("type") == "ByteLevel"
        and not any(t[k] for t in spec["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
    )
    if not plain:
        raise ValueError("the file is not one of byte-level BPE alone")


@lru_cache(maxsize=2)
def loaded(path: str) -> ByteBpe:
    """One per worker process, kept between tasks."""
    return ByteBpe(path)


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ids): the ids of each whole text as little-endian 32-bit numbers.

    NULL and empty texts have no ids. Every row has its own, repeated rows and NULL ids included; the
    id may be of any type. An empty table gives an empty result. Only the two named columns are read,
    next to where they lie: nothing is shuffled.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                ids = own.encode([t or "" for t in part.column(1).to_pylist()])
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                columns = [part.column(0), counts, pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids"])

    kind = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(encode, f"id {kind}, n_tokens long, ids binary")
    return made.withColumnRenamed("id", id)


def decoded(tokens: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``tokens`` with a column ``text`` more (or in place of one of that name): the text of the ids.

    NULL ids have a NULL text.
    """
    schema = tokens.drop(text).schema.add(text, "string")
    names = [c for c in tokens.columns if c != text]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                found = [None if i is None else own.decode(i) for i in part.column(ids).to_pylist()]
                columns = [part.column(c) for c in names] + [pa.array(found, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, text])

    return tokens.mapInArrow(decode, schema)
