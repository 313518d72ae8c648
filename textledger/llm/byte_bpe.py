"""Byte-level BPE: whole pre-tokens through a minimal perfect hash, misses through a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .common import each_text, id_and_text, whole_text

_MASK = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15
#: Pre-tokens kept with their ids in each task, in a young and an old half of this size: a full young half becomes the old one.
MEMO = 1 << 18
MEMO_CHARS = 48
#: Texts longer than this are cut into pre-tokens and hashed piece by piece.
LONG_TEXT = 1 << 20
_PIECES = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary of a rank file (lines of base64 token and rank). Read on the driver: its size is the vocabulary's."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _slot(h, d):
    x = (h ^ (d * _ODD & _MASK)) * 0xBF58476D1CE4E5B9 & _MASK
    return x ^ x >> 31


class PerfectHash:
    """Minimal perfect hash of byte strings: n keys in n slots, one displacement for each bucket of about four keys.

    Buckets are placed from the largest on; those of one key point straight at a free slot.
    A looked-up key is compared with the one in its slot, so strangers are told apart for certain.
    """

    def __init__(self, entries: dict[bytes, int]):
        keys = list(entries)
        n, buckets = len(keys), max(1, len(keys) // 4)
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        by_bucket: list[list[int]] = [[] for _ in range(buckets)]
        for i, b in enumerate((hashes % np.uint64(buckets)).tolist()):
            by_bucket[b].append(i)
        shift = [0] * buckets
        taken = np.zeros(n, bool)
        place = np.zeros(n, np.int64)
        for b in sorted(range(buckets), key=lambda b: -len(by_bucket[b])):
            members = by_bucket[b]
            if len(members) < 2:
                break
            tried, own = 1, hashes[members]
            while True:
                slots = (_slots(own, np.arange(tried, tried + 64, dtype=np.uint64)) % np.uint64(n)).astype(np.int64)
                fits = ~taken[slots].any(axis=1)
                fits[fits] = [len(set(row)) == len(row) for row in slots[fits].tolist()]
                if fits.any():
                    at = int(fits.argmax())
                    shift[b], taken[slots[at]], place[members] = tried + at, True, slots[at]
                    break
                tried += 64
        free = iter(np.flatnonzero(~taken).tolist())
        for b, members in enumerate(by_bucket):
            if len(members) == 1:
                place[members[0]] = slot = next(free)
                shift[b] = -slot - 1
        self.shift, self.size, self.buckets = shift, n, buckets
        self.keys: list[bytes] = [b""] * n
        self.values = [0] * n
        for i, slot in enumerate(place.tolist()):
            self.keys[slot], self.values[slot] = keys[i], entries[keys[i]]

    def parts(self) -> tuple:
        """Plain lists, to be sent to tasks."""
        return self.shift, self.keys, self.values

    @classmethod
    def of(cls, parts: tuple) -> PerfectHash:
        table = cls.__new__(cls)
        table.shift, table.keys, table.values = parts
        table.size, table.buckets = len(table.keys), len(table.shift)
        return table

    def get(self, key: bytes) -> int | None:
        if not self.size:
            return None
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -d - 1 if d < 0 else _slot(h, d) % self.size
        return self.values[slot] if self.keys[slot] == key else None


def _slots(hashes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (hashes[None, :] ^ (shifts[:, None] * np.uint64(_ODD))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(31)


class Codec:
    """Encodes and decodes with one vocabulary."""

    def __init__(self, table: PerfectHash, pattern: str):
        self.table, self.find = table, regex.compile(pattern)
        self.rank_of = dict(zip(table.keys, table.values, strict=True))
        self.bytes_of = {str(v): k for k, v in zip(table.keys, table.values, strict=True)}
        self.memo = _Memo(self)

    def merge(self, token: bytes) -> list[int]:
        """Ids of a byte string: the lowest-ranked pair of neighbours first, the leftmost of equals."""
        n, get = len(token), self.rank_of.get
        # Where the part that begins at a byte ends, -1 within a part; the last entry is no end of any part.
        after, before = [*range(1, n + 1), -2], list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := get(token[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, start, end = heappop(heap)
            middle = after[start]
            if after[middle] != end:
                continue  # one of its halves has gone into another merge
            after[start], after[middle] = end, -1
            if end < n:
                before[end] = start
                follower = after[end]
                if (rank := get(token[start:follower])) is not None:
                    heappush(heap, (rank, start, follower))
            if (left := before[start]) >= 0 and (rank := get(token[left:end])) is not None:
                heappush(heap, (rank, left, end))
        ids, at = [], 0
        while at < n:
            ids.append(get(token[at : after[at]]))
            at = after[at]
        return ids

    def ids_of(self, piece: str) -> str:
        token = piece.encode()
        whole = self.table.get(token)
        return str(whole) if whole is not None else ",".join(map(str, self.merge(token)))

    def pieces(self, text: str) -> Iterator[list[str]]:
        if len(text) <= LONG_TEXT:
            yield self.find.findall(text)
        else:
            found = (m.group() for m in self.find.finditer(text))
            while part := list(islice(found, _PIECES)):
                yield part

    def encode(self, text: str) -> Iterator[str]:
        """Decimal ids joined by commas, in one or more parts."""
        for part in self.pieces(text):
            if part:
                yield ",".join(map(self.memo.__getitem__, part))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split(","))) if ids else b""

    def round_trip(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids' text, SHA-256 of the decoded bytes."""
        ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
        for ids in self.encode(text):
            ids_hash.update(f",{ids}".encode() if n else ids.encode())
            text_hash.update(self.decode(ids))
            n += ids.count(",") + 1
        return n, ids_hash.hexdigest(), text_hash.hexdigest()


class _Memo(dict):
    """The young half is the dictionary itself. Frequent pre-tokens come back from the old half, so only rare ones are merged again."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.old = codec, {}

    def __missing__(self, piece: str) -> str:
        ids = self.old.get(piece) or self.codec.ids_of(piece)
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def _over_batches(docs: DataFrame, ranks: dict[bytes, int], pattern: str, one, fields: str) -> DataFrame:
    """``one(codec, text)`` gives the fields of a row after doc_id."""
    table = docs.sparkSession.sparkContext.broadcast(PerfectHash(ranks).parts())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(PerfectHash.of(table.value), pattern)
        for batch in batches:
            rows = [one(codec, t) for t in each_text(batch)]
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", *names])

    names, types = zip(*(f.split() for f in fields.split(", ")), strict=True)
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[t] for t in types]
    return id_and_text(docs).select("doc_id", whole_text().alias("text")).mapInArrow(task, f"doc_id long, {fields}")


def encode_decode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row.

    Each match of ``pattern`` is encoded separately, without special tokens, then the ids are decoded. A null text
    counts as empty: no tokens, and the hash of nothing. Rows that repeat each get a row, no rows give no rows.
    ``ranks`` must hold all single bytes. The table that is broadcast has the size of the vocabulary.
    """
    return _over_batches(docs, ranks, pattern, Codec.round_trip, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(doc_id, ids) of every row: the token ids themselves; a null text has none."""

    def ids(codec: Codec, text: str) -> tuple[list[int]]:
        return ([int(i) for part in codec.encode(text) for i in part.split(",")],)

    return _over_batches(docs, ranks, pattern, ids, "ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """(doc_id, bytes) of rows with (doc_id, ids); null ids give empty bytes, an id outside the vocabulary is an error."""
    by_id = encoded.sparkSession.sparkContext.broadcast({v: k for k, v in ranks.items()})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b"".join(map(by_id.value.__getitem__, ids or ())) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id long, bytes binary")
