"""Byte-level BPE encoding and decoding.

Text is cut into pre-tokens by a pattern. Two tiers give the ids of a pre-token: a minimal perfect
hash over the vocabulary finds those that are one token; the others are merged, lowest rank first,
with a heap over a linked list of bytes.

Null text counts as empty and gives no ids. Texts of any length are encoded whole; rows are
independent, so copies, ties and rows with null ids are encoded like any other. Bytes that are
not UTF-8 are read as U+FFFD. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import extended

_LOW = (1 << 32) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class PerfectHash:
    """A minimal perfect hash: n keys to the slots 0..n-1, each slot holding its key and its value.

    Keys are dealt to buckets; each bucket, largest first, gets a shift that puts all its keys on
    free slots. A bucket of one key can be shifted to any slot, so the last slots fill as well.
    """

    def __init__(self, table: dict[bytes, int], per_bucket: int = 3):
        keys = list(table)
        self.n = n = max(len(keys), 1)
        self.m = m = n // per_bucket + 1
        hashes = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
        low, high = (hashes & np.uint64(_LOW)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.int64)
        start, step, bucket = low % n, high % n, (low ^ high) % m
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(m + 1))
        sizes = np.diff(cuts)
        free = np.ones(n, dtype=bool)
        self.shift: list[int] = [0] * m
        slot = np.zeros(len(keys), dtype=np.int64)
        left, since = np.arange(n), 0
        for b in np.argsort(-sizes, kind="stable"):
            if not sizes[b]:
                break
            own = order[cuts[b] : cuts[b + 1]]
            if since <= 0:
                left = np.flatnonzero(free)
                since = max(64, len(left) // 8)
            turn = 0
            while True:
                base = (start[own] + turn * step[own]) % n
                if len(set(base.tolist())) == len(own):
                    targets = left[free[left]]
                    if len(own) > 1 and len(targets) > 2048:
                        at = (int(b) * 7919 + turn * 104729) % (len(targets) - 2048)
                        targets = targets[at : at + 2048]
                    shifts = (targets - base[0]) % n
                    fits = free[(base[:, None] + shifts[None, :]) % n].all(axis=0)
                    if fits.any():
                        shift = int(shifts[int(np.argmax(fits))])
                        break
                turn += 1
                if turn > 100_000:
                    raise ValueError("two keys have one hash")
            places = (base + shift) % n
            free[places] = False
            slot[own] = places
            self.shift[b] = turn * n + shift
            since -= len(own)
        self.keys: list[bytes | None] = [None] * n
        self.values: list[int] = [0] * n
        for k, s in zip(keys, slot.tolist(), strict=True):
            self.keys[s], self.values[s] = k, table[k]

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh64_intdigest(key)
        low, high = h & _LOW, h >> 32
        turn, shift = divmod(self.shift[(low ^ high) % self.m], self.n)
        at = (low + turn * high + shift) % self.n
        return self.values[at] if self.keys[at] == key else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: neighbours of the lowest rank are joined, the leftmost first, to the end.

    Parts are a doubly linked list over the bytes. The heap holds a number for each pair: its rank, then
    the place of its left part. An entry whose rank is no longer its pair's is passed over.
    """
    n = len(piece)
    rank_of, far = ranks.get, n << 40
    pair = [rank_of(piece[i : i + 2], far) for i in range(n - 1)]  # of the part that starts here and the next
    pair.append(far)
    after, before = list(range(1, n + 1)), list(range(-1, n))
    heap = [r << 32 | i for i, r in enumerate(pair) if r != far]
    heapify(heap)
    while heap:
        entry = heappop(heap)
        i = entry & _LOW
        if pair[i] != entry >> 32:
            continue
        j = after[i]
        stop = after[j]
        after[i], before[stop] = stop, i
        pair[j] = far
        if stop < n:
            rank = pair[i] = rank_of(piece[i : after[stop]], far)
            if rank != far:
                heappush(heap, rank << 32 | i)
        else:
            pair[i] = far
        if i:
            h = before[i]
            rank = pair[h] = rank_of(piece[h:stop], far)
            if rank != far:
                heappush(heap, rank << 32 | h)
    out, i = [], 0
    while i < n:
        stop = after[i]
        out.append(ranks[piece[i:stop]])
        i = stop
    return out


class Tokens(dict):
    """Ids by pre-token, found on first sight, as the bytes of 32-bit numbers: these are joined fast and
    are nothing to the garbage collector. At ``most`` entries it starts afresh, so memory is bounded."""

    def __init__(self, whole: PerfectHash, ranks: dict[bytes, int], most: int = 400_000):
        super().__init__()
        self.whole, self.ranks, self.most = whole, ranks, most

    def __missing__(self, token: str) -> bytes:
        piece = token.encode()
        one = self.whole.get(piece)
        ids = array("i", merge(piece, self.ranks) if one is None else (one,)).tobytes()
        if len(self) >= self.most:
            self.clear()
        if len(piece) <= 256:
            self[token] = ids
        return ids


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all but the text if not given) and ``ids``, an array of the text's token ids.

    ``ranks_path`` is read on the driver; the vocabulary, whose size does not depend on the data,
    goes to the tasks with the function. No row is moved between tasks.
    """
    ranks = read_ranks(ranks_path)
    whole = PerfectHash(ranks)
    keep = [c for c in docs.columns if c not in (text, "ids")] if keep is None else keep
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("binary").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, tokens = regex.compile(pattern).findall, Tokens(whole, ranks)
        for batch in batches:
            # A few documents at a time: the ids of a batch can be large.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ends, flat = [0], []
                for raw in part.column(len(keep)).to_pylist():
                    pieces = find((raw or b"").decode("utf-8", "replace"))
                    flat.append(b"".join([tokens[piece] for piece in pieces]))
                    ends.append(ends[-1] + len(flat[-1]) // 4)
                values = pa.array(np.frombuffer(b"".join(flat), np.int32))
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*keep, "ids"])

    schema = extended(rows.drop("_text").schema, "ids array<int>")
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """All columns but ``decoded`` and, as ``decoded``, the bytes that the ids stand for (binary).

    Null ids give empty bytes; an id that is not in the vocabulary is an error.
    """
    ranks = read_ranks(ranks_path)
    pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    keep = [c for c in rows.columns if c != "decoded"]
    at = keep.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(pieces, pa.binary())
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = pc.fill_null(part.column(at), pa.scalar([], part.column(at).type))
                found = table.take(lists.flatten())
                if found.null_count:
                    raise ValueError("an id that is not in the vocabulary")
                ends = np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)]
                texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), found), b"")
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*keep, "decoded"])

    picked = rows.select(*[F.col(f"`{c}`") for c in keep])
    return picked.mapInArrow(run, extended(picked.schema, "decoded binary"))


def ids_digest(ids: Column) -> Column:
    """SHA-256 in hex of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
