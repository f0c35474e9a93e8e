"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart have a value at most r/2 bits from either. So every distinct
fingerprint stands for all variants within half the radius, equal variants are brought together,
and what collides is verified. The shuffle goes by the high bits of a variant: fingerprints are sent
once for each variant of their high bits, and the variants of the low bits, with the flips that are
left, are made where they meet. That is the same set of variants, moved in fewer rows.

Null and empty texts have the fingerprint zero and are linked like any other. Texts of fewer words
than a shingle are one shingle. Copies share a fingerprint, which is linked once however many rows
have it. Rows with a null key take part; a component's name is null if it has null keys only. An
empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.llm.common import extended
from etalage.llm.graph import components
from etalage.session import write_through

BITS = 64
#: Fixed value: the seed of the shingle hash.
SEED = 42


def fingerprint(text: bytes, shingle: int) -> int:
    """The bits that are set in over half the hashes of the text's word shingles."""
    words = text.lower().split()  # of bytes: A-Z, and the white space of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    stops = ends[width - 1 :].tolist()
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: Column, text: str = "text", shingle: int = 4) -> DataFrame:
    """key and fingerprint (a signed long) of every row."""
    rows = docs.select(key.alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["key", "fingerprint"])

    return rows.mapInArrow(run, extended(rows.select("key").schema, "fingerprint long"))


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def flips(bits: int, most: int) -> list[tuple[int, int]]:
    """All masks of at most ``most`` of the lowest ``bits`` bits, each with its number of bits."""
    return [(sum(1 << b for b in c), n) for n in range(most + 1) for c in combinations(range(bits), n)]


def _n_flips(bits: int, most: int) -> int:
    return sum(math.comb(bits, n) for n in range(most + 1))


def meeting(nodes: DataFrame, key_bits: int, half: int) -> DataFrame:
    """place and node: each fingerprint at every variant of its high bits."""
    masks = F.array(*[F.lit(m).cast("long") for m, _ in flips(key_bits, half)])
    high = F.shiftrightunsigned("node", BITS - key_bits)
    return nodes.select("node", F.explode(masks).alias("mask")).select(high.bitwiseXOR(F.col("mask")).alias("place"), "node")


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64)).astype(np.int64)


def _roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of a small graph other than the smallest of their component, each with that one."""
    nodes, both = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = both[: len(u)], both[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, label[a], low)
        np.minimum.at(now, label[b], low)
        now = now[now]
        if (now == label).all():
            break
        label = now
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


#: Variants that are made at a time: 8 bytes each, and some four times that on the way.
AT_ONCE = 8_000_000


def collide(places: np.ndarray, nodes: np.ndarray, key_bits: int, radius: int, at_once: int = AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints that meet at these places (sorted): pairs that join up all that share a variant.

    Where their variants are too many, places are taken apart, and a single crowded place by further bits of the
    variant, one value of these after the other; so memory is bounded for any crowd.
    """
    half, low = (radius + 1) // 2, BITS - key_bits
    used = _ones((nodes >> np.uint64(low)) ^ places)
    size = sum(int((used == n).sum()) * _n_flips(low, half - n) for n in range(half + 1))
    if size > at_once and low and len(nodes) > 1:
        if places[0] != places[-1]:
            middle = places[len(places) // 2]
            cut = int(np.searchsorted(places, middle)) or int(np.searchsorted(places, middle, "right"))
            parts = [collide(places[x], nodes[x], key_bits, radius, at_once) for x in (slice(0, cut), slice(cut, None))]
        else:
            more, parts = min(4, low), []
            high = nodes >> np.uint64(low - more)
            for value in range(1 << more):
                place = (places[0] << np.uint64(more)) | np.uint64(value)
                own = nodes[_ones(high ^ place) <= half]
                if len(own) > 1:
                    parts.append(collide(np.full(len(own), place, np.uint64), own, key_bits + more, radius, at_once))
        u, v = (np.concatenate(x) if x else nodes[:0] for x in zip(*parts, strict=True)) if parts else (nodes[:0], nodes[:0])
        return _roots(u, v) if len(u) else (u, v)
    base = (places << np.uint64(low)) | (nodes & np.uint64((1 << low) - 1))
    variants, owners, spent = [], [], []
    for n in range(half + 1):
        own = np.flatnonzero(used == n)
        masks = flips(low, half - n)
        variants.append((base[own][:, None] ^ np.array([m for m, _ in masks], np.uint64)[None, :]).ravel())
        owners.append(np.repeat(own, len(masks)))
        if radius % 2:
            spent.append(np.tile(n + np.array([k for _, k in masks]), len(own)))
    value, owner = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(value)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return nodes[:0], nodes[:0]
    at = np.minimum(np.searchsorted(shared, value), len(shared) - 1)
    hit = np.flatnonzero(shared[at] == value)
    at, who = at[hit], nodes[owner[hit]]
    # The first of a run is linked with the rest. For an odd radius it must be within the smaller half.
    near = np.concatenate(spent)[hit] if radius % 2 else np.zeros(len(hit), np.int64)
    order = np.lexsort((who, near, at))
    at, who, near = at[order], who[order], near[order]
    begins = np.r_[True, at[1:] != at[:-1]]
    first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    a, b = who[first], who
    verified = (a != b) & (_ones(a ^ b) <= radius)
    return _roots(a[verified], b[verified])


def links(nodes: DataFrame, radius: int = 4, at_once: int = AT_ONCE) -> DataFrame:
    """u and v: links between distinct fingerprints (column node, no value twice) that join up all
    pairs at most ``radius`` bits apart. Within a crowd each is linked with one, not with all.

    The high bits are two less than the number of nodes has, which keeps places small; a crowd at one place is taken
    apart where it is met. The result does not depend on it.
    """
    half = (radius + 1) // 2
    key_bits = min(32, max(8, math.ceil(math.log2(max(nodes.count(), 2))) - 2))
    met = meeting(nodes, key_bits, half).repartition("place").sortWithinPartitions("place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(held: list[tuple[np.ndarray, np.ndarray]], last: bool):
            places, nodes = (np.concatenate(x) for x in zip(*held, strict=True))
            # The last place may go on in the next batch.
            stop = len(places) if last else int(np.searchsorted(places, places[-1]))
            u, v = collide(places[:stop].view(np.uint64), nodes[:stop].view(np.uint64), key_bits, radius, at_once)
            out = pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(u.view(np.int64))], names=["u", "v"])
            return out, [(places[stop:], nodes[stop:])]

        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= 150_000:
                out, held = cut(held, False)
                size = len(held[0][0])
                if out.num_rows:
                    yield out
        if size:
            out, _ = cut(held, True)
            if out.num_rows:
                yield out

    return met.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, key: Column, text: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """key, fingerprint (long) and component: the smallest key among all rows whose fingerprints can be
    reached from this one over steps of at most ``radius`` bits."""
    rows = write_through(fingerprints(docs, key, text, shingle), "fingerprints")
    nodes = write_through(rows.groupBy(F.col("fingerprint").alias("node")).agg(F.min("key").alias("least")), "nodes")
    roots = components(links(nodes.select("node"), radius))
    grouped = nodes.join(roots, "node")
    least = grouped.groupBy("root").agg(F.min("least").alias("component"))
    linked = grouped.select("node", "root").join(least, "root").select("node", "component")
    # Written, so that the last join reads two plain tables and a fingerprint with many rows can be split.
    named = write_through(
        nodes.join(linked, "node", "left").select(
            F.col("node").alias("fingerprint"), F.coalesce("component", "least").alias("component")
        ),
        "named",
    )
    return rows.join(named, "fingerprint").select("key", "fingerprint", "component")
