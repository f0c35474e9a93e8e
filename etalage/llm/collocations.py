"""Frequent phrases and how closely their words belong together, from Rabin-Karp fingerprints.

Texts are bytes in numpy arrays. A prefix polynomial over the bytes gives each word a hash, one over the word
hashes gives every run of up to ``longest`` words a fingerprint, whatever white space lies between. Each task
adds its fingerprints up and sends, packed, distinct fingerprints with their counts, a second hash and a pointer
to a document that has them. Where they meet the frequent ones are told. Only these are looked up: the documents
that the first and the last pointer name are read again and the words taken from them. Different second hashes
or different words under one fingerprint are a collision; then all is hashed anew with another seed.

Cases. A null text is empty, a null language is ``und``, and both may be in one group with rows that say so.
Texts of any length are read whole: words and words' hashes are taken in slabs. Bytes are compared, so only A-Z
are lower-cased. Repeated rows and ids count as often as they are there; ids are not read. Ties in the ranking
are broken by count, then by the phrase's bytes. An empty table, or one without a frequent phrase, gives no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.llm.common import in_files, located
from etalage.session import write_through

#: Bytes of text for each bucket of fingerprints, and words that a task adds up at a time.
BUCKET_BYTES, CHUNK_WORDS = 16 << 20, 2_000_000
#: Bytes and words that are hashed at a time, bytes that are looked up at a time, and rows that a packed pointer can tell apart.
SLAB, LOOK_BYTES, CHUNK_ROWS = 1 << 18, 1 << 20, 1 << 16
#: Bits of the second hash that are sent along; 16 at most.
CHECK_BITS = 16
#: The signs that end a piece; all other bytes but blank and tab are in words.
SEPARATORS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(SEPARATORS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``; one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Polynomial:
    """Prefix polynomials modulo 2**64 in an odd base."""

    def __init__(self, seed: int, most: int):
        draw = np.random.default_rng(seed)
        self.letters = draw.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(draw.integers(1 << 32, 1 << 62)) * 2 + 1
        self.powers = self._row(base, most)
        self.inverses = self._row(pow(base, -1, 1 << 64), most)

    @staticmethod
    def _row(base: int, most: int) -> np.ndarray:
        row = np.full(most, base, np.uint64)
        row[0] = 1
        return np.cumprod(row, dtype=np.uint64)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The hash of each ``values[start:end]``, which does not depend on where it stands."""
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * self.inverses[starts]

    def long_run(self, data: np.ndarray) -> np.uint64:
        """The same hash of bytes of any length, slab by slab."""
        total, shift = np.uint64(0), np.ones(1, np.uint64)
        for at in range(0, len(data), SLAB):
            part = data[at : at + SLAB]
            total = total + (self.letters[part] * self.powers[: len(part)]).sum(dtype=np.uint64) * shift[0]
            shift = shift * self.powers[1] * self.powers[SLAB - 1]
        return total


Hashes = tuple[Polynomial, Polynomial, Polynomial, Polynomial]


def hashes(seed: int) -> Hashes:
    """For bytes and for words: the fingerprint's and the second hash's."""
    at_bytes, at_words = 2 * SLAB + 2, SLAB + 64
    return tuple(Polynomial(seed * 4 + i, n) for i, n in enumerate((at_bytes, at_bytes, at_words, at_words)))


class Words:
    """The words of the texts of a batch: places, hashes, and whether a piece begins with them."""

    def __init__(self, texts: pa.Array, poly: Hashes):
        self.poly = poly
        offsets, data = _bytes(texts)
        self.data = data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        # A text's first byte begins a word though the text before it ended in one.
        at = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[at] = inside[at]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        stops[last] = inside[last]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        upto = np.searchsorted(self.starts, offsets)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(upto))
        self.fresh = np.zeros(len(self.starts) + 1, bool)
        self.fresh[np.searchsorted(self.starts, np.flatnonzero(kind == 2))] = True
        self.fresh[upto] = True

    def __len__(self) -> int:
        return len(self.starts)

    def word_hashes(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of the words a..b."""
        first, second = self.poly[:2]
        out = np.empty((2, b - a), np.uint64)
        at = a
        while at < b:
            begin = self.starts[at]
            stop = min(b, int(np.searchsorted(self.starts, begin + SLAB)))
            if self.ends[stop - 1] - begin > 2 * SLAB:  # only the last can be so long
                word = self.data[self.starts[stop - 1] : self.ends[stop - 1]]
                out[:, stop - 1 - a] = first.long_run(word), second.long_run(word)
                if stop - 1 == at:
                    at = stop
                    continue
                stop -= 1
                rest = stop + 1
            else:
                rest = stop
            starts, ends = self.starts[at:stop] - begin, self.ends[at:stop] - begin
            part = self.data[begin : begin + ends[-1]]
            out[0, at - a : stop - a] = first.runs(first.letters[part], starts, ends)
            out[1, at - a : stop - a] = second.runs(second.letters[part], starts, ends)
            at = rest
        return _mixed(out[0]), _mixed(out[1])

    def grams(self, longest: int, salts: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """For each slab and number of words: the first word's index, fingerprint and second hash of each run of words
        inside a piece. ``salts`` has a value for each text, so that languages keep apart."""
        n = len(self)
        for a in range(0, n, SLAB):
            b, over = min(n, a + SLAB), min(n, a + SLAB + longest - 1)
            one, two = self.word_hashes(a, over)
            whole = np.ones(b - a, bool)
            for k in range(1, longest + 1):
                if k > 1:
                    # The run's last word must be there and go on in the piece.
                    whole[max(0, n - a - k + 1) :] = False
                    whole &= ~self.fresh[np.minimum(np.arange(a, b) + k - 1, n)]
                at = np.flatnonzero(whole)
                mark = _mixed(self.poly[2].runs(one, at, at + k) + np.uint64(k) ^ salts[self.doc[a + at]])
                check = _mixed(self.poly[3].runs(two, at, at + k))
                yield k, a + at, mark >> np.uint64(64 - bits), check

    def identities(self) -> np.ndarray:
        """A number for each word; equal numbers mean equal bytes, which are compared."""
        marks = np.concatenate([self.word_hashes(a, min(len(self), a + SLAB))[0] for a in range(0, len(self), SLAB)] or [np.zeros(0, np.uint64)])
        _, first, ids = np.unique(marks, return_index=True, return_inverse=True)
        size = self.ends - self.starts
        same = (size == size[first[ids]]).all()
        for a in range(0, len(self), SLAB):
            if not same:
                break
            own, n = slice(a, a + SLAB), size[a : a + SLAB]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            here, there = (np.repeat(x, n) + step for x in (self.starts[own], self.starts[first[ids[own]]]))
            same = bool((self.data[here] == self.data[there]).all())
        if not same:
            known: dict[bytes, int] = {}
            ids = np.array([known.setdefault(self.text(i, 1), len(known)) for i in range(len(self))], np.int64)
        return ids

    def text(self, first: int, k: int) -> bytes:
        return b" ".join(self.data[self.starts[i] : self.ends[i]].tobytes() for i in range(first, first + k))


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a binary array without nulls."""
    width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(places, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], whole[offsets[0] : offsets[-1]]


def salts_of(langs: list[str]) -> np.ndarray:
    known = {x: xxhash.xxh64_intdigest(x) for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: bytes that hardly change lie together, for the shuffle's codec."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


PACK = "k int, bucket long, lang string, file string, base long, n long, marks binary, counts binary, checks binary, rows binary"
FOUND = "k int, mark long, f long, lang string, clash boolean, first_file string, first_row long, last_file string, last_row long"


def _packs(k: int, parts: list, shift: int) -> Iterator[dict]:
    """One chunk's fingerprints of ``k`` words, added up, a row for each bucket: differences of sorted fingerprints,
    counts, second hashes and rows."""
    marks, checks, rows = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(marks):
        return
    order = np.argsort(marks, kind="stable")
    marks, checks, rows = marks[order], checks[order], rows[order]
    # A second hash is part of the key here, so that a collision reaches the place where it is told.
    begins = np.flatnonzero(np.r_[True, (marks[1:] != marks[:-1]) | (checks[1:] != checks[:-1])])
    counts = np.diff(np.r_[begins, len(marks)]).astype(np.uint32)
    marks, checks, rows = marks[begins], checks[begins], np.minimum.reduceat(rows, begins)
    buckets = marks >> np.uint64(shift) if shift < 64 else np.zeros(len(marks), np.uint64)
    cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1], True])
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield {
            "k": k,
            "bucket": int(buckets[a]),
            "n": int(b - a),
            "marks": packed(np.diff(marks[a:b], prepend=np.uint64(0))),
            "counts": packed(counts[a:b]),
            "checks": packed(checks[a:b]),
            "rows": packed(rows[a:b]),
        }


def count_grams(docs: DataFrame, longest: int, least: int, seed: int, buckets_log: int, bits: int, chunk_words: int) -> DataFrame:
    """``FOUND`` rows: runs of words that are there ``least`` times or more; with k = 0 the words of each language."""
    shift = bits - buckets_log
    empty = {"lang": None, "file": None, "base": 0, "n": 0, "marks": b"", "counts": b"", "checks": b"", "rows": b""}
    fields = [f.split() for f in PACK.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[t]) for n, t in fields])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = hashes(seed)
        held: dict[int, list] = {k: [] for k in range(1, longest + 1)}
        state = {"file": None, "base": 0, "words": 0}
        totals: dict[str, int] = {}

        def chunk() -> Iterator[pa.RecordBatch]:
            for k, parts in held.items():
                if parts:
                    out = [empty | {"file": state["file"], "base": state["base"]} | p for p in _packs(k, parts, shift)]
                    parts.clear()
                    for at in range(0, len(out), 256):
                        yield pa.RecordBatch.from_pylist(out[at : at + 256], schema)
            state["words"] = 0

        for batch in batches:
            files, numbers = batch.column(2).to_pylist(), batch.column(3).to_numpy()
            cuts = [0]
            for i in range(1, len(files)):
                if files[i] != files[cuts[-1]] or not 0 <= numbers[i] - numbers[cuts[-1]] < CHUNK_ROWS:
                    cuts.append(i)
            for a, b in zip(cuts, [*cuts[1:], len(files)], strict=True):
                if a == b:
                    continue
                low, high = int(numbers[a:b].min()), int(numbers[a:b].max())
                if state["words"] and (files[a] != state["file"] or low < state["base"] or high - state["base"] >= CHUNK_ROWS):
                    yield from chunk()
                if not state["words"]:
                    state["file"], state["base"] = files[a], low
                langs = batch.column(1).slice(a, b - a).to_pylist()
                words = Words(batch.column(0).slice(a, b - a), poly)
                for x, n in zip(langs, np.bincount(words.doc, minlength=b - a).tolist(), strict=True):
                    totals[x] = totals.get(x, 0) + n
                for k, at, mark, check in words.grams(longest, salts_of(langs), bits):
                    row = (numbers[a:b] - state["base"]).astype(np.uint16)
                    held[k].append((mark, (check >> np.uint64(48) >> np.uint64(16 - CHECK_BITS)).astype(np.uint16), row[words.doc[at]]))
                    state["words"] += len(at) if k == 1 else 0
                    if k == longest and state["words"] >= chunk_words:
                        yield from chunk()
                        state["base"] = low
        yield from chunk()
        if totals:
            sums = [empty | {"k": 0, "bucket": xxhash.xxh32_intdigest(x), "lang": x, "n": n} for x, n in totals.items() if n]
            yield pa.RecordBatch.from_pylist(sums, schema)

    def tell(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        k = group.column("k")[0].as_py()
        out = {n: [] for n in ("k", "mark", "f", "lang", "clash", "first_file", "first_row", "last_file", "last_row")}
        if k == 0:
            sums: dict[str, int] = {}
            for x, n in zip(group.column("lang").to_pylist(), group.column("n").to_pylist(), strict=True):
                sums[x] = sums.get(x, 0) + n
            m = len(sums)
            columns = [[0] * m, [0] * m, list(sums.values()), list(sums), [False] * m, *[[None] * m] * 4]
        else:
            files, bases = group.column("file").to_pylist(), group.column("base").to_pylist()
            ranked = sorted(range(len(files)), key=lambda i: (files[i], bases[i]))
            sizes = group.column("n").to_numpy()[ranked]

            def whole(name: str, kind: type) -> np.ndarray:
                column = group.column(name)
                return np.concatenate([unpacked(column[i].as_buffer(), kind) for i in ranked])

            column = group.column("marks")
            marks = np.concatenate([np.cumsum(unpacked(column[i].as_buffer(), np.uint64), dtype=np.uint64) for i in ranked])
            order = np.argsort(marks, kind="stable")  # within a fingerprint, sources stay in their order
            marks = marks[order]
            begins = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]])
            counts = np.add.reduceat(whole("counts", np.uint32)[order].astype(np.int64), begins)
            kept = np.flatnonzero(counts >= least)
            checks = whole("checks", np.uint16)[order]
            clash = (np.minimum.reduceat(checks, begins) != np.maximum.reduceat(checks, begins))[kept]
            rows = whole("rows", np.uint16)
            source = np.repeat(np.arange(len(ranked)), sizes)
            ends = np.r_[begins[1:], len(marks)] - 1
            first, last = order[begins[kept]], order[ends[kept]]

            def place(entry: np.ndarray) -> tuple[list, np.ndarray]:
                of = [ranked[i] for i in source[entry]]
                base = np.array([bases[i] for i in of], np.int64)
                return [files[i] for i in of], base + rows[entry]

            m = len(kept)
            columns = [
                np.full(m, k, np.int32), marks[begins[kept]].view(np.int64), counts[kept], [None] * m, clash,
                *place(first), *place(last),
            ]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=list(out))

    return docs.mapInArrow(count, PACK).groupBy("k", "bucket").applyInArrow(tell, FOUND)


def materialised(docs: DataFrame, found: DataFrame, longest: int, seed: int, bits: int) -> DataFrame:
    """k, mark, lang, phrase and the fingerprints of its parts (by length, then place), for each of the documents that
    the pointers name."""
    pointers = F.array_distinct(
        F.array(
            F.struct(F.col("first_file").alias("file"), F.col("first_row").alias("row")),
            F.struct(F.col("last_file").alias("file"), F.col("last_row").alias("row")),
        )
    )
    asked = found.where("k > 0").select("mark", F.explode(pointers).alias("_loc"))
    lists = asked.groupBy("_loc").agg(F.collect_list("mark").alias("marks"))
    rows = docs.select("text", "lang", F.struct("file", "row").alias("_loc")).join(lists, "_loc").select("text", "lang", "marks")
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
    names = ["k", "mark", "lang", "phrase", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = hashes(seed)
        for batch in batches:
            # A few texts at a time.
            sizes = np.cumsum(pc.binary_length(batch.column(0)).to_numpy())
            cuts = [0, *(np.flatnonzero(np.diff(sizes // LOOK_BYTES)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    part = batch.slice(a, b - a)
                    yield from look(poly, part.column(0), part.column(1).to_pylist(), part.column(2))

    def look(poly: Hashes, texts: pa.Array, langs: list[str], marks: pa.Array) -> Iterator[pa.RecordBatch]:
        words = Words(texts, poly)
        wanted = np.asarray(marks.flatten()).view(np.uint64)
        owner = np.repeat(np.arange(len(langs)), np.asarray(marks.value_lengths()))
        known, which = np.unique(wanted, return_inverse=True)
        asked = np.unique(owner * len(known) + which)
        ids = words.identities()
        for k, at, mark, _ in words.grams(longest, salts_of(langs), bits):
            near = np.minimum(np.searchsorted(known, mark), len(known) - 1)
            hit = np.flatnonzero(known[near] == mark)
            codes = words.doc[at[hit]] * len(known) + near[hit]
            hit = hit[np.isin(codes, asked)]
            codes, first, which = np.unique(words.doc[at[hit]] * len(known) + near[hit], return_index=True, return_inverse=True)
            # All that has a fingerprint must have the words of the first that has it; what has not is told too.
            run, like = at[hit], at[hit[first]][which]
            other = np.logical_or.reduce([ids[run + j] != ids[like + j] for j in range(k)])
            one = hit[np.unique(np.r_[first, np.flatnonzero(other)[:1]])]
            for i in range(0, len(one), 10_000):
                chosen = one[i : i + 10_000]
                of = [langs[d] for d in words.doc[at[chosen]]]
                yield phrased(poly, k, mark[chosen], of, [words.text(int(x), k) for x in at[chosen]])

    def phrased(poly: Hashes, k: int, marks: np.ndarray, langs: list[str], phrases: list[bytes]) -> pa.RecordBatch:
        """The phrases with the fingerprints of their parts, from their own text."""
        words = Words(pa.array(phrases, pa.binary()), poly)
        parts = np.zeros((len(phrases), k * (k + 1) // 2 - 1), np.int64)
        for j, at, mark, _ in words.grams(k - 1, salts_of(langs), bits):
            parts[at // k, (j - 1) * (k + 1) - (j - 1) * j // 2 + at % k] = mark.view(np.int64)
        steps = np.arange(len(phrases) + 1) * parts.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(steps, pa.int32()), pa.array(parts.ravel(), pa.int64()))
        columns = [np.full(len(phrases), k, np.int32), marks.view(np.int64), langs, [p.decode("utf-8", "replace") for p in phrases]]
        return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, kinds, strict=False)], lists], names=names)

    return rows.mapInArrow(run, "k int, mark long, lang string, phrase string, parts array<long>")


def _part(length: Column, start: Column) -> Column:
    """The fingerprint of the part of ``length`` words from ``start`` in the list of a phrase of k words."""
    before = (length - 1) * (F.col("k") + 1) - F.floor((length - 1) * length / 2).cast("int")
    return F.col("parts")[before + start]


def frequent_phrases(
    docs: DataFrame, lang: Column, text: Column, longest: int = 3, least: int = 10, seeds: tuple[tuple[int, int], ...] = ((1, 64), (2, 64), (3, 64)),
    chunk_words: int = CHUNK_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """All runs of up to ``longest`` words with ``least`` occurrences or more in their language, and each language's words.

    The first table has k, mark, lang, phrase, parts and f, the second lang and n. ``seeds`` are tried in turn (seed and
    bits of a fingerprint) until no two different runs of words share a fingerprint.
    """
    rows = located(
        in_files(docs),
        [F.coalesce(text, F.lit("")).cast("binary").alias("text"), F.coalesce(lang, F.lit("und")).alias("lang")],
    ).select("text", "lang", "_loc.file", "_loc.row")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets_log = max(0, (size // BUCKET_BYTES).bit_length())
    for seed, bits in seeds:
        found = write_through(count_grams(rows, longest, least, seed, min(buckets_log, bits), bits, chunk_words), "grams")
        if not found.where("clash").isEmpty():
            continue
        told = write_through(materialised(rows, found, longest, seed, bits), "phrases")
        phrases = told.groupBy("k", "mark").agg(
            F.min("phrase").alias("phrase"),
            F.max("phrase").alias("_other"),
            F.min("lang").alias("lang"),
            F.max("lang").alias("_other_lang"),
            F.any_value("parts").alias("parts"),
        )
        if phrases.where("phrase <> _other or lang <> _other_lang").isEmpty():
            counted = found.where("k > 0").select("k", "mark", "f")
            totals = found.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
            return phrases.drop("_other", "_other_lang").join(counted, ["k", "mark"]), totals
    raise ValueError("fingerprints collide with every seed given")


def collocations(
    docs: DataFrame, lang: Column, text: Column, longest: int = 3, least: int = 10, share: int = 50, most: int = 2000, **how
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``most`` best phrases of two words or more.

    The score is floor(1000000 a a / (l r)) for the cut into two parts, of l and r occurrences, where it is lowest.
    A phrase goes if a longer frequent one that holds it has ``share`` percent of its occurrences or more.
    """
    found, totals = frequent_phrases(docs, lang, text, longest, least, **how)
    found = write_through(found, "frequent")
    whole = found.where("k > 1")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("k") - 1),
        lambda c: F.struct(c.alias("cut"), _part(c, F.lit(0)).alias("left"), _part(F.col("k") - c, c).alias("right")),
    )
    at_cuts = whole.select("k", "mark", F.col("f").alias("a"), F.explode(cuts).alias("c")).select("k", "mark", "a", "c.*")
    left = found.select(F.col("k").alias("cut"), F.col("mark").alias("left"), F.col("f").alias("l"))
    right = found.select(F.col("k").alias("_rest"), F.col("mark").alias("right"), F.col("f").alias("r"))
    both = at_cuts.withColumn("_rest", F.col("k") - F.col("cut")).join(left, ["cut", "left"]).join(right, ["_rest", "right"])
    big = {c: f"cast({c} as decimal(38,0))" for c in "alr"}
    score = F.expr(f"(1000000 * {big['a']} * {big['a']}) div ({big['l']} * {big['r']})")
    lowest = both.groupBy("k", "mark").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("k") - 1),
            lambda j: F.transform(
                F.sequence(F.lit(0), F.col("k") - j), lambda i: F.struct(j.alias("k"), _part(j, i).alias("mark"))
            ),
        )
    )
    around = (
        found.where("k > 2")
        .select(F.col("f").alias("around"), F.explode(inner).alias("p"))
        .groupBy("p.k", "p.mark")
        .agg(F.max("around").alias("around"))
    )
    scored = (
        whole.join(lowest, ["k", "mark"])
        .join(around, ["k", "mark"], "left")
        .where(F.coalesce(100 * F.col("around") < share * F.col("f"), F.lit(True)))
        .select("lang", "phrase", F.col("f").alias("a"), "low.l", "low.r", "low.score", "mark")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First the best of each share of a language, then the best of these.
    spread = Window.partitionBy("lang", F.pmod(F.col("mark"), F.lit(64))).orderBy(*order)
    best = scored.withColumn("_nth", F.row_number().over(spread)).where(F.col("_nth") <= most).drop("_nth")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )
