"""Nearest vectors by cosine: lists around centroids, scanned a few dimensions at a time.

Vectors are cut to length one and turned by a fixed random rotation, after which any few of their columns say as
much about a distance as any others. A list's vectors lie in blocks of columns. After each block a hypothesis test
compares the distance so far, scaled up, with the best found in the list; a candidate that would have to be lucky
is abandoned, and only what is left reads the next block. What stays is scored on the original vectors.

Equal vectors are one entry of the index; it keeps the smallest ids, as many as any result can show, so nothing is
lost by it. How many lists a query looks into is measured, not set: a sample of vectors is compared with all others
exactly, and as many lists are probed as hold the stated share of the true neighbours. A query goes on to further
lists while those probed hold too few candidates. Lists are cut into chunks and a list's queries into groups, so
that a cell has a bounded number of each, however the vectors and the queries are spread.

Cases. Vectors that are null, empty, all zero, or hold a null or a value that is not finite take no part; nor do
vectors of another length than the most frequent one (of equally frequent ones the longest). Rows that repeat an id,
or have none, are candidates each; a query meets all rows but its own, and a row without an id is no query. Of equal
scores the smaller id comes first, rows without one last. Fewer candidates than asked for give fewer rows, an empty
table none. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.llm.common import extended, in_files, located
from etalage.session import write_through

#: The most lists, sampled vectors a list to fit them on, and vectors that are compared with all others.
MOST_LISTS, SAMPLE_A_LIST, COMPARED = 4096, 64, 512
#: Share of true neighbours that the probed lists of the sample must hold.
COVER = 0.97
#: Rows and queries of a cell, columns of a block, and how unlikely a candidate must be to be abandoned.
CELL_ROWS, CELL_QUERIES, BLOCK, EPSILON = 16_384, 4_096, 16, 2.1


def _matrix(vectors: pa.Array) -> np.ndarray:
    return np.asarray(vectors.flatten()).astype(np.float64).reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 0))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows cut to length one; the largest value is taken out first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The cosine of each query and its candidates (queries x candidates x columns), in double precision."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        sizes = np.sqrt((vectors * vectors).sum(-1)) * np.sqrt((queries * queries).sum(-1))[:, None]
        found = (vectors * queries[:, None, :]).sum(-1) / sizes
    odd = ~np.isfinite(found) | ~np.isfinite(sizes) | (sizes < 1e-290)
    for i, j in zip(*np.nonzero(odd), strict=True):
        found[i, j] = float((unit(vectors[i, j][None])[0] * unit(queries[i][None])[0]).sum())
    return found


def rotation(size: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def fit(sample: np.ndarray, lists: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centroids of length one: spherical k-means."""
    draw = np.random.default_rng(seed)
    centroids = sample[draw.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        own = np.concatenate([np.argmax(sample[a : a + 4096] @ centroids.T, axis=1) for a in range(0, len(sample), 4096)])
        order = np.argsort(own, kind="stable")
        begins = np.flatnonzero(np.r_[True, np.diff(own[order]) > 0])
        sums = np.add.reduceat(sample[order], begins)
        size = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        full = size[:, 0] > 1e-12
        centroids[own[order][begins][full]] = sums[full] / size[full]
    return centroids


def scan(queries: np.ndarray, rows: np.ndarray, most: int, epsilon: float = EPSILON, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, int]:
    """For rotated unit vectors: the ``most`` nearest rows of each query (-1: none), their squared distances, and how
    many values of rows were read. Of equal distances the earlier row stays."""
    size = queries.shape[1]
    cuts = list(range(0, size, block)) + [size]
    blocks = [np.ascontiguousarray(rows[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    asked = [np.ascontiguousarray(queries[:, a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    best = np.full((len(queries), most), np.inf)
    at = np.full((len(queries), most), -1)
    read = 0
    begins = [0]
    while begins[-1] < len(rows):  # a few first, to have something to compare with
        begins.append(min(len(rows), begins[-1] + (64 if len(begins) == 1 else 2048)))
    for lo in range(0, len(queries), 256):
        hi = min(lo + 256, len(queries))
        for a, b in zip(begins, begins[1:], strict=False):
            limit = best[lo:hi, -1]
            first, mine = blocks[0][a:b], asked[0][lo:hi]
            part = (mine * mine).sum(1)[:, None] + (first * first).sum(1)[None, :] - 2 * (mine @ first.T)
            read += part.size * first.shape[1]
            q, r = np.nonzero(_hopeful(part, limit[:, None], cuts[1], size, epsilon))
            so_far = part[q, r]
            for j in range(1, len(blocks)):
                gap = asked[j][lo:hi][q] - blocks[j][a:b][r]
                read += gap.size
                so_far = so_far + (gap * gap).sum(1)
                keep = _hopeful(so_far, limit[q], cuts[j + 1], size, epsilon)
                q, r, so_far = q[keep], r[keep], so_far[keep]
            order = np.lexsort((r, so_far, q))
            q, r, so_far = q[order], r[order], so_far[order]
            nth = np.arange(len(q)) - np.searchsorted(q, q)
            keep = nth < most
            new, who = np.full((hi - lo, most), np.inf), np.full((hi - lo, most), -1)
            new[q[keep], nth[keep]], who[q[keep], nth[keep]] = so_far[keep], a + r[keep]
            both, ids = np.concatenate([best[lo:hi], new], 1), np.concatenate([at[lo:hi], who], 1)
            order = np.argsort(both, axis=1, kind="stable")[:, :most]
            best[lo:hi], at[lo:hi] = np.take_along_axis(both, order, 1), np.take_along_axis(ids, order, 1)
    return at, best, read


def _hopeful(part: np.ndarray, limit: np.ndarray, columns: int, size: int, epsilon: float) -> np.ndarray:
    """The test: not so far, after ``columns`` of ``size``, that the whole distance is under the limit by luck only."""
    slack = (1 + epsilon / math.sqrt(columns)) ** 2 if columns < size else 1
    return part * (size / columns) <= limit * slack


def usable(vectors: DataFrame, key: Column, vector: Column) -> DataFrame:
    """key, vector and the row's place (hash of its file, number in the file) of all rows that take part."""
    rows = located(in_files(vectors), [key.alias("key"), vector.alias("vector")])
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.coalesce(fine & some, F.lit(False))).select(
        "key", "vector", F.struct(F.xxhash64("_loc.file").alias("file"), F.col("_loc.row").alias("row")).alias("place")
    )
    return rows


def _drawn(rows: DataFrame, n: int, of: int) -> DataFrame:
    """About ``n`` of ``of`` rows, all rows if there are fewer, by a hash of the vector: the same ones on every run."""
    return rows.where(F.pmod(F.xxhash64(F.lit(n), "vector"), F.lit(1 << 30)) < F.lit(math.ceil((1 << 30) * min(1.0, n / of))))


def build(rows: DataFrame, size: int, n: int, most: int, lists: int | None = None) -> tuple[DataFrame, np.ndarray]:
    """The index: entry, vector, the ``most`` smallest (key, place) that have it, and its list; and the centroids.

    Centroids are fitted on about SAMPLE_A_LIST vectors a list, MOST_LISTS lists at most; every vector is indexed.
    """
    lists = lists or min(MOST_LISTS, max(1, math.ceil(math.sqrt(n) / 4)))
    sample = _drawn(rows.select("vector"), SAMPLE_A_LIST * lists, n).distinct().orderBy("vector").toArrow()
    centroids = fit(unit(_matrix(sample.column(0).combine_chunks())), lists)
    line = Window.partitionBy("vector").orderBy(F.col("key").asc_nulls_last(), "place")
    entries = (
        rows.withColumn("nth", F.row_number().over(line))
        .where(F.col("nth") <= most)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list(F.struct("nth", "key", "place"))).alias("holders"))
        .select(F.monotonically_increasing_id().alias("entry"), "vector", "holders")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = np.argmax(unit(_matrix(batch.column(1))) @ centroids.T, axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "list"])

    return write_through(entries.mapInArrow(run, extended(entries.schema, "list int")), "index"), centroids


def _probe_order(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argsort(-(unit(vectors) @ centroids.T), axis=1, kind="stable")


def measured_probes(index: DataFrame, n: int, centroids: np.ndarray, nearest: int, cover: float = COVER) -> int:
    """How many lists a query must look into: a sample of entries is compared with all, exactly."""
    sample = _drawn(index.select("entry", "vector"), COMPARED, n).orderBy("entry").toArrow()
    if not sample.num_rows:
        return 1
    ids, asked = sample.column(0).to_numpy(), unit(_matrix(sample.column(1).combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, own = np.full((len(ids), nearest), -np.inf), np.full((len(ids), nearest), -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            near = asked @ unit(_matrix(batch.column(1))).T
            near[ids[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            both = np.concatenate([best, near], 1)
            lists = np.concatenate([own, np.broadcast_to(batch.column(2).to_numpy(), near.shape)], 1)
            order = np.argpartition(-both, nearest - 1, axis=1)[:, :nearest]
            best, own = np.take_along_axis(both, order, 1), np.take_along_axis(lists, order, 1)
        row, col = np.nonzero(np.isfinite(best))
        columns = [pa.array(row), pa.array(best[row, col]), pa.array(own[row, col].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", "near", "list"])

    found = index.select("entry", "vector", "list").mapInArrow(run, "row long, near double, list int")
    nth = F.row_number().over(Window.partitionBy("row").orderBy(F.col("near").desc(), "list"))
    true = found.withColumn("nth", nth).where(F.col("nth") <= nearest).select("row", "list").toArrow()
    if not true.num_rows:
        return 1
    order = _probe_order(asked, centroids)
    rank = np.empty_like(order)
    rank[np.arange(len(order))[:, None], order] = np.arange(len(centroids))
    ranks = np.sort(rank[true.column(0).to_numpy(), true.column(1).to_numpy()])
    return int(ranks[math.ceil(cover * len(ranks)) - 1]) + 1


def nearest(
    vectors: DataFrame, key: Column, vector: Column, is_query: Column, nearest: int = 5, lists: int | None = None, probes: int | None = None,
    cell_rows: int = CELL_ROWS, cell_queries: int = CELL_QUERIES,
) -> DataFrame:
    """query, rank, key, score: the ``nearest`` best rows found for each row where ``is_query``, about column ``key``, holds.

    ``probes`` is measured unless it is given.
    """
    rows = usable(vectors, key, vector)
    most = nearest + 1  # a query's own row may be among them
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.col("count").desc(), F.col("size").desc()).first()
    if sizes is None:
        kind = rows.select("key").schema["key"].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"query {kind}, rank int, key {kind}, score double")
    size, n = sizes
    rows = rows.where(F.size("vector") == size)
    index, centroids = build(rows, size, n, most, lists)
    probes = probes or measured_probes(index, n, centroids, nearest)
    asking = rows.withColumn("asks", is_query).where("key is not null and asks").drop("asks")
    asked = write_through(asking.select("vector").distinct().select(F.monotonically_increasing_id().alias("query"), "vector"), "queries")

    # At most a row for each list: how many entries and rows it has.
    held = index.groupBy("list").agg(F.count("*").alias("entries"), F.sum(F.size("holders")).alias("rows")).toArrow()
    n_entries, n_rows = np.zeros(len(centroids), np.int64), np.zeros(len(centroids), np.int64)
    n_entries[held.column(0).to_numpy()], n_rows[held.column(0).to_numpy()] = held.column(1).to_numpy(), held.column(2).to_numpy()
    chunks = -(-n_entries // cell_rows)

    def probed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Query's place in the batch and list, for each list it looks into; empty lists are left out."""
        order = _probe_order(_matrix(batch.column(1)), centroids)
        before = np.cumsum(n_rows[order], axis=1) - n_rows[order]
        looks = ((np.arange(order.shape[1]) < probes) | (before < most)) & (n_rows[order] > 0)
        row, col = np.nonzero(looks)
        return row, order[row, col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(centroids), np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(probed(batch)[1], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["list", "n"])

    told = asked.mapInArrow(count, "list int, n long").groupBy("list").agg(F.sum("n")).toArrow()
    groups = np.ones(len(centroids), np.int64)
    groups[told.column(0).to_numpy()] = -(-told.column(1).to_numpy() // cell_queries)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, own = probed(batch)
            row, own = np.repeat(row, chunks[own]), np.repeat(own, chunks[own])
            begins = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(own) != 0)]) if len(row) else np.zeros(0, np.int64)
            chunk = np.arange(len(row)) - np.repeat(begins, np.diff(np.r_[begins, len(row)]))
            group = batch.column(0).to_numpy()[row] * 0x9E3779B1 % (1 << 31) % groups[own]
            for a in range(0, len(row), 4096):
                cut = slice(a, a + 4096)
                cell = [pa.array(x[cut].astype(np.int32)) for x in (own, chunk, group)]
                yield pa.RecordBatch.from_arrays([*cell, *batch.take(pa.array(row[cut])).columns], names=["list", "chunk", "part", "query", "vector"])

    kind = asked.schema["vector"].dataType.simpleString()
    sent = asked.mapInArrow(send, f"list int, chunk int, part int, query long, vector {kind}")
    counts = F.array(*[F.struct(F.lit(int(c)).alias("chunks"), F.lit(int(g)).alias("parts")) for c, g in zip(chunks, groups, strict=True)])
    placed = index.withColumn("_of", counts[F.col("list")]).select(
        "list",
        F.pmod(F.xxhash64("entry"), F.greatest(F.col("_of.chunks"), F.lit(1))).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("_of.parts") - 1)).alias("part"),
        "entry",
        "vector",
        "holders",
    )
    def search(entries: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("holders", entries.schema.field("holders").type)])
        if not entries.num_rows or not queries.num_rows:
            return schema.empty_table()
        # In the order of the smallest key, so that ties go to it.
        keys = [h[0]["key"] for h in entries.column("holders").to_pylist()]
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, 0 if keys[i] is None else keys[i], i))
        entries = entries.take(pa.array(order))
        raw, asks = (_matrix(t.column("vector").combine_chunks()) for t in (entries, queries))
        turn = rotation(raw.shape[1])
        at, _, _ = scan(unit(asks) @ turn, unit(raw) @ turn, most)
        scores = np.concatenate([cosine(asks[i : i + 512], raw[np.maximum(at[i : i + 512], 0)]) for i in range(0, len(asks), 512)])
        row, col = np.nonzero(at >= 0)
        columns = [queries.column("query").take(pa.array(row)), pa.array(scores[row, col]), entries.column("holders").take(pa.array(at[row, col]))]
        return pa.Table.from_arrays(columns, schema=schema)

    shape = index.schema["holders"].dataType.simpleString()
    cell = ["list", "chunk", "part"]
    found = placed.groupBy(*cell).cogroup(sent.groupBy(*cell)).applyInArrow(search, f"query long, score double, holders {shape}")
    line = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("holder.key").asc_nulls_last(), "holder.place")
    best = (
        found.select("query", "score", F.explode("holders").alias("holder"))
        .withColumn("nth", F.row_number().over(line))
        .where(F.col("nth") <= most)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("nth", "score", "holder.key", "holder.place"))).alias("found"))
    )
    answers = asked.join(best, "query").select("vector", "found")
    others = F.slice(F.filter("found", lambda x: x["place"] != F.col("place")), 1, nearest)
    return (
        asking.join(answers, "vector")
        .select(F.col("key").alias("query"), F.posexplode(others).alias("pos", "hit"))
        .select("query", (F.col("pos") + 1).alias("rank"), "hit.key", "hit.score")
    )
