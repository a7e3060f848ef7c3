"""Approximate nearest neighbours by multiprobe p-stable hashing.

Vectors are hashed by several tables of p-stable (Gaussian) functions floor((a.x + b) / w), whose
values, clamped to SLOTS slots each, name a bucket. A row is stored once in each table, under its
bucket. A query's probes are made function by function: perturbed buckets in the order of their
estimated success - the squared distance from the query's own projections to the bucket's slots, in
units of w - as far as a score that is calibrated. Probes meet the stored buckets in a join; what lies
in them is ranked by the exact measure on the original vectors, and the tables' candidates are merged.

The measure is the inner product. Vectors get one more component, that makes all of one length;
among these the nearest by distance are those of the largest inner product with a query.

Calibration: for a bounded sample of queries the exact neighbours are found among all rows, and the
score up to which buckets are probed is that which finds `recall` of them.

Scale: equal vectors are one class, of which only the k + 1 smallest ids can be in any result. Buckets
are packed into groups of about GROUP_ROWS rows, and a query is sent once to each group in which it
probes a bucket. A group that a hot bucket makes larger is cut into pieces, and the queries that
probe it into blocks; every piece meets every block, each pair in a task of its own. A task emits its
best k + 1 classes of each query.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from errata.llm.common import forget, mapped, written

NEIGHBOURS = 20
TABLES = 2
#: Each function takes one of so many slots; those at the ends are open.
SLOTS = 4
#: A width of so many standard deviations, and the bits that a function's slots then tell.
WIDTH, SLOT_BITS = 1.3, 1.65
#: There are so many functions that a bucket has about so many rows, and within these limits.
BUCKET_ROWS = 32
FUNCTIONS = (2, 16)
RECALL = 0.95
SAMPLE_QUERIES = 96
SAMPLE_ROWS = 4000
QUERY_EVERY = 20
#: Rows and queries that a task takes at once, about.
GROUP_ROWS = 16384
QUERY_BLOCK = 4096
#: Queries whose probes, or scores, are worked out at once.
PROBED = 16
TILE = 256


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, v) of rows with an id and a vector of finite components, not all zero, of the usual size.

    Rows that repeat id and vector count once. The usual size is the most frequent (the larger, if
    two are as frequent); an inner product with others is not defined.
    """
    v = F.col("v")
    rows = vectors.select(F.col(key).alias("id"), F.col(column).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & v.isNotNull() & F.exists(v, lambda x: x != 0))
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    usual = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.filter(F.size("v") == (usual["d"] if usual else 0))


def classes_of(rows: DataFrame, least: int) -> DataFrame:
    """Distinct vectors: name, v and the `least` smallest ids of each. A common vector's rows are
    cut to these before they are shuffled."""
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    kept = rows.withColumn("turn", first).filter(F.col("turn") <= least)
    grouped = kept.groupBy("v").agg(F.slice(F.array_sort(F.collect_set("id")), 1, least).alias("ids"))
    return grouped.select(F.element_at("ids", 1).alias("name"), "v", "ids")


@dataclass
class Index:
    """The hash functions, the norm that bounds all rows, and the score up to which to search."""

    norm: float
    a: np.ndarray  # tables, functions, dimensions + 1
    b: np.ndarray  # tables, functions
    width: np.ndarray  # tables
    reach: float = np.inf

    def hashed(self, x: np.ndarray) -> np.ndarray:
        """Projections of rows in units of the width: rows, tables, functions."""
        unit = x / self.norm
        longer = np.column_stack([unit, np.sqrt(np.maximum(0, 1 - (unit**2).sum(1)))])
        return self._project(longer)

    def asked(self, q: np.ndarray) -> np.ndarray:
        unit = q / np.sqrt((q**2).sum(1))[:, None]
        return self._project(np.column_stack([unit, np.zeros(len(q))]))

    def _project(self, x: np.ndarray) -> np.ndarray:
        return (np.einsum("nd,tfd->ntf", x, self.a) + self.b) / self.width[None, :, None]

    @staticmethod
    def slots(hashed: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(hashed) + SLOTS // 2, 0, SLOTS - 1).astype(np.int64)

    @staticmethod
    def gaps(asked: np.ndarray, slots: np.ndarray) -> np.ndarray:
        """Squared distances to slots; those at the ends are open."""
        gap = asked - (slots - SLOTS // 2)
        below = np.where(slots == 0, 0, np.maximum(0, -gap))
        above = np.where(slots == SLOTS - 1, 0, np.maximum(0, gap - 1))
        return (below + above) ** 2

    @staticmethod
    def buckets(slots: np.ndarray) -> np.ndarray:
        """The number of each bucket, from the last axis."""
        out = np.zeros(slots.shape[:-1], np.int64)
        for f in range(slots.shape[-1]):
            out = out * SLOTS + slots[..., f]
        return out

    def probes(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, bucket) of one table, for each query in the order of estimated success. Buckets are
        perturbed function by function; what is beyond the reach already is not perturbed further."""
        every = np.arange(SLOTS)
        query, cost, bucket = np.arange(len(asked)), np.zeros(len(asked)), np.zeros(len(asked), np.int64)
        for f in range(asked.shape[1]):
            more = cost[:, None] + self.gaps(asked[query, f][:, None], every[None, :])
            at, slot = np.nonzero(more <= self.reach)
            query, cost, bucket = query[at], more[at, slot], bucket[at] * SLOTS + slot
        order = np.lexsort((bucket, cost, query))
        return query[order], bucket[order]


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products along the last axis, summed in the same order wherever a vector stands."""
    return np.ascontiguousarray(x * q).sum(-1)


def _vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _best(x: np.ndarray, first: np.ndarray, q: np.ndarray, seen, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the best `most` rows of each query, of those that seen(queries) allows."""
    out = []
    for at in range(0, len(q), TILE):
        part = slice(at, min(at + TILE, len(q)))
        rough = seen(part, q[part])
        n = min(most + 3, rough.shape[1])
        top = np.argpartition(-rough, n - 1, axis=1)[:, :n]
        score = _exact(x[top], q[part][:, None, :])
        score[np.isneginf(np.take_along_axis(rough, top, 1))] = -np.inf
        order = np.lexsort((first[top], -score), axis=1)[:, :most]
        score, top = np.take_along_axis(score, order, 1), np.take_along_axis(top, order, 1)
        query, place = np.nonzero(np.isfinite(score))
        out.append((at + query, top[query, place], score[query, place]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


FOUND = "query long, score double, ids array<long>"


def _found(names: np.ndarray, query: np.ndarray, score: np.ndarray, row: np.ndarray, ids) -> list[pa.Array]:
    return [pa.array(names[query]), pa.array(score), ids.take(pa.array(row)).cast(pa.list_(pa.int64()))]


def exact_search(index_rows: DataFrame, names: np.ndarray, queries: np.ndarray, most: int) -> DataFrame:
    """Of a few queries the best `most` classes in each batch of rows: query (its name), score, ids."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("v"))
                first = pc.list_element(batch.column("ids"), 0).to_numpy()
                query, row, score = _best(x, first, queries, lambda part, q, x=x: q @ x.T, most)
                yield pa.RecordBatch.from_arrays(_found(names, query, score, row, batch.column("ids")), ["query", "score", "ids"])

    return mapped(index_rows.select("v", "ids"), search, FOUND)


def _placed(index_rows: DataFrame, index: Index, groups: int) -> DataFrame:
    """name, v, ids, t, g, bucket: each row in each table."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                slots = index.slots(index.hashed(_vectors(batch.column("v"))))
                for t in range(slots.shape[1]):
                    bucket = index.buckets(slots[:, t])
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(_groups(bucket, groups)), pa.array(bucket)], [*names, "t", "g", "bucket"])

    names = ["name", "v", "ids"]
    fields = [*(index_rows.schema[c] for c in names), T.StructField("t", T.IntegerType()), T.StructField("g", T.IntegerType()), T.StructField("bucket", T.LongType())]
    return mapped(index_rows.select(names), place, T.StructType(fields))


def _groups(bucket: np.ndarray, groups: int) -> np.ndarray:
    """The group of each bucket, as even as a hash is."""
    mixed = bucket.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ mixed >> np.uint64(32)) % np.uint64(groups)).astype(np.int32)


def _probed(queries: DataFrame, index: Index, groups: int) -> DataFrame:
    """name, v, t, g, buckets (in the order of the probes): each query in each group that it probes."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asked = index.asked(_vectors(batch.column("v")))
            for t in range(asked.shape[1]):
                for at in range(0, len(asked), PROBED):
                    query, bucket = index.probes(asked[at : at + PROBED, t])
                    g = _groups(bucket, groups)
                    order = np.lexsort((g, query))  # stable: a group's probes keep their order
                    query, bucket, g = query[order], bucket[order], g[order]
                    new = np.flatnonzero(np.append(True, (query[1:] != query[:-1]) | (g[1:] != g[:-1])))
                    offsets = pa.array(np.append(new, len(query)).astype(np.int32))
                    own = batch.slice(at, PROBED).take(pa.array(query[new]))
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(np.full(len(new), t, np.int32)), pa.array(g[new]), pa.ListArray.from_arrays(offsets, pa.array(bucket))], ["name", "v", "t", "g", "buckets"])

    fields = [*(queries.schema[c] for c in ("name", "v")), T.StructField("t", T.IntegerType()), T.StructField("g", T.IntegerType()), T.StructField("buckets", T.ArrayType(T.LongType()))]
    return mapped(queries.select("name", "v"), probe, T.StructType(fields))


def search(index_rows: DataFrame, queries: DataFrame, index: Index, most: int, *, group_rows: int = GROUP_ROWS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Of each query (name, v) the best `most` classes of each task: query, score, ids."""
    groups = max(1, -(-index_rows.count() // group_rows))
    placed = written(_placed(index_rows, index, groups), "placed")
    probed = written(_probed(queries, index, groups), "probed")
    key = ["t", "g"]
    pieces = placed.groupBy(key).agg(F.ceil(F.count("*") / (2 * group_rows)).cast("int").alias("pieces"))
    blocks = probed.groupBy(key).agg(F.ceil(F.count("*") / query_block).cast("int").alias("blocks"))
    sizes = written(pieces.join(blocks, key), "sizes")
    # Both sides' keys are of one type: they are dealt by their hashes.
    own_piece, own_block = F.pmod(F.xxhash64("name"), F.col("pieces")).cast("int"), F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
    rows = placed.join(sizes, key).withColumn("piece", own_piece).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = probed.join(sizes, key).withColumn("block", own_block).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))

    def meet(own: pa.Table, asked: pa.Table) -> pa.Table:
        if not own.num_rows or not asked.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        own = own.sort_by("bucket")
        x, bucket = _vectors(own["v"]), own["bucket"].to_numpy()
        ids = own["ids"].combine_chunks()
        first = pc.list_element(ids, 0).to_numpy()
        q, probes = _vectors(asked["v"]), asked["buckets"].combine_chunks()
        there, start = np.unique(bucket, return_index=True)
        end = np.append(start[1:], len(bucket))
        edges = probes.offsets.to_numpy()

        def seen(part: slice, tile: np.ndarray) -> np.ndarray:
            scores = np.full((len(tile), len(x)), -np.inf)
            wanted = probes.values.to_numpy()[edges[part.start] : edges[part.stop]]
            who = np.repeat(np.arange(len(tile)), np.diff(edges[part.start : part.stop + 1]))
            at = np.minimum(np.searchsorted(there, wanted), len(there) - 1)
            hit = there[at] == wanted
            who, at = who[hit], at[hit]
            order = np.argsort(at, kind="stable")
            who, at = who[order], at[order]
            cuts = np.append(np.flatnonzero(np.diff(at, prepend=-1)), len(at))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                rows = slice(start[at[lo]], end[at[lo]])
                scores[who[lo:hi], rows] = tile[who[lo:hi]] @ x[rows].T
            return scores

        query, row, score = _best(x, first, q, seen, most)
        return pa.table(_found(asked["name"].to_numpy(), query, score, row, ids), names=["query", "score", "ids"])

    by = ["t", "g", "piece", "block"]
    found = rows.select(*by, "bucket", "v", "ids").groupBy(by).cogroup(asking.select(*by, "name", "v", "buckets").groupBy(by)).applyInArrow(meet, FOUND)
    best = written(best_of(found, most), "neighbours")
    forget(placed, probed, sizes)
    return best


def build(index_rows: DataFrame, *, tables: int = TABLES, functions: int | None = None, width: float = WIDTH, seed: int = 7) -> Index:
    """Hash functions fitted to a bounded sample of rows; the norm, and the number of functions if it
    is not given, are those for all rows."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    most, n = index_rows.agg(F.max(square), F.count("*")).first()
    norm = float(np.sqrt(most)) * (1 + 1e-12)
    if functions is None:
        functions = int(np.clip(round(np.log2(max(1, n / BUCKET_ROWS)) / SLOT_BITS), *FUNCTIONS))
    sample = np.array([r["v"] for r in index_rows.orderBy(F.xxhash64("name")).limit(SAMPLE_ROWS).select("v").collect()])
    random = np.random.default_rng(seed)
    a = random.normal(size=(tables, functions, sample.shape[1] + 1))
    index = Index(norm, a, np.zeros((tables, functions)), np.ones(tables))
    hashed = index.hashed(sample)
    index.width = np.maximum(hashed.std(axis=0).mean(axis=1), 1e-9) * width
    # Slots lie about the middle of the rows, shifted at random within one.
    index.b = random.uniform(size=(tables, functions)) * index.width[:, None] - hashed.mean(axis=0)
    return index


def best_of(found: DataFrame, most: int) -> DataFrame:
    """The best classes of each query over all tasks and tables, each once: what several tables found
    has the same score and first id, and so one place. A query's rows are cut before they are shuffled."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.element_at("ids", 1))
    kept = found.withColumn("turn", F.dense_rank().over(order)).filter(F.col("turn") <= most)
    return kept.groupBy("query", "turn").agg(F.first("score").alias("score"), F.first("ids").alias("ids")).drop("turn")


def calibrate(index_rows: DataFrame, queries: DataFrame, index: Index, most: int, recall: float) -> Index:
    """Sets how far to search, by the exact neighbours of a bounded sample of queries among all rows."""
    sample = queries.orderBy(F.xxhash64("name", F.lit(1))).limit(SAMPLE_QUERIES).collect()
    if not sample:
        return index
    names, q = np.array([r["name"] for r in sample], np.int64), np.array([r["v"] for r in sample])
    exact = best_of(exact_search(index_rows, names, q, most), most).select("query", F.element_at("ids", 1).alias("name"))
    near = exact.join(index_rows.select("name", "v"), "name").collect()
    if not near:
        return index
    place = {n: i for i, n in enumerate(names.tolist())}
    asked = index.asked(q)[[place[r["query"]] for r in near]]
    score = index.gaps(asked, index.slots(index.hashed(np.array([r["v"] for r in near])))).sum(-1).min(axis=1)
    index.reach = float(np.quantile(score, recall)) + 1e-6
    return index


def neighbours(vectors: DataFrame, *, key: str = "vec_id", column: str = "embedding", k: int = NEIGHBOURS, every: int = QUERY_EVERY, recall: float = RECALL, group_rows: int = GROUP_ROWS, query_block: int = QUERY_BLOCK, **shape) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: of each query its k best rows found, without itself.

    Queries are the rows whose id is divisible by `every`. Ties go to the smaller id. If there are
    fewer than k candidates, all come back that are found. No usable vectors give no rows: those that
    are null, zero, or hold a null or a component that is not finite are not usable, nor those of
    another dimension than most have, with which an inner product is not defined.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, key, column).withColumn("id", F.col("id").cast("long"))
    index_rows = written(classes_of(rows, k + 1), "vectors")
    asking = rows.filter(F.col("id") % every == 0)
    # A query's class goes by the least id that asks; (id, name) pairs carry no vectors further on.
    same = F.md5(F.col("v").cast("string").cast("binary"))
    asking = written(asking.withColumn("same", same), "asking")
    if index_rows.isEmpty() or asking.isEmpty():
        return spark.createDataFrame([], schema)
    least = asking.groupBy("same").agg(F.min("id").alias("name"))
    members = written(asking.select("id", "same").join(least, "same").select("id", "name").distinct(), "members")
    queries = written(asking.join(least, "same").filter("id = name").select("name", "v").distinct(), "queries")
    index = calibrate(index_rows, queries, build(index_rows, **shape), k + 1, recall)
    best = search(index_rows, queries, index, k + 1, group_rows=group_rows, query_block=query_block)
    each = members.join(best.select(F.col("query").alias("name"), "score", F.explode("ids").alias("vec_id")), "name").filter("vec_id != id")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("score"), "vec_id"))
    return each.select(F.col("id").alias("query_id"), rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
