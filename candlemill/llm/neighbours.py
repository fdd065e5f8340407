"""Nearest neighbours by largest inner product, with multiprobe p-stable hashing.

p-stable hashes are made for distances, so vectors are lifted first: divided by
the largest norm and given one more component that makes them unit vectors,
while queries are normalised and get a zero.  The nearest lifted vector then has
the largest inner product.

One long vector would push all others to about the same distance from every
query.  So the vectors of a length are split into bands of norm, each a factor
``BAND`` wide and lifted by its own largest norm.  A query probes every band; a
band of fewer than ``SPARSE_ROWS`` vectors is not hashed but compared as a whole.

A table hashes a vector with several functions floor((a.v + b) / w), a Gaussian;
together they name a bucket.  A query visits more buckets than its own:
each function's value may move by one, and the sets of moves are taken in the
order of their estimated success (the sum of squared distances to the bucket
borders that they cross).  What the tables' buckets hold is reranked by exact
inner products, and the best of all tables are merged.

Each different vector is indexed once, with its smallest ids, and each different
query vector is searched once, so copies cost nothing.  Buckets are
dealt to shards by their hash; a bucket with more than ``SHARD_ROWS`` vectors is
salted over several, and the queries that visit a shard are dealt to parts of
``QUERY_PART``.  Inside a part, vectors meet the queries that visit their
bucket, in blocks.  A query that found fewer than it should is compared with
all shards, so small tables are searched exactly.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part, nor do NULL ids.  Only vectors of equal length meet.
Rows that repeat an id count once, with the smallest of its vectors.  Ties go to
the smaller id.  Tables without candidates give no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlemill.operators.keyed import match_keyed, top_per_key
from candlemill.workspace import checkpointed

TABLES = 6
FUNCTIONS = 8
WIDTH = 2.2
PROBES = 150
SEED = 7
#: Vectors in a shard, and queries that are compared with them at a time.
SHARD_ROWS = 65_536
QUERY_BLOCK = 128
#: Queries that one Python call holds, whatever share of them visits a place.
QUERY_PART = 4096
#: Largest norm of a band over its smallest, and vectors below which a band is not hashed.
BAND = 2**0.5
SPARSE_ROWS = 256
#: Scores this close to the last one that counts are worked out exactly.
CLOSE = 1e-9


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector, class): one row per id; equal vectors have the same class."""
    doubles = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + F.lit(0.0))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), doubles.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull()).where(finite & some)
    once = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    digest = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(seed), "vector")), 16, "0") for seed in (1, 2)])
    return once.withColumn("class", digest)


class Hashes:
    """The hash functions of all tables for lifted vectors of one length."""

    def __init__(self, length: int, tables: int, functions: int, width: float, seed: int):
        random = np.random.default_rng([seed, length])
        self.tables, self.functions, self.width = tables, functions, width
        self.directions = random.normal(size=(length, tables * functions))
        self.shifts = random.uniform(0, width, tables * functions)
        self.factors = random.integers(1, 1 << 62, (tables, functions), np.int64) * 2 + 1

    def places(self, lifted: np.ndarray) -> np.ndarray:
        """(a.v + b) / w of every vector: [vector, table, function]."""
        return ((lifted @ self.directions + self.shifts) / self.width).reshape(-1, self.tables, self.functions)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """Bucket keys of cells [..., table, function]."""
        with np.errstate(over="ignore"):
            return (cells * self.factors).sum(axis=-1)


def _by_length(vectors: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and matrix of the vectors of each length."""
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, np.array([vectors[i] for i in at], float)


def _keys_of(tables, functions, width, seed, lift, cells):
    """An Arrow function from vectors to their buckets: array of (table, key)."""

    @F.arrow_udf("array<struct<table: int, key: long>>")
    def buckets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hashes: dict[int, Hashes] = {}
        for batch in batches:
            found: list = [None] * len(batch)
            for at, matrix in _by_length(batch.to_pylist()):
                lifted = lift(matrix)
                size = lifted.shape[1]
                if size not in hashes:
                    hashes[size] = Hashes(size, tables, functions, width, seed)
                for start in range(0, len(at), QUERY_BLOCK):
                    rows = at[start : start + QUERY_BLOCK]
                    keys = cells(hashes[size], lifted[start : start + QUERY_BLOCK])
                    for row, of_tables in zip(rows.tolist(), keys, strict=True):
                        found[row] = [{"table": t, "key": int(k)} for t, of in enumerate(of_tables) for k in of]
            yield pa.array(found, pa.list_(pa.struct([("table", pa.int32()), ("key", pa.int64())])))

    return buckets


def norm_of(vector: str) -> Column:
    """Length of a finite vector that is not zero; squares neither overflow nor vanish."""
    largest = F.array_max(F.transform(vector, F.abs))
    squares = F.aggregate(
        F.transform(vector, lambda x: x / largest), F.lit(0.0), lambda total, x: total + x * x
    )
    return F.least(largest * F.sqrt(squares), F.lit(1.7e308))


def banded(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``classes`` (.., length, norm) with their ``band``, its largest norm ``lift`` and whether it is ``sparse``; and per
    length the ``bands`` that are hashed and whether ``some_sparse``.

    Doubles have some 4,200 bands at most, so these tables are small.
    """
    tops = checkpointed(classes.groupBy("length").agg(F.max("norm").alias("_top")))  # stored, so known to be small
    # From the largest norm down, so that equal norms that differ by rounding stay together.
    fall = -F.log(F.greatest(F.col("norm") / F.col("_top"), F.lit(1e-300))) / F.lit(float(np.log(BAND)))
    rows = match_keyed(classes, tops, ["length"], "inner").withColumn("band", F.floor(fall).cast("int")).drop("_top")
    bands = checkpointed(
        rows.groupBy("length", "band")
        .agg(F.max("norm").alias("lift"), F.count("*").alias("n"))
        .select("length", "band", "lift", (F.col("n") < SPARSE_ROWS).alias("sparse"))
    )
    of_length = bands.groupBy("length").agg(
        F.collect_list(F.when(~F.col("sparse"), F.col("band"))).alias("bands"), F.max("sparse").alias("some_sparse")
    )
    return match_keyed(rows, bands, ["length", "band"], "inner"), of_length


def index_buckets(norm: float, tables: int, functions: int, width: float, seed: int):
    def lift(matrix: np.ndarray) -> np.ndarray:
        scaled = matrix / norm
        return np.c_[scaled, np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))]

    def cells(hashes: Hashes, lifted: np.ndarray) -> np.ndarray:
        return hashes.keys(np.floor(hashes.places(lifted)).astype(np.int64))[:, :, None]

    return _keys_of(tables, functions, width, seed, lift, cells)


def probe_buckets(probes: int, tables: int, functions: int, width: float, seed: int):
    moves = np.array(list(product((-1, 0, 1), repeat=functions)), np.int64)

    def lift(matrix: np.ndarray) -> np.ndarray:
        return np.c_[matrix / np.linalg.norm(matrix, axis=1, keepdims=True), np.zeros(len(matrix))]

    def cells(hashes: Hashes, lifted: np.ndarray) -> np.ndarray:
        places = hashes.places(lifted)
        home = np.floor(places)
        inside = places - home
        keys = np.empty((len(lifted), tables, min(probes, len(moves))), np.int64)
        for table in range(tables):
            to_lower, to_upper = inside[:, table] ** 2, (1.0 - inside[:, table]) ** 2
            cost = to_lower @ (moves == -1).T + to_upper @ (moves == 1).T
            best = np.argsort(cost, axis=1, kind="stable")[:, : keys.shape[2]]
            visited = home[:, table].astype(np.int64)[:, None, :] + moves[best]
            with np.errstate(over="ignore"):
                keys[:, table] = (visited * hashes.factors[table]).sum(axis=-1)
        return keys

    return _keys_of(tables, functions, width, seed, lift, cells)


def _best(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed: np.ndarray, most: int):
    """For each query the best allowed vectors: (query, vector, score) positions, ties to smaller ids."""
    rough = np.where(allowed, queries @ vectors.T, -np.inf)
    kept = min(most, rough.shape[1])
    last = np.partition(rough, rough.shape[1] - kept, axis=1)[:, rough.shape[1] - kept]
    slack = CLOSE * np.linalg.norm(queries, axis=1) * (np.linalg.norm(vectors, axis=1).max() if len(vectors) else 0.0)
    for at in range(len(queries)):
        near = np.flatnonzero((rough[at] >= last[at] - slack[at]) & allowed[at])
        scores = (vectors[near] * queries[at]).sum(axis=1)
        order = np.lexsort((ids[near], -scores))[:most]
        yield at, near[order], scores[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1)


def compared(most: int):
    """The function for two cogrouped sides: vectors of a shard and the queries that visit it."""
    kind = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if left.num_rows and right.num_rows:
            ids = left["id"].to_numpy()
            buckets, bucket = np.unique(left["key"].to_numpy(), return_inverse=True)
            vectors = _matrix(left["vector"])
            names = right["id"].to_numpy()
            wanted = _matrix(right["vector"])
            visits = right["keys"].combine_chunks()
            for start in range(0, len(names), QUERY_BLOCK):
                block = slice(start, start + QUERY_BLOCK)
                visited = np.zeros((len(names[block]), len(buckets)), bool)
                for row, keys in enumerate(visits[start : start + QUERY_BLOCK]):
                    if not keys.is_valid:  # a search of everything
                        visited[row] = True
                    else:
                        keys = keys.values.to_numpy()
                        at = np.searchsorted(buckets, keys)
                        at[at == len(buckets)] = 0
                        visited[row, at[buckets[at] == keys]] = True
                columns = np.flatnonzero(visited.any(axis=0)[bucket])
                if len(columns):
                    allowed = visited[:, bucket[columns]]
                    for row, near, scores in _best(wanted[block], vectors[columns], ids[columns], allowed, most):
                        found.append((np.full(len(near), names[start + row]), ids[columns[near]], scores))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0)] * 3
        return pa.table([pa.array(x, field.type, from_pandas=False) for x, field in zip(columns, kind, strict=True)], kind)

    return compare


def _salted(hot: DataFrame | None, rows: DataFrame, spread: Column, replicate: bool) -> DataFrame:
    """``rows`` (table, key, ..) with the ``salt`` of their bucket: one by ``spread``, or all."""
    if hot is None:
        return rows.withColumn("salt", F.lit(0))
    salts = F.coalesce(F.col("salts"), F.lit(1))
    joined = match_keyed(rows, hot, ["table", "key"], "left")
    if replicate:
        return joined.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    return joined.withColumn("salt", F.pmod(F.xxhash64(spread), salts).cast("int")).drop("salts")


def _matched(index: DataFrame, queries: DataFrame, most: int, query_part: int = QUERY_PART) -> DataFrame:
    """(query, id, score): the best of each shard (place, length) for the queries there.

    The queries of a place are dealt to parts of ``query_part`` at most (a quarter less on
    average, since they are dealt by hash), each of which meets the vectors of the place.
    """
    place = ["place", "length"]
    queries = checkpointed(queries)  # counted and dealt, but probed once
    parts = queries.groupBy(*place).agg(F.ceil(F.count("*") * 1.25 / query_part).cast("int").alias("parts"))
    parts = checkpointed(parts)
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = match_keyed(queries, parts, place, "inner").withColumn("part", part).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    copied = match_keyed(index, parts, place, "inner").withColumn("part", copies).drop("parts")
    return copied.groupBy(*place, "part").cogroup(dealt.groupBy(*place, "part")).applyInArrow(
        compared(most), "query long, id long, score double"
    )


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    functions: int = FUNCTIONS,
    width: float = WIDTH,
    probes: int = PROBES,
    seed: int = SEED,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: up to ``k`` nearest rows of each query row.

    ``is_query`` is a condition on the column ``id`` (the row's id).
    """
    rows = checkpointed(usable(df, vec_id, vector))
    # A query needs k others at most, so of equal vectors the k + 1 smallest ids do.
    classes = checkpointed(
        top_per_key(rows, ["class"], [F.col("id")], k + 1)
        .groupBy("class")
        .agg(F.min("id").alias("first"), F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
        .withColumn("norm", norm_of("vector"))
        .withColumn("length", F.size("vector"))
    )
    asked = rows.where(is_query)
    targets = checkpointed(
        match_keyed(classes, asked.groupBy("class").agg(F.count("*").alias("_n")), ["class"], "inner").select(
            F.col("first").alias("id"), "class", "vector"
        )
    )
    length = F.lit(1.0) * F.size("vector")
    shards = max(1, -(-classes.count() // shard_rows))
    shape = (tables, functions, width, seed)

    rows_in_bands, of_length = banded(classes.select(F.col("first").alias("id"), "vector", "length", "norm"))
    in_band = F.xxhash64(F.col("band"), F.col("key")).alias("key")
    lifted = F.transform("vector", lambda x: x / F.col("lift"))
    hashed = rows_in_bands.where(~F.col("sparse")).select(
        "id", "vector", "band", F.inline(index_buckets(1 + 1e-12, *shape)(lifted))
    )
    whole = [F.lit(-1).alias("table"), F.lit(0).cast("long").alias("key")]  # the bucket of all sparse bands
    bucketed = hashed.select("id", "vector", "table", in_band).unionByName(
        rows_in_bands.where("sparse").select("id", "vector", *whole)
    )
    crowded = bucketed.groupBy("table", "key").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows)
    hot = checkpointed(crowded.select("table", "key", F.ceil(F.col("n") / shard_rows).cast("int").alias("salts")))
    hot = None if hot.isEmpty() else hot
    place = F.concat_ws("/", "table", F.pmod(F.xxhash64("table", "key", "salt"), F.lit(shards)))
    index = _salted(hot, bucketed, F.col("id"), False).select(
        place.alias("place"), length.alias("length"), "key", "id", "vector"
    )
    asking = match_keyed(targets.withColumn("length", F.size("vector")), of_length, ["length"], "inner")
    probed = asking.where(F.size("bands") > 0).select("id", "bands", F.inline(probe_buckets(probes, *shape)("vector")))
    probed = probed.select("id", "table", "key", F.explode("bands").alias("band")).select("id", "table", in_band)
    probed = probed.unionByName(asking.where("some_sparse").select("id", *whole))
    visits = _salted(hot, probed, F.col("id"), True).groupBy("id", place.alias("place")).agg(F.collect_list("key").alias("keys"))
    visiting = match_keyed(visits, targets.select("id", "vector"), ["id"], "inner").select(
        "place", length.alias("length"), "id", "vector", "keys"
    )
    merged = checkpointed(_merged(_matched(index, visiting, k + 1), k))

    # Whoever found fewer classes than there are to find looks at all shards.
    there = classes.groupBy(length.alias("length")).agg(F.count("*").alias("_n"))
    found = merged.groupBy("query").agg(F.count("*").alias("_found")).withColumnRenamed("query", "id")
    short = match_keyed(match_keyed(targets.withColumn("length", length), there, ["length"], "left"), found, ["id"], "left")
    short = checkpointed(short.where(F.coalesce("_found", F.lit(0)) < F.least(F.col("_n"), F.lit(k + 1))).select("id", "length", "vector"))
    if not short.isEmpty():
        everywhere = classes.select(
            F.pmod(F.xxhash64("first"), F.lit(shards)).cast("string").alias("place"),
            length.alias("length"),
            F.lit(0).cast("long").alias("key"),
            F.col("first").alias("id"),
            "vector",
        )
        asking = short.select(
            F.explode(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda n: n.cast("string"))).alias("place"),
            "length",
            "id",
            "vector",
            F.lit(None).cast("array<long>").alias("keys"),
        )
        again = _merged(_matched(everywhere, asking, k + 1), k)
        merged = match_keyed(merged, short.select("id").withColumnRenamed("id", "query"), ["query"], "left_anti").unionByName(again)

    members = match_keyed(merged, classes.select(F.col("first").alias("id"), "ids"), ["id"], "inner")
    listed = members.groupBy("query").agg(
        F.flatten(
            F.collect_list(F.transform("ids", lambda x: F.struct((-F.col("score")).alias("minus"), x.alias("vec_id"))))
        ).alias("near")
    )
    by_class = match_keyed(targets.select("class", F.col("id").alias("query")), listed, ["query"], "inner").select("class", "near")
    answers = match_keyed(asked.select("id", "class"), by_class, ["class"], "inner")
    others = F.slice(F.array_sort(F.filter("near", lambda x: x["vec_id"] != F.col("id"))), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score")
    )


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best k + 1 classes of each query; what several tables found counts once."""
    once = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    return top_per_key(once, ["query"], [F.col("score").desc(), F.col("id")], k + 1)
