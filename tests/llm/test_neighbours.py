"""Nearest neighbours against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlemill.llm import neighbours, queries


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")


def brute(rows, k, every=1):
    """Answers of all rows whose id is a multiple of ``every``."""
    found = {}
    for query, q in rows:
        if query % every == 0:
            others = sorted((-float(np.dot(q, v)), i) for i, v in rows if i != query and len(v) == len(q))
            found[query] = [(i, -minus) for minus, i in others[:k]]
    return found


def answers(df):
    found = {}
    for row in df.orderBy("query_id", "rank").collect():
        assert row["rank"] == len(found.setdefault(row["query_id"], [])) + 1
        found[row["query_id"]].append((row["vec_id"], row["score"]))
    return found


def test_small_table_is_exact(spark):
    random = np.random.default_rng(1)
    rows = [(i, [float(x) for x in random.integers(-3, 4, 5)]) for i in range(40)]
    rows = [(i, v) for i, v in rows if any(v)]
    assert answers(neighbours.nearest(frame(spark, rows), F.lit(True), k=50)) == brute(rows, 50)


def test_ties_and_copies(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(i, [0.0, 1.0]) for i in range(60, 70)] + [(99, [2.0, 2.0])]
    found = answers(neighbours.nearest(frame(spark, rows), F.col("id") % 5 == 0, k=7))
    assert found == {q: a for q, a in brute(rows, 7, 5).items()}


def test_rows_that_take_no_part(spark):
    bad = [(50, None), (51, []), (52, [0.0, 0.0]), (53, [None, 1.0]), (54, [float("nan"), 1.0]), (55, [float("inf"), 0.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0, 3.0])]
    found = answers(neighbours.nearest(frame(spark, good + bad + good[:2]), F.lit(True), k=20))
    wanted = {q: a for q, a in brute(good, 20).items() if a}
    assert found == wanted


def test_repeated_id_keeps_the_smallest_vector(spark):
    found = answers(neighbours.nearest(frame(spark, [(0, [1.0]), (1, [5.0]), (1, [2.0])]), F.col("id") == 0))
    assert found == {0: [(1, 2.0)]}


def test_empty_table_and_extra_columns(spark):
    assert neighbours.nearest(frame(spark, []), F.lit(True)).count() == 0
    df = frame(spark, [(0, [1.0]), (1, [2.0])]).withColumn("rank", F.lit("x")).withColumn("class", F.lit(1)).withColumn("id", F.lit(7))
    assert answers(neighbours.nearest(df, F.lit(True))) == {0: [(1, 2.0)], 1: [(0, 2.0)]}


@pytest.mark.parametrize("shard_rows", [50, 16_384])
def test_recall_where_lengths_differ(spark, shard_rows):
    random = np.random.default_rng(3)
    matrix = random.normal(size=(1500, 24)) * random.uniform(0.2, 3, (1500, 1))
    matrix[:400] = matrix[0] + random.normal(scale=0.01, size=(400, 24))  # a crowded bucket
    rows = [(i, v.tolist()) for i, v in enumerate(matrix)]
    found = answers(neighbours.nearest(frame(spark, rows), F.col("id") % 20 == 0, k=10, shard_rows=shard_rows))
    wanted = brute(rows, 10, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 10 * len(wanted)
    for q, pairs in found.items():
        assert len(pairs) == 10
        assert all(abs(score - float(matrix[q] @ matrix[i])) < 1e-9 for i, score in pairs)


@pytest.mark.parametrize("norms", ["one long vector", "lognormal"])
def test_recall_where_norms_are_skewed(spark, norms):
    random = np.random.default_rng(11)
    matrix = random.normal(size=(50_000, 64))
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    if norms == "lognormal":
        matrix *= random.lognormal(sigma=0.7, size=(len(matrix), 1))
    else:
        matrix[17] *= 50
    found = answers(neighbours.nearest(frame(spark, list(enumerate(matrix.tolist()))), F.col("id") % 1250 == 0))
    hits = 0
    for query in range(0, len(matrix), 1250):
        scores = matrix @ matrix[query]
        scores[query] = -np.inf
        hits += len(set(np.argsort(-scores)[:20].tolist()) & {i for i, _ in found[query]})
    assert hits >= 0.96 * 800


def test_norms_at_the_ends_of_doubles(spark):
    rows = [(i, [x, x]) for i, x in enumerate([1e-160, 3e-160, 1.0, 2.0, 1e150, 3e150])]
    found = answers(neighbours.nearest(frame(spark, rows), F.col("id") == 2, k=3))
    assert [i for i, _ in found[2]] == [5, 4, 3]


def test_probes_come_in_order_of_their_cost():
    hashes = neighbours.Hashes(4, 2, 3, 1.0, 5)
    vector = np.array([[0.3, -0.2, 0.9, 0.1]])
    places = hashes.places(vector)
    assert places.shape == (1, 2, 3)
    assert hashes.keys(np.floor(places).astype(np.int64)).shape == (1, 2)


def test_query_recall(spark, sf_dir):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = answers(queries.QUERIES["op3_nearest_neighbours"](spark, sf_dir))
    wanted = brute(rows, 20, 20)
    assert found.keys() == wanted.keys()
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in wanted[q]}) for q in wanted)
    assert hits >= 0.9 * 20 * len(wanted)


def test_no_call_gets_more_queries_than_a_part(spark, monkeypatch):
    """One outlier norm: all queries visit the sparse bands, in parts."""
    random = np.random.default_rng(5)
    vectors = random.normal(size=(400, 6))
    vectors[0] *= 50
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    wanted = answers(neighbours.nearest(frame(spark, rows), F.col("id") % 2 == 0, k=5))
    calls = spark.sparkContext.accumulator(0)

    def counted(most, inner=neighbours.compared):
        compare = inner(most)

        def call(left, right):
            assert right.num_rows <= 64, right.num_rows
            calls.add(1)
            return compare(left, right)

        return call

    monkeypatch.setattr(neighbours, "compared", counted)
    monkeypatch.setattr(neighbours._matched, "__defaults__", (64,))
    assert answers(neighbours.nearest(frame(spark, rows), F.col("id") % 2 == 0, k=5)) == wanted
