"""Centroid clustering against plain k-means over whole numbers."""

import hashlib
import itertools
import math
import random

import duckdb
import numpy as np
import pytest

from tidemark.llm import centroids as M
from tidemark.llm.graph import Steps
from tidemark.llm.queries import ORACLES
from tidemark.llm.shipping import ship

SMALL = M.Shape(id="vec_id", vector="embedding", dims=3)
SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def blobs(n=400, dims=3, seed=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-9, 9) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, .4))) for x in rng.choice(centres)], 1, "x") for i in range(n)]
    bad = [None, [], [1.0] * (dims - 1), [1.0] * (dims + 1), [None] + [1.0] * (dims - 1),
           [math.nan] * dims, [math.inf] + [0.0] * (dims - 1), [-math.inf] * dims]
    rows += [(n + i, v, 1, "x") for i, v in enumerate(bad)]
    rows += [(None, [0.5] * dims, 2, "y"), rows[3], rows[3]] + [(3, [-0.5] * dims, 2, "z")]
    return rows + [(1000 + i, [2.0] * dims, 2, "y") for i in range(300)]


def brute(rows, k, rounds, seed, dims):
    kept = [(i, tuple(math.floor(256 * x) for x in v), v) for i, v, *_ in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                        r[2]))
    centres = [r[1] for r in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v, _ in kept]
    for _ in range(rounds):
        best = assign()
        for j in range(len(centres)):
            mine = [v for (_, v, _), (_, c) in zip(kept, best) if c == j]
            if mine:
                centres[j] = tuple(sum(x) // len(mine) for x in zip(*mine))
    best = assign()
    inertia = sum(d for d, _ in best)
    sums = {j: sum(d for d, c in best if c == j) for j in range(len(centres))}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, sums[j], inertia, names[j]) for (i, _, _), (d, j) in zip(kept, best)]


@pytest.mark.parametrize("bits, dims", [(1, 2), (2, 2), (3, 2), (2, 3), (1, 5), (2, 4)])
def test_hilbert_neighbours(bits, dims):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = M.hilbert_keys(cells, bits)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_candidates_lose_no_nearest():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(200):
        x = rng.integers(-50, 50, 4) + rng.integers(-8, 8, (20, 4))
        c = rng.integers(-60, 60, (12, 4))
        chosen = M.candidates(x.min(0), x.max(0), c)
        distances = ((x[:, None] - c) ** 2).sum(2)
        best, found = M.nearest(x, c[chosen])
        assert (chosen[best] == distances.argmin(1)).all() and (found == distances.min(1)).all()
        pruned += 12 - len(chosen)
    assert pruned > 400


def test_nearest_is_exact_for_large_numbers():
    x = np.array([[M.BOUND, -M.BOUND + 1, 3]])
    c = np.array([[M.BOUND, -M.BOUND, 3], [-M.BOUND, M.BOUND, 3]])
    best, distance = M.nearest(x, c)
    assert (best[0], distance[0]) == (0, 1)
    assert M.nearest(x, c[1:])[1][0] == (2 * M.BOUND) ** 2 + (2 * M.BOUND - 1) ** 2


@pytest.mark.parametrize("block, k", [(128, 7), (16, 40), (64, 2000)])
def test_clusters(spark, monkeypatch, block, k):
    ship(spark)
    monkeypatch.setattr(M, "BLOCK", block)
    rows = blobs()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = [tuple(r) for r in M.clusters(frame, k, 5, 2, SMALL).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows, k, 5, 2, 3), key=repr)


def test_boxes_prune_on_blobs(spark):
    ship(spark)
    vectors = M.whole_vectors(spark.createDataFrame(blobs(), SCHEMA), SMALL)
    blocks = M.zone_blocks(Steps(spark, "test"), vectors, SMALL)
    assert M.pruned_share(blocks, M.fit(blocks, M.seeds(vectors, 6, 2, SMALL), 5)) > 0.3


def test_query_equals_sql(spark, sf_dir):
    ship(spark)
    rows = [r[:2] for r in blobs(60, 64)]
    found = M.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        con.execute(ORACLES["op13_centroids"]).fetchall(), key=repr)


def test_text_ids_and_huge_components(spark):
    ship(spark)
    frame = spark.createDataFrame([("a", [3e38, 0.0, 0.0]), ("b", [-3e38, 0.0, 1.0])],
                                  "vec_id string, embedding array<double>")
    found = M.clusters(frame, 1, 1, 2, SMALL).collect()
    assert {r["vec_id"] for r in found} == {"a", "b"} and all(r["distance"] >= M.BOUND ** 2 for r in found)


def test_no_vectors(spark):
    ship(spark)
    for rows in ([], [(1, None), (2, [])]):
        frame = M.clusters(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert frame.collect() == [] and frame.columns[:3] == ["vec_id", "cluster", "distance"]
