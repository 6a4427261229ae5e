"""Near copies among vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from llm import near_vectors
from llm.near_vectors import Tile, near_copies, near_pairs
from llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def same(got, rows):
    return sorted(map(tuple, got), key=repr) == sorted(brute.cosine_links(rows), key=repr)


def as_floats(x):
    return np.asarray(x, dtype=np.float32).tolist()


def test_query(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert same(QUERIES["op13_near_vectors"](spark, small).collect(), rows)


@pytest.fixture(scope="module")
def clusters():
    """Near copies in groups of many sizes, around far and not so far centres, with a common direction."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24)) * np.linspace(2, 0.2, 24)
    rows = [c + rng.standard_normal((n, 24)) * s for c, n, s in zip(centres, [1, 2, 3, 5, 8, 13, 21, 300] * 5, rng.choice([0.02, 0.2, 0.35], 40))]
    rows = np.concatenate(rows) + 0.5
    return [(1000 - k, as_floats(x)) for k, x in enumerate(rows * rng.uniform(0.1, 9, (len(rows), 1)))]


@pytest.mark.parametrize(("tile", "least", "group"), [(512, 1024, 32 << 20), (16, 10, 32 << 20), (8, 100, 24 * 8 * 30)])
def test_groups_and_tiles_of_any_size(spark, clusters, monkeypatch, tile, least, group):
    monkeypatch.setattr(near_vectors, "TILE_ROWS", tile)
    monkeypatch.setattr(near_vectors, "LEAST_ROWS", least)
    monkeypatch.setattr(near_vectors, "GROUP_BYTES", group)
    monkeypatch.setattr(near_vectors, "FIRST_STEP", 4)
    got = near_copies(spark.createDataFrame(clusters, SCHEMA).repartition(5), sample_rows=200).collect()
    assert 20 < len({r.component_id for r in got}) < len(got)
    assert same(got, clusters)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    one = [1.0, 0.0, 0.0]
    rows = [
        (5, one), (5, one), (3, one), (7, [2.0, 0.0, 0.0]), (8, [1.0, 0.3, 0.0]), (9, [1.0, 0.8, 0.0]), (10, [-1.0, -0.0, 0.0]), (11, [-1.0, 0.0, 0.0]),
        (1, None), (2, []), (4, [0.0, 0.0, 0.0]), (6, [nan, 1.0, 0.0]), (12, [inf, 0.0, 0.0]), (13, [None, 1.0, 0.0]), (14, [1.0, 0.0]), (None, one),
        (15, [1e30, 1e30, 0.0]), (16, [1e-30, 1e-30, 0.0]), (0, [nan, 1.0, 0.0]),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    clash = docs.withColumns({c: F.lit(1) for c in ("row", "usable", "node", "copies", "low", "root", "links", "label", "component", "n_links", "tile_group")})
    got = near_copies(clash).collect()
    want = [(i, n, c, True if i is None else k) for i, n, c, k in brute.cosine_links(rows)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    doubles = docs.withColumn("embedding", F.col("embedding").cast("array<double>"))
    assert sorted(map(tuple, near_copies(doubles).collect()), key=repr) == sorted(want, key=repr)
    for none in (docs.limit(0), docs.where("vec_id = 1"), docs.where("vec_id IS NULL")):
        assert near_copies(none).count() == none.count()


def test_many_equal_vectors_are_compared_once(spark):
    docs = spark.range(30000).select(F.col("id").alias("vec_id"), F.array(*[F.lit(x).cast("float") for x in (1, 2, 3)]).alias("embedding"))
    got = near_copies(docs).groupBy("n_links", "component_id", "kept").count().collect()
    assert sorted(map(tuple, got)) == [(29999, 0, False, 29999), (29999, 0, True, 1)]


def test_a_tile_stops_when_no_pair_can_be_near():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.concatenate([x[:7] + 0.02 * rng.standard_normal((7, 64)), rng.standard_normal((200, 64))])
    y /= np.linalg.norm(y, axis=1)[:, None]
    sides = [Tile.of(0, v.astype(np.float32), v.astype(np.float32), np.ones(len(v), np.int64)) for v in (x, y)]
    rows, columns = near_pairs(*sides, 0.9)
    want = np.nonzero(x @ y.T >= 0.9)
    assert sorted(zip(rows.tolist(), columns.tolist())) == sorted(zip(want[0].tolist(), want[1].tolist()))
