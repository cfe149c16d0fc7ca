"""Top-k search: reading of lists, bounds, ties, ranges, against plain products."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm import topk
from rivulet.llm.topk import Lists, exact_scores, nra, top_k


def listed(values, ids=None):
    values = np.array(values)
    return Lists(values, np.arange(len(values)) if ids is None else np.array(ids), Lists.sort(values))


def read(shard, query, query_id, k, bar=-np.inf):
    _, ids, scores, part = next(nra(shard, np.array([query]), np.array([query_id]), k, np.array([bar])))
    return ids, scores, part


def plain(values, ids, query, query_id, k):
    scored = sorted((-int(v.astype(object) @ query.astype(object)), int(i)) for v, i in zip(values, ids) if i != query_id)
    return [(i, -s) for s, i in scored[:k]]


@pytest.mark.parametrize("size, spread", [(1, 3), (4, 100), (24, 5)])
def test_reading_finds_the_best_with_ties(size, spread):
    rng = np.random.default_rng(size)
    for n in (1, 3, 50, 600):
        values, ids = rng.integers(-spread, spread + 1, (n, size)), rng.permutation(n)
        for at in range(min(n, 12)):
            query = values[at] if at % 3 else np.zeros(size, np.int64)
            found, scores, part = read(listed(values, ids), query, int(ids[at]), 5)
            assert list(zip(found.tolist(), scores.tolist())) == plain(values, ids, query, ids[at], 5)
            assert 0 <= part <= 1


def test_reading_stops_before_the_end_of_the_lists():
    rng = np.random.default_rng(2)
    values = (rng.standard_normal((4000, 3)) * 256).astype(np.int64)
    values[7] = [2000, 1900, 1800]
    depths = [read(listed(values), np.array([5, 4, 3]), -1, 1)[2], read(listed(values), np.array([5, -4, 0]), -1, 5)[2]]
    assert max(depths) < 0.5
    # A bar from earlier shards stops it earlier still, and keeps what equals it.
    query, shard = values[11], listed(values)
    ids, scores, part = read(shard, query, 11, 5)
    again, same, sooner = read(shard, query, 11, 5, float(scores[0]))
    assert again[0] == ids[0] and same[0] == scores[0] and sooner <= part


def test_scores_are_exact_or_an_error():
    big = np.array([[134_217_729, 0], [134_217_728, 1]])
    assert exact_scores(big, big[0]).tolist() == [134_217_729**2, 134_217_729 * 134_217_728]
    ids, scores, _ = read(listed(big), big[0], -1, 2)
    assert (ids.tolist(), scores.tolist()) == ([0, 1], [134_217_729**2, 134_217_729 * 134_217_728])
    with pytest.raises(OverflowError):
        exact_scores(np.array([[2**40]]), np.array([2**40]))


def test_top_k_over_shards_lanes_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    rng = np.random.default_rng(1)
    vectors = [(i, rng.normal(size=8).round(2).tolist()) for i in range(160)]
    vectors += [(50, vectors[50][1]), (50, vectors[3][1]), (100, [0.0] * 8), (150, [1.0, 2.0]), (151, [3.0, 4.0])]  # repeated, and of its own length
    vectors += [(200, None), (201, [1.0, None] * 4), (202, [float("nan")] * 8), (None, [1.0] * 8), (250, [])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumns({"score": F.lit("x"), "query": F.lit(1), "part": F.lit(0)})
    found = defaultdict(list)
    for r in top_k(df.repartition(3), df.filter("vec_id % 50 = 0"), 5).collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    whole = [(i, np.array([int(np.floor(256 * float(np.float32(x)))) for x in v])) for i, v in vectors[:165]]
    for query_id in (0, 50, 100, 150):
        expected = []
        for own in {tuple(v.tolist()) for i, v in whole if i == query_id}:
            rows = [(i, v) for i, v in whole if len(v) == len(own)]
            best = plain([v for _, v in rows], [i for i, _ in rows], np.array(own), query_id, 5)
            expected += [(rank, i, s) for rank, (i, s) in enumerate(best, 1)]
        assert sorted(found.pop(query_id)) == sorted(expected)
    assert not found
    assert top_k(df.limit(0), df.limit(0), 5).count() == 0
    parts = [r.depth for r in top_k(df, df.filter("vec_id % 50 = 0"), 5, with_depth=True).select("depth").collect()]
    assert all(0 <= p <= 1 for p in parts)


def test_components_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e30]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        top_k(df, df, 1).collect()
