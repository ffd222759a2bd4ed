import math

import numpy as np
from pyspark.sql import functions as F

from voxlake.llm import top_k as T


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, norm int, bucket string")


def brute_force(rows, k, scale=256):
    whole = {i: [math.floor(scale * float(np.float32(x))) for x in v] for i, v in rows
             if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in whole:
        if q % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i)
                           for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


def check(spark, rows, k=5, **more):
    found = T.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k, **more).collect()
    assert len(found) == len(set(found))
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == brute_force(rows, k)


def test_ties_repeats_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 40)
    monkeypatch.setattr(T, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6) * (1 + i % 5)]) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(60)]  # one vector many times
    rows += [(1000, None), (1001, [None, 1.0]), (1050, [float("nan")] * 6), (1051, [float("inf")] * 6),
             (1100, [0.0] * 6), (1150, []), (1200, [1.0, 2.0]), (1201, [2.0, 1.0]), (None, [1.0] * 6)]
    check(spark, rows)


def test_high_thresholds_use_coordinates(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 30)
    used = []
    plain = T._candidates
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 8))
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=8) * 0.05]) for i in range(200)]
    check(spark, rows, 3)
    unit = centres / np.linalg.norm(centres, axis=1)[:, None]
    for row in unit:
        for threshold in (0.6, 0.9, 0.999):
            near = plain(row, unit, threshold)
            assert set(np.flatnonzero(unit @ row >= threshold)) <= set(near)
            used.append(len(near))
    assert min(used) < 4


def test_fewer_than_k_and_none(spark):
    check(spark, [(50, [1.0]), (51, [2.0]), (100, [-1.0])])
    check(spark, [(1, [1.0])])
    check(spark, [])


def test_products_beyond_doubles_stay_exact():
    big = np.array([[2.0 ** 40 + 1, 1.0]])
    assert T._products(big, big)[0, 0] == min((2 ** 40 + 1) ** 2 + 1, 2 ** 63 - 1)
    small = np.array([[2.0 ** 28 + 1, 3.0]])
    assert T._products(small, small)[0, 0] == (2 ** 28 + 1) ** 2 + 9


def test_only_wanted_blocks_are_dealt(spark):
    vectors = spark.createDataFrame([(i, i % 4, i % 3, 2) for i in range(120)],
                                    "id long, bucket int, block long, dim int")
    wanted = spark.createDataFrame([(2, 1, 0, 0), (2, 1, 0, 5), (2, 3, 2, 0), (9, 1, 1, 0)],
                                   "dim int, bucket int, block long, part long")
    dealt = [(r.bucket, r.block, r.part) for r in T._dealt(vectors, wanted).collect()]
    assert {x: dealt.count(x) for x in set(dealt)} == {(1, 0, 0): 10, (1, 0, 5): 10, (3, 2, 0): 10}


def test_of_a_repeated_query_id_the_smallest_vector_asks(spark):
    rows = [(50, [2.0, 0.0]), (50, [1.0, 9.0]), (50, [1.0, 5.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    found = T.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, 1).collect()
    assert [(r.query_id, r.vec_id, r.score) for r in found] == [(50, 2, 5 * 256 * 256)]
