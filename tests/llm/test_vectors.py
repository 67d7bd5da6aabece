"""Near-duplicate vectors and clusters against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millwatch.llm import orchard, vector_dedup
from millwatch.llm.vector_dedup import near_vectors

LAYOUT = "vec_id bigint, embedding array<float>, label int"


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame(
        [(i, v, 0) for i, v in rows], LAYOUT.replace("float", kind)
    )


def close_pairs(n: int, size: int, cosine: float, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    a, b = draw.normal(size=(2, n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return np.concatenate((a, cosine * a + math.sqrt(1 - cosine * cosine) * b))


def brute_links(values: list, least: float = 0.9) -> dict[int, set[int]]:
    links = {k: set() for k in range(len(values))}
    for i, a in enumerate(values):
        for j, b in enumerate(values):
            if i != j and a is not None and b is not None and len(a) == len(b):
                x, y = np.array(a, float), np.array(b, float)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                    x, y = x / np.abs(x).max(), y / np.abs(y).max()
                    if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                        links[i].add(j)
    return links


def brute_rows(ids: list, values: list) -> list[tuple]:
    links, out = brute_links(values), []
    for k, own in enumerate(ids):
        seen, todo = {k}, [k]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        least = min((ids[s] for s in seen if ids[s] is not None), default=None)
        out.append((own, len(links[k]), least, own == least))
    return sorted(out, key=repr)


def test_hadamard_transform_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 16))
    turned = vector_dedup.transformed(x)
    assert np.allclose(np.linalg.norm(turned, axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(vector_dedup.transformed(turned), x)


def test_own_bucket_is_the_nearest_axis():
    one = vector_dedup.Hashing(8, 1, 1, 4)
    x = np.random.default_rng(2).normal(size=(50, 8))
    turned = x
    for signs in one.signs(0)[0]:
        turned = vector_dedup.transformed(turned * signs)
    ends = np.concatenate((turned, -turned), axis=1)
    codes = one.codes(x, 0)
    assert (codes[:, 0] == ends.argmax(axis=1)).all()
    assert (np.sort(codes, axis=1) == np.sort(np.argsort(-ends, axis=1)[:, :4], axis=1)).all()


@pytest.mark.parametrize("functions", [1, 2, 3])
def test_tables_are_enough_for_pairs_at_the_least_cosine(functions):
    count = round(vector_dedup.PER_BUCKET * (128**functions) * 0.9)
    use = vector_dedup.fitted(64, count, 0.9)
    assert use.functions == functions
    both = close_pairs(2000, 64, 0.9001, 5)
    a, b = use.all_codes(both[:2000]), use.all_codes(both[2000:])
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3))
    assert met.mean() > 0.985
    words = use.sketches(both)
    apart = np.bitwise_count(words[:2000] ^ words[2000:]).sum(axis=1)
    assert (apart <= vector_dedup.most_bits_apart(0.9)).all()


def test_pairs_near_the_limit_are_found(spark):
    """Recall over pairs just above the limit is 0.9 at least, and nothing below it is linked."""
    n = 800
    above, below = close_pairs(n, 64, 0.902, 6), close_pairs(n, 64, 0.898, 7)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate((above, below)))]
    found = {r["vec_id"]: r for r in near_vectors(vectors(spark, rows, "double")).collect()}
    linked = sum(found[k]["n_links"] == 1 and found[k + n]["component_id"] == k for k in range(n))
    assert linked / n > 0.97
    assert all(found[k]["n_links"] == 0 for k in range(2 * n, 4 * n))


def test_near_vectors_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 64))
    near = [centres[k % 12] + draw.normal(size=64) * 0.22 for k in range(150)]  # chains about the limit
    values = [v.astype(np.float32).tolist() for v in (*near, *draw.normal(size=(60, 64)))]
    values += values[:20] + [values[0]] * 30
    ids = [7 * k % 997 for k in range(len(values))]
    found = near_vectors(vectors(spark, zip(ids, values, strict=True)), recall=0.999999)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_rows(ids, values)


def test_hard_vectors(spark):
    nan, inf = float("nan"), float("inf")
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.1]
    rows = [
        (1, a), (2, b), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [1.0, None, 3.0]), (7, [1.0, nan, 3.0]),
        (8, [inf, 2.0, 3.0]), (9, [1.0, 2.0]), (10, [-1.0, -2.0, -3.0]), (None, a), (None, None), (2, b), (11, [5.0]),
        (12, [0.5]), (13, [1e300, 2e300, 3e300]), (14, [1e-310, 2e-310, 3e-310]), (None, [9.0] * 7), (None, [9.0] * 7),
        (15, [0.0, -0.0, 1.0]), (16, [-0.0, 0.0, 1.0]),
    ]
    frame = vectors(spark, rows, "double").withColumns(
        {c: F.lit("x") for c in ("payload", "node", "n", "links", "digest", "kept", "code")}
    )
    found = sorted((tuple(r) for r in near_vectors(frame).collect()), key=repr)
    expected = brute_rows([i for i, _ in rows], [None if v and None in v else v for _, v in rows])
    assert found == expected
    assert (None, 1, None, True) in found


def test_no_vectors(spark):
    none = spark.createDataFrame([], LAYOUT)
    assert near_vectors(none).collect() == []
    assert near_vectors(none).columns == ["vec_id", "n_links", "component_id", "kept"]
    assert orchard.cluster(none).collect() == []
    useless = vectors(spark, [(1, None), (2, [1.0])])
    assert {tuple(r) for r in near_vectors(useless).collect()} == {(1, 0, 1, True), (2, 0, 2, True)}
    assert orchard.cluster(useless).collect() == []


def test_cut_buckets_count_each_link_once(spark, monkeypatch):
    draw = np.random.default_rng(4)
    values = (draw.normal(size=64) + draw.normal(size=(120, 64)) * 0.33).tolist()
    frame = vectors(spark, enumerate(values), "double")
    whole = sorted((tuple(r) for r in near_vectors(frame, recall=0.999999).collect()), key=repr)
    monkeypatch.setattr(vector_dedup.likely, "__defaults__", (10,))
    monkeypatch.setattr(vector_dedup.linked, "__defaults__", (7,))
    cut = near_vectors(frame, recall=0.999999).collect()
    assert sorted((tuple(r) for r in cut), key=repr) == whole
    assert whole == brute_rows(list(range(120)), values)


def plain_clusters(rows, k=8, rounds=10, size=64, scale=1024):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)
    ]
    def name(row):
        return hashlib.sha256(f"3:{'' if row[0] is None else row[0]}".encode()).hexdigest(), row[1]

    def far(p, c):
        return sum((x - y) ** 2 for x, y in zip(p, c, strict=True))

    centres = [v for _, v in sorted(kept, key=name)[:k]]
    for _ in range(rounds):
        at = [min(range(len(centres)), key=lambda c, v=v: (far(v, centres[c]), c)) for _, v in kept]
        for c in range(len(centres)):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == c]
            if mine:
                centres[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    out = []
    for i, v in kept:
        c = min(range(len(centres)), key=lambda c: (far(v, centres[c]), c))
        out.append((i, c, far(v, centres[c])))
    each = {c: sum(d for _, a, d in out if a == c) for c in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, each[c], sum(each.values()), digest[c]) for i, c, d in out), key=repr)


def test_clusters_equal_brute_force(spark):
    draw = np.random.default_rng(8)
    values = (draw.normal(size=(10, 64))[draw.integers(0, 10, 300)] + draw.normal(size=(300, 64)) * 0.4).tolist()
    rows = [(int(i), v) for i, v in enumerate(values)]
    rows += [(5, values[5]), (None, values[6]), (None, values[6]), (400, None), (401, values[0][:63]), (402, []),
             (403, [None, *values[0][1:]]), (404, [float("nan"), *values[0][1:]]), (405, [0.0] * 64)]
    frame = vectors(spark, rows, "double").withColumns({c: F.lit(1) for c in ("point", "cluster", "distance")})
    found = sorted((tuple(r) for r in orchard.cluster(frame).collect()), key=repr)
    assert found == plain_clusters(rows)


def test_few_vectors_and_ties(spark):
    rows = [(1, [0.0] * 64), (2, [0.0] * 64), (3, [1.0] * 64)]
    assert sorted(tuple(r) for r in orchard.cluster(vectors(spark, rows)).collect()) == plain_clusters(rows)


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="64 bits"):
        orchard.cluster(vectors(spark, [(1, [1e30] * 64)], "double")).collect()


def test_orchard_search_is_exact_and_skips():
    draw = np.random.default_rng(9)
    centres = draw.integers(-50, 50, size=(40, 6))
    centres[7] = centres[3]  # a tie everywhere
    points = np.concatenate((centres, centres[draw.integers(0, 40, 500)] + draw.integers(-6, 7, size=(500, 6))))
    at, far, computed = orchard.nearest(points, centres)
    all_ = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    assert (at == all_.argmin(axis=1)).all() and (far == all_.min(axis=1)).all()
    assert computed < all_.size
