import numpy as np

from hrflow.llm.embed_dedup import ForestBounds, near_duplicates


def brute(vectors, threshold):
    ids = list(vectors)
    parent, links = {i: i for i in ids}, {i: 0 for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            x, y = vectors[i], vectors[j]
            if x is None or y is None or len(x) != len(y):
                continue
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], find(i)) for i in ids}


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, codes string")


def clusters(rng, n, dim=16):
    out = {}
    while len(out) < n:
        c = rng.normal(size=dim)
        for _ in range(rng.integers(1, 9)):
            out[len(out)] = (c + 0.08 * rng.normal(size=dim)).astype(np.float32).astype(float)
    return out


def test_links_equal_brute_force(spark):
    vectors = clusters(np.random.default_rng(1), 700)
    rows = [(i, v.tolist(), 0, "x") for i, v in vectors.items()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(
        table(spark, rows), 0.95, ForestBounds(leaf=64, block=50)).collect()}
    want = brute(vectors, 0.95)
    found, there = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)   # none below the threshold, none twice
    assert found >= 0.97 * there


def test_a_large_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    vectors = {i: base.copy() for i in range(300)}
    vectors |= {300 + i: base + 0.01 * rng.normal(size=8) for i in range(300)}
    vectors = {i: v.astype(np.float32).astype(float) for i, v in vectors.items()}
    got = near_duplicates(table(spark, [(i, v.tolist(), 0, "x") for i, v in vectors.items()]), 0.95,
                          ForestBounds(leaf=32, block=40)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(599, 0)}
    assert sum(r.kept for r in got) == 1


def test_unusable_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]),
            (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (10, [1.0, 2.0]), (10, [1.0, 2.0]), (None, [1.0, 2.0]), (11, [0.0, 0.0])]
    got = near_duplicates(table(spark, [(i, v, 0, "x") for i, v in rows])).collect()
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert len(got) == len(rows)
    for i in (1, 2, 3, 4, 5, 6, 9, 11):
        assert by[i] == (0, i, True)
    assert by[7][:2] == by[8][:2][:0] + by[7][:2] and by[8][1] == by[10][1] == 7 and not by[8][2]


def test_empty_table(spark):
    assert near_duplicates(table(spark, [])).count() == 0


def test_repeated_ids_lose_no_link(spark):
    x, y = [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    near = lambda v: [v[0], 0.1, v[2], 0.0]
    rows = [(1, x, 0, ""), (1, y, 0, ""), (2, near(x), 0, ""), (3, near(y), 0, ""), (4, [0.0, 0.0, 0.0, 1.0], 0, "")]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(table(spark, rows), 0.95).collect()), key=str)
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)], key=str)
