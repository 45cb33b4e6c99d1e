import numpy as np
import pytest

from flightlake.llm import near


def brute_near(rows, cosine):
    fine = [v is not None and len(v) > 0 and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float) / np.abs(v).max()) / np.abs(v).max() if f else None for (_, v, _), f in zip(rows, fine)]
    label, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine:
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        r = root(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return sorted(((k, links[i], least[root(i)], k is not None and k == least[root(i)]) for i, (k, _, _) in enumerate(rows)), key=repr)


def vectors(seed=0, width=24):
    rng = np.random.default_rng(seed)
    f = lambda x: [float(np.float32(y)) for y in x]
    rows = [(i, f(rng.normal(size=width)), i % 3) for i in range(150)]
    for i in range(100, 190):  # near copies about the limit, chains of them, scaled ones
        base = np.array(rows[int(rng.integers(0, len(rows)))][1])
        rows.append((i + 100, f((base + rng.normal(size=width) * rng.choice([0.02, 0.1, 0.15, 0.2])) * rng.choice([1, 1e-20, 1e15])), i % 3))
    rows += [(500 + i, rows[i % 4][1], rows[i % 4][2]) for i in range(40)]
    rows += [(600, None, 1), (601, [0.0] * width, 1), (602, [float("nan")] * width, 1), (603, [None] * width, 1), (604, rows[0][1], None), (605, [], 1), (606, [float("inf")] + [1.0] * (width - 1), 1)]
    rows += [(None, rows[0][1], 0), (None, f(rng.normal(size=width)), 0), (700, rows[5][1], rows[5][2]), (700, rows[6][1], rows[6][2]), (701, [1.0, 2.0], 0), (702, [2.0, 4.0], 0), (703, [-0.0, 1.0], 0), (704, [0.0, 1.0], 0)]
    rows += [(800 + i, f(np.ones(width) + rng.normal(size=width) * 0.1), 2) for i in range(60)]
    return rows


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(k, v, lab, 1, 2, b"x") for k, v, lab in rows], f"vec_id long, embedding array<{kind}>, label int, node int, width int, v binary")


@pytest.mark.parametrize(("cosine", "block", "cell", "tile", "kind"), [(0.98, 8, 512, 1024, "float"), (0.98, 4, 2, 8, "float"), (0.9, 8, 1, 5, "double"), (0.99, 7, 4, 3, "float"), (0.5, 8, 1, 16, "float")])
def test_against_brute_force(spark, rows, monkeypatch, cosine, block, cell, tile, kind):
    monkeypatch.setattr(near, "TILE", tile)
    monkeypatch.setattr(near, "PAIRS", 64)
    data = vectors()
    got = near.near_duplicates(frame(spark, data, kind).repartition(3), near.Join(cosine, block, cell))
    assert rows(got) == brute_near(data, cosine)


def test_empty_and_unusable(spark):
    assert near.near_duplicates(frame(spark, [])).collect() == []
    got = near.near_duplicates(frame(spark, [(1, None, 1), (2, [1.0], None), (None, [0.0], 3)]))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False)]


def test_every_pair_in_reach_meets_once():
    rng = np.random.default_rng(1)
    points = np.rint(rng.uniform(-300, 300, (200, 3)))
    met = {}
    for rows, cell, visits in near.cells_of(points, 50.0):
        for r, c in zip(rows.tolist(), cell.astype(int).tolist()):
            met.setdefault(tuple(c), ([], []))[visits].append(r)
    pairs = [tuple(sorted(p)) for home, guests in met.values() for p in [*((a, b) for i, a in enumerate(home) for b in home[:i]), *((a, b) for a in home for b in guests)]]
    near_ones = {(a, b) for a in range(200) for b in range(a + 1, 200) if ((points[a] - points[b]) ** 2).sum() <= 2500}
    assert near_ones and near_ones <= set(pairs)
    assert len(set(pairs)) == len(pairs)


def test_rotation_keeps_distances():
    x = near.units(np.random.default_rng(2).normal(size=(50, 30)))
    turned = near.rotated(x) / near.STEPS
    assert np.abs(turned @ turned.T - x @ x.T).max() < 1e-5
