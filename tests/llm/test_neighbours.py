import numpy as np
import pytest
from pyspark.sql import functions as F

from loquela.llm import neighbours as nb


def brute(rows, k, least, dim):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v is not None and len(v) == dim and None not in v]
    ok = sorted(((i, v) for i, v in ok if np.isfinite(v).all() and v.any()), key=lambda x: x[0])
    out = set()
    for i, v in ok:
        sims = sorted((-round(float(v @ w / np.linalg.norm(v) / np.linalg.norm(w)), 9), j) for j, w in ok if j != i)
        out |= {(min(i, j), max(i, j)) for s, j in sims[:k] if -s >= least}
    return out


def test_against_brute_force(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((40, 16))
    rows = [(i, (centres[i % 40] + 0.4 * rng.standard_normal(16)).tolist()) for i in range(600)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(12)] + [(2000 + i, rows[50][1]) for i in range(2)]
    rows += [(3000, None), (3001, [1.0] * 15), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [1.0] * 15 + [None]), (3005, [float("inf")] * 16)]
    df = spark.createDataFrame(rows, "voice long, c array<float>").withColumn("id", F.lit("x")).withColumn("vec", F.lit(1))
    got = {tuple(r) for r in nb.pairs(nb.nearest_vectors(df, "voice", "c", 16)).collect()}
    want = brute(rows, 5, 0.7, 16)
    assert len(got & want) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(got)
    copies = {1000 + i for i in range(12)} | {3}
    assert {p for p in got if set(p) <= copies} == {p for p in want if set(p) <= copies}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small(spark, n):
    rows = [(i, [1.0, float(i)]) for i in range(n)]
    df = spark.createDataFrame(rows, "voice long, c array<float>")
    assert nb.pairs(nb.nearest_vectors(df, "voice", "c", 2)).count() == (1 if n == 2 else 0)


def test_tree():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 8)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = nb.KMeansTree(x, branching=8, leaf_size=20)
    again = nb.KMeansTree.load(tree.dump())
    assert tree.visit(x[:20], 9) == again.visit(x[:20], 9)
    assert all(len(set(v)) == 9 for v in tree.visit(x[:20], 9))
    assert nb.KMeansTree(np.ones((100, 4), np.float32)).leaves == 1


def test_calibration_widens_until_met():
    x = np.random.default_rng(3).standard_normal((1200, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = nb.KMeansTree(x[200:].astype(np.float32), branching=256, leaf_size=4)
    sims = x[:200] @ x.T
    sims[np.arange(200), np.arange(200)] = -2
    pairs = [(q, int(b)) for q in range(200) for b in np.argsort(-sims[q])[:5]]
    n = tree.calibrate(pairs, x)
    visits = tree.visit(x, n)
    assert n > 32 and sum(visits[b][0] in visits[q] or visits[q][0] in visits[b] for q, b in pairs) >= nb.TARGET_RECALL * len(pairs)
    assert tree.calibrate([], x) == 1


def test_calibration_is_against_the_whole_table_and_not_fitted(spark, monkeypatch):
    seen, fit, calibrated = {}, nb.KMeansTree.__init__, nb.calibrated
    monkeypatch.setattr(nb.KMeansTree, "__init__", lambda self, x, *a, **k: (seen.update(fit=x), fit(self, x, *a, **k))[1])
    monkeypatch.setattr(nb, "calibrated", lambda tree, groups, queries, *a: (seen.update(asked=queries), calibrated(tree, groups, queries, *a))[1])
    rows = [(i, np.random.default_rng(i).standard_normal(8).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "voice long, c array<float>")
    nb.nearest_vectors(df, "voice", "c", 8)
    assert len(seen["asked"]) and not {tuple(r) for r in seen["asked"].astype(np.float32)} & {tuple(r) for r in seen["fit"]}
    groups = nb.usable_vectors(df, "voice", "c", 8).select(F.col("id").alias("uid"), "vec")
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sims = x[:3] @ x.T
    sims[np.arange(3), np.arange(3)] = -2
    got = {}
    for uid, other in zip(*(nb.exact_nearest(groups.repartition(3), x[:3], np.arange(3), 4, -1.0).column(c).to_pylist() for c in ("uid", "other"))):
        got.setdefault(uid, set()).add(other)
    assert got == {q: set(np.argsort(-sims[q])[:4].tolist()) for q in range(3)}


def test_leaves_grow_with_the_table_and_only_opened_nodes_are_scored():
    x = np.random.default_rng(5).standard_normal((8000, 16)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    few, many = (nb.KMeansTree(x[:n], leaf_size=32) for n in (1000, 8000))
    assert many.leaves > 4 * few.leaves
    own = [v[0] for v in many.visit(x, 1)]
    assert np.bincount(own).max() < 400
    scored = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            scored.append(len(key) if isinstance(key, list) else 1)
            return np.asarray(super().__getitem__(key))

    many.centres = many.centres.view(Watched)
    many.visit(x[:1], 3)
    assert sum(scored) < len(many.leaf) / 2


def test_vectors_share_few_leaves_under_several_branches():
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((3000, 32))
    x = np.concatenate([centres + 0.45 * rng.standard_normal(centres.shape) for _ in range(4)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = nb.KMeansTree(x[rng.permutation(len(x))].astype(np.float32), branching=32, leaf_size=10)
    pairs, asked = [(i, 300 + i) for i in range(300)], np.concatenate([x[:300], x[3000:3300]])
    before = tree.calibrate(pairs, asked)
    tree.even(x[6000:6300])
    assert tree.lift.any() and not tree.lift[tree.leaf >= 0].any()
    n = tree.calibrate(pairs, asked, shared=True)
    visits = nb.KMeansTree.load(tree.dump()).visit(asked, n)
    assert sum(bool(set(visits[q]) & set(visits[b])) for q, b in pairs) >= nb.TARGET_RECALL * len(pairs)
    assert n <= before / 3  # so a vector goes to fewer leaves than when one of the two had to reach the first leaf of the other


def test_passes_bound_the_disk_and_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((60, 16))
    rows = [(i, (centres[i % 60] + 0.4 * rng.standard_normal(16)).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "voice long, c array<float>")
    found = lambda: {tuple(r) for r in nb.nearest_vectors(df, "voice", "c", 16, leaves=2).collect()}
    whole, swept = found(), []
    monkeypatch.setattr(nb, "PASS_BYTES", 1)
    monkeypatch.setattr(nb, "sweep", lambda spark: swept.append(1))
    assert nb.passes(900, 16, 2) == 4 and found() == whole and len(whole) > 3000 and len(swept) >= 4
    monkeypatch.undo()
    assert nb.passes(60_000, 128, 5) == 1
    # A table of 6.2 GB: no pass holds more than the vectors do.
    n = nb.passes(8_600_000, 128, 40)
    assert 8_600_000 * 40 * (2 * 128 + nb.ROW_BYTES) / n <= 8_600_000 * 2 * 128
