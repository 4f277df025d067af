"""Top-k scoring: the in-block top-k equals a full stable sort, and streamed, skipped blocks leave lists exact."""

import numpy as np
import pytest


def test_local_topk_matches_full_sort():
    from rankfold.operators.scoring import _local_topk
    rng = np.random.default_rng(0)
    for _ in range(300):
        nr, nc, k = rng.integers(1, 30), rng.integers(1, 40), rng.integers(1, 12)
        est = rng.integers(0, 4, (nr, nc)).astype(float)
        est[rng.random((nr, nc)) < 0.3] = -np.inf
        got = list(zip(*_local_topk(est, k)))
        want = []
        for r in range(nr):
            for j in np.argsort(-est[r], kind="stable")[:min(k, nc)]:
                if np.isfinite(est[r, j]):
                    want.append((r, j, est[r, j]))
        assert got == want


@pytest.mark.parametrize("kind,mu,divisor", [("dot", 0.0, 1.0), ("biased", 0.0, 1.0), ("svd", 3.0, 10.0)])
def test_score_many_by_force(spark, kind, mu, divisor):
    """Two models, several user and item blocks, ties, clipping, seen pairs: the lists of a full sort."""
    from rankfold.operators.factors import FactorModel
    from rankfold.operators.scoring import score_many
    rng = np.random.default_rng(1)
    schema = "id long, bias double, features array<double>"

    def side(n, first, scale):
        return [(first + i, float(rng.integers(-2, 3)), [float(x) for x in rng.integers(-3, 4, 3) * scale[i]]) for i in range(n)]
    users, items = side(50, 0, np.ones(50)), side(200, 1000, np.repeat([1, 2, 5, 0], 50))
    seen = {(int(u), int(1000 + i)) for u in range(50) for i in range(200) if rng.random() < 0.2}
    uf = spark.createDataFrame(users, schema)
    models = {"a": FactorModel(kind, uf, spark.createDataFrame(items, schema), mu, divisor),
              "b": FactorModel(kind, uf, spark.createDataFrame(items[:40], schema), mu, divisor)}
    asked = spark.createDataFrame([(u,) for u in range(0, 60, 2)], "u long")
    lists = {}
    for r in score_many(models, asked, 7, spark.createDataFrame(sorted(seen), "u long, i long"),
                        max_block_items=23, max_block_users=20, chunk=8).collect():
        lists.setdefault((r["model"], r["u"]), []).append((r["rank"], r["i"], r["score"]))
    for tag, own in (("a", items), ("b", items[:40])):
        for u, bu, p in users[::2]:
            scored = []
            for i, bi, q in own:
                x = sum(a * b for a, b in zip(p, q)) + (bu + bi if kind != "dot" else 0.0)
                x = mu + x / divisor
                if (u, i) not in seen:
                    scored.append((-(min(5.0, max(1.0, x)) if kind == "svd" else x), i))
            want = [(n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:7])]
            got = sorted(lists[tag, u])
            assert [x[:2] for x in got] == [x[:2] for x in want]
            assert np.allclose([x[2] for x in got], [x[2] for x in want])
    assert len(lists) == 50


def test_blocks_out_of_reach_are_not_read(spark, tmp_path):
    """Once a user holds k items, blocks whose bound is below the k-th score are never opened."""
    import pyarrow as pa
    from rankfold.operators.scoring import _scorer
    from rankfold.sources.blockfiles import save_block
    folder = str(tmp_path)
    save_block(folder, "long", ids=np.arange(3), m=np.array([[9.0], [8.0], [7.0]]), b=np.zeros(3))
    run = _scorer(folder, {"": [("long", 9.0, 0.0), ("missing", 1.0, 0.0)]}, {"": ("dot", 0.0, 1.0, None)}, 2, 8)
    table = pa.table({"id": [5], "bias": [0.0], "features": pa.array([[1.0]], pa.list_(pa.float64()))})
    out = run((pa.scalar(""), pa.scalar(0)), table).to_pydict()
    assert out["i"] == [0, 1] and out["score"] == [9.0, 8.0] and out["rank"] == [1, 2]


def test_clipped_ties_of_larger_ids_are_not_read(spark, tmp_path):
    """A user whose list is full at the upper clip opens no block whose ids all lose the tie."""
    import pyarrow as pa
    from rankfold.operators.scoring import _scorer
    from rankfold.sources.blockfiles import save_block
    folder = str(tmp_path)
    save_block(folder, "long", ids=np.arange(3), m=np.array([[900.0], [800.0], [700.0]]), b=np.zeros(3))
    blocks = {"": [("long", 900.0, 0.0, 0), ("missing", 600.0, 0.0, 3)]}
    run = _scorer(folder, blocks, {"": ("svd", 3.0, 100.0, (1.0, 5.0))}, 2, 8)
    table = pa.table({"id": [5], "bias": [0.0], "features": pa.array([[1.0]], pa.list_(pa.float64()))})
    out = run((pa.scalar(""), pa.scalar(0)), table).to_pydict()
    assert out["i"] == [0, 1] and out["score"] == [5.0, 5.0] and out["rank"] == [1, 2]


@pytest.mark.parametrize("kind,mu,divisor,whole", [("dot", 0.0, 1.0, False), ("biased", 0.5, 2.0, False), ("dot", 0.0, 1.0, True),
                                                   ("svd", 3.0, 20.0, True), ("svd", 3.0, 2.0, False), ("svd", -40.0, 1.0, True)])
def test_leaves_and_single_precision_leave_lists_exact(tmp_path, monkeypatch, kind, mu, divisor, whole):
    """Several blocks and leaves, whole and broken components, ties at both clips, seen pairs: the lists of a full sort."""
    import pyarrow as pa
    from rankfold.operators import scoring
    from rankfold.operators.factors import CLIP
    from rankfold.sources.blockfiles import save_block
    monkeypatch.setattr(scoring, "LEAF_ITEMS", 16)
    monkeypatch.setattr(scoring, "FIRST_ITEMS", 40)
    folder, rng = str(tmp_path), np.random.default_rng(3)
    n, users, k, dims = 900, 60, 6, 4
    draw = (lambda *s: rng.integers(-4, 5, s).astype(float)) if whole else (lambda *s: rng.normal(size=s) * 3)
    m, b, P, bu = draw(n, dims), draw(n), draw(users, dims), draw(users)
    P[0], b0 = 0.0, 0.0 if kind == "dot" else 1.0
    m[5:9] = m[4]                                              # equal items: ties by id
    ids = rng.permutation(np.arange(5_000, 5_000 + n))
    order = np.argsort(-np.linalg.norm(m, axis=1), kind="stable")
    blocks = []
    for c, part in enumerate(np.array_split(order, 4)):
        part = part[scoring._near_order(m[part], 16)]
        save_block(folder, f"items-{c}", ids=ids[part], m=m[part], b=b[part])
        blocks.append((f"items-{c}", float(np.linalg.norm(m[part], axis=1).max()), float(b[part].max()), int(ids[part].min())))
    head = np.argsort(ids)[:64]
    save_block(folder, "head", ids=ids[head], m=m[head], b=b[head])
    seen = np.array(sorted({(int(u), int(i)) for u, i in zip(rng.integers(0, users, 4000), rng.choice(ids, 4000))}))
    save_block(folder, "seen-0", u=seen[:, 0], i=seen[:, 1])
    clip = CLIP.get(kind)
    run = scoring._scorer(folder, {"": blocks}, {"": (kind, mu, divisor, clip)}, k, 17, {"": "head"} if clip else {})
    table = pa.table({"id": np.arange(users), "bias": bu, "features": pa.array(P.tolist(), pa.list_(pa.float64()))})
    out = run((pa.scalar(""), pa.scalar(0)), table).to_pydict()
    got = {u: [(i, s) for v, i, s in zip(out["u"], out["i"], out["score"]) if v == u] for u in range(users)}
    est = mu + (np.einsum("uf,if->ui", P, m) + (bu[:, None] + b[None, :] if b0 else 0.0)) / divisor
    est = est if clip is None else np.clip(est, *clip)
    gone = set(map(tuple, seen.tolist()))
    for u in range(users):
        want = sorted((-round(est[u, j], 9), int(ids[j])) for j in range(n) if (u, int(ids[j])) not in gone)[:k]
        assert [i for i, _ in got[u]] == [i for _, i in want]
        assert np.allclose([s for _, s in got[u]], [-s for s, _ in want])


def test_items_are_dealt_to_cells_of_near_items():
    """Every item gets one cell; cells are even and narrow, and equal items are told apart by id."""
    from rankfold.operators.scoring import _cell, _coordinates, _cuts
    rng = np.random.default_rng(5)
    m, bias, ids = rng.integers(-10, 11, (8000, 3)).astype(float), np.zeros(8000), np.arange(8000)
    m[:2000] = 1.0                                              # a quarter of the items are alike
    x = _coordinates(m, bias, ids)
    cell = _cell(_cuts(x[::4], 16), x)
    size = np.bincount(cell, minlength=16)
    assert len(size) == 16 and size.max() < 1100
    wide = [np.ptp(m[cell == c], axis=0).mean() for c in range(16)]
    assert np.mean(wide) < 0.7 * np.ptp(m, axis=0).mean()
    assert set(cell) == set(range(16)) and len(np.unique(cell[:2000])) > 1


def test_a_users_best_block_is_met_first(tmp_path):
    """Blocks are met by the box around them: the one of shorter items but nearer to the user rules the other out."""
    import pyarrow as pa
    from rankfold.operators.scoring import _scorer
    from rankfold.sources.blockfiles import save_block
    folder = str(tmp_path)
    near = np.array([[5.0, 0.0], [4.0, 0.0], [3.0, 0.0]])
    save_block(folder, "near", ids=np.arange(3), m=near, b=np.zeros(3))
    blocks = {"": [("missing", 9.0, 0.0, 3, [1.0, 9.0], [0.0, 8.0]), ("near", 5.0, 0.0, 0, [5.0, 0.0], [3.0, 0.0])]}
    run = _scorer(folder, blocks, {"": ("dot", 0.0, 1.0, None)}, 2, 8)
    table = pa.table({"id": [5], "bias": [0.0], "features": pa.array([[1.0, 0.0]], pa.list_(pa.float64()))})
    out = run((pa.scalar(""), pa.scalar(0)), table).to_pydict()
    assert out["i"] == [0, 1] and out["score"] == [5.0, 4.0]


def test_a_block_looks_its_ids_up_among_the_seen_pairs(tmp_path, monkeypatch):
    """Opening a block doesn't search every seen pair of the user block; pairs on its items are found, repeated ones too."""
    from rankfold.operators import scoring
    from rankfold.sources.blockfiles import save_block
    rng = np.random.default_rng(7)
    su, si = rng.integers(0, 40, 3000), rng.integers(0, 500, 3000)
    ids = rng.permutation(np.arange(490, 520))
    save_block(str(tmp_path), "items", ids=ids, m=rng.normal(size=(30, 2)), b=np.zeros(30))
    searched, places = [], scoring._places
    monkeypatch.setattr(scoring, "_places", lambda x, wanted: (searched.append(len(wanted)), places(x, wanted))[1])
    own = scoring._Users(np.arange(40), rng.normal(size=(40, 2)), np.zeros(40), ("dot", 0.0, 1.0, None), 3, su, si)
    block = scoring._Block(str(tmp_path), "items", own)
    assert max(searched, default=0) <= len(ids)
    want = sorted((u, i) for u, i in zip(su.tolist(), si.tolist()) if i >= 490)
    assert len(set(want)) > 10 and sorted(zip(block.seen_user.tolist(), ids[block.seen_item].tolist())) == want
    every = np.array([(u, n) for u in range(40) for n in range(30)])
    assert block.unseen(every[:, 0], every[:, 1]).tolist() == [(u, ids[n]) not in set(want) for u, n in every.tolist()]
