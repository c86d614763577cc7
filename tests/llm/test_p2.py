import numpy as np

from foliant.llm import p2_neighbours as m

SCHEMA = "chunk_id bigint, embedding array<float>, h bigint, ids string, list int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k=5):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 64 and np.isfinite(v).all() and np.any(v):
            seen[i] = np.asarray(v, np.float32).astype(np.float64)
    ids = np.array(sorted(seen))
    x = np.stack([seen[i] / np.linalg.norm(seen[i]) for i in ids])
    s = x @ x.T
    np.fill_diagonal(s, -2)
    out = set()
    for i, row in enumerate(s):
        for j in np.argsort(-row, kind="stable")[:k]:
            out.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return out


def test_recall_on_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(m, "LIST_SIZE", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(150, 64))
    data = [(i, centres[i % 150] + 0.2 * rng.normal(size=64)) for i in range(3000)]
    got = {tuple(r) for r in m.pairs(frame(spark, data)).collect()}
    want = brute(data)
    assert len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.97


def test_unusable_repeated_and_equal_vectors(spark):
    rng = np.random.default_rng(4)
    data = [(i, rng.normal(size=64)) for i in range(30)]
    data += [(100 + i, [1.0] * 64) for i in range(20)] + [(200, data[3][1]), (3, data[3][1])]
    data += [(300, None), (301, [0.0] * 64), (302, [1.0] * 63), (303, [float("nan")] + [1.0] * 63), (304, [float("inf")] + [1.0] * 63)]
    got = m.nearest(frame(spark, data)).collect()
    by = {}
    for r in got:
        by.setdefault(r.chunk_id, {})[r["rank"]] = r.other_id
    assert set(by) == {*range(30), *range(100, 120), 200}
    assert all(sorted(v) == [1, 2, 3, 4, 5] and k not in v.values() for k, v in by.items())
    assert by[119] == dict(zip(range(1, 6), range(100, 105))) and by[102] == dict(zip(range(1, 6), [100, 101, 103, 104, 105]))
    assert by[3][1] == 200 and by[200][1] == 3


def test_oversized_lists_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 50)
    monkeypatch.setattr(m, "LIST_SIZE", 400)
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=64)) for i in range(300)]
    assert {tuple(r) for r in m.pairs(frame(spark, data)).collect()} == brute(data)


def test_exact_misses_nothing_and_a_region_the_sample_missed_is_cut(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 60)
    monkeypatch.setattr(m, "LIST_SIZE", 16)
    rng = np.random.default_rng(9)
    dense = rng.normal(size=64)
    data = [(i, rng.normal(size=64)) for i in range(100)] + [(1000 + i, dense + 0.2 * rng.normal(size=64)) for i in range(200)]
    got = {tuple(r) for r in m.nearest(frame(spark, data), exact=True).select("chunk_id", "other_id").collect()}
    assert {(min(p), max(p)) for p in got} == brute(data)
    # all rows in one list, whatever the sample said
    monkeypatch.setattr(m, "fit", lambda sample, lists: (m.unit(dense[None, :].astype(np.float32)), np.array([0.001])))
    assert {tuple(r) for r in m.pairs(frame(spark, data)).collect()} == brute(data)


def test_small_and_empty_tables(spark):
    assert m.pairs(frame(spark, [])).count() == 0
    assert m.pairs(frame(spark, [(1, [1.0] * 64)])).count() == 0
    assert [tuple(r) for r in m.pairs(frame(spark, [(1, [1.0] * 64), (2, [1.0] * 63 + [2.0])])).collect()] == [(1, 2)]


def test_graph_search_finds_the_nearest_centroid():
    rng = np.random.default_rng(6)
    c = m.unit(rng.normal(size=(2000, 64)))
    q = m.unit(c[:300] + 0.05 * rng.normal(size=(300, 64)))
    ids, _ = m.Graph(c).search(q)
    assert (ids[:, 0] == np.arange(300)).mean() > 0.95


def test_fit_gives_balanced_lists():
    rng = np.random.default_rng(7)
    x = m.unit(np.concatenate([rng.normal(size=(500, 64)), 5 + 0.01 * rng.normal(size=(500, 64))]))
    _, share = m.fit(x, 50)
    assert abs(share.sum() - 1) < 1e-9 and share.max() <= 0.031
