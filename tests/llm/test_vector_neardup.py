import math

import numpy as np
import pytest

from harborline.llm import vector_neardup

SCHEMA = "vec_id long, embedding array<float>, label long, row string, component string, unit string, word string"


def table(spark, rows):
    return spark.createDataFrame([(i, e, label, "x", "x", "x", "x") for i, e, label in rows], SCHEMA)


def brute(rows, threshold):
    x = []
    for _, e, label in rows:
        ok = label is not None and e is not None and len(e) and all(v is not None and np.isfinite(v) for v in e) and any(e)
        v = np.array(e, np.float32).astype(float) if ok else None
        x.append(v / np.linalg.norm(v) if ok else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and float(x[i] @ x[j]) >= threshold] for i in range(n)]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        least = min(rows[j][0] for j in group)
        for j in group:
            out[j] = (rows[j][0], len(near[j]), least, rows[j][0] == least)
    return sorted(out)


def test_same_as_brute_force(spark):
    r = np.random.RandomState(1)
    rows = []
    for c in range(30):
        centre = r.standard_normal(16)
        for _ in range(r.randint(1, 25)):
            rows.append((len(rows), (centre + r.standard_normal(16) * r.choice([0.05, 0.15, 0.3])).astype(np.float32).tolist(), int(c % 3)))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(700)]  # equal vectors, more than a tile
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] + [1.0] * 15, 1), (2004, [float("inf")] * 16, 1), (2005, [None] + [1.0] * 15, 1), (2006, rows[0][1], None), (2007, [1.0, 2.0], 0), (2008, [1.0, 2.0], 0), (2007, [2.0, 4.0], 0)]
    got = sorted(tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows), 0.93).collect())
    assert got == brute(rows, 0.93)


def test_all_wrong_and_empty(spark):
    rows = [(1, None, None), (2, [0.0], 1)]
    assert sorted(tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows)).collect()) == brute(rows, 0.93)
    assert vector_neardup.near_duplicates(table(spark, [])).collect() == []


@pytest.mark.parametrize("dim", [64])
def test_recall_on_one_large_label(spark, dim):
    """Pairs near the threshold in one label of several thousand vectors: at least 0.9 of the links' components are found."""
    r = np.random.RandomState(2)
    base = r.standard_normal((1500, dim))
    other = base + r.standard_normal((1500, dim)) * 0.36
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(np.concatenate((base, other)))]
    got = sorted(tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows), 0.93).collect())
    want = brute(rows, 0.93)
    linked = [w for w in want if w[1]]
    assert len(linked) > 300
    assert len(set(linked) & set(got)) >= 0.9 * len(linked)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_copies_do_not_fill_windows(spark):
    """Twenty different vectors of 40 copies each, fewer than a window: one pass compares all of them."""
    r = np.random.RandomState(4)
    base = [v + r.standard_normal(16) * 0.2 for v in r.standard_normal((4, 16)) for _ in range(5)]
    rows = [(40 * i + k, v.astype(np.float32).tolist(), 0) for i, v in enumerate(base) for k in range(40)]
    got = sorted(tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows), 0.93, window=24).collect())
    assert got == brute(rows, 0.93)


def test_passes_grow_with_the_label_and_its_spread(spark):
    p = vector_neardup.passes_for
    assert p(17_000, 0.93, 24) == 20 and p(24, 0.93, 24) == 1 and p(17_000, 0.93, 2048) == 7 and p(10**6, 0.93, 2048, 0.5) > p(10**6, 0.93, 2048) == 18
    r = np.random.RandomState(5)
    base = r.standard_normal((1000, 32))
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(np.concatenate((base, base + r.standard_normal((1000, 32)) * 0.36)))]
    got = {tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows), 0.93, window=4).collect()}
    linked = [w for w in brute(rows, 0.93) if w[1]]
    assert len(linked) > 200 and sum(w in got for w in linked) >= 0.9 * len(linked)


def test_short_partitions_do_not_part_windows(spark):
    """Partitions of a few rows: windows reach over several of them, as many pairs are found as in one partition."""
    r = np.random.RandomState(6)
    base = r.standard_normal((60, 16))
    rows = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(np.concatenate((base, base + r.standard_normal((60, 16)) * 0.2)))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for n in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(n == "1").lower())
            found.append(sorted(tuple(x) for x in vector_neardup.near_duplicates(table(spark, rows), 0.93).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found[0] == found[1] == brute(rows, 0.93)


def test_rounding_bounds_hold():
    r = np.random.RandomState(7)
    x = r.standard_normal((300, 64)) * np.exp(r.standard_normal((300, 64)))
    x /= np.linalg.norm(x, axis=1)[:, None]
    import pyarrow as pa

    n = len(x)
    b = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), *[pa.array(np.zeros(n, np.int64))] * 3, pa.array(vector_neardup._rounded(x), pa.binary())], ["row", "pass", "label", "dim", "small"])
    rows = vector_neardup.Rows(b)
    margin = rows.lost[:, None] * (1 + rows.lost[None]) + rows.lost[None]
    assert (np.abs(x @ x.T - rows.x @ rows.x.T) <= margin).all() and margin.max() < 0.1


def test_double_vectors_keep_their_precision(spark):
    """Cosine just under the threshold in double, at it in float."""
    a, c = [1.0, 0.0], 0.93 - 1e-9
    rows = [(1, a, 0), (2, [c, math.sqrt(1 - c * c)], 0)]
    schema = "vec_id long, embedding array<double>, label long"
    assert [x.n_links for x in vector_neardup.near_duplicates(spark.createDataFrame(rows, schema), 0.93).collect()] == [0, 0]
    rows[1] = (2, [0.93 + 1e-9, math.sqrt(1 - (0.93 + 1e-9) ** 2)], 0)
    assert [x.n_links for x in vector_neardup.near_duplicates(spark.createDataFrame(rows, schema), 0.93).collect()] == [1, 1]


@pytest.mark.parametrize("shared", [1.2])
def test_recall_on_a_large_clustered_label(spark, shared):
    """100,000 vectors of one label, in clusters that share a direction: queries are every 100th id against all."""
    import pyarrow as pa

    r = np.random.RandomState(8)
    centres = r.standard_normal((4000, 64)) + shared * np.ones(64)
    v = np.repeat(centres, 25, axis=0) + r.standard_normal((100_000, 64)) * 0.45
    base = np.flatnonzero(np.arange(100_000) % 10 == 0)
    v[base + 1] = v[base] + r.standard_normal((len(base), 64)) * 0.3
    v = v[r.permutation(len(v))].astype(np.float32)
    embedding = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, 64), pa.int32()), pa.array(v.ravel()))
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(len(v)), "embedding": embedding, "label": np.zeros(len(v), np.int64)})).repartition(8)
    got = vector_neardup.near_duplicates(df, 0.93).toPandas().set_index("vec_id").sort_index()
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    hit = want = 0
    for q in range(0, len(v), 100):
        near = np.flatnonzero(u @ u[q] >= 0.93)
        want += len(near) - 1
        hit += int((got.component_id.to_numpy()[near] == got.component_id[q]).sum()) - 1
        assert got.n_links[q] <= len(near) - 1
    assert want > 50 and hit >= 0.9 * want


def planted(r, sizes, dim=16):
    """Clustered vectors of labels of the given sizes, every tenth with a near copy; rows and the copies' pairs."""
    rows, pairs = [], []
    for label, n in enumerate(sizes):
        centres = r.standard_normal((max(1, n // 8), dim)) + 1.0
        v = centres[r.randint(0, len(centres), n)] + r.standard_normal((n, dim)) * 0.35
        for k in range(0, n - 1, 10):
            v[k + 1] = v[k] + r.standard_normal(dim) * 0.25
            if v[k] @ v[k + 1] / np.linalg.norm(v[k]) / np.linalg.norm(v[k + 1]) >= 0.93:
                pairs.append((len(rows) + k, len(rows) + k + 1))
        rows += [(len(rows) + k, [float(np.float32(y)) for y in x], label) for k, x in enumerate(v)]
    order = r.permutation(len(rows))
    return [rows[k] for k in order], pairs


@pytest.mark.parametrize("sizes", [[40] * 1200, [4000, 40, 40, 700, 2, 1, 300]])
def test_recall_whatever_the_number_and_sizes_of_labels(spark, sizes, monkeypatch):
    rows, pairs = planted(np.random.RandomState(11), sizes)
    out = {x.vec_id: x.component_id for x in vector_neardup.near_duplicates(table(spark, rows), 0.93, window=12).collect()}
    assert len(out) == len(rows) and len(pairs) > 50
    assert sum(out[a] == out[b] for a, b in pairs) >= 0.95 * len(pairs)


def test_labels_beyond_the_means_take_passes_too(spark, monkeypatch):
    monkeypatch.setattr(vector_neardup, "MEANS", 3 * 8 * 16)  # three labels' means
    rows, pairs = planted(np.random.RandomState(12), [60] * 40)
    keyed = spark.createDataFrame([(k, 16, 60) for k in range(40)], "label long, dim int, count long")
    plan, others = vector_neardup.planned(spark.createDataFrame([(i, x, e) for i, e, x in rows], "row long, label long, embedding array<float>"), keyed, 0.93, 1, 12)
    assert len(plan) == 3 and others == vector_neardup.passes_for(60, 0.93, 12) > 1
    out = {x.vec_id: x.component_id for x in vector_neardup.near_duplicates(table(spark, rows), 0.93, window=12).collect()}
    assert sum(out[a] == out[b] for a, b in pairs) >= 0.9 * len(pairs)


@pytest.mark.parametrize("tile", [6, 512])
def test_links_of_components_of_every_size(spark, monkeypatch, tile):
    """Counted as pairs, together in a task, or in tiles: the same numbers, those of brute force."""
    monkeypatch.setattr(vector_neardup, "TILE", tile)
    r = np.random.RandomState(7)
    rows, want = [], {}
    for c, size in enumerate([2] * 40 + [3, 5, 6, 9, 30] * 3 + [60]):
        centre = r.standard_normal(12)
        x = centre + r.standard_normal((size, 12)) * (0.01 if size == 2 else 0.25)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, n in enumerate(((x @ x.T) >= 0.93).sum(axis=1) - 1):
            want[len(rows)] = int(n)
            rows.append((len(rows), c, x[i].tobytes()))
    order = r.permutation(len(rows))
    members = spark.createDataFrame([rows[k] for k in order], "row long, component long, unit binary").repartition(7)
    assert {x.row: x.n_links for x in vector_neardup.count_links(members, 0.93).collect()} == want


def test_many_small_components_are_counted_fast(spark):
    """No Python call a component: twenty thousand of three take seconds."""
    import time

    one = np.eye(4)[0].tobytes()
    members = spark.range(60_000).selectExpr("id as row", "id div 3 as component").crossJoin(spark.createDataFrame([(bytearray(one),)], "unit binary"))
    begin = time.time()
    got = vector_neardup.count_links(members, 0.93).groupBy("n_links").count().collect()
    assert [tuple(x) for x in got] == [(2, 60_000)] and time.time() - begin < 15
