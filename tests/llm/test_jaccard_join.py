import random

import pytest

from harborline.llm import jaccard_join

from .helpers import documents, edge_rows, sentence


def shingles(text, k):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not words:
        return set()
    return {tuple(words)} if len(words) < k else {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted((row[0], len(sets[i]), least[find(i)]) for i, row in enumerate(rows))


def near_copies(r, base, n, changes, start):
    out = []
    for i in range(n):
        words = base.split()
        for _ in range(r.randrange(changes + 1)):
            words[r.randrange(len(words))] = f"n{r.randrange(10**6)}"
        out.append((start + i, " ".join(words), "en", "web"))
    return out


def chained(r, n, step, start):
    """Texts that drift apart: neighbours link, ends do not."""
    words, out = sentence(r, 200, 10**6).split(), []
    for i in range(n):
        out.append((start + i, " ".join(words), "en", "web"))
        for _ in range(step):
            words[r.randrange(len(words))] = f"d{r.randrange(10**6)}"
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_same_components_as_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(jaccard_join, "LEAF", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    r = random.Random(k)
    rows = edge_rows() + near_copies(r, sentence(r, 300), 40, 8, 100) + near_copies(r, sentence(r, 60), 30, 3, 200) + chained(r, 30, 4, 300)
    rows += [(400 + i, sentence(r, r.randrange(1, 12), 4), "en", "web") for i in range(150)]  # many short sets, alike
    rows += [(600 + i, rows[20][1], "en", "web") for i in range(20)]  # exact copies
    got = sorted(tuple(x) for x in jaccard_join.join(documents(spark, rows), k, percent).collect())
    assert got == brute(rows, k, percent)


@pytest.mark.parametrize("percent", [50, 80, 90, 99, 100])
def test_linked_sets_share_a_region_in_any_order(percent):
    import numpy as np

    r = np.random.RandomState(percent)
    levels, linked = r.randint(0, 5, jaccard_join.SLOTS).astype(np.uint8), 0
    for _ in range(3000):
        common, x, y = r.randint(1, 150), *(r.randint(0, 12, 2) if percent > 50 else r.randint(0, 60, 2))
        s = r.randint(1, 1 << 62, common + x + y).astype(np.uint64)
        a, b = np.unique(s[: common + x]), np.unique(np.concatenate((s[:common], s[common + x :])))
        both = len(np.intersect1d(a, b))
        if len(a) + len(b) > 2 * both and 100 * both >= percent * (len(a) + len(b) - both):
            linked += 1
            assert len(np.intersect1d(jaccard_join._regions(a, percent, levels), jaccard_join._regions(b, percent, levels)))
    assert linked > 100 or percent >= 99


@pytest.mark.parametrize("n,percent,kept", [(1, 80, 0), (3, 80, 0), (4, 80, 1), (5, 80, 2), (100, 80, 21), (8, 90, 0), (9, 90, 1), (10, 90, 2), (7, 100, 0)])
def test_how_many_shingles_a_set_keeps(n, percent, kept):
    assert jaccard_join.kept_of(n, percent) == kept


def test_shared_passages_come_last(spark):
    """Texts that share half their words with all others meet nobody: their own words come first."""
    r = random.Random(8)
    passage = sentence(r, 100, 10**6)
    rows = [(i, sentence(r, 100, 10**6) + " " + passage, "en", "web") for i in range(300)]
    d = documents(spark, rows).select("doc_id", "text").coalesce(2)
    levels = jaccard_join._levels(d, 5).value
    sets = list(jaccard_join.doc_shingles([x[1].encode() for x in rows], 5))
    kept = [set(jaccard_join._regions(s, 80, levels).tolist()) for s in sets]
    assert sum(len(x) for x in kept) == len(set.union(*kept))
    assert all(levels[jaccard_join._slots(s)[1]].max() >= 8 for s in sets)


def test_single_shingles_shared_by_chance_make_no_region_at_90(spark):
    """Texts of few words share most of their shingles with some other text, but are not alike: none meets another."""
    r = random.Random(9)
    rows = [(i, sentence(r, 200, 25), "en", "web") for i in range(300)]
    levels = jaccard_join._levels(documents(spark, rows).select("doc_id", "text").coalesce(2), 3).value
    sets = list(jaccard_join.doc_shingles([x[1].encode() for x in rows], 3))
    kept = [set(jaccard_join._regions(s, 90, levels).tolist()) for s in sets]
    assert min(len(x) for x in kept) > 0 and sum(len(x) for x in kept) == len(set.union(*kept))


def test_pairs_at_the_threshold_link(spark):
    a = [f"a{i}" for i in range(102)]  # 100 shingles
    b = a[:95] + [f"b{i}" for i in range(7)]  # shares 93
    sets = shingles(" ".join(a), 3), shingles(" ".join(b), 3)
    percent = 100 * len(sets[0] & sets[1]) // len(sets[0] | sets[1])
    rows = [(1, " ".join(a), "en", "x"), (2, " ".join(b), "en", "x")]
    for p in (percent, percent + 1):
        assert sorted(tuple(x) for x in jaccard_join.join(documents(spark, rows), 3, p).collect()) == brute(rows, 3, p)


def test_empty_table(spark):
    assert jaccard_join.join(documents(spark, [])).collect() == []


def test_copies_too_far_apart_to_link_meet_nobody(spark):
    """Copies of one text with own words in many places agree in most slices; they part without distances to pivots, and links among them stay."""
    r = random.Random(12)
    base, rows = sentence(r, 100, 10**6).split(), []
    for i in range(300):
        own = list(base)
        for at in r.sample(range(2, 98, 3), 4):  # 12 of 98 shingles, and a set keeps 10
            own[at] = f"o{i}x{at}"
        rows.append((i, " ".join(own), "en", "web"))
        if i % 10 == 0:
            own[r.randrange(100)] = f"p{i}"
            rows.append((1000 + i, " ".join(own), "en", "web"))
    seen: dict = {}
    for s in jaccard_join.doc_shingles([x[1].encode() for x in rows], 3):
        for x in jaccard_join._slices(s, 90).tolist():
            seen[x] = seen.get(x, 0) + 1
    assert max(seen.values()) > jaccard_join.LEAF  # slices alone make large regions of them
    counts: list = []
    got = sorted(tuple(x) for x in jaccard_join.join(documents(spark, rows), 3, 90, counts).collect())
    assert got == brute(rows, 3, 90)
    assert sum(c["voronoi"] for c in counts) == 0


@pytest.mark.parametrize("n,window", [(20, 5), (150, 40)])
def test_linked_sets_share_a_shingle_that_both_keep(n, window):
    """Whatever the levels say, so also when they are counted among few sets."""
    import numpy as np

    r = np.random.RandomState(n)
    for _ in range(500):
        levels = r.randint(0, 4, jaccard_join.SLOTS >> 6).astype(np.uint8).repeat(64)
        s = r.randint(1, 1 << 62, n + window).astype(np.uint64)
        cut = r.randint(0, window // 5 + 1, 2)
        a, b = np.unique(s[cut[0] : n]), np.unique(s[: n - cut[1]])
        both = len(np.intersect1d(a, b))
        if len(a) + len(b) > 2 * both and 100 * both >= 90 * (len(a) + len(b) - both):
            assert len(np.intersect1d(jaccard_join._rarest(a, 90, levels), jaccard_join._rarest(b, 90, levels)))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_voronoi_cells_with_production_parameters(spark, k, percent):
    r = random.Random(5)
    rows = chained(r, 60, 2 if percent == 90 else 3, 1000) + near_copies(r, sentence(r, 300, 10**6), 150, 12, 2000)
    counts: list = []
    got = sorted(tuple(x) for x in jaccard_join.join(documents(spark, rows), k, percent, counts).collect())
    assert got == brute(rows, k, percent)
    assert sum(c["voronoi"] for c in counts) > 0 and len(counts) > 1


def test_null_and_repeated_ids(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(None, a, "en", "x"), (7, a, "en", "x"), (7, b, "en", "x"), (None, b, "en", "x"), (None, "only one", "en", "x"), (None, None, "en", "x")]
    got = sorted((str(x), n, str(c)) for x, n, c in jaccard_join.join(documents(spark, rows), 3, 90).collect())
    assert got == sorted([("None", 38, "7"), ("7", 38, "7"), ("7", 38, "7"), ("None", 38, "7"), ("None", 1, "None"), ("None", 0, "None")])


@pytest.mark.parametrize("percent", [90, 80])
def test_least_distances_hold(spark, percent):
    """Wide sketches never say more than the distance, and say much of unrelated sets."""
    import numpy as np

    r = np.random.RandomState(percent)
    base = r.randint(1, 1 << 62, 9000).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[: n - n // m], r.randint(1, 1 << 62, n // m).astype(np.uint64)))) for n in (3, 20, 128, 129, 300, 700, 1500, 4000) for m in (1, 2, 9, 40)]
    rows = [(i, len(s), (w := jaccard_join._sketch(s))[8:] or w) for i, s in enumerate(sets)]
    t = spark.createDataFrame(rows, "class long, size long, wide array<long>")
    got = t.alias("x").join(t.alias("y"), how="cross").selectExpr("x.class", "y.class", f"{jaccard_join.least_distance()}").collect()
    for i, j, low in got:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert low <= 1 - both / (len(sets[i]) + len(sets[j]) - both) + 1e-9
        if i != j and i % 4 == j % 4 == 0 and 0.6 < len(sets[i]) / len(sets[j]) < 1.6:
            assert low > 0.6
