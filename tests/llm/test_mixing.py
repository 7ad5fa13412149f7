import random

from harborline.llm import mixing

from ..compare import difference
from .helpers import documents, edge_rows, sentence

SF = "/root/testdata/sf0.001"


def water_fill(sizes):
    """Targets by filling a source at a time; sources by code point, null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    free, left, out = set(order), float(sum(sizes.values())), {}
    while free:
        rate = left / sum(weight[s] for s in free)
        over = [s for s in free if rate * weight[s] > 3 * sizes[s]]
        if not over:
            return out | {s: rate * weight[s] for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def make(seed=0):
    r = random.Random(seed)
    rows = edge_rows()
    for s, n in (("a", 400), ("b", 5), ("Z", 60), (None, 40), ("empty", 0), ("é", 30)):
        rows += [(len(rows) + 100, sentence(r, r.randrange(1, 200)), "en", s) for _ in range(n)]
    return rows + [(9000 + i, "", "en", "none") for i in range(3)]


def test_targets_and_words_taken(spark):
    rows = make()
    out = mixing.mix(documents(spark, rows)).collect()
    assert sorted(x.doc_id for x in out) == sorted(x[0] for x in rows)
    sizes = {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").replace("\x0b", " ").split(None) if t and t.isascii() else [w for w in (t or "").split(" ") if w])
    want = water_fill(sizes)
    for s, target in want.items():
        mine = [x for x in out if x.source == s]
        assert {x.source_size for x in mine} == {sizes[s]}
        assert all(abs(x.target - target) < 1e-6 * max(1, target) for x in mine)
        assert all(0 <= x.copies <= 3 and x.taken == x.copies * x.size for x in mine)
        assert abs(sum(x.taken for x in mine) - target) <= max(x.size for x in mine) * 2 + 3 * len({x.size for x in mine}) ** 0.5
    again = mixing.mix(documents(spark, rows).repartition(7)).collect()
    assert sorted((x.doc_id, x.size, x.taken) for x in out) == sorted((x.doc_id, x.size, x.taken) for x in again)


def test_buckets_do_not_change_expectations(spark):
    rows = make(1)
    out = mixing.mix(documents(spark, rows), bucket_rows=16).collect()
    for s in {x.source for x in out}:
        mine = [x for x in out if x.source == s]
        rate = mine[0].target / max(1, mine[0].source_size)
        assert abs(sum(x.copies for x in mine) - rate * len(mine)) <= 1.001


def test_empty(spark):
    assert mixing.mix(documents(spark, [])).collect() == []


def test_sql(spark):
    from harborline.llm.queries import op5_mix_sources

    assert difference(op5_mix_sources(spark, SF), SF, mixing.ORACLE_SQL) is None
