import hashlib
import random
import zlib

import pytest

from harborline.llm import merkle

from ..compare import difference
from .helpers import documents, edge_rows, sentence

SF = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def climb(digests):
    """All levels of a tree, and for each place the siblings on its way (side, digest) or None."""
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])

    def way(i):
        for level in levels[:-1]:
            j = i ^ 1
            yield (j < i, level[j]) if j < len(level) else None
            i //= 2

    return levels[-1][0], way


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of every row (doc_id, source, lang, n_chars, text), sorted."""
    groups = {}
    for r in rows:
        i, source, lang, n, text = r
        leaf = h(*map(value, r))
        hit = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf, i, h(value(i), value(source), value(lang), value(n + 1), value(text)) if hit else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    if not order:
        return []
    root, way = climb([trees[g][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for j, (_, _, leaf, i, shown) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*trees[g][1](j), *way(k)]
            folded = shown
            for s in steps:
                folded = h(folded) if s is None else h(s[1], folded) if s[0] else h(folded, s[1])
            out.append((i, leaf, trees[g][0], root, h(*[s[1] for s in steps if s]), folded, folded == root))
    return sorted(out, key=repr)


def check(spark, rows, bits):
    made = documents(spark, rows)
    got = merkle.audit(made, bits=bits).collect()
    assert sorted((tuple(x) for x in got), key=repr) == brute([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in made.collect()])


@pytest.mark.parametrize("bits", [1, 2, 8])
def test_edge_rows(spark, bits):
    r = random.Random(bits)
    rows = [*edge_rows(), (None, "no id", "en", "web"), (None, None, None, None), (77, "x", "", "web")]
    rows += [(100 + i, sentence(r, r.randrange(12)), r.choice(["en", "en", "de", "é"]), r.choice(["a", None])) for i in range(60)]
    check(spark, rows, bits)


def test_sizes_around_powers(spark):
    check(spark, [(i * 3, f"t{i}", f"l{n}", "s") for n in (1, 2, 3, 4, 5, 8, 9, 17) for i in range(n)], 2)


@pytest.mark.parametrize("n", [0, 1])
def test_empty_and_lone(spark, n):
    check(spark, [(i, "t", "en", "s") for i in range(n)], 8)


def test_many_bands_and_copies(spark):
    check(spark, [(i // 3, "same", "en" if i % 10 else "fr", "s") for i in range(700)], 3)


def test_labels_cover_their_ranks(spark):
    rows = [(i, f"t{i}", "en", "s") for i in range(37)]
    d = documents(spark, rows).withColumn("leaf", merkle.leaf())
    items = merkle.ranked(d.selectExpr("'g' as g", "doc_id", "unhex(leaf) as digest"), "g", ["doc_id"]).selectExpr("g", "rank", "rank as lo", "rank + 1 as hi", "digest", "n")
    nodes = merkle.band(items, 8).collect()
    for level in range(7):
        mine = sorted((x.lo, x.hi) for x in nodes if x.level == level)
        assert mine == [(a, min(a + (1 << level), 37)) for a in range(0, 37, 1 << level)]
    of = {(x.level, x.lo): x for x in nodes}
    for x in nodes:
        if x.level < 6:
            other = of.get((x.level, x.lo ^ (1 << x.level)))
            assert x.sibling == (other.digest if other else None) and (other is None or x.left == (other.lo < x.lo))


def test_tampered_rows_do_not_verify(spark):
    out = merkle.audit(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert all(x.verified == (zlib.crc32(str(x.doc_id).encode()) % 7 != 0) for x in out)


def test_sql_over_nulls(spark, tmp_path):
    rows = [*edge_rows(), (None, "no id", "en", "web"), *[(200 + i, f"t{i}", "de" if i % 3 else None, None) for i in range(40)]]
    documents(spark, rows).write.parquet(str(tmp_path / "all"))
    spark.read.parquet(str(tmp_path / "all")).coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    assert difference(merkle.audit(spark.read.parquet(str(tmp_path / "documents.parquet"))), str(tmp_path), merkle.ORACLE_SQL) is None
