import random

from harborline.llm import licenses

from .helpers import documents, edge_rows, sentence


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_a_rising_match_and_no_longer_than_the_best():
    r = random.Random(1)
    for _ in range(300):
        a, b = ([r.randrange(12) for _ in range(r.randrange(25))] for _ in range(2))
        m = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(m, m[1:]))
        assert len(m) <= lcs(a, b)
    same = list(range(50))
    assert licenses.align(same, same) == [(i, i) for i in same]


def test_increasing_is_longest():
    r = random.Random(2)
    for _ in range(200):
        p = list(enumerate(r.sample(range(15), 12)))
        assert len(licenses.increasing(p)) == lcs([y for _, y in p], sorted(y for _, y in p))


def test_notices_are_found(spark):
    r = random.Random(3)
    t = licenses.TEMPLATES
    mit = t["mit"].split()
    changed = " ".join(w if i % 12 else "changed" for i, w in enumerate(mit))
    rows = edge_rows() + [
        (50, sentence(r, 300) + " " + t["mit"] + " " + sentence(r, 300), "en", "web"),
        (51, sentence(r, 30) + " " + changed + " " + sentence(r, 30), "en", "web"),
        (52, t["gpl-3.0"] + " " + sentence(r, 500) + " " + t["gpl-3.0"].upper(), "en", "web"),
        (53, "// " + t["apache-2.0"].replace(" ", "\n// "), "en", "web"),
        (54, "the license of the software is granted to any person under the general terms", "en", "web"),
        (55, " ".join(mit[::-1]), "en", "web"),
        (56, sentence(r, 20) + " " + t["cc-by-nc-4.0-line"], "en", "web"),
        (57, sentence(r, 50_000, 9000) + " " + t["bsd"], "en", "web"),
    ]
    got = {x.doc_id: x for x in licenses.licenses(documents(spark, rows)).collect()}
    assert got[50].license == "mit" and got[50].coverage == 1.0 and got[50].n_notices == 1
    assert got[51].license == "mit" and 0.8 <= got[51].coverage < 1
    assert got[52].license == "gpl-3.0" and got[52].n_notices == 2
    assert got[53].license == "apache-2.0" and got[57].license == "bsd" and got[56].license == "cc-by-nc-4.0-line"
    assert got[54].license is None and got[55].license is None and got[54].coverage == 0
    assert all(got[i].n_notices == 0 for i, *_ in edge_rows())
    assert licenses.licenses(documents(spark, [])).collect() == []


def test_coverage_at_the_threshold_counts(spark):
    rows = [(1, "Released under the MIT Licence today", "en", "x"), (2, "Released under a MIT Licence today", "en", "x")]
    got = {x.doc_id: (x.license, x.coverage) for x in licenses.licenses(documents(spark, rows), least=0.8).collect()}
    assert got == {1: ("mit-line", 0.8), 2: (None, 0.0)}
    assert [licenses.needed(n, 0.8) for n in (5, 10, 80, 81)] == [4, 8, 64, 65]


def test_notices_with_something_between_their_lines(spark):
    r = random.Random(6)
    words = licenses.TEMPLATES["mit"].split()
    rows = [(i, " ".join([sentence(r, 40), *words[:at], sentence(r, gap), *words[at:], sentence(r, 40)]), "en", "x") for i, (at, gap) in enumerate([(40, 30), (40, 70), (10, 60), (70, 60)])]
    got = {x.doc_id: (x.license, x.coverage) for x in licenses.licenses(documents(spark, rows)).collect()}
    assert got == {i: ("mit", 1.0) for i in range(4)}


def test_same_as_every_window_without_bounds(spark):
    """The query's rule by brute force: every window is aligned, no word bound spares one."""
    r = random.Random(8)
    templates = {"a": "one two three four five six seven eight nine ten", "b": "two one three five four"}
    rows = [(i, " ".join(r.choice(templates["a"].split() + ["x", "y"]) for _ in range(r.randrange(60))), "en", "x") for i in range(60)]
    rows += [(100 + i, " ".join(w for w in templates["a"].split() * 3 if r.random() < 0.85), "en", "x") for i in range(40)]
    for least in (0.5, 0.8):
        want = {}
        for i, text, *_ in rows:
            w, found = licenses.words(text.encode()), []
            for name, t in templates.items():
                t = t.encode().split()
                mine = []
                for begin, stop in licenses.windows(len(w), len(t)):
                    m = licenses.align(w[begin:stop], t)
                    if 100 * len(m) >= round(100 * least) * len(t):
                        mine.append((-len(m) / len(t), begin + m[0][0], begin + m[-1][0] + 1))
                for c, s, e in apart(sorted(mine, key=lambda x: (x[0], x[1]))):
                    found.append((c * len(t), s, e, name))
            kept = apart(sorted(found, key=lambda x: (round(x[0], 9), x[1], x[3])))
            want[i] = ",".join(f"{n}:{s}:{e}" for _, s, e, n in sorted(kept, key=lambda x: x[1]))
        got = {x.doc_id: x.notices for x in licenses.licenses(documents(spark, rows), templates, least).collect()}
        assert got == want and any(want.values())


def apart(found):
    kept = []
    for f in found:
        if all(k[2] <= f[1] or f[2] <= k[1] for k in kept):
            kept.append(f)
    return kept
