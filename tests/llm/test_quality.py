import math
import random
import re
from collections import Counter, defaultdict

import pytest

from harborline.llm import quality

from .helpers import documents, edge_rows, sentence


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i : i + 5])] > 1:
            hit |= set(range(i, i + 5))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def perplexities(rows, order=5, symbols=256):
    """Interpolated modified Kneser-Ney by its definition, a language at a time, words one by one."""
    out = {}
    for lang in {x for _, _, x, _ in rows}:
        mine = [(i, t) for i, t, x, _ in rows if x == lang and t]
        seqs = {i: [b" " * (order - 1) + w.encode() + b" " for w in re.findall(r"[^\x20\x09-\x0D]+", t)] for i, t in mine}
        counts = {order: Counter(s[j : j + order] for ws in seqs.values() for s in ws for j in range(len(s) - order + 1))}
        for o in range(order - 1, 0, -1):
            counts[o] = Counter(g[1:] for g in counts[o + 1])
        cuts, totals, backs = {}, {}, {}
        for o, c in counts.items():
            t = Counter(min(n, 5) for n in c.values())
            y = t[1] / (t[1] + 2 * t[2]) if t[1] + 2 * t[2] else 0.5
            d = [0.0] + [max(0.05 * k, min(0.95 * k, k - (k + 1) * y * t[k + 1] / t[k] if t[k] and k < 4 and t[k + 1] is not None else 0.5 * k)) for k in (1, 2, 3)]
            cuts[o] = lambda n, d=d: d[min(n, 3)]
            totals[o], backs[o] = defaultdict(float), defaultdict(float)
            for g, n in c.items():
                totals[o][g[:-1]] += n
                backs[o][g[:-1]] += cuts[o](n)

        def p(g, o, counts=counts, totals=totals, backs=backs, cuts=cuts):
            if o == 0:
                return 1 / symbols
            n = counts[o][g]
            return (n - cuts[o](n)) / totals[o][g[:-1]] + backs[o][g[:-1]] / totals[o][g[:-1]] * p(g[1:], o - 1)

        for i, ws in seqs.items():
            grams = [s[j : j + order] for s in ws for j in range(len(s) - order + 1)]
            if grams:
                out[i] = -sum(math.log(p(g, order)) for g in grams) / len(grams)
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["".join(r.choice("aeioubcdlmnprst") for _ in range(r.randrange(1, 8))) for _ in range(300)]
    out = [x for x in edge_rows() if x[0] not in (6, 7, 8, 9)]
    out += [(100 + i, " ".join(r.choice(words) for _ in range(r.randrange(1, 120))), r.choice(["en", "de"]), "web") for i in range(150)]
    out += [(500, "\n".join(["the same line again", "", "another line # here"] * 6), "en", "web"), (501, " ".join("qzxwvkj"[j % 7] * 5 + str(j) for j in range(80)), "en", "web")]
    return out


def test_base_statistics_and_perplexity(spark, rows):
    got = {x.doc_id: x for x in quality.rules(documents(spark, rows)).collect()}
    want = perplexities(rows)
    for i, t, *_ in rows:
        x = got[i]
        assert (x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words) == base(t)
        assert x.base_failed == (x.n_words < 10 or 100 * x.n_repeat_words > 20 * x.n_words)
        assert (x.log_ppl is None) == (i not in want)
        if i in want:
            assert math.isclose(x.log_ppl, want[i], rel_tol=1e-6)
        assert not (x.base_failed and x.kept)
    assert not got[501].kept and not got[501].base_failed  # words unlike the language's
    good = [x for i, x in got.items() if 100 <= i < 500 and not x.base_failed]
    assert sum(x.kept for x in good) >= 0.97 * len(good)


def test_same_bits_for_any_head(spark, rows):
    """All n-grams in the arrays, some, and none."""
    results = [sorted(tuple(x) for x in quality.rules(documents(spark, rows), head=head).collect()) for head in (quality.HEAD, 700, 0)]
    assert results[0] == results[1] == results[2]


def test_head_has_a_bound(spark, rows):
    model = spark.createDataFrame([(i, n, -i) for i, n in enumerate([9, 7, 7, 7, 5, 1, 1, 1, 1])], "hash long, n long, score long")
    for head, held in ((9, 9), (8, 5), (5, 5), (4, 4), (3, 1), (1, 1), (0, 0)):
        arrays, others = quality.split_model(model, head)
        assert len(arrays.hashes) == held and (0 if others is None else others.count()) == 9 - held


def test_null_language_is_its_own(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choice(["abc", "abd", "bcd", "cde"]) for _ in range(30)), "", "x") for i in range(20)] + [(100 + i, " ".join(r.choice(["xyz", "yzx"]) for _ in range(30)), None, "x") for i in range(20)]
    got = {x.doc_id: x.log_ppl for x in quality.rules(documents(spark, rows)).collect()}
    assert all(math.isclose(got[i], v, rel_tol=1e-6) for i, v in perplexities(rows).items())


def test_edges(spark):
    rows = edge_rows()
    got = sorted((x.doc_id, x.n_words, x.word_chars) for x in quality.rules(documents(spark, rows)).collect())
    assert got == sorted((i, *base(t)[:2]) for i, t, *_ in rows)
    assert quality.rules(documents(spark, [])).collect() == []
    assert [x.kept for x in quality.rules(documents(spark, [(1, None, None, None)])).collect()] == [False]


def test_long_repeats(spark):
    r = random.Random(9)
    rows = [(1, sentence(r, 30000, 3000) + " " + "again and again it says " * 9000, "en", "x"), (2, sentence(r, 40), "en", "x")]
    got = {x.doc_id: x.n_repeat_words for x in quality.rules(documents(spark, rows)).collect()}
    assert got == {i: base(t)[4] for i, t, *_ in rows}
