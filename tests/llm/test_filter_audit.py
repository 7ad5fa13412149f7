import random
import re
from itertools import permutations

import pytest

from harborline.llm import filter_audit
from harborline.llm.common import WORD

from .helpers import documents, edge_rows, sentence

LABELS = "doc_id long, quality int, toxic int, part string, n string"


def brute(rows, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}, document by document."""
    first = {}
    for i, t, _, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = []
    for i, t, _, source in rows:
        t = t or ""
        w = re.findall(WORD, t)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and first[t] < i,
        }
        docs.append((source or "", fails, any(x[0] == i and x[1] == 1 for x in labels if i is not None), any(x[0] == i and x[2] == 1 for x in labels if i is not None)))
    out = {}
    for part in {d[0] for d in docs}:
        of = {f: 0 for f in "ABCDE"}
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for k, f in enumerate(order):
                hit = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                redundant = sum(d[1][f] for d in gone)
                unique = sum(d[1][f] and sum(d[1].values()) == 1 for d in docs if d[0] == part)
                gone += hit
                of[f] += len(hit)
                out[part, "".join(order), k + 1] = (len(left), len(hit), redundant, unique, sum(d[2] for d in hit), sum(d[3] for d in hit), f)
        for key in [k for k in out if k[0] == part]:
            out[key] = (*out[key][:-1], of[out[key][-1]])
    return out


def make(seed):
    r = random.Random(seed)
    rows = [*edge_rows(), (None, "no id", "en", "web"), (None, "no id", "en", "web"), (900, "no id", "en", "other")]
    for i in range(80):
        t = sentence(r, r.choice([5, 150, 199, 200, 201, 400]), r.choice([40, 150, 3000]))
        t = t.upper() if r.random() < 0.2 else t
        t = t + r.choice(["", "", " #", " 5%", " a|b"])
        rows.append((1000 + i, rows[-1][1] if r.random() < 0.2 else t, "en", r.choice(["web", "books", None, ""])))
    r.shuffle(rows)
    labels = [(i, r.randrange(2), r.randrange(2), "x", "y") for i, *_ in rows if r.random() < 0.6] + [(1000, 1, 0, "x", "y"), (None, 1, 1, "x", "y")]
    return rows, labels


@pytest.mark.parametrize("bits", [4, 63])
def test_brute_force(spark, bits):
    rows, labels = make(bits)
    out = filter_audit.audit(documents(spark, rows), spark.createDataFrame(labels, LABELS), bits).collect()
    got = {(x.part, x.filter_order, x.step): (x.kept, x.removed, x.redundant, x.unique_fails, x.good_lost, x.toxic_lost, x.shapley) for x in out}
    assert len(got) == len(out) == 600 * len({x[3] or "" for x in rows})
    assert got == brute(rows, labels)


@pytest.mark.parametrize("bits", [5, 63])
def test_matrix_is_the_texts(spark, bits):
    """Shards give back every text's counts of words, and numbers stand for one word each."""
    rows, _ = make(3)
    d = documents(spark, rows)
    words = {}
    for x in filter_audit.matrix(d, bits).collect():
        assert len(x.indptr) == len(x.docs) + 1 and x.indptr[-1] == len(x.indices) == len(x.data)
        for k, doc in enumerate(x.docs):
            mine = slice(x.indptr[k], x.indptr[k + 1])
            words.setdefault((doc.doc_id, bytes(doc.same)), []).append(dict(zip(x.indices[mine], x.data[mine], strict=True)))
    import hashlib
    from collections import Counter

    of_word = {}
    for i, t, _, _ in rows:
        want = Counter(re.findall(WORD, t or ""))
        for got in words[i, hashlib.sha256((t or "").encode()).digest()]:
            assert sorted(got.values()) == sorted(want.values())
        if len(want) == 1:
            of_word.setdefault(next(iter(got)), set()).add(next(iter(want)))
    assert all(len(v) == 1 for v in of_word.values())
    found = filter_audit.dictionary(d, bits).collect()
    assert sorted(bytes(x.word) for x in found) == sorted({w.encode() for _, t, _, _ in rows for w in re.findall(WORD, t or "")})


def test_too_many_shared_numbers(spark):
    words = filter_audit.dictionary(documents(spark, make(1)[0]), 2)
    with pytest.raises(ValueError, match="share numbers"):
        filter_audit.shared_numbers(words, most=10)


def test_empty(spark):
    assert filter_audit.audit(documents(spark, []), spark.createDataFrame([], LABELS)).collect() == []
