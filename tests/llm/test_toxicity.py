import random
import zlib

import numpy as np
import pytest

from harborline.llm import toxicity as T

from .helpers import documents, edge_rows, sentence

SF = "/root/testdata/sf0.1"


def found(text, g=T.KNOWN_ONLY):
    t = T.Tokens(T.pieces(text)[0])
    words, weight, kind, target, negated, said = T.matched(t, g)
    w = T.weighed(g, weight, target, negated, said)
    return [(t.buf[t.starts[i] : t.ends[i]].decode(), int(k), int(a), int(b), int(c), round(float(x), 6)) for i, k, a, b, c, x in zip(words, kind, target, negated, said, w, strict=True)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("You are an idiot.", [("idiot", 1, 1, 0, 0)]),
        ("Idiot, she left", [("idiot", 1, 0, 0, 0)]),
        ("idiot that you are", [("idiot", 1, 1, 0, 0)]),
        ("You are not an idiot!", [("idiot", 1, 1, 1, 0)]),
        ("not so good. An idiot came", [("idiot", 1, 0, 0, 0)]),
        ("The paper said it was trash", [("trash", 1, 0, 0, 1)]),
        ('a "stupid" idea and a dumb one', [("stupid", 1, 0, 0, 1), ("dumb", 1, 0, 0, 0)]),
        ("I will kill you", [("kill", 2, 1, 0, 0)]),
        ("weeds kill grass", []),
        ("die sache ist nicht dumm", [("dumm", 1, 0, 1, 0)]),
        ("“Moron”, she is", [("moron", 1, 0, 0, 1)]),
        ("", []),
    ],
)
def test_grammar(text, want):
    assert [x[:5] for x in found(text)] == want


def test_context_weighs():
    weight = {k: found(t)[0][5] for k, t in {"plain": "such an idiot", "at": "such an idiot you are", "not": "not an idiot", "said": "wrote the word idiot"}.items()}
    assert weight["at"] > weight["plain"] > weight["not"] and weight["plain"] > weight["said"]


def test_machine_is_its_parts():
    """The composed machine gives what its parts give one by one, symbol after symbol."""
    r = np.random.RandomState(5)
    parts = (T.events(), T.window((T.TARGET,), 5), T.window((T.NEGATOR,), 3), T.reported())
    symbols = r.randint(0, 8, 4000)
    sizes = []
    while sum(sizes) < len(symbols):
        sizes.append(min(int(r.randint(1, 40)), len(symbols) - sum(sizes)))
    sizes = np.array(sizes)
    begins = np.cumsum(sizes) - sizes
    out = T.run(T.FORWARD, symbols, begins, sizes)
    for b, n in zip(begins, sizes, strict=True):
        for i, m in enumerate(parts):
            state = 0
            for k in range(b, b + n):
                assert out[k] >> 2 * i & 3 == m.out[state, symbols[k]]
                state = m.step[state, symbols[k]]


def test_clauses_and_keys_by_brute_force():
    import re

    r = random.Random(2)
    text = "".join(r.choice(["ab", "é", "zzz", " ", " ", ", ", ".\n", "!", '"', "'", "x1"]) for _ in range(5000))
    t = T.Tokens(text.encode())
    words = re.findall(r"[a-z0-9'é]+", text)
    assert [t.buf[a:b].decode() for a, b in zip(t.starts, t.ends, strict=True)] == words
    clauses = [c for part in re.split(r"[.!?;:,\n]", text) for w in [re.findall(r"[a-z0-9'é]+", part)] for c in [w[i : i + T.WORDS] for i in range(0, len(w), T.WORDS)]]
    assert np.bincount(t.clause).tolist() == [len(c) for c in clauses]
    for length in (0, 3, 4):
        at, keys = t.keys(length)
        forms = [words[i].encode()[: length or None] for i in at]
        assert len(at) == sum(len(w.encode()) >= length for w in words)
        assert len(set(forms)) == len(set(keys.tolist())) == len(set(zip(forms, keys.tolist(), strict=True)))


def test_long_texts_are_read_whole():
    text = ("word " * 300_000) + "you are an idiot " + ("word " * 300_000)
    f = T.features([text, "you are an idiot", None, ""], T.KNOWN_ONLY)
    assert f[0, 2] == 600_004 and f[0, 1] == f[1, 1] > 0 and not f[2:].any()
    assert sum(len(p) for p in T.pieces("x" * 3_000_000)) == 3_000_000


def labelled(spark, seed=1, n=900):
    """Toxic texts hold words of invented stems; labels of held-out rows are wrong on purpose."""
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.25
        words = [f"{r.choice('abcdefgh')}{r.choice('xyzuvw')}{r.randrange(60)}" for _ in range(r.randrange(20, 90))]
        if toxic:
            for _ in range(r.randrange(2, 6)):
                words[r.randrange(len(words))] = r.choice(["grobnak", "zulvite"]) + r.choice(["a", "er", "us", "ing"])
        rows.append((i, " ".join(words), "xx", "s"))
        held = zlib.crc32(str(i).encode()) % 3 == 1
        labels.append((i, 1, int(toxic != held)))
    return rows, labels, [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(n)]


def test_learned_forms_and_held_out_labels(spark):
    rows, labels, held = labelled(spark)
    out = T.toxicity(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {i: bool(t) != h for (i, _, t), h in zip(labels, held, strict=True)}  # undo the wrong labels
    assert {x.doc_id: x.held_out for x in out} == dict(enumerate(held))
    right = [x.predicted == truth[x.doc_id] for x in out if x.held_out]
    assert len(right) > 250 and np.mean(right) > 0.97
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in out)


def test_labels_of_held_out_rows_change_nothing(spark):
    rows, labels, held = labelled(spark, 2, 400)
    d = documents(spark, rows)
    a, b = (T.fit(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, [(i, q, 1 - t if h else t) for (i, q, t), h in zip(labels, held, strict=True)]))
    assert (a.keys == b.keys).all() and (a.weights == b.weights).all() and a.context == b.context and a.scores == b.scores


def test_edges(spark):
    rows = [*edge_rows(), (None, "you idiot", "en", "web")]
    d = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = T.toxicity(d, none).collect()
    assert len(out) == len(rows) and not any(x.held_out for x in out if x.doc_id is None)
    assert len({x.score for x in out if x.doc_id in (1, 2, 3)}) == 1 and len({x.score for x in out if x.doc_id == 9}) == 1
    odd = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 1, 1), (9, 1, 1), (6, 0, 0), (6, 0, 1), (11, 0, 0)], "doc_id long, quality int, toxic int")
    assert T.toxicity(d, odd).count() == len(rows)
    assert T.toxicity(documents(spark, []), none).collect() == []
    m = T.matches(d, T.KNOWN_ONLY).collect()
    assert [(x.doc_id, x.word, x.clause, x.targeted) for x in m] == [(None, "idiot", "you idiot", True)]


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = T.toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    hit = sum(x.predicted and x.toxic for x in out)
    assert hit / sum(x.predicted for x in out) > 0.95 and hit / sum(x.toxic for x in out) > 0.88


def test_sentence_helper_has_no_matches():
    assert found(sentence(random.Random(1), 200)) == []
