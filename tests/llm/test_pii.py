import hashlib
import random
import re

import pytest

from harborline.llm import pii

from .helpers import documents, edge_rows


def naive(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(6)
    for _ in range(4000):
        text = "".join(r.choice(["@", ".", "a", "B", "1", "25", "4111", " ", "-", "+", "(", ")", "..", "_", "%", "é", "\n", "255.1.1.1", "4111 1111 1111 1111", "a@b.c", "+1 (555) 010-9999"]) for _ in range(r.randrange(1, 14)))
        assert pii.base_spans(text) == naive(text), repr(text)
    assert pii.base_spans("1" * 20_000 + "." + "a" * 20_000 + "@" * 20_000 + "+1" + "." * 20_000) is not None


@pytest.fixture(scope="module")
def field():
    return pii.train()


def test_viterbi_is_the_best_of_all_paths(field):
    import itertools

    import numpy as np

    words = "call 555-010-9999 or write".split()
    e, _ = field.scores([words])
    best = max(itertools.product(range(len(pii.LABELS)), repeat=len(words)), key=lambda p: field.start[p[0]] + sum(e[0, i, y] for i, y in enumerate(p)) + sum(field.move[a, b] for a, b in itertools.pairwise(p)))
    assert np.array_equal(field.decode([words])[0], best)


def test_held_out_accuracy(field):
    rows = pii.labelled_rows(400, seed=77)
    right = total = found = 0
    for (words, gold), labels in zip(rows, field.decode([w for w, _ in rows]), strict=True):
        guess = [pii.LABELS[x] for x in labels]
        total += sum(g != "outside" for g in gold)
        found += sum(g != "outside" for g in guess)
        right += sum(g == h != "outside" for g, h in zip(guess, gold, strict=True))
    assert right >= 0.93 * total and right >= 0.93 * found


def test_the_field_adds_spans_and_keeps_base_ones(spark, field):
    rows = edge_rows() + [
        (50, "call (555) 010-4477 now, or mail jo.do [at] mail [dot] org or jo@mail.org from 10.0.0.7.", "en", "web"),
        (51, "é\U0001f600 4111 1111 1111 1111 and 4111 1111 1111 1112", "en", "web"),
        (52, "in 1998 he sold 25 of 300 houses for $400,000", "en", "web"),
    ]
    got = {x.doc_id: x for x in pii.personal_data(documents(spark, rows), field).collect()}
    for i, t, *_ in rows:
        base = naive(t or "") if len(t or "") < 100_000 else pii.base_spans(t)
        x = got[i]
        assert x.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [sum(b[0] == k for b in base) for k in pii.KINDS]
        spans = [(k, int(s), int(e)) for k, s, e in (y.split(":") for y in x.spans.split(",") if y)]
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert "phone:5:19" in got[50].spans
    assert got[52].spans == ""
    masked = {x.doc_id: x.text for x in pii.redacted(documents(spark, rows), field).collect()}
    assert "555" not in masked[50] and "jo@mail" not in masked[50] and "10.0.0.7" not in masked[50]
    assert masked[1] is None and masked[2] == "" and masked[52] == rows[-1][1]


def test_empty(spark, field):
    assert pii.personal_data(documents(spark, []), field).collect() == []
    assert pii.redacted(documents(spark, []), field).collect() == []


FORMS = (("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", "."), (" at ", "."))


@pytest.mark.parametrize("at,dot", FORMS)
def test_every_form_is_decoded_without_digits_near_by(field, at, dot):
    """The triggers hide none of the forms: most made addresses are found."""
    r = random.Random(8)
    w = lambda: "".join(r.choice("bcdlmnprsaeiou") for _ in range(r.randrange(3, 9)))
    texts, wants = [], []
    for _ in range(60):
        name = r.choice((w(), f"{w()}.{w()}", f"{w()}_{w()}")) + at + r.choice((f"{w()}.com", f"{w()}.example.net", f"mail.{w()}.org")).replace(".", dot)
        before = " ".join(w() for _ in range(r.randrange(6, 9))) + " email "
        texts.append(f"{before}{name} {' '.join(w() for _ in range(6))}")
        wants.append(("email", len(before), len(before) + len(name)))
    found = [every for _, every in pii.find([t.encode() for t in texts], field)]
    assert sum(want in f for want, f in zip(wants, found, strict=True)) >= 0.9 * len(texts)


def test_what_holds_has_a_trigger():
    r = random.Random(9)
    parts = ["a", "B.c", "at", "AT", "dot", "@", ".", "com", " ", "\n", "\xa0", "\x1c", " ", "[", "]", "(", ")", "{", "}", "<", ">", "[at]", "(dot)", " at ", " at ", "x.org", "x.org", "b.com"]
    held = 0
    for _ in range(300_000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(3, 8)))
        if pii.holds("email", text):
            held += 1
            assert any(pii._TRIGGER.search(x) for x in pii._WORD.findall(text)) and pii._TRIGGER.search(text), repr(text)
    assert held > 100


def test_long_runs_are_decoded_in_steps(field, monkeypatch):
    """Scores made a few words at a time, and small batches, give the labels and spans of whole sentences."""
    r = random.Random(4)
    words = [w for row, _ in pii.labelled_rows(60, seed=3) for w in row]
    text = " ".join(r.choice(words) if r.random() < 0.9 else "plain" for _ in range(3000))
    whole = pii.find([text.encode(), b"call 555-010-9999 now"], field)
    labels = field.decode([text.split()])[0]
    monkeypatch.setattr(pii, "STEP", 7)
    monkeypatch.setattr(pii, "CELLS", 16)
    assert (field.decode([text.split()])[0] == labels).all()
    assert pii.find([text.encode(), b"call 555-010-9999 now"], field) == whole and whole[0][1] != whole[0][0]


def test_scores_are_the_sums_of_the_features(field):
    import numpy as np

    words = pii.labelled_rows(1, seed=8)[0][0] + "a 12 b@c.org".split()
    for n in (1, 2, 3, len(words)):
        want = [field.emit[[field.index[f] for f in fs if f in field.index]].sum(axis=0) for fs in pii.sentence_features(words[:n])]
        assert np.allclose(field.scores([words[:n]])[0][0], want)


def test_runs_hold_triggers_and_their_neighbours():
    r = random.Random(2)
    for _ in range(300):
        words = [r.choice(("a", "b", "c", "d", "7")) if r.random() < 0.5 else "w" for _ in range(r.randrange(0, 60))]
        near = [any(words[j] == "7" for j in range(max(0, i - pii.REACH), min(len(words), i + pii.REACH + 1))) for i in range(len(words))]
        want, open_ = [], False
        for w, x in zip(words, near, strict=True):
            if x and not open_:
                want.append([])
            if x:
                want[-1].append(w)
            open_ = x
        got = [run[:] for run in pii.runs(" ".join(words))]
        assert [w for run in got for w in run] == [w for run in want for w in run]


def test_a_long_text_of_numbers_takes_little_memory(field):
    import tracemalloc

    r = random.Random(1)
    text = " ".join(str(r.randrange(10 ** r.randrange(1, 9))) for _ in range(60_000)).encode()
    tracemalloc.start()
    pii.find([text], field)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 * len(text) + 30_000_000


def test_spans_that_touch_base_ones():
    r = random.Random(3)
    for _ in range(300):
        spans = [("card", s, s + r.randrange(1, 12)) for s in (r.randrange(60) for _ in range(r.randrange(0, 6)))]
        covered = pii.Covered(spans)
        for _ in range(20):
            a = r.randrange(60)
            b = a + r.randrange(1, 9)
            assert covered.touches(a, b) == any(s < b and a < e for _, s, e in spans)
