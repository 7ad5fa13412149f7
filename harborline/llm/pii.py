"""Personal data: patterns, and a linear-chain conditional random field over word-shape features.

The patterns give the base spans. The field labels words (outside, email, ip, card, phone); it is trained by gradient
steps on a small labelled table made from templates (`labelled_rows`, at most `most` rows), and decoded by Viterbi in
numpy, many word sequences at once. A labelled run becomes a span if it does not touch a base span and its form holds
(digits of a phone, Luhn sum of a card, four parts of an address, a domain of an email).

Words without a digit, an @ or an at/dot near them (words of their own, or in brackets within a word) are never labelled:
the field decodes each such trigger word with `REACH` words on either side, and takes the rest as outside. No form that
holds is without a trigger word.
"""

from __future__ import annotations

import hashlib
import random
import re
from array import array
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column_bytes, mapped

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
REACH = 4
STEP = 1024  # words of a sentence that are scored at a time
CELLS = 1 << 16  # words of a decode batch, unless one sentence alone has more

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# All that holds() accepts has a match in one of its words: digits, an @, or an at between brackets or spaces of any kind.
_TRIGGER = re.compile(r"[\d@]|(?:^|[\[({<\s])(?:at|dot)(?=$|[\])}>\s])", re.I)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")  # possessive: nothing follows, so there is nothing to take back
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind's pattern that pass its check; by kind, then start. Linear in the text."""
    out = []
    end = at = 0
    while (at := text.find("@", max(at, end))) >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            end = m.end()
        at += 1
    for m in _IP.finditer(text):
        if all(len(p) < 4 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub(r"[\x20-]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# Words that announce personal data.
CUES = "tel tel. telephone phone mobile cell call fax whatsapp ring number email e-mail mail contact write reach ip address host server visa card credit mastercard amex at dot [at] (at) [dot] (dot) {at} <at>".split()


def shape(word: str) -> tuple[str, ...]:
    """Features of one word: its shape, counts of its characters, cue words."""
    bare = word.strip(".,;:!?\"'")
    digits = sum(c.isdigit() for c in bare)
    letters = sum(c.isalpha() for c in bare)
    runs = re.sub(r"[0-9]+", "9", re.sub(r"[^\W\d_]+", "a", bare))[:12]
    size = [len(x) for x in re.findall(r"[0-9]+", bare)][:5]
    f = ["runs=" + runs, f"digits={min(digits, 20)}", f"letters={min(letters, 3)}", "sizes=" + "-".join(str(min(x, 17)) for x in size)]
    f += [f"has={c}" for c in "@.-+()[]/:=_#$%*&|\"" if c in bare]
    low = word.lower().strip(",;:!?\"'")
    for form in (low, low.strip(".")):
        if form in CUES:
            f.append("cue=" + form)
            break
    if digits and bare[:1].isdigit() and bare.replace(".", "").isdigit() and bare.count(".") == 3 and all(x and int(x[-4:]) <= 255 for x in bare.split(".")):
        f.append("quad")
    if word[-1:] in ".,;:!?":
        f.append("end=" + word[-1:])
    return tuple(f)


NEIGHBOURS = ((-1, "p:"), (1, "n:"), (-2, "pp:"))


def neighbour_features(own: tuple[str, ...], name: str) -> list[str]:
    """What a word's features are called where it stands beside the word that is labelled."""
    return [name + x for x in own if not x.startswith("has=")]


def sentence_features(words: list[str]) -> list[list[str]]:
    """Features of each word: its own, and its neighbours' at distances one and two."""
    own = [shape(w) for w in words]
    out = []
    for i in range(len(words)):
        f = list(own[i])
        for d, name in NEIGHBOURS:
            f += neighbour_features(own[i + d], name) if 0 <= i + d < len(words) else [name + "none"]
        out.append(f)
    return out


def labelled_rows(most: int = 900, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """The labelled table: (words, labels) rows made from templates; about a third hold no personal data."""
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    w = lambda: "".join(r.choice("aeioubcdlmnprsteh") for _ in range(r.randrange(2, 10)))
    cap = lambda: w().capitalize()

    def card():
        n = r.choice((13, 15, 16, 16, 16, 16, 19))
        body = r.choice("3456") + d(n - 2)
        full = next(body + str(c) for c in range(10) if luhn(body + str(c)))
        sep = r.choice(("", "", " ", "-", "."))
        return sep.join(full[i : i + 4] for i in range(0, n, 4)) if sep else full

    def phone():
        a, b, c = d(3), d(3), d(4)
        return r.choice((f"+{d(1)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{d(2)} {d(3)} {d(7)}", f"0{d(3)} {d(6)}", f"00{d(2)} {d(3)} {d(6)}", f"+{d(2)}-{d(2)}-{d(8)}", f"1-{a}-{b}-{c}"))

    def email():
        host = r.choice((f"{w()}.com", f"mail.{w()}.org", f"{w()}.example.net", f"{w()}.de"))
        name = r.choice((w(), f"{w()}.{w()}", f"{w()}{d(2)}", f"{w()}_{w()}"))
        at, dot = r.choice((("@", "."), ("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" [at] ", ".")))
        return name + at + host.replace(".", dot)

    def ip():
        return ".".join(str(r.randrange(256)) for _ in range(4)) + r.choice(("", "", "", ":80", "/24"))

    def nothing():
        return r.choice((f"{d(1)}.{d(1)}", f"{d(1)}.", f"v{d(1)}.{d(1)}.{d(2)}", r.choice(("1998", "2024", "2011")), f"${d(3)}", f"{d(2)}:{d(2)}", f"{d(4)}-{d(2)}-{d(2)}", f"{d(2)}%", "AKIA" + d(4).replace("0", "X") + w().upper() + d(3), f"password={w()}{d(5)}", '"' + d(6) + w() + d(8) + '"', d(5), d(6), d(12), d(2) + "," + d(3), f"{d(3)} {d(3)} {w()}", f"at {w()} dot", f"#{d(4)}", f"{d(1)}/{d(2)}", f"{w()}@{w()}", f"isbn {d(3)}-{d(1)}-{d(2)}", "order " + d(8), d(3) + "." + d(3), f"{d(1)}.{d(1)}.{d(1)}", d(16), d(18)))

    cues = {"phone": ("tel", "phone", "call", "Tel.:", "mobile", "fax", "ring"), "card": ("card", "visa", "credit card"), "email": ("email", "contact", "write to", "e-mail:"), "ip": ("ip", "host", "address", "server")}
    make = {"phone": phone, "card": card, "email": email, "ip": ip}
    rows = []
    for _ in range(most):
        words, labels = [], []

        def add(text, label="outside", words=words, labels=labels):
            for x in text.split():
                words.append(x)
                labels.append(label)

        for _ in range(r.randrange(1, 4)):
            for _ in range(r.randrange(0, 6)):
                add(cap() if r.random() < 0.2 else w())
            k = r.choice(("phone", "card", "email", "ip", "none", "none", "none"))
            if k == "none":
                add(nothing() + r.choice(("", ".", ",")))
                continue
            if r.random() < 0.4:
                add(r.choice(cues[k]))
            add(make[k]() + r.choice(("", "", ".", ",")), k)
            add(w())
        rows.append((words, labels))
    return rows


class Field:
    """Weights of the field: a row for each feature, transitions, starts."""

    def __init__(self, index: dict, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.index, self.emit, self.move, self.start = index, emit, move, start
        self.none = np.array([self._sum([name + "none"]) for _, name in NEIGHBOURS])
        self.known: dict[str, np.ndarray] = {}

    def _sum(self, features) -> np.ndarray:
        return self.emit[[x for f in features if (x := self.index.get(f)) is not None]].sum(axis=0)

    def parts(self, word: str) -> np.ndarray:
        """What a word adds to the scores of itself and, in the order of NEIGHBOURS, of the words it stands beside."""
        found = self.known.get(word)
        if found is None:
            own = shape(word)
            found = np.array([self._sum(own), *[self._sum(neighbour_features(own, name)) for _, name in NEIGHBOURS]])
            if len(word) <= 64:
                if len(self.known) >= 1 << 15:
                    self.known.clear()
                self.known[word] = found
        return found

    def scores(self, sentences: list, lo: int = 0, hi: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Emission scores (sentence, word, label) of words lo to hi, padded, and the sentences' lengths."""
        size = np.array([len(s) for s in sentences])
        hi = int(size.max(initial=1)) if hi is None else hi
        out = np.zeros((len(sentences), hi - lo, len(LABELS)))
        for i, s in enumerate(sentences):
            end = min(hi, len(s))
            if end <= lo:
                continue
            first = max(0, lo - 2)
            words = np.array([self.parts(w) for w in s[first : min(end + 1, len(s))]])
            e = out[i, : end - lo]
            e += words[lo - first : end - first, 0]
            for k, (d, _) in enumerate(NEIGHBOURS):
                a, b = max(lo, -d), min(end, len(s) - d)  # the words that have such a neighbour
                if a < b:
                    e[a - lo : b - lo] += words[a + d - first : b + d - first, k + 1]
                e[: max(0, min(end, -d) - lo)] += self.none[k]
                e[max(0, len(s) - max(0, d) - lo) :] += self.none[k]
        return out, size

    def decode(self, sentences: list) -> list[np.ndarray]:
        """Most likely labels of each sentence: Viterbi over all sentences of the batch at once.

        Scores are made `STEP` words at a time; what is held of a whole sentence is a byte a word and label.
        """
        if not sentences:
            return []
        size = np.array([len(s) for s in sentences])
        n, t, k = len(sentences), int(size.max()), len(LABELS)
        back = np.zeros((n, t, k), np.int8)
        for lo in range(0, t, STEP):
            e, _ = self.scores(sentences, lo, min(t, lo + STEP))
            if lo == 0:
                best = self.start + e[:, 0]
            for j in range(max(1, lo), min(t, lo + STEP)):
                options = best[:, :, None] + self.move
                back[:, j] = options.argmax(axis=1)
                new = options.max(axis=1) + e[:, j - lo]
                best = np.where((j < size)[:, None], new, best)
        out = np.zeros((n, t), np.int8)
        now = best.argmax(axis=1)
        for j in range(t - 1, -1, -1):
            live = j < size
            out[live, j] = now[live]
            now = np.where(live & (j > 0), back[np.arange(n), j, now], now)
        return [out[i, : size[i]] for i in range(n)]


def train(rows: list[tuple[list[str], list[str]]] | None = None, steps: int = 120, rate: float = 0.15, decay: float = 2e-3) -> Field:
    """Fit by Adam on the penalised log likelihood of the whole labelled table; the same rows give the same weights."""
    rows = rows if rows is not None else labelled_rows()
    index: dict[str, int] = {}
    count: dict[str, int] = {}
    sentences = [sentence_features(w) for w, _ in rows]
    for s in sentences:
        for fs in s:
            for f in fs:
                count[f] = count.get(f, 0) + 1
    for f, n in count.items():
        if n > 1:
            index[f] = len(index)
    k, t, n = len(LABELS), max(len(s) for s in sentences), len(rows)
    size = np.array([len(s) for s in sentences])
    gold = np.zeros((n, t), int)
    at_word, at_feature = [], []
    for i, (s, (_, labels)) in enumerate(zip(sentences, rows, strict=True)):
        for j, fs in enumerate(s):
            gold[i, j] = LABELS.index(labels[j])
            ids = [index[f] for f in fs if f in index]
            at_word += [i * t + j] * len(ids)
            at_feature += ids
    at_word, at_feature = np.array(at_word), np.array(at_feature)
    params = [np.zeros((len(index), k)), np.zeros((k, k)), np.zeros(k)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    live = np.arange(t) < size[:, None]
    rows_at, columns = np.arange(n), np.arange(k)

    def logsum(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for step in range(1, steps + 1):
        emit, move, start = params
        e = np.zeros((n * t, k))
        for c in range(k):
            e[:, c] = np.bincount(at_word, weights=emit[at_feature, c], minlength=n * t)
        e = e.reshape(n, t, k)
        a = np.zeros((n, t, k))
        a[:, 0] = start + e[:, 0]
        for j in range(1, t):
            a[:, j] = np.where(live[:, j, None], logsum(a[:, j - 1, :, None] + move, 1) + e[:, j], a[:, j - 1])
        z = logsum(a[:, -1], 1)
        b = np.zeros((n, t, k))
        moves = np.zeros((k, k))
        for j in range(t - 2, -1, -1):
            inner = e[:, j + 1] + b[:, j + 1]
            b[:, j] = np.where(live[:, j + 1, None], logsum(move + inner[:, None, :], 2), 0)
            p = np.exp(a[:, j, :, None] + move + inner[:, None, :] - z[:, None, None]) * live[:, j + 1, None, None]
            moves += p.sum(axis=0)
        p = np.exp(a + b - z[:, None, None]) * live[:, :, None]
        p[rows_at[:, None], np.arange(t), gold] -= live
        g_emit = np.zeros_like(emit)
        flat = p.reshape(n * t, k)
        for c in range(k):
            g_emit[:, c] = np.bincount(at_feature, weights=flat[at_word, c], minlength=len(index))
        pairs = live[:, 1:]
        seen = np.bincount(gold[:, :-1][pairs] * k + gold[:, 1:][pairs], minlength=k * k).reshape(k, k)
        grads = [g_emit / n + decay * emit, (moves - seen) / n + decay * move, p[:, 0].sum(axis=0) / n + decay * start]
        for q, g, m, v in zip(params, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(index, *params)


def holds(kind: str, text: str) -> bool:
    """Whether a labelled run has the form of its kind."""
    digits = "".join(_DIGIT.findall(text))
    if kind == "phone":
        return 8 <= len(digits) <= 15 and len(set(digits)) > 1 and bool(re.search(r"[ ().+-]", text)) and not re.search(r"[^\W\d_]|[=#$%&*\"/:]", text)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits) and len(set(digits)) > 1 and not re.search(r"[^0-9 .-]", text)
    if kind == "ip":
        parts = re.split(r"[/:]", text)[0].split(".")
        return len(parts) == 4 and all(x.isdigit() and len(x) <= 3 and int(x) <= 255 for x in parts)
    text = re.sub(r"\s+", " ", text)  # long gaps would make the patterns below quadratic
    plain = re.sub(r"\s*[\[({<]\s*at\s*[\])}>]\s*|\s+at\s+", "@", text, flags=re.I)
    plain = re.sub(r"\s*[\[({<]\s*dot\s*[\])}>]\s*|\s+dot\s+", ".", plain, flags=re.I)
    return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", plain))


class Run:
    """Words of a text that are decoded together: their places, and the words themselves where they are asked for."""

    def __init__(self, text: str, row: int, places: array):
        self.text, self.row, self.places = text, row, places  # starts and ends in turn

    def __len__(self) -> int:
        return len(self.places) // 2

    def __getitem__(self, at: slice) -> list[str]:
        lo, hi, _ = at.indices(len(self))
        flat = self.places[2 * lo : 2 * hi]
        return [self.text[a:b] for a, b in zip(flat[::2], flat[1::2], strict=True)]


def runs(text: str, row: int = 0) -> Iterator[Run]:
    """The trigger words of a text with REACH words on either side; runs that touch are one."""
    before: deque = deque(maxlen=REACH)  # words since the last run that may begin the next one
    places, left = array("q"), 0
    for m in _WORD.finditer(text):
        a, b = m.span()
        if _TRIGGER.search(text[a:b]):
            for x in before:
                places.extend(x)
            before.clear()
            places.extend((a, b))
            left = REACH
        elif left:
            places.extend((a, b))
            left -= 1
        else:
            if len(before) == REACH and places:  # too far on for the open run
                yield Run(text, row, places)
                places = array("q")
            before.append((a, b))
    if places:
        yield Run(text, row, places)


class Covered:
    """Whether spans touch any of the given ones, by their starts in order and the furthest end so far."""

    def __init__(self, spans: list):
        some = sorted((s, e) for _, s, e in spans)
        self.starts = [s for s, _ in some]
        self.ends = list(accumulate((e for _, e in some), max))

    def touches(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def field_spans(texts: list[str | None], bases: list[list], field: Field) -> list[list[tuple[str, int, int]]]:
    """Spans the field adds to each text."""
    sentences = [r for i, text in enumerate(texts) if text for r in runs(text, i)]
    covered = {i: Covered(bases[i]) for i in {r.row for r in sentences}}
    out: list[list] = [[] for _ in texts]
    sentences.sort(key=len)  # sentences of like length together
    at = 0
    while at < len(sentences):
        to = at + 1
        while to < min(len(sentences), at + 256) and (to + 1 - at) * len(sentences[to]) <= CELLS:
            to += 1
        some = sentences[at:to]
        at = to
        for run, labels in zip(some, field.decode(some), strict=True):
            text = run.text
            edges = np.flatnonzero(np.diff(labels)) + 1
            for j, end_word in zip([0, *edges.tolist()], [*edges.tolist(), len(labels)], strict=True):
                if labels[j] == 0:
                    continue
                start, end = run.places[2 * j], run.places[2 * end_word - 1]
                while start < end and text[start] in "\"'<[{,;:":
                    start += 1
                while end > start and text[end - 1] in "\"'>]},;:.!?":
                    end -= 1
                kind = LABELS[labels[j]]
                if start < end and holds(kind, text[start:end]) and not covered[run.row].touches(start, end):
                    out[run.row].append((kind, start, end))
    return out


def find(texts: list[bytes | None], field: Field) -> list[tuple[list, list]]:
    """(base spans, all spans) of each UTF-8 text; spans are (kind, start, end) in code points, by kind and start."""
    decoded = [s if t and _TRIGGER.search(s := t.decode()) else None for t in texts]
    bases = [base_spans(t) if t else [] for t in decoded]
    added = field_spans(decoded, bases, field)
    return [(b, sorted(b + a, key=lambda s: (KINDS.index(s[0]), s[1])) if a else b) for b, a in zip(bases, added, strict=True)]


def listed(spans: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _rows(field, redact: bool):
    def run(batches):
        import pyarrow as pa

        f = field.value
        for b in batches:
            for i in range(0, len(b), 512):
                part = b.slice(i, 512)
                texts = column_bytes(part.column("text"))
                found = find(texts, f)
                if redact:
                    out = [masked(t, every) for t, (_, every) in zip(texts, found, strict=True)]
                    yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(out, pa.string()))
                    continue
                counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in KINDS]
                lists = [listed(base) for base, _ in found]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lists], pa.string()), pa.array([listed(every) for _, every in found], pa.string())], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return run


def masked(text: bytes | None, spans: list) -> str | None:
    """The text with each span replaced by its kind in capitals between < and >; of spans that overlap, the longest-reaching cut wins."""
    if text is None:
        return None
    s = text.decode()
    if not spans:
        return s
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [s[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, s[at:]])


def personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row for each document: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans (base and added).

    Null and empty texts have no spans. Very long texts are read whole: decoding holds some twenty bytes a word of them.
    Repeated documents and null ids give a row each. Empty tables give no rows; further columns are ignored.
    """
    f = docs.sparkSession.sparkContext.broadcast(field or trained())
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(d, _rows(f, False), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


@lru_cache
def trained() -> Field:
    """The field of the labelled rows, fitted once a session: the same rows give the same weights."""
    return train()


def redacted(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """The documents with every span replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; other columns as they are.

    Null texts stay null, empty ones empty; very long texts are read whole. Repeated documents and null ids give a row each.
    Empty tables give no rows.
    """
    f = docs.sparkSession.sparkContext.broadcast(field or trained())
    return mapped(docs, _rows(f, True), docs.schema)
