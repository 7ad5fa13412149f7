"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols: insults, threats, targets, intent, negators, verbs of reported speech, quotation marks, others. Small
transducers read them side by side: one passes insults on, one finds threats near an intent, one knows whether a target
is near, one whether a negator stands shortly before, one whether the words are reported. Their composition is one machine
that gives each match its context; a match weighs its word's weight and its context's, and a clause weighs what its matches
weigh together. A document's score follows from its clauses by a logistic function.

Which forms of words are insults is learned, as are the weights of contexts and of the function: from at most `rows` labelled
rows, spread by a hash of their ids, never from held-out ones. A form is the beginning of a word or a whole word; it needs
documents of either label counted by Spark. The weights of contexts and the function are learned on documents that the forms
were not counted on: two folds swap their roles.

The grammar's known words are listed below; what is learned adds to them. Every clause of every text is read.
"""

from __future__ import annotations

from itertools import product
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, tidied, written

ROWS = 20_000  # labelled rows that the grammar is learned from, at most
FORMS = 50_000  # forms in the grammar, at most: the heaviest
LENGTHS = (3, 4, 5, 6, 7, 8, 9, 10, 12, 14)  # bytes of beginnings of words
PRIOR, LEAST = 10.0, 1.6  # documents by which a form's odds are drawn to the common ones; least log odds of a form
WORDS = 64  # a clause without punctuation ends after so many words
PIECE = 1 << 20  # bytes of text read at once
THRESHOLD = 0.7

OTHER, INSULT, THREAT, TARGET, INTENT, NEGATOR, REPORT, QUOTE = range(8)

# fixed words of the grammar, lower case; insults carry a weight of their own beside what is learned
KNOWN = {
    INSULT: "idiot idiots idiotic moron morons stupid loser losers scum trash worthless pathetic disgusting clown fool imbecile dumb vermin idiota imbécil estúpido basura idioten dumm blöd abschaum trottel imbécile débile ordure connard",
    THREAT: "kill hurt destroy beat murder stab shoot töten umbringen schlagen matar golpear destruir tuer frapper détruire",
    TARGET: "you your yours u ya he she they them him her his their du dich dir dein deine ihr euch sie er tu te toi ton ta vous votre il elle ils tú ti usted ustedes él ella ellos",
    INTENT: "will shall gonna going must should i'll we'll werde werden wird will muss vais va vont allons voy vamos va van",
    NEGATOR: "not no never nobody none don't isn't aren't wasn't nicht kein keine nie niemals pas jamais aucun no nunca ningún jamás",
    REPORT: "said says say wrote writes claimed claims reported quoted called calls sagte sagt schrieb behauptet dit disait écrit déclare dijo dice escribió afirma",
}
KNOWN_WEIGHT = 1.5
# log weights of contexts before data: target near, negated, reported
CONTEXT = (0.5, -1.0, -1.0)
CONTEXT_PRIOR = 20.0

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(97, 123), 39, *range(128, 256)]] = True
_ENDS = np.zeros(256, np.int32)
_ENDS[list(b".!?;:,\n")] = 1
_VALUES = np.random.RandomState(13).randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_BASE = 0xC2B2AE3D27D4EB4F
_POW = np.full(PIECE + (1 << 16), _BASE, np.uint64)
_INV = np.full(len(_POW), pow(_BASE, -1, 1 << 64), np.uint64)
_POW[0] = _INV[0] = 1
_POW, _INV = np.multiply.accumulate(_POW), np.multiply.accumulate(_INV)
_PLAIN = [("“".encode(), b'"'), ("”".encode(), b'"'), ("„".encode(), b'"'), ("«".encode(), b'"'), ("»".encode(), b'"'), ("’".encode(), b"'"), ("…".encode(), b"."), ("—".encode(), b","), ("–".encode(), b","), (" ".encode(), b" "), ("¡".encode(), b" "), ("¿".encode(), b" ")]


class Machine(NamedTuple):
    """A transducer that gives a number for each symbol it reads: next state and output by [state, symbol]."""

    step: np.ndarray
    out: np.ndarray


def window(symbols: tuple, words: int) -> Machine:
    """1 for symbols up to `words` places after one of `symbols`."""
    step, out = np.zeros((words + 1, 8), np.int64), np.zeros((words + 1, 8), np.int64)
    for state in range(words + 1):
        step[state] = max(state - 1, 0)
        step[state, list(symbols)] = words
        out[state] = state > 0
    return Machine(step, out)


def reported() -> Machine:
    """1 after a verb of speech, and between quotation marks."""
    step = np.tile(np.arange(3)[:, None], (1, 8))  # 0: own words, 1: after a verb, 2: inside marks
    step[0, REPORT] = 1
    step[:, QUOTE] = [2, 2, 0]
    return Machine(step, np.tile((np.arange(3) > 0)[:, None], (1, 8)).astype(np.int64))


def events() -> Machine:
    """1 for an insult, 2 for a threat at most four words after an intent."""
    near = window((INTENT,), 4)
    out = np.zeros_like(near.out)
    out[:, INSULT] = 1
    out[1:, THREAT] = 2
    return Machine(near.step, out)


def composed(*machines: Machine) -> Machine:
    """The machine that reads alongside all of these; its output is theirs, each in two bits, the first one lowest."""
    sizes = [len(m.step) for m in machines]
    step, out = np.zeros((int(np.prod(sizes)), 8), np.int64), np.zeros((int(np.prod(sizes)), 8), np.int64)
    for state, parts in enumerate(product(*map(range, sizes))):
        for symbol in range(8):
            step[state, symbol] = np.ravel_multi_index([m.step[p, symbol] for m, p in zip(machines, parts, strict=True)], sizes)
            out[state, symbol] = sum(int(m.out[p, symbol]) << 2 * i for i, (m, p) in enumerate(zip(machines, parts, strict=True)))
    return Machine(step, out)


FORWARD = composed(events(), window((TARGET,), 5), window((NEGATOR,), 3), reported())
BACKWARD = window((TARGET,), 3)  # read from the end of a clause: a target that follows


def run(machine: Machine, symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray, back: bool = False) -> np.ndarray:
    """A machine's output for each symbol of many clauses, read side by side, a word of every clause at a time."""
    out = np.zeros(len(symbols), np.int64)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes, state = begins[order], sizes[order], np.zeros(len(sizes), np.int64)
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, side="left"))  # clauses longer than k
        at = begins[:n] + (sizes[:n] - 1 - k if back else k)
        s = symbols[at]
        out[at] = machine.out[state[:n], s]
        state[:n] = machine.step[state[:n], s]
    return out


def _key(h: np.ndarray, length: int) -> np.ndarray:
    return mix(h + np.uint64(length))


def whole_keys(words: list[str]) -> np.ndarray:
    return np.concatenate([Tokens(w.encode()).keys(0)[1] for w in words]) if words else np.zeros(0, np.uint64)


class Tokens:
    """Words of a buffer of lower-case bytes: starts, ends, clause of each."""

    def __init__(self, buf: bytes):
        b = np.frombuffer(buf, np.uint8)
        edge = np.diff(np.concatenate(([0], _IS_WORD[b].view(np.int8), [0])))
        self.buf, self.starts, self.ends = buf, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_VALUES[b] * _POW[: len(b)], out=self.total[1:])
        cuts = np.zeros(len(b) + 1, np.int32)
        np.cumsum(_ENDS[b], out=cuts[1:])
        marks = np.zeros(len(b) + 1, np.int32)
        np.cumsum(b == 34, out=marks[1:])
        new = np.ones(len(self.starts), bool)
        new[1:] = cuts[self.starts[1:]] != cuts[self.ends[:-1]]
        first = np.flatnonzero(new)
        place = np.arange(len(new)) - np.repeat(first, np.diff(np.append(first, len(new))))
        self.new = new | (place % WORDS == 0)
        self.clause = np.cumsum(self.new) - 1
        self.quoted = np.zeros(len(new), bool)  # an odd number of marks since the word before, or the clause's begin
        if len(new):
            since = np.where(self.new, self.starts, np.append(0, self.ends[:-1]))
            since[0] = 0
            since[1:][self.new[1:]] = self.ends[:-1][self.new[1:]]
            self.quoted = (marks[self.starts] - marks[since]) % 2 == 1

    def keys(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words have a beginning of `length` bytes (0: the whole word), and its key."""
        at = np.arange(len(self.starts)) if not length else np.flatnonzero(self.ends - self.starts >= length)
        s = self.starts[at]
        e = self.ends[at] if not length else s + length
        return at, _key((self.total[e] - self.total[s]) * _INV[s], length)


class Grammar(NamedTuple):
    """keys: of forms, sorted, and their weights; context: of target, negation, report; scores: of the logistic function."""

    keys: np.ndarray
    weights: np.ndarray
    context: tuple
    scores: tuple


_KNOWN_KEYS = {s: np.unique(whole_keys(words.split())) for s, words in KNOWN.items()}


def matched(t: Tokens, g: Grammar) -> tuple[np.ndarray, ...]:
    """Words that match: their index, weight, and context bits (kind, target, negated, reported)."""
    n = len(t.starts)
    symbol, weight = np.zeros(n, np.int64), np.zeros(n)
    whole = t.keys(0)[1]
    for s, keys in _KNOWN_KEYS.items():
        symbol[np.isin(whole, keys)] = s
    weight[(symbol == INSULT) | (symbol == THREAT)] = KNOWN_WEIGHT
    if len(g.keys):
        for length in (0, *LENGTHS):
            at, key = t.keys(length)
            i = np.minimum(np.searchsorted(g.keys, key), len(g.keys) - 1)
            hit = g.keys[i] == key
            weight[at[hit]] = np.maximum(weight[at[hit]], g.weights[i[hit]])
        symbol[(weight > 0) & (symbol != THREAT)] = INSULT
    hit = np.isin(symbol, (INSULT, THREAT))
    wanted = np.zeros(int(t.clause[-1]) + 1 if n else 0, bool)
    wanted[t.clause[hit]] = True
    keep = np.flatnonzero(wanted[t.clause]) if n else np.zeros(0, np.int64)
    # quotation marks are symbols of their own, before the word they precede
    quote = t.quoted[keep]
    at = np.arange(len(keep)) + np.cumsum(quote)
    stream = np.full(len(keep) + int(quote.sum()), QUOTE)
    stream[at] = symbol[keep]
    of = np.zeros(len(stream), np.int64)
    of[at] = t.clause[keep]
    of[(at - 1)[quote]] = t.clause[keep][quote]
    begins = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begins, len(of)))
    code = run(FORWARD, stream, begins, sizes)[at]
    after = run(BACKWARD, stream, begins, sizes, back=True)[at]
    event = np.flatnonzero(code & 3)
    code = code[event]
    kind, target, negated, said = code & 3, (code >> 2 & 3) | after[event], code >> 4 & 3, code >> 6 & 3
    words = keep[event]
    return words, weight[words], kind, target, negated, said


def weighed(g: Grammar, weight, target, negated, said) -> np.ndarray:
    a, b, c = g.context
    return np.maximum(weight + a * target + b * negated + c * said, 0)


def pieces(text) -> list[bytes]:
    """A text as lower-case pieces of at most PIECE bytes, cut at the ends of clauses, else of words."""
    buf = (text or "").lower().encode("utf-8", "surrogatepass")
    for a, b in _PLAIN:
        buf = buf.replace(a, b)
    out, at = [], 0
    while len(buf) - at > PIECE:
        b = np.frombuffer(buf, np.uint8, PIECE // 2, at + PIECE // 2)
        cut = np.flatnonzero(_ENDS[b] == 1)
        cut = cut if len(cut) else np.flatnonzero(~_IS_WORD[b])
        to = at + PIECE // 2 + int(cut[-1]) + 1 if len(cut) else at + PIECE
        out.append(buf[at:to])
        at = to
    return [*out, buf[at:]]


def groups(texts: list):
    """(rows, Tokens, row of each word): pieces of texts put together to about PIECE bytes."""
    held, rows, size = [], [], 0

    def made():
        t = Tokens(b"\n".join(held))
        begins = np.concatenate(([0], np.cumsum([len(x) + 1 for x in held])))[:-1]
        return t, np.array(rows)[np.searchsorted(begins, t.starts, side="right") - 1]

    for i, text in enumerate(texts):
        for p in pieces(text):
            if held and size + len(p) > PIECE:
                yield made()
                held, rows, size = [], [], 0
            held.append(p)
            rows.append(i)
            size += len(p) + 1
    if held:
        yield made()


def features(texts: list, g: Grammar) -> np.ndarray:
    """A row for each text: the heaviest clause, all clauses' weight, words, and events by context."""
    out = np.zeros((len(texts), 9))
    for t, row in groups(texts):
        words, weight, _, target, negated, said = matched(t, g)
        np.add.at(out[:, 2], row, 1)
        if not len(words):
            continue
        w = weighed(g, weight, target, negated, said)
        clause, inverse = np.unique(t.clause[words], return_inverse=True)
        total = np.bincount(inverse, weights=w)
        of = row[words][np.unique(inverse, return_index=True)[1]]
        np.maximum.at(out[:, 0], of, total)
        np.add.at(out[:, 1], of, total)
        for k, x in enumerate((target, negated, said)):
            np.add.at(out[:, 3 + 2 * k], row[words], x)
            np.add.at(out[:, 4 + 2 * k], row[words], 1 - x)
    return out


def inputs(f: np.ndarray) -> np.ndarray:
    """What the logistic function takes of features."""
    total, words = f[:, 1], f[:, 2]
    return np.column_stack((np.ones(len(f)), np.minimum(f[:, 0], 20), np.log1p(total), np.log1p(100 * total / np.maximum(words, 1)), np.log1p(words)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Coefficients by Newton's method; all but the constant are drawn to 0."""
    c = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * c)
        c = c + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-7:
            break
    return c


def form_weights(toxic: np.ndarray, clean: np.ndarray, n_toxic: float, n_clean: float) -> np.ndarray:
    """Log odds of a form's documents against all, drawn to 0 by PRIOR documents."""
    share = n_toxic / max(n_toxic + n_clean, 1)
    return np.log((toxic + PRIOR * share) / (clean + PRIOR * (1 - share) + 1e-9)) - np.log(max(share, 1e-9) / max(1 - share, 1e-9))


def _fold(doc_id):
    return F.crc32(doc_id.cast("string")) % 3


def training(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """(text, toxic, fold), written: at most `rows` labelled documents of folds 0 and 2, by a hash of their ids.

    Ids that stand for several documents, or for documents of no label or of two, are not learned from.
    """
    of = labels.where("toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    of = of.where("toxic = other and doc_id is not null").where(_fold(F.col("doc_id")) != 1)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lone = d.groupBy("doc_id").agg(F.count("*").alias("n")).where("n = 1").join(of, "doc_id")
    taken = written(lone.select("doc_id", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("doc_id").alias("h")).sort("h", "doc_id").limit(rows), "labelled")
    return written(d.join(F.broadcast(taken), "doc_id").select("text", "toxic", _fold(F.col("doc_id")).cast("int").alias("fold")), "training")


def _document_keys(texts: list):
    """(rows, keys): each form of each text once."""
    for t, row in groups(texts):
        found = [t.keys(length) for length in (0, *LENGTHS)]
        rows, keys = np.concatenate([row[at] for at, _ in found]), np.concatenate([k for _, k in found])
        order = np.lexsort((keys, rows))
        rows, keys = rows[order], keys[order]
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
        yield rows[new], keys[new]


def _toxic_forms(batches):
    import pyarrow as pa

    for batch in batches:
        for _, keys in _document_keys(batch.column("text").to_pylist()):
            key, n = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])


def _counts_of(candidates):
    def run(batches):
        import pyarrow as pa

        wanted = candidates.value
        n = np.zeros((len(wanted), 4), np.int64)  # clean and toxic of fold 0, clean and toxic of fold 2
        for batch in batches:
            toxic, fold = batch.column("toxic").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy(zero_copy_only=False)
            for rows, keys in _document_keys(batch.column("text").to_pylist()):
                at = np.minimum(np.searchsorted(wanted, keys), max(len(wanted) - 1, 0))
                hit = wanted[at] == keys if len(wanted) else np.zeros(len(keys), bool)
                kind = (toxic[rows] == 1).astype(int) + (fold[rows] == 2) * 2
                np.add.at(n, (at[hit], kind[hit]), 1)
        some = np.flatnonzero(n.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), *[pa.array(n[some, k]) for k in range(4)]], ["key", "c0", "t0", "c2", "t2"])

    return run


def _features_of(by_fold: dict):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts, fold = batch.column("text").to_pylist(), np.array(batch.column("fold").to_pylist(), int)
            out = np.zeros((len(texts), 9))
            for f, g in by_fold.items():
                mine = np.flatnonzero(fold == f)
                out[mine] = features([texts[i] for i in mine], g)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *[pa.array(out[:, k]) for k in range(9)]], ["toxic", *[f"x{k}" for k in range(9)]])

    return run


#: Without labels to learn from: the known words alone.
KNOWN_ONLY = Grammar(np.zeros(0, np.uint64), np.zeros(0), CONTEXT, (-4.0, 0.5, 1.0, 1.0, -0.2))


def context_weights(f: np.ndarray, y: np.ndarray) -> tuple:
    """Log odds of events with a context against those without, drawn to CONTEXT by CONTEXT_PRIOR events of each label."""
    out = []
    for k, prior in enumerate(CONTEXT):
        t, c = f[y == 1][:, 3 + 2 * k : 5 + 2 * k].sum(axis=0), f[y == 0][:, 3 + 2 * k : 5 + 2 * k].sum(axis=0)
        seen = float(np.log((t[0] + 1) / (t[1] + 1)) - np.log((c[0] + 1) / (c[1] + 1)))
        n = min(t[0] + c[0], c[0] + c[1])  # events that tell anything
        out.append((CONTEXT_PRIOR * prior + n * seen) / (CONTEXT_PRIOR + n))
    return tuple(out)


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, forms: int = FORMS, candidates: int = 1_000_000) -> Grammar:
    """The grammar learned from labelled documents that are not held out; KNOWN_ONLY where there are none of either label.

    Spark counts documents with each form. `candidates` bounds the forms whose documents of either label are counted: those
    of the most toxic documents of the sample, three at least.
    """
    spark = docs.sparkSession
    sample = training(docs, labels, rows)
    n = {(r.fold, r.toxic): r.n for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    if not any(v for (_, t), v in n.items() if t == 1) or not any(v for (_, t), v in n.items() if t != 1):
        return KNOWN_ONLY
    found = sample.where("toxic = 1").select("text").mapInArrow(tidied(_toxic_forms), "key long, n long")
    found = found.groupBy("key").agg(F.sum("n").alias("n")).where("n >= 3").orderBy(F.desc("n"), "key").limit(candidates)
    wanted = spark.sparkContext.broadcast(np.sort(found.select("key").toPandas()["key"].to_numpy(np.int64).view(np.uint64)))
    counts = sample.mapInArrow(tidied(_counts_of(wanted)), "key long, c0 long, t0 long, c2 long, t2 long").groupBy("key").agg(*[F.sum(c).alias(c) for c in ("c0", "t0", "c2", "t2")])
    size = {(f, t): float(sum(v for (g, u), v in n.items() if g == f and (u == 1) == t)) for f in (0, 2) for t in (True, False)}
    share = (size[0, True] + size[2, True]) / sum(size.values())
    odds = F.log((F.col("t0") + F.col("t2") + PRIOR * share) / (F.col("c0") + F.col("c2") + PRIOR * (1 - share)))
    kept = counts.where(odds - float(np.log(share / (1 - share))) >= LEAST / 2).orderBy(odds.desc(), "key").limit(forms).toPandas()
    key = kept["key"].to_numpy(np.int64).view(np.uint64)
    c0, t0, c2, t2 = (kept[c].to_numpy(float) for c in ("c0", "t0", "c2", "t2"))

    def grammar(toxic, clean, n_toxic, n_clean):
        w = form_weights(toxic, clean, n_toxic, n_clean)
        good = np.flatnonzero((toxic >= 3) & (w >= LEAST))
        good = good[np.argsort(key[good])]
        return Grammar(key[good], w[good], CONTEXT, KNOWN_ONLY.scores)

    folds = {2: grammar(t0, c0, size[0, True], size[0, False]), 0: grammar(t2, c2, size[2, True], size[2, False])}
    whole = grammar(t0 + t2, c0 + c2, size[0, True] + size[2, True], size[0, False] + size[2, False])
    schema = "toxic int, " + ", ".join(f"x{k} double" for k in range(9))
    fitted = lambda by_fold: sample.mapInArrow(tidied(_features_of(by_fold)), schema).toPandas().sort_values([*[f"x{k}" for k in range(9)], "toxic"], ignore_index=True)
    f = fitted(folds)
    context = context_weights(f.iloc[:, 1:].to_numpy(float), (f["toxic"] == 1).to_numpy(int))
    f = fitted({k: g._replace(context=context) for k, g in folds.items()})
    scores = logistic(inputs(f.iloc[:, 1:].to_numpy(float)), (f["toxic"] == 1).to_numpy(float))
    return whole._replace(context=context, scores=tuple(scores))


def _scores(g: Grammar):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                x = inputs(features(batch.column("text").slice(i, 512).to_pylist(), g)) @ np.array(g.scores)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, 512), batch.column("held_out").slice(i, 512), pa.array(1 / (1 + np.exp(-np.clip(x, -30, 30))))], ["doc_id", "held_out", "score"])

    return run


def score(docs: DataFrame, g: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score, predicted.

    Null and empty texts score as texts without a match. Repeated rows score alike; a null id is not held out. Very long
    texts are read whole, in pieces. A table without rows gives none; only doc_id and text are read.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(_fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"))
    out = d.mapInArrow(tidied(_scores(g)), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def _matches(g: Grammar):
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "clause", "word", "kind", "targeted", "negated", "reported", "weight"]
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for t, row in groups(batch.column("text").to_pylist()):
                words, weight, kind, target, negated, said = matched(t, g)
                w = weighed(g, weight, target, negated, said)
                first = np.searchsorted(t.clause, t.clause[words])
                last = np.searchsorted(t.clause, t.clause[words], side="right") - 1
                cut = lambda a, b: t.buf[a:b].decode("utf-8", "replace")  # noqa: E731, B023
                rows = [
                    (ids[row[i]], cut(t.starts[a], t.ends[z]), cut(t.starts[i], t.ends[i]), "insult" if k == 1 else "threat", bool(x), bool(y), bool(s), float(v))
                    for i, a, z, k, x, y, s, v in zip(words, first, last, kind, target, negated, said, w, strict=True)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) if c[0] is not None else pa.array(c, pa.int64()) for c in map(list, zip(*rows, strict=True))], names)

    return run


def matches(docs: DataFrame, g: Grammar) -> DataFrame:
    """What the grammar finds: doc_id, clause (in lower case), word, kind, targeted, negated, reported, weight."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(tidied(_matches(g)), "doc_id long, clause string, word string, kind string, targeted boolean, negated boolean, reported boolean, weight double")


def toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """Scores of docs by the grammar that their labels teach."""
    return score(docs, fit(docs, labels, rows))
