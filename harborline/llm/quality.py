"""Quality rules: base text statistics and perplexity bands of a byte n-gram model.

Model. Modified Kneser-Ney over bytes inside words: a word is its bytes between white-space symbols, so a document's
perplexity says how usual its word forms are for its language. Order 5; all words of all documents are counted by Spark;
lower orders count distinct left neighbours. The documents judged are the ones the model is fitted on, so each of their
5-grams is in it with its interpolated probability, and no back-off is left to do when they are scored.

Store. A 5-gram is a 64-bit hash of (language, bytes) with its log probability as a whole number of 2 ** -24. The most
frequent 5-grams, at most `head`, are one sorted hash array in every task, searched by numpy: a fixed number, whatever the
corpus. Rarer ones of a document, few as they are, travel with its row and meet their probabilities by a join. Sums of whole
numbers do not depend on the split, so the result is the same, bit for bit, for any `head`.

Bands. For each language, the log perplexity of all its documents (in steps of 1e-3, so a few thousand at most) gives quartiles; documents below
q1 - low x spread or above q3 + high x spread are rejected (spread: the quartile distance, at least `floor`, times
sqrt(1 + short / words), for a short text's perplexity varies more). A language with fewer than `min_docs` documents takes
the quartiles of all documents.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U, blocks, chain, column_bytes, discard, few, joined, mapped, mix, scan_words, written

ORDER = 5
PAD = 32  # the white space before and after a word
SYMBOLS = 256
UNIT = 1 << 24  # log probabilities are whole numbers of 1 / UNIT
LANG = "lang_key"  # '' for a null language, else = and the language
MIN_WORDS, REPEAT_PERCENT = 10, 20
HEAD = 2_000_000  # n-grams in the arrays, 12 bytes each
SLICE = 1024  # documents whose texts a task copies at once
ROWS = 1 << 16  # n-grams that a task sends at once


def lang_seed(lang: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.md5(lang.encode()).digest()[:8], "little")


def hashed(seed, key):
    """Hash of an ORDER-gram (its bytes as an integer) of a language."""
    return mix((key + (U(ORDER) << U(56))) ^ seed)


class Words:
    """Words of a block of documents: where they are, whose they are, and the distinct (word, language) pairs."""

    def __init__(self, texts: list, langs: list):
        self.buf, self.begins = joined(texts)
        self.starts, self.ends, self.chars, self.hashes = scan_words(self.buf)
        self.doc = np.searchsorted(self.begins, self.starts, "right") - 1
        names = sorted(set(langs))
        seeds = np.array([lang_seed(x) for x in names], U)
        self.names = names
        self.lang = np.searchsorted(np.array(names), np.array(langs)) if names else np.zeros(0, int)
        of_word = self.lang[self.doc]
        _, self.first, self.inverse, self.counts = np.unique(self.hashes ^ seeds[of_word] if len(of_word) else self.hashes, return_index=True, return_inverse=True, return_counts=True)
        self.word_lang = of_word[self.first]
        self.seeds = seeds

    def grams(self):
        """Of the distinct words: n-gram keys of ORDER, one for each byte and the end, and where each word's begin."""
        starts, size = self.starts[self.first], self.ends[self.first] - self.starts[self.first]
        full = size + ORDER  # ORDER - 1 pads before, one after
        at = np.concatenate(([0], np.cumsum(full)))
        symbols = np.full(at[-1] + ORDER, PAD, np.uint8)
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        symbols[np.repeat(at[:-1] + ORDER - 1, size) + inner] = np.frombuffer(self.buf, np.uint8)[np.repeat(starts, size) + inner]
        n = size + 1
        where = np.repeat(at[:-1], n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        keys = np.zeros(len(where), U)
        for i in range(ORDER):
            keys = (keys << U(8)) | symbols[where + i].astype(U)
        return keys, np.cumsum(n) - n, n


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_batches(batches):
    import pyarrow as pa

    held: dict[str, list] = {}

    def rows(lang):
        keys, counts = _summed(*(np.concatenate(x) for x in zip(*held.pop(lang), strict=True)))
        for i in range(0, len(keys), ROWS):
            n = len(keys[i : i + ROWS])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(keys[i : i + n].view(np.int64)), pa.array(counts[i : i + n])], ["lang", "gram", "n"])

    waiting = 0
    for batch in batches:
        texts, langs = column_bytes(batch.column("text")), batch.column(LANG).to_pylist()
        for i, j in blocks(texts):
            w = Words(texts[i:j], langs[i:j])
            if not len(w.first):
                continue
            keys, _, n = w.grams()
            lang, count = np.repeat(w.word_lang, n), np.repeat(w.counts, n)
            for k in range(len(w.names)):
                if (mine := lang == k).any():
                    held.setdefault(w.names[k], []).append(_summed(keys[mine], count[mine]))
                    waiting += len(held[w.names[k]][-1][0])
            if waiting > 2_000_000:  # pairs held: merge, and send what does not shrink
                for x in held:
                    held[x] = [_summed(*(np.concatenate(y) for y in zip(*held[x], strict=True)))]
                waiting = sum(len(v[0][0]) for v in held.values())
                if waiting > 1_000_000:
                    for x in list(held):
                        yield from rows(x)
                    waiting = 0
    for x in list(held):
        yield from rows(x)


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): ORDER-byte n-grams of all words of all texts, a language at a time; summed in each task first."""
    parts = mapped(docs.select("text", LANG).where("text is not null"), _count_batches, "lang string, gram long, n long", SLICE)
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, gram, n, logp) of counts (lang, gram, n): interpolated modified Kneser-Ney.

    logp: log probability of an ORDER-gram's last byte after the others. All work is grouped sums and equi-joins; the
    discounts, five rows a language, are broadcast if they are at most 100,000.
    """
    level = counts.select("lang", "gram", F.col("n").cast("double").alias("c"))
    adjusted = level.withColumn("ord", F.lit(ORDER))
    for o in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.expr(f"gram & {(1 << 8 * o) - 1}L").alias("gram")).agg(F.count("*").cast("double").alias("c"))
        adjusted = adjusted.unionByName(level.withColumn("ord", F.lit(o)))
    t = written(adjusted.withColumn("context", F.expr("shiftright(gram, 8)")), "adjusted")
    by = t.groupBy("lang", "ord").agg(*[F.sum(F.when(F.col("c") == k, 1.0).otherwise(0.0)).alias(f"t{k}") for k in (1, 2, 3, 4)])
    y = F.expr("coalesce(t1 / nullif(t1 + 2 * t2, 0), 0.5D)")
    steps = by.select("lang", "ord", *[F.greatest(F.lit(0.05 * k), F.least(F.lit(0.95 * k), F.coalesce(F.expr(f"{k}D") - (k + 1) * y * F.expr(f"t{k + 1} / nullif(t{k}, 0)"), F.lit(0.5 * k)))).alias(f"d{k}") for k in (1, 2, 3)])
    steps = written(steps, "steps")
    t = t.join(few(steps, 100_000), ["lang", "ord"]).withColumn("cut", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")))
    contexts = t.groupBy("lang", "ord", "context").agg(F.sum("c").alias("total"), (F.sum("cut") / F.sum("c")).alias("back"))
    t = t.join(contexts, ["lang", "ord", "context"]).select("lang", "ord", "gram", "c", ((F.col("c") - F.col("cut")) / F.col("total")).alias("own"), "back")
    t = written(t, "discounted")
    p = t.where("ord = 1").select("lang", "gram", (F.col("own") + F.col("back") / SYMBOLS).alias("p"))
    for o in range(2, ORDER + 1):
        mine = t.where(f"ord = {o}").withColumn("suffix", F.expr(f"gram & {(1 << 8 * (o - 1)) - 1}L"))
        p = mine.join(p.select("lang", F.col("gram").alias("suffix"), "p"), ["lang", "suffix"]).select("lang", "gram", "c", (F.col("own") + F.col("back") * F.col("p")).alias("p"))
    return p.select("lang", "gram", F.col("c").cast("long").alias("n"), F.ln("p").alias("logp"))


def _hash_rows(batches):
    import pyarrow as pa

    for b in batches:
        langs = b.column("lang").to_pylist()
        seeds = {x: lang_seed(x) for x in set(langs)}
        key = b.column("gram").to_numpy(zero_copy_only=False).astype(np.int64).astype(U)
        h = hashed(np.array([seeds[x] for x in langs], U), key)
        score = np.rint(b.column("logp").to_numpy(zero_copy_only=False) * UNIT).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), b.column("n"), pa.array(score)], ["hash", "n", "score"])


class HashArrays:
    """The most frequent ORDER-grams: a sorted array of 64-bit hashes, and one of their log probabilities."""

    def __init__(self, hashes: np.ndarray, scores: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.scores = hashes[order], scores[order].astype(np.int32)

    @staticmethod
    def collect(model: DataFrame) -> HashArrays:
        """Of rows whose number has a bound: 12 bytes an n-gram travel."""
        t = model.select("hash", F.col("score").cast("int").alias("score")).toArrow()
        return HashArrays(t["hash"].to_numpy().astype(U), t["score"].to_numpy())

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities in 1 / UNIT, 0 where a hash is not held, and which are held."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        held = self.hashes[at] == h
        return np.where(held, self.scores[at], 0).astype(np.int64), held


def split_model(model: DataFrame, head: int) -> tuple[HashArrays, DataFrame | None]:
    """The n-grams from some count on, at most `head`, as arrays; the others as a frame (hash, score), None if there are none."""
    total = model.count()
    least = 0
    if total > head:
        by = model.groupBy("n").count().orderBy(F.desc("n")).limit(head + 1)  # so many different counts cannot all fit
        run = by.withColumn("so_far", F.sum("count").over(Window.orderBy(F.desc("n"))))
        least = (run.where(F.col("so_far") <= head).agg(F.min("n")).first()[0]) or (1 << 62)
    return HashArrays.collect(model.where(F.col("n") >= least)), model.where(F.col("n") < least).select("hash", "score") if total > head else None


def repeated_words(hashes: np.ndarray, doc: np.ndarray, width: int = 5) -> np.ndarray:
    """Which words lie in a `width`-word window that its document holds twice or more."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(len(hashes), bool)
    keys = chain([hashes[i : i + n] for i in range(width)]) ^ mix(doc[:n].astype(U) + U(1))
    keys = keys[same := doc[:n] == doc[width - 1 :]]
    at = np.flatnonzero(same)
    order = np.argsort(keys)
    twin = keys[order][1:] == keys[order][:-1]
    hit = np.zeros(len(keys), bool)
    hit[order[1:][twin]] = hit[order[:-1][twin]] = True
    change = np.zeros(len(hashes) + 1, np.int32)
    np.add.at(change, at[hit], 1)
    np.add.at(change, at[hit] + width, -1)
    return np.cumsum(change[:-1]) > 0


def _statistics(model):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        m, row = model.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts, langs = batch.column("doc_id").to_pylist(), column_bytes(batch.column("text")), batch.column(LANG).to_pylist()
            for i, j in blocks(texts):
                w, size = Words(texts[i:j], langs[i:j]), j - i
                n = np.bincount(w.doc, minlength=size)
                lines = [[x for x in t.split(b"\n") if x.strip()] if t and b"\n" in t else () for t in texts[i:j]]
                total, rare = np.zeros(size, np.int64), [None] * size
                if len(w.first):
                    keys, at, k = w.grams()
                    h = hashed(np.repeat(w.seeds[w.word_lang], k), keys)
                    score, held = m.look_up(h)
                    words = np.add.reduceat(score, at)
                    np.add.at(total, w.doc, words[w.inverse])
                    if not held.all():
                        rare = _rare_of(size, w, h, held, at, k)
                cols = {
                    "row": pa.array(np.arange(row, row + size)), "doc_id": pa.array(ids[i:j], pa.int64()), LANG: pa.array(langs[i:j], pa.string()), "n_words": pa.array(n.astype(np.int64)),
                    "word_chars": pa.array(np.bincount(w.doc, weights=w.chars, minlength=size).astype(np.int64)),
                    "n_symbols": pa.array([len(t) - len(t.translate(None, b"#*$%&|<>")) if t else 0 for t in texts[i:j]], pa.int64()),
                    "n_dup_lines": pa.array([len(x) - len(set(x)) for x in lines], pa.int64()),
                    "n_repeat_words": pa.array(np.bincount(w.doc, weights=repeated_words(w.hashes, w.doc), minlength=size).astype(np.int64)),
                    "n_grams": pa.array(np.bincount(w.doc, weights=w.ends - w.starts + 1, minlength=size).astype(np.int64)),
                    "score": pa.array(total), "rare": pa.array(rare, pa.list_(pa.int64())),
                }
                row += size
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def _rare_of(size: int, w: Words, h: np.ndarray, held: np.ndarray, at: np.ndarray, k: np.ndarray) -> list:
    """For each document, the hashes of its n-grams that the arrays do not hold, as often as they stand there; None if none."""
    missing = np.flatnonzero(~held)
    of_word = np.repeat(np.arange(len(k)), k)[missing]  # distinct words, in order
    n = np.bincount(of_word, minlength=len(k))
    begin = np.cumsum(n) - n
    times = n[w.inverse]  # of each word as it stands
    out = h[missing[np.repeat(begin[w.inverse], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]].view(np.int64)
    each = np.bincount(w.doc, weights=times, minlength=size).astype(np.int64)
    return [x if len(x) else None for x in np.split(out, np.cumsum(each)[:-1])]


_SCHEMA = f"row long, doc_id long, {LANG} string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_grams long, score long, rare array<long>"


def statistics(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """Base statistics and log perplexity per symbol of every document, under a model of all these documents."""
    spark = docs.sparkSession
    key = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), key.alias(LANG))
    counts = written(count_grams(d), "grams")
    model = written(mapped(kneser_ney(counts), _hash_rows, "hash long, n long, score long"), "model")
    discard(counts)
    arrays, others = split_model(model, head)
    s = written(mapped(d, _statistics(spark.sparkContext.broadcast(arrays)), _SCHEMA, SLICE), "statistics")
    total = F.col("score")
    if others is not None:
        rare = s.where("rare is not null").select("row", F.explode("rare").alias("hash")).groupBy("row", "hash").agg(F.count("*").alias("times"))
        more = rare.join(others, "hash").groupBy("row").agg(F.sum(F.expr("times * score")).alias("more"))
        s = s.join(more, "row", "left")
        total = total + F.coalesce("more", F.lit(0))
    return s.withColumn("log_ppl", F.when(F.col("n_grams") > 0, -total / F.lit(float(UNIT)) / F.col("n_grams"))).drop("row", "score", "rare", "more", "n_grams")


def quartiles(scored: DataFrame, step: float = 1e-3) -> DataFrame:
    """(LANG, docs, q1, q3) of each language's log_ppl, in steps; exact whatever the partitions, from counts of steps."""
    steps = scored.groupBy(LANG, F.round(F.col("log_ppl") / step).cast("long").alias("at")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(LANG).orderBy("at"))
    steps = steps.withColumn("upto", upto).withColumn("docs", F.sum("n").over(Window.partitionBy(LANG)))
    q = [F.min(F.when(F.col("upto") >= F.ceil(F.col("docs") * share), F.col("at") * step)).alias(name) for name, share in (("q1", 0.25), ("q3", 0.75))]
    return steps.groupBy(LANG).agg(F.max("docs").alias("docs"), *q)


def rules(docs: DataFrame, low: float = 2.0, high: float = 3.0, floor: float = 0.02, short: float = 100.0, min_docs: int = 50, head: int = HEAD) -> DataFrame:
    """One row for each document: base statistics, base_failed, log_ppl, its band, kept.

    Model and bands are fitted on these very documents. Null or empty texts, and texts without words, have zeros, no
    log_ppl and fail the base rule. A null language is a language of its own. A document on the edge of its band is kept;
    equal texts of a language have equal results. Very long texts are read whole, one at a time. Repeated and null doc_ids
    give a row each. Empty tables give no rows. Other columns are ignored.
    """
    s = statistics(docs, head).withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {REPEAT_PERCENT} * n_words"))
    s = written(s, "quality")
    scored = s.where("log_ppl is not null and not base_failed")
    overall = quartiles(scored.withColumn(LANG, F.lit("all"))).first()
    every = [F.lit(float(overall[x] if overall else 0.0)) for x in ("q1", "q3")]
    short_of = F.col("docs") < min_docs
    bands = quartiles(scored).select(F.col(LANG).alias("band_lang"), F.when(short_of, every[0]).otherwise(F.col("q1")).alias("q1"), F.when(short_of, every[1]).otherwise(F.col("q3")).alias("q3"))
    out = s.join(bands, s[LANG] == bands["band_lang"], "left").drop("band_lang", LANG)
    wide = F.greatest(F.col("q3") - F.col("q1"), F.lit(floor)) * F.sqrt(1 + short / F.greatest(F.col("n_words"), F.lit(1)))
    out = out.withColumn("ppl_low", F.col("q1") - low * wide).withColumn("ppl_high", F.col("q3") + high * wide).drop("q1", "q3")
    inside = F.coalesce((F.col("log_ppl") >= F.col("ppl_low")) & (F.col("log_ppl") <= F.col("ppl_high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside)
