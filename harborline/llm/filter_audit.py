"""How five filters of documents interact, from a sparse document-term matrix.

Words get whole numbers from a dictionary of the whole corpus, and blocks of documents become shards of a matrix in
compressed sparse rows: a row's sum is its number of words, its stored entries are its distinct words, which decide A and
B. The other flags are attached, documents are counted by part, set of failed filters and labels, and all orders of the
filters follow from those counts, not from documents.

Numbers of words are their 63-bit hashes, which every task knows without a lookup. The dictionary makes them one-to-one: it
holds every word of the corpus once, and words that share a number (about the square of their count over 2 ** 64) get
numbers below zero instead, in a table that goes to every task once it is counted. So no pair of a document and a word is
shuffled, only each task's distinct words, which it tells apart by fingerprints of 128 bits.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, column_bytes, joined, scan_words, tidied, written

LETTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2  # A: words; B, C: per cent
SYMBOLS = b"#$%&*|"
SHARED = 100_000  # words that may share a number, all in all; what goes to every task is bounded by it
ENTRIES = 1 << 20  # fingerprints a task keeps, to give a word once; beyond them a block's words are given again
BITS = 63

_SHARD = "docs array<struct<doc_id:bigint,part:string,points:bigint,capitals:bigint,symbols:bigint,same:binary>>, indptr array<bigint>, indices array<bigint>, data array<int>"
_CHECK = np.random.RandomState(77).randint(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)
_MULTIPLIER = np.uint64(0xD1342543DE82EF95)
_POWERS: dict = {}
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _spread(begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the bytes of slices, one slice after another, each byte's place in its slice, and where slices begin."""
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], sizes)
    return np.repeat(begins, sizes) + place, place, offsets


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        for name, base in (("p", int(_MULTIPLIER)), ("q", pow(int(_MULTIPLIER), -1, 1 << 64))):
            x = np.full(max(n, 1 << 20), base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["p"], _POWERS["q"]


def _checks(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of words in the order of their bytes, of other values and another base than that of scan_words."""
    out = np.zeros(len(starts), np.uint64)
    for i in range(0, len(starts), 1 << 17):
        s, e = starts[i : i + (1 << 17)], ends[i : i + (1 << 17)]
        part = b[s[0] : e[-1]]
        p, q = _powers(len(part))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CHECK[part] * p[: len(part)], out=total[1:])
        out[i : i + (1 << 17)] = (total[e - s[0]] - total[s - s[0]]) * q[s - s[0]]
    return out


def _numbers(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _entries(bits: int):
    def run(batches):
        import pyarrow as pa

        seen = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        for batch in batches:
            texts = column_bytes(batch.column("text"))
            for a, z in blocks(texts):
                buf, _ = joined(texts[a:z])
                b = np.frombuffer(buf, np.uint8)
                starts, ends, _, h = scan_words(buf)
                if not len(h):
                    continue
                c = _checks(b, starts, ends)
                first = _distinct(h, c)
                first = first[~_held(*seen, h[first], c[first])]
                if len(seen[0]) < ENTRIES:
                    both = [np.concatenate((x, y[first])) for x, y in zip(seen, (h, c), strict=True)]
                    order = np.argsort(both[0], kind="stable")  # two sorted runs
                    seen = (both[0][order], both[1][order])
                for i in range(0, len(first), 1 << 16):
                    f = first[i : i + (1 << 16)]
                    at, _, offsets = _spread(starts[f], ends[f] - starts[f])
                    words = pa.Array.from_buffers(pa.large_binary(), len(f), [None, pa.py_buffer(offsets), pa.py_buffer(b[at])])
                    yield pa.RecordBatch.from_arrays([pa.array(_numbers(h[f], bits)), words.cast(pa.binary())], ["id", "word"])

    return run


def _distinct(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Where each fingerprint (h, c) stands once, in order of h."""
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    if (same & (c[order[1:]] != c[order[:-1]])).any():  # one half of a fingerprint shared: sort by both
        order = np.lexsort((c, h))
        same = (h[order[1:]] == h[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
    return order[np.concatenate(([True], ~same))]


def _held(sorted_h: np.ndarray, its_c: np.ndarray, h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which fingerprints (h, c) are among others that are sorted by h; those that share h are looked through in turn."""
    out = np.zeros(len(h), bool)
    at, to = np.searchsorted(sorted_h, h), np.searchsorted(sorted_h, h, side="right")
    while (left := np.flatnonzero((at < to) & ~out)).size:
        out[left] = its_c[at[left]] == c[left]
        at[left] += 1
    return out


def dictionary(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(id, word), written: every word (its bytes) of every text once, with its number before shared ones are told apart."""
    texts = docs.select(F.col("text").cast("string").alias("text"))
    return written(texts.mapInArrow(tidied(_entries(bits)), "id long, word binary").distinct(), "dictionary")


def shared_numbers(words: DataFrame, most: int = SHARED) -> dict:
    """{(id, word): number} of the words that share an id: numbers from -1 downwards, none twice. More than `most` are an error."""
    several = words.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    shared = written(words.join(several, "id"), "shared")
    n = shared.count()
    if n > most:
        raise ValueError(f"{n} words share numbers: take more bits")
    return {(r.id, bytes(r.word)): -1 - i for i, r in enumerate(shared.sort("id", "word").collect())}


def _shards(shared: dict, bits: int):
    def run(batches):
        import pyarrow as pa

        special = np.array(sorted({_id for _id, _ in shared}), np.int64)
        fields = ["doc_id", "part", "points", "capitals", "symbols", "same"]
        row = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        for batch in batches:
            texts, ids, parts = column_bytes(batch.column("text")), batch.column("doc_id").cast(pa.int64()), batch.column("part")
            for a, z in blocks(texts):
                buf, begins = joined([*texts[a:z], b""])
                b, begins = np.frombuffer(buf, np.uint8), begins[:-1]  # each text ends with a line feed of its own
                count = lambda hit: np.add.reduceat(hit, begins[:-1], dtype=np.int64)  # noqa: E731, B023
                points = count((b & 0xC0) != 0x80) - 1
                capitals, symbols = count((b >= 65) & (b <= 90)), count(_IS_SYMBOL[b])
                same = pa.array([hashlib.sha256(t or b"").digest() for t in texts[a:z]], pa.binary())
                starts, ends, _, h = scan_words(buf)
                number = _numbers(h, bits)
                if len(special):
                    for i in np.flatnonzero(np.isin(number, special)).tolist():
                        number[i] = shared[int(number[i]), buf[starts[i] : ends[i]]]
                doc = np.searchsorted(begins, starts, side="right") - 1
                order = np.argsort(number)
                order = order[np.argsort(doc[order].astype(np.uint16 if z - a < 1 << 16 else np.int64), kind="stable")]
                number, doc = number[order], doc[order]
                new = np.ones(len(number), bool)
                new[1:] = (number[1:] != number[:-1]) | (doc[1:] != doc[:-1])
                at = np.flatnonzero(new)
                data = np.diff(np.append(at, len(number))).astype(np.int32)
                indptr = np.searchsorted(doc[at], np.arange(z - a + 1))
                docs = pa.StructArray.from_arrays([ids.slice(a, z - a), parts.slice(a, z - a), pa.array(points), pa.array(capitals), pa.array(symbols), same], fields)
                yield pa.RecordBatch.from_arrays([row(docs), row(pa.array(indptr.astype(np.int64))), row(pa.array(number[at])), row(pa.array(data))], ["docs", "indptr", "indices", "data"])

    return run


def matrix(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """The document-term matrix in shards, a row for each block of documents, of about a megabyte or one longer text.

    docs: the block's documents (with what the other filters count in their texts); indptr, indices, data: its rows of the
    matrix, as usual; indices are numbers of words. Null texts are empty rows.
    """
    shared = shared_numbers(dictionary(docs, bits))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(tidied(_shards(shared, bits)), _SHARD)


def flags(shards: DataFrame) -> DataFrame:
    """(doc_id, part, same, words, distinct_words, failed), written: `failed` has a bit for each of A to D that fails."""
    each = "transform(docs, (d, i) -> struct(d.doc_id as doc_id, d.part as part, d.points as points, d.capitals as capitals, d.symbols as symbols, d.same as same, get(indptr, i + 1) - get(indptr, i) as distinct_words, aggregate(slice(data, cast(get(indptr, i) + 1 as int), cast(get(indptr, i + 1) - get(indptr, i) as int)), 0L, (s, x) -> s + x) as words))"
    d = shards.select(F.explode(F.expr(each)).alias("d")).select("d.*")
    fails = [F.col("words") < LEAST_WORDS, 100 * F.col("distinct_words") < LEAST_DISTINCT * F.col("words"), 100 * F.col("capitals") > MOST_CAPITALS * F.col("points"), F.col("symbols") > 0]
    failed = sum(F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails))
    return written(d.select("doc_id", "part", "same", "words", "distinct_words", failed.cast("int").alias("failed")), "flags")


def with_copies(rows: DataFrame) -> DataFrame:
    """rows with the bit of E: a smaller id has the same text. A null id has no smaller one and is none."""
    groups = written(rows.groupBy("same").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1"), "copies")
    total = rows.count()
    hot = groups.where(F.col("n") * 1000 > total).select("same", F.col("first").alias("hot_first"))  # fewer than a thousand
    rest = groups.where(F.col("n") * 1000 <= total).select("same", "first")
    joined_ = rows.join(F.broadcast(hot), "same", "left").join(rest, "same", "left")
    later = F.coalesce(F.coalesce("hot_first", "first") < F.col("doc_id"), F.lit(False))
    return joined_.withColumn("failed", F.col("failed") + F.when(later, 1 << LETTERS.index("E")).otherwise(0)).drop("hot_first", "first")


def counted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n), written: documents by part, failed filters and labels; several labels of an id count as one, any of them."""
    grouped = rows.groupBy("doc_id", "part", "failed").agg(F.count("*").alias("n"))
    of = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))])
    both = grouped.join(of, "doc_id", "left")
    return written(both.groupBy("part", "failed", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n")), "counts")


def effects(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from counts of documents by the filters they fail.

    What a step does depends on its filter and the set of those before it: 80 cases, of which 600 rows are made.
    """
    cases = [(1 << f, prior) for f in range(5) for prior in range(32) if not prior & 1 << f]
    case = counts.withColumn("case", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.lit(p).alias("prior")) for f, p in cases]))).select("*", "case.f", "case.prior")
    fails, before = F.col("failed").bitwiseAND(F.col("f")) != 0, F.col("failed").bitwiseAND(F.col("prior")) != 0
    total = lambda hit: F.sum(F.when(hit, F.col("n")).otherwise(0)).cast("long")
    gone = fails & ~before
    sums = {"kept": ~fails & ~before, "removed": gone, "redundant": fails & before, "unique_fails": F.col("failed") == F.col("f"), "good_lost": gone & (F.col("good") == 1), "toxic_lost": gone & (F.col("toxic") == 1)}
    done = case.groupBy("part", "f", "prior").agg(*[total(hit).alias(name) for name, hit in sums.items()])
    orders_with = F.array(*[F.lit(factorial(k) * factorial(4 - k)) for k in range(5)])[F.bit_count("prior")]  # orders in which just these come before
    done = done.withColumn("shapley", F.sum(F.col("removed") * orders_with).over(Window.partitionBy("part", "f")).cast("long"))
    steps = []
    for order in permutations(range(5)):
        for k, f in enumerate(order):
            steps.append(("".join(LETTERS[x] for x in order), k + 1, 1 << f, sum(1 << x for x in order[:k])))
    rows = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, f int, prior int")
    return done.join(F.broadcast(rows), ["f", "prior"]).select("part", "filter_order", "step", *sums, "shapley")


def audit(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> DataFrame:
    """Effects of the five filters over docs in every order, by source.

    Null sources are the empty part, null texts are empty (and equal to each other). A document without a label is neither
    good nor toxic. Rows with one id are documents of their own. A table without rows gives none; further columns are
    ignored, whatever their names.
    """
    return effects(counted(with_copies(flags(matrix(docs, bits))), labels))


ORACLE_SQL = r"""with words as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
    firsts as (select t, min(doc_id) as first from words group by t),
    failing as (
      select d.doc_id, d.part, (len(w) < 200)::int as a, (100 * len(list_distinct(w)) < 50 * len(w))::int as b, (100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t))::int as c,
        regexp_matches(d.t, '[#$%&*|]')::int as d, coalesce(f.first < d.doc_id, false)::int as e from words d join firsts f on f.t = d.t),
    marks as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
    flagged as (
      select f.part, [f.a, f.b, f.c, f.d, f.e] as fails, coalesce(m.good, 0) as good, coalesce(m.toxic, 0) as toxic, count(*) as n from failing f left join marks m on m.doc_id = f.doc_id group by all),
    letters as (select * from (values ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)) as l(letter, i)),
    orders as (
      select p.letter || q.letter || r.letter || s.letter || t.letter as filter_order, [p.i, q.i, r.i, s.i, t.i] as o from letters p join letters q on q.i <> p.i join letters r on r.i not in (p.i, q.i)
        join letters s on s.i not in (p.i, q.i, r.i) join letters t on t.i not in (p.i, q.i, r.i, s.i)),
    steps as (select filter_order, o, cast(k as int) as step, o[k] as f from orders, unnest(range(1, 6)) as u(k)),
    judged as (select x.*, s.filter_order, s.step, s.f, x.fails[s.f] = 1 as now, list_sum(list_transform(s.o[1 : s.step - 1], lambda j: x.fails[j])) > 0 as earlier, list_sum(x.fails) as many from flagged x cross join steps s),
    result as (
      select part, filter_order, step, f, coalesce(sum(n) filter (not now and not coalesce(earlier, false)), 0) as kept, coalesce(sum(n) filter (now and not coalesce(earlier, false)), 0) as removed,
        coalesce(sum(n) filter (now and coalesce(earlier, false)), 0) as redundant, coalesce(sum(n) filter (now and many = 1), 0) as unique_fails,
        coalesce(sum(n) filter (now and not coalesce(earlier, false) and good = 1), 0) as good_lost, coalesce(sum(n) filter (now and not coalesce(earlier, false) and toxic = 1), 0) as toxic_lost from judged group by part, filter_order, step, f)
    select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
      cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, f) as bigint) as shapley from result"""
