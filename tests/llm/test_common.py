import random
import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from harborline.llm import common, pii, quality


class Held:
    """What a task holds until its end."""


def test_memory_goes_back_when_a_task_has_ended(monkeypatch):
    refs, gone = [], []

    class Pool:
        def release_unused(self):
            gone.append(refs[0]() is None)

    def run(batches):
        held = Held()
        refs.append(weakref.ref(held))
        yield from batches
        del batches

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    batch = pa.RecordBatch.from_pydict({"x": list(range(10))})
    assert sum(b.num_rows for b in common.tidied(run)(iter([batch, batch]))) == 20
    assert gone == [False, False, True]


def test_batches_come_in_slices():
    batch = pa.RecordBatch.from_pydict({"x": list(range(10))})
    out = list(common.tidied(lambda batches: batches, 4)(iter([batch, batch.slice(0, 0), batch])))
    assert [b.num_rows for b in out] == [4, 4, 2] * 2
    assert [x for b in out for x in b.column("x").to_pylist()] == list(range(10)) * 2
    assert [b.num_rows for b in common.tidied(lambda batches: batches)(iter([batch]))] == [10]


def _sizes(field, redact):
    """In the place of pii._rows: the bytes that a batch holds instead of its texts."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield b.set_column(0, "text", pa.array([str(b.get_total_buffer_size())] * b.num_rows))

    return run


def test_batches_are_cut_by_bytes(spark, monkeypatch):
    """3,000 texts of 10 KB in one task: no batch holds them all, and a limit that the session has set stays."""
    monkeypatch.setattr(pii, "_rows", _sizes)
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))

    def sizes():
        out = [int(x.text) for x in pii.redacted(docs, "no field").collect()]
        assert len(out) == 3000
        return out

    spark.conf.unset(common.BATCH_LIMIT)
    assert max(sizes()) <= 3 * common.BATCH_BYTES
    spark.conf.set(common.BATCH_LIMIT, str(1 << 17))
    try:
        assert max(sizes()) <= 3 << 17
        assert spark.conf.get(common.BATCH_LIMIT) == str(1 << 17)
    finally:
        spark.conf.unset(common.BATCH_LIMIT)


def test_ngrams_are_sent_in_slices():
    """A task with 100,000 words of its own sends its n-grams some at a time, each once and with its count."""
    r = random.Random(5)
    text = " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(100_000))
    batch = pa.RecordBatch.from_pydict({"text": [text, text, "a b"], quality.LANG: ["=en", "=en", "=de"]})
    out = list(quality._count_batches(iter([batch])))
    assert max(b.num_rows for b in out) <= 1 << 16
    rows = [(x["lang"], x["gram"]) for b in out for x in b.to_pylist()]
    assert len(rows) == len(set(rows)) > 200_000
    assert sum(n for b in out for n in b.column("n").to_pylist()) == 2 * 9 * 100_000 + 4


def test_words_do_not_depend_on_steps():
    r = random.Random(6)
    buf = " ".join("w" * r.choice((1, 3, 9, 40_000 if i % 100 == 0 else 5)) + str(i) for i in range(60_000)).encode() + b" " + b"y" * 700_000
    for a, b in zip(common.scan_words(buf), common.scan_words(buf, step=1 << 20), strict=True):
        assert np.array_equal(a, b)
