import random

from harborline.llm import token_counts

from .helpers import documents, edge_rows

SCHEMA = "op string, doc_id long, source string, lang string, tokenizer_version string, tokens long"


def test_counts(spark):
    from .test_packing import tokenizer

    t, rows = tokenizer(), edge_rows()
    got = [(x.doc_id, x.source, x.tokens) for x in token_counts.counted(documents(spark, rows)).collect()]
    want = [(i, s, len(t.encode(x or "", add_special_tokens=False).ids)) for i, x, _, s in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


class Plain:
    """The ledger's rules over a dict."""

    def __init__(self):
        self.docs, self.done = {}, set()

    def commit(self, name, rows):
        if name in self.done:
            return
        self.done.add(name)
        last = {}
        flat = []
        for op, d, s, lang, v, n in rows:
            if d is None or op not in ("insert", "revise", "delete"):
                continue
            versions = [v] if v is not None else [x for y, x in self.docs if y == d] if op == "delete" else []
            flat += [(op, d, s, lang, x, n or 0) for x in versions]
        for op, d, s, lang, v, n in flat:
            rank = (op == "delete", n, s is not None, s or "", lang is not None, lang or "")
            if (d, v) not in last or rank > last[d, v][0]:
                last[d, v] = (rank, op, s, lang, n)
        for key, (_, op, s, lang, n) in last.items():
            self.docs.pop(key, None)
            if op != "delete":
                self.docs[key] = (s, lang, n)

    def totals(self):
        out = {}
        for (_, v), (s, lang, n) in self.docs.items():
            a, b = out.get((s, lang, v), (0, 0))
            out[s, lang, v] = (a + 1, b + n)
        return sorted(((*k, *n) for k, n in out.items()), key=repr)


def test_ledger_follows_the_plain_rules(spark, tmp_path):
    r = random.Random(4)
    ledger, plain = token_counts.Ledger(spark, str(tmp_path / "ledger")), Plain()
    for b in range(4):
        rows = [(r.choice(["insert", "insert", "revise", "delete", None]), r.choice([None, *range(12)]), r.choice(["web", "books", None]), r.choice(["en", None]), r.choice(["v1", "v1", "v2", None]), r.choice([None, *range(50)])) for _ in range(30)]
        changes = spark.createDataFrame(rows, SCHEMA)
        assert ledger.commit(f"b{b}", changes)
        assert not ledger.commit(f"b{b}", changes)  # delivered again
        plain.commit(f"b{b}", rows)
        assert sorted((tuple(x) for x in ledger.totals().collect()), key=repr) == plain.totals()


def test_a_broken_batch_is_written_anew(spark, tmp_path):
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    rows = [("insert", 1, "web", "en", "v1", 5)]
    changes = spark.createDataFrame(rows, SCHEMA)
    changes.drop("op").write.parquet(str(tmp_path / "ledger/batch=b0/rows"))  # rows without totals: no commit
    assert ledger.batches() == []
    assert ledger.commit("b0", changes)
    assert [tuple(x) for x in ledger.totals().collect()] == [("web", "en", "v1", 1, 5)]


def test_empty(spark, tmp_path):
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.totals().collect() == []
    assert ledger.commit("none", spark.createDataFrame([], SCHEMA))
    assert ledger.totals().collect() == []
    assert token_counts.counted(documents(spark, [])).collect() == []


def test_compaction_keeps_totals_names_and_later_changes(spark, tmp_path):
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    first = spark.createDataFrame([("insert", 1, "web", "en", "v1", 5), ("insert", 2, None, None, "v1", 7)], SCHEMA)
    second = spark.createDataFrame([("revise", 1, "books", "en", "v1", 9), ("delete", 2, None, None, None, 0)], SCHEMA)
    ledger.commit("a", first)
    ledger.commit("b", second)
    for name in ("m1", "m2"):
        ledger.compact(name)
        assert [tuple(x) for x in ledger.totals().collect()] == [("books", "en", "v1", 1, 9)]
        assert not ledger.commit("a", first) and not ledger.commit("b", second)
    assert [x.name for x in (tmp_path / "ledger").iterdir()] == ["batch=m2"]
    assert ledger.commit("c", spark.createDataFrame([("delete", 1, None, None, "v1", 0)], SCHEMA))
    assert ledger.totals().collect() == []


def test_documents_are_counted_once_in_a_commit(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    schema = SCHEMA
    changes = spark.createDataFrame([("insert", i, "web", "en", "v1", i) for i in range(50)], schema).mapInArrow(count, schema)
    token_counts.Ledger(spark, str(tmp_path / "ledger")).commit("a", changes)
    assert seen.value == 50
