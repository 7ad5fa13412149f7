import random

import corpus_pipeline
from harborline.llm import mixing, pii, quality

from .helpers import documents, edge_rows, sentence
from .test_jaccard_join import brute
from .test_packing import tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_do_their_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first = [tuple(x) for x in docs.collect()]
    by = dict(corpus_pipeline.STAGES)
    a = by["quality_rules"](spark, docs, SF)
    assert a.columns == docs.columns
    kept = {x.doc_id for x in quality.rules(docs).where("kept").collect()}
    rows_a = [tuple(x) for x in a.collect()]
    assert sorted(rows_a) == sorted(x for x in first if x[0] in kept) and 0.5 * len(first) < len(rows_a) < len(first)
    b = by["near_duplicates"](spark, a, SF)
    least = {i for i, _, c in brute([x[:4] for x in rows_a], 5, 80) if i == c}
    assert b.columns == docs.columns and sorted(x.doc_id for x in b.collect()) == sorted(least)
    c = by["personal_data"](spark, b, SF)
    before, after = {x.doc_id: x for x in b.collect()}, {x.doc_id: x for x in c.collect()}
    assert c.columns == docs.columns and before.keys() == after.keys()
    field = pii.train()
    for i, x in before.items():
        spans = pii.find([x.text.encode()], field)[0][1]
        assert after[i].text == pii.masked(x.text.encode(), spans) and after[i].n_chars == len(after[i].text)
        assert not pii.base_spans(after[i].text)
    d = by["mix_sources"](spark, c, SF)
    copies = {x.doc_id: x.copies for x in mixing.mix(c).collect()}
    assert d.columns == docs.columns and sorted(x.doc_id for x in d.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    e = by["packing"](spark, d, SF).collect()
    t = tokenizer()
    assert sum(x.length for x in e) == sum(len(t.encode(x.text, add_special_tokens=False).ids) + 1 for x in d.collect())


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_edges(spark):
    """Edge rows and columns of clashing names through every stage, each on the edge rows themselves."""
    rows = edge_rows() + [(50 + i, sentence(random.Random(i), 40, 4000), "en", "web") for i in range(5)]
    docs = documents(spark, rows)
    more = docs.select("*", *[docs.n_chars.alias(c) for c in ("copies", "copy", "component_id", "kept", "first", "spans")])
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, more, SF)
        assert name == "packing" or out.columns == more.columns
        got[name] = out.collect()
        assert stage(spark, more.limit(0), SF).collect() == []
    key = lambda xs: sorted((x.doc_id, x.text or "") for x in xs)
    whole = sorted((i, t or "") for i, t, *_ in rows)
    kept = [x.kept for x in quality.rules(docs).collect()]
    assert len(got["quality_rules"]) == sum(kept) and not {1, 2, 3, 4, 5, 8, 9} & {x.doc_id for x in got["quality_rules"]}
    # 7 is a copy of 6, 5 of 4, 9 stands there twice
    assert key(got["near_duplicates"]) == sorted({x for x in whole if x[0] not in (5, 7)})
    assert key(got["personal_data"]) == whole and all(x.n_chars == (None if x.text is None else len(x.text)) for x in got["personal_data"])
    assert len(got["mix_sources"]) == sum(x.copies for x in mixing.mix(docs).collect())
    assert all(x.copy == x.n_chars for x in got["mix_sources"] if x.text is not None)
    t = tokenizer()
    assert sum(x.length for x in got["packing"]) == sum(len(t.encode(text, add_special_tokens=False).ids) + 1 for _, text in whole)


def test_null_and_repeated_ids(spark):
    """Rows count, not ids: one of each group of near-duplicates stays, and the mix gives each row its own copies."""
    r = random.Random(12)
    a, b, c = (sentence(r, 60, 5000) for _ in range(3))
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows = [(9, a, "en", "web"), (9, a, "en", "web"), (9, b, "en", "web"), (None, c, "en", "web"), (None, c, "en", "web"), (4, c, "en", "web"), (None, sentence(r, 60, 5000), "en", "books")]
    by = dict(corpus_pipeline.STAGES)
    docs = documents(spark, rows).select(*columns)
    kept = by["near_duplicates"](spark, docs, SF).collect()
    assert sorted((x.doc_id or 0, x.text) for x in kept) == sorted([(9, a), (9, b), (4, c), (0, rows[-1][1])])
    mixed = mixing.mix(docs).collect()
    assert sorted(x.doc_id or 0 for x in mixed) == sorted(x[0] or 0 for x in rows)
    assert by["mix_sources"](spark, docs, SF).count() == sum(x.copies for x in mixed)
