import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from harborline.llm import packing

from .helpers import documents, edge_rows

TEXTS = ["a  b", " lead", "trail ", "tab\tand\nline\r\n\r\n  x", "it's we'll 3,000 <|endoftext|> !!", "a <|endoftext|> b", "<|endoftext|>", "x <|endoftext|><|endoftext|>  y", " <|endoftext|>\n", "é\u00a0\u2003 z", "\U0001f600 \U0001f600  ", "  ", "\n", "x y z " * 400, "   three", "a \n b", "a\x0bb \x1c c", "中文 字 符"]


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizers_library():
    t, e = tokenizer(), packing.Encoder(packing.vocabulary_path())
    texts = TEXTS + [x[1] for x in edge_rows() if x[1] and len(x[1]) < 100_000]
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert e.encode([None, ""]) == [b"", b""]
    assert np.frombuffer(e.encode(["a <|endoftext|> b"])[0], "<u2").tolist() == [64, 220, 50256, 275]


def test_special_strings_may_be_ordinary_text():
    t, e = tokenizer(), packing.Encoder(packing.vocabulary_path(), special={})
    t.encode_special_tokens = True
    assert [np.frombuffer(x, "<u2").tolist() for x in e.encode(TEXTS)] == [t.encode(x, add_special_tokens=False).ids for x in TEXTS]


def test_pieces_give_the_documents_back(spark):
    rows = edge_rows() + [(100 + i, x, "en", "web") for i, x in enumerate(TEXTS)]
    t = tokenizer()
    pieces = packing.pack(documents(spark, rows).repartition(5), sequence=64).collect()
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x, *_ in rows}
    seen = {}
    by_sequence = {}
    for p in pieces:
        ids = want[p.doc_id][p.start : p.start + p.length]
        assert len(ids) == p.length > 0 and p.doc_tokens == len(want[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen.setdefault(p.doc_id, []).append((p.start, p.length))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    times = {i: sum(r[0] == i for r in rows) for i in want}
    for i, ids in want.items():
        covered = sorted(x for s, n in seen[i] for x in range(s, s + n))
        assert covered == sorted(list(range(len(ids))) * times[i])
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, parts in by_sequence.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 64 or k == len(by_sequence) - 1


def test_empty(spark):
    assert packing.pack(documents(spark, [])).collect() == []
