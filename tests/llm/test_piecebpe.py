"""Piece codec against the sentencepiece library: ids, spans, texts, normalisers."""

import random
import time
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from reelspark.llm import bytebpe, piecebpe, queries
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs

PIECES = ["a", "b", "Don't", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", "É", "123", "!?", "<s>", "<0x41>", "\0", "中文", "X", "\n\n",
          "ΑΣ", "İ", "\xa0", "\U0001f600", "é", "aaaa", "▁", "▁▁", "½", "the", " x", " \n", "据数", "ال", "    ", "Привет",
          "://", "();", "ＡＢ", "㍿"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    odd = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    runs = ["".join(rng.choice("abé! ▁") for _ in range(rng.randint(1, 200))) for _ in range(300)]
    wild = ["".join(chr(rng.choice([rng.randint(1, 0x7F), rng.randint(0x80, 0x7FF), rng.randint(0x10000, 0x10FFFF)])) for _ in range(20))
            for _ in range(500)]
    return odd + runs + wild + ["", " ", "▁", "word " * 3000, "x" * 5000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=bytebpe.tokenizer_path(piecebpe.PIECE_BPE))


def test_ids_spans_and_texts_equal_the_library(texts, library):
    c = piecebpe.PieceCodec()
    for t in texts:
        ids, bounds = c.encode(t)
        proto = library.encode(t, return_type="proto")
        assert ids.tolist() == [p.id for p in proto.pieces], t[:80]
        assert list(zip(bounds[:-1].tolist(), bounds[1:].tolist())) == [(p.begin, p.end) for p in proto.pieces], t[:80]
        assert c.decode(ids) == library.decode(ids.tolist())
    assert c.encode(None)[0].tolist() == [] and c.encode(None)[1].tolist() == [0] and c.decode(None) == ""


def test_any_ids_decode_as_in_the_library(library):
    c, rng = piecebpe.codec(), random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(32000) if rng.random() < .5 else rng.randrange(260) for _ in range(rng.randint(1, 8))]
        assert c.decode(ids) == library.decode(ids), ids


def test_both_merges_agree(texts):
    c = piecebpe.codec()
    for t in texts[3000:3300]:
        t = t.replace(" ", "▁")
        assert c._merge(list(t)) == c._merge_long(t)


def test_small_caches_change_nothing(texts, library, monkeypatch):
    monkeypatch.setattr(piecebpe, "CACHE_CHUNKS", 3)
    c = piecebpe.PieceCodec()
    assert [c.encode(t)[0].tolist() for t in texts[:500]] == library.encode(texts[:500])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("flags", [{}, {"remove_extra_whitespaces": False}, {"add_dummy_prefix": False}, {"escape_whitespaces": False}])
def test_normalisers_equal_the_library(texts, rule, flags):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, **flags)
    spec = sentencepiece_model_pb2.NormalizerSpec()
    spec.ParseFromString(lib.serialized_normalizer_spec())
    mine = piecebpe.Normaliser(spec)
    for t in [*texts[:600], "  ", " a  b ", "ＡＢ  ㍿ é "]:
        norm, place = mine.align(t)
        want, offsets = lib.normalize(t, with_offsets=True)
        assert norm == want, t
        if want:
            begins = np.cumsum([0, *(len(x.encode()) for x in t)])
            ends = np.cumsum([0, *(len(x.encode()) for x in norm)])
            assert place[ends].tolist() == [int(begins[k]) for k in offsets], t


ROWS = [(5, "Hello there, world.\nA second line"), (1, None), (2, ""), (9, "  two  spaces <s> x"), (9, "tie"), (9, "tie"),
        (None, "no id"), (3, "long é▁ " * 2000)]


def test_columns(spark, library):
    d = docs(spark, ROWS, decoded=1, ids="clash", bounds="clash")
    rows = piecebpe.round_trip(d).collect()
    assert len(rows) == len(ROWS) and "text" not in rows[0].asDict()
    want = sorted((library.encode(t or ""), library.decode(library.encode(t or ""))) for _, t in ROWS)
    assert sorted((list(r["ids"]), r["decoded"]) for r in rows) == want
    source = {tuple(library.encode(t or "")): (t or "").encode() for _, t in ROWS}
    for r in rows:  # the spans cover the text without gap or overlap
        raw, b = source[tuple(r["ids"])], r["bounds"]
        assert b"".join(raw[x:y] for x, y in zip(b, b[1:])) == raw
    encoded = piecebpe.encode(d)
    assert sorted(r["decoded"] for r in piecebpe.decode(encoded).collect()) == sorted(x for _, x in want)
    assert piecebpe.round_trip(docs(spark, [])).collect() == []


def test_long_runs_stay_near_linear():
    c, spent = piecebpe.PieceCodec(), []
    for n in (20_000, 80_000):
        start = time.process_time()
        for s in ("a" * n, " " * n, "ab\n" * (n // 3)):
            c.encode(s)
        spent.append(time.process_time() - start)
    assert spent[1] < 8 * spent[0] + 0.5


def test_other_models_are_refused(tmp_path):
    with open(bytebpe.tokenizer_path(piecebpe.PIECE_BPE), "rb") as f:
        model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piecebpe.PieceCodec(str(tmp_path / "m.model"))


def test_registered_query_on_the_whole_table(spark, library):
    d = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op13_piece_roundtrip(spark, SF_SMALL).collect()
    assert len(rows) == len(d)
    for r in rows:
        ids = library.encode(d[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(library.decode(ids).encode()).hexdigest()
