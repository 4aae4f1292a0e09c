"""BPE codec, token counts and token files against the tokenizers library."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from reelspark.llm import bpe, bytebpe, queries, tokencount, tokenfile
from reelspark.llm.common import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs

PIECES = ["a", "b", "Don't", "'s", " ", "  ", "\n", "\t", "\x1c", " ", "\x85", "É", "123", "!?", "<|endoftext|>",
          "<|startoftext|>", "\0", "中文", "X", "\n\n", "ΑΣ", "İ", "\xa0", "\U0001f600", "é", "᠎", "aaaa",
          "</w>", "½", "ª", "the", " x", " \n"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    odd = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    runs = ["".join(rng.choice("abé! ") for _ in range(rng.randint(1, 40))) for _ in range(1000)]
    return odd + runs + ["", "word " * 3000, "x" * 5000]


def library(name):
    return Tokenizer.from_file(bytebpe.tokenizer_path(name))


def test_bpe_ids_and_text_equal_the_library(texts):
    c, d, t = bpe.encoder(), bpe.decoder(), library(bpe.WORD_BPE)
    for text, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        packed = c.encode_packed(text)
        assert np.frombuffer(packed, "<u4").tolist() == e.ids, text[:80]
        assert d.decode_packed(packed).decode() == t.decode(e.ids, skip_special_tokens=False)
    assert c.encode_packed(None) == b"" and d.decode_packed(None) == b""


def test_bpe_columns(spark):
    t = library(bpe.WORD_BPE)
    d = docs(spark, ROWS, decoded=1, ids="clash")
    rows = bpe.round_trip(d, lists=True).collect()
    assert len(rows) == len(ROWS) and "text" not in rows[0].asDict()
    want = sorted((x, t.decode(x, skip_special_tokens=False)) for x in (t.encode(v or "", add_special_tokens=False).ids for _, v in ROWS))
    assert sorted((list(r["ids"]), r["decoded"]) for r in rows) == want
    again = bpe.decode(bpe.encode(d)).collect()
    assert sorted(r["decoded"] for r in again) == sorted(x for _, x in want)
    assert bpe.round_trip(docs(spark, [])).collect() == []


def test_backtracking_equals_greedy_where_greedy_is_valid():
    m = bpe.encoder().merges
    for word in ("hello", "backtracking", "aaaaaaaa"):
        symbols = word[:-1] + chr(ord(word[-1]) + 0x100)
        assert m.encode(symbols) == m.backtrack(symbols)


def test_chunk_ids_equal_the_library(texts):
    t = library(bytebpe.BYTE_BPE)
    coder = bytebpe.ChunkCoder(bytebpe.BYTE_BPE, list, "test-ids", cache_entries=500)
    got = [sum(v, []) for v in coder.encode([*texts, None])]
    assert got[-1] == []
    for text, e, g in zip(texts, t.encode_batch(texts, add_special_tokens=False), got):
        assert g == e.ids, text[:80]


ROWS = [(5, "Hello there, world.\nA second line"), (1, None), (2, ""), (9, "  two  spaces <|endoftext|> x"), (9, "tie"), (9, "tie"),
        (None, "no id"), (3, "long " * 2000)]


def test_token_counts(spark):
    t = library(bytebpe.BYTE_BPE)
    d = docs(spark, ROWS, n_tokens=7, chunk="clash")
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"])
                 for r in tokencount.token_counts(d).collect())
    want = sorted((-1 if i is None else i, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids),
                   len(t.encode(x or "", add_special_tokens=False).ids) > 1024) for i, x in ROWS)
    assert got == want
    assert tokencount.token_counts(docs(spark, [])).collect() == []


def test_counts_do_not_depend_on_the_frequent_table(spark):
    d = docs(spark, ROWS)
    count = tokencount.token_count_udf(spark, [])
    plain = sorted(r[0] for r in d.select(count("text")).collect())
    assert plain == sorted(r["n_tokens"] for r in tokencount.token_counts(d).collect())


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, encoding):
    t = library(bytebpe.BYTE_BPE)
    path = scratch_path(spark, "test-tokens")
    tokenfile.write_token_files(tokenfile.encode_sorted(docs(spark, ROWS, ids=1)), path, encoding)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"]), r["n_tokens"], r["ids_crc32"])
                 for r in tokenfile.token_digest(spark, path).collect())
    ids = {x: np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4") for _, x in ROWS}
    assert sorted((n, c) for _, n, c in got) == sorted((len(ids[x]), zlib.crc32(ids[x].tobytes())) for _, x in ROWS)
    at = 0
    for (_, _, start), n, _ in got:  # ascending ids, the null one first
        assert start == at
        at += n
    # metadata alone can be read
    meta = tokenfile.read_tokens(spark, path, ("doc_id", "n_tokens"))
    assert "ids" not in meta.columns and meta.count() == len(ROWS)


def test_empty_token_files(spark):
    path = scratch_path(spark, "test-no-tokens")
    tokenfile.write_token_files(tokenfile.encode_sorted(docs(spark, [])), path)
    assert tokenfile.token_digest(spark, path).collect() == []


def test_token_files_have_page_indexes(spark, tmp_dir):
    import glob

    import pyarrow.parquet as pq
    path = tmp_dir + "/tokens"
    tokenfile.write_token_files(tokenfile.encode_sorted(docs(spark, ROWS)), path)
    for f in glob.glob(path + "/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            assert meta.row_group(g).column(0).has_column_index and meta.row_group(g).column(0).has_offset_index


def test_registered_queries_on_whole_tables(spark):
    d = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    t, b = library(bpe.WORD_BPE), library(bytebpe.BYTE_BPE)
    for r in queries.op6_bpe_roundtrip(spark, SF_SMALL).collect():
        ids = t.encode(d[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    at = 0
    for r in sorted(queries.op7_token_files(spark, SF_SMALL).collect(), key=lambda r: r["doc_id"]):
        ids = np.array(b.encode(d[r["doc_id"]] or "", add_special_tokens=False).ids + [0], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    rows = queries.op8_token_counts(spark, SF_SMALL).collect()
    assert len(rows) == len(d) and all(r["n_tokens"] == len(b.encode(d[r["doc_id"]] or "", add_special_tokens=False).ids) for r in rows)


def test_files_are_whole_under_a_record_limit(spark):
    d = docs(spark, [(i, "word " * (i % 7)) for i in range(200)])
    starts = []
    for limit in ("0", "7"):
        spark.conf.set("spark.sql.files.maxRecordsPerFile", limit)
        try:
            path = scratch_path(spark, "test-limit")
            tokenfile.write_token_files(tokenfile.encode_sorted(d), path)
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        starts.append(sorted((r["doc_id"], r["start"]) for r in tokenfile.token_digest(spark, path).collect()))
    assert starts[0] == starts[1]


def test_two_generations_keep_what_is_asked_for():
    from reelspark.llm.common import TwoGenerations
    c = TwoGenerations(2)
    for k in range(6):
        c.put(k, k)
        c.get(0)
    assert c.get(0) == 0 and c.get(1) is None and len(c) <= 4


def test_old_chunks_come_back(texts):
    coder = bytebpe.ChunkCoder(bytebpe.BYTE_BPE, list, "test-old", {"the": [262]}, cache_entries=20)
    first = [sum(v, []) for v in coder.encode(texts[:1000])]
    assert [sum(v, []) for v in coder.encode(texts[:1000])] == first
    assert len(coder.young) <= 20 + 1 + max(len(coder._flat_chunks(t)) for t in texts[:1000]) * 1000


def packed_ids(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("large", [False, True])
def test_id_lists_equal_the_library(texts, large, monkeypatch):
    if large:
        monkeypatch.setattr(bytebpe, "LARGE_TEXT", 0)
    t = library(bytebpe.BYTE_BPE)
    plain = ["The cat, the dog.\nA second line!?", "word", "Ünï àb (x) 12 a1 don't, it's.", "中文 ɐb, ªº", "a,b ,c, d,,"]
    odd = ["a\n\nb", "a \n b", " lead", "trail ", "a \t \tb", "a\x1c b", "x\n", "\n", " ", "\0", "a\0 b\nc", "p\u180e\nq", "q <|endoftext|>z\nt", None]
    rows = [x for k, text in enumerate(texts) for x in (text, plain[k % len(plain)], odd[k % len(odd)])]
    coder = bytebpe.ChunkCoder(bytebpe.BYTE_BPE, packed_ids, f"test-lists-{large}", cache_entries=500)
    column = pa.concat_arrays([pa.array(["before"]), pa.array(rows, pa.string())]).slice(1)  # does not begin at its buffer's begin
    runs = list(coder.encode_lists(column, packed_ids([7, 0]), run_bytes=5000))
    assert len(runs) > 3
    got = [ids for run in runs for ids in run.to_pylist()]
    want = t.encode_batch([x or "" for x in rows], add_special_tokens=False)
    assert len(got) == len(rows)
    for text, ids, e in zip(rows, got, want):
        assert ids == [*e.ids, 7, 0], (text or "")[:80]
    assert list(coder.encode_lists(pa.array([], pa.string()), packed_ids([0]))) == []


def test_a_run_looks_a_word_up_once(monkeypatch):
    coder = bytebpe.ChunkCoder(bytebpe.BYTE_BPE, packed_ids, "test-once")
    asked = []
    values = coder.values
    monkeypatch.setattr(coder, "values", lambda chunks: asked.extend(chunks) or values(chunks))
    texts = ["x the cat, the cat. the dog!\nx the cat" for _ in range(50)]
    assert sum(map(len, coder.encode_lists(pa.array(texts), packed_ids([0])))) == 50
    assert len(asked) == len(set(asked)) and {"the", "cat", "dog"} <= set(asked) and not {"cat,", "cat.", "dog!"} & set(asked)


def test_token_files_of_repeated_words(spark):
    t = library(bytebpe.BYTE_BPE)
    d = [(i, f"line {i % 3}, word\nword {'the ' * (i % 5)}end") for i in range(300)]
    path = scratch_path(spark, "test-runs")
    tokenfile.write_token_files(tokenfile.encode_sorted(docs(spark, d)), path)
    at = 0
    for r, (i, text) in zip(sorted(tokenfile.token_digest(spark, path).collect(), key=lambda r: r["doc_id"]), d, strict=True):
        ids = np.array(t.encode(text, add_special_tokens=False).ids + [0], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
