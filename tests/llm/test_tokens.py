import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from pagetables.llm import packing, queries, token_store
from pagetables.llm.tokens import WordCoder

DATA = "/root/testdata/sf0.001"
NAMES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain(name):
    t = Tokenizer.from_file(P.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_word_coder_equals_whole_text_encoding(name):
    draw = random.Random(3)
    letters = list(" \n\t.,'sé1aB\x00\x01́\u0085　Σ!ſß") + ["  ", ".\n", " the", "'ll"]
    texts = ["", " ", "<|endoftext|> x<|endoftext|>", "x" * 3000 + " y", "a\n\n b \n"]
    texts += ["".join(draw.choice(letters) for _ in range(draw.randint(0, 60))) for _ in range(2000)]
    coder, encode = WordCoder(P.path(name), keep=50), plain(name)
    for at in range(0, len(texts), 100):  # forgets now and then
        part = texts[at:at + 100]
        ids, lengths = coder.encode(part)
        want = [encode(t) for t in part]
        assert lengths.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("change", ["no normalizer", "other normalizer", "other cuts", "words kept whole"])
def test_files_of_other_kinds_are_encoded_text_by_text(tmp_path, change):
    import json

    with open(P.path(NAMES[0]), encoding="utf-8") as file:
        shape = json.load(file)
    if change == "no normalizer":
        shape["normalizer"] = None
    elif change == "other normalizer":
        shape["normalizer"]["normalizers"].pop()
    elif change == "other cuts":
        shape["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = "[^\\s]+"
    else:
        shape["added_tokens"] = [{"id": 5, "content": "lazy dog", "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": False}]
    path = str(tmp_path / "changed.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(shape, file)
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    texts = ["Hello World, THE end", "a,b  c.D", "", "the lazy dog. The End"]
    ids, lengths = WordCoder(path).encode(texts)
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_store_equals_brute_force(spark):
    encode = plain(NAMES[0])
    docs = sorted(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect())
    want, start = [], 0
    for doc_id, text in docs:
        ids = [*encode(text), 2]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = queries.op1_token_store(spark, DATA).collect()
    assert sorted(map(tuple, got)) == want


def test_store_of_odd_rows(spark, documents, no_documents, tmp_path):
    params = token_store.StoreParams(P.path(NAMES[0]))
    token_store.write_tokens(documents, f"{tmp_path}/a", params)
    rows = token_store.read_tokens(spark, f"{tmp_path}/a").orderBy("start").collect()
    assert len(rows) == documents.count()
    assert [r.doc_id or 0 for r in rows] == sorted(r.doc_id or 0 for r in rows)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    assert all(r.token_ids[-1] == 2 and len(r.token_ids) == r.n_tokens for r in rows)
    token_store.write_tokens(no_documents, f"{tmp_path}/b", params)
    assert token_store.read_tokens(spark, f"{tmp_path}/b").count() == 0


def test_store_reads_columns_and_pages(spark, tmp_path):
    token_store.write_tokens(spark.read.parquet(f"{DATA}/documents.parquet"), f"{tmp_path}/t", token_store.StoreParams(P.path(NAMES[0])))
    some = token_store.read_tokens(spark, f"{tmp_path}/t").where("doc_id = 7").select("n_tokens")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,7)" in plan and "token_ids" not in plan
    import glob

    import pyarrow.parquet as pq

    meta = pq.ParquetFile(glob.glob(f"{tmp_path}/t/tokens/*.parquet")[0]).metadata.row_group(0)
    column = next(meta.column(i) for i in range(meta.num_columns) if "token_ids" in meta.column(i).path_in_schema)
    assert column.has_dictionary_page and column.has_column_index


def check_packing(rows, capacity=1024):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        by_doc.setdefault((r.doc_id), []).append(r)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_sequence, by_doc


def test_packing_equals_brute_force(spark):
    encode = plain(NAMES[1])
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op10_pack(spark, DATA).collect()
    sequences, by_doc = check_packing(rows)
    total = 0
    for doc_id, text in docs:
        ids, at = [*encode(text), 2], 0
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and len(own) == -(-len(ids) // 1024)
        for r in own:
            assert r.start == at and r.ids_crc32 == crc(ids[at:at + r.length])
            assert r.length == 1024 or r.piece == 0
            at += r.length
        assert at == len(ids)
        total += at
    assert len(sequences) <= 1.02 * total / 1024 + 1


def test_packing_of_odd_rows(spark, documents, no_documents):
    parts = packing.pieces(documents, P.path(NAMES[1]))
    rows = packing.pack(parts).collect()
    check_packing(rows)
    assert len(rows) == parts.count()
    assert sum(r.doc_id is None for r in rows) >= 2
    assert packing.pack(packing.pieces(no_documents, P.path(NAMES[1]))).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_length_once(spark, seed):
    draw = random.Random(seed)
    lengths = [draw.choice([draw.randint(1, 1024), draw.randint(1, 60), 700]) for _ in range(3000)]
    rows = spark.createDataFrame([(k, 0, 0, n, 0) for k, n in enumerate(lengths)], packing.PIECES)
    out = packing.pack(rows, packing.PackParams(part_rows=100)).collect()
    sequences, _ = check_packing(out)
    assert sorted((r.doc_id, r.length) for r in out) == list(enumerate(lengths))
    # 700 and more can't share with each other
    assert len(sequences) <= 1.03 * max(sum(lengths) / 1024, sum(n > 512 for n in lengths)) + 2
