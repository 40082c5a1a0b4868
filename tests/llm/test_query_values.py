"""Registered queries that SQL can't express, value by value against plain versions, on whole tables."""

import hashlib
import random
import struct

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tests.llm.test_groups import sketch_of
from tidemark.llm import fingerprints, queries


def odd_documents():
    draw = random.Random(6)
    words = [f"w{i}" for i in range(900)]
    texts = [None, "", " ", "\n", "a", "a b", "👍🏽 é́ \U0001f600x", "<|endoftext|> end", "a b c d e", None, "tail\r\n\x0b\x0c"]
    texts += [" ".join(draw.choice(words) for _ in range(draw.randint(1, 400))) for _ in range(60)]
    texts += [" ".join(words)] * 40 + [" ".join(words[:k] + words[k + 1 :]) for k in range(0, 900, 90)]
    texts += [" ".join(draw.choice(words) for _ in range(60_000)), "x" * 50_000, "", None]
    ids = draw.sample(range(-(10**6), 10**12), len(texts))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())})


@pytest.fixture(scope="module")
def folders(tmp_path_factory, sf):
    odd, empty = tmp_path_factory.mktemp("odd"), tmp_path_factory.mktemp("empty")
    rows = odd_documents()
    pq.write_table(rows, odd / "documents.parquet", row_group_size=20)
    pq.write_table(rows.slice(0, 0), empty / "documents.parquet")
    return {"odd": str(odd), "empty": str(empty), "given": sf}


def documents(folder):
    rows = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def found(spark, name, folder):
    rows = queries.QUERIES[name](spark, folder).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(by_id) == len(rows)
    return by_id


def sha(data):
    return hashlib.sha256(data).hexdigest()


def likeness(a, b, k=fingerprints.K):
    union = sorted(set(a) | set(b))[:k]
    return len(set(a) & set(b) & set(union)) / len(union) if union else 1.0


@pytest.mark.parametrize("table", ["odd", "empty", "given"])
def test_codec_query(spark, folders, table):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts, got = documents(folders[table]), found(spark, "op1_bpe_codec", folders[table])
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(decoded.encode()))
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want, i


@pytest.mark.parametrize("table", ["odd", "empty", "given"])
def test_count_query(spark, folders, table):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts, got = documents(folders[table]), found(spark, "op8_token_counts", folders[table])
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(text.encode()), n, n > 512), i


@pytest.mark.parametrize("table", ["odd", "empty", "given"])
def test_fingerprint_query(spark, folders, table):
    texts, got = documents(folders[table]), found(spark, "op10_fingerprints", folders[table])
    assert got.keys() == texts.keys()
    ids = sorted(texts)
    hexed = lambda s: "".join(f"{h % 2**64:016X}" for h in s)
    for i, j in zip(ids, ids[1:] + ids[:1]):
        text, after = texts[i], texts[j]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        own, changed, other = sketch_of(text), sketch_of(edited), sketch_of(after)
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), sha(edited.encode()), hexed(own), hexed(changed)), i
        assert (r.near_edited, r.near_next) == pytest.approx((likeness(own, changed), likeness(own, other))), i
    assert all(got[i].fingerprint == got[j].fingerprint for i in ids for j in ids[:5] if texts[i] == texts[j])
