"""Tokenizers against the public library."""

import random
import struct

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, token_counts
from tidemark.llm.automaton import Automaton
from tidemark.llm.vocab import Vocab

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = "aàbcdeéfghiïjklmnoöpqrstuüvwxyz'sst    \n\t.,!?#$%0123456789ΣσςİıßﬁÅ한글日本語👍🏽͸ \x1c\x85"


def texts(sf):
    draw = random.Random(1)
    out = ["", " ", "<|endoftext|>", "a<|startoftext|><|endoftext|>b", "don't WE'LL", "a" * 5000, "ab" * 3000, "é" * 3000, "=" * 700, " " * 700 + "x"]
    out += ["".join(draw.choice(LETTERS) for _ in range(draw.randint(0, 80))) for _ in range(1500)]
    out += [draw.choice("abst=-. 1") * draw.randint(1, 60) for _ in range(200)]
    return out + pq.read_table(f"{sf}/documents.parquet")["text"].to_pylist()


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(*bpe.compiled(WORD))


def test_codec_equals_library(codec, sf):
    library = Tokenizer.from_file(WORD)
    for text in texts(sf):
        want = library.encode(text, add_special_tokens=False).ids
        packed = codec.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == want, text
        assert codec.decode(packed) == library.decode(want, skip_special_tokens=False), text


def test_codec_on_all_letters(codec):
    library = Tokenizer.from_file(WORD)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 64):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}" for c in points[k : k + 64])
        packed = codec.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode(text, add_special_tokens=False).ids, hex(points[k])


def test_full_tables_start_anew(codec, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    small = bpe.Codec(codec.automaton, {}, r"(?!)")
    text = "one two three four five one six seven two eight nine one"
    assert small.encode(text) == codec.encode(text) and len(small.words) <= 3


def plain_merges(symbols, merges):
    for u, v, w in merges:
        out, i = [], 0
        while i < len(symbols):
            if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == (u, v):
                out.append(w)
                i += 2
            else:
                out.append(symbols[i])
                i += 1
        symbols = out
    return symbols


@pytest.mark.parametrize("seed", range(12))
def test_automaton_equals_merges_in_order(seed):
    """Random merges over two letters, which make runs and overlaps common."""
    draw = random.Random(seed)
    ids, labels, merges = {"a": 0, "b": 1}, ["a", "b"], []
    while len(merges) < 14:
        u, v = draw.randrange(len(labels)), draw.randrange(len(labels))
        label = labels[u] + labels[v]
        if label in ids or len(label) > 12:
            continue
        ids[label] = len(labels)
        merges.append((u, v, len(labels)))
        labels.append(label)
    machine = Automaton(Vocab(ids, merges, {}, ""))
    for _ in range(300):
        word = "".join(draw.choice("ab") for _ in range(draw.randint(1, 24)))
        assert machine.encode(word.encode()) == plain_merges([ids[c] for c in word], merges), word


def test_automaton_refuses_disorder():
    with pytest.raises(ValueError):
        Automaton(Vocab({"a": 0, "b": 1, "ab": 2, "abb": 3}, [(2, 1, 3), (0, 1, 2)], {}, ""))


def test_counts_equal_library(sf):
    library = Tokenizer.from_file(BYTE)
    counts, special = token_counts.counter(token_counts.proven(BYTE))
    for text in texts(sf):
        assert token_counts.count(text, counts, special) == len(library.encode(text, add_special_tokens=False).ids), text


def test_proven_tokens_are_whole():
    merges, whole, _ = token_counts.proven(BYTE)
    library = Tokenizer.from_file(BYTE)
    for piece in random.Random(2).sample(sorted(whole), 2000):
        if len(token_counts.pieces(piece)) == 1:
            assert len(library.encode(piece, add_special_tokens=False).ids) == 1


def test_long_pieces_merge_as_short_ones():
    merges = token_counts.proven(BYTE)[0]
    draw = random.Random(4)
    for _ in range(300):
        piece = "".join(draw.choice("abest ing") for _ in range(draw.randint(1, 60))).encode()
        short = merges.merge(piece)
        ids = [merges.bytes[b] for b in piece]
        assert short == merges._short(list(ids))
        assert len(merges.merge(piece * 3)) > 0


def test_rows_with_nulls_and_clashes(spark):
    rows = [(1, None, "x"), (1, "", "x"), (2, "Hello <|endoftext|> World", "x"), (2, "Hello <|endoftext|> World", "x"), (None, "a b", "x")]
    df = spark.createDataFrame(rows, "doc_id int, text string, n_tokens string")
    counted = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(df, BYTE, limit=3).collect())
    assert counted == [(0, 3, 2, False), (1, 0, 0, False), (1, 0, 0, False), (2, 25, 4, True), (2, 25, 4, True)]
    coded = bpe.tokenize(df, WORD, outputs=("ids", "n_tokens", "decoded"))
    again = bpe.decode(coded.drop("decoded"), WORD).collect()
    assert {(r.decoded) for r in again} == {r.decoded for r in coded.collect()}
    assert [r.decoded for r in again if r.text == "a b"] == ["a</w> b</w>"]
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert bpe.tokenize(empty, WORD).count() == 0 and token_counts.count_tokens(empty, BYTE).count() == 0
