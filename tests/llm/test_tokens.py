"""Token ids, BPE, packing and id files against the tokenizers library."""

import hashlib
import io
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dossierlake.llm import bpe, idcoder, idfiles, packing, tokens
from tests.llm.data import TEXTS, documents

ODD = [
    "a", "The", " ", "  ", "\n", " \n", "\t", "\r\n", "'s", "'re", "12", "é", "é", "中文", "!", "##", "\xa0",
    "\x1c", "\x85", "　", "<|endoftext|>", "<|startoftext|>", "Σ", "😀", "​", "½",
]


def texts(n=1500, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randrange(25))) for _ in range(n)] + ["", " ", "abc\n"]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ROOM", 40)
    ours, whole = tokens.Encoder(name), library(name)
    some = texts() + [t for _, t in TEXTS]
    for text, got in zip(some, ours.encode(some), strict=True):
        assert array("I", ids_of(whole, text)).tobytes() == got, repr(text)


def test_bpe_equals_library_both_ways(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ROOM", 40)
    ours, whole = bpe.PairIndexBpe(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    some = texts() + [t for _, t in TEXTS] + ["aaaa aaa aa", "banana" * 9]
    for text, got in zip(some, ours.encode(some), strict=True):
        ids = ids_of(whole, text)
        assert array("I", ids).tobytes() == got, repr(text)
        assert ours.decode(ids) == whole.decode(ids, skip_special_tokens=False)
    r = random.Random(1)
    for _ in range(300):
        ids = [r.randrange(50257) for _ in range(r.randrange(9))]
        assert ours.decode(ids) == whole.decode(ids, skip_special_tokens=False)


def test_bpe_query_rows(spark):
    whole = library("byte_bpe_50k.json")
    want = []
    for doc, text in TEXTS:
        ids = ids_of(whole, text)
        back = whole.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), back)]
        want.append((doc, len(ids), *sha))
    got = [tuple(r) for r in bpe.round_trip(documents(spark)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(documents(spark, [])).count() == 0
    assert [r["ids"] for r in bpe.encode_documents(documents(spark, [(1, "Hello")])).collect()] == [
        ids_of(whole, "Hello")
    ]


def test_piece_lengths():
    for n in (1, 2, 7, 4095, 4096, 4097, 12_345):
        got = packing.piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 4096 for x in got)
        assert got == sorted(got, reverse=True)


def test_packing(spark):
    whole = library("word_bpe_49k.json")
    rows = packing.pack(documents(spark)).collect()
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    by_doc = {}
    for r in rows:
        assert r["offset"] == 0 and r["length"] & (r["length"] - 1) == 0
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    lengths = [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])]
    assert lengths == sorted(lengths, reverse=True)
    for doc, text in TEXTS:
        ids = np.array([*ids_of(whole, text), 2], "<u4")
        mine = {(r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc, len(ids)]}
        assert sum(n for _, n, _ in mine) == len(ids)
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == crc for s, n, crc in mine)
    assert packing.pack(documents(spark, [])).count() == 0
    some = packing.cut_documents(documents(spark, [(1, "a b c")]), with_ids=True).collect()
    assert [i for r in sorted(some, key=lambda r: r["start"]) for i in r["ids"]] == [*ids_of(whole, "a b c"), 2]


@pytest.mark.parametrize("n", [0, 1, 2, 255, 257, 3000, 70_001])
@pytest.mark.parametrize("high", [1, 3, 50257])
def test_coder_round_trip(n, high):
    ids = np.random.default_rng(n + high).integers(0, high, n)
    block = idcoder.encode_block(ids, 50257)
    assert np.array_equal(idcoder.decode_block(block), ids)


def test_coder_learns_and_notices_damage():
    ids = np.tile(np.arange(500), 200)
    block = idcoder.encode_block(ids, 50257)
    assert len(block) < len(ids)  # half of two bytes an id
    for at in (20, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            idcoder.decode_block(bytes(bad))
    with pytest.raises(ValueError):
        idcoder.decode_block(block[:-1])
    with pytest.raises(ValueError):
        idcoder.encode_block(np.array([50257]), 50257)


def test_blocks_cut_long_documents(monkeypatch):
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 100)
    out = io.BytesIO()
    writer = idfiles.BlockWriter(out, 50257)
    docs = [(7, 250), (None, 1), (-3, 99), (9, 100)]
    for doc, n in docs:
        writer.add(doc, np.arange(n, dtype="<u4").tobytes())
    writer.flush()
    out.seek(0)
    parts = [p for table, _ in idfiles.read_blocks(out) for p in table.tolist()]
    assert [(None if null else d) for d, null, _, last in parts if last] == [7, None, -3, 9]
    assert sum(n for _, _, n, _ in parts) == 450


def test_id_files(spark):
    whole = library("byte_bpe_50k.json")
    order = sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    want, start = [], 0
    for doc, text in order:
        ids = np.array([*ids_of(whole, text), 0], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in idfiles.id_file_round_trip(documents(spark)).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert idfiles.id_file_round_trip(documents(spark, [])).count() == 0
