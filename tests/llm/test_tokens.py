import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siftwork.llm import packing, tokenfile, tokens
from siftwork.llm.common import fresh_dir

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return {f: Tokenizer.from_file(public_tokenizers.path(f)) for f in FILES}


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", FILES)
def test_encoder_equals_the_library(plain, file, odd_pairs, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 40)
    rng = random.Random(7)
    bits = ["a", "B", "é", "é", " ", "  ", "\n", "\t", " ", "\x1c", "\x01", "'s", "'", "1", "23", ".", ",)", "<|endoftext|>", "日本", "Σς", "İ", "ß", "ﬁ", " ", "😀", "word", "Ünder"]
    texts = [t for _, t in odd_pairs] + ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(1500)]
    got = [np.frombuffer(x, "<u4").tolist() for x in tokens.ChunkEncoder(public_tokenizers.path(file)).encode(texts)]
    assert got == [ids_of(plain[file], t) for t in texts]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 31, 32])
def test_packing_bits_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1003, dtype=np.uint64).astype(np.uint32)
    data = tokenfile.pack(ids, bits)
    assert len(data) == -(-1003 // 8) * bits
    assert (tokenfile.unpack(data, bits, 1003) == ids).all()


def test_file_random_access(monkeypatch):
    monkeypatch.setattr(tokenfile, "BLOCK", 64)
    rng = np.random.default_rng(0)
    docs = [(None if k == 3 else k, rng.integers(0, 49408, rng.integers(0, 300)).astype(np.uint32)) for k in range(40)]
    out = io.BytesIO()
    writer = tokenfile.TokenFileWriter(out, 16)
    for i, ids in docs:
        writer.add(i, ids)
    writer.close()

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    file = tokenfile.TokenFile(Source(out.getvalue()))
    whole = np.concatenate([ids for _, ids in docs])
    assert [(i, x.tolist()) for i, _, x in file.documents(step=100)] == [(i, x.tolist()) for i, x in docs]
    assert file.read(100, 333).tolist() == whole[100:333].tolist() and not len(file.read(5, 5))
    with pytest.raises(ValueError):
        tokenfile.TokenFile(Source(b"x" * 200))


def test_token_files(spark, frame, odd_pairs, plain):
    manifest = tokenfile.write_tokens(frame(odd_pairs), fresh_dir(spark, "t"), public_tokenizers.path(FILES[0]))
    rows = tokenfile.read_tokens(manifest).orderBy("start").collect()
    assert len(rows) == len(odd_pairs)
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda x: (x is not None, x or 0))
    at = 0
    texts = {}
    for i, t in odd_pairs:
        texts.setdefault(i, []).append(t)
    for r in rows:
        known = [np.array([*ids_of(plain[FILES[0]], t), 2], "<u4").tobytes() for t in texts[r.doc_id]]
        assert r.start == at and r.ids_crc32 in [zlib.crc32(k) for k in known]
        at += r.n_tokens
    assert tokenfile.read_tokens(tokenfile.write_tokens(frame([]), fresh_dir(spark, "t"), public_tokenizers.path(FILES[0]))).count() == 0


def check_pieces(rows, pairs, tokenizer, capacity):
    wanted = {}
    for i, t in pairs:
        wanted.setdefault(i, []).append(ids_of(tokenizer, t) + [0])
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        assert any(w[r.start : r.start + r.length] == ids and len(w) == r.doc_tokens for w in wanted[r.doc_id])
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    for i, docs in wanted.items():
        assert sum(r.length for r in rows if r.doc_id == i) == sum(map(len, docs))
    return held


def test_packing(spark, frame, odd_pairs, plain):
    rows = packing.pack_documents(frame(odd_pairs), public_tokenizers.path(FILES[1])).collect()
    check_pieces(rows, odd_pairs, plain[FILES[1]], 1024)
    assert packing.pack_documents(frame([]), public_tokenizers.path(FILES[1])).count() == 0


def test_packing_pads_little(spark, frame, plain):
    rng = random.Random(3)
    pairs = [(k, " ".join(rng.choice(["some", "words", "here", "and", "there"]) for _ in range(rng.randint(1, 2500)))) for k in range(300)]
    rows = packing.pack_documents(frame(pairs).coalesce(1), public_tokenizers.path(FILES[1])).collect()
    held = check_pieces(rows, pairs, plain[FILES[1]], 1024)
    assert sum(r.length for r in rows) / (1024 * len(held)) > 0.98


def test_classes_hold_a_fixed_count():
    packer = packing.HarmonicPacker(1024, 0)
    for length in range(1, 3000):
        pieces = list(packer.cut(length))
        assert sum(n for n, _ in pieces) == length
        assert all(n * held <= 1024 for n, held in pieces) and len(pieces) <= length // 1024 + 5
