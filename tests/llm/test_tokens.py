"""Packing and BPE against the library itself."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cairnframe.llm import bpe, packing

ODD = ["", None, "a", "  ", "Don't  we'll\t\n x y", "<|endoftext|> and <|startoftext|>hi", "İstanbul ΣΣ", "café é ﬁ 中文 \U0001f600", "aaaaaaaaaaaaaaaaaaaaaaaa ababababab", "x" * 5000, "1234 5 ½ ٠", "!!! ... '' 's'S", "\x00\x1c\x85 a b", "ẞ Ǆ ͅ"]


def texts():
    r = random.Random(5)
    alphabet = "abcdeEThiou  \n'.,1éèñüß中\U0001f600́"
    return ODD + ["".join(r.choices(alphabet, k=r.randint(1, 300))) for _ in range(120)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n long")


def test_bpe_as_the_library(spark):
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(0, "", 7), (None, "twice", 1)]
    got = bpe.bpe_round_trip(frame(spark, rows), with_ids=True).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r[1] or "" for r in rows}
    for g in got:
        ids = lib.encode(by_id[g.doc_id], add_special_tokens=False).ids
        decoded = lib.decode(ids, skip_special_tokens=False)
        assert g.ids == ids and g.decoded == decoded and g.n_tokens == len(ids), by_id[g.doc_id]
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_bpe_empty_table(spark):
    assert bpe.bpe_round_trip(frame(spark, [])).count() == 0


def test_small_cache_changes_nothing(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    words = [t for t in texts() if t]
    whole = [bpe.WordBpe(path).encode(t) for t in words]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    small = bpe.WordBpe(path)
    assert [small.encode(t) for t in words] == whole


@pytest.mark.parametrize("window", [1024, 64])
def test_packing_round_trip(spark, window):
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(i, t, 7) for i, t in enumerate(texts())] + [(5, texts()[5], 7), (None, "twice", 1)]
    got = packing.pack(frame(spark, rows).repartition(5), window=window, with_ids=True).collect()
    expected = sorted(([*lib.encode(t or "", add_special_tokens=False).ids, 0] for _, t, _ in rows), key=lambda x: (len(x), x))
    order = sorted(got, key=lambda r: (r.sequence_id, r.offset))
    at, found = 0, []
    for r in order:
        assert (r.sequence_id, r.offset) == divmod(at, window) and r.length == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        if r.start == 0:
            found.append([])
        assert r.start == len(found[-1])
        found[-1] += r.ids
        assert len(found[-1]) <= r.doc_tokens and (len(found[-1]) == r.doc_tokens) == (found[-1][-1] == 0 and len(found[-1]) == r.doc_tokens)
        at += r.length
    assert sorted(found, key=lambda x: (len(x), x)) == expected


def test_packing_empty_table(spark):
    assert packing.pack(frame(spark, [])).count() == 0
