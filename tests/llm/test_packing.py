"""Packing against the tokenizer itself and a full round trip."""

import random
import zlib

import numpy as np
import pytest

from keepcurve.llm.packing import Packer, WordEncoder, pack_documents
from keepcurve.llm.queries import QUERIES, tokenizer_path
from tests.llm import edge_tables


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_word_encoder_equals_the_tokenizer(tokenizer):
    e, rng = WordEncoder(tokenizer_path()), random.Random(7)
    letters = "aBéÉß'’İΣς <|startoftext|> 　\x1c\t\n1²Ⅷ٣_-.!?s t ré漢字🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["<|startoftext|>", "a<|endoftext|>b", "it's we'll O'Neil ABC'S", "x" * 5000, "end."]
    for t in texts:
        assert list(np.frombuffer(e.encode(t), "<u4")) == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_packer_keeps_few_windows_and_places_best_fit():
    p = Packer(10, 2)
    piece = lambda n: (0, 0, bytes(4 * n), n)
    for n in (6, 3, 3):
        assert list(p.add(*piece(n))) == []
    assert sorted(w[0] for w in p.open) == [3, 9]  # the second 3 went to the fuller window
    full = list(p.add(*piece(8)))  # fits none: tops up the window of 9, its rest the other one
    assert [sum(len(x[2]) for x in w) for w in full] == [40, 40] and len(p.open) <= 2
    for k in range(200):
        list(p.add(*piece(1 + k * 7 % 30)))
        assert len(p.open) <= 2


def test_round_trip_on_awkward_documents(spark, tmp_path, tokenizer):
    folder = edge_tables.write(tmp_path)
    docs = edge_tables.documents()
    got = pack_documents(spark.read.parquet(f"{folder}/documents.parquet"), tokenizer_path(), max_tokens=64, open_windows=3).toPandas()
    want = sorted(tuple(ids_of(tokenizer, t)) for t in docs["text"].to_pylist())
    assert got["length"].sum() == sum(map(len, want))
    assert sorted(got["ids"].map(len) // 4) == sorted(got["length"])
    sizes = got.groupby("sequence_id")["length"].sum()
    assert all(n == 64 or n & (n - 1) == 0 for n in sizes) and sizes.max() <= 64
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert list(g["offset"]) == [0, *g["length"].cumsum()[:-1]]
    single = got[got["doc_id"].isin([100, 101, 103, 107, 108])]
    texts = dict(zip(docs["doc_id"].to_pylist(), docs["text"].to_pylist()))
    for d, g in single.groupby("doc_id"):
        ids = np.concatenate([np.frombuffer(x, "<u4") for x in g.sort_values("start")["ids"]])
        assert list(ids) == ids_of(tokenizer, texts[int(d)]) and set(g["doc_tokens"]) == {len(ids)}


def test_query_digest(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op1_packing"](spark, sf).toPandas()
    assert set(got["doc_id"]) == set(texts)
    for d, g in got.groupby("doc_id"):
        ids, at = np.array(ids_of(tokenizer, texts[d]), dtype="<u4"), 0
        for r in g.sort_values("start").itertuples():
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
