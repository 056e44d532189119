"""SimHash near-duplicates against brute force."""

import itertools
import random

import numpy as np
import pytest
import xxhash

from keepcurve.llm import simhash
from keepcurve.llm.simhash import fingerprint, fingerprint_links, golay_tables, near_duplicates, nearest_codewords, one_per_group
from tests.llm import edge_tables


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, distance=2):
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(values)), 2):
        if (values[a] ^ values[b]).bit_count() <= distance:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(k) for k in range(len(values))]


def test_fingerprint_equals_the_plain_rule(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    for t in ["", " \n", "one", "One TWO", "a b c", "a b c d a b c d" * 9, "É é  x\x0by\x1cz", "w " * 100]:
        assert fingerprint(t.encode()) == plain_fingerprint(t), repr(t)


def test_golay_code_is_perfect_and_keys_meet_one_bit_apart():
    errors, _ = tables = golay_tables()
    assert len(set(errors.tolist())) == 2048 and max(int(e).bit_count() for e in errors) == 3
    words = np.random.default_rng(2).integers(0, 1 << 23, 500)
    near = nearest_codewords(words, tables)
    around = np.stack([near, *(nearest_codewords(words ^ (1 << b), tables) for b in range(23))])
    assert {len(set(c)) for c in around.T.tolist()} <= {1, 6}
    for b in range(23):
        other = nearest_codewords(words ^ (1 << b), tables)
        assert all(o in set(a) for o, a in zip(other.tolist(), around.T.tolist()))


@pytest.mark.parametrize("distance,crowd", [(2, 16), (2, 1), (3, 16), (1, 1)])
def test_links_have_the_components_of_all_pairs(spark, distance, crowd):
    rng = random.Random(distance * 100 + crowd)
    values = [rng.getrandbits(64) for _ in range(60)]
    for v in values[:8]:  # chains and dense groups of flipped bits
        for _ in range(25):
            for _ in range(rng.randint(1, 3)):
                v ^= 1 << rng.randrange(64)
            values.append(v)
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    place = {s: k for k, s in enumerate(signed)}
    links = fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), distance, crowd).distinct().collect()
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links:
        assert (values[place[a]] ^ values[place[b]]).bit_count() <= distance
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(values))] == components(values, distance)


def test_near_duplicates_on_awkward_documents(spark, tmp_path):
    folder = edge_tables.write(tmp_path)
    t = edge_tables.documents()
    ids, texts = t["doc_id"].to_pylist(), t["text"].to_pylist()
    prints = [plain_fingerprint(x) for x in texts]
    classes = components(prints)
    least = {}
    for i, c in zip(ids, classes):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == sorted(
        (str(i), f"{p:016x}", str(least.get(c))) for i, p, c in zip(ids, prints, classes))
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(least.get(c)) for c in set(classes))
