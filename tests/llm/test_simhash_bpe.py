import hashlib
import itertools
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from tabsmith.llm import bpe, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id string"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, None, None, "x", "y") for i, t in zip(ids, texts, strict=True)], DOCS)


def plain_fingerprint(text):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    sh = [b" ".join(ws[i:i + 3]) for i in range(max(1, len(ws) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    out = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))
    return out - (1 << 64) if out >> 63 else out


def test_fingerprint():
    for t in [None, "", " \t\n", "One", "a b", "A b C", "É é word", "x y z x y z x y z w", " ".join(map(str, range(70000)))]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_masks_cover_every_pair():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == (1 << radius + 1) - 1
        for bits in itertools.combinations(range(64), radius):
            assert any(all(not m >> b & 1 for b in bits) for m in masks)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_links_equal_brute_force(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(12)]
    fps = {0}
    for _ in range(300):
        x = rng.choice(seeds)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    root = list(range(len(fps)))
    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    groups = spark.createDataFrame(list(zip(signed, range(len(fps)), strict=True)), "fp long, rep long")
    got = {r.node: r.component for r in simhash.components(simhash.links(groups, radius)).collect()}
    assert [got.get(i, i) for i in range(len(fps))] == [find(i) for i in range(len(fps))]


def test_near_duplicates_and_dedup(spark):
    long = " ".join(f"w{i}" for i in range(300))
    texts = [long, long + " end", None, "", "  ", "other text entirely here", long, "x"]
    df = frame(spark, texts, [5, 3, 9, 8, 7, 1, 5, None])
    got = {}
    for r in simhash.near_duplicates(df).collect():
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert got[5] == got[3] == {3} and got[9] == got[8] == got[7] == {7} and got[1] == {1} and got[None] == {None}
    kept = simhash.dedup(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "7", "None"]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, k) for k in range(6, 90)] + [(200, 200), (None, 3), (201, None)]
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got) == set(range(100, 161)) | set(range(5, 90))
    assert all(c == (100 if n >= 100 else 5) for n, c in got.items())


PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def odd_texts():
    rng = random.Random(2)
    return [None, "", " ", "a" * 3000, "ab" * 700, " " * 700, "\n" * 300 + "x", "日本語テキスト" * 100, "it's WE'LL 123456789012 x²",
            "😀" * 60, "0" * 257, "x" * 256, "<|endoftext|>", "".join(chr(rng.randrange(32, 0x3000)) for _ in range(4000))]


def test_bpe_equals_tiktoken(reference):
    texts = [t or "" for t in odd_texts()]
    for latin in (None, bpe.LATIN_SPLIT):
        codec = bpe.Codec(bpe.Merges(bpe.load_ranks(PATH)), public_tokenizers.PATTERN, latin)
        for t, ids in zip(texts, codec.encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t)
            assert codec.merges.decode(ids) == t.encode()
    with pytest.raises(ValueError):
        codec.merges.decode(np.array([1 << 20], "<u4").tobytes())


def test_bpe_frames(spark, reference):
    texts = odd_texts()
    df = frame(spark, texts).withColumnRenamed("fp", "n_tokens")
    kept = [c for c in df.columns if c != "n_tokens"]
    got = bpe.round_trip(df, PATH, public_tokenizers.PATTERN, latin_pattern=bpe.LATIN_SPLIT)
    assert got.columns == [*kept, "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in got.collect():
        ids = reference.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    back = bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN), PATH)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in back.collect())
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
