import collections
import hashlib
import itertools
import math
import random

import numpy as np
import pytest

from tabsmith.llm import embed_dedup, suffix_dedup, warc
from tabsmith.llm.queries import QUERIES


def brute_links(ids, vectors, threshold=0.9):
    ok = [k for k, x in enumerate(vectors) if x and ids[k] is not None and any(v for v in x if v is not None)
          and all(v is not None and math.isfinite(v) for v in x)]
    count, root = [0] * len(ids), list(range(len(ids)))
    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for a, b in itertools.combinations(ok, 2):
        if len(vectors[a]) == len(vectors[b]) and embed_dedup.exact_cosine(np.array(vectors[a]), np.array(vectors[b])) >= threshold:
            count[a] += 1
            count[b] += 1
            root[find(a)] = find(b)
    least = collections.defaultdict(list)
    for k, i in enumerate(ids):
        if i is not None:
            least[find(k)].append(i)
    return [(i, count[k], min(least[find(k)], default=None), i is not None and i == min(least[find(k)])) for k, i in enumerate(ids)]


@pytest.mark.parametrize("block", [4096, 48])
def test_ego_join_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(10, 8))
    vectors = [(base[rng.integers(10)] + rng.normal(size=8) * rng.choice([.02, .2, .5])).astype(np.float32).astype(float).tolist() for _ in range(250)]
    vectors += vectors[:9] + [[0.0] * 8, None, [], [1.0, math.nan] + [0.0] * 6, [math.inf] + [0.0] * 7, [None] + [1.0] * 7, [1., 2., 3.], [2., 4., 6.]]
    vectors += [[-0.0, 0., 1., 0., 0., 0., 0., 0.], [0.0, 0., 1., 0., 0., 0., 0., 0.], [x * 1e30 for x in vectors[3]]]
    vectors += [[1.0, 0.0], [0.9, math.sqrt(1 - 0.81)], [0.9, -math.sqrt(1 - 0.81) * 1.0000001]]  # at and below the threshold
    ids = list(range(len(vectors)))
    ids[17] = None
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, vectors, strict=True)],
                               "vec_id long, embedding array<double>, label int, links string")
    got = [tuple(r) for r in embed_dedup.near_duplicates(df, block=block).collect()]
    assert sorted(got, key=str) == sorted(brute_links(ids, vectors), key=str)
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0


def test_tight_knot_links_whole_intervals():
    rng = np.random.default_rng(2)
    x = rng.normal(size=16)
    raw = x + rng.normal(size=(3000, 16)) * 1e-3
    side = embed_dedup.Side(raw, np.ones(3000, np.int64), embed_dedup.directions(embed_dedup.unit(raw), 4))
    got = embed_dedup.join_blocks(side, None, 0.9)
    assert (got.count == 2999).all() and (got.find(np.arange(3000)) == 0).all() and len(side.known) == 1


PAGES = "page_id long, url string, html string, digest string, refers_to string"


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "é" * 200 + "\r\n\r\nx</p>"
    rows = [(7, "https://WWW.Example.com:443/a?b=1#f", big), (3, "http://example.com/z", big), (9, None, big), (1, "http://b.example.com:81", None),
            (2, "http://b.example.com", ""), (4, "not a url\nx", "short"), (5, "http://example.com/z", "short"), (None, "http://q.com/", big),
            (6, "http://[bad", "y" * 99), (8, "http://[bad", "y" * 99), (3, "http://example.com/z", big), (10, "u", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, "c", "c") for r in rows], PAGES)
    archive = warc.write(df, root=str(tmp_path / "arc"))
    places = warc.captures_of(df.select("url").where("url = 'http://example.com/z'"), archive)
    got = warc.fetch(places, archive, payloads=True).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(3, "response"), (3, "response"), (5, "response")]
    assert {bytes(r.payload).decode() for r in got} == {big, "short"}
    for (i, u, h) in rows:
        digest = hashlib.sha256((h or "").encode()).hexdigest()
        keys = spark.createDataFrame([(warc.capture_key(u, i, digest),)], "key string")
        for r in warc.fetch(warc.locate(keys, archive), archive).collect():
            refers = 3 if h == big and i != 3 else None
            assert (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == (
                i, len((h or "").encode()), digest, "revisit" if refers else "response", refers)
    none = warc.write(df.limit(0), root=str(tmp_path / "none"))
    assert none.manifest == [] and warc.locate(keys, none).count() == 0


def test_index_looks_up_like_a_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "LINES", 7)
    df = spark.createDataFrame([(i, f"http://h{i % 13}.org/{i % 5}", "h" * (i % 300), "", "") for i in range(400)], PAGES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive = warc.write(df, root=str(tmp_path / "arc"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(archive.manifest) > 1
    reader = warc.Reader(archive)
    keys = sorted(warc.capture_key(f"http://h{i % 13}.org/{i % 5}", i, hashlib.sha256(b"h" * (i % 300)).hexdigest()) for i in range(400))
    assert [x[0] for x in reader.captures("", "~~")] == keys
    assert all([x[0] for x in reader.captures(k, k)] == [k] for k in random.Random(0).sample(keys, 60))
    assert list(reader.captures("zz", "zzz")) == []


def test_surt():
    assert warc.surt("https://user@www.Example.com:443/a/b?q=1#x") == "com,example,www)/a/b?q=1"
    assert warc.surt("http://example.com:8080") == "com,example:8080)/" and warc.surt(None) == "-" and warc.surt("nope") == ")nope"


def test_suffix_array_and_kasai(monkeypatch):
    rng = random.Random(5)
    for trial in range(150):
        n = rng.randrange(1, 120)
        data = bytes([rng.choice(b"ab\0") for _ in range(n)]) if trial % 3 else bytes([rng.choice(b"ab")]) * n
        sa, rank, eight = suffix_dedup.suffix_array(np.frombuffer(data, np.uint8))
        assert sa.tolist() == sorted(range(n), key=lambda i: data[i:]) and rank[sa].tolist() == list(range(n))
        monkeypatch.setattr(suffix_dedup, "LANE", rng.randrange(1, 150))
        lcp = suffix_dedup.common_prefixes(sa, rank, eight, 20)
        for k in range(1, n):
            a, b, c = data[sa[k - 1]:], data[sa[k]:], 0
            while c < min(len(a), len(b), 20) and a[c] == b[c]:
                c += 1
            assert lcp[sa[k]] == c


def test_anchors_own_every_start_once_and_alike():
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcd") for _ in range(3000)) + b"z" * 900
    anchors = suffix_dedup.Anchors(50, 12)
    owned, by_string = [], {}
    for lo, hi, _, h, _ in anchors.contexts(text):
        owned += range(lo, hi + 1)
        for s in range(lo, hi + 1):
            assert by_string.setdefault(text[s:s + 50], h) == h
    assert owned == list(range(len(text) - 49))


def brute_spans(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[s:s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 2, bool)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s + 1:s + length + 1] = True
        edge = np.flatnonzero(np.diff(gone.astype(int)))
        out.append((i, [tuple(map(int, x)) for x in edge.reshape(-1, 2)]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("hot", "shard"), [(1024, 1 << 21), (3, 500)])
def test_repeated_spans_equal_brute_force(spark, hot, shard):
    rng = random.Random(7)
    base, rows = "".join(rng.choice("abc é") for _ in range(600)), []
    for i in range(150):
        kind, t = rng.randrange(6), "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(80)))
        if kind < 3:
            part = list(base[rng.randrange(300):][:rng.randrange(20, 300)])
            for _ in range(rng.randrange(3)):
                part[rng.randrange(len(part))] = "Z"
            t = t[:20] + "".join(part) + t[20:]
        if kind == 4:
            t = rng.choice("xy") * rng.randrange(90)
        rows.append((i if i % 40 else None, t if i % 50 else None))
    rows += rows[:5] + [(900, "")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string")
    got = suffix_dedup.repeated_spans(df, 30, hot=hot, shard_bytes=shard).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=str) == brute_spans(rows, 30)
    kept = suffix_dedup.remove_repeats(df, 30)
    assert kept.columns == ["doc_id", "text"] and kept.count() == len(rows)


def test_split_anchors_with_cells(spark, monkeypatch):
    """Near copies of one long text: nearly all contexts of an anchor differ, and cores prune most digests."""
    monkeypatch.setattr(suffix_dedup, "CELL", 8)
    rng = random.Random(11)
    base, rows = "".join(rng.choice("abcdefgh ") for _ in range(260)), []
    for i in range(60):
        t = list(base)
        for _ in range(rng.randrange(4)):
            t[rng.randrange(len(t))] = rng.choice("XYZ")
        rows.append((i, "".join(t)[rng.randrange(20):]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (2, 7, 1000):
        got = suffix_dedup.repeated_spans(df, 60, hot=hot).collect()
        assert sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in got), key=str) == brute_spans(rows, 60)


def test_query_on_planted_passages(spark, tmp_path):
    """Passages of over 50 words in two documents go if they have 400 bytes, and only then; every row equals a brute force."""
    rng = random.Random(14)

    def words(n, letters):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(letters)) for _ in range(n))
    rows, planted = [], {}
    for k in range(24):
        passage = words(51 + k, 7 if k % 2 else 5)  # 415 bytes and more; 305 to 437 bytes
        for doc, mark in ((10 * k, "A"), (10 * k + 1, "B")):
            rows.append((doc, f"{words(30, 6)}{mark} {passage} {mark}{words(30, 6)}"))
            # the spaces around the passage are equal, too
            planted[doc] = len(passage) + 2 if len(passage) + 2 >= 400 else 0
    clean = range(1000, 1040)
    rows += [(i, words(rng.randrange(200), 6)) for i in clean]
    rows += [(2000, None), (2001, ""), (2002, "é" * 250 + words(20, 5)), (2003, words(60, 8) * 2), rows[0], rows[5]]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op10_suffix_array"](spark, str(tmp_path)).collect()
    texts, want = collections.defaultdict(list), []
    for i, t in rows:
        texts[i].append((t or "").encode())
    for i, spans in brute_spans(rows, 400):
        data = texts[i][0]  # rows of one id have one text
        kept = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))
        want.append((i, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    removed = {r.doc_id: r.n_removed for r in got}
    once = {i: n for i, n in planted.items() if len(texts[i]) == 1}
    assert {i: removed[i] for i in once} == once and 0 < sum(n > 0 for n in once.values()) < len(once)
    assert not any(removed[i] for i in clean) and removed[2000] == removed[2001] == 0 and removed[2003] > 0


def test_no_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string")
    assert [r.spans for r in suffix_dedup.repeated_spans(df).collect()] == [[], []]
    assert suffix_dedup.repeated_spans(df.limit(0)).count() == 0


def test_long_text_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = bytes(rng.choice(b"ab") for _ in range(5000))
    whole = {s: h for lo, hi, _, h, _ in suffix_dedup.Anchors(40, 10).contexts(text) for s in range(lo, hi + 1)}
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    parts = {s: h for lo, hi, _, h, _ in suffix_dedup.Anchors(40, 10).contexts(text) for s in range(lo, hi + 1)}
    assert parts == whole


def test_tiles_and_pruning_of_clusters(spark):
    """Clusters far apart: few pairs of blocks meet, in tiles, and no link is lost."""
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(24, 32))
    x = np.concatenate([c + rng.normal(size=(60, 32)) * rng.choice([0.05, 0.25]) for c in centres])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(6)
    got = {r["vec_id"]: r for r in embed_dedup.near_duplicates(df, block=20).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    assert [got[i]["n_links"] for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
    reach = near
    while (more := (reach.astype(float) @ reach.astype(float) > 0)).sum() > reach.sum():
        reach = more
    assert [got[i]["component_id"] for i in range(len(x))] == reach.argmax(axis=1).tolist()
    eps = (2 - 2 * 0.9) ** 0.5
    groups = df.selectExpr("vec_id AS rep", "1L AS weight", "embedding AS v")
    basis = embed_dedup.directions(u, 16)
    blocks = embed_dedup.table(embed_dedup._blocks(groups, basis, eps, 20), "t")
    n = blocks.count()
    assert n == 72 and embed_dedup._pairs(blocks, eps).count() < 0.4 * n * (n + 1) / 2
