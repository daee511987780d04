import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from tabsmith.llm import conv_repair, line_dedup, periodic_runs
from tabsmith.llm.queries import QUERIES
from tests.conftest import SF001

WHITE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return text.encode().lower().decode()


# -- lines ----------------------------------------------------------------------------

def plain_lines(docs, least=10):
    """{row: (lines, dropped, kept)} of (doc_id, text) rows by a plain dictionary."""
    ids = [float("inf") if i is None else i for i, _ in docs]
    split = [(t or "").split("\n") for _, t in docs]
    keys = [[low(x.strip(WHITE)) for x in lines] for lines in split]
    holders = {}
    for i, ks in zip(ids, keys, strict=True):
        for k in ks:
            if len(k) >= least:
                holders.setdefault(k, set()).add(i)
    out = []
    for i, lines, ks in zip(ids, split, keys, strict=True):
        kept = [x for x, k in zip(lines, ks, strict=True)
                if len(k) < least or len(holders[k]) < 2 or min(holders[k]) == i]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_docs():
    rng = random.Random(5)
    pool = [" Shared Line number one ", "shared line NUMBER one", "ÄÖÜ äöü einmal und", "äöü ÄÖÜ einmal und", "tiny", "", "\t\v  ", "exactly 10", "Nine char", "x" * 5000]
    pool += [f"body line {k} of the pool" for k in range(40)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for i in rng.sample(range(-50, 400), 120)]
    docs += [(900, None), (901, ""), (902, "\n\n"), (903, "the very same row\nhere it is again"), (903, "the very same row\nhere it is again"),
             (None, "body line 3 of the pool\nonly rows without an id hold this"), (None, "only rows without an id hold this")]
    return docs


@pytest.mark.parametrize("limit", [1 << 24, 0])
def test_lines_equal_brute_force(spark, limit):
    docs = line_docs()
    given = spark.createDataFrame([(n, i, t, "kept", 7) for n, (i, t) in enumerate(docs)],
                                  "n int, doc_id long, text string, lost_doc0 string, N_Lines int").repartition(5)
    done = line_dedup.dedup_lines(given, broadcast_bytes=limit, shard_keys=8)
    assert sorted(done.columns) == sorted(["n", "doc_id", "lost_doc0", "text", "n_lines", "n_dropped"])
    got = {r["n"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in done.collect()}
    assert [got[n] for n in range(len(docs))] == plain_lines(docs)
    assert sum(r[1] for r in got.values()) > 50


def test_no_lines(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    for limit in (1 << 24, 0):
        assert line_dedup.dedup_lines(empty, broadcast_bytes=limit).count() == 0


def test_line_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, n, d, sha(kept)) for (i, _), (n, d, kept) in zip(docs, plain_lines(docs), strict=True)}
    rows = QUERIES["op11_line_dedup"](spark, SF001).collect()
    assert {(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in rows} == want and len(rows) == len(docs)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 5000])
def test_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-2**63, 2**63 - 1, (n, 2), dtype=np.int64)
    hi, lo = keys[:, 0], keys[:, 1]
    if n > 2:
        hi[1], lo[2] = hi[0], lo[0]  # equal halves, different digests
    sizes, words = line_dedup.build_hash(hi, lo)
    assert sorted(line_dedup.find(sizes, words, hi, lo).tolist()) == list(range(n))
    shard = line_dedup.build_shard(hi, lo, np.arange(n) + 2, np.arange(n) * 3)
    count, keeper = line_dedup.probe(shard, hi, lo)
    assert count.tolist() == list(range(2, n + 2)) and keeper.tolist() == list(range(0, 3 * n, 3))
    strangers = rng.integers(-2**63, 2**63 - 1, (1000, 2), dtype=np.int64)
    assert not line_dedup.probe(shard, strangers[:, 0], strangers[:, 1])[0].any()


# -- conversations --------------------------------------------------------------------

def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(rows, faults):
    """Least (cost, audit, repaired rows) by trying every edit; inserts up to two in a gap are enough."""
    def legal(roles):
        s = "".join(r[:1] if r[:1] in ("s", "u", "a") else "?" for r in roles)
        s = s[1:] if s[:1] == "s" and len(s) > 1 else s
        return s == "ua" * (len(s) // 2)
    best = None
    gaps = [()] + [((r, ""),) for r in ("user", "assistant")] + [(("user", ""), ("assistant", "")), (("assistant", ""), ("user", ""))]

    def walk(i, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        for gap in gaps:
            c, a, o = cost + 3 * len(gap), audit + "I" * len(gap), out + list(gap)
            if i == len(rows):
                if legal([r for r, _ in o]) and (best is None or (c, a) < best[:2]):
                    best = (c, a, o)
                continue
            role, text = rows[i]
            walk(i + 1, c + 4, a + "D", o)
            if faults[i] in ("blank", "duplicate"):
                continue
            more = 3 * (faults[i] == "truncated")
            walk(i + 1, c + more, a + "K", o + [(role, text)])
            for r in ("user", "assistant"):
                walk(i + 1, c + 3 + more, a + "R", o + [(r, text)])
    walk(0, 0, "", [])
    return best


def plain_repair(rows):
    """rows: (turn, role, text) in order."""
    faults = faults_of([r[1:] for r in rows])
    cost, audit, out = all_repairs([r[1:] for r in rows], faults)
    turns = {t for t, _, _ in rows if t is not None}
    first = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first)), cost, audit,
            sha("\n".join(f"{r}:{t}" for r, t in out)))


FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Why?", "And?  ", "é…", "Yes."]
    roles = ["user", "assistant", "system", "user", "assistant", " ", "tool", ""]
    out = {}
    for c in range(60):
        turns = sorted(rng.sample(range(-2, 9), rng.randrange(1, 5)))
        out[c] = [(t, rng.choice(roles), rng.choice(texts)) for t in turns]
    out[None] = [(1, "user", "Hello."), (3, "assistant", "Bye.")]
    out[77] = [(None, "user", "Hello.")]
    return out


@pytest.mark.parametrize("width", [conv_repair.SEGMENT_ROWS, 2])
def test_repair_equals_all_edits(spark, width):
    convs = conversations()
    rows = [(c, *r, "x") for c, rs in convs.items() for r in rs]
    random.Random(3).shuffle(rows)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, audit string").repartition(3)
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in conv_repair.repair(given, segment_rows=width, fan=2).collect()}
    assert got == {c: plain_repair(rs) for c, rs in convs.items()}


def test_repaired_rows_and_long_conversation(spark):
    rng = random.Random(2)
    rows = [(5, t, rng.choice(["user", "assistant"]), f"text {rng.randrange(2500)}" + rng.choice(["", "."])) for t in range(3000)]
    rows += [(6, 0, "user", "Hi.")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r["conv_id"]: r for r in conv_repair.repair(given, segment_rows=10**6).collect()}
    small = {r["conv_id"]: r for r in conv_repair.repair(given, segment_rows=7, fan=3).collect()}
    assert whole == small and len(whole[5]["audit"]) >= 3000
    turns = conv_repair.repaired_turns(given, segment_rows=50, fan=4).orderBy("conv_id", "place").collect()
    for c in (5, 6):
        mine = [r for r in turns if r["conv_id"] == c]
        assert [r["place"] for r in mine] == list(range(len(mine)))
        assert sha("\n".join(f"{r['role']}:{r['text']}" for r in mine)) == whole[c]["repaired_sha256"]
        assert "".join(r["role"][0] for r in mine) == "ua" * (len(mine) // 2)


def test_repair_of_nulls_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conv_repair.repair(spark.createDataFrame([], schema)).count() == 0
    got = conv_repair.repair(spark.createDataFrame([(1, None, None, None), (1, None, None, "Ok."), (1, 4, "user", "Ok.")], schema)).first()
    assert (got["gaps"], got["blank"], got["illegal"], got["cost"], got["audit"]) == (0, 1, 2, 10, "RDR")
    gone = spark.createDataFrame([(9, 1, "user", "Hi.", 0)], schema + ", copies int")
    assert tuple(conv_repair.repair(gone).first()) == (9, 0, 0, 0, 0, 0, 0, "", sha(""))


def test_repair_query(spark):
    """Damage by zlib's CRC32, then every edit."""
    convs = {}
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").collect():
        kind = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in r["text"] if c not in ".!?") if kind == 2 else r["text"]
        row = (r["turn"], "user" if kind == 4 else r["role"], text)
        convs.setdefault(r["conv_id"], []).extend([row] * {0: 0, 3: 2}.get(kind, 1))
    want = {c: plain_repair(sorted(rs, key=lambda r: r[0])) for c, rs in convs.items() if len(rs) < 6}
    got = {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in QUERIES["op12_conversation_repair"](spark, SF001).collect()}
    assert set(got) == set(convs) and len(want) > 5
    assert {c: got[c] for c in want} == want


def test_agenda_with_two_premises():
    """The lightest derivation of a conclusion of two premises waits for both."""
    edges = [(("a",), 1, "x", "b"), (("a", "b"), 1, "y", "c"), (("b", "c"), 0, "z", "goal"), (("a",), 9, "w", "c")]
    assert conv_repair.lightest({"a": (0, "")}, edges, "goal")["goal"] == (3, "xxyz")


# -- periodic runs --------------------------------------------------------------------

def plain_runs(words, least, repeats):
    out = []
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            n = j - i + q
            part = words[i:i + n]
            if n >= max(least, repeats * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                out.append((i, n, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize(("least", "repeats"), [(24, 3), (4, 2), (6, 3), (1, 2)])
def test_runs_equal_brute_force(least, repeats):
    rng = random.Random(least)
    for _ in range(300):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            k, words = rng.choice([1, 2, 3, 10]), []
            while len(words) < rng.randrange(1, 150):
                words += [rng.randrange(k) for _ in range(rng.randrange(1, 20))] * rng.choice([1, 1, 2, 3, 4, 10])
            texts.append([b"%d" % w for w in words[:rng.randrange(200)]])
        assert periodic_runs.runs_of(texts, least, repeats) == [plain_runs(t, least, repeats) for t in texts]


def test_runs_of_long_texts():
    same = [b"x"] * 30000
    parts = [b"%d" % (i % 997) for i in range(40000)]
    assert periodic_runs.runs_of([same, parts, []]) == [[(0, 30000, 1)], [(0, 40000, 997)], []]


def plain_row(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 24, 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(runs), *best, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))


def test_runs_query(spark, tmp_path):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 400)))) for i in range(150)]
    docs += [(500, None), (501, ""), (502, " \n\t"), (503, "a b " * 40), (504, "é é x\n" * 30), (503, "a b " * 40)]
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_row(*d) for d in docs), key=str)
    assert sum(r[1] > 0 for r in got) > 10


def test_collapse_keeps_other_columns(spark):
    given = spark.createDataFrame([(None, "go " * 30 + "on", "c"), (2, None, None)], "doc_id long, text string, Best string")
    rows = {r["doc_id"]: r for r in periodic_runs.collapse_runs(given).collect()}
    assert rows[None]["text"] == "go on" and [tuple(r) for r in rows[None]["runs"]] == [(0, 30, 1)]
    assert rows[2]["text"] == "" and rows[2]["runs"] == [] and rows[2]["best"] is None
    assert periodic_runs.collapse_runs(given.where("false"), prepare=periodic_runs.planted).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.collapse_runs(given, repeats=1)
