"""Long items, many languages, long documents, clashing names, workers without the package."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest

from tabsmith.llm import decontam, lang_id, pii, quality_crf, simhash

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def named(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(n)]


# -- decontamination of long items ------------------------------------------------------

@pytest.mark.parametrize("n", [100, 128, 129, 133, 192, 193, 300, 1000])
def test_units_overlap_and_none_is_short(n):
    ws = [w.encode() for w in named(n, n)]
    got = decontam.units(" ".join(w.decode() for w in ws))
    assert all(64 <= len(w) <= 128 or n <= 128 for w, _ in got)
    at = [ws.index(w[0]) for w, _ in got]
    assert at[0] == 0 and at[-1] + len(got[-1][0]) == n
    for a, (w, _), b in zip(at, got, at[1:], strict=False):
        assert ws[a:a + len(w)] == w and b < a + len(w) <= b + 66


def leaks(spark, items, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    kept = {r["doc_id"] for r in decontam.decontaminate(rows, bench).collect()}
    found = {(r["doc_id"], r["item_id"]): r["overlap"] for r in decontam.retrieve(rows, bench).where("contaminated").collect()}
    assert {d for d, _ in found} == set(range(len(texts))) - kept
    return found


def test_long_items_by_their_covered_share(spark):
    w133, w300, other = named(133, 1), named(300, 2), named(900, 3)
    fill = lambda a, b: " ".join(other[a:b])
    copied = lambda ws: fill(0, 200) + " " + " ".join(ws) + " " + fill(200, 400)
    odd = [w for i, w in enumerate(w300) if not 120 <= i < 178]      # a gap of a fifth in the middle
    texts = [copied(w133[-5:]), copied(w133), copied(w300[64:192]), copied(w300[128:256]), copied(w300), copied(w300[:250]), copied(w300[50:]),
             copied(odd), copied(w300[:150]) + " " + copied(w300[150:]), copied(w300[100:150]), fill(0, 900),
             " ".join(" ".join(w300[a:a + 44]) + " " + fill(a, a + 25) for a in range(0, 300, 50))]
    found = leaks(spark, [" ".join(w133), " ".join(w300)], texts)
    # a stretch as long as a unit counts wherever it begins, a short one does not; pieces over the text add up
    assert set(found) == {(1, 0), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1), (8, 1), (11, 1)}
    assert found[4, 1] == 1.0 and found[11, 1] >= 264 / 300


# -- many languages ---------------------------------------------------------------------

def test_languages_beyond_a_shard_change_nothing(spark, monkeypatch):
    rng = random.Random(1)
    langs = [f"l{i:03d}" for i in range(130)]
    speak = {x: named(12, i) for i, x in enumerate(langs)}
    rows = [(i, " ".join(rng.choice(speak[x]) for _ in range(30)), x, "s") for i, x in enumerate(langs * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, LANG_STATE string")
    model = lang_id.train(df)
    assert model["log_p"].shape == (lang_id.BUCKETS, 130)
    whole = dict(zip([r[0] for r in rows], zip(*lang_id.Scorer(model).predict([r[1] for r in rows]), strict=True), strict=True))
    got = lang_id.identify(df, model)
    assert got.columns == ["doc_id", "text", "lang", "LANG_STATE", "lang_pred", "score"]
    for r in got.collect():
        assert r["lang_pred"] == r["lang"] == whole[r["doc_id"]][0] and r["score"] == pytest.approx(whole[r["doc_id"]][1], abs=1e-4)


def test_no_gram_is_counted_twice(monkeypatch):
    table = lang_id.letter_table()
    text = "Ein Text,  mit   Lücken \n\n und Zeichen; " * 200
    monkeypatch.setattr(lang_id, "GATHERED", 0)
    pieces = np.concatenate(list(lang_id.pieces(text, table, lang_id.BUCKETS, 3)))
    assert sorted(pieces.tolist()) == sorted(lang_id.grams(text, table, lang_id.BUCKETS).tolist())


# -- a class of long documents -----------------------------------------------------------

def test_quality_sample_is_drawn_from_usable_documents(spark):
    good = "A full sentence of plain words stands here.\nAnother one follows it, as it should.\n"
    bad = "click here $$$\n>>> buy now !!!\n"
    docs = [(i, good * 80, None) for i in range(30)] + [(100 + i, good, None) for i in range(3)] + [(200 + i, bad, None) for i in range(10)]
    labels = [(i, 1) for i in range(30)] + [(100 + i, 1) for i in range(3)] + [(200 + i, 0) for i in range(10)] + [(900 + i, 1) for i in range(50)]
    d = spark.createDataFrame(docs, "doc_id long, text string, Score string")
    model = quality_crf.train(d, spark.createDataFrame(labels, "doc_id long, quality int"), max_docs=3, max_lines=20)
    got = quality_crf.classify(d, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"]
    by = {r["doc_id"]: r["predicted"] for r in got.collect()}
    assert by[100] == 1 and by[200] == 0 and by[0] == 1


# -- names -----------------------------------------------------------------------------

def test_clashing_names_stay_the_users(spark):
    text = "some words of a text that nobody else has, with name@host.com in it"
    d = spark.createDataFrame([(1, text, "a", "b", "c", "d"), (2, text, "e", "f", "g", "h")],
                              "doc_id long, text string, __leak string, Gone string, GOOD string, Leak string")
    bench = spark.createDataFrame([(1, " ".join(named(20, 5)))], "item_id long, text string")
    out = decontam.decontaminate(d, bench)
    assert out.columns == d.columns and sorted(map(tuple, out.collect())) == sorted(map(tuple, d.collect()))
    one = simhash.dedup(d)
    assert one.columns == d.columns and [tuple(r) for r in one.collect()] == [(1, text, "a", "b", "c", "d")]
    kept = quality_crf.keep_good(d, quality_crf.train(d, spark.createDataFrame([(1, 1)], "doc_id long, quality int")))
    assert kept.columns == d.columns
    spans = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, Base_Spans string")
    assert [s["kind"] for s in pii.detect(spans).select("base_spans").first()[0]] == ["email"]


# -- workers ---------------------------------------------------------------------------

def test_queries_run_where_workers_have_no_package():
    code = ("import importlib.util\n"
            f"spec = importlib.util.spec_from_file_location('e', '{ROOT}/__spark_entry__.py')\n"
            "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[4]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '4').getOrCreate()\n"
            "q = m.queries()\n"
            "for n in sorted(x for x in q if x.startswith('op') or x == 'pipeline'):\n"
            "    print('ran', n, q[n](s, '/root/testdata/sf0.001').count())\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/tmp", capture_output=True, text=True, timeout=900, env=env)
    assert out.stdout.count("ran ") >= 14, out.stderr[-3000:]
