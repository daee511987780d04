import hashlib
import os
import shutil
import subprocess
import sys

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tabsmith.llm import bpe, decontam, pii, quality_crf, simhash
from tests.conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_run_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = quality_crf.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    table = quality_crf.char_table()
    rows = {r.doc_id: r.text for r in docs.collect() if quality_crf.score([r.text], model, table)[0] >= 0.5}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    known = [i for i in labels if i in {r.doc_id for r in docs.collect()}]
    assert np.mean([(i in rows) == (labels[i] == 1) for i in known]) > 0.97
    # single linkage over all pairs of fingerprints
    fps, root = {i: simhash.fingerprint(t) & (1 << 64) - 1 for i, t in rows.items()}, {i: i for i in rows}
    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    ids = sorted(rows)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = {i: t for i, t in rows.items() if find(i) == i}
    # every five-word shingle of every item looked up in the whole text
    items = [decontam.words(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    def leaks(text):
        ws = decontam.words(text)
        there = {tuple(ws[k:k + 5]) for k in range(len(ws) - 4)}
        for item in items:
            hit = [k for k in range(len(item) - 4) if tuple(item[k:k + 5]) in there]
            if len({k + j for k in hit for j in range(5)}) >= 0.8 * len(item):
                return True
        return False
    rows = {i: t for i, t in rows.items() if not leaks(t)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    want = {}
    for i, t in rows.items():
        t = pii.redact(t, pii.find(t)[1])
        tokens = enc.encode_ordinary(t)
        want[i] = (len(tokens), hashlib.sha256(np.array(tokens, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got == want and 0 < len(got) < len(fps)


def test_stages_take_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(1, None, None, None, None, None), (1, None, None, None, None, None), (None, "", "en", "s", 0, 1.0),
            (2, "word " * 50_000, "en", "s", 250_000, 1.0), (3, "Mail me: a@b.co, please.", "en", None, 24, None)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            if name != "tokens":
                assert out.columns == docs.columns
            assert out.count() <= len(part)


def test_the_rest_works_without_the_corpus_part(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "corpus_pipeline.py", "__pycache__")])
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, check=True, env=env, timeout=120)
