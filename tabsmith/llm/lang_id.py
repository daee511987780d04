"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, everything but letters becomes a space and runs of spaces
one; n-grams of 1 to ``ORDERS`` characters (none of spaces alone) are hashed to
buckets.  Training counts n-grams by language in Spark.  The log-probability
matrix is cut in shards of ``SHARD_LANGS`` languages, each broadcast alone; a batch
is scored as a sparse product: the rows of its n-grams are gathered and summed
by text.  More languages mean more passes, not another model: the buckets are
the same for any number of them.

Training reads a bounded sample: about ``TRAIN_DOCS`` documents of each
language, those with the smallest hashes of their id; rarer languages give all
they have.  Null languages teach nothing.

``score`` is the posterior probability of the predicted language.  A text that
is null or has no letter gets ``und`` and score 0, as does any text where no
language was learned.  Ties go to the first language by name.  Whole texts are
scored; rows that share an id are scored by themselves; extra columns stay
(``lang_pred`` and ``score`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import free_name, map_texts, read

ORDERS = 3
TRAIN_DOCS = 3000
BUCKETS = 1 << 16
SHARD_LANGS = 64
ALPHA = 0.1
#: Numbers gathered at once (n-grams x languages); bounds memory on very long texts and many languages.
GATHERED = 1 << 22


def letter_table() -> np.ndarray:
    """For every code point below 2^16 its small letter, or a space if it is no letter."""
    return np.array([(ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c) if chr(c).isalpha() else 32
                     for c in range(1 << 16)], np.uint32)


def normal(text: str, table: np.ndarray) -> np.ndarray:
    """Code points of the whole text: small letters, other signs as spaces, one for each run."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(codes < 1 << 16, table[np.minimum(codes, 0xFFFF)], codes)
    space = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return codes[keep]


def grams(text: str, table: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all n-grams of a text."""
    return code_grams(normal(text, table), buckets)


def code_grams(codes: np.ndarray, buckets: int, starts: int | None = None) -> np.ndarray:
    """Buckets of the n-grams of normal ``codes``, of those that begin among the first ``starts`` if given."""
    codes = codes.astype(np.uint64)
    out, h = [], np.zeros(len(codes), np.uint64)
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for n in range(1, ORDERS + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        h = (h[:m] + codes[n - 1:] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        b = (h * np.uint64(0xD6E8FEB86659FD93)) >> shift
        b = b[:starts]
        out.append(b[codes[:len(b)] != 32] if n == 1 else b)
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def pieces(text: str, table: np.ndarray, buckets: int, langs: int) -> Iterator[np.ndarray]:
    """The n-grams of the whole text, each once, in pieces of bounded size."""
    codes = normal(text, table)
    size = max(1 << 10, GATHERED // (ORDERS * max(1, langs)))
    for at in range(0, max(1, len(codes)), size):
        yield code_grams(codes[at:at + size + ORDERS - 1], buckets, size)


def train(docs: DataFrame, fold=None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_lang: int = TRAIN_DOCS, buckets: int = BUCKETS) -> dict:
    """Languages and their log-probability matrix, from rows with a language where ``fold`` holds."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(fold) if fold is not None else rows
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row for each language
    if not sizes:
        return {"langs": []}
    langs = sorted(sizes)
    share = docs.sparkSession.createDataFrame([(x, min(1.0, per_lang / sizes[x])) for x in langs], "lang string, share double")
    chance = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(share), "lang").where(chance < F.col("share")).select("lang", "text")
    number = {x: k for k, x in enumerate(langs)}

    def count(batches):
        import pyarrow as pa
        table = letter_table()
        total: dict[int, np.ndarray] = {}

        def told():
            for k, n in total.items():
                b = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b), k, np.int32)), pa.array(b.astype(np.int32)), pa.array(n[b])],
                                                 names=["k", "b", "n"])
            total.clear()
        for batch in batches:
            for lang, text in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "text")), strict=True):
                if number[lang] not in total:
                    if len(total) >= SHARD_LANGS:
                        yield from told()
                    total[number[lang]] = np.zeros(buckets, np.int64)
                for g in pieces(text, table, buckets, 1):
                    total[number[lang]] += np.bincount(g, minlength=buckets)
        yield from told()

    counts = sample.mapInArrow(count, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n")).toPandas()
    matrix = np.full((buckets, len(langs)), ALPHA)
    matrix[counts["b"].to_numpy(), counts["k"].to_numpy()] += counts["n"].to_numpy()
    prior = np.log(np.array([sizes[x] for x in langs], float) / sum(sizes.values()))
    return {"langs": langs, "log_p": np.log(matrix / matrix.sum(axis=0)), "prior": prior}


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Scorer:
    def __init__(self, model: dict):
        self.model, self.table = model, letter_table()

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and posterior probability of each text among the model's languages."""
        pred, top, mass = self.best(texts)
        return pred, np.where(np.isfinite(top), np.minimum(1.0, 1 / mass), 0.0)

    def best(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Of each text the best language, its log-probability, and the sum of all languages' probabilities over the best one's."""
        langs = self.model["langs"]
        pred, score, weight = ["und"] * len(texts), np.full(len(texts), -np.inf), np.ones(len(texts))
        which = [k for k, t in enumerate(texts) if langs and has_letter(t)]
        if not which:
            return pred, score, weight
        matrix, prior = self.model["log_p"], self.model["prior"]
        total = np.tile(prior, (len(which), 1))
        held, owners, size = [], [], 0

        def flush():
            nonlocal held, owners, size
            if not held:
                return
            rows = np.concatenate(held)
            at = np.cumsum([0] + [len(h) for h in held[:-1]])
            np.add.at(total, owners, np.add.reduceat(matrix[rows], at, axis=0))
            held, owners, size = [], [], 0
        for j, k in enumerate(which):
            for g in pieces(texts[k], self.table, len(matrix), len(langs)):
                if len(g):
                    held.append(g)
                    owners.append(j)
                    size += len(g) * len(langs)
                if size > GATHERED:
                    flush()
        flush()
        best = total.argmax(axis=1)
        top = total[np.arange(len(which)), best]
        mass = np.exp(total - top[:, None]).sum(axis=1)
        for j, k in enumerate(which):
            pred[k], score[k], weight[k] = langs[best[j]], top[j], mass[j]
        return pred, score, weight


PREDICTION = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def combined(old: dict | None, pred: list[str], top: np.ndarray, mass: np.ndarray) -> dict:
    """The better one of two shards' predictions of each text (the earlier on a tie) and the mass of both beside it."""
    if old is None:
        return {"pred": pred, "top": top, "mass": mass}
    first = old["top"] >= top
    best = np.maximum(old["top"], top)
    with np.errstate(invalid="ignore"):
        both = [np.where(np.isfinite(t), m * np.exp(t - best), 0.0) for t, m in ((old["top"], old["mass"]), (top, mass))]
    return {"pred": [a if f else b for f, a, b in zip(first, old["pred"], pred, strict=True)], "top": best, "mass": both[0] + both[1]}


def identify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of every whole text; a pass for every ``SHARD_LANGS`` languages."""
    langs = model["langs"]
    shards = [slice(at, at + SHARD_LANGS) for at in range(0, max(1, len(langs)), SHARD_LANGS)]
    state = free_name(docs.columns, "lang_state")
    kept = T.StructType([T.StructField("pred", T.StringType()), T.StructField("top", T.DoubleType()), T.StructField("mass", T.DoubleType())])
    out = docs
    for number, shard in enumerate(shards):
        part = {"langs": langs[shard]}
        if langs:
            part |= {"log_p": np.ascontiguousarray(model["log_p"][:, shard], np.float32), "prior": model["prior"][shard]}
        held = docs.sparkSession.sparkContext.broadcast(part)

        def task(held=held, number=number):
            scorer = Scorer(held.value)

            def run(cols):
                pred, top, mass = scorer.best(cols[0])
                old = None
                if number:
                    old = {"pred": [r["pred"] for r in cols[1]], "top": np.array([r["top"] for r in cols[1]]), "mass": np.array([r["mass"] for r in cols[1]])}
                now = combined(old, pred, top, mass)
                if number + 1 < len(shards):
                    return {state: [{"pred": p, "top": t, "mass": m} for p, t, m in zip(now["pred"], now["top"].tolist(), now["mass"].tolist(), strict=True)]}
                known = np.isfinite(now["top"])
                return {"lang_pred": now["pred"], "score": np.where(known, np.minimum(1.0, 1 / now["mass"]), 0.0)}
            return run
        last = number + 1 == len(shards)
        out = map_texts(out, [text_col] + [state] * bool(number), PREDICTION if last else T.StructType([T.StructField(state, kept)]), task)
    return out.drop(state)


def in_fold(remainder: int, of: int):
    """crc32 of the id's text, modulo ``of``, is ``remainder``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, fold=~in_fold(0, 5))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(in_fold(0, 5), F.lit(False)).alias("held_out"), "lang_pred", "score")
