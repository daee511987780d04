"""Document quality from a linear-chain conditional random field over lines.

Every line (text between line feeds) gets a label good or bad.  Its unary
features describe the line and its two neighbours: character classes, words,
repetition inside the line and of whole lines.  Transition weights tie
neighbouring labels.  Forward-backward gives each line's probability of good;
their mean weighted by line length is the document's raw quality, which a
logistic curve fitted on the same training documents turns into the score.

Labels mark whole documents, so the line labels are found in two rounds
(multiple-instance learning): all lines of a good document are good; those of
a bad one start as bad, and after a first fit of the unary weights only the
lines that it calls bad stay so, and in any case the worst one.

Training uses a bounded sample: at most ``TRAIN_DOCS`` labelled documents of
each class, chosen by the hash of their id, of at most ``TRAIN_LINES`` lines
(longer ones are not used to fit, but scored whole like any other).  A class
that is not in the sample leaves the prior as the score.

Null and empty texts are one empty line.  Rows that share an id are scored by
themselves.  Extra columns stay; ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import free_name, map_texts, read, table

#: Bound of the training sample: documents of each class, and lines of a document in it.
TRAIN_DOCS = 1500
TRAIN_LINES = 128
#: Characters whose features are computed at once.
CHUNK_CHARS = 1 << 21

LETTER, UPPER, DIGIT, SPACE, STOP, SYMBOL, OTHER, BREAK = range(8)
NAMES = ["length", "words", "letters", "upper", "digits", "spaces", "stops", "symbols", "other", "same_as_left",
         "word_length", "repeated_words", "word_as_left", "long_words", "short_words", "ends_stop", "starts_upper",
         "empty", "seen_line", "symbol_words"]


def char_table() -> np.ndarray:
    """Class of every code point below 2^16; those above count as OTHER."""
    out = np.full(1 << 16, OTHER, np.uint8)
    for c in range(1 << 16):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = UPPER if kind == "Lu" else LETTER
        elif kind[0] == "N":
            out[c] = DIGIT
        elif kind[0] == "Z" or c in (9, 11, 12, 13):
            out[c] = SPACE
        elif kind[0] in "PS":
            out[c] = STOP if chr(c) in ".,;:!?'\"()-" else SYMBOL
    out[10] = BREAK
    return out


def line_features(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the number of lines of each text and the lengths of the lines."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = np.where(codes < 1 << 16, table[np.minimum(codes, 0xFFFF)], OTHER).astype(np.uint8)
    ends = np.flatnonzero(kind == BREAK)
    n = len(ends)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    line = np.repeat(np.arange(n), length + 1)
    counts = np.bincount(line * 8 + kind, minlength=8 * n).reshape(n, 8).astype(np.float64)
    size = np.maximum(length, 1)
    same = np.zeros(len(codes), bool)
    same[1:] = (codes[1:] == codes[:-1]) & (kind[1:] != BREAK)
    # words: runs that are neither space nor break
    inside = (kind != SPACE) & (kind != BREAK)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = np.flatnonzero(first)
    if len(at):
        place = np.arange(len(codes), dtype=np.uint64) - np.repeat(at, np.diff(np.append(at, len(codes)))).astype(np.uint64) \
            if at[0] == 0 else np.arange(len(codes), dtype=np.uint64) - np.concatenate(
                [np.zeros(at[0], np.int64), np.repeat(at, np.diff(np.append(at, len(codes))))]).astype(np.uint64)
        mix = (codes.astype(np.uint64) + np.uint64(0x9E37)) * (place * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
        mix *= np.uint64(0xBF58476D1CE4E5B9)
        word = np.add.reduceat(np.where(inside, mix, np.uint64(0)), at)
        width = np.add.reduceat(inside.astype(np.int64), at)
        word_symbols = np.add.reduceat((kind == SYMBOL).astype(np.int64), at)
    else:
        word, width, word_symbols = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    home = line[at]
    n_words = np.bincount(home, minlength=n)
    some = np.maximum(n_words, 1)
    order = np.lexsort((word, home))
    again = np.zeros(len(at), bool)
    if len(at):
        again[order[1:]] = (word[order[1:]] == word[order[:-1]]) & (home[order[1:]] == home[order[:-1]])
    as_left = np.zeros(len(at), bool)
    as_left[1:] = (word[1:] == word[:-1]) & (home[1:] == home[:-1])
    def of(x):
        return np.bincount(home, x, minlength=n) / some
    # whole lines seen before in their text
    per_text = np.array([t.count("\n") + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), per_text)
    line_hash = np.zeros(n, np.uint64)
    np.add.at(line_hash, home, (word ^ (word >> np.uint64(31))) * (np.arange(len(at), dtype=np.uint64) - np.repeat(
        np.cumsum(n_words) - n_words, n_words).astype(np.uint64) + np.uint64(1)))
    by = np.lexsort((np.arange(n), line_hash, owner))
    seen = np.zeros(n, bool)
    seen[by[1:]] = (line_hash[by[1:]] == line_hash[by[:-1]]) & (owner[by[1:]] == owner[by[:-1]]) & (length[by[1:]] > 0)
    letters = counts[:, LETTER] + counts[:, UPPER]
    last = kind[np.maximum(ends - 1, 0)]
    feats = np.stack([
        np.log1p(length), np.log1p(n_words), letters / size, counts[:, UPPER] / np.maximum(letters, 1),
        counts[:, DIGIT] / size, counts[:, SPACE] / size, counts[:, STOP] / size, counts[:, SYMBOL] / size,
        counts[:, OTHER] / size, np.bincount(line, same, minlength=n) / size, np.log1p(of(width)), of(again), of(as_left),
        of(width > 12), of(width <= 3), (last == STOP) & (length > 0), kind[starts] == UPPER, length == 0, seen,
        of(word_symbols > 0)], axis=1).astype(np.float64)
    return feats, per_text, length


def long_text_features(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``line_features`` of one very long text, a run of lines at a time; repeated lines are known by their digest."""
    lines, feats, lengths, known, at = text.split("\n"), [], [], set(), 0
    while at < len(lines):
        to, size = at, 0
        while to < len(lines) and (to == at or size + len(lines[to]) <= CHUNK_CHARS):
            size += len(lines[to])
            to += 1
        f, _, n = line_features(["\n".join(lines[at:to])], table)
        for k in range(at, to):
            words = hash(tuple(lines[k].split()))
            f[k - at, NAMES.index("seen_line")] = bool(lines[k]) and words in known
            known.add(words)
        feats.append(f)
        lengths.append(n)
        at = to
    return np.concatenate(feats), np.array([len(lines)]), np.concatenate(lengths)


def with_neighbours(feats: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Line features beside those of the line before and after (zeros and a flag at the ends), and a constant."""
    n = len(feats)
    stops = np.cumsum(per_text)
    is_first, is_last = np.zeros(n, bool), np.zeros(n, bool)
    is_first[stops - per_text] = True
    is_last[stops - 1] = True
    before, after = np.roll(feats, 1, axis=0), np.roll(feats, -1, axis=0)
    before[is_first] = 0
    after[is_last] = 0
    return np.column_stack([feats, before, after, is_first, is_last, np.ones(n)])


def pad(values: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of lines as a matrix texts x longest, and the mask of its filled cells."""
    width = int(per_text.max())
    mask = np.arange(width) < per_text[:, None]
    out = np.zeros((len(per_text), width))
    out[mask] = values
    return out, mask


def forward_backward(unary: np.ndarray, mask: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log partition, P(good) of every line and expected transition counts.

    ``unary``: log-odds of good (texts x lines); ``trans``: 2 x 2 log weights.
    """
    n, width = unary.shape
    emit = np.stack([np.zeros_like(unary), unary], axis=2)
    alpha = np.zeros((n, width, 2))
    beta = np.zeros((n, width, 2))
    alpha[:, 0] = emit[:, 0]
    for t in range(1, width):
        step = np.logaddexp(alpha[:, t - 1, :1] + trans[0], alpha[:, t - 1, 1:] + trans[1]) + emit[:, t]
        alpha[:, t] = np.where(mask[:, t, None], step, alpha[:, t - 1])
    for t in range(width - 2, -1, -1):
        on = emit[:, t + 1] + beta[:, t + 1]
        step = np.logaddexp(trans[:, 0] + on[:, :1], trans[:, 1] + on[:, 1:])
        beta[:, t] = np.where(mask[:, t + 1, None], step, 0.0)
    log_z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    both = alpha + beta
    good = 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500)))
    pair = np.zeros((2, 2))
    if width > 1:
        for i in range(2):
            for j in range(2):
                x = alpha[:, :-1, i] + trans[i, j] + emit[:, 1:, j] + beta[:, 1:, j] - log_z[:, None]
                pair[i, j] = np.exp(np.minimum(x, 0))[mask[:, 1:]].sum()
    return log_z, good, pair


class Adam:
    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, w: np.ndarray, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * grad
        self.v = 0.999 * self.v + 0.001 * grad ** 2
        return w - self.rate * (self.m / (1 - 0.9 ** self.t)) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-9)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 150, l2: float = 1e-3) -> np.ndarray:
    w, opt = np.zeros(x.shape[1]), Adam(x.shape[1], 0.05)
    total = max(weight.sum(), 1e-9)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        w = opt.step(w, x.T @ (weight * (p - y)) / total + l2 * w)
    return w


def fit(docs: list[tuple[np.ndarray, np.ndarray, int]], rounds: int = 60, l2: float = 1e-3) -> dict:
    """Weights from ``(line features, line lengths, label)`` of training documents."""
    labels = np.array([d[2] for d in docs], float)
    if not len(docs) or labels.min() == labels.max():
        share = float(labels.mean()) if len(docs) else 0.5
        return {"prior": share}
    per_text = np.array([len(d[0]) for d in docs])
    base = np.concatenate([d[0] for d in docs])
    mean, std = base.mean(axis=0), base.std(axis=0) + 1e-6
    x = with_neighbours((base - mean) / std, per_text)
    owner = np.repeat(np.arange(len(docs)), per_text)
    of_doc = labels[owner]
    length = np.concatenate([d[1] for d in docs])
    # round one: every line has its document's label, classes weigh the same
    even = np.where(of_doc == 1, 0.5 / max((of_doc == 1).sum(), 1), 0.5 / max((of_doc == 0).sum(), 1)) * len(of_doc)
    first = x @ logistic(x, of_doc, even)
    y = of_doc.copy()
    worst = np.full(len(docs), np.inf)
    np.minimum.at(worst, owner, first)
    y[(of_doc == 0) & (first > 0) & (first > worst[owner])] = 1
    # round two: the chain
    gold, mask = pad(y, per_text)
    pairs = np.array([[((gold[:, :-1] == i) & (gold[:, 1:] == j) & mask[:, 1:]).sum() for j in range(2)] for i in range(2)], float)
    k = x.shape[1]
    w, trans = np.zeros(k), np.zeros(4)
    opt = Adam(k + 4, 0.05)
    n = len(y)
    for _ in range(rounds):
        u, _ = pad(x @ w, per_text)
        _, good, pair = forward_backward(u, mask, trans.reshape(2, 2))
        grad = np.concatenate([x.T @ (good[mask] - y) / n + l2 * w, (pair - pairs).ravel() / n + l2 * trans])
        new = opt.step(np.concatenate([w, trans]), grad)
        w, trans = new[:k], new[k:]
    u, _ = pad(x @ w, per_text)
    good = forward_backward(u, mask, trans.reshape(2, 2))[1][mask]
    raw = aggregate(good, length, per_text)
    curve = logistic(np.column_stack([logit(raw), np.ones(len(raw))]), labels,
                     np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum()) * len(labels), rounds=2000, l2=1e-6)
    return {"mean": mean, "std": std, "w": w, "trans": trans.reshape(2, 2), "curve": curve}


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def aggregate(good: np.ndarray, length: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Mean of the lines' probabilities weighted by length plus one."""
    owner = np.repeat(np.arange(len(per_text)), per_text)
    weight = length + 1.0
    return np.bincount(owner, weight * good, minlength=len(per_text)) / np.bincount(owner, weight, minlength=len(per_text))


def score(texts: list[str], model: dict, table: np.ndarray) -> np.ndarray:
    """Score of each whole text."""
    if "prior" in model or not texts:
        return np.full(len(texts), model.get("prior", 0.5))
    out, at = np.zeros(len(texts)), 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= CHUNK_CHARS):
            size += len(texts[to])
            to += 1
        feats, per_text, length = line_features(texts[at:to], table) if size <= CHUNK_CHARS else long_text_features(texts[at], table)
        x = with_neighbours((feats - model["mean"]) / model["std"], per_text)
        unary = x @ model["w"]
        good = np.zeros(len(unary))
        stops = np.cumsum(per_text)
        ranked = np.argsort(per_text, kind="stable")
        for part in np.array_split(ranked, max(1, len(ranked) // 64)):  # texts of similar length share a matrix
            lines = np.concatenate([np.arange(stops[i] - per_text[i], stops[i]) for i in part])
            u, mask = pad(unary[lines], per_text[part])
            good[lines] = forward_backward(u, mask, model["trans"])[1][mask]
        raw = aggregate(good, length, per_text)
        out[at:to] = 1 / (1 + np.exp(-(model["curve"][0] * logit(raw) + model["curve"][1])))
        at = to
    return out


def train(docs: DataFrame, labels: DataFrame, fold=None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_docs: int = TRAIN_DOCS, max_lines: int = TRAIN_LINES) -> dict:
    """Fit on a bounded sample of ``docs`` with a label 0 or 1 in ``labels``.

    ``fold``: a Boolean column expression over ``doc_id``; only rows where it
    holds give labels.  Of an id with several labels the smallest counts.
    """
    y = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("y IN (0, 1)")
    y = y.where(fold) if fold is not None else y
    y = y.groupBy("doc_id").agg(F.min("y").alias("y"))
    # only documents that can be used are counted: there, with a text of few lines
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    usable = docs.where(lines <= max_lines).select(F.col(id_col).alias("doc_id")).distinct()
    y = table(y.join(usable, "doc_id"), "quality-labels")
    key = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    wanted = None
    for v in (0, 1):
        one = y.where(F.col("y") == v).orderBy(key, "doc_id").limit(max_docs)
        wanted = one if wanted is None else wanted.unionByName(one)
    sample = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
              .join(F.broadcast(wanted), "doc_id"))  # at most 2 * max_docs rows of two numbers
    rows = T.StructType([T.StructField("feats", T.ArrayType(T.DoubleType())), T.StructField("lengths", T.ArrayType(T.DoubleType()))])

    def task():
        table = char_table()

        def run(cols):
            out = {"feats": [], "lengths": []}
            for t in cols[0]:
                t = t or ""
                if t.count("\n") >= max_lines:
                    out["feats"].append(None)
                    out["lengths"].append(None)
                else:
                    f, _, n = line_features([t], table)
                    out["feats"].append(f.ravel())
                    out["lengths"].append(n.astype(float))
            return out
        return run
    got = (map_texts(sample, ["text"], rows, task).where("feats IS NOT NULL")
           .dropDuplicates(["doc_id"]).select("doc_id", "y", "feats", "lengths").collect())
    got.sort(key=lambda r: r[0])
    return fit([(np.array(r[2]).reshape(-1, len(NAMES)), np.array(r[3]), r[1]) for r in got])


SCORE = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def classify(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` of every whole text.  The model is some hundred numbers."""
    def task():
        table = char_table()

        def run(cols):
            s = np.clip(score([t or "" for t in cols[0]], model, table), 0, 1)
            return {"score": s, "predicted": (s >= 0.5).astype(np.int32)}
        return run
    return map_texts(docs, [text_col], SCORE, task)


def keep_good(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted good, columns as they are."""
    def task():
        table = char_table()
        return lambda cols: {name: score([t or "" for t in cols[0]], model, table) >= 0.5}
    name = free_name(docs.columns, "good")
    scored = map_texts(docs, [text_col], T.StructType([T.StructField(name, T.BooleanType())]), task)
    return scored.where(scored[name]).drop(name)


def in_fold(remainder: int, of: int):
    """crc32 of the id's text, modulo ``of``, is ``remainder``."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == remainder


def op9_quality_crf(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read(spark, sf_dir, "labels"), fold=~in_fold(1, 3))
    return classify(docs, model).select("doc_id", F.coalesce(in_fold(1, 3), F.lit(False)).alias("held_out"), "score", "predicted")
