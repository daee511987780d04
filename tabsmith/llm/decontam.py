"""Benchmark decontamination: every training passage queries a BM25 index of the test items.

Words: runs of letters and digits, lower-cased.  An item's question is all but
its last sentence, its answer the last one (an item of one sentence is all
question).  Test items of more than ``UNIT_WORDS`` words are cut into equal blocks
of half that many at most, and every two neighbouring blocks are a unit; so units
overlap by half and none is short.

Index: BM25 impacts of each (word, unit), divided by the unit's own total, so
a passage that holds all words of a unit scores 1.  The question of a unit that
has an answer is an entry of its own beside question plus answer, with its own
total.  Posting lists are cut into blocks of ``BLOCK`` entries with the block's
largest impact.

Threshold: of each entry the least score that ``OVERLAP`` of its words leave,
whichever words are missing, and ``THRESHOLD`` at most; so no pair that the
check would find is lost before it.  Of a long item's units it is the least score
that ``UNIT_OVERLAP`` leaves: an item that is covered to ``OVERLAP`` has a unit that
is covered to more than that (0.7 for three blocks, more for others).

Query, as in block-max WAND: words whose impacts may be added up to ``SLACK``
(half the threshold where that is less) in any entry are non-essential; a
passage that reaches the threshold in an entry must get the rest from essential words.  The block bounds of a passage's
essential words are summed; only (passage, block) pairs whose bound plus slack
reaches the threshold have their postings opened, which gives a closer bound
by entry, and the pairs that still reach it get exact scores.  The bounds never
lose a pair.

Passages: windows of twice the step, one every step, where a step is 1.25
times the longest unit, so a copy of any unit lies whole in some window.

Check: the share of the question's (answer's) words that lie in five-word
shingles found in the passage.  A pair is contaminated if question, or
question and answer together, reach ``OVERLAP``.  Of a long item each unit counts
like an item, so a copied stretch of some 120 words is found wherever it begins;
and once a unit is retrieved the item's words are looked up in the whole text, so its
covered share over all passages counts, too.  An item of fewer than five words
counts only as a text's only words.

The index is broadcast in shards of at most ``SHARD_POSTINGS`` postings; more
items mean more passes over the documents, not a larger broadcast.  Null or
empty texts and items match nothing; no items, no matches.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabsmith.llm.common import by_value, free_name, map_texts, read, table

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.8
UNIT_OVERLAP = 0.68
SHINGLE = 5
UNIT_WORDS = 128
BLOCK = 8
SLACK = 0.2
#: Up to so many (passage, block or unit) cells are summed in a dense array, more by sorting.
DENSE_CELLS = 1 << 22
SHARD_POSTINGS = 1_000_000

#: ASCII signs and spaces become a space, capitals small letters; bytes above 127 stay.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SIGNS = re.compile("[ -©«-´¶-¹»-¿×÷ -⁯←-⯿　-〄〇-〰！-／：-＠]")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words(text: str | None) -> list[bytes]:
    text = text or ""
    if not text.isascii():
        text = text.lower()
        if _SIGNS.search(text):
            text = _SIGNS.sub(" ", text)
    return text.encode("utf-8", "replace").translate(_BYTES).split()


def whole_item(text: str | None) -> tuple[list[bytes], int]:
    """The words of an item and how many of them are the question's."""
    all_words = words(text)
    sentences = [w for w in map(words, _SENTENCE.split((text or "").strip())) if w]
    return all_words, len(all_words) - (len(sentences[-1]) if len(sentences) > 1 else 0)


def units(text: str | None, size: int = UNIT_WORDS) -> list[tuple[list[bytes], int]]:
    """``(words, number of question words)`` of every unit of an item."""
    all_words, question = whole_item(text)
    n = len(all_words)
    if n <= size:
        return [(all_words, question)] if n else []
    blocks = -(-n // (size // 2))
    edges = [n * i // blocks for i in range(blocks + 1)]
    return [(all_words[a:b], max(0, min(b, question) - a)) for a, b in zip(edges, edges[2:], strict=False)]


UNITS = T.StructType([T.StructField("units", T.ArrayType(T.StructType([
    T.StructField("words", T.ArrayType(T.StringType())), T.StructField("question", T.IntegerType())]))),
    T.StructField("whole", T.ArrayType(T.StringType())), T.StructField("whole_question", T.IntegerType())])


def build_index(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list["Index"]:
    """Index shards; document frequencies and lengths cover all items."""
    def task():
        def run(cols):
            out = {"units": [], "whole": [], "whole_question": []}
            for t in cols[0]:
                parts, (whole, question) = units(t), whole_item(t)
                out["units"].append([{"words": [x.decode("utf-8", "replace") for x in w], "question": q} for w, q in parts])
                out["whole"].append([x.decode("utf-8", "replace") for x in whole] if len(parts) > 1 else None)
                out["whole_question"].append(question)
            return out
        return run
    cut = map_texts(items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")), ["text"], UNITS, task)
    cut = table(cut.withColumn("row", F.monotonically_increasing_id()), "bench-items")   # equal ids are items of their own
    cut = table(cut.select("row", "item_id", "whole", "whole_question", F.posexplode("units").alias("part", "u"))
                .select("row", "item_id", "part", "u.*", F.when(F.col("part") == 0, F.col("whole")).alias("whole"), "whole_question"), "bench-units")
    df = table(cut.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count(), "bench-df")
    asked = F.when((F.col("question") >= SHINGLE) & (F.col("question") < F.size("words")),
                   F.size(F.array_distinct(F.slice("words", F.lit(1), F.greatest("question", F.lit(1)))))).otherwise(0)
    n, total, largest, postings = cut.agg(F.count("*"), F.sum(F.size("words")), F.max(F.size("words")),
                                          F.sum(F.size(F.array_distinct("words")) + asked)).first()
    if not n:
        return []
    shards = -(-postings // (SHARD_POSTINGS // 2))
    out = []
    for s in range(shards):
        mine = cut.where(F.pmod(F.xxhash64("row"), F.lit(shards)) == s)
        rows = mine.orderBy("item_id", "row", "part").collect()  # about half of SHARD_POSTINGS words
        if not rows:
            continue
        freq = dict(mine.select(F.explode("words").alias("w")).distinct().join(df, "w").select("w", "count").collect())
        long = {r["row"]: ([w.encode() for w in r["whole"]], r["whole_question"]) for r in rows if r["whole"]}
        out.append(Index([(r["item_id"], [w.encode() for w in r["words"]], r["question"]) for r in rows],
                         {w.encode(): c for w, c in freq.items()}, n, total / n, largest, [long.get(r["row"]) for r in rows]))
    return out


def _ranges(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, stop), one range after the other."""
    count = stop - start
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


def _sums(key: np.ndarray, value: np.ndarray, size: int) -> np.ndarray:
    """For each element the sum of the values with its key; keys are below ``size``."""
    if size <= DENSE_CELLS:
        return np.bincount(key, value, minlength=size)[key]
    _, at = np.unique(key, return_inverse=True)
    return np.bincount(at, value)[at]


def least_score(impacts: list[float], n: int, missing: int | None = None, share: float = OVERLAP) -> float:
    """The least score of a passage that covers ``share`` of ``n`` words, or all but ``missing``; ``THRESHOLD`` at most.

    ``impacts``: of every word its term's impact, shared among the term's places.
    """
    missing = int(n * (1 - share) + 1e-9) if missing is None else missing
    return min(THRESHOLD, 1 - sum(sorted(impacts, reverse=True)[:missing]) - 1e-9)


class Index:
    """Impacts in posting lists with block maxima, for units ``(item id, words, question words)``.

    Entries of the lists: every unit whole, under its own number, then the questions; ``of``: an entry's unit.
    """

    def __init__(self, rows: list[tuple[int, list[bytes], int]], freq: dict[bytes, int], n: int, mean: float, largest: int,
                 long: list[tuple[list[bytes], int] | None] | None = None):
        """``long``: of every unit that is a part of a longer item that item's words and number of question words."""
        self.long = long or [None] * len(rows)
        self.items = [r[0] for r in rows]
        self.words = [r[1] for r in rows]
        self.question = [r[2] for r in rows]
        self.step = max(8, -(-largest * 5 // 4))
        self.terms = {w: k for k, w in enumerate(sorted({w for r in rows for w in r[1]}))}
        asked = [u for u, (_, ws, q) in enumerate(rows) if SHINGLE <= q < len(ws)]
        self.of = [*range(len(rows)), *asked]
        entries = self.words + [self.words[u][:self.question[u]] for u in asked]
        names = list(self.terms)
        idf = np.array([np.log1p((n - freq[w] + 0.5) / (freq[w] + 0.5)) for w in names])
        trip, self.least = [], np.zeros(len(entries))
        for entry, ws in enumerate(entries):
            tf: dict[int, int] = {}
            for w in ws:
                tf[self.terms[w]] = tf.get(self.terms[w], 0) + 1
            full = {t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(ws) / mean)) for t, f in tf.items()}
            own = sum(full.values())
            trip += [(t, entry, x / own) for t, x in full.items()]
            self.least[entry] = least_score([full[t] / own / f for t, f in tf.items() for _ in range(f)], len(ws),
                                            share=OVERLAP if self.long[self.of[entry]] is None else UNIT_OVERLAP)
        trip.sort()
        self.post_unit = np.array([x[1] for x in trip])
        self.post_impact = np.array([x[2] for x in trip])
        term = np.array([x[0] for x in trip])
        self.impact: list[dict[int, float]] = [{} for _ in entries]
        for t, unit, x in trip:
            self.impact[unit][t] = x
        post_at = np.searchsorted(term, np.arange(len(names) + 1))
        # block maxima, in order of (term, block)
        self.blocks = -(-len(entries) // BLOCK)
        key = term * self.blocks + self.post_unit // BLOCK
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.bm_post = np.append(first, len(term))
        self.bm_block = self.post_unit[first] // BLOCK
        self.bm_max = np.maximum.reduceat(self.post_impact, first)
        self.bm_at = np.searchsorted(term[first], np.arange(len(names) + 1))
        # non-essential words: smallest maxima first, while no entry gets more than SLACK, or half its threshold, from them
        top = np.maximum.reduceat(self.post_impact, post_at[:-1])
        self.given = given = np.zeros(len(entries))
        most = np.minimum(SLACK, self.least / 2)
        self.essential = np.ones(len(names), bool)
        for t in np.argsort(top, kind="stable"):
            if top[t] > SLACK:
                break
            mine = slice(post_at[t], post_at[t + 1])
            at = self.post_unit[mine]
            if (given[at] + self.post_impact[mine] > most[at]).any():
                continue
            given[at] += self.post_impact[mine]
            self.essential[t] = False
        self.slack = np.zeros(self.blocks)
        np.maximum.at(self.slack, np.arange(len(entries)) // BLOCK, given)
        self.slack += 1e-9

    def search(self, texts: list[str | None], threshold: float | None = None) -> list[list[dict]]:
        """For every text its units with some passage at the threshold, whole or in their question.

        Of a unit's passages the one that is a leak, then of most overlap, then score; the score is the
        whole unit's.  ``threshold`` above ``SLACK`` replaces the entries' own thresholds.
        """
        least = self.least if threshold is None else np.full(len(self.of), threshold)
        block_least = np.minimum.reduceat(least, np.arange(0, len(least), BLOCK))
        tokens = [words(t) for t in texts]
        get, missing = self.terms.get, -1
        ids = [np.array([get(w, missing) for w in ws], np.int64) for ws in tokens]
        lens = np.array([len(x) for x in ids], np.int64)
        wins = np.maximum(1, -(-lens // self.step) - 1)  # windows start at 0, step, 2 step, ...
        first_win = np.cumsum(wins) - wins
        found: list[list[dict]] = [[] for _ in texts]
        flat = np.concatenate(ids) if len(ids) else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(texts)), lens)
        hit = np.flatnonzero(flat >= 0)
        hit = hit[self.essential[flat[hit]]]
        if not len(hit):
            return found
        place = hit - (np.cumsum(lens) - lens)[doc[hit]]
        k = place // self.step
        right, left = np.minimum(k, wins[doc[hit]] - 1), k - 1
        both = np.concatenate([first_win[doc[hit]] + right, (first_win[doc[hit]] + left)[left >= 0]])
        both_t = np.concatenate([flat[hit], flat[hit][left >= 0]])
        pair = np.unique(both * len(self.terms) + both_t)
        win, t = pair // len(self.terms), pair % len(self.terms)
        # sum the block bounds of the essential words of every passage
        src = _ranges(self.bm_at[t], self.bm_at[t + 1])
        cell = np.repeat(win, self.bm_at[t + 1] - self.bm_at[t]) * self.blocks + self.bm_block[src]
        bound = _sums(cell, self.bm_max[src], int(wins.sum()) * self.blocks)
        open_ = (bound + self.slack[cell % self.blocks]) >= block_least[cell % self.blocks]
        # open the postings of the blocks left: sums by entry, and the rest bounded by what the entry's other words give
        src, win = src[open_], cell[open_] // self.blocks
        post = _ranges(self.bm_post[src], self.bm_post[src + 1])
        size = len(self.of)
        cell = np.repeat(win, self.bm_post[src + 1] - self.bm_post[src]) * size + self.post_unit[post]
        got = _sums(cell, self.post_impact[post], int(wins.sum()) * size)
        left = np.unique(cell[got + self.given[cell % size] + 1e-9 >= least[cell % size]])
        done = set()
        for c in left.tolist():
            w, entry = divmod(c, size)
            unit = self.of[entry]
            if (w, unit) in done:
                continue
            d = int(np.searchsorted(first_win, w, "right") - 1)
            at = (w - int(first_win[d])) * self.step
            stop = min(at + 2 * self.step, int(lens[d]))
            here = set(ids[d][at:stop].tolist())
            score = self.score(entry, here)
            if score >= least[entry]:
                done.add((w, unit))
                found[d].append({"item_id": self.items[unit], "unit": unit, "passage": at,
                                 "score": score if entry == unit else self.score(unit, here),
                                 **self.overlap(unit, tokens[d], at, stop)})
        for d, matches in enumerate(found):
            best: dict[int, dict] = {}
            for m in sorted(matches, key=lambda m: (is_leak(m), m["overlap"], m["score"], -m["passage"])):
                best[m["unit"]] = m
            found[d] = self._items_of([best[u] for u in sorted(best)], tokens[d])
        return found

    def _items_of(self, matches: list[dict], tokens: list[bytes]) -> list[dict]:
        """Matches; of each long item the best one of its units, or of its words in the whole text."""
        out, best = [], {}
        for m in matches:
            long = self.long[m["unit"]]
            if long is None:
                out.append(m)
                continue
            key = (m["item_id"], id(long))
            if key not in best:
                best[key] = {**m, **shares(*long, tokens)}
            best[key] = max(best[key], m, key=lambda x: (is_leak(x), x["overlap"], x["score"]))
        return out + list(best.values())

    def score(self, entry: int, there: set[int]) -> float:
        impact = self.impact[entry]
        return float(sum(impact[term] for term in impact.keys() & there))

    def overlap(self, unit: int, tokens: list[bytes], at: int, stop: int) -> dict:
        """Shares of the question's, answer's and all words in shingles that the passage holds."""
        ws, q = self.words[unit], self.question[unit]
        if len(ws) < SHINGLE:
            same = float(tokens == ws)
            return {"question_overlap": same, "answer_overlap": same if q < len(ws) else None, "overlap": same}
        return shares(ws, q, tokens[at:stop])


def shares(ws: list[bytes], q: int, tokens: list[bytes]) -> dict:
    """Shares of the question's (the first ``q``), answer's and all words in shingles that ``tokens`` hold."""
    there = {tuple(tokens[i:i + SHINGLE]) for i in range(len(tokens) - SHINGLE + 1)}
    covered = np.zeros(len(ws), bool)
    for i in range(len(ws) - SHINGLE + 1):
        if tuple(ws[i:i + SHINGLE]) in there:
            covered[i:i + SHINGLE] = True
    whole = float(covered.mean())
    return {"question_overlap": float(covered[:q].mean()) if q >= SHINGLE else whole,
            "answer_overlap": float(covered[q:].mean()) if q < len(ws) else None, "overlap": whole}


MATCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("passage", T.LongType()),
                      T.StructField("score", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
                      T.StructField("answer_overlap", T.DoubleType()), T.StructField("overlap", T.DoubleType())])


def is_leak(m: dict, least: float = OVERLAP) -> bool:
    return max(m["question_overlap"], m["overlap"]) >= least


def retrieve(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, a row per (row, unit of an item) above the threshold.

    ``passage``: the window's first word.  ``contaminated``: the check's verdict.
    """
    out = None
    for index in build_index(items):
        held = by_value(docs.sparkSession, index)

        def task(held=held):
            names, here = MATCH.fieldNames(), held()
            return lambda cols: {"matches": [[{n: m[n] for n in names} for m in ms] for ms in here.search(cols[0])]}
        got = map_texts(docs, [text_col], T.StructType([T.StructField("matches", T.ArrayType(MATCH))]), task).drop(text_col)
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = docs.drop(text_col).withColumn("matches", F.array().cast(T.ArrayType(MATCH)))
    kept = [c for c in out.columns if c not in {*MATCH.fieldNames(), "matches", "contaminated"}]
    return (out.select(*kept, F.explode("matches").alias("m")).select(*kept, "m.*")
            .withColumn("contaminated", F.greatest("question_overlap", "overlap") >= OVERLAP))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a contaminated pair, columns as they are."""
    out, name = docs, free_name(docs.columns, "leak")
    for index in build_index(items):
        held = by_value(docs.sparkSession, index)

        def task(held=held):
            here = held()
            return lambda cols: {name: [any(map(is_leak, ms)) for ms in here.search(cols[0])]}
        out = map_texts(out, [text_col], T.StructType([T.StructField(name, T.BooleanType())]), task)
        out = out.where(~out[name]).drop(name)
    return out


def op3_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = retrieve(docs, read(spark, sf_dir, "benchmark")).where("contaminated")
    return found.groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("passage", "score", "question_overlap", "answer_overlap", "overlap"), F.struct("overlap", "score")).alias("m")
    ).select("doc_id", "item_id", "m.*")
