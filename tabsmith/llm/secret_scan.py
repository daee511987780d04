"""Secrets: candidates by pattern, false positives removed by a random forest.  DataFrame functions only.

Candidates are maximal runs of at least 12 of the characters A-Z a-z 0-9 + / _
~ - (and up to two = behind) that hold a digit, every match of a published key
format, and every value assigned to a credential word, whatever its length and
characters: between quotes all of it, else up to a space, quote, comma,
semicolon or the next parameter of a query string.  Each gets features:

* length, shares of digits, capitals, small letters, signs, hexadecimal
  characters and distinct characters;
* transitions: changes of character class, longest runs, and the mean
  log-probability of its letter pairs under the pairs of the corpus' words;
* dictionary coverage: share of its letters in words of the dictionary, the
  ``DICTIONARY`` most frequent words of all documents;
* path: whether it stands in a URL, path, mail address or longer chain of
  signs, and what touches it;
* neighbouring words: words of credentials, of checksums and identifiers, of
  placeholders, and an assignment or quotes before it.

Training.  The forest learns from labelled findings.  Where the caller has
none, findings are labelled by format: published key formats and assigned
credentials are positive, valid card numbers, plain numbers, dates, UUIDs and
words with numbers are negative, all others stay unlabelled; so do assigned
values that are neither runs as above nor quoted.  The forest sees
the features, not the rules, and a bounded sample: at most ``TRAIN_ROWS`` of
each class by the hash of the finding.  Without both classes there is no
forest: the score is null and every finding is kept.

Null and empty texts have no candidates.  Positions are characters, ends
exclusive.  Equal rows give equal findings; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import read, table

_C = r"A-Za-z0-9+/_~\-"
RUN = rf"(?<![{_C}])(?=[A-Za-z+/_~\-]*+[0-9])[{_C}]{{12,}}+={{0,2}}"
LEFT, RIGHT = 60, 20
DICTIONARY = 20_000
TRAIN_ROWS = 10_000
TREES, DEPTH = 40, 6
MARK = "\u0001"

CREDENTIAL = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential|private|bearer)"
IDENTIFIER = r"(?i)(commit|sha\d*|md5|hash|checksum|digest|uuid|guid|etag|isbn|order|invoice|page|version|phone|card)"
PLACEHOLDER = r"(?i)(example|sample|dummy|test|fake|placeholder|xxxx|your)"
ASSIGNED = r"[=:]\s*[\"']?$"

#: Formats that issuers publish, as text in order.
KEY_FORMATS = [("aws_access_key", r"^(AKIA|ASIA)[0-9A-Z]{16}$"), ("github_token", r"^gh[pousr]_[A-Za-z0-9]{36,}$"),
               ("google_api_key", r"^AIza[0-9A-Za-z_\-]{35}$"), ("stripe_key", r"^[sr]k_(live|test)_[0-9a-zA-Z]{16,}$"),
               ("slack_token", r"^xox[abprs]-[0-9A-Za-z\-]{10,}$")]
_KEY = "|".join(p.strip("^$") for _, p in KEY_FORMATS)
#: The place behind an assignment to a credential word; a cheap look at the sign before comes first.
_BEHIND = rf"{CREDENTIAL.replace('(?i)', '(?i:', 1)})[\"']?[ \t]{{0,2}}[=:][ \t]{{0,2}}"
_QUOTED = "|".join(rf"(?<={q})(?<={_BEHIND}{q})[^{q}\r\n]++(?={q})" for q in "\"'")
_BARE = rf"(?<=[=: \t])(?<=[=:][ \t]{{0,2}})(?<={_BEHIND})(?![=:])[^\s\"'`,;<>]*[^\s\"'`,;<>.:)\]}}]"
#: A run that ends its value, a longer value, a key, any other run.
CANDIDATE = (rf"{_QUOTED}|{RUN}(?=&\w{{1,40}}=|[\s\"'`,;<>.:)\]}}]|$)|{_BARE}"
             rf"|(?<![{_C}])(?:{_KEY})(?![{_C}])|{RUN}")
NOT_SECRET = [r"^[0-9+/_~\-]+=*$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}", r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
              r"^[A-Za-z]+[_/~\-]?[0-9]{1,4}$"]

FEATURES = ["length", "digits", "upper", "lower", "signs", "hex", "distinct", "changes", "digit_run", "letter_run", "pairs",
            "coverage", "in_path", "touches_left", "touches_right", "quoted", "assigned", "credential", "identifier", "placeholder"]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(finding, doc_id, start, end, candidate, before, after)`` of every candidate."""
    marked = F.regexp_replace(F.translate(F.col(text_col), MARK, " "), f"({CANDIDATE})", f"{MARK}$1{MARK}")
    pieces = F.split(marked, MARK)
    rows = (docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), pieces.alias("p"))
            .where(F.size("p") > 1))
    narrow = F.transform("p", lambda x, i: F.struct(
        F.length(x).alias("n"), F.when(i % 2 == 1, x).alias("candidate"),
        F.when(i % 2 == 0, F.right(x, F.lit(LEFT))).alias("before"), F.when(i % 2 == 0, F.left(x, F.lit(RIGHT))).alias("after")))
    ordered = Window.partitionBy("row").orderBy("at")  # the pieces of one text
    return (rows.select("row", "doc_id", F.posexplode(narrow).alias("at", "x")).select("row", "doc_id", "at", "x.*")
            .withColumn("start", F.coalesce(F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("before", F.lag("before").over(ordered)).withColumn("after", F.lead("after").over(ordered))
            .where("candidate IS NOT NULL")
            .select(F.struct("row", "at").alias("finding"), "doc_id", F.col("start").cast("long").alias("start"),
                    (F.col("start") + F.col("n")).cast("long").alias("end"), "candidate", "before", "after"))


def lexicon(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY) -> DataFrame:
    """``(kind, item, value)``: the dictionary's words (value 1) and log-probabilities of letter pairs in all words.

    Counts cover all documents; the result has at most ``size`` + 676 rows.
    """
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("([a-z]{3,20})"), 1)).alias("w"))
    counts = table(words.groupBy("w").count(), "secret-counts")
    top = counts.orderBy(F.desc("count"), "w").limit(size)
    pairs = (counts.select("count", F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", i, 2))).alias("item"))
             .groupBy("item").agg(F.sum("count").alias("n")))
    of_first = Window.partitionBy(F.substring("item", 1, 1))  # 26 pairs at most
    value = F.log((F.col("n") + 1) / (F.sum("n").over(of_first) + 26))
    return table(top.select(F.lit("word").alias("kind"), F.col("w").alias("item"), F.lit(1.0).alias("value"))
                 .unionByName(pairs.select(F.lit("pair").alias("kind"), "item", value.alias("value"))), "secret-lexicon")


def _share(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)) / F.length("candidate")


def _longest(pattern: str) -> Column:
    found = F.regexp_extract_all("candidate", F.lit(f"({pattern})"), 1)
    return F.coalesce(F.array_max(F.transform(found, F.length)), F.lit(0)) / F.length("candidate")


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of ``FEATURES`` as doubles; ``words``: a lexicon."""
    low = F.lower("candidate")
    runs = F.regexp_extract_all(low, F.lit("([a-z]{3,20})"), 1)
    chars = F.split(low, "")   # one pass; a substring for each place would go through a long candidate again and again
    n = F.length("candidate") - 1
    pairs = F.zip_with(F.slice(chars, F.lit(1), n), F.slice(chars, F.lit(2), n), lambda a, b: F.concat(a, b))
    items = F.concat(F.transform(runs, lambda x: F.struct(F.lit("word").alias("kind"), x.alias("item"))),
                     F.transform(pairs, lambda x: F.struct(F.lit("pair").alias("kind"), x.alias("item"))))
    looked = (found.select("finding", F.explode(items).alias("x")).select("finding", "x.*")
              .join(F.broadcast(words), ["kind", "item"], "left")  # at most DICTIONARY + 676 rows
              .groupBy("finding").agg(
                  F.sum(F.when((F.col("kind") == "word") & F.col("value").isNotNull(), F.length("item"))).alias("known"),
                  F.avg(F.when(F.col("kind") == "pair", F.coalesce("value", F.lit(-8.0)))).alias("pairs")))
    flags = {
        "length": F.log1p(F.length("candidate")), "digits": _share("[0-9]"), "upper": _share("[A-Z]"), "lower": _share("[a-z]"),
        "signs": _share("[^A-Za-z0-9]"), "hex": _share("[0-9a-fA-F]"),
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / F.length("candidate"),
        "changes": _share("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])"), "digit_run": _longest("[0-9]+"),
        "letter_run": _longest("[A-Za-z]+"), "pairs": F.coalesce("pairs", F.lit(-8.0)),
        "coverage": F.coalesce(F.col("known"), F.lit(0)) / F.length("candidate"),
        "in_path": F.col("before").rlike(r"(://|[\\/.@])\S*$") | F.col("candidate").rlike("/.*/"),
        "touches_left": F.col("before").rlike(r"\S$"), "touches_right": F.col("after").rlike(r"^\S"),
        "quoted": F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"), "assigned": F.col("before").rlike(ASSIGNED),
        "credential": F.col("before").rlike(CREDENTIAL), "identifier": F.col("before").rlike(IDENTIFIER),
        "placeholder": F.concat("before", "candidate").rlike(PLACEHOLDER)}
    out = found.join(looked, "finding", "left")
    kept = [c for c in found.columns if c not in flags]
    return out.select(*kept, *[F.coalesce(flags[f].cast("double"), F.lit(0.0)).alias(f) for f in FEATURES])


def _luhn(digits: Column) -> Column:
    def add(total, x):
        d = x.cast("int")
        return total + d
    rev = F.split(F.reverse(digits), "")
    doubled = F.transform(rev, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), add) % 10 == 0


def label_by_format(found: DataFrame) -> DataFrame:
    """``found`` with ``kind`` and ``label``: 1 secret, 0 not, null unknown."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KEY_FORMATS):
        kind = F.when(F.col("candidate").rlike(pattern), name).otherwise(kind)
    number = F.col("candidate").rlike(r"^[0-9]+$")
    other = F.lit(False)
    for pattern in NOT_SECRET:
        other = other | F.col("candidate").rlike(pattern)
    credential = F.col("before").rlike(CREDENTIAL + r"\s{0,2}[=:]\s{0,2}[\"']?$")
    run = F.col("candidate").rlike(f"^{RUN}$")
    quoted = F.col("before").rlike(CREDENTIAL + r"[\"']?[ \t]{0,2}[=:][ \t]{0,2}[\"']$")
    kind = (F.when(kind.isNotNull(), kind)
            .when(F.col("candidate").rlike(r"^[0-9]{13,19}$") & _luhn(F.when(number, F.col("candidate"))), "card_number")
            .when(run & other, "number_or_identifier").when(run & credential | ~run & quoted, "assigned_credential")
            .otherwise("unknown"))
    label = F.when(F.col("kind").isin("card_number", "number_or_identifier"), 0).when(F.col("kind") != "unknown", 1)
    return found.withColumn("kind", kind).withColumn("label", label.cast("double"))


def train(labelled: DataFrame, rows: int = TRAIN_ROWS):
    """A fitted forest, or None without both classes."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    key = F.xxhash64("candidate", "before", "after")
    sample = None
    for v in (0.0, 1.0):
        one = labelled.where(F.col("label") == v).orderBy(key, "candidate", "before", "after").limit(rows).select("label", *FEATURES)
        sample = one if sample is None else sample.unionByName(one)
    sample = table(sample.coalesce(1).sortWithinPartitions("label", *FEATURES), "secret-train")  # at most 2 * rows
    if sample.select("label").distinct().count() < 2:
        return None
    ready = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(sample)
    return RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=42).fit(ready)


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         fold: Column | None = None) -> DataFrame:
    """``(doc_id, start, end, kind, candidate, score, kept)`` of every candidate.

    ``labelled``: findings with a ``label`` and the columns of ``features``;
    without it findings are labelled by format, those where ``fold`` (over
    ``doc_id``) holds.  ``kept`` is false for what the forest calls a false positive.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    found = table(candidates(docs, id_col, text_col), "secret-candidates")
    known = table(label_by_format(features(found, lexicon(docs, text_col))), "secret-features")
    if labelled is None:
        labelled = known.where("label IS NOT NULL")
        labelled = labelled.where(fold) if fold is not None else labelled
    forest = train(labelled)
    if forest is None:
        scored = known.withColumn("score", F.lit(None).cast("double"))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(known)
        scored = forest.transform(ready).withColumn("score", F.element_at(vector_to_array("probability"), 2))
    return scored.select("doc_id", "start", "end", "kind", "candidate", "score",
                         F.coalesce(F.col("score") >= 0.5, F.lit(True)).alias("kept"))


def quality(judged: DataFrame) -> DataFrame:
    """``(verdict, precision, recall)`` of the forest's verdicts (``kept``) and of the format rule alone.

    ``judged``: rows of ``scan`` with ``truth``, 1 for a secret and 0 for none.  The rule keeps
    what it labels a secret or does not know.
    """
    rule = ~F.col("kind").isin("card_number", "number_or_identifier")
    both = judged.select("truth", F.explode(F.array(
        F.struct(F.lit("forest").alias("verdict"), F.col("kept").alias("kept")),
        F.struct(F.lit("rule").alias("verdict"), rule.alias("kept")))).alias("v")).select("truth", "v.*")
    hit = F.count_if(F.col("kept") & (F.col("truth") == 1))
    return both.groupBy("verdict").agg(F.try_divide(hit, F.count_if("kept")).alias("precision"),
                                       F.try_divide(hit, F.count_if(F.col("truth") == 1)).alias("recall"))


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every candidate with its verdict; the candidate itself as a digest.  One document in five teaches nothing."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = scan(read(spark, sf_dir, "documents"), fold=~held_out)
    return found.select("doc_id", "start", "end", "kind", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "kept",
                        F.coalesce(held_out, F.lit(False)).alias("held_out"))
