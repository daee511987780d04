"""Conversation structure repair by Knuth's lightest derivation.

A conversation is the sequence of its rows by ``turn`` (nulls first; equal turns
by role, then by SHA-256 of conversation, role and text).  A row's first fault
counts: blank (white space only), duplicate (role and text seen earlier in the
conversation), truncated (its last character that is no ASCII white space is
none of ``.!?``).

Repair items and edits.  ``("at", i, q)`` says that the first ``i`` rows are
repaired and that their roles leave the automaton of ``(s?(ua)+)?`` in state
``q``; ``("row", i)`` is a fact of weight nothing.  A deduction has a list of
premises, a cost, an edit and a conclusion: Keep, Rerole and Delete use an item
and the fact of its next row, Insert an item alone.  The value of a conclusion is
the sum of the costs and the edits' initials in order, so values compare as
(cost, audit).  The agenda pops the least value; a popped item is final, as every
deduction's value is not below its premises' (costs add, audits grow at the end)
and keeps their order.  It ends with the goal item.

Scale.  Rows are range-partitioned by (conversation, order) and cut in segments
of ``SEGMENT_ROWS`` rows, so no task holds a conversation: whole ones inside a
partition are repaired at once; of the others each segment gives the lightest
derivation between every two states, and rounds of groups of ``FAN`` neighbours,
the same agenda over segments for rows, make one of them.  Only the SHA-256 of a
repaired conversation is sequential by definition; one task streams its segments.

Defined results: null role or text is one space, null turns come first and count
for no gap, rows of null ``conv_id`` are one conversation, equal rows are
duplicates, roles other than s..., u... or a... cannot be kept; an empty table
gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Hashable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import bounded_batches, table

#: Rows and characters after which a segment ends.
SEGMENT_ROWS, SEGMENT_CHARS = 256, 4 << 20
#: Neighbouring segments merged by one task in a round.
FAN = 64
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: State after s, u, a from each state: 0 nothing yet, 1 after s, 2 after u, 3 after a.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
#: The role that an inserted or reroled row takes in each state.
NEXT = ["user", "user", "assistant", "user"]
DONE = (0, 3)
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 3, 4, 3, 3
WHITE = " \t\n\x0b\x0c\r"

Value = tuple[int, str]
Edge = tuple[tuple[Hashable, ...], int, str, Hashable]


# -- the agenda -----------------------------------------------------------------------

def lightest(axioms: dict[Hashable, Value], edges: list[Edge], goal: Hashable = None) -> dict[Hashable, Value]:
    """Least (cost, audit) of every item up to ``goal`` (of all items without one).

    An edge ``(premises, cost, edit, conclusion)`` fires when its last premise is
    final; audits of the premises are joined in their order.
    """
    uses, missing = defaultdict(list), [len(e[0]) for e in edges]
    for n, (premises, *_) in enumerate(edges):
        for p in premises:
            uses[p].append(n)
    agenda = [(cost, audit, n, item) for n, (item, (cost, audit)) in enumerate(axioms.items())]
    heapq.heapify(agenda)
    made, final = len(agenda), {}
    while agenda:
        cost, audit, _, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if item == goal:
            break
        for n in uses[item]:
            missing[n] -= 1
            if missing[n] == 0:
                premises, w, edit, head = edges[n]
                if head not in final:
                    heapq.heappush(agenda, (sum(final[p][0] for p in premises) + w,
                                            "".join(final[p][1] for p in premises) + edit, made, head))
                    made += 1
    return final


def deductions(roles: list[str], faults: list[int]) -> list[Edge]:
    """Every edit of every row in every state."""
    edges = []
    for i in range(len(roles) + 1):
        for q in range(4):
            here = ("at", i, q)
            then = STEP[q][NEXT[q][0]]
            edges.append(((here,), INSERT, "I", ("at", i, then)))
            if i == len(roles):
                continue
            both = (here, ("row", i))
            edges.append((both, DELETE, "D", ("at", i + 1, q)))
            if faults[i] in (BLANK, DUPLICATE):
                continue
            more = UNMENDED if faults[i] == TRUNCATED else 0
            edges.append((both, REROLE + more, "R", ("at", i + 1, then)))
            kept = STEP[q].get(roles[i][:1])
            if kept is not None:
                edges.append((both, KEEP + more, "K", ("at", i + 1, kept)))
    return edges


def _facts(n: int, q: int) -> dict[Hashable, Value]:
    return {("at", 0, q): (0, ""), **{("row", i): (0, "") for i in range(n)}}


def cheapest(roles: list[str], faults: list[int]) -> Value:
    """Cost and audit of a whole conversation."""
    n = len(roles)
    goal = [((("at", n, q),), 0, "", "goal") for q in DONE]
    return lightest(_facts(n, 0), deductions(roles, faults) + goal, "goal")["goal"]


def exits(roles: list[str], faults: list[int]) -> list[dict]:
    """Cheapest way through a segment between every two states."""
    n, edges, out = len(roles), deductions(roles, faults), []
    for q in range(4):
        final = lightest(_facts(n, q), edges)
        out += [{"q": q, "e": e, "cost": final["at", n, e][0], "audit": final["at", n, e][1]}
                for e in range(4) if ("at", n, e) in final]
    return out


def joined_exits(parts: list[list[dict]]) -> list[dict]:
    """Cheapest way through neighbouring segments between every two states."""
    edges = [((("at", i, x["q"]),), x["cost"], x["audit"], ("at", i + 1, x["e"])) for i, p in enumerate(parts) for x in p]
    out = []
    for q in range(4):
        final = lightest({("at", 0, q): (0, "")}, edges)
        out += [{"q": q, "e": e, "cost": final["at", len(parts), e][0], "audit": final["at", len(parts), e][1]}
                for e in range(4) if ("at", len(parts), e) in final]
    return out


class Mender:
    """Carries out an audit over rows that come in pieces."""

    def __init__(self, audit: str):
        self.audit, self.at, self.q = audit, 0, 0

    def _inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield self._put(NEXT[self.q]), ""
            self.at += 1

    def _put(self, role: str) -> str:
        self.q = STEP[self.q][role[:1]]
        return role

    def rows(self, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str]]:
        for role, text in zip(roles, texts, strict=True):
            yield from self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit != "D":
                yield self._put(role if edit == "K" else NEXT[self.q]), text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._inserted()


class Digest:
    """SHA-256 of ``role:text`` lines joined by a newline."""

    def __init__(self):
        self.sha, self.any = sha256(), False

    def add(self, rows: Iterator[tuple[str, str]]) -> Digest:
        for role, text in rows:
            self.sha.update(f"{chr(10) * self.any}{role}:{text}".encode("utf-8", "surrogatepass"))
            self.any = True
        return self


# -- facts about a segment that merge with its neighbour's ------------------------------

def counts(roles: list[str], faults: list[int], turns: list[int | None]) -> dict:
    """Faults, illegal neighbours, first and last initial, and range and number of turns of a stretch of rows."""
    initials = [r[:1] for r in roles]
    known = [t for t in turns if t is not None]
    return {"n": len(roles), "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "first": initials[0] if initials else None, "last": initials[-1] if initials else None,
            "turns": len(set(known)), "lo": known[0] if known else None, "hi": known[-1] if known else None}


def merged_counts(a: dict, b: dict) -> dict:
    """Counts of ``a`` followed by ``b``."""
    out = {k: a[k] + b[k] for k in ("n", "blank", "duplicate", "truncated", "illegal", "turns")}
    if a["n"] and b["n"]:
        out["illegal"] += a["last"] + b["first"] not in LEGAL
    if a["hi"] is not None and a["hi"] == b["lo"]:
        out["turns"] -= 1
    out["first"], out["last"] = (a if a["n"] else b)["first"], (b if b["n"] else a)["last"]
    out["lo"], out["hi"] = (b if a["lo"] is None else a)["lo"], (a if b["hi"] is None else b)["hi"]
    return out


COUNTS = ("n long, blank long, duplicate long, truncated long, illegal long, first string, last string, "
          "turns long, lo long, hi long")
COUNT_NAMES = [c.split()[0] for c in COUNTS.split(", ")]
EXITS = pa.list_(pa.struct([("q", pa.int32()), ("e", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
PARTS = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int32()), ("k", pa.int64()), ("whole", pa.bool_()), ("n", pa.int64()), ("blank", pa.int64()),
    ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()),
    ("turns", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("repaired_sha256", pa.string()), ("exits", EXITS), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])
PARTS_SQL = (f"conv_id long, part int, k long, whole boolean, {COUNTS}, cost long, audit string, repaired_sha256 string, "
             "exits array<struct<q int, e int, cost long, audit string>>, roles array<string>, texts array<string>")


# -- Spark ----------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copies)``: the rows of ``conversations``, one in four of them damaged.

    ``copies`` is 0 for a dropped row and 2 for a repeated one.
    """
    def known(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    text = (F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text")))
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.when(kind == 4, F.lit("user")).otherwise(known("role")).alias("role"),
        text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def marked(turns: DataFrame) -> DataFrame:
    """Rows with their order and first fault; dropped rows stay, without text, to keep their conversation."""
    gone = F.col("copies") == 0
    rows = turns.select(
        "conv_id", "turn", F.when(gone, F.lit("")).otherwise(F.col("role")).alias("role"),
        F.when(gone, F.lit("")).otherwise(F.col("text")).alias("text"), "copies", F.monotonically_increasing_id().alias("id"))
    trimmed = F.rtrim("text", F.lit(WHITE))
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.length("role"), "role", "text"), 256)
    rows = rows.select("*", key.alias("key"), (F.length(trimmed) == 0).alias("blank"),
                       (~F.right(trimmed, F.lit(1)).isin(".", "!", "?")).alias("cut"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "id")
    seen = (rows.where("copies > 0 AND NOT blank").groupBy("key").agg(F.min(place).alias("earliest"), F.count("*").alias("times"))
            .where("times > 1").select("key", "earliest"))
    rows = rows.join(seen, "key", "left")
    fault = (F.when(F.col("blank"), BLANK).when(F.col("earliest") < place, DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0))
    return rows.select("conv_id", "turn", "role", "text", "copies", "id", "key", fault.alias("fault"))


def segments(turns: DataFrame, hold: bool = False, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """One row for each whole conversation inside a range partition, repaired, and one for each segment of the others.

    With ``hold`` no conversation counts as whole, so all rows keep their texts.
    """
    bounded_batches(turns.sparkSession)
    none, known = F.col("conv_id").isNotNull(), F.col("turn").isNotNull()
    order = [none, F.col("conv_id"), known, F.col("turn"), F.col("role"), F.col("key"), F.col("id")]
    dealt = marked(turns).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, current, k, first = TaskContext.get().partitionId(), None, 0, True
        roles, texts, faults, when, ready = [], [], [], [], []

        def close(whole: bool) -> dict:
            row = {"conv_id": current[0], "part": part, "k": k, "whole": whole, **counts(roles, faults, when)}
            if whole:
                cost, audit = cheapest(roles, faults)
                mender, digest = Mender(audit), Digest()
                digest.add(mender.rows(roles, texts)).add(mender.rest())
                return row | {"cost": cost, "audit": audit, "repaired_sha256": digest.sha.hexdigest()}
            return row | {"exits": exits(roles, faults), "roles": list(roles), "texts": list(texts)}

        def clear():
            for x in (roles, texts, faults, when):
                x.clear()

        size = 0
        for b in batches:
            for conv, turn, role, text, copies, fault in zip(*(b.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "fault")),
                                                            strict=True):
                if current is None or current[0] != conv:
                    if current is not None:
                        ready.append(close(whole=not hold and not first and k == 0))
                        first, k = False, 0
                        clear()
                        size = 0
                    current = (conv,)
                for copy in range(copies):
                    if len(roles) >= segment_rows or size > SEGMENT_CHARS:
                        ready.append(close(whole=False))
                        k += 1
                        clear()
                        size = 0
                    roles.append(role)
                    texts.append(text)
                    faults.append(DUPLICATE if copy and fault != BLANK else fault)
                    when.append(turn)
                    size += len(text)
                if len(ready) >= 64 or size > SEGMENT_CHARS and ready:
                    yield pa.RecordBatch.from_pylist(ready, schema=PARTS)
                    ready = []
        if current is not None:
            ready.append(close(whole=False))
            yield pa.RecordBatch.from_pylist(ready, schema=PARTS)
    narrow = dealt.select("conv_id", "turn", "role", "text", "copies", "fault")
    return table(narrow.mapInArrow(run, PARTS_SQL), "conv-parts")


def _merge(split: DataFrame, step: str) -> DataFrame:
    """Neighbours of one ``step`` value (a SQL expression of part and k, at most ``FAN`` rows a group) as one row."""
    names = ["conv_id", "part", "k", *COUNT_NAMES, "exits"]
    schema = f"conv_id long, part int, k long, {COUNTS}, exits array<struct<q int, e int, cost long, audit string>>"
    arrow = pa.schema([PARTS.field(n) for n in names])

    def merge(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r["part"], r["k"]))
        out = rows[0]
        for r in rows[1:]:
            out = out | merged_counts(out, r)
        out["exits"] = joined_exits([r["exits"] for r in rows]) if len(rows) > 1 else rows[0]["exits"]
        return pa.Table.from_pylist([{n: out[n] for n in names}], schema=arrow)
    keyed = split.select(*names, F.expr(step).alias("step"))
    return keyed.groupBy("conv_id", "step", *([] if step.startswith("part") else ["part"])).applyInArrow(merge, schema)


def composed(parts: DataFrame, fan: int = FAN) -> DataFrame:
    """``(conv_id, counts, cost, audit)`` of the conversations that are in segments."""
    split = parts.where("NOT whole")
    top = split.agg(F.max("k"), F.max("part")).first()
    width = 1
    while top[0] is not None and width <= top[0]:          # segments of one partition
        split = table(_merge(split, f"k div {width * fan}"), "conv-merge")
        width *= fan
    width = 1
    while top[1] is not None and width <= top[1]:          # partitions
        split = table(_merge(split, f"part div {width * fan}"), "conv-merge")
        width *= fan
    best = F.array_min(F.transform(F.filter("exits", lambda x: (x["q"] == 0) & x["e"].isin(*DONE)),
                                   lambda x: F.struct(x["cost"].alias("cost"), x["audit"].alias("audit"))))
    return split.select("conv_id", *COUNT_NAMES, best.alias("best")).select("*", "best.*").drop("best")


def _streamed(parts: DataFrame, whole: DataFrame, make, schema: str) -> DataFrame:
    """Run ``make`` over the segments of each conversation in order, in one streaming task per conversation."""
    pieces = parts.where("NOT whole").select("conv_id", "part", "k", "roles", "texts")
    audits = whole.select(F.col("conv_id").alias("c"), F.col("audit").alias("a"))
    starts = pieces.groupBy(F.col("conv_id").alias("c")).agg(F.min(F.struct("part", "k")).alias("start"))
    told = starts.join(audits, starts["c"].eqNullSafe(audits["c"])).select(starts["c"], "start", "a")
    both = pieces.join(told, pieces["conv_id"].eqNullSafe(told["c"]) & (F.struct("part", "k") == told["start"]), "left")
    order = ["conv_id", "part", "k"]
    return both.select(*order, "roles", "texts", F.col("a").alias("audit")).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(make, schema)


def _shas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, mender, digest = None, None, None

    def done():
        digest.add(mender.rest())
        return pa.RecordBatch.from_pydict({"conv_id": pa.array([current[0]], pa.int64()), "sha": pa.array([digest.sha.hexdigest()])})
    for b in batches:
        for conv, roles, texts, audit in zip(*(b.column(c).to_pylist() for c in ("conv_id", "roles", "texts", "audit")), strict=True):
            if current is None or current[0] != conv:
                if current is not None:
                    yield done()
                current, mender, digest = (conv,), Mender(audit), Digest()
            digest.add(mender.rows(roles, texts))
    if current is not None:
        yield done()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, mender, place = None, None, 0

    def give(rows):
        nonlocal place
        rows = list(rows)
        out = pa.RecordBatch.from_pydict({
            "conv_id": pa.array([current[0]] * len(rows), pa.int64()), "place": pa.array(range(place, place + len(rows)), pa.int64()),
            "role": pa.array([r for r, _ in rows], pa.string()), "text": pa.array([t for _, t in rows], pa.string())})
        place += len(rows)
        return out
    for b in batches:
        for conv, roles, texts, audit in zip(*(b.column(c).to_pylist() for c in ("conv_id", "roles", "texts", "audit")), strict=True):
            if current is None or current[0] != conv:
                if current is not None:
                    yield give(mender.rest())
                current, mender, place = (conv,), Mender(audit), 0
            yield give(mender.rows(roles, texts))
    if current is not None:
        yield give(mender.rest())


def _with_copies(turns: DataFrame) -> DataFrame:
    if "copies" in turns.columns:
        return turns

    def known(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), known("role"), known("text"), F.lit(1).alias("copies"))


def repair(turns: DataFrame, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> DataFrame:
    """Faults, gaps, cost, audit and digest of the repaired rows of each conversation.

    ``turns`` holds conv_id, turn, role and text, and ``copies`` where it comes from ``damage``.
    """
    parts = segments(_with_copies(turns), segment_rows=segment_rows)
    cols = ["conv_id", *COUNT_NAMES, "cost", "audit"]
    split = composed(parts, fan)
    shas = _streamed(parts, split, _shas, "conv_id long, sha string").toDF("c", "repaired_sha256")
    split = split.join(shas, split["conv_id"].eqNullSafe(shas["c"])).select(*cols, "repaired_sha256")
    both = parts.where("whole").select(*cols, "repaired_sha256").unionByName(split)
    gaps = F.when(F.col("lo").isNull(), F.lit(0)).otherwise(F.col("hi") - F.col("lo") + 1 - F.col("turns")).cast("long")
    return both.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired_turns(turns: DataFrame, segment_rows: int = SEGMENT_ROWS, fan: int = FAN) -> DataFrame:
    """``(conv_id, place, role, text)``: the repaired rows."""
    parts = segments(_with_copies(turns), hold=True, segment_rows=segment_rows)
    return _streamed(parts, composed(parts, fan), _turns, "conv_id long, place long, role string, text string")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    from tabsmith.llm.common import read
    return repair(damage(read(spark, sf_dir, "conversations")))


ORACLE_SQL = r"""
WITH RECURSIVE
crc_table AS (
  SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)),
kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                                                                 lambda c: ord(c)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind != 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1 WHEN seen > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault,
         lead(role) OVER (PARTITION BY conv_id ORDER BY i) AS after FROM placed),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (after IS NOT NULL AND left(role, 1) || left(after, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
convs AS (
  SELECT c.conv_id, coalesce(n, 0) AS n, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
         coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal
  FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON c.conv_id IS NOT DISTINCT FROM f.conv_id),
inserted(q, e, cost, audit, body) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:']),
  (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:']),
  (2, 2, 6, 'II', ['assistant:', 'user:']), (3, 3, 6, 'II', ['user:', 'assistant:'])),
edits(edit, q, initial, e, role) AS (VALUES
  ('K', 0, 's', 1, NULL), ('K', 0, 'u', 2, NULL), ('K', 1, 'u', 2, NULL), ('K', 2, 'a', 3, NULL), ('K', 3, 'u', 2, NULL),
  ('R', 0, NULL, 2, 'user'), ('R', 1, NULL, 2, 'user'), ('R', 2, NULL, 3, 'assistant'), ('R', 3, NULL, 2, 'user'),
  ('D', 0, NULL, 0, NULL), ('D', 1, NULL, 1, NULL), ('D', 2, NULL, 2, NULL), ('D', 3, NULL, 3, NULL)),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS body FROM convs
  UNION ALL
  SELECT conv_id, i, q, cost, audit, body FROM (
    SELECT w.conv_id, f.i, d.e AS q,
           (w.cost + s.cost + CASE d.edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
            + CASE WHEN d.edit != 'D' AND f.fault = 3 THEN 3 ELSE 0 END)::BIGINT AS cost,
           w.audit || s.audit || d.edit AS audit,
           list_concat(w.body, s.body, CASE d.edit WHEN 'D' THEN [] ELSE [coalesce(d.role, f.role) || ':' || f.text] END) AS body
    FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
    JOIN inserted s ON s.q = w.q JOIN edits d ON d.q = s.e
    WHERE (d.edit = 'D' OR f.fault IN (0, 3)) AND (d.edit != 'K' OR d.initial = left(f.role, 1)))
  QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1),
ends AS (
  SELECT w.conv_id, (w.cost + s.cost)::BIGINT AS cost, w.audit || s.audit AS audit, list_concat(w.body, s.body) AS body
  FROM walk w JOIN convs c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserted s ON s.q = w.q
  WHERE s.e IN (0, 3) QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + s.cost, w.audit || s.audit) = 1)
SELECT c.conv_id, c.gaps, c.blank, c.duplicate, c.truncated, c.illegal, e.cost, e.audit,
       sha256(array_to_string(e.body, chr(10))) AS repaired_sha256
FROM convs c JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
