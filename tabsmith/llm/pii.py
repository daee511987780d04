"""Personal data: exact detectors, and the same detectors behind an offset-preserving deobfuscation.

Base detectors (kinds in this order): email, ip, card, phone; leftmost
non-overlapping matches per kind on the source text.

Deobfuscation is a chain of transducers.  Each turns a text into another one
and keeps, for every character it puts out, the source interval that it stands
for; so a match on the last text maps back to source characters:

* homoglyphs: fullwidth forms, Cyrillic and Greek look-alikes and other
  scripts' digits become ASCII, one character for one;
* spelled digits: in a chain of digit words (English, German, French, Spanish)
  and figures, parted by spaces, hyphens, commas, brackets or dot signs, every
  word becomes its digit; words in a row become one number.  A chain of fewer
  than ``MIN_DIGITS`` digits, which no kind can have, stays;
* at/dot disguises: ``[at]``, ``(at)``, `` at `` and the like become ``@``,
  ``[dot]`` and `` dot `` become ``.``; the bare words count only where the
  whole disguised address follows (``name at host dot com``).  Before real dots
  (``name at host.com``) the last label must be letters, and the name none of
  the words ``PLACED`` that prose puts before a place.

The detectors decide (octets, Luhn, 10 to 15 digits after a plus): spans found
only in the deobfuscated text are added; base spans stay, and an added span
that overlaps a base span of its kind is dropped.  A chain that mixes words and
figures is read twice, the gaps between the two kept, then closed; the second
reading adds what the first leaves.  Only texts with such a trigger are
transduced, so plain texts cost the base detectors alone.

All scans are linear in the text, which is never cut.  Null text counts as
empty.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tabsmith.llm.common import map_texts

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each ``@`` backwards so that long words cost no retries."""
    out, last = [], 0
    for m in DOMAIN.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            out.append((start, m.end()))
            last = m.end()
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers; a longer chain is taken four by four from its left."""
    out = []
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15]


DETECT = {"email": (emails, "@"), "ip": (ips, "."), "card": (cards, ""), "phone": (phones, "+")}
HAS_DIGIT = re.compile("[0-9]").search


def base_spans(text: str) -> list[Span]:
    """All base spans, ordered by start, then kind as in ``KINDS``."""
    digit = HAS_DIGIT(text) is not None
    found = [(k, s, e) for k in KINDS if DETECT[k][1] in text and (digit or k == "email") for s, e in DETECT[k][0](text)]
    return sorted(found, key=_order)


def _order(span: Span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


# ---- deobfuscation -------------------------------------------------------------------------------

#: Look-alikes of ASCII letters and signs, each beside the character it stands for.
LOOKALIKES = dict(zip("АВЕЅІЈКМНОРСТХаесорхуіјѕһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧον∙․＠．",
                      "ABESIJKMHOPCTXaecopxyijshdqwABEZHIKMNOPTYXov..@.", strict=True))
_TABLE = {ord(a): b for a, b in LOOKALIKES.items()}
_TABLE |= {c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}  # fullwidth forms
_TABLE |= {first + d: str(d) for first in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7E2, 0x1D7EC, 0x1D7F6) for d in range(10)}
HOMOGLYPH = re.compile("[" + "".join(sorted(map(chr, _TABLE))).replace("\\", "") + "]")

#: Digit words by language.
DIGIT_WORDS = {w: str(d) for words in (
    "zero one two three four five six seven eight nine",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "cero uno dos tres cuatro cinco seis siete ocho nueve") for d, w in enumerate(words.split())}
DIGIT_WORDS |= {"oh": "0"}
_WORD = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
#: An IP has four digits at least, a card and a phone more.
MIN_DIGITS = 4
#: With so many digits, ``plus`` before a chain is the sign of a phone.
PLUS_DIGITS = 10
_GAP = r"[\x20,\-]{1,3}"
#: Only in brackets do the words of other languages count: bare ones are common prose.
_AT, _DOT = r"(?:at|arroba|arobase)", r"(?:dot|punkt|point|punto)"
_BR_AT = rf"[\x20]?[\[({{<][\x20]?(?:{_AT}|@)[\x20]?[\])}}>][\x20]?"
_BR_DOT = rf"[\x20]?[\[({{<][\x20]?(?:{_DOT}|\.)[\x20]?[\])}}>][\x20]?"
_NAME = r"[A-Za-z0-9_%+-]{1,64}"
_LABEL = r"[A-Za-z0-9-]{1,63}"
_ANY_AT = rf"(?:{_BR_AT}|[\x20]at[\x20]|@)"
_ANY_DOT = rf"(?:{_BR_DOT}|[\x20]dot[\x20]|\.)"
_SURE = rf"(?:{_BR_AT}|{_BR_DOT}|[\x20]dot[\x20]|[\x20]at[\x20](?={_LABEL}\.[A-Za-z0-9]))"
#: A bracketed or spelled sign, or a bare at before a host, must occur; then the address around it is looked at.
SIGN = re.compile(_SURE, re.IGNORECASE)
ADDRESS = re.compile(rf"(?<![A-Za-z0-9_%+-]){_NAME}(?:{_ANY_DOT}{_NAME}){{0,4}}?{_ANY_AT}{_LABEL}(?:{_ANY_DOT}{_LABEL}){{1,5}}",
                     re.IGNORECASE)
AT_SIGN = re.compile(rf"{_BR_AT}|[\x20]at[\x20]", re.IGNORECASE)
DOT_SIGN = re.compile(rf"{_BR_DOT}|[\x20]dot[\x20]", re.IGNORECASE)
#: A bare dot word of any language counts between numbers.
_NUMBER_DOT = rf"(?:{_BR_DOT}|[\x20]{_DOT}[\x20]|\.)"
_DIGITS = rf"(?:(?:{_WORD})|[0-9]++)"
CHAIN = re.compile(rf"(?<!\w)(?P<plus>plus[\x20])?(?<!\w){_DIGITS}(?!\w)(?:(?:{_NUMBER_DOT}|[\x20,.()\-]{{1,3}}){_DIGITS}(?!\w))+",
                   re.IGNORECASE)
DIGITS = re.compile(rf"(?<!\w){_DIGITS}(?!\w)", re.IGNORECASE)
GAP = re.compile(_GAP)
#: Cheap triggers on the lower-cased text: without a match the exact patterns cannot match either.
_PART = rf"(?:{_GAP}|[\x20,.()\-]{{1,3}}|[\x20\[({{<]{{1,3}}(?:{_DOT}|\.)[\x20\])}}>]{{1,3}})"
MAYBE_SPELLED = re.compile(rf"(?:{_WORD}){_PART}(?:{_WORD}|[0-9])|[0-9]{_PART}(?:{_WORD})")
MAYBE_SIGN = re.compile(r"[\[({<]\x20?(?:at|arroba|arobase|dot|punkt|point|punto|[@.])|\x20(?:dot|punkt|point|punto)\x20"
                        r"|\x20at\x20[a-z0-9-]{1,63}\.[a-z0-9]")
ADDRESS_IP = re.compile(rf"(?<![0-9])[0-9]{{1,3}}(?:{_NUMBER_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
NUMBER_DOT = re.compile(_NUMBER_DOT, re.IGNORECASE)
#: A plain address but for its bare at; fixed words that stand before "at" and a host in prose.
BARE_AT = re.compile(rf"({_NAME}(?:\.{_NAME})*)[\x20]at[\x20]{_LABEL}(?:\.{_LABEL})*?\.[A-Za-z]{{2,63}}", re.IGNORECASE)
SURE_SIGN = re.compile(rf"{_BR_AT}|{_BR_DOT}|[\x20]dot[\x20]", re.IGNORECASE)
PLACED = frozenset("""a an and are available be been but find found go he her here him hosted i is it live look looked looking looks me
    meet more not of online or page see she shop site that them they this us visit was we were work working works you""".split())
#: Characters on each side of a sign that an address may take.
REACH = 400


class Mapped:
    """A text with the replacements that made it: piecewise map of positions back to the source."""

    def __init__(self, text: str):
        self.text = text
        self.mixed = False  # whether closing the gaps between words and figures gives another text
        self.steps: list[list[tuple[int, int, int, int]]] = []  # of a step: (new start, new end, old start, old end)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply sorted, disjoint ``(start, end, new)`` to the current text."""
        if not edits:
            return
        parts, step, at, shift = [], [], 0, 0
        for s, e, new in edits:
            parts += [self.text[at:s], new]
            step.append((s + shift, s + shift + len(new), s, e))
            shift += len(new) - (e - s)
            at = e
        self.text = "".join(parts) + self.text[at:]
        self.steps.append(step)

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source interval of ``[start, end)``; a cut replacement counts whole."""
        for step in reversed(self.steps):
            start, end = _back(step, start, False), _back(step, end, True)
        return start, end


def _back(step: list[tuple[int, int, int, int]], x: int, is_end: bool) -> int:
    """Position before one step's replacements; inside a replacement: its old start, or end."""
    key = x if is_end else x + 1
    k = bisect_left(step, key, key=lambda r: r[0]) - 1  # the last that starts before x (or at it, for a start)
    if k < 0:
        return x
    new_s, new_e, old_s, old_e = step[k]
    if x < new_e or is_end and x == new_e:
        return old_e if is_end else old_s
    return x + old_e - new_e


def spelled(text: str, close: bool) -> list[tuple[int, int, str]]:
    """Edits that turn the digit words of chains into digits; ``close``: gaps between a word and figures go, too."""
    edits = []
    for m in CHAIN.finditer(text):
        parts = [(x.start(), x.end(), DIGIT_WORDS.get(x.group().lower())) for x in DIGITS.finditer(text, m.start(), m.end())]
        digits = sum(e - s if new is None else 1 for s, e, new in parts)
        if digits < MIN_DIGITS or all(new is None for _, _, new in parts):
            continue
        runs: list[list] = []  # start, end, digits, whether words are in it, whether its last is a word
        for s, e, new in parts:
            last = runs[-1] if runs else None
            words = last is not None and (last[4] and new is not None or close and (last[4] or new is not None))
            if words and GAP.fullmatch(text, last[1], s):
                runs[-1] = [last[0], e, last[2] + (new or text[s:e]), True, new is not None]
            else:
                runs.append([s, e, new or text[s:e], new is not None, new is not None])
        if m["plus"] and digits >= PLUS_DIGITS:
            runs[0] = [m.start(), runs[0][1], "+" + runs[0][2], True, False]
        edits += [(s, e, new) for s, e, new, words, _ in runs if words]
    return edits


def deobfuscate(text: str, close: bool = False) -> Mapped:
    out = Mapped(text)
    if not text.isascii():
        out.text = HOMOGLYPH.sub(lambda m: _TABLE[ord(m.group())], text)  # one for one: no offsets move
    low = out.text.lower()
    if MAYBE_SPELLED.search(low):
        edits, closed = spelled(out.text, False), spelled(out.text, True)
        out.mixed = edits != closed
        out.replace(closed if close else edits)
    if not MAYBE_SIGN.search(low):
        return out
    signs, last = {}, 0
    for m in ADDRESS_IP.finditer(out.text):
        signs.update({x.span(): "." for x in NUMBER_DOT.finditer(out.text, m.start(), m.end()) if x.group() != "."})
    for sign in SIGN.finditer(out.text):
        if sign.start() < last or sign.span() in signs:
            continue
        lo, hi = max(last, sign.start() - REACH), sign.end() + REACH
        for m in ADDRESS.finditer(out.text, lo, min(hi, len(out.text))):
            if m.end() <= sign.start():
                continue
            if m.start() < sign.end():
                bare = BARE_AT.match(out.text, m.start(), m.end())
                if not SURE_SIGN.search(m.group()) and (bare is None or bare[1].lower() in PLACED):
                    break
                signs.update({x.span(): "." for x in DOT_SIGN.finditer(out.text, m.start(), m.end())})
                signs.update({x.span(): "@" for x in AT_SIGN.finditer(out.text, m.start(), m.end())})
                last = m.end()
            break
    edits: list[tuple[int, int, str]] = []
    for (s, e), new in sorted(signs.items()):
        if not edits or s >= edits[-1][1]:
            edits.append((s, e, new))
    out.replace(edits)
    return out


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the deobfuscated text shows, in source positions."""
    seen = deobfuscate(text)
    if seen.text == text:
        return []
    out = _new_spans(seen, base)
    if seen.mixed:
        out += _new_spans(deobfuscate(text, close=True), sorted(base + out, key=_order))
    return out


def _new_spans(seen: Mapped, base: list[Span]) -> list[Span]:
    taken = {k: [] for k in KINDS}
    for k, s, e in base:
        taken[k].append((s, e))
    out = []
    for k, s, e in base_spans(seen.text):
        s, e = seen.back(s, e)
        near = taken[k]
        i = bisect_left(near, e, key=lambda x: x[0])
        if (not i or near[i - 1][1] <= s) and (not out or not any(o[0] == k and o[2] > s and o[1] < e for o in out[-4:])):
            out.append((k, s, e))
    return out


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans."""
    text = text or ""
    base = base_spans(text)
    return base, sorted(set(base + added_spans(text, base)), key=lambda x: (*_order(x), x[2]))


def _join(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span, overlapping ones merged, replaced by its first kind in brackets."""
    out, at, end, kind = [], 0, -1, ""
    for k, s, e in sorted(spans, key=_order):
        if end < 0 or s >= end:
            if end >= 0:
                out.append(f"[{kind.upper()}]")
                at = end
            out.append(text[at:s])
            kind, end = k, e
        end = max(end, e)
    if end >= 0:
        out.append(f"[{kind.upper()}]")
        at = end
    return "".join(out) + text[at:]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType())])
FOUND = T.StructType([T.StructField("base_spans", T.ArrayType(SPAN)), T.StructField("all_spans", T.ArrayType(SPAN))])


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the arrays ``base_spans`` and ``all_spans`` of ``(kind, start, end)``."""
    def task():
        def run(cols):
            both = [find(t) for t in cols[0]]
            rows = [[[dict(zip(("kind", "start", "end"), x, strict=True)) for x in one] for one in side]
                    for side in zip(*both, strict=True)] or [[], []]
            return {"base_spans": rows[0], "all_spans": rows[1]}
        return run
    return map_texts(docs, [text_col], FOUND, task)


def redact_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind; null stays null, columns stay as they are.

    ``n_chars``, where there is such a long column, gets the new length.
    """
    counted = dict(docs.dtypes).get("n_chars") == "bigint"
    schema = [T.StructField(text_col, T.StringType())] + [T.StructField("n_chars", T.LongType())] * counted

    def task():
        def run(cols):
            new = [t if not t else redact(t, find(t)[1]) for t in cols[0]]
            out = {text_col: new}
            if counted:
                out["n_chars"] = [n if a == b else len(b) for n, a, b in zip(cols[1], cols[0], new, strict=True)]
            return out
        return run
    done = map_texts(docs, [text_col] + ["n_chars"] * counted, T.StructType(schema), task)
    return done.select(docs.columns)


DIGEST = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                      + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def op7_pii(spark, sf_dir: str) -> DataFrame:
    """Digest columns from the operator's spans: counts and digest of the base spans, all spans as text."""
    from tabsmith.llm.common import read

    def task():
        def run(cols):
            both = [find(t) for t in cols[0]]
            out = {f"n_{k}": [sum(s[0] == k for s in b) for b, _ in both] for k in KINDS}
            out["base_sha256"] = [hashlib.sha256(_join(b).encode()).hexdigest() for b, _ in both]
            out["spans"] = [_join(a) for _, a in both]
            return out
        return run
    return map_texts(read(spark, sf_dir, "documents").select("doc_id", "text"), ["text"], DIGEST, task).drop("text")
