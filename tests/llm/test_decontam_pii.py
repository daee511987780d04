import random
import re

import pytest

from tabsmith.llm import decontam, pii

ITEMS = ["What is the tallest mountain on the planet when measured from the level of the sea? Mount Everest is the answer.",
         "Un deux trois quatre cinq éléphants se balançaient sur une toile toile d'araignée. Combien?", "", None, "two words",
         " ".join(f"word{i}" for i in range(300))]


def index(texts):
    rows = [(i, w, q) for i, t in enumerate(texts) for w, q in decontam.units(t)]
    freq = {}
    for _, ws, _ in rows:
        for w in set(ws):
            freq[w] = freq.get(w, 0) + 1
    return decontam.Index(rows, freq, len(rows), sum(len(r[1]) for r in rows) / len(rows), max(len(r[1]) for r in rows))


def brute(ix, text, threshold):
    """Scores of all windows against all units from the impacts alone."""
    ws, out = decontam.words(text), {}
    names = {k: w for w, k in ix.terms.items()}
    for at in range(0, max(1, len(ws) - ix.step), ix.step):
        here = set(ws[at:at + 2 * ix.step])
        for u, impact in enumerate(ix.impact):
            s = sum(x for t, x in impact.items() if names[t] in here)
            if s >= threshold:
                out[u] = max(out.get(u, 0), s)
    return out


def test_block_max_search_equals_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(4000)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randrange(6, 60))) for _ in range(90)]
    ix = index(items)
    texts = [None, ""]
    for _ in range(120):
        t = rng.choices(vocabulary, k=rng.randrange(1, 300))
        if rng.random() < 0.6:
            leak = rng.choice(items).split()
            at = rng.randrange(len(t))
            t[at:at] = leak[:max(1, int(len(leak) * rng.choice([0.5, 0.7, 1.0])))]
        texts.append(" ".join(t))
    for threshold in (0.4, 0.6, 0.9):
        for t, found in zip(texts, ix.search(texts, threshold), strict=True):
            want = brute(ix, t, threshold)
            assert {m["unit"] for m in found} == set(want)


def test_leaks(spark):
    filler = "some quite ordinary prose that has nothing to do with any test item at all "
    docs = [(1, filler * 30 + ITEMS[0] + filler * 30), (2, filler * 50), (3, ITEMS[1].upper()), (4, None), (5, ""), (6, "two words"),
            (7, "there are two words here"), (8, ITEMS[0].replace("tallest", "highest")), (9, ITEMS[0].split("?")[0] + "? " + filler),
            (10, " ".join(f"word{i}" for i in range(100, 260))), (1, filler * 30 + ITEMS[0] + filler * 30), (None, ITEMS[0])]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in docs], "doc_id long, text string, item_id string, score double")
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    got = decontam.retrieve(df, items).where("contaminated")
    assert sorted({(str(r.doc_id), r.item_id) for r in got.collect()}) == [
        ("1", 0), ("10", 5), ("3", 1), ("6", 4), ("8", 0), ("9", 0), ("None", 0)]
    left = decontam.decontaminate(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 4, 5, 7]
    assert decontam.decontaminate(df, items.limit(0)).count() == len(docs)
    assert decontam.retrieve(df, items.limit(0)).count() == 0 and decontam.retrieve(df.limit(0), items).count() == 0


def test_index_shards_give_the_same(spark, monkeypatch):
    rng = random.Random(1)
    items = [" ".join(f"t{rng.randrange(500)}" for _ in range(20)) for _ in range(40)]
    df = spark.createDataFrame([(i, "before " + t + " after") for i, t in enumerate(items)], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontam.retrieve(df, bench).collect())
    monkeypatch.setattr(decontam, "SHARD_POSTINGS", 200)
    assert len(decontam.build_index(bench)) > 2
    assert sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in decontam.retrieve(df, bench).collect()) == want


def test_short_question_with_a_long_answer_is_a_leak(spark):
    """The question carries less than THRESHOLD of question plus answer, or its common words less than that of the question."""
    items = ["Which old river runs through the city? " + "Rare " + " ".join(f"answer{i}" for i in range(30)) + ".",
             "the of and to in is was that zyx qwv. Because.",
             *["the of and to in is was that for with"] * 40]
    ix = index(items)
    docs = ["chapter one begins " * 20 + t + " and so it goes on" * 20 for t in (
        "Which old river runs through the city?", "the of and to in is was that", "which river runs through this city, answer3?")]
    leaks = [{m["item_id"] for m in ms if decontam.is_leak(m)} for ms in ix.search(docs)]
    assert 0 in leaks[0] and 1 in leaks[1] and 0 not in leaks[2]
    whole = sum(x for t, x in ix.impact[0].items() if t in {ix.terms[w] for w in ix.words[0][:7]})
    assert whole < decontam.THRESHOLD
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items[:1])), "item_id long, text string")
    assert [r.doc_id for r in decontam.decontaminate(df, bench).orderBy("doc_id").collect()] == [1, 2]


def test_every_covered_question_is_retrieved():
    """The thresholds lose no pair of the check: against all windows of all items."""
    rng = random.Random(8)
    vocabulary = [f"w{int(rng.paretovariate(0.5))}" for _ in range(3000)]
    items = [" ".join(rng.choices(vocabulary, k=rng.randrange(5, 30))) + ". " + " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)))
             for _ in range(60)]
    ix = index(items)
    texts = []
    for _ in range(150):
        t, leak = rng.choices(vocabulary, k=rng.randrange(20, 200)), decontam.words(rng.choice(items).split(".")[0])
        drop = rng.randrange(1 + len(leak) // 5) if leak else 0
        t[5:5] = [w.decode() for w in leak[drop:]]
        texts.append(" ".join(t))
    seen = 0
    for t, found in zip(texts, ix.search(texts), strict=True):
        ws, want = decontam.words(t), set()
        for at in range(0, max(1, len(ws) - ix.step), ix.step):
            want |= {u for u in range(len(items)) if decontam.is_leak(ix.overlap(u, ws, at, min(at + 2 * ix.step, len(ws))))}
        assert want == {m["unit"] for m in found if decontam.is_leak(m)}
        seen += len(want)
    assert seen > 50


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        total = sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    for _ in range(20000):
        t = "".join(rng.choice("a.@1 2-+b30(%é") for _ in range(rng.randrange(45)))
        assert pii.base_spans(t) == plain(t)
    card = "4111 1111-1111 1111 and 4111111111111111, 4111111111111112"
    assert pii.base_spans(card) == plain(card) and len(plain(card)) == 2


def test_long_texts_are_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 150_000, "+1" + "(" * 300_000, "(at) " * 60_000, "one " * 60_000):
        pii.find(t)


@pytest.mark.parametrize(("text", "spans"), [
    ("mail john.doe [at] example [dot] com now", ["email john.doe [at] example [dot] com"]),
    ("write to jane at mail dot example dot org please", ["email jane at mail dot example dot org"]),
    ("look at this point of view, meet me at noon", []), ("one two three go", []),
    ("аlice@ехample.com here", ["email аlice@ехample.com"]),
    ("call plus four nine one five one two three four five six seven eight ok",
     ["phone plus four nine one five one two three four five six seven eight"]),
    ("id ４１１１１１１１１１１１１１１１ x", ["card ４１１１１１１１１１１１１１１１"]),
    ("at 10 dot 0 dot 0 dot 1 or 10.0.0.2", ["ip 10 dot 0 dot 0 dot 1", "ip 10.0.0.2"]),
    ("bob(at)host.net, bob{at}host{dot}net", ["email bob(at)host.net", "email bob{at}host{dot}net"]),
    ("un deux trois quatre cinq six sept huit neuf un deux trois quatre cinq", []), (None, [])])
def test_deobfuscation_maps_back(text, spans):
    base, every = pii.find(text)
    assert set(base) <= set(every)
    assert [f"{k} {text[s:e]}" for k, s, e in every] == spans
    for k, s, e in every:
        assert text[s:e] not in pii.redact(text, every)


@pytest.mark.parametrize(("text", "spans"), [
    ("host one nine two dot one six eight dot zero dot one is up", ["ip one nine two dot one six eight dot zero dot one"]),
    ("eins null punkt null punkt null punkt sieben", ["ip eins null punkt null punkt null punkt sieben"]),
    ("at one 92 [dot] 168 [dot] zero [dot] one", ["ip 92 [dot] 168 [dot] zero [dot] one"]),
    ("two 192 dot 168 dot 0 dot 1", ["ip 192 dot 168 dot 0 dot 1"]), ("one nine nine nine dot one dot two dot three", []),
    ("call +1 five five five 867 5309 now", ["phone +1 five five five 867 5309"]),
    ("call plus 49 one five one (two three four) 5678", ["phone plus 49 one five one (two three four) 5678"]),
    ("call +1, five five five, 867, five three oh nine", ["phone +1, five five five, 867, five three oh nine"]),
    ("card four one one one 1111 1111 one one one one", ["card four one one one 1111 1111 one one one one"]),
    ("card four one one one 1111 1111 one one one two", []), ("555 one two three four five six", []),
    ("7, four one one one one one one one one one one one one one one one", ["card four" + " one" * 15]),
    ("john.doe at example.com wrote", ["email john.doe at example.com"]), ("mail jane at mail.example.org.", ["email jane at mail.example.org"]),
    ("jean (arobase) exemple (point) fr", ["email jean (arobase) exemple (point) fr"]),
    ("visit us at example.com or at 10.30, arrive at 11.45", []), ("one two, three. Four 5 plus six", [])])
def test_detectors_decide_on_chains(text, spans):
    _, every = pii.find(text)
    assert [f"{k} {text[s:e]}" for k, s, e in every] == spans
    assert not pii.find(pii.redact(text, every))[1]


def test_long_chains_are_linear():
    for t in ("one 2 " * 50_000, "1 dot " * 50_000, "one dot " * 50_000, "a at b.c" * 40_000, "one (" * 50_000, "name at host.com " * 20_000):
        pii.find(t)


def test_pii_frames(spark):
    rows = [(1, "a@b.co and 10.0.0.1", 19, "z"), (2, None, None, None), (3, "", 0, ""), (1, "a@b.co and 10.0.0.1", 19, "z"), (None, "plain", 5, "q")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kind string")
    got = {r.doc_id: r for r in pii.detect(df).collect()}
    assert [tuple(s) for s in got[1].all_spans] == [("email", 0, 6), ("ip", 11, 19)] and got[2].all_spans == []
    red = pii.redact_documents(df)
    assert red.columns == df.columns
    assert sorted(map(str, (tuple(r) for r in red.collect()))) == sorted(map(str, [
        (1, "[EMAIL] and [IP]", 16, "z"), (2, None, None, None), (3, "", 0, ""), (1, "[EMAIL] and [IP]", 16, "z"), (None, "plain", 5, "q")]))
    assert pii.redact("abc", [("card", 0, 2), ("phone", 1, 3)]) == "[CARD]"
