import random
import re

import pytest

from millrace.llm.contract import QUERIES
from millrace.llm import templates as tp
from millrace.llm.templates import NUM, UNIT, UNITS, canonical, codes, leaks, mark_leaks

ITEM = "Alice walked 12 km to the market and bought 12 apples from Bob Smith before the old clock struck again"


def simple(text):
    """Canonical tokens by plain rules, for texts without names: a check of the array version."""
    out = []
    for raw in (text or "").replace("\n", ". ").split():
        w = re.sub(r"^\W+|\W+$", "", raw).lower()
        if not w:
            continue
        m = re.fullmatch(r"([+-]?\d(?:[\d.,/:]*\d)?)([^\W\d_]+)", w)
        if re.fullmatch(r"\d[\d.,]*%?", w):
            out.append("<n>")
        elif m and m[2] in UNITS:
            out += ["<n>", "<u>"]
        elif w in UNITS and out and out[-1] == "<n>":
            out.append("<u>")
        else:
            out.append(w)
    return out


def brute(docs, items, width=8):
    index = {}
    for i, t in items:
        c = simple(t)
        for k in range(len(c) - width + 1):
            w = tuple(c[k : k + width])
            if sum(x[0] != "<" for x in w) >= 4:
                index.setdefault(w, set()).add((i, k))
    out = {}
    for d, t in docs:
        c, found = simple(t), {}
        for k in range(len(c) - width + 1):
            for i, p in index.get(tuple(c[k : k + width]), ()):
                found.setdefault(i, set()).add(p)
        of = {i: len({p for v in index.values() for j, p in v if j == i}) for i in found}
        out[d] = sorted(i for i, p in found.items() if len(p) >= min(3, of[i]))
    return out


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    return {r["doc_id"]: r["item_ids"] for r in mark_leaks(d, b).collect()}


def test_reparameterised_questions(spark):
    other = ITEM.replace("12", "73").replace("km", "miles").replace("Bob Smith", "Carla").replace("Alice", "Dora")
    mixed = ITEM.replace("12 km", "5 km").replace("12 apples", "9 apples")
    docs = [(1, "Some words first. " + ITEM.upper().lower() + " and more"), (2, "Intro. " + other), (3, "Intro. " + mixed), (4, "Nothing here of that kind at all, really nothing to be seen in it"), (5, None), (6, "")]
    got = run(spark, docs, [(7, ITEM), (3, ITEM), (8, "too short"), (9, None), (None, "x y z")])
    assert got[2] == [3] and got[3] == [] and got[4] == got[5] == got[6] == []


def test_kinds():
    kind, _, _, at, raw = canonical(["It took 5km, or 3 hours, not twelve days."])
    assert kind.tolist() == [0, 0, NUM, UNIT, 0, NUM, UNIT, 0, NUM, UNIT]


@pytest.mark.parametrize("seed", [1, 2])
def test_like_brute_force(spark, seed):
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)] + ["12", "7.5", "km", "5kg"]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(3, 40)))) for i in range(30)]
    docs = []
    for d in range(80):
        w = rnd.choices(words, k=rnd.randint(0, 120))
        if rnd.random() < 0.6:
            t = rnd.choice(items)[1].split()
            a = rnd.randrange(len(t))
            k = rnd.randrange(len(w) + 1)
            w[k:k] = t[a : a + rnd.randint(1, 40)]
        docs.append((d, " ".join(w)))
    assert run(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, ITEM, 0), (1, ITEM, 0), (None, ITEM, 0), (2, "q " * 100000, 0)], "doc_id bigint, text string, leaked int")
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    got = sorted((r["doc_id"] or -1, r["leaked"]) for r in mark_leaks(docs, bench).collect())
    assert got == [(-1, True), (1, True), (1, True), (2, False)]  # rows without an id are judged too
    assert mark_leaks(docs.limit(0), bench).count() == 0 and mark_leaks(docs, bench.limit(0)).where("leaked").count() == 0
    assert leaks(docs, bench).count() == 3


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r["item_ids"] for r in QUERIES["op8_template_decontamination"](spark, sf).collect()}
    want = brute(docs, items)
    assert {i for i, v in want.items() if v} == {i for i, v in got.items() if v} and sum(map(bool, want.values())) > 3


def test_occurrences_are_judged_apart(spark):
    """A verbatim copy beside a variant, two variants, and an item whose own template repeats."""
    one, two = (ITEM.replace("12", a).replace("km", b).replace("Bob Smith", c) for a, b, c in (("73", "miles", "Carla"), ("41", "yards", "Emil")))
    twice = "then they added 3 large red apples to the big basket and then they added 4 large red apples to the big basket"
    docs = [(1, f"Intro. {ITEM}. {one}"), (2, f"Intro. {one}. {two}"), (3, f"Intro: {twice}"), (4, "Intro. " + ITEM.replace("12 km", "5 km").replace("12 apples", "9 apples"))]
    assert run(spark, docs, [(3, ITEM), (4, twice)]) == {1: [3], 2: [3], 3: [4], 4: []}


def test_names_that_begin_sentences_or_have_more_capitals(spark):
    tom = "Tom has 12 red apples. Tom eats 5 apples today. How many apples are left?"
    mac = "in the morning old McDonald and NASA sold eleven brown cows to the farmer next door for money"
    docs = [(1, "Intro. " + tom.replace("Tom", "Anna")), (2, "Intro. " + tom.replace("Tom", "Mary Ann").replace("12", "9")), (3, "Intro: " + mac.replace("McDonald", "O'Brien").replace("NASA", "ESA")), (4, "Intro: " + tom), (5, "so " + tom.lower()), (6, "Intro: " + mac.upper())]
    assert run(spark, docs, [(1, tom), (2, mac)]) == {1: [1], 2: [1], 3: [2], 4: [1], 5: [1], 6: [2]}


def test_short_items_and_items_of_numbers(spark):
    short, dense, tiny = "What is the capital city of France?", "2 + 3 x 4 - 5 = 7 or 9 km ?", "so be it"
    docs = [(1, f"Intro here. {short} And more."), (2, f"well: {dense} then"), (3, "so be it and what is the capital"), (4, dense.replace("9", "8")), (None, f"well: {dense} then"), (None, short)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    b = spark.createDataFrame([(1, short), (2, dense), (3, tiny)], "item_id bigint, text string")
    got = sorted((r["doc_id"] or 0, r["item_ids"]) for r in mark_leaks(d, b).collect())
    assert got == [(0, [1]), (0, [2]), (1, [1]), (2, [2]), (3, []), (4, [])]
    from millrace.llm.templates import drop_leaks

    assert sorted(r["doc_id"] for r in drop_leaks(d, b).collect()) == [3, 4]


def test_variants_of_one_template_are_one_class(spark):
    from millrace.llm.templates import template_classes, windows

    text = "after the long storm {} men carried {} km of rope over {} hills and {} rivers to the old town"
    items = [(i, text.format(i + 2, i + 3, i + 4, i + 5)) for i in range(40)] + [(50, text.format(7, 7, 8, 9)), (51, text.format(7, 8, 9, 7)), (52, "nothing of the kind is said in this item of the benchmark")]
    known = windows(spark.createDataFrame(items, "i bigint, t string"), "i", "t", None)
    heads = {r["row"]: r["head"] for r in template_classes(known).collect()}
    assert heads == {**{i: 0 for i in range(40)}, 50: 50, 51: 51, 52: 52}
    docs = [(1, "Intro. " + text.format(91, 92, 93, 94)), (2, "Intro. " + text.format(91, 91, 93, 94)), (3, "Intro. " + text.format(3, 3, 3, 3).replace("rope", "wool").replace("hills", "fields").replace("long", "short"))]
    got = run(spark, docs, items)
    assert got[1][:40] == list(range(40)) and 50 in got[2] and got[3] == []


def spelled(text):
    """Template tokens and slots by plain rules, names inside sentences included: (token, value) pairs."""
    out, begins, last_name = [], True, False
    for raw in text.split():
        bare = re.sub(r"^\W+|\W+$", "", raw)
        if re.fullmatch(r"\d+", bare):
            out.append(("<n>", bare))
        elif bare.lower() in UNITS and out and out[-1][0] == "<n>":
            out.append(("<u>", bare.lower()))
        elif bare[0].isupper() and bare[1:].islower() and not begins:
            if not last_name:
                out.append(("<p>", bare.lower()))
        else:
            out.append((bare.lower(), None))
        last_name = out[-1][0] == "<p>"
        begins = raw[-1] in ".!?"
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_names_and_slots_like_brute_force(spark, seed):
    """One planted occurrence a document, its values replaced throughout or at odds: windows and slots judged by plain rules."""
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    names, units = ["Ann", "Bob", "Cleo", "Dora", "Emil"], ["km", "kg", "hours"]

    def question():
        t = []
        while len(t) < 30:
            t += rnd.choices(words, k=rnd.randint(2, 4)) + rnd.choice([[rnd.choice(names)], [str(rnd.randint(2, 4)), rnd.choice(units)], [str(rnd.randint(2, 4))]])
        return ["in"] + t

    items, docs = [question() for _ in range(20)], []
    for d in range(60):
        item, table, odd = rnd.choice(items), {}, rnd.random() < 0.4
        new = []
        for w in item:
            fresh = str(rnd.randint(100, 999)) if w.isdigit() else rnd.choice(names) + "x" * rnd.randint(1, 9) if w in names else rnd.choice(units) if w in units else w
            new.append(fresh if odd else table.setdefault(w, fresh))
        docs.append((d, " ".join(rnd.choices(words, k=9) + new + rnd.choices(words, k=9))))
    want = {}
    for d, t in docs:
        have, want[d] = spelled(t), []
        for i, item in enumerate(items):
            of = spelled(" ".join(item))
            hits, slots = set(), set()
            for a in range(len(of) - 7):
                for b in range(len(have) - 7):
                    x, y = of[a : a + 8], have[b : b + 8]
                    if [k for k, _ in x] == [k for k, _ in y] and sum(k[0] != "<" for k, _ in x) >= 4:
                        hits.add(a)
                        slots |= {(v, z) for (_, v), (_, z) in zip(x, y) if v is not None}
            values = {v for v, _ in slots}
            if len(hits) >= 3 and len(slots) - len(values) <= 0.25 * len(values):
                want[d].append(i)
    got = run(spark, docs, [(i, " ".join(t)) for i, t in enumerate(items)])
    assert got == want and 20 < sum(map(bool, want.values())) < 60


def plain_flags(raw):
    """Flags of a token by plain string functions."""
    bare = tp.OUTER.sub("", raw)
    word = bare.lower()
    number = bool(tp.NUMBER.fullmatch(bare)) or word in tp.NUMBER_WORDS or bool(re.fullmatch(tp.COMPOUND, word))
    m = tp.JOINED.fullmatch(bare)
    joined = not number and bool(m) and m[2].lower() in UNITS
    capital = bool(bare) and not number and not joined and bare[0].isupper()
    return not bare, number and bool(bare), joined, capital, capital and bare[1:].islower(), word in UNITS, raw[-1] in ".!?:;"


def test_codes_like_plain_strings(spark):
    import numpy as np
    import pyarrow as pa

    odd = "5km 12kg +5 -5 -5km ²x ½ 5² one, zwei. ZWEI (seven) _a_ __ -- é É. Éa ÉA a1 1a 1a. 5. 5, 5% 12:30 1/2 km. Km KM! '' ... x² ²³ ٣ ٣km McDonald O'Brien NASA. word;: (word) «mot» ’s A Ab. aB DŽ Dža ß ẞ i̇".split()
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    words = sorted({w for t in texts for w in (t or "").split()} | set(odd))
    got = codes(pa.array(words))
    for k, bit in enumerate((tp._EMPTY, tp._NUM, tp._JOINED, tp._CAPITAL, tp._TITLE, tp._UNIT, tp._END)):
        have = ((got & bit) != 0).tolist()
        assert [w for w, h in zip(words, have) if h != plain_flags(w)[k]] == [], k
    by = {}
    for w, h in zip(words, (got & tp._HASH).tolist()):
        assert by.setdefault(tp.OUTER.sub("", w).lower(), h) == h
    assert len(set(by.values())) == len(by) and np.unique(got).size > 100


def test_a_common_opening_leaks_nothing(spark):
    """A hundred items begin alike; a document with that beginning and another ending leaks none of them, one with an item's ending leaks that one."""
    opening = "choose the correct answer from the options listed below and write it into the box"
    endings = [" ".join(f"q{chr(97 + i // 26)}{chr(97 + i % 26)}{chr(97 + k)}" for k in range(14)) for i in range(100)]
    items = [(i, f"{opening} {e}") for i, e in enumerate(endings)]
    docs = [(k, f"so then: {opening} " + " ".join(f"d{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j)}" for j in range(9))) for k in range(100)]
    docs += [(200, f"so then: {opening} {endings[7]}"), (201, f"so then: {endings[9]} and more")]
    got = run(spark, docs, items)
    assert [d for d, v in got.items() if v] == [200, 201] and got[200] == [7] and got[201] == [9]
    # items that have nothing but shared windows are still found
    same = [(i, f"{opening} in lane {chr(97 + i)}{chr(97 + i)}") for i in range(20)]
    assert run(spark, [(1, f"so then: {opening} in lane cc")], same)[1] == [2]


def test_compound_numbers_and_ordinals(spark):
    import pyarrow as pa

    numbers = "twenty-one Thirty-Two one-hundred 1st 2nd 23rd 4th 3e 1er einundzwanzig dreihundertzwölf zweitausend fünfhundertsechsundachtzig quatre-vingt-dix vingt-et-un veintiuno doscientos quinientas twenty 7".split()
    words = "twenty-something one-way undzwanzig hundertste e st and-one well-known einund tausendfach".split()
    flags = (codes(pa.array(numbers + words)) & tp._NUM) != 0
    assert flags.tolist() == [True] * len(numbers) + [False] * len(words)
    item = "a baker sold {} loaves of rye bread on the {} day of the long fair"
    docs = [(1, "so " + item.format("twenty-one", "3rd")), (3, "so " + item.format("einundzwanzig", "1st"))]
    assert run(spark, docs, [(1, item.format("5", "2nd"))]) == {1: [1], 3: [1]}


def test_common_windows_are_counted_and_decide_alone_in_the_pipeline(spark, tmp_path):
    """Twelve questions about one passage: a document with the passage alone goes, one with its end and two words of a question leaks that question."""
    import corpus_pipeline

    passage = "the old mill beside the river was sold in spring to a baker who wanted its great stone wheel for his new house"
    items = [(i, f"{passage} " + " ".join(f"q{chr(97 + i)}{chr(97 + k)}" for k in range(12))) for i in range(12)]
    docs = [(1, f"so then: {passage} and so on"), (2, f"so then: {passage} qda qdb and so on"), (3, "nothing of the kind is told in this text about mills and rivers and bakers at all"), (4, f"so then: {items[5][1]}")]
    d = spark.createDataFrame([(*x, "en", "s", 1) for x in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    every = list(range(12))
    assert run(spark, docs, items) == {1: [], 2: [3], 3: [], 4: [5]}
    assert {r["doc_id"]: r["item_ids"] for r in mark_leaks(d, b, common=True).collect()} == {1: every, 2: every, 3: [], 4: every}
    b.write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [r["doc_id"] for r in corpus_pipeline.decontaminate(spark, d, str(tmp_path)).collect()] == [3]


@pytest.mark.parametrize("seed", [5, 6])
def test_common_windows_like_brute_force(spark, monkeypatch, seed):
    """Items are made of pieces that several share, windows of two holders or more are common: nothing is lost where they decide alone."""
    monkeypatch.setattr(tp, "SHARED", 1)
    rnd = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    pieces = [" ".join(rnd.choices(words, k=rnd.randint(4, 14))) for _ in range(12)]
    items = sorted({" ".join(rnd.sample(pieces, rnd.randint(1, 3)) + rnd.choices(words, k=rnd.choice([0, 1, 2, 9]))) for _ in range(40)})
    items = list(enumerate(items))
    docs = []
    for k in range(120):
        w = rnd.choices(words, k=rnd.randint(0, 40))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            t = rnd.choice(items)[1].split()
            a = rnd.randrange(len(t))
            w[(at := rnd.randrange(len(w) + 1)) : at] = t[a : a + rnd.randint(8, 30)]
        docs.append((k, " ".join(w)))
    want = brute(docs, [x for x in items if len(x[1].split()) >= 8])
    items = [x for x in items if len(x[1].split()) >= 8]
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert {r["doc_id"]: r["item_ids"] for r in mark_leaks(d, b, common=True).collect()} == want
    assert sorted(r["doc_id"] for r in tp.drop_leaks(d, b).collect()) == [k for k, v in want.items() if not v]
    assert 20 < sum(map(bool, want.values())) < 115
