import random

import pytest

from scriptmill.llm import decontam as D

QUESTION = "A train leaves the old station at {a} km per hour and {n} waits there for {b} minutes before the next one comes along"
PLAIN = "the quick brown fox jumps over that lazy dog while nobody in town looks at it"


def kinds(text):
    tokens, first, kinds, _ = D.canonical(text, D._Words())
    return [D.PLACEHOLDERS[k] or tokens[first[i]].lower() for i, k in enumerate(kinds)]


def test_canonical_form():
    assert kinds("He saw Anna Maria Lopez. Then 3.5 km later two dogs") == [
        "he", "saw", "<name>", "then", "<num>", "<unit>", "later", "<num>", "dogs"]
    assert kinds("m is a letter\nKm too, 5%") == ["m", "is", "a", "letter", "km", "too", "<num>", "<unit>"]
    assert kinds("") == kinds(None) == kinds(" .?! ") == []


def make(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(1)
    bench = [(1, QUESTION.format(a="60", n="Peter", b="15"), "x"), (2, PLAIN, "x"), (3, "short one 4 you see it", "x"), (4, None, "x"),
             (5, "", "x"), (6, "12 13 14 15 Km Anna 17", "x"), (2, PLAIN, "x"),
             (7, "give 5 to the first and 9 to the second but 5 again to the last of all", "x")]
    docs = [(0, make(rng, 200)), (10, make(rng, 40) + " " + PLAIN.upper() + " " + make(rng, 40)),
            (11, make(rng, 30) + ". " + QUESTION.format(a="75", n="Maria Keller", b="20") + " " + make(rng, 30)),
            (12, " ".join(PLAIN.split()[:9])), (13, " ".join(PLAIN.split()[:13]) + " " + make(rng, 5)), (14, None), (15, ""),
            (None, "oh " + PLAIN), (16, "Short one 88 you see it"), (17, "1 2 3 4 Km Anna 5 " * 40),
            (18, "give 6 to the first and 8 to the second but 6 again to the last of all"),
            (19, "give 6 to the first and 8 to the second but 7 again to the last of all"),
            (20, make(rng, 60_000) + " " + PLAIN), (10, "nothing here"), (21, PLAIN), (21, PLAIN)]
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, template string, item_id int")
    b = spark.createDataFrame(bench, "item_id long, text string, template string")
    return d, b, D.contamination(d, b).collect()


def test_finds_exact_and_reparameterised(found):
    got = {(r.doc_id, r.item_id): r for r in found[2]}
    assert set(got) == {(10, 2), (11, 1), (13, 2), (None, 2), (16, 3), (18, 7), (20, 2), (21, 2)}
    assert len(found[2]) == 8
    assert got[(11, 1)].reparameterised and got[(18, 7)].reparameterised and not got[(21, 2)].reparameterised
    assert got[(21, 2)].coverage == 1.0
    pairs = {(p.item_slots.value, p.doc_slots.value) for p in got[(11, 1)].slots}
    assert pairs == {("60", "75"), ("km", "km"), ("peter", "maria keller"), ("15", "20"), ("minutes", "minutes")}


def test_bitmap_drops_nothing(found):
    """Every window that a plain comparison of templates finds is found."""
    d, b, rows = found
    w = D._Words()
    items = {t for r in b.collect() for *_, t, _ in D.windows(r.text, w, [min(8, len(kinds(r.text)))], 4)}
    plain = {r.doc_id for r in d.collect() for s in range(4, 9) if {x[3] for x in D.windows(r.text, w, [s], 4)} & items}
    assert {r.doc_id for r in rows} <= plain


def test_remove(found):
    d, b, _ = found
    left = D.remove_contaminated(d, b)
    assert left.columns == d.columns
    assert sorted((r.doc_id, (r.text or "")[:7]) for r in left.collect() if r.doc_id is not None and r.doc_id in (10, 12, 14, 15, 17, 19, 21)) == [
        (10, "nothing"), (12, "the qui"), (14, ""), (15, ""), (17, "1 2 3 4"), (19, "give 6 ")]


def test_empty(spark, found):
    d, b, _ = found
    assert D.contamination(d.limit(0), b).count() == 0
    assert D.contamination(d, b.limit(0)).count() == 0


def held(spark, items, docs, **limits):
    b = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    d = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in D.contamination(d, b, **limits).collect()}


TOM = "Tom has 5 apples. Tom gives 2 to Anna. Tom buys 3 more. How many apples does Tom have now?"


def test_sentence_initial_names(spark):
    maria = TOM.replace("Tom", "Maria").replace("5", "7").replace("2", "4").replace("3", "6")
    got = held(spark, [TOM, "What is the name of this river"], ["so. " + maria, "now see What is the name of this river here"])
    assert set(got) == {(0, 0), (1, 1)}
    assert got[0, 0].reparameterised and got[0, 0].coverage >= 0.75 and not got[1, 1].reparameterised
    assert ("tom", "maria") in {(p.item_slots.value, p.doc_slots.value) for p in got[0, 0].slots}


def test_slots_are_judged_per_window(spark):
    pears = "she put {} apples and {} pears into the basket before the others came home"
    years = "in {} the people of the town built a bridge over the wide river and in {} they built another one of stone"
    got = held(spark, [pears.format(5, 7), years.format(2010, 2010)],
               [pears.format(4, 4), years.format(2010, 2011), years.format(2011, 2010), years.format(2011, 2012)])
    assert set(got) == {(0, 0), (1, 1), (2, 1)}
    assert got[0, 0].coverage == 1.0 and got[1, 1].n_matched < got[1, 1].n_windows
    assert not got[1, 1].reparameterised


def test_edited_and_partial_copies(spark):
    rng = random.Random(5)
    words = make(rng, 50).split()
    half = " ".join(words[:25]), " ".join(words[25:])
    price = "the man who sold the old boat paid {} for it and then gave {} to his young son at home"
    sum_ = "Compute 12 + 7 * 3 - 4."
    docs = [f"{half[0]} oh {half[1]}", f"{half[0]} {' '.join(words[26:])}", make(rng, 30) + " " + " ".join(words[13:37]) + " " + make(rng, 30),
            " ".join(words[13:30]), price.format("twenty five", "one hundred and six km"), "see: compute 12 7 3 4, then", "Compute 13 + 7 * 3 - 4.",
            half[1] + " " + half[0], make(rng, 9) + " " + " ".join(words[:20]) + " " + make(rng, 300) + " " + " ".join(words[30:])]
    got = held(spark, [" ".join(words), price.format(25, 100), sum_, "Ñ. 5"], docs)
    assert set(got) == {(0, 0), (1, 0), (2, 0), (4, 1), (5, 2), (7, 0)}
    assert got[0, 0].n_matched == 36 and got[1, 0].n_matched == 35 and got[2, 0].n_matched == 17
    assert kinds("twenty five or 3 million or one, no one") == ["<num>", "or", "<num>", "or", "one", "no", "one"]


def test_chains_match_search_over_all():
    rng = random.Random(2)
    for _ in range(60):
        points = list({(rng.randrange(7), rng.randrange(12)) for _ in range(rng.randint(1, 9))})
        reach, best = rng.randint(7, 9), 0
        for mask in range(1, 1 << len(points)):
            c = sorted(p for k, p in enumerate(points) if mask >> k & 1)
            if all(a[0] < b[0] and a[1] < b[1] and abs((b[1] - a[1]) - (b[0] - a[0])) <= reach for a, b in zip(c, c[1:])):
                best = max(best, len(c))
        found = list(D.chains(points, reach))
        assert sorted(p for c in found for p in c) == sorted(points)
        assert len(found[0]) == best
