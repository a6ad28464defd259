from pyspark.sql import functions as F

from scriptmill.operators import localization, logs
from tests import plain

LOC_LINES = [' k:0 "a"', 'k: "a" # "b"', 'k:1"a"', 'k.t:0 "a"', 'k:0 ""', '  é_1:12 "x y"']


def test_loc_parse_edge_rows(spark):
    df = spark.createDataFrame([("a.yml", i, line) for i, line in enumerate(LOC_LINES)], "path string, ln int, line string")
    got = {r.ln: (r.key, r.value) for r in localization.parse_loc(df).collect()}
    want = {i: plain.loc_entry(line) for i, line in enumerate(LOC_LINES) if plain.loc_entry(line)}
    assert got == want
    assert got[1] == ("k", 'a" # "b')


def test_latest_key_wins_by_path_then_line(spark):
    df = spark.createDataFrame([("a.yml", 1, "k", "x"), ("a.yml", 5, "k", "y"), ("b.yml", 0, "k", "z"), ("a.yml", 2, "j", "w")],
                               "path string, ln int, key string, value string")
    assert dict(localization.latest_loc(df).collect()) == {"k": "z", "j": "w"}


def test_description_cleaning_and_fallthrough(spark):
    vals = ["#P big#! [x.Y]", "[a] [b]", " plain "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(localization.clean_description("v")).collect()]
    assert got == [plain.clean_desc(v) for v in vals] == ["big#!", "", "plain"]
    loc = spark.createDataFrame([("n", "[a] [b]"), ("n_desc", "#P ok"), ("n_title", "late"), ("m_tooltip", "tip")],
                                "key string, value string")
    d = dict(localization.descriptions(loc).collect())
    assert d["n"] == "ok" and d["m"] == "tip"


def test_prefix_and_group_sizes(spark):
    keys = ["a_b_c", "a", "_x", "a_"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = [r[0] for r in df.select(localization.key_prefix("k")).collect()]
    assert got == [k.rsplit("_", 1)[0] if "_" in k else k for k in keys]
    rows = [(f"g1_{i}", "v") for i in range(1)] + [(f"g2_{i}", "v") for i in range(2)] + \
           [(f"g20_{i}", "v") for i in range(20)] + [(f"g21_{i}", "v") for i in range(21)]
    loc = spark.createDataFrame(rows, "key string, value string")
    pairs = {r.name: r.completion for r in localization.loc_pairs(loc).collect()}
    assert set(pairs) == {"g2", "g20"}
    assert pairs["g2"] == 'l_english:\n  g2_0:0 "v"\n  g2_1:0 "v"'


def test_large_groups_are_split_without_loss(spark):
    loc = spark.createDataFrame([(f"g_{i}", "v") for i in range(95)] + [("h_1", "v"), ("h_2", "v")], "key string, value string")
    parts = localization.loc_pairs(loc, oversize="split").collect()
    lines = [x for r in parts if r.name == "g" for x in r.completion.split("\n")[1:]]
    assert len(lines) == len(set(lines)) == 95 and len(parts) > 3
    whole = {r.name: r.completion.count("\n") for r in localization.loc_pairs(loc, max_size=None).collect()}
    assert whole == {"g": 95, "h": 2}


def test_entries_lose_nothing_but_delimiters(spark):
    """All characters of a text but delimiter lines and stripped white space are in its entries."""
    texts = ["alpha beta\n----\ngamma  \n\n delta\n ------ x\nlast " + "y" * 5000, "no delimiter at all"]
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string")
    got = {}
    for r in logs.split_entries(df, 4).collect():
        got[r.file] = got.get(r.file, 0) + len("".join(r.entry.split()))
    keep = lambda t: len("".join("".join(x for x in t.split("\n") if not x.strip().startswith("----")).split()))
    assert got == {f"f{i}": keep(t) for i, t in enumerate(texts)}


def test_log_split_rules(spark):
    text = "a\n ----\n\n----- b\nc"
    df = spark.createDataFrame([("f", text)], "file string, text string")
    four = [r.entry for r in logs.split_entries(df, 4).orderBy("entry_no").collect()]
    five = [r.entry for r in logs.split_entries(df, 5).orderBy("entry_no").collect()]
    assert four == plain.split_entries(text, 4) == ["a", "c"]
    assert five == plain.split_entries(text, 5) == ["a\n ----", "c"]
    three = spark.createDataFrame([("f", "x\n---\ny")], "file string, text string")
    assert [r.entry for r in logs.split_entries(three, 4).collect()] == ["x\n---\ny"]


def test_entry_names(spark):
    df = spark.createDataFrame([("add_gold - Adds gold\nScopes: x",), ("scope:thing: y",), ("Func(int) -> x",)], "e string")
    got = df.select(logs.log_entry_name("e").alias("a"), logs.data_type_name("e").alias("b")).collect()
    assert [r.a for r in got] == ["add_gold", "scope", "Func(int) -> x"]
    assert got[2].b == "Func"


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

LOC_PIECES = st.sampled_from(["k", "é", "_", "1", ":", "0", " ", "\t", '"', "a b", "#", ".", "　", "x"])
LOG_PIECES = st.sampled_from(["a", " ", "\n", "-", "----", "-----", "\t", "x - y", ":", " ", "("])


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(LOC_PIECES, max_size=16).map("".join), min_size=1, max_size=25))
def test_loc_parse_matches_plain(spark, lines):
    df = spark.createDataFrame([("a.yml", i, line) for i, line in enumerate(lines)], "path string, ln int, line string")
    got = {r.ln: (r.key, r.value) for r in localization.parse_loc(df).collect()}
    want = {i: plain.loc_entry(line) for i, line in enumerate(lines) if plain.loc_entry(line)}
    assert got == want


@settings(max_examples=20, deadline=None)
@given(st.lists(st.lists(LOG_PIECES, max_size=30).map("".join), min_size=1, max_size=10))
def test_log_split_matches_plain(spark, texts):
    df = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file string, text string")
    for dashes in (4, 5):
        got = {}
        for r in logs.split_entries(df, dashes).collect():
            got.setdefault(r.file, []).append((r.entry_no, r.entry))
        for i, t in enumerate(texts):
            assert [e for _, e in sorted(got.get(f"f{i}", []))] == plain.split_entries(t, dashes)
