from pyspark.sql import functions as F

from scriptmill.operators import results, score

SCORE_CASES = [
    ("", ["a"], (0.0, 0.0, 0.0, 0.0, True)),
    ("a = { trigger }", ["a", "zz"], (1.0, 0.5, 1.0, 0.85, True)),
    ("import a = { }", [], (0.5, 0.0, 0.5, 0.35, True)),
    ("a = {", ["a"], (0.5, 1.0, 0.5, 0.65, False)),
]


def test_score_edge_rows(spark):
    out = spark.createDataFrame([(i, "p", t) for i, (t, _, _) in enumerate(SCORE_CASES)], "run_id int, prompt_id string, text string")
    got = {}
    for i, (t, checks, _) in enumerate(SCORE_CASES):
        p = spark.createDataFrame([("p", checks, 0)], "prompt_id string, checks array<string>, ord int")
        r = score.score_outputs(out.where(F.col("run_id") == i), p).first()
        got[i] = (r.syntax_score, r.keyword_score, r.structure_score, r.total_score, r.brace_balanced)
    for i, (_, _, want) in enumerate(SCORE_CASES):
        assert got[i] == want


def test_summary_of_nothing_is_zero(spark):
    out = spark.createDataFrame([(1, "zz", "x")], "run_id int, prompt_id string, text string")
    p = spark.createDataFrame([("p", ["a"], 0)], "prompt_id string, checks array<string>, ord int")
    s = score.summarize(score.score_outputs(out, p, "left"), ["run_id"]).first()
    assert s.val_score == 0.0 and s.num_prompts == 0


def test_benchmark_prompts_are_fixed(spark):
    p = score.eval_prompts(spark).collect()
    assert len(p) == 8 and p[0].prompt_id == "eval_event_basic" and p[-1].checks == ["l_english:", ":0", '"']


def test_rating_bands(spark):
    df = spark.createDataFrame([(0.7,), (0.69,), (0.4,), (0.1,)], "t double")
    assert [r[0] for r in df.select(score.rating("t")).collect()] == ["PASS", "WARN", "WARN", "FAIL"]


def _results(spark, scores, status="ok", configs=None):
    configs = configs or ['{"a": 1}'] * len(scores)
    rows = [(i, s, status, c) for i, (s, c) in enumerate(zip(scores, configs))]
    return spark.createDataFrame(rows, "seq long, val_score double, status string, config string")


def test_best_config_rules(spark):
    r = results.best_config(_results(spark, [0.0, 0.5, 0.5], configs=['{"a":0}', '{"a":1}', '{"a":2}'])).first()
    assert (r.best_val_score, r.best_config, r.best_seq) == (0.5, '{"a":1}', 1)
    none = results.best_config(_results(spark, [0.0, 0.0])).first()
    assert (none.best_val_score, none.best_config) == (0.0, "{}")
    bad = results.best_config(_results(spark, [0.9, 0.2], configs=["nope", '{"b":2}'])).first()
    assert bad.best_config == '{"b":2}'


def test_compact_json_of_very_long_strings(spark):
    import json

    values = [{"a": "x y" * 400_000, "b": [1, 2]}, {"q": '\\"\t' * 200_000}, {"k": " ", "": '"'}, [], "s p"]
    df = spark.createDataFrame([(i, json.dumps(v, indent=2)) for i, v in enumerate(values)], "i int, c string")
    got = dict(df.select("i", results.compact_json("c")).collect())
    assert got == {i: json.dumps(v, separators=(",", ":")) for i, v in enumerate(values)}


def test_six_decimals_as_python_writes_them(spark):
    """Random doubles, exact ties (odd multiples of 1/128) and decimal texts that look like ties."""
    import random

    from scriptmill.functions.text import fixed_6

    rng = random.Random(6)
    xs = [rng.uniform(-2, 2) * 10 ** rng.randint(-8, 8) for _ in range(200_000)] + [k / 128 for k in range(-4001, 4001, 2)]
    xs += [round(rng.uniform(0, 10 ** rng.randint(0, 8)), 6) + 5e-7 for _ in range(50_000)] + [float(f"{rng.randint(0, 10**8)}.{rng.randint(0, 10**6):06d}5") for _ in range(100_000)]
    xs += [0.0, 0.5, 5e-7, 1.5e-6, 1e-7, 0.9999995, 1.0000005, 123456.7890125, 2.0 ** 30 + 0.0078125, 1e300 * 0 + 4e9]
    df = spark.createDataFrame(list(enumerate(xs)), "i int, x double").repartition(8)
    for r in df.select("i", "x", fixed_6("x").alias("t")).collect():
        assert r.t == "%.6f" % xs[r.i], repr(xs[r.i])


def test_new_best_needs_a_saved_model(spark):
    rows = [(0, 0.3, "ok"), (1, 0.5, "error"), (2, 0.4, "ok"), (3, 0.4, "ok"), (4, 0.6, "ok")]
    df = spark.createDataFrame(rows, "seq long, val_score double, status string")
    got = [r.new_best for r in results.new_best_flags(df, width=2).orderBy("seq").collect()]
    assert got == [True, False, True, False, True]


def test_log_analytics_small(spark):
    rows = [(0, "c0", "0.5", "1", " keep ", "base"), (1, "c1", "0.4", "1", "DISCARD", "d"),
            (2, "c2", "x", "1", "crash", "boom"), (3, "c3", "0.7", "1", "Keep", "up"), (4, "c4", "0.6", "1", "keep", "down")]
    log = results.normalise_log(spark.createDataFrame(rows, "seq long, commit string, val_score string, memory_gb string, status string, description string"))
    kr = results.keep_rate(log).first()
    assert (kr.n_keep, kr.n_discard, kr.n_crash, kr.keep_rate) == (3, 1, 1, 0.75)
    rb = results.running_best(log, width=2).orderBy("seq").collect()
    assert [(r.idx, r.running_best) for r in rb] == [(0, 0.5), (2, 0.7), (3, 0.7)]
    h = results.hits(log, width=2).orderBy("rank").collect()
    assert [(r.rank, r.seq) for r in h] == [(1, 3), (2, 4)]
    s = results.summary(log).first()
    assert (s.baseline, s.best, s.best_description) == (0.5, 0.7, "up")


def test_ranking_and_cut(spark):
    df = _results(spark, [0.2, 0.9, 0.2], configs=['{"LEARNING_RATE":0.0001,"CLM_MIX_RATIO":0.2}', "{}", "{}"])
    r = results.ranking(df).orderBy("rank").collect()
    assert [x.seq for x in r] == [1, 0, 2]
    assert r[1].config_short.endswith("...") and len(r[1].config_short) == 40
