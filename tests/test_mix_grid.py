import pytest
from pyspark.sql import functions as F

from scriptmill.operators import grid, mix
from scriptmill.operators.ordered import cut_classes


def test_exact_split_sizes(spark):
    for n, train in [(20, 19), (1, 0), (1000, 950)]:
        df = spark.range(n).withColumnRenamed("id", "k")
        s = mix.split_train_val(df, "k", bits=4)
        counts = dict(s.groupBy("split").count().collect())
        assert counts.get("train", 0) == train and counts.get("val", 0) == n - train
        pos = sorted(r.pos for r in s.collect())
        assert pos == list(range(n))


def test_split_is_stable_under_repartition(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a = {r.k: r.pos for r in mix.split_train_val(df, "k").collect()}
    b = {r.k: r.pos for r in mix.split_train_val(df.repartition(7), "k").collect()}
    assert a == b


def test_mix_sizes(spark):
    one = spark.range(1)
    def size(n_sft, n_clm, r):
        return one.select(mix.mix_size(F.lit(n_sft), F.lit(n_clm), r)).first()[0]
    assert size(100, 1000, 0.2) == 25
    assert size(100, 10, 0.2) == 10
    assert size(100, 1000, 0.0) == 0
    with pytest.raises(ValueError):
        mix.mix_size(F.lit(1), F.lit(1), 1.0)


def test_mixed_datasets(spark):
    sft = spark.range(400).select(F.concat(F.lit("k"), "id").alias("key"), F.lit("q").alias("instruction"), F.lit("a").alias("completion"))
    clm = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))

    def counts(**kw):
        m = mix.mix_datasets(sft, clm, bits=6, **kw)
        rows = m.select("kind", "split", "key").collect()
        assert len({(r.kind, r.key) for r in rows}) == len(rows)
        return {k: sum(1 for r in rows if (r.kind, r.split) == k) for k in {(r.kind, r.split) for r in rows}}

    base = {("sft", "train"): 380, ("sft", "val"): 20}
    assert counts(ratio=0.0) == base
    assert counts(ratio=0.2) == base | {("clm", "train"): 95, ("clm", "val"): 150}
    assert counts(ratio=0.2, val_cap=100) == base | {("clm", "train"): 95, ("clm", "val"): 100}
    assert counts(ratio=0.9) == base | {("clm", "train"): 2850, ("clm", "val"): 150}
    assert mix.mix_datasets(sft, None, 0.5, bits=4).count() == 400
    with pytest.raises(ValueError):
        mix.instruction_records()


def test_plans_are_lazy_and_scan_little(spark, tmp):
    """Building the log and mix plans starts no job; hashes are counted, records stay."""
    spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).write.parquet(f"{tmp}/d")
    df = spark.read.parquet(f"{tmp}/d")
    plan = mix.mix_datasets(df.select(F.col("doc_id").alias("key"), "text"), df, 0.2)._jdf.queryExecution().optimizedPlan().toString()
    # per record set: hashes counted, the cell, the records and the copies of a cut's key, each branch naming its
    # cuts (the same subplans, run once); and one total
    assert plan.count("Relation") <= 14


def test_cuts_match_ranks(spark):
    """Classes by counted cuts are those of the ranked positions, with copies of keys too."""
    import random

    rng = random.Random(1)
    for n, copies in ((1, 0), (2, 0), (300, 0), (300, 120), (40, 39)):
        keys = [f"k{i}" for i in range(n - copies)] + ["same"] * copies
        rng.shuffle(keys)
        df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, i int").repartition(3)
        ranked = {r.i: r for r in mix.split_train_val(df, "key", bits=4).collect()}
        for name, targets in (("split", lambda t: [mix.n_train(t)]), ("three", lambda t: [F.floor(t / 5), F.floor(t / 2), t]), ("none", lambda t: [F.lit(0), t])):
            got = cut_classes(mix._hashed(df, "key", mix.SEED), "_h", "_key", targets, "c", bits=4).collect()
            assert sorted(r.i for r in got) == sorted(ranked)
            cuts = {"split": [int(n * 0.95)], "three": [n // 5, n // 2, n], "none": [0, n]}[name]
            size = lambda f: sorted((k, sum(1 for r in got if r.key == k and f(r) )) for k in set(keys))
            for c in range(len(cuts) + 1):
                by_rank = sorted((k, sum(1 for r in ranked.values() if r.key == k and sum(r.pos >= x for x in cuts) == c)) for k in set(keys))
                assert size(lambda r: r.c == c) == by_rank
        labels = mix.label_split(df, "key", bits=4)
        assert sorted(labels.columns) == ["i", "key", "split"]
        assert labels.where("split = 'train'").count() == int(n * 0.95)


def test_grid_of_many_combinations_is_spread(spark):
    df = spark.createDataFrame([(1, {f"k{i}": [str(x) for x in range(10)] for i in range(6)})], "id int, grid map<string,array<string>>")
    e = grid.expand_grid(df)
    parts = e.groupBy(F.spark_partition_id()).count().count()
    assert e.count() == 10 ** 6 and parts > 1
    last = e.where("ordinal = 123457").first()
    assert "".join(c.value for c in last.combo) == "123456"


def test_chat_text_default_system(spark):
    df = spark.createDataFrame([(None, "q", "a")], "system string, instruction string, completion string")
    t = df.select(mix.chat_text()).first()[0]
    assert t == ("<|im_start|>system\nYou are a CK3 modding expert.<|im_end|>\n<|im_start|>user\nq<|im_end|>\n"
                 "<|im_start|>assistant\na<|im_end|>")


def test_grid_order_last_key_fastest(spark):
    df = spark.createDataFrame([('{"B": [1, 2], "A": ["x", "y"]}',)], "g string")
    e = grid.expand_grid(df.select(grid.parse_grid("g").alias("grid")), "grid")
    got = [(r.ordinal, [(c.key, c.value) for c in r.combo]) for r in e.orderBy("ordinal").collect()]
    assert got == [(1, [("A", "x"), ("B", "1")]), (2, [("A", "x"), ("B", "2")]),
                   (3, [("A", "y"), ("B", "1")]), (4, [("A", "y"), ("B", "2")])]
    first = grid.expand_grid(df.select(grid.parse_grid("g").alias("grid")), "grid", max_experiments=3)
    assert first.count() == 3


def test_default_grid_size_and_estimate(spark):
    import json

    from scriptmill.fixed import DEFAULT_GRID
    df = spark.createDataFrame([(json.dumps(DEFAULT_GRID),)], "g string").select(grid.parse_grid("g").alias("grid"))
    total = df.select(grid.grid_size("grid")).first()[0]
    assert total == 96
    assert df.select(grid.estimate_minutes(grid.grid_size("grid"))).first()[0] == 480


def test_config_resolve_known_keys_only(spark):
    df = spark.createDataFrame([({"LEARNING_RATE": "0.001", "BOGUS": "1", "TIME_BUDGET": "5"},)], "m map<string,string>")
    cfg = df.select(grid.resolve_config("m", time_budget=600)).first()[0]
    assert cfg["LEARNING_RATE"] == "0.001" and "BOGUS" not in cfg and cfg["TIME_BUDGET"] == "600"
    assert cfg["NUM_EPOCHS"] == "3"
