import json
import random
import struct

from pyspark.sql import functions as F

from scriptmill.functions.json_text import python_float, python_json


def _written(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(4)
    return [r.t for r in sorted(d.select("i", python_json("t").alias("t")).collect())]


def _python(text):
    return json.dumps(json.loads(text), separators=(",", ":"))


def test_numbers_escapes_and_order(spark):
    texts = ['{ "b" : 1.0e5, "a": [1E2, -0, -0.0, 0.1e-6, 1e16, 123456789012345678901234567890, 1e400, -1e400, 5e-324] }', '"\\u0041\\u00e9\\/\\u0022\\u005c\\u000a\\u001F"',
             '{"k":"\\\\u0041 \\" \\n é 日本 \U0001f600 \x7f \\ud83d\\ude00 \\uD800"}', "[]", "{}", " null ", "true", '""', '"\\\\"', "[NaN, -Infinity]", "0.30", "1e22", "9007199254740993.0",
             "2e23", "8.41e21", "2.2250738585072011e-308", "1.7976931348623157e308", "0.0001", "0.00001", "123456789012345680.0"]
    for text, got in zip(texts, _written(spark, texts)):
        assert got == _python(text)


def test_random_objects(spark):
    rng = random.Random(7)

    def value(depth):
        kind = rng.randrange(8 if depth else 6)
        if kind == 0:
            return rng.choice([None, True, False])
        if kind == 1:
            return rng.randrange(-10**rng.randrange(1, 25), 10**rng.randrange(1, 25))
        if kind in (2, 3):
            return rng.choice([rng.random(), rng.uniform(-1, 1) * 10.0 ** rng.randrange(-30, 30), round(rng.random() * 1000, 3)])
        if kind in (4, 5):
            return "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0, 32), rng.randrange(0xA0, 0xD800), rng.randrange(0x10000, 0x1FFFF), 34, 92, 47]))
                           for _ in range(rng.randrange(12)))
        if kind == 6:
            return [value(depth - 1) for _ in range(rng.randrange(5))]
        return {f"k{i}" + chr(rng.randrange(0x20, 0x400)): value(depth - 1) for i in range(rng.randrange(5))}

    objects = [{"x": value(3)} for _ in range(1500)]
    texts = [json.dumps(o, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5) for o in objects]
    assert _written(spark, texts) == [_python(t) for t in texts]


def test_floats_print_as_python_prints_them(spark):
    rng = random.Random(11)
    bits = [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(30_000)]
    values = [x for x in bits if x == x] + [rng.random() for _ in range(10_000)] + [float(f"{rng.randrange(1, 10**6)}e{rng.randrange(-25, 25)}") for _ in range(10_000)]
    d = spark.createDataFrame([(x,) for x in values], "x double").select("x", python_float(F.col("x")).alias("t"))
    wrong = [(r.x, r.t) for r in d.collect() if r.t != json.dumps(r.x)]
    # the last of 16 digits may be the other neighbour's
    assert len(wrong) <= 5 and all(float(t) == x and len(t) == len(json.dumps(x)) for x, t in wrong), wrong[:5]


def test_long_strings_and_other_text(spark):
    n = 1_000_000
    texts = [json.dumps({"k": s, "n": 1}, ensure_ascii=False) for s in ("a" * 10 * n, "é" * n, "\\" * n, "aé" * (n // 4))]
    assert _written(spark, texts) == [_python(t) for t in texts]
    assert _written(spark, ["not json 1.50", '{"a": "open 1.0', "", None]) == ["notjson1.50", '{"a":"open1.0', "", None]
