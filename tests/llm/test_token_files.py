import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scriptmill.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, world. It's a.b ,x", "x <|endoftext|> y<|ENDOFTEXT|>", "ÀÉ İΣΑΣ ß é å.", "12.5,6 a1.b2",
         "tab\tand nbsp em\x85nel 　x", "  lead  and trail  ", "'s don't WE'LL .'s", "日本語 текст, ок.", "a" * 300,
         "&&&. ,,,. x...y", "word " * 3000, "\n\n", "a ̈b ,̈c", "İ."]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_round_trip_of_values(n):
    rng = np.random.default_rng(n)
    v = (rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
    control, data = T.encode_values(v)
    assert len(control) == -(-n // 4)
    assert T.decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n).tolist() == v.tolist()


def test_store_matches_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(T, "CACHE_WORDS", 5)
    tok = Tokenizer.from_file(PATH)
    data = [(i * 37 % 101, t, "x") for i, t in enumerate(TEXTS * 2)] + [(None, "null id", "x"), (5, "b", "x"), (5, "a", "x"), (5, "a", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string").repartition(5)
    path = str(tmp_path / "store")
    T.write_token_files(docs, path, PATH)
    rows = sorted(T.read_token_files(spark, path).collect(), key=lambda r: r.start)
    ids = [tok.encode(t or "", add_special_tokens=False).ids + [1] for _, t, _ in data]
    enc = lambda x: np.array(x, dtype="<u4").tobytes()
    got = [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in rows]
    want = [(d, len(x), enc(x)) for (d, _, _), x in zip(data, ids)]
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda d: (d is not None, d or 0))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert [r.start for r in rows] == list(np.cumsum([0] + [r.n_tokens for r in rows])[:-1])


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "store")
    T.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert T.read_token_files(spark, path).count() == 0


def test_other_tokenizers_are_encoded_whole():
    import pyarrow as pa

    texts = [t or "" for t in TEXTS]
    texts += ["a\x01b \x01 c", "\x01"] + [f"w{i} x{i}y" for i in range(1500)]
    texts += ["".join(map(chr, range(a, a + 40))) + " x" + chr(a) + "y" for a in range(33, 0x300)]
    for name, by_words in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        encoder, library = T.WordEncoder(public_tokenizers.path(name)), Tokenizer.from_file(public_tokenizers.path(name))
        assert encoder.by_words is by_words
        got = [g.tolist() for g in encoder.encode(pa.array(texts), 1)]
        want = [library.encode(t, add_special_tokens=False).ids + [1] for t in texts]
        assert got == want
        narrow = encoder.packed(pa.array(["skipped", *texts]).slice(1), 1, "<u2").to_pylist()
        assert [np.frombuffer(g, "<u2").tolist() for g in narrow] == want and len(encoder.packed(pa.array([], pa.string()), 1)) == 0
