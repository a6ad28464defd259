import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from scriptmill.llm import spm_wfst as W

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  a  b ", "é　中文 🙂🙂 x", "▁a ▁ b▁▁c", "<s> </s> <unk> <0x41>", "a.b,c. ..,, 1.5 x'.s", "\n\n\t a\0b",
         "aaaa" * 20, "......", "HELLO.World e.g., U.S.A.", "日本語テキスト。", "x" * 500, "    " * 9, "   .a   ,b", "word and " * 4000,
         "öffentlichkeit straße", "\r\n\v\f", "𝔘𝔫𝔦"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("text", TEXTS)
def test_matches_the_library(library, text):
    t = W.transducer(MODEL)
    ids = t.encode(text)
    assert ids == library.encode(text or "")
    assert t.decode(ids) == library.decode(ids)


def test_random_texts_with_small_caches(library, monkeypatch):
    monkeypatch.setattr(W, "CACHE_WORDS", 20)
    monkeypatch.setattr(W, "CACHE_PAIRS", 50)
    t, rng = W.Transducer(MODEL), random.Random(0)
    alphabet = "aaeeiionrst  .,\n'éß中🙂▁19"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for i in range(0, 400, 50):
        got = [np.frombuffer(x, "<u4").tolist() for x in t.encode_batch(texts[i:i + 50])]
        assert got == [library.encode(x) for x in texts[i:i + 50]]


def test_path_is_the_cheapest_of_all_paths():
    """Brute force over the whole lattice: one path of finite weight, and it is the one found."""
    t = W.transducer(MODEL)

    def paths(word, last=""):
        if not word:
            yield []
        for n in range(1, len(word) + 1):
            if (word[:n] in t.piece_id or n == 1) and t.weight(last, word[:n]) == 0.0:
                for rest in paths(word[n:], word[:n]):
                    yield [word[:n], *rest]

    for word in ("▁hello", "▁tokens", "ation", "▁🙂a", "thing", "▁▁▁x"):
        assert list(paths(word)) == [t.shortest_path(word)]


def test_decoding_bad_bytes(library):
    t = W.transducer(MODEL)
    for ids in ([t.byte_id[0xC3]], [t.byte_id[0xE4], t.byte_id[0xB8], 500], [t.byte_id[0xE4], t.byte_id[0xB8], t.byte_id[0xAD]],
                [600, t.byte_id[0xFF], t.byte_id[0x41], 700]):
        assert t.decode(ids) == library.decode(ids)


def test_frames(spark, library):
    data = [(i, x, "x") for i, x in enumerate(TEXTS)] + [(None, "no id", "x"), (3, TEXTS[3], "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, ids string")
    out = W.decode(W.encode(docs, MODEL), MODEL)
    assert sorted(map(str, W.encode_and_decode(docs, MODEL).collect())) == sorted(map(str, out.collect()))
    assert out.columns == ["doc_id", "text", "ids", "__ids", "__decoded"]
    rows = out.collect()
    assert len(rows) == len(data)
    for r in rows:
        assert np.frombuffer(r["__ids"], "<u4").tolist() == library.encode(r.text or "")
        assert r["__decoded"] == (r.text or "").replace("▁", " ")
    assert W.encode(docs.limit(0), MODEL).count() == 0
    for name in ("__ids", "__both"):
        with pytest.raises(ValueError):
            W.encode_and_decode(docs.withColumnRenamed("ids", name), MODEL)


def retyped(tmp_path, kind):
    """The model file with another model type."""
    blob = sentencepiece.SentencePieceProcessor(model_file=MODEL).serialized_model_proto()
    spec = dict(W._fields(blob))[2]
    new = spec.replace(b"\x18\x02", bytes([0x18, kind]), 1)
    assert dict(W._fields(new))[3] == kind
    path = str(tmp_path / f"kind{kind}.model")
    with open(path, "wb") as f:
        f.write(blob.replace(spec, new, 1))
    return path


def test_unigram_models_use_piece_weights(tmp_path):
    path = retyped(tmp_path, W.UNIGRAM)
    t, library, rng = W.Transducer(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(3)
    alphabet = "aaeeiionrst  .,\n'éß中🙂19"
    texts = [x for x in TEXTS if len(x or "") < 300] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for text in texts:
        assert t.encode(text) == library.encode(text or ""), text


def test_other_model_types_raise(tmp_path):
    with pytest.raises(ValueError, match="unigram"):
        W.Transducer(retyped(tmp_path, 4))


def test_many_bad_bytes_and_very_long_texts(library):
    t = W.transducer(MODEL)
    bad = [t.byte_id[0xFF]] * 100_000 + [t.byte_id[0xE4]] * 3 + [600]
    assert t.decode(bad) == library.decode(bad)
    for text in ("x" * 20_000, "ab " * 100_000, "中" * 20_000, "é.,\n" * 20_000):
        assert t.encode(text) == library.encode(text)
