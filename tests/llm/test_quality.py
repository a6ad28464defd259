import itertools
import re

import numpy as np
import pytest

from scriptmill.llm import quality as Q

TEXTS = ["", None, "one", "a b c a b c a b c", "x\nx\n\n\nx y\nx", "# $ %\n<a> | b&\n", "é É  ß\tü\r\nab　c", "a\n" * 40,
         "w " * 300, "\n".join(f"line {i} of words" for i in range(30)), "a b c d a b c e", " \n \n"]


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    rep = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(c in "#*$%&|<>" for c in text or ""), "n_dup_lines": dup, "n_repeat_words": len(rep)}


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert Q.analyse(text)[0] == brute(text)
    assert len(Q.analyse(text)[1]) == len((text or "").split("\n"))


def path_score(path, e, crf):
    s = crf.start * path[0]
    s += sum(x for x, p in zip(e, path) if p)
    return s + sum(crf.pairs[a][b] for a, b in zip(path, path[1:]))


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(60):
        e = rng.normal(size=rng.integers(1, 8)) * 2
        crf = Q.Crf(start=rng.normal(), pairs=tuple(map(tuple, rng.normal(size=(2, 2)))))
        best = max(path_score(p, e, crf) for p in itertools.product((0, 1), repeat=len(e)))
        assert path_score(Q.viterbi(e, crf), e, crf) == pytest.approx(best)


def test_fit_raises_the_likelihood_and_separates():
    good = [(Q.analyse("The plain line of words here.\nAnother line follows it.")[2], 1)] * 20
    bad = [(Q.analyse("a### b%%% c&&& d***\nx$$$ y### z%%%")[2], 0)] * 20
    crf = Q.fit_crf(good + bad)
    label = lambda t: Q.viterbi(np.asarray(crf.weights)[Q.analyse(t)[2]].sum(axis=1), crf)
    assert label("Some more words on a line.\nAnd other words.") == [1, 1]
    assert label("q### r%%%\ns&&& t***") == [0, 0]
    assert label("Some more words on a line.\nq### r%%%\ns&&& t***\nq### r%%%")[1:] == [0, 0, 0]


def test_assess_and_reject(spark):
    good = " ".join(f"word{i}" for i in range(80)) + "."
    bad = " ".join(f"word{i}###" for i in range(80))
    data = [(i, good if i % 2 else bad, "x", i) for i in range(60)] + [(100, None, "x", 1), (101, "", "x", 1), (None, good, "x", 2),
                                                                       (1, good, "x", 9), (102, "ab " * 100, "x", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, kept string, n_words int")
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(None, 1, None), (3, None, None), (5, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    got = {(r.doc_id, r.n_words): r for r in Q.assess(docs, labels).collect()}
    assert Q.assess(docs, labels).count() == len(data)
    assert got[(1, 80)].kept and got[(None, 80)].kept and not got[(2, 80)].kept and not got[(2, 80)].base_failed
    assert got[(100, 0)].base_failed and not got[(101, 0)].kept and got[(102, 100)].base_failed
    kept = Q.reject_boilerplate(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 32
    none = Q.assess(docs, labels.limit(0)).filter("kept").count()
    assert none == 62  # no model: the base rules alone
    assert Q.assess(docs.limit(0), labels).count() == 0


def test_repeated_rows_leave_both_classes(spark):
    """Each row twice, and one document many times with other texts: no class is crowded out."""
    data = [(i, f"text {i}") for i in range(40) for _ in range(2)] + [(0, f"other {k}") for k in range(50)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    rows = Q.labelled_rows(docs, Q.labelled_sample(labels, "quality", 10), 10).collect()
    assert len(rows) == len(set(rows)) and {r.label for r in rows} == {0, 1}
    assert sum(r.label for r in rows) == 10 and len(rows) <= 20
    crf = Q.fit(spark.createDataFrame([(i, ("plain words here" if i % 2 else "a### b%%% c&&&")) for i in range(40) for _ in range(2)],
                                      "doc_id long, text string"), labels, max_docs=10)
    assert crf != Q.fit_crf([])


def mixed(rng, good):
    """A text of prose and boilerplate lines, most of one kind, with the true line labels."""
    word = lambda: "".join(rng.choice(list("abcdefghijklmnop"), int(rng.integers(2, 9))))
    prose = lambda: " ".join(word() for _ in range(int(rng.integers(9, 25)))).capitalize() + "."
    junk = [lambda: " | ".join(word().capitalize() for _ in range(6)), lambda: "### " + " $ ".join(word() for _ in range(4)) + " &&&",
            lambda: " ".join([word().upper()] * 6), lambda: "Menu > " + " > ".join(word().upper() for _ in range(3))]
    labels, state = [], int(good)
    for _ in range(int(rng.integers(8, 20))):
        if rng.random() < 0.25:
            state = int(rng.random() < (0.75 if good else 0.2))
        labels.append(state)
    if np.mean(labels) < 0.6 and good or np.mean(labels) > 0.3 and not good:
        return mixed(rng, good)
    return "\n".join(prose() if z else junk[int(rng.integers(len(junk)))]() for z in labels), labels


def test_lines_of_mixed_documents_are_labelled():
    """From document labels alone: at least 90 % of the lines of new mixed documents are right."""
    rng = np.random.default_rng(7)
    sample = [(*Q.analyse(mixed(rng, y)[0])[1:], y) for y in [0, 1] * 150]
    crf = Q.fit_latent([(feats, words, y) for words, feats, y in sample])
    right = of = both = truly = 0
    for y in [0, 1] * 60:
        text, labels = mixed(rng, y)
        got = Q.viterbi(np.asarray(crf.weights)[Q.analyse(text)[2]].sum(axis=1), crf)
        right, of = right + sum(a == b for a, b in zip(got, labels)), of + len(labels)
        both, truly = both + (len(set(got)) == 2), truly + (len(set(labels)) == 2)
    assert right >= 0.9 * of and truly > 30 and both >= 0.9 * truly


def test_share_path_meets_the_label():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = int(rng.integers(1, 12))
        scores, words = rng.normal(size=n) * 3, rng.integers(1, 9, n)
        crf = Q.Crf(start=rng.normal(), pairs=tuple(map(tuple, rng.normal(size=(2, 2)))))
        for y in (0, 1):
            share = words[Q.share_path(scores, words, crf, y) == 1].sum() / words.sum()
            assert (share >= 0.5) == bool(y)
        free = np.array(Q.viterbi(scores, crf))
        assert (Q.share_path(scores, words, crf, int(words[free == 1].sum() * 2 >= words.sum())) == free).all()


def test_very_long_text_and_reserved_name(spark):
    long = "some words here again and more of them " * 50_000 + "\n" + "x\n" * 100_000
    assert Q.analyse(long)[0] == {**Q.analyse(long)[0], "n_words": 500_000 - 100_000 + 100_000, "n_dup_lines": 99_999}
    with pytest.raises(ValueError):
        Q.score(spark.createDataFrame([(1, "a", 2)], "doc_id long, text string, __quality int"), Q.Crf())
