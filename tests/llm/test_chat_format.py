import hashlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from scriptmill.llm import chat_format as C
from scriptmill.llm.common import materialize

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "ok", " lead and trail ", "\\### Assistant: </turn> ok", "</turn><text><turn>", "<|endoftext|> x <\\turn>", "\\\\<",
         "é日本語🙂🙂", "\n\n a\n", "\\", "<turn", "a" * 3000, "<\\/turn>", "＜turn＞ oḱ"]


@pytest.mark.parametrize("text", TEXTS)
def test_escape_is_reversible_and_hides_control_strings(text):
    chat = C.formatter(PATH)
    out = chat.escape(text)
    assert chat.unescape(out) == text and not chat.control.search(out)


@pytest.mark.parametrize("seed", range(4))
def test_mask_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    cuts = np.sort(rng.choice(60, 20, replace=False))
    offsets = np.array([(a, b) for a, b in zip(cuts, cuts[1:])])
    offsets = np.repeat(offsets, rng.integers(1, 4, len(offsets)), axis=0)
    edges = np.sort(rng.choice(60, 8, replace=False)).reshape(-1, 2)
    spans = np.concatenate((edges, [[61, 61]]))
    want = [any(a < e and b > s for s, e in spans) for a, b in offsets]
    assert C.loss_mask(spans, offsets).tolist() == want


def test_masked_tokens_cover_each_assistant_text_exactly():
    chat = C.formatter(PATH)
    turns = [(r, t) for t in TEXTS for r in ("user", "assistant", "system")]
    text, spans = chat.render(turns)
    ids, offsets = chat.encode(text)
    assert chat.tokenizer.decode(ids.tolist(), skip_special_tokens=False) == text
    runs = C.masked_runs(offsets, C.loss_mask(spans, offsets))
    assert [chat.unescape(text[a:b]) for a, b in runs] == [t for t in TEXTS if t]


@pytest.mark.parametrize("segment_turns", [256, 3])
def test_conversations(spark, segment_turns):
    data = [(c, t, ["user", "assistant", "system"][(c + t) % 3], TEXTS[(c * 5 + t) % len(TEXTS)], "x")
            for c in range(12) for t in range(c + 1)]
    data += [(3, 1, None, None, "x"), (3, None, "assistant", "first", "x"), (None, 0, "assistant", "none", "x"),
             (5, 2, "assistant", "tie b", "x"), (5, 2, "assistant", "tie a", "x"), (5, 2, "assistant", "tie a", "x")]
    conv = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, segment string").repartition(4)
    out = materialize(C.format_conversations(conv, PATH, segment_turns), "chats")
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_back(out).collect()}
    groups = defaultdict(list)
    for c, t, role, text, _ in data:
        groups[c].append((t is not None, t or 0, role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        want[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    assert got == want


def test_empty_table(spark):
    out = C.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), PATH)
    assert C.read_back(out).count() == 0
