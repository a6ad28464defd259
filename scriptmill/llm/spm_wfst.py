"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The model file compiles into three machines.  The normaliser maps a text to
its escaped form (a leading mark, spaces to marks).  The piece machine reads
characters and writes pieces; a state is the piece written last, and there is
an arc for piece t after piece s only if the model's merges keep the two apart
(merging ``s + t`` as one string gives back s and t).  The byte machine writes
one byte piece per UTF-8 byte of a character that is no piece.

Merges only depend on what they join and where, so a sequence of pieces is the
model's own segmentation exactly if all neighbouring pairs are kept apart:
pairs carry weight 0 or infinity, and the composition with an input has one
path of finite weight.  The tropical shortest path so gives the same ids as
the library, for a merge (BPE) model whose piece scores alone would not: their
sum is not what merging minimises.  Every prefix of an input has one finite
path too, so the search holds one state per position: the arc of finite weight
that enters it.  In a unigram model the weights are the pieces' own, and the
search keeps the cheapest arc into each position.  Other model types raise.

Machines are composed lazily: arcs are weighed when an input first needs them.
No piece holds a mark after another character (checked at compile time), nor a
full stop or comma after most letters, so the shortest path of a text is those
of its words one after the other.  Each distinct word is composed once per
worker, in a cache of bounded size; words are taken in sorted order, and since
the arc into a position depends on the characters before it alone, a word goes
on where the one before it differs.

Decoding concatenates pieces, byte pieces as UTF-8 with U+FFFD for each bad
byte, marks as spaces, and drops the leading one.

Defined results: an empty table gives an empty result; columns named ``__ids``,
``__decoded`` or ``__both`` raise; a very long text is composed word by word;
null text counts as empty; an empty text has no ids and
decodes to the empty string; unknown characters become bytes, so decoding
returns the normalised text exactly; control pieces written in a text are
plain characters; rows that repeat a doc_id are encoded one by one.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import reserve

MARK = "▁"
#: words kept by a worker, in two generations of this size
CACHE_WORDS = 300_000
CACHE_PAIRS = 150_000
SLICE_CHARS = 1 << 20
UNIGRAM, MERGES = 1, 2  # model types of the file format
START = (1 << 21) - 1  # stands before a word's first piece; codes are smaller


def _fields(blob: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = blob[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(blob):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, blob[at:at + size]
        at += size


class Transducer:
    """The compiled machines of one model file."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        proto = dict(_fields(sp.serialized_model_proto()))
        trained = dict(_fields(proto.get(2, b""))).get(3, UNIGRAM)  # proto default
        if trained not in (UNIGRAM, MERGES):
            raise ValueError("only merge (BPE) and unigram models are compiled")
        self.additive = trained == UNIGRAM
        spec = dict(_fields(proto.get(3, b"")))
        if spec.get(2):
            raise ValueError("the model's normaliser maps characters; only the identity is compiled")
        # proto defaults: add_dummy_prefix, remove_extra_whitespaces and escape_whitespaces are true
        self.add_prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        if not spec.get(5, 1):
            raise ValueError("the model does not escape spaces")
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.id_byte = {i: b for b, i in self.byte_id.items()}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.piece_id = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.unknown = sp.unk_id()
        # characters that are no piece are numbered behind the pieces
        self.size = [len(p) for p in self.pieces]
        self.four = [i.to_bytes(4, "little") for i in range(n)]
        self.cost = [-self.score[p] if p in self.score else 0.0 for p in self.pieces]
        self.unknown_cost = 10.0 - min(self.score.values())
        self.backward = self._trie()
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.piece_id):
            raise ValueError("a piece holds a mark after another character")
        # letters after which no piece goes on with a full stop or comma: words can be cut there too
        joined = {m[0][0] for p in self.piece_id for m in re.finditer(r"(?=[a-z][.,])..", p)}
        loose = "".join(sorted(set("abcdefghijklmnopqrstuvwxyz") - joined))
        cut = rf"{MARK}*[^{MARK}.,]*[{loose}](?=[.,])|" if loose else ""
        self.words = re.compile(rf"{cut}{MARK}*[^{MARK}]+|{MARK}+", re.S)
        self.apart: dict[int, bool] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for i, x in self.id_byte.items():
            raw[i] = bytes([x])
        self.raw = raw

    # -- the machines

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.add_prefix else "") + text.replace(" ", MARK)

    def merge(self, text: str) -> list[str]:
        """The model's merges on a short string: best score first, leftmost on ties."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _trie(self) -> dict:
        """The pieces read backwards: character -> (piece that ends the walk or -1, what may stand before)."""
        grown: dict = {}
        for piece, i in self.piece_id.items():
            at = grown
            for c in reversed(piece):
                at = at.setdefault(c, {})
            at[""] = i
        leaf: dict = {}

        def close(node: dict) -> dict:  # as deep as the longest piece
            return {c: (kids.get("", -1), close(kids) if len(kids) > ("" in kids) else leaf) for c, kids in node.items() if c}

        return close(grown)

    def text_of(self, code: int) -> str:
        n = len(self.pieces)
        return self.pieces[code] if code < n else chr(code - n) if code < START else ""

    def kept_apart(self, last: int, code: int) -> bool:
        """Whether the arc that writes ``code`` after ``last`` (``START`` at the
        start) has weight 0: merging leaves the two as they are."""
        a, b = self.text_of(last), self.text_of(code)
        if len(self.apart) >= CACHE_PAIRS:
            self.apart.clear()
        kept = self.apart[last << 21 | code] = self.merge(a + b) == ([a, b] if a else [b])
        return kept

    def weight(self, last: str, piece: str) -> float:
        """Of the arc that writes ``piece`` after ``last`` ('' at the start)."""
        code = lambda x: self.piece_id.get(x, len(self.pieces) + ord(x[0])) if x else START
        return 0.0 if self.kept_apart(code(last), code(piece)) else np.inf

    def arcs(self, word: str, end: int) -> list[int]:
        """The arcs into position ``end``, shortest first: pieces, or the character itself if it is none."""
        kids, at, found = self.backward, end, []
        while at:
            hit = kids.get(word[at - 1])
            if hit is None:
                break
            at -= 1
            piece, kids = hit
            if piece >= 0:
                found.append(piece)
        if not found or self.size[found[0]] > 1:
            found.insert(0, len(self.pieces) + ord(word[end - 1]))  # bytes, joins nothing
        return found

    def extend(self, word: str, entered: list[int], done: int) -> None:
        """Fill ``entered`` (per position of ``word`` the code of the finite arc
        into it, -1 if there is none) beyond position ``done``."""
        del entered[done + 1:]
        backward, size, apart, n = self.backward, self.size, self.apart, len(self.pieces)
        for end in range(done + 1, len(word) + 1):
            kids, at, found = backward, end, []
            while at:
                hit = kids.get(word[at - 1])
                if hit is None:
                    break
                at -= 1
                piece, kids = hit
                if piece >= 0:
                    found.append(piece)
            if not found or size[found[0]] > 1:
                found.insert(0, n + ord(word[end - 1]))
            for code in reversed(found):
                last = entered[end - size[code] if code < n else end - 1]
                if last >= 0:
                    kept = apart.get(last << 21 | code)
                    if kept or (kept is None and self.kept_apart(last, code)):
                        break
            else:
                code = -1
            entered.append(code)

    def cheapest(self, word: str) -> list[int]:
        """The tropical shortest path where pieces have weights of their own
        (unigram models): ties go to the longest last piece."""
        best, entered, n = [0.0], [START], len(self.pieces)
        for end in range(1, len(word) + 1):
            total, chosen = np.inf, -1
            for code in reversed(self.arcs(word, end)):
                start, cost = (end - self.size[code], self.cost[code]) if code < n else (end - 1, self.unknown_cost)
                if best[start] + cost < total:
                    total, chosen = best[start] + cost, code
            best.append(total)
            entered.append(chosen)
        return entered

    def path(self, entered: list[int]) -> list[int]:
        out, at, n, size = [], len(entered) - 1, len(self.pieces), self.size
        while at:
            code = entered[at]
            out.append(code)
            at -= size[code] if code < n else 1
        return out[::-1]

    def shortest_path(self, word: str) -> list[str]:
        if self.additive:
            entered = self.cheapest(word)
        else:
            entered = [START]
            self.extend(word, entered, 0)
        return [self.text_of(code) for code in self.path(entered)]

    # -- ids

    def ids_of_path(self, entered: list[int]) -> bytes:
        n, four = len(self.pieces), self.four
        return b"".join([four[code] if code < n else b"".join([four[self.byte_id.get(b, self.unknown)] for b in chr(code - n).encode()])
                         for code in self.path(entered)])

    def learn(self, words: set[str]) -> None:
        """Compose words that the cache lacks."""
        entered, before = [START], ""
        for w in sorted(words):
            got = self.older.get(w)
            if got is None:
                if self.additive:
                    entered = self.cheapest(w)
                else:
                    same = 0
                    for a, b in zip(before, w):
                        if a != b:
                            break
                        same += 1
                    self.extend(w, entered, same)
                got = self.ids_of_path(entered)
                before = w
            self.recent[w] = got

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, little-endian unsigned 32 bit."""
        if len(self.recent) > CACHE_WORDS:
            self.older, self.recent = self.recent, {}
        split = [self.words.findall(self.normalise(t or "")) for t in texts]
        self.learn(set().union(*split) - self.recent.keys())
        get = self.recent.__getitem__
        return [b"".join(map(get, words)) for words in split]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        get = self.raw.__getitem__
        try:  # pieces are whole characters, so bytes that are valid all together are valid run by run
            text = b"".join(map(get, ids)).decode()
        except UnicodeDecodeError:
            out, held = [], bytearray()
            for i in [*ids, None]:
                if i in self.id_byte:
                    held += self.raw[i]
                    continue
                out.append(decode_bytes(bytes(held)))
                held.clear()
                if i is not None:
                    out.append(self.raw[i].decode())
            text = "".join(out)
        return text[1:] if self.add_prefix and text[:1] == " " else text


codecs.register_error("one_each", lambda e: ("\ufffd", e.start + 1))


def decode_bytes(raw: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that is not part of a character."""
    return raw.decode(errors="one_each")


_TRANSDUCERS: dict[str, Transducer] = {}  # per Python worker


def transducer(model: str) -> Transducer:
    if model not in _TRANSDUCERS:
        _TRANSDUCERS[model] = Transducer(model)
    return _TRANSDUCERS[model]


def _encoded(texts: pd.Series, t: Transducer) -> list[bytes]:
    """The ids of each text, in slices of bounded size."""
    out, held, size = [], [], 0
    for x in texts:
        held.append(x)
        size += len(x)
        if size >= SLICE_CHARS:
            out += t.encode_batch(held)
            held, size = [], 0
    return out + t.encode_batch(held)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Every column of ``docs`` plus ``__ids`` (little-endian unsigned 32 bit, binary)."""
    @F.pandas_udf("binary")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(_encoded(texts, transducer(model)), dtype=object)

    reserve(docs, "__ids")
    return docs.withColumn("__ids", run(F.coalesce("text", F.lit(""))))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """Every column of ``encoded`` plus ``__decoded``, the text that ``__ids`` stand for."""
    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        t = transducer(model)
        return pd.Series([t.decode(np.frombuffer(x, "<u4").tolist()) for x in ids], dtype=object)

    return encoded.withColumn("__decoded", run("__ids"))


def encode_and_decode(docs: DataFrame, model: str) -> DataFrame:
    """``encode`` and ``decode`` in one pass: both columns from one Python worker a task."""
    @F.pandas_udf("ids binary, decoded string")
    def run(texts: pd.Series) -> pd.DataFrame:
        t = transducer(model)
        ids = _encoded(texts, t)
        return pd.DataFrame({"ids": ids, "decoded": [t.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]})

    for name in ("__both", "__ids", "__decoded"):
        reserve(docs, name)
    return (docs.withColumn("__both", run(F.coalesce("text", F.lit(""))))
            .select(*docs.columns, F.col("__both.ids").alias("__ids"), F.col("__both.decoded").alias("__decoded")))


def round_trip() -> Column:
    """Whether ``__decoded`` is the text.  The one change of the normaliser that
    decoding cannot undo is a mark in the text, which reads as a space."""
    return F.col("__decoded") == F.replace(F.coalesce("text", F.lit("")), F.lit(MARK), F.lit(" "))
