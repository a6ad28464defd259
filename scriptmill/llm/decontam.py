"""Benchmark decontamination by template canonicalisation.

Texts become token sequences in which numbers, units and names are typed
placeholders (``<num> <unit> <name>``), everything else its lower-cased word.
A benchmark item's windows of ``window`` canonical tokens (the whole item if it
is shorter) are hash-joined with the windows of all documents.  Matches are
gathered per document, item and alignment (document place less item place);
their slot values must be consistent: within an alignment each item value maps
to the document value that most of its places have (two item values may share
one), windows that contradict this are dropped, and windows with equal values
always count.  So a question asked again with other numbers or names is found,
while windows that agree by accident in differently used slots are not.  A
document holds an item if the consistent rest of one alignment, or of a chain
of alignments in order (words put in, left out or counted otherwise between
them, at most an item's length at a time), covers at least ``min_coverage`` of
the item's windows, or if that of one alignment covers ``min_run`` tokens without
a gap.

Canonical form.  A number starts with a digit or is a number word, with the
number words after it; a unit is a
unit word next to a number; a name is a capitalised word, and neighbouring
names are one slot.  Whether a capitalised word that begins a sentence is a name
cannot be told, so texts are read both ways: such words all plain, or all names;
a window matches in either reading.  A window needs at least ``min_literals``
plain words, so that placeholders alone match nothing.

Plan.  The texts of an Arrow batch are tokenised together as one array of code
points, and their windows hashed as arrays; a window is kept if its hash is set in a bitmap of fixed size built from the benchmark (2 MB
however large the benchmark is), and only then written out; the survivors are
joined on the whole template text, so hash collisions do not matter.

Defined results: an empty table of either kind gives an empty result; null and
empty texts have no windows; a very long text is one array, about 100 bytes a
character while it is read; an item without a
usable window is found where all its tokens stand verbatim, one of fewer than
``min_literals`` tokens never; rows equal in doc_id and text are one document;
items that repeat an item_id are told apart by their text; ties between
alignments go to the larger coverage, then the smaller alignment, chains last; other
columns of the input are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.llm.common import doc_key, materialize

WINDOW = 8
MIN_LITERALS = 4
MIN_COVERAGE = 0.5
MIN_RUN = 24
BITMAP_BITS = 24

NUMBER_WORDS = frozenset("two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                         "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred "
                         "thousand million billion dozen".split())
UNITS = frozenset("% $ € £ ° m cm mm km mi ft inch inches mile miles meter meters metre metres kilometers kilometres feet "
                  "yard yards g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml "
                  "liter liters litre litres gallon gallons s ms sec second seconds min minute minutes h hour hours day "
                  "days week weeks month months year years mph kmh km/h usd eur dollar dollars cent cents euro euros "
                  "percent degree degrees celsius fahrenheit watt watts volt volts joule joules".split())

_KMH = "km/h"  # the one word that holds a sign
_NONE, _LETTER, _DIGIT, _END, _SIGN = range(5)  # classes of characters
_LITERAL, _NUMBER, _UNIT, _CAPITAL, _ENDER, _NUMBER_WORD, _ONE = range(7)
PLACEHOLDERS = ("", "<num>", "<unit>", "<name>")
_CODES = np.array([0] + [xxhash.xxh64_intdigest(p) for p in PLACEHOLDERS[1:]], dtype=np.uint64)
_BASE = np.uint64(xxhash.xxh64_intdigest("base") | 1)
_CHAR_BASE = np.uint64(xxhash.xxh64_intdigest("char") | 1)
#: texts are tokenised together up to this many characters; a longer one alone
SLICE_CHARS = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class _Words:
    """What tokens are told by: per character its class, case and the hash of its
    lower case; the hashes of number and unit words."""

    def __init__(self):
        every = "".join(map(chr, range(0x110000)))
        self.kind = np.zeros(len(every), dtype=np.uint8)
        self.upper, self.changes = np.zeros(len(every), dtype=bool), np.zeros(len(every), dtype=np.uint8)
        low = np.arange(len(every), dtype=np.uint64)
        for kind, pattern in ((_LETTER, r"[^\W\d_]+"), (_DIGIT, r"\d+"), (_END, r"[.!?:\n]"), (_SIGN, "[%$€£°]")):
            for m in re.finditer(pattern, every):
                self.kind[m.start():m.end()] = kind
        for c in np.flatnonzero(self.kind == _LETTER).tolist():
            x = every[c]
            small, self.upper[c] = x.lower(), x.isupper()
            if small != x:
                self.changes[c] = 1
                if len(small) == 1:
                    low[c] = ord(small)
        low[ord("ς")] = ord("σ")  # lower case of one letter by its place
        self.hashes = _mix(low + np.uint64(1))
        self.powers = np.ones(1, dtype=np.uint64)
        self.flag, self.special, self.classes = np.zeros(4096, dtype=bool), np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int8)
        words = {**dict.fromkeys(UNITS, _UNIT), "one": _ONE, **dict.fromkeys(NUMBER_WORDS, _NUMBER_WORD)}
        of = np.array([Tokens([w], self).codes[0] for w in words], dtype=np.uint64)
        order = np.argsort(of)
        self.special, self.classes = of[order], np.array(list(words.values()), dtype=np.int8)[order]
        self.flag[of >> np.uint64(52)] = True

    def power(self, n: int) -> np.ndarray:
        while len(self.powers) < n:
            self.powers = np.concatenate((self.powers, self.powers * self.powers[-1] * _CHAR_BASE))
        return self.powers


class Tokens:
    """The tokens of several texts, found together: words of letters, numbers with
    their inner signs, single signs, sentence ends.  Token ``i`` lies in text
    ``doc[i]``; ``codes`` are hashes of the lower-cased tokens."""

    def __init__(self, texts: list[str | None], words: _Words):
        self.text = "\0".join(t or "" for t in texts)
        c = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = words.kind[c]
        point = np.flatnonzero((c[1:-1] == ord(".")) | (c[1:-1] == ord(","))) + 1
        kind[point[(kind[point - 1] == _DIGIT) & (kind[point + 1] == _DIGIT)]] = _DIGIT
        cut = set()  # where a token begins though its class goes on
        for i in np.flatnonzero(c == ord("/")).tolist():
            at = i - 2
            if at >= 0 and self.text.startswith(_KMH, at) and (not at or kind[at - 1] != _LETTER or at in cut):
                kind[i] = _LETTER
                cut.add(at + len(_KMH))
        held = kind > 0
        begins = held.copy()
        begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] >= _END)
        forced = [i for i in cut if i < len(c)]
        begins[forced] = held[forced]
        ends = held.copy()
        ends[:-1] &= begins[1:] | ~held[1:]
        self.start, self.stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        size = np.fromiter((len(t or "") for t in texts), dtype=np.int64, count=len(texts))
        doc_start = np.cumsum(size + 1) - size - 1
        self.doc = np.searchsorted(doc_start, self.start, "right") - 1
        self.doc_end = np.searchsorted(self.start, doc_start + size)  # the token behind each text's last one
        self.kinds, self.codes = np.zeros(0, dtype=np.int8), np.zeros(0, dtype=np.uint64)
        if not len(self.start):
            return
        length = self.stop - self.start
        head = np.cumsum(length) - length
        within = np.arange(head[-1] + length[-1]) - np.repeat(head, length)
        chars = c[held]
        self.codes = _mix(np.add.reduceat(words.hashes[chars] * words.power(int(length.max()))[within], head))
        first = c[self.start]
        other = np.add.reduceat(words.changes[chars], head, dtype=np.int64) - words.changes[first]
        kinds = np.where(words.upper[first] & (other == 0), _CAPITAL, _LITERAL).astype(np.int8)
        maybe = np.flatnonzero(words.flag[self.codes >> np.uint64(52)])
        if len(maybe):
            found = np.searchsorted(words.special, self.codes[maybe]) % len(words.special)
            same = words.special[found] == self.codes[maybe]
            kinds[maybe[same]] = words.classes[found[same]]
        kinds[kind[self.start] == _DIGIT] = _NUMBER
        kinds[kind[self.start] == _END] = _ENDER
        self.kinds = kinds

    def __len__(self) -> int:
        return len(self.start)

    def __getitem__(self, i: int) -> str:
        return self.text[self.start[i]:self.stop[i]]


@dataclass
class Reading:
    """A canonical form of texts.  ``at`` numbers the tokens of each text as in the
    literal reading, so places in both readings compare."""

    tokens: Tokens
    first: np.ndarray  # first token of each canonical token, and the end
    kinds: np.ndarray
    codes: np.ndarray
    at: np.ndarray
    doc: np.ndarray
    changed: np.ndarray | None = None  # tokens read otherwise than in the literal reading


def _within(doc: np.ndarray) -> np.ndarray:
    """The number of each element among those of its text (texts in order)."""
    return np.arange(len(doc)) - np.searchsorted(doc, doc)


def readings(tokens: Tokens) -> list[Reading]:
    """The literal reading, in which a capitalised word that begins a sentence is
    a plain word, and, if there is such a word, the one in which it is a name."""
    kinds, codes, doc = tokens.kinds, tokens.codes, tokens.doc
    ender = kinds == _ENDER
    begins = np.ones(len(kinds), dtype=bool)  # of a sentence
    begins[1:] = ender[:-1] | (doc[1:] != doc[:-1])
    place = np.flatnonzero(~ender)
    kinds, codes, begins, doc = kinds[place], codes[place], begins[place], doc[place]
    follows = (np.diff(place) == 1) & (doc[1:] == doc[:-1])
    # number words after a number belong to it; "one" is a number only beside a number word
    word, one = kinds == _NUMBER_WORD, kinds == _ONE
    near = np.zeros(len(kinds), dtype=bool)
    near[1:] |= word[:-1] & follows
    near[:-1] |= word[1:] & follows
    word |= one & near
    kinds = np.where(word, _NUMBER, np.where(one, _LITERAL, kinds))
    joined = np.zeros(len(kinds), dtype=bool)
    joined[1:] = word[1:] & (kinds[:-1] == _NUMBER) & follows
    # a unit word counts as one only beside a number of its own sentence
    number = kinds == _NUMBER
    beside = np.zeros(len(kinds), dtype=bool)
    beside[1:] |= number[:-1] & ~begins[1:]
    beside[:-1] |= number[1:] & ~begins[1:]
    kinds = np.where((kinds == _UNIT) & ~beside, _LITERAL, kinds)
    initial = (kinds == _CAPITAL) & begins

    def read(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        name = kinds == _CAPITAL
        head = ~joined
        head[1:] &= ~(name[1:] & name[:-1] & follows)
        kinds = kinds[head]
        return np.append(place[head], len(tokens)), kinds, np.where(kinds == _LITERAL, codes[head], _CODES[kinds]), np.flatnonzero(head)

    first, plain, plain_codes, heads = read(np.where(initial, _LITERAL, kinds))
    number_of = _within(doc[heads])
    out = [Reading(tokens, first, plain, plain_codes, number_of, doc[heads])]
    if initial.any():
        first, named, named_codes, at = read(kinds)
        out.append(Reading(tokens, first, named, named_codes, number_of[np.searchsorted(heads, at)], doc[at], initial[at]))
    return out


def verbatim(tokens: Tokens) -> Reading:
    """The reading in which every token is a plain word."""
    place = np.flatnonzero(tokens.kinds != _ENDER)
    doc = tokens.doc[place]
    return Reading(tokens, np.append(place, len(tokens)), np.zeros(len(place), dtype=np.int8), tokens.codes[place], _within(doc), doc)


def canonical(text: str | None, words: _Words) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray]:
    """The literal reading: tokens, first token of each canonical token (and the end), its kind and its code."""
    r = readings(Tokens([text], words))[0]
    return r.tokens, r.first, r.kinds, r.codes


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hash of every window of ``size`` canonical tokens."""
    n = len(codes) - size + 1
    out = np.full(max(n, 0), size, dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        out = out * _BASE + codes[k:k + n]
    return out ^ (out >> np.uint64(29))


def _windows(r: Reading, size: int, min_literals: int, wanted=None) -> Iterator[tuple]:
    """(text, place, size, hash, template, slots) of the usable windows of a reading."""
    hashes = window_hashes(r.codes, size)
    if not len(hashes):
        return
    sums = lambda flags: (lambda c: c[size:] - c[:-size])(np.concatenate(([0], np.cumsum(flags))))
    ok = r.doc[:len(hashes)] == r.doc[size - 1:]
    if wanted is not None:
        ok &= wanted(hashes)
    if not ok.any():
        return
    ok &= sums(r.kinds == _LITERAL) >= min_literals
    if r.changed is not None:
        ok &= sums(r.changed) > 0  # the others are windows of the literal reading
    tokens, first, kinds = r.tokens, r.first, r.kinds
    for p in np.flatnonzero(ok).tolist():
        doc = int(r.doc[p])
        template, slots = [], []
        for i in range(p, p + size):
            if kinds[i] == _LITERAL:
                template.append(tokens[first[i]].lower())
            else:
                template.append(PLACEHOLDERS[kinds[i]])
                end, last = first[i] + 1, min(first[i + 1], tokens.doc_end[doc])
                while kinds[i] in (_CAPITAL, _NUMBER) and end < last and tokens.kinds[end] != _ENDER:
                    end += 1
                slots.append({"type": PLACEHOLDERS[kinds[i]], "value": " ".join(tokens[t] for t in range(first[i], end)).lower(), "at": int(r.at[i])})
        yield doc, int(r.at[p]), size, int(hashes[p].view(np.int64)), " ".join(template), slots


def windows(text: str | None, words: _Words, sizes: list[int], min_literals: int, wanted=None) -> list[tuple]:
    """(place, size, hash, template, slots) of the usable windows of both readings
    whose hash is ``wanted`` (all if None); slots: type, value and place of each placeholder."""
    return [w[1:] for r in readings(Tokens([text], words)) for size in sizes for w in _windows(r, size, min_literals, wanted)]


def slices(texts: list[str | None]) -> Iterator[tuple[int, list[str | None]]]:
    """The texts in runs of bounded size, each with the number of its first."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield start, texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield start, texts[start:]


@functools.cache
def _words() -> _Words:
    """Built once per Python worker."""
    return _Words()


SLOTS = "array<struct<type:string,value:string,at:int>>"
HITS = ["item_at", "doc_at", "item_slots", "doc_slots", "size"]
VERBATIM = "="  # marks the templates of the verbatim reading; no token holds it


PAIRS = "array<struct<item_slots:struct<type:string,value:string>,doc_slots:struct<type:string,value:string>>>"


def _pairs(hit: tuple) -> list[tuple]:
    """(type, item value, document value, item place, document place) of a hit's slots."""
    return [(a["type"], a["value"], b["value"], a["at"], b["at"]) for a, b in zip(hit[2], hit[3], strict=True)]


def _points(hits: list[tuple]) -> dict[tuple[int, int], list[tuple]]:
    """Slot pairs by (item place, document place): of both readings the one
    with fewer slots, as the other calls equal words a name."""
    out: dict[tuple[int, int], list[tuple]] = {}
    for hit in hits:
        at, pairs = (hit[0], hit[1]), sorted(_pairs(hit))
        if at not in out or (len(pairs), pairs) < (len(out[at]), out[at]):
            out[at] = pairs
    return out


def consistent_part(points: dict[tuple[int, int], list[tuple]]) -> dict[tuple[int, int], list[tuple]]:
    """The windows whose slots agree with the majority: per item value the document
    value most of its places have (none on a tie).  Windows with equal values always agree."""
    votes: dict[tuple, Counter] = {}
    for type_, a, b, *_ in {p for pairs in points.values() for p in pairs}:  # each place once
        votes.setdefault((type_, a), Counter())[b] += 1
    chosen = {}
    for key, counts in votes.items():
        (value, n), *rest = counts.most_common(2)
        if not rest or rest[0][1] < n:
            chosen[key] = value
    return {at: pairs for at, pairs in points.items()
            if all(p[1] == p[2] for p in pairs) or all(chosen.get(p[:2]) == p[2] for p in pairs)}


def longest_run(places: list[int], size: int) -> int:
    """Tokens of the longest stretch that windows of one shift cover without a gap."""
    best = start = last = 0
    for n, i in enumerate(sorted(places)):
        if not n or i - last > size:
            start = i
        last = i
        best = max(best, last - start + size)
    return best


def chains(points: Iterable[tuple[int, int]], reach: int) -> Iterator[list[tuple[int, int]]]:
    """Disjoint chains of (item place, document place), longest first, that rise in
    both; between neighbours the shift changes by ``reach`` at most, and as little as can be."""
    order = sorted(points, key=lambda p: (p[1], p[0]))
    i, d = (np.array(x, dtype=np.int64) for x in zip(*order, strict=True))
    one = np.int64(1) << np.int64(32)  # a point outweighs any sum of changes
    value, back = np.full(len(order), one), np.full(len(order), -1)
    low = np.searchsorted(d, d - 2 * reach)  # item places differ by less than ``reach``
    for j in range(len(order)):
        at = slice(low[j], j)
        change = np.abs((d[j] - d[at]) - (i[j] - i[at]))
        may = np.flatnonzero((i[at] < i[j]) & (d[at] < d[j]) & (change <= reach))
        if len(may):
            gain = value[at][may] - change[may]
            k = int(gain.argmax())
            value[j], back[j] = gain[k] + one, low[j] + may[k]
    used = np.zeros(len(order), dtype=bool)
    for j in np.argsort(-value, kind="stable").tolist():
        out = []
        while j >= 0 and not used[j]:
            used[j] = True
            out.append(order[j])
            j = back[j]
        if out:
            yield out


def best_alignment(hits: list[tuple], n_windows: int, min_coverage: float, min_run: int | None = None) -> tuple[int, list[dict]] | None:
    """Windows matched by, and pairs of values of, the best alignment of a
    document and an item: of one shift or, if ``min_run`` is given, a chain of shifts."""
    points, size = _points(hits), max(h[4] for h in hits)
    by_shift: dict[int, list[tuple[int, int]]] = {}
    for i, d in points:
        by_shift.setdefault(d - i, []).append((i, d))
    best = None

    def weigh(places: list[tuple[int, int]], run: int | None) -> None:
        nonlocal best
        part = consistent_part({at: points[at] for at in places})
        matched = len(part)
        enough = matched / n_windows >= min_coverage or (run is not None and longest_run([i for i, _ in part], size) >= run)
        if part and enough and (best is None or matched > best[0]):
            pairs = sorted({p[:3] for ps in part.values() for p in ps})
            best = matched, [{"item_slots": {"type": t, "value": a}, "doc_slots": {"type": t, "value": b}} for t, a, b in pairs]

    for _, places in sorted(by_shift.items()):
        weigh(places, min_run)
    if min_run is not None and len(by_shift) > 1 and len({i for i, _ in points}) >= min_coverage * n_windows:
        for places in chains(points, n_windows + size):
            if len(places) >= min_coverage * n_windows:
                weigh(places, None)
    return best


def item_windows(benchmark: DataFrame, window: int, min_literals: int) -> DataFrame:
    """``item, item_id, item_at, size, hash, template, item_slots, n_windows, whole`` of every usable
    item window; an item without one gives its verbatim windows (``whole``)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for item, item_id, text in zip(pdf["item"], pdf["item_id"], pdf["text"], strict=True):
                tokens = Tokens([text], _words())
                found = [w for r in readings(tokens) if (size := min(window, len(r.kinds))) >= min_literals
                         for w in _windows(r, size, min_literals)]
                whole = not found
                if whole and (size := min(window, len((r := verbatim(tokens)).kinds))) >= min_literals:
                    found = [(of, at, n, h, VERBATIM + template, slots) for of, at, n, h, template, slots in _windows(r, size, 0)]
                places = len({at for _, at, *_ in found})
                out += [(item, item_id, at, n, h, template, slots, places, whole) for _, at, n, h, template, slots in found]
            yield pd.DataFrame(out, columns=["item", "item_id", "item_at", "size", "hash", "template", "item_slots", "n_windows", "whole"]
                               ).astype({"item_id": "Int64"})

    return (benchmark.filter("text is not null").select(F.xxhash64("item_id", "text").alias("item"),
                                                        F.col("item_id").cast("long").alias("item_id"), "text")
            .dropDuplicates(["item"])
            .mapInPandas(run, f"item long, item_id long, item_at int, size int, hash long, template string, "
                              f"item_slots {SLOTS}, n_windows int, whole boolean"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_literals: int = MIN_LITERALS,
                  min_coverage: float = MIN_COVERAGE, min_run: int = MIN_RUN) -> DataFrame:
    """One row per document and benchmark item it holds: ``doc`` (key), ``doc_id,
    item_id, n_matched, n_windows, coverage, reparameterised, slots`` (the pairs of values)."""
    spark = docs.sparkSession
    items = materialize(item_windows(benchmark, window, min_literals), "items")
    seen = items.select("whole", "size").distinct().collect()  # at most 2 * ``window``
    sizes, whole_sizes = (sorted(r["size"] for r in seen if r["whole"] == w) for w in (False, True))
    bit = F.expr(f"shiftrightunsigned(hash, {64 - BITMAP_BITS})")
    cells = (items.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).collect())  # at most 2^(BITMAP_BITS-6)
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    for r in cells:
        bitmap[r["cell"]] = r["bits"] & 0xFFFFFFFFFFFFFFFF
    shared = spark.sparkContext.broadcast(bitmap)

    def wanted(hashes: np.ndarray) -> np.ndarray:
        b = hashes >> np.uint64(64 - BITMAP_BITS)
        return (shared.value[(b >> np.uint64(6)).astype(np.int64)] >> (b & np.uint64(63))) & np.uint64(1) == 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out, of = [], list(zip(pdf["doc_id"], pdf["a"], pdf["b"], strict=True))
            for start, texts in slices(pdf["text"].tolist()):
                tokens = Tokens(texts, _words())
                out += [(*of[start + i], at, template, slots) for r in readings(tokens) for size in sizes
                        for i, at, _, _, template, slots in _windows(r, size, min_literals, wanted)]
                if whole_sizes:
                    r = verbatim(tokens)
                    out += [(*of[start + i], at, VERBATIM + template, slots) for size in whole_sizes
                            for i, at, _, _, template, slots in _windows(r, size, 0, wanted)]
            yield pd.DataFrame(out, columns=["doc_id", "a", "b", "doc_at", "template", "doc_slots"]).astype({"doc_id": "Int64"})

    key = doc_key()
    found = (docs.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), key["a"].alias("a"), key["b"].alias("b"), "text")
             .mapInPandas(run, f"doc_id long, a long, b long, doc_at int, template string, doc_slots {SLOTS}"))
    group = ["doc_id", "a", "b", "item", "item_id", "whole", "n_windows"]

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for *of, hits in zip(*(pdf[c] for c in [*group, "hits"]), strict=True):
                best = best_alignment([tuple(h[c] for c in HITS) for h in hits], of[-1], *((1.0,) if of[-2] else (min_coverage, min_run)))
                if best:
                    out.append((*of, *best))
            yield pd.DataFrame(out, columns=[*group, "n_matched", "slots"]).astype({"doc_id": "Int64", "item_id": "Int64"})

    held = (found.join(items.drop("hash"), "template").groupBy(*group)
            .agg(F.collect_list(F.struct(*HITS)).alias("hits"))  # by document and item: bounded by their windows
            .mapInPandas(judge, f"doc_id long, a long, b long, item long, item_id long, whole boolean, n_windows int, n_matched long, slots {PAIRS}"))
    return held.select(F.struct(F.col("doc_id").alias("id"), "a", "b").alias("doc"), "doc_id", "item_id", "n_matched",
                       F.col("n_windows").cast("long").alias("n_windows"), (F.col("n_matched") / F.col("n_windows")).alias("coverage"),
                       F.exists("slots", lambda p: p["item_slots"]["value"] != p["doc_slots"]["value"]).alias("reparameterised"),
                       "slots")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    held = materialize(contamination(docs, benchmark).select(F.col("doc").alias("__doc")).distinct(), "held")
    return docs.withColumn("__key", doc_key()).join(held, F.col("__key") == F.col("__doc"), "left_anti").drop("__key")
