"""Pre-tokenization of whole text batches as numpy arrays.

The tokenizer library spends most of its time merging the same words again and
again. Here a batch of texts becomes one array of code points; class changes
give the pre-token boundaries, a rolling hash gives each pre-token a key, and
only pre-tokens that a worker has not met reach the library's model. Character
classes are asked from the library itself, one code point at a time and once
per worker, so its Unicode tables decide.

Two boundary rules are known, both fixed by the public vocabulary files:
``byte`` (a leading space belongs to the next pre-token, whitespace is kept)
and ``word`` (whitespace is dropped, each digit stands alone).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from tokenizers import pre_tokenizers

LETTER, DIGIT, SPACE, OTHER = 1, 2, 3, 4
# The contractions that both public vocabularies split off.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MUL = np.uint64(0xD6E8FEB86659FD93)
_STEP = 0x5851F42D4C957F2D
_INV_STEP = pow(_STEP, -1, 1 << 64)

_classes = np.zeros(0x110000, np.uint8)
_probe = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def char_classes(cps: np.ndarray) -> np.ndarray:
    """Class of each code point; unseen ones are put to the library's own splitter."""
    found = _classes[cps]
    if not found.all():
        for cp in np.unique(cps[found == 0]).tolist():
            c = chr(cp)
            if len(_probe.pre_tokenize_str("a" + c)) == 1:
                kind = LETTER
            elif len(_probe.pre_tokenize_str("1" + c)) == 1:
                kind = DIGIT
            elif len(_probe.pre_tokenize_str("!" + c)) == 1:
                kind = OTHER
            else:
                kind = SPACE
            _classes[cp] = kind
        found = _classes[cps]
    return found


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        for k, base in enumerate((_STEP, _INV_STEP)):
            factors = np.full(n + 1, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of symbols[start:end] for every span, by prefix sums."""
    up, down = _powers_to(len(symbols))
    mixed = symbols.astype(np.uint64)
    mixed += np.uint64(1)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MUL
    mixed *= up[: len(symbols)]
    sums = np.empty(len(symbols) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(mixed, out=sums[1:])
    out = (sums[ends] - sums[starts]) * down[starts]
    out ^= out >> np.uint64(32)
    out *= _MUL
    return out + (ends - starts).astype(np.uint64)


@dataclass
class Distinct:
    """Distinct hashes of a batch: a span that has each, and each span's index."""

    sample: np.ndarray
    index: np.ndarray


def distinct(hashes: np.ndarray) -> Distinct:
    order = np.argsort(hashes)
    ordered = hashes[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    index = np.empty(len(ordered), np.int64)
    index[order] = np.cumsum(first) - 1
    return Distinct(order[first], index)


def boundaries(cps: np.ndarray, doc_ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of a batch of texts laid end to end.

    ``doc_ends`` has the end of each text; pre-tokens never cross it.
    """
    n = len(cps)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    cls = char_classes(cps)
    doc_first = np.zeros(n + 1, bool)
    doc_first[0] = True
    doc_first[doc_ends] = True
    prev = np.concatenate(([0], cls[:-1]))
    prev[doc_first[:n]] = 0
    start = np.zeros(n + 1, bool)
    start[n] = True
    space = cls == SPACE
    if rule == "byte":
        blank = np.zeros(n, bool)
        blank[1:] = cps[:-1] == 32
        blank &= prev != 0
        last = np.zeros(n, bool)  # of a whitespace run, with text after it
        last[:-1] = space[:-1] & ~space[1:] & ~doc_first[1:n]
        start[:n] = np.where(space, (prev != SPACE) | last, (prev != cls) & ~blank)
    else:
        start[:n] = (prev != cls) | (cls == DIGIT)
    marks = np.flatnonzero((cps == 39) & start[:n])
    marks = marks[marks + 1 < n]
    marks = marks[(cls[marks + 1] == LETTER) & ~doc_first[marks + 1]]
    if len(marks):
        stops = doc_ends[np.searchsorted(doc_ends, marks, side="right")]
        for at, stop in zip(marks.tolist(), stops.tolist()):
            tail = "".join(map(chr, cps[at + 1 : min(stop, at + 3)].tolist()))
            hit = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
            if hit:
                start[at + 1 : at + 1 + len(hit)] = False
                start[at + 1 + len(hit)] = True
    begins = np.flatnonzero(start)
    starts, ends = begins[:-1], begins[1:]
    if rule == "word":
        kept = ~space[starts]
        starts, ends = starts[kept], ends[kept]
    return starts, ends


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _byte_alphabet() -> dict[int, str]:
    """The public byte-to-letter rule: printable bytes stand for themselves, the
    others for the letters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


_ALPHABET = _byte_alphabet()


def as_letters(pretoken: str) -> str:
    """A pre-token as the vocabulary writes it: one letter for each UTF-8 byte."""
    return pretoken.encode("utf-8", "surrogatepass").decode("latin-1").translate(_ALPHABET)


class Memo:
    """Token ids of the pre-tokens met so far, by hash.

    At most ``limit`` pre-tokens (about 35 bytes each) are kept; beyond that the
    memo starts again, which costs time only.
    """

    def __init__(self, encode: Callable[[str], list[int]], limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.keys, self.slots = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def find(self, hashes: np.ndarray, string_of: Callable[[int], str]) -> np.ndarray:
        """Slots of distinct ``hashes``; ``string_of(k)`` is the pre-token of the k-th."""
        if len(self.keys) > self.limit:
            self.clear()
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == hashes[inside]
        slots = np.empty(len(hashes), np.int64)
        slots[known] = self.slots[at[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            found = [self.encode(string_of(k)) for k in fresh.tolist()]
            first = len(self.ends) - 1
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.ids = np.concatenate((self.ids, np.array([i for ids in found for i in ids], np.uint32)))
            self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(lengths)))
            slots[fresh] = first + np.arange(len(fresh))
            order = fresh[np.argsort(hashes[fresh])]
            spot = np.searchsorted(self.keys, hashes[order])
            self.keys = np.insert(self.keys, spot, hashes[order])
            self.slots = np.insert(self.slots, spot, slots[order])
        return slots


@dataclass
class Window:
    """Pre-tokens of some consecutive texts: their memo slots, text by text."""

    slots: np.ndarray
    doc_of: np.ndarray


def resolve(
    texts: list[str], rule: str, memo: Memo, prepare: Callable[[str], np.ndarray] = code_points,
    part: int = 1 << 20,
) -> Window:
    """Memo slots of all pre-tokens of ``texts``.

    Arrays as long as the text are made for about ``part`` code points at a
    time; distinct pre-tokens are sought over all ``texts`` together.
    """
    pieces, spans, docs = [], [], []
    batch, sizes, first = [], 0, 0
    for k, text in enumerate(texts):
        batch.append(prepare(text))
        sizes += len(batch[-1])
        if sizes >= part or k + 1 == len(texts):
            cps = np.concatenate(batch) if batch else np.empty(0, np.uint32)
            ends = np.cumsum([len(x) for x in batch])
            starts, stops = boundaries(cps, ends, rule)
            pieces.append(cps)
            spans.append((span_hashes(cps, starts, stops), starts, stops, np.full(len(starts), len(pieces) - 1)))
            docs.append(first + np.searchsorted(ends, starts, side="right"))
            batch, sizes, first = [], 0, k + 1
    if not spans:
        return Window(np.empty(0, np.int64), np.empty(0, np.int64))
    hashes, starts, stops, piece = (np.concatenate(x) for x in zip(*spans))
    d = distinct(hashes)

    def string_of(k: int) -> str:
        s = d.sample[k]
        return pieces[piece[s]][starts[s] : stops[s]].tobytes().decode("utf-32-le", "surrogatepass")

    slots = memo.find(hashes[d.sample], string_of)
    return Window(slots[d.index], np.concatenate(docs))
