"""Byte-level BPE with a remembered result per pre-token, equal to the library's output.

Pre-tokens are cut on arrays of character classes. Those of at most 15 bytes are their own keys, as two 64-bit numbers, in a hash table of
numpy arrays, which all pre-tokens of a block are looked up in at once; longer ones are remembered in a dictionary.
"""

from __future__ import annotations

import sys
from array import array

import numpy as np
import public_tokenizers
import regex

from .common import worker_cache

#: Pre-tokens that a dictionary remembers (about 200 bytes each), in two generations of half as many.
MAX_REMEMBERED = 500_000
#: Slots of a table of short pre-tokens (24 bytes each and their ids); at most half of them are taken.
SLOTS = 1 << 20
#: Longest pre-token of that table in bytes: two numbers of 8 bytes, the last of which is the length.
MAX_SHORT = 15
#: Characters that are cut at a time, about.
_CUT_CHARS = 1 << 18
#: Character classes: anything else, letter, number, other white space, the space.
_OTHER, _LETTER, _NUMBER, _WHITE, _SPACE = range(5)
_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
_APOSTROPHE = ord("'")


def default_tokenizer() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 stays, the rest moves past 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Ids(dict):
    """Pre-token to its ids, from the library's model, as little-endian uint32 bytes.

    The young generation is this dictionary; when it is full it becomes the old one, from which entries that
    are used again come back. So frequent pre-tokens stay.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model
        self.symbols = {b: c for c, b in byte_symbols().items()}
        self.old: dict[str, bytes] = {}

    def rotate(self) -> None:
        if len(self) > MAX_REMEMBERED // 2:
            self.old = dict(self)
            self.clear()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is not None:
            self[word] = ids
            return ids
        ids = self[word] = self.tokens(word.encode())
        return ids

    def tokens(self, word: bytes) -> bytes:
        """The ids of a pre-token, not remembered."""
        return array("I", [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.symbols))]).tobytes()


def char_classes() -> np.ndarray:
    """The class of each code point, as the pre-token pattern's library sees it."""
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, sys.maxunicode + 1))))
    out = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            a, b = (x if x < 0xD800 else x + 0x800 for x in m.span())
            out[a:b] = kind
    out[ord(" ")] = _SPACE
    return out


def pretoken_begins(code: np.ndarray, kind: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where ``public_tokenizers.PATTERN`` begins a match, in texts one after another that begin at ``begins`` (ascending, none empty)."""
    n = len(kind)
    white = kind >= _WHITE
    first = np.zeros(n + 1, bool)
    first[begins] = first[n] = True
    # a letter, number or other character begins a match unless it goes on with the one before or the space before is its first
    out = np.ones(n, bool)
    out[1:] = (kind[1:] != kind[:-1]) & (kind[:-1] != _SPACE)
    # white space: a run is one match, without its last character if something follows in the text
    after = np.ones(n, bool)
    after[1:] = ~white[:-1]
    stop = np.zeros(n, bool)
    stop[:-1] = ~white[1:]
    stop &= ~first[1:]
    out = np.where(white, after | stop, out)
    out |= first[:-1]
    # contractions, where the apostrophe is the first character of a match
    at = np.flatnonzero(code == _APOSTROPHE)
    at = at[out[at]]
    if len(at):
        text = np.concatenate((np.cumsum(first[:-1], dtype=np.int64), [-1, -1, -1]))
        padded = np.concatenate((code, np.zeros(3, code.dtype)))
        for x in _CONTRACTIONS:
            hit = text[at] == text[at + len(x)]
            for k, c in enumerate(x, 1):
                hit &= padded[at + k] == ord(c)
            here = at[hit]
            out[here + 1] = False
            end = here + len(x) + 1
            out[end[end < n]] |= ~white[end[end < n]]
    return np.flatnonzero(out)


def _short_keys(raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of each pre-token (at most MAX_SHORT) and their number as two 64-bit numbers: equal for equal pre-tokens only."""
    words = np.frombuffer(raw + bytes(-len(raw) % 8 + 24), "<u8")
    at, shift = begin >> 3, ((begin & 7) << 3).astype(np.uint64)
    x, y, z = words[at], words[at + 1], words[at + 2]
    up = np.uint64(63) - shift  # in two steps, because a shift by 64 isn't defined
    one, two = (x >> shift) | (y << up << np.uint64(1)), (y >> shift) | (z << up << np.uint64(1))
    return one & _KEEP[size, 0], (two & _KEEP[size, 1]) | (size.astype(np.uint64) << np.uint64(56))


_KEEP = np.array([[(1 << 8 * min(n, 8)) - 1, (1 << 8 * max(n - 8, 0)) - 1] for n in range(MAX_SHORT + 1)], np.uint64)


class _ShortIds:
    """Ids of short pre-tokens: a hash table with open addressing, asked for many keys at once. When it is full, the ones that
    were asked for again stay, if they are at most half of it."""

    def __init__(self, slots: int):
        self.slots = slots
        self.empty()

    def empty(self) -> None:
        self.one, self.two = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.uint64)  # a second number of 0: free
        self.value = np.zeros(self.slots, np.int64)  # 16 times the first place in the pool, and the number of ids
        self.again = np.zeros(self.slots, bool)
        self.pool, self.used, self.n = np.zeros(1 << 16, "<u4"), 0, 0

    def _slot(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        h = (one ^ (two * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return ((h >> np.uint64(32)) & np.uint64(self.slots - 1)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it isn't known."""
        slot = self._slot(one, two)
        there = self.two[slot]
        same = (there == two) & (self.one[slot] == one)
        out = np.where(same, self.value[slot], -1)
        self.again[slot[same]] = True
        left = np.flatnonzero(~same & (there != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & (self.slots - 1)
            at = slot[left]
            there = self.two[at]
            same = (there == two[left]) & (self.one[at] == one[left])
            out[left[same]] = self.value[at[same]]
            self.again[at[same]] = True
            left = left[~same & (there != 0)]
        return out

    def add(self, one: np.ndarray, two: np.ndarray, ids: list[bytes]) -> None:
        """Remembers distinct keys that aren't known."""
        if self.n + len(ids) > self.slots // 2:
            self._make_room(len(ids))
        count = np.array([len(x) // 4 for x in ids], np.int64)
        new = np.frombuffer(b"".join(ids), "<u4")
        self._put(one, two, count, new)

    def _put(self, one: np.ndarray, two: np.ndarray, count: np.ndarray, new: np.ndarray) -> None:
        if self.used + len(new) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.used], np.zeros(self.used + 2 * len(new), "<u4")))
        self.pool[self.used : self.used + len(new)] = new
        value = (self.used + np.cumsum(count) - count) * 16 + count
        self.used, self.n = self.used + len(new), self.n + len(one)
        slot, left = self._slot(one, two), np.arange(len(one))
        while len(left):
            at = slot[left]
            free = self.two[at] == 0
            here = left[free]
            self.one[at[free]], self.two[at[free]], self.value[at[free]] = one[here], two[here], value[here]
            # of several keys for one slot the last stays; the others go on
            left = left[(self.one[at] != one[left]) | (self.two[at] != two[left])]
            slot[left] = (slot[left] + 1) & (self.slots - 1)

    def _make_room(self, need: int) -> None:
        at = np.flatnonzero(self.again)
        if len(at) + need > self.slots // 4:
            at = at[: max(0, self.slots // 4 - need)]
        one, two, value, pool = self.one[at], self.two[at], self.value[at], self.pool
        while need + len(at) > self.slots // 2:
            self.slots *= 2
        self.empty()
        self._put(one, two, value & 15, pool[places(value >> 4, value & 15)])


def places(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each, one after another."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())


class IdEncoder:
    """Ids of texts. Special strings split a text first, the pre-token pattern splits the rest."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {k: np.array([v], "<u4").tobytes() for k, v in added.items()}
        self.split = regex.compile("(" + "|".join(regex.escape(x) for x in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.cut = regex.compile(r"(?<=\S) (?=\S)")
        self.known = _Ids(self.tokenizer)
        self.short = _ShortIds(SLOTS)
        self.kinds = char_classes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian uint32 bytes."""
        self.known.rotate()
        parts, owner = [], []
        out: list[list[bytes]] = [[] for _ in texts]
        for i, text in enumerate(texts):
            special = self.split is not None and self.split.search(text)
            for piece in self.split.split(text) if special else [text]:
                for part in self._portions(piece):
                    parts.append(part)
                    owner.append(i)
        size = 0
        a = 0
        for b, part in enumerate(parts):
            if size and size + len(part) > _CUT_CHARS:
                self._add(parts[a:b], owner[a:b], out)
                a, size = b, 0
            size += len(part)
        self._add(parts[a:], owner[a:], out)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _portions(self, text: str) -> list[str]:
        """A long text in parts of about _CUT_CHARS, cut before a single space between other characters, where a pre-token begins."""
        out, a = [], 0
        while len(text) - a > 2 * _CUT_CHARS:
            m = self.cut.search(text, a + _CUT_CHARS)
            if m is None:
                break
            out.append(text[a : m.start()])
            a = m.start()
        out.append(text[a:] if a else text)
        return out

    def _add(self, parts: list[str], owner: list[int], out: list[list[bytes]]) -> None:
        """Appends the ids of each part to its owner's."""
        plain = [i for i, x in enumerate(parts) if x and x not in self.special]
        ids = dict(zip(plain, self._ids([parts[i] for i in plain]))) if plain else {}
        for i, part in enumerate(parts):
            if part:
                out[owner[i]].append(ids[i] if i in ids else self.special[part])

    def _ids(self, parts: list[str]) -> list[bytes]:
        """The ids of each part (none empty or special)."""
        text = "".join(parts)
        raw = text.encode()
        code = np.frombuffer(text.encode("utf-32-le"), "<u4") if len(raw) > len(text) else np.frombuffer(raw, np.uint8)
        starts = np.concatenate(([0], np.cumsum([len(x) for x in parts])))
        begin = pretoken_begins(code, self.kinds[code], starts[:-1])
        first = np.searchsorted(begin, starts)  # of each part, the first pre-token
        if len(raw) > len(text):
            # UTF-8 bytes: characters begin where a byte isn't one that goes on
            begin = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)[begin]
        size = np.diff(np.append(begin, len(raw)))
        short = np.flatnonzero(size <= MAX_SHORT)
        one, two = _short_keys(raw, begin[short], size[short])
        value = self.short.find(one, two)
        pool = self.short.pool
        count = np.zeros(len(begin), np.int64)
        source = np.zeros(len(begin), np.int64)
        new = np.flatnonzero(value < 0)
        known, hit = np.delete(short, new), np.delete(value, new)
        count[known], source[known] = hit & 15, hit >> 4
        # the others, new short ones and long ones, one by one
        other = np.ones(len(begin), bool)
        other[known] = False
        own = [raw[a : a + n] for a, n in zip(begin[other].tolist(), size[other].tolist())]
        found = dict.fromkeys(own)
        for x in found:
            found[x] = self.known.tokens(x) if len(x) <= MAX_SHORT else self.known[x.decode()]
        if len(new):
            at = dict(zip((x for x in own if len(x) <= MAX_SHORT), new.tolist()))
            key = np.fromiter(at.values(), np.int64, len(at))
            self.short.add(one[key], two[key], [found[x] for x in at])
        told = [found[x] for x in own]
        count[other] = [len(x) // 4 for x in told]
        ids = pool.take(places(source, count), mode="clip")  # places of the others are filled next
        if told:
            ids[np.repeat(other, count)] = np.frombuffer(b"".join(told), "<u4")
        ends = np.concatenate(([0], np.cumsum(count)))[first].tolist()
        whole = ids.tobytes()
        return [whole[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]


def encoder(path: str) -> IdEncoder:
    """The worker's encoder for a tokenizer file."""
    cache = worker_cache("ids")
    if path not in cache:
        cache[path] = IdEncoder(path)
    return cache[path]
