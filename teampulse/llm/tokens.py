"""Ids of many texts under byte-level BPE, from the ids of their distinct pre-tokens.

The pre-tokens of a whole buffer are found at once from the classes of its
characters, by the rules of the byte-level pattern: contractions; runs of
letters, of numbers or of other characters, with a space before them if there is
one; white space, whose last character stays apart if something follows. Only
distinct pre-tokens go to a tokenizer, which treats each as it would inside its
text. They are found by 64-bit hashes and compared character by character.
"""

from __future__ import annotations

from itertools import chain

import numpy as np

from teampulse.llm import vec

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: Pre-tokens held by a worker, and characters of them, before it drops some: tens of MB, however long it lives.
CACHE_ENTRIES = 1 << 17
CACHE_CHARS = 1 << 21
_MARK = ord("'")


def character_classes() -> np.ndarray:
    """Class of every code point."""
    kept = vec.worker_cache("tokens")
    if "classes" not in kept:
        import regex

        every = "".join(map(chr, range(0xD800))) + "\0" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
        classes = np.zeros(0x110000, np.uint8)
        for label, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, every):
                classes[m.start() : m.end()] = label
        kept["classes"] = classes
        kept["codes"] = vec.seeded(0x110000, 23)
    return kept["classes"]


def pretoken_starts(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in code points of texts that begin at offsets (the last offset is the end)."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = character_classes()[points]
    begins, ends = np.zeros(n + 1, bool), np.zeros(n, bool)
    begins[offsets] = True
    ends[offsets[1:][offsets[1:] > 0] - 1] = True
    begins = begins[:n]
    turn = begins.copy()  # first character of a run of one class
    turn[1:] |= kind[1:] != kind[:-1]
    white = kind == SPACE
    joined = np.zeros(n, bool)  # the character before is a space of the same text
    joined[1:] = points[:-1] == 0x20
    joined &= ~begins
    last_white = np.zeros(n, bool)  # white, and something else follows in the text
    last_white[:-1] = white[:-1] & ~white[1:]
    last_white &= ~ends
    start = np.where(white, turn | last_white, turn & ~joined)
    # contractions: a lone mark that starts a pre-token, before letters
    at = np.flatnonzero((points[:-1] == _MARK) & start[:-1] & (kind[1:] == LETTER) & ~ends[:-1])
    if len(at):
        one = points[at + 1]
        two = np.where((at + 2 < n) & ~ends[at + 1], points[np.minimum(at + 2, n - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for a, b in ("re", "ve", "ll"):
            size = np.where((one == ord(a)) & (two == ord(b)), 2, size)
        at, size = at[size > 0], size[size > 0]
        start[at + 1] = False
        after = at + 1 + size
        start[after[after < n]] = True
    return np.flatnonzero(start)


class Memory:
    """Ids of pre-tokens by hash. `learn` maps a list of pre-tokens to (all their ids, the number of ids of each).

    A direct-mapped table answers most look-ups for a whole buffer at once; sorted arrays hold every entry. The
    characters of each entry are kept, and every pre-token is compared with those of the entry it got; one that shares
    another's hash is held by its text instead. Past `CACHE_ENTRIES` entries the older half stays, which has most of the
    frequent pre-tokens; past twice as many, or `CACHE_CHARS` characters, the memory starts anew. `added`: ids of the
    tokens that stand for themselves in a text, by their bytes.
    """

    SLOTS = 18

    def __init__(self, learn, added: dict[bytes, int] | None = None):
        import re

        self.learn, self.added = learn, added or {}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, longest_first))) if longest_first else None
        self.clear()

    def clear(self):
        self.hashes = np.zeros(0, np.uint64)  # ascending, and the entry of each
        self.numbers_of = np.zeros(0, np.int32)
        self.by_text: dict[str, int] = {}
        self.entries = 0
        self.chars = np.zeros(1 << 18, "<u4")
        self.char_place = np.zeros(1 << 14, np.int64)
        self.char_size = np.zeros(1 << 14, np.int64)
        self.chars_used = 0
        self.slot_hash = np.zeros(1 << self.SLOTS, np.uint64)
        self.slot_number = np.full(1 << self.SLOTS, -1, np.int32)
        self.flat = np.zeros(1 << 16, "<u4")
        self.place = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _forget(self):
        keep = CACHE_ENTRIES // 2
        if self.entries > 2 * CACHE_ENTRIES or self.chars_used > CACHE_CHARS:
            return self.clear()  # arrays grown by one long text go, too
        self.entries, self.used, self.chars_used = keep, int(self.place[keep]), int(self.char_place[keep])
        older = self.numbers_of < keep
        self.hashes, self.numbers_of = self.hashes[older], self.numbers_of[older]
        self.slot_number[self.slot_number >= keep] = -1
        self.by_text = {pretoken: i for pretoken, i in self.by_text.items() if i < keep}

    def _append(self, pretokens):
        """Numbers of new entries for these pre-tokens."""
        ids, sizes = self.learn(pretokens)
        have, count, more = self.entries, len(sizes), len(ids)
        letters = np.frombuffer("".join(pretokens).encode("utf-32-le"), "<u4")
        lengths = np.fromiter(map(len, pretokens), np.int64, count)
        while have + count > len(self.place):
            self.place, self.size, self.char_place, self.char_size = (
                np.append(x, np.zeros_like(x)) for x in (self.place, self.size, self.char_place, self.char_size))
        while self.used + more > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        while self.chars_used + len(letters) > len(self.chars):
            self.chars = np.append(self.chars, np.zeros_like(self.chars))
        self.flat[self.used : self.used + more] = ids
        self.size[have : have + count] = sizes
        self.place[have : have + count] = self.used + np.cumsum(sizes) - sizes
        self.chars[self.chars_used : self.chars_used + len(letters)] = letters
        self.char_size[have : have + count] = lengths
        self.char_place[have : have + count] = self.chars_used + np.cumsum(lengths) - lengths
        self.used += more
        self.chars_used += len(letters)
        self.entries += count
        return np.arange(have, have + count)

    def _others(self, number, points, start, stop) -> np.ndarray:
        """Places of the pre-tokens whose characters are not those of their entry."""
        lengths = stop - start
        wrong = lengths != self.char_size[number]
        some = np.flatnonzero(~wrong)
        n = lengths[some]
        ends = np.cumsum(n)
        step = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        differ = points[np.repeat(start[some], n) + step] != self.chars[np.repeat(self.char_place[number[some]], n) + step]
        if differ.any():
            wrong[some[np.unique(np.searchsorted(ends, np.flatnonzero(differ), "right"))]] = True
        return np.flatnonzero(wrong)

    def numbers(self, h, text, points, start, stop) -> np.ndarray:
        """Entry of each pre-token: h its hash, [start, stop) its place in text, whose code points are points."""
        number = self._by_hash(h, text, start, stop)
        for i in self._others(number, points, start, stop).tolist():
            pretoken = text[start[i] : stop[i]]
            if pretoken not in self.by_text:
                self.by_text[pretoken] = int(self._append([pretoken])[0])
            number[i] = self.by_text[pretoken]
        return number

    def _by_hash(self, h, text, start, stop) -> np.ndarray:
        if self.entries > CACHE_ENTRIES or self.chars_used > CACHE_CHARS:
            self._forget()
        slot = (h >> np.uint64(64 - self.SLOTS)).astype(np.int64)
        out = self.slot_number[slot]
        other = np.flatnonzero((self.slot_hash[slot] != h) | (out < 0))
        if len(other):
            unique, first, inverse = np.unique(h[other], return_index=True, return_inverse=True)
            place = np.searchsorted(self.hashes, unique)
            got = np.full(len(unique), -1, np.int64)
            held = np.flatnonzero(place < len(self.hashes))
            held = held[self.hashes[place[held]] == unique[held]]
            got[held] = self.numbers_of[place[held]]
            new = np.flatnonzero(got < 0)
            if len(new):
                at = other[first[new]]
                got[new] = self._append([text[a:b] for a, b in zip(start[at].tolist(), stop[at].tolist())])
                self.hashes = np.insert(self.hashes, place[new], unique[new])
                self.numbers_of = np.insert(self.numbers_of, place[new], got[new])
            out[other] = got[inverse]
            slot = (unique >> np.uint64(64 - self.SLOTS)).astype(np.int64)
            self.slot_hash[slot], self.slot_number[slot] = unique, got
            # two keys of one slot: make both arrays tell of the same one
            self.slot_number[slot[self.slot_hash[slot] != unique]] = -1
        return out


def byte_alphabet() -> np.ndarray:
    """The character ('<u4') that stands for each byte in a byte-level vocabulary: printable Latin-1 characters for
    themselves, the others in order from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = np.zeros(256, "<u4")
    out[own] = own
    rest = np.flatnonzero(out == 0)
    out[rest] = 0x100 + np.arange(len(rest))
    return out


def tokenizer_memory(path: str) -> Memory:
    """The worker's memory for a `tokenizers` file with byte-level BPE: its model is applied to each pre-token; the
    file's added tokens are taken whole wherever they stand in a text, as the tokenizer does."""
    kept = vec.worker_cache("tokens")
    if path not in kept:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        model, alphabet = tokenizer.model, byte_alphabet()
        added = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}

        def learn(pretokens):
            raw = [p.encode() for p in pretokens]
            ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))).tolist()
            text = alphabet[np.frombuffer(b"".join(raw), np.uint8)].tobytes().decode("utf-32-le")
            ids = [[t.id for t in model.tokenize(text[a:b])] for a, b in zip([0, *ends], ends)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter(chain.from_iterable(ids), "<u4", int(sizes.sum())), sizes

        kept[path] = Memory(learn, added)
    return kept[path]


def added_tokens(raw: bytes, offsets: np.ndarray, memory: Memory) -> list[tuple[int, int, int]]:
    """(start, end, id) of the added tokens in texts at byte offsets, from the left; none crosses texts."""
    out, at = [], 0
    while memory.pattern and (m := memory.pattern.search(raw, at)):
        end_of_text = int(offsets[np.searchsorted(offsets, m.start(), "right")])
        whole = m.end() <= end_of_text
        if whole:
            out.append((m.start(), m.end(), memory.added[m[0]]))
        at = m.end() if whole else m.start() + 1
    return out


def id_arrays(raw: bytes, offsets: np.ndarray, memory: Memory) -> tuple[np.ndarray, np.ndarray]:
    """(ids as '<u4', place of the first id of each text and the end) of UTF-8 texts at byte offsets."""
    text = raw.decode()
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    leads = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, out=leads[1:])
    special = np.array(added_tokens(raw, offsets, memory), np.int64).reshape(-1, 3)
    offsets, special[:, :2] = leads[offsets], leads[special[:, :2]]
    # the text before, between and after added tokens is split as texts of their own are
    start = pretoken_starts(points, np.unique(np.concatenate([offsets, special[:, 0], special[:, 1]])))
    if not len(start):
        return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
    if len(special):  # an added token is one pre-token
        token = np.searchsorted(special[:, 0], start, "right") - 1
        inside = (token >= 0) & (start > special[token, 0]) & (start < special[token, 1])
        start = start[~inside]
    stop = np.append(start[1:], len(points))
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(vec.worker_cache("tokens")["codes"][points] * vec.powers(len(points))[0][: len(points)], out=total[1:])
    number = memory.numbers(vec.span_hash(total, start, stop), text, points, start, stop)
    counts = memory.size[number]
    at = np.searchsorted(start, special[:, 0])
    counts[at] = 1
    ends = np.cumsum(counts)
    index = np.arange(ends[-1]) + np.repeat(memory.place[number] - (ends - counts), counts)
    ids = memory.flat[index]
    ids[ends[at] - 1] = special[:, 2]
    return ids, np.append(0, ends)[np.searchsorted(start, offsets)]
