"""Whole texts to token ids with the ``tokenizers`` library, fast: each distinct pre-token is encoded once.

A byte-level file splits a text into pre-tokens by classes of characters: runs of letters, of digits or of other signs,
each with a single space before it, and white space. The split is made here over whole buffers; a stretch between white
space whose characters' classes aren't known from their bytes stays one piece, which the library splits itself. Pieces of
up to 24 bytes are told apart by these bytes, longer ones by a dictionary; those that a worker has seen come from a
table, new ones are encoded together. A text with white space beyond ASCII, a zero byte or the name of a special token goes
to the library whole.
"""

from __future__ import annotations

import numpy as np

#: Pieces that a worker's table holds before it starts anew (bounds memory, changes no result).
MOST_PIECES = 600_000
SEPARATOR, SPACE, WHITE, LETTER, DIGIT, SIGN, UNKNOWN = range(7)
_CLASS = np.full(256, UNKNOWN, np.uint8)
_CLASS[33:127] = SIGN
for _from, _to, _kind in ((48, 58, DIGIT), (65, 91, LETTER), (97, 123, LETTER), (9, 14, WHITE), (32, 33, SPACE), (0, 1, SEPARATOR)):
    _CLASS[_from:_to] = _kind
_CLASS[ord("'")] = UNKNOWN  # contractions have a rule of their own
#: First bytes of two-byte letters (U+00C0 to U+017F, U+0400 to U+047F), but for the signs U+00D7 and U+00F7.
_LETTER_LEADS = np.zeros(256, bool)
_LETTER_LEADS[[0xC3, 0xC4, 0xC5, 0xD0, 0xD1]] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def spread(first: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes of ranges laid end to end: first[0], first[0] + 1, ..., first[1], ..."""
    ends = np.cumsum(lens)
    return np.repeat(first - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)


def classes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte, and places of bytes that make the library split a text in its own way."""
    kind = _CLASS[buf]
    high = np.flatnonzero(buf >= 0x80)
    if len(high):
        lead, after = buf[high], buf[np.minimum(high + 1, len(buf) - 1)]
        first = _LETTER_LEADS[lead]
        sign = (lead == 0xC3) & ((after == 0x97) | (after == 0xB7))
        for place, what in ((high[first], LETTER), (high[sign], SIGN)):
            kind[place] = what
            kind[place + 1] = what
        third = buf[np.minimum(high + 2, len(buf) - 1)]
        wide = (lead == 0xC2) & ((after == 0x85) | (after == 0xA0)) | (lead == 0xE1) & (after == 0x9A) & (third == 0x80) | (lead == 0xE3) & (after == 0x80) & (third == 0x80)
        wide |= (lead == 0xE2) & ((after == 0x80) & ((third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)) | (after == 0x81) & (third == 0x9F))
        odd = high[wide]
    else:
        odd = high
    return kind, np.concatenate((odd, np.flatnonzero((buf >= 0x1C) & (buf <= 0x1F))))


def pieces(buf: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and ends of the pieces of texts that stand between separators, and which are left to the library."""
    blank = kind <= WHITE  # white space or separator
    before = np.empty_like(kind)
    before[0] = SEPARATOR
    before[1:] = kind[:-1]
    border = kind != before
    # a space opens the run behind it; other white space doesn't
    border[1:] &= (kind[:-1] != SPACE) | blank[1:]
    # of white space in a row all but the last is one piece, or all of it at a text's end
    white = np.flatnonzero((kind == SPACE) | (kind == WHITE))
    after = kind[np.minimum(white + 1, len(kind) - 1)]
    was = before[white]
    border[white] = (after > WHITE) | (was == SEPARATOR) | (was > WHITE)
    separators = np.flatnonzero(kind == SEPARATOR)
    border[separators] = True
    starts = np.flatnonzero(border)
    strange = np.flatnonzero(kind == UNKNOWN)
    whole = np.zeros(len(starts), bool)
    if len(strange):
        edge = np.flatnonzero(np.diff(blank.view(np.int8), prepend=np.int8(1)))  # where stretches begin and end, in turn
        first, last = edge[::2], edge[1::2] if len(edge) % 2 == 0 else np.append(edge[1::2], len(buf))
        held = np.zeros(len(first), bool)
        held[np.searchsorted(first, strange, "right") - 1] = True
        of = np.maximum(np.searchsorted(first, starts, "right") - 1, 0)
        inner = held[of] & (starts > first[of]) & (starts < last[of])
        starts = starts[~inner]
        whole = np.zeros(len(starts), bool)
        opened = np.searchsorted(starts, first[held], "right") - 1
        whole[opened] = True
    ends = np.append(starts[1:], len(buf))
    real = kind[starts] != SEPARATOR
    return starts[real], ends[real], whole[real]


class Encoder:
    def __init__(self, path: str, most: int = MOST_PIECES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        from .token_counts import byte_alphabet

        self.most = most
        self.tokenizer = Tokenizer.from_file(path)
        self.split = Tokenizer.from_file(path)  # the same model for pre-tokens in the file's own alphabet, set apart by spaces
        self.split.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = np.zeros(256, np.uint32)
        for letter, byte in byte_alphabet().items():
            self.letters[byte] = ord(letter)
        vocabulary = self.tokenizer.get_vocab()
        self.stop = vocabulary[chr(self.letters[10])]
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that begin with a space
        for token, i in vocabulary.items():
            self.opens[i] = token.startswith(chr(self.letters[32]))
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear(most)

    def _clear(self, room: int) -> None:
        """The table: rows in order of arrival (a piece's bytes, where its ids stand), found by open addressing."""
        self.rows = self.ids = 0
        bits = max(4, int(2 * room - 1).bit_length())
        self.shift, self.slots = np.uint64(64 - bits), np.full(1 << bits, -1, np.int32)
        self.names = [np.empty(room, np.uint64) for _ in range(3)]
        self.begin, self.size = np.empty(room, np.int32), np.empty(room, np.int32)
        self.flat = np.empty(1 << 16, np.uint16 if len(self.opens) <= 1 << 16 else np.uint32)
        self.long: dict[bytes, int] = {}

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all UTF-8 texts, in order, and the number of ids of each text."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        data = b"\0".join([*texts, b"\0" * 24])
        buf = np.frombuffer(data, np.uint8)[: len(data) - 23]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(sizes + 1) - sizes - 1
        kind, places = classes(buf)
        odd = {int(i) for i in np.searchsorted(begins, places, "right") - 1}
        if np.count_nonzero(buf == 0) != len(texts):
            odd.update(i for i, t in enumerate(texts) if b"\0" in t)
        for word in self.added:
            if word in data:
                odd.update(i for i, t in enumerate(texts) if word in t)
        if odd:
            return self._mixed(texts, odd)
        starts, ends, whole = pieces(buf, kind)
        pick = self._pick(data, starts, ends, whole)
        lens = self.size[pick]
        ids = self.flat[spread(self.begin[pick].astype(np.int64), lens)].astype(np.uint32)
        total = np.concatenate(([0], np.cumsum(lens, dtype=np.int64)))
        edge = np.searchsorted(starts, np.append(begins, len(buf)))
        return ids, np.diff(total[edge])

    def _mixed(self, texts: list[bytes], odd: set[int]) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode``; the texts ``odd`` go to the library whole."""
        plain = [t for i, t in enumerate(texts) if i not in odd]
        ids, n = self.encode(plain)
        parts = iter(np.split(ids, np.cumsum(n)[:-1])) if plain else iter(())
        others = iter(self._whole([texts[i].decode() for i in sorted(odd)]))
        out = [next(others) if i in odd else next(parts) for i in range(len(texts))]
        return np.concatenate(out), np.fromiter(map(len, out), np.int64, len(out))

    def _pick(self, data: bytes, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Rows of the table for the pieces, which come into it first."""
        lens = ends - starts
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        name = [eight[np.minimum(starts + 8 * i, len(eight) - 1)] & _MASKS[np.clip(lens - 8 * i, 0, 8)] for i in range(3)]
        row = self._find(name)
        long = np.flatnonzero(lens > 24)
        words = [data[a:b] for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
        row[long] = [self.long.get(w, -1) for w in words]
        new = np.flatnonzero((row < 0) & (lens <= 24))
        order = new[np.lexsort([x[new] for x in reversed(name)])]
        different = np.ones(len(order), bool)
        if len(order):
            different[1:] = np.logical_or.reduce([x[order[1:]] != x[order[:-1]] for x in name])
        first = order[different]
        longs = dict.fromkeys(w for w, r in zip(words, row[long].tolist(), strict=True) if r < 0)
        if self.rows + len(first) + len(longs) > len(self.begin) and self.rows:
            self._clear(max(self.most, len(np.unique(row)) + len(first) + len(longs)))  # one very long text may have more pieces than that
            return self._pick(data, starts, ends, whole)
        if len(first) + len(longs) > len(self.begin):
            self._clear(len(first) + len(longs))
        if len(first):
            row[order] = (self._learn(data, starts[first], ends[first], whole[first]))[np.cumsum(different) - 1]
            self._insert([x[first] for x in name], row[first])
        if longs:
            at = {w: i for i, w in zip(long.tolist(), words, strict=True) if w in longs}
            some = np.fromiter(at.values(), np.int64, len(at))
            self.long |= zip(at, self._learn(data, starts[some], ends[some], whole[some]).tolist(), strict=True)
            row[long] = [self.long[w] for w in words]
        return row

    def _slot(self, name: list[np.ndarray]) -> np.ndarray:
        h = (name[0] * _MIX[0]) ^ (name[1] * _MIX[1]) ^ (name[2] * _MIX[2])
        return ((h ^ (h >> np.uint64(32))) * _MIX[3] >> self.shift).astype(np.int64)

    def _find(self, name: list[np.ndarray]) -> np.ndarray:
        at = self._slot(name)
        row = self.slots[at].astype(np.int64)
        rest = np.flatnonzero((row >= 0) & np.logical_or.reduce([x[row] != y for x, y in zip(self.names, name, strict=True)]))
        while len(rest):  # another piece has that place
            at[rest] = (at[rest] + 1) & (len(self.slots) - 1)
            row[rest] = r = self.slots[at[rest]]
            rest = rest[(r >= 0) & np.logical_or.reduce([x[r] != y[rest] for x, y in zip(self.names, name, strict=True)])]
        return row

    def _insert(self, name: list[np.ndarray], row: np.ndarray) -> None:
        for mine, x in zip(self.names, name, strict=True):
            mine[row] = x
        at, rest = self._slot(name), np.arange(len(row))
        while len(rest):
            free = self.slots[at] < 0
            self.slots[at[free]] = row[rest[free]]  # of several, the last one stays
            lost = self.slots[at] != row[rest]
            at, rest = (at[lost] + 1) & (len(self.slots) - 1), rest[lost]

    def _learn(self, data: bytes, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """New rows for distinct pieces, in order; like pieces follow each other, on which the library is faster."""
        buf = np.frombuffer(data, np.uint8)
        size, parts, place = np.zeros(len(starts), np.int64), [], []
        spaced = buf[starts] == 32
        white = (_CLASS[buf[ends - 1]] == WHITE) | (_CLASS[buf[ends - 1]] == SPACE)
        own = np.flatnonzero(whole | white)  # for the library's own split
        for i, ids in zip(own.tolist(), self._whole([data[starts[i] : ends[i]].decode() for i in own.tolist()]), strict=True):
            size[i] = len(ids)
            parts.append(ids)
        place.append(own)
        for group, spaces in ((np.flatnonzero(spaced & ~whole & ~white), True), (np.flatnonzero(~spaced & ~whole & ~white), False)):
            for i in range(0, len(group), 4000):
                some = group[i : i + 4000]
                n = ends[some] - starts[some]
                gap = 1 if spaces else 3  # without a space in front, a line's end stands before each piece
                letters = np.full(int((n + gap).sum()), 32, np.uint32)
                to = np.cumsum(n + gap) - n
                letters[spread(to, n)] = self.letters[buf[spread(starts[some], n)]]
                if not spaces:
                    letters[to - 2] = self.letters[10]
                (e,) = self.split.encode_batch_fast([letters.tobytes().decode("utf-32-le")], add_special_tokens=False)
                ids = np.array(e.ids, np.uint32)
                first = np.flatnonzero(self.opens[ids] if spaces else ids == self.stop)
                if len(first) != len(some):
                    raise AssertionError("pieces and their tokens don't agree")
                size[some] = np.diff(np.append(first, len(ids))) - (not spaces)
                parts.append(ids if spaces else np.delete(ids, first))
                place.append(some)
        ids, place = np.concatenate(parts), np.concatenate(place)
        while self.ids + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.empty_like(self.flat)))
        self.flat[self.ids : self.ids + len(ids)] = ids
        row = np.empty(len(starts), np.int64)
        row[place] = np.arange(self.rows, self.rows + len(place))
        mine = slice(self.rows, self.rows + len(place))
        self.size[mine] = size[place]
        self.begin[mine] = self.ids + np.cumsum(size[place]) - size[place]
        self.rows += len(place)
        self.ids += len(ids)
        return row


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, most: int = MOST_PIECES) -> Encoder:
    """One encoder for each worker process, file and table size."""
    if (path, most) not in _encoders:
        _encoders[path, most] = Encoder(path, most)
    return _encoders[path, most]
