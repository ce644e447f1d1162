"""Small numpy and Arrow helpers that several operators use inside tasks."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_A = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LENGTH = np.uint64(0x94D049BB133111EB)


class _Kept(dict):
    """A cache that stays where it was filled: it travels to tasks empty."""

    def __reduce__(self):
        return _Kept, ()


_powers = _Kept()


def layout(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row offsets (from 0) and the bytes of an Arrow string array without nulls."""
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    size = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, size)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def filled(texts: pa.Array) -> pa.Array:
    """Texts with nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    return pc.fill_null(texts, "") if texts.null_count else texts


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Consecutive pieces of about ``limit`` bytes; a longer text is a piece of its own."""
    offsets, _ = layout(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield texts.slice(start, stop - start)
        start = stop


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, ``n`` of each."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, n.bit_length())
        for name, base in (("up", _A), ("down", pow(_A, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """True for bytes of words: letters, digits and characters beyond ASCII.

    Latin-1 signs (U+0080 to U+00BF) and general punctuation (U+2000 to U+203F)
    separate words like ASCII punctuation does.
    """
    table = np.zeros(256, bool)
    for first, last in (("0", "9"), ("a", "z"), ("A", "Z")):
        table[ord(first) : ord(last) + 1] = True
    table[0x80:] = True
    inside = table[data]
    for place in np.flatnonzero(data == 0xC2):
        inside[place : place + 2] = False
    signs = np.flatnonzero(data[:-1] == 0xE2) if len(data) else data
    for place in signs[data[signs + 1] == 0x80] if len(signs) else ():
        inside[place : place + 3] = False
    return inside


def _unspaced(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and behind the last byte of each character of a script that is written without blanks,
    and the first bytes of signs between words that such scripts use."""
    wide = np.flatnonzero(data[:-2] >= 0xE0) if len(data) > 2 else np.zeros(0, np.int64)
    code = (data[wide].astype(np.int32) << 16) | (data[wide + 1].astype(np.int32) << 8) | data[wide + 2]

    def within(first: str, last: str) -> np.ndarray:
        return (code >= int.from_bytes(first.encode()[:3])) & (code <= int.from_bytes(last.encode()[:3]))

    # Thai and Lao, Myanmar, Khmer, kana, Han; Han beyond the first plane has four bytes.
    three = within("\u0e01", "\u0eff") | within("\u1000", "\u109f") | within("\u1780", "\u17ff") | within("\u3040", "\u30ff")
    three |= within("\u3400", "\u9fff") | within("\uf900", "\ufaff")
    four = within("\U00020000", "\U0003ffff")
    signs = within("\u3000", "\u303f") | within("\uff01", "\uff0f") | within("\uff1a", "\uff20") | within("\uff3b", "\uff40") | within("\uff5b", "\uff65")
    return wide[three | four], wide[three | four] + np.where(four[three | four], 4, 3), wide[signs]


class Words:
    """The lower-cased words of some rows: place, row and 64-bit hash of each.

    With ``characters`` each character of a script that is written without
    blanks is a word of its own.
    """

    def __init__(self, texts: pa.Array, characters: bool = False):
        self.text = pc.utf8_lower(filled(texts))
        offsets, data = layout(self.text)
        self.data = data
        n = len(data)
        inside, edges = _word_bytes(data), offsets
        if characters:
            starts, ends, signs = _unspaced(data)
            edges = np.concatenate((offsets, starts, ends))
            for k in range(3):
                inside[signs + k] = False
        before = np.zeros(n + 1, bool)
        before[1:] = inside
        before[edges] = False
        after = np.zeros(n + 1, bool)
        after[:n] = inside
        after[edges] = False
        self.starts = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.row_starts = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.row_starts)
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)
        up, down = _powers_of(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:], dtype=np.uint64)
        h = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        self.hashes = mixed(h + (self.ends - self.starts).astype(np.uint64) * _LENGTH)

    def words(self) -> pa.Array:
        """The words themselves, one row each."""
        lengths = self.ends - self.starts
        offsets = np.zeros(len(lengths) + 1, np.int32)
        np.cumsum(lengths, out=offsets[1:])
        marks = np.zeros(len(self.data) + 1, np.int8)
        marks[self.starts] += 1
        marks[self.ends] -= 1
        kept = self.data[np.cumsum(marks[:-1], dtype=np.int8).astype(bool)]
        return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept)))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * _MIX
    h = (h ^ (h >> np.uint64(27))) * _LENGTH
    return h ^ (h >> np.uint64(31))


class Runs:
    """Hashes of all runs of a sequence of numbers."""

    def __init__(self, values: np.ndarray):
        self.up, self.down = _powers_of(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mixed(values.astype(np.uint64) + _LENGTH) * self.up[: len(values)], out=self.sums[1:], dtype=np.uint64)

    def hash(self, first, length: int):
        return (self.sums[first + length] - self.sums[first]) * self.down[first]


def hashes(texts: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text."""
    offsets, data = layout(texts)
    n = len(data)
    up, down = _powers_of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:], dtype=np.uint64)
    starts, ends = offsets[:-1], offsets[1:]
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _LENGTH)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rolling hashes of every ``size`` words of one row, and the first word of each."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(size):
        h = h * np.uint64(_A) + words.hashes[k : k + n]
    at = np.flatnonzero(words.rows[:n] == words.rows[size - 1 :])
    return h[at], at


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches by the links ``a`` to ``b``."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            break
    return label
