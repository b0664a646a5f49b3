"""Vectorised text primitives over Arrow buffers: words, 64-bit hashes, pre-tokens.

A batch is worked through in slices of a few MB, so memory does not follow the batch or the
partition. Every hash is a polynomial modulo 2**64 taken from one prefix sum, then mixed.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C55
_U = np.uint64

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_POW: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        size = max(n, 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, _U(base))
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=_U)
    return _POW[0], _POW[1]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; equal content, equal hash."""
    n = len(values)
    power, inverse = _powers(n + 1)
    prefix = np.zeros(n + 1, _U)
    np.cumsum((values.astype(_U) + _U(1)) * power[:n], out=prefix[1:])
    h = (prefix[end] - prefix[start]) * inverse[start]
    return mix(h + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of consecutive rows of a null-free string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word [^\\x20\\x09-\\x0D]+ ."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    white = WHITE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= white[:-1]
    after = edge[1:].copy()
    after[:-1] |= white[1:]
    start = np.flatnonzero(~white & before)
    end = np.flatnonzero(~white & after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def row_spans(rows: np.ndarray, n: int) -> np.ndarray:
    """First word of each row: rows must be ascending; n + 1 entries."""
    return np.searchsorted(rows, np.arange(n + 1))


def window_hashes(h: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every `width` consecutive words within one row, and the index of its first word."""
    m = len(h) - width + 1
    if m <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    acc = np.zeros(m, _U)
    for k in range(width):
        acc *= _U(0xFF51AFD7ED558CCD)
        acc += h[k : k + m]
    first = np.flatnonzero(rows[:m] == rows[width - 1 :])
    return mix(acc[first]), first


# --- pre-tokens ---------------------------------------------------------------------------------

OTHER, LETTER, NUMBER, SPACE = range(4)


@functools.cache
def classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(m[0][0]), ord(m[0][-1])
            table[a : b + 1] = kind
    table[0xD800:0xE000] = OTHER
    table[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray, str]:
    """All code points, the offset of every text, and the joined text."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    joined = "".join(texts)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), offsets, joined


def _contractions(cp: np.ndarray, cls: np.ndarray, run: np.ndarray, run_end: np.ndarray, ok: np.ndarray, starts: np.ndarray, edge: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll: an apostrophe that is a pre-token of its own takes those letters."""
    n = len(cp)
    q = run[(run_end - run == 1) & (cls[run] == OTHER) & (cp[run] == 39) & ok]
    q = q[q + 1 < n]
    q = q[~edge[q + 1]]
    if not len(q):
        return
    one = np.isin(cp[q + 1], [ord(c) for c in "stmd"])
    third = np.minimum(q + 2, n - 1)
    inside = (q + 2 < n) & ~edge[third]
    two = np.zeros(len(q), bool)
    for a, b in ("re", "ve", "ll"):
        two |= (cp[q + 1] == ord(a)) & (cp[third] == ord(b)) & inside
    for hit, k in ((one, 1), (two, 2)):
        p = q[hit]
        starts[p + 1] = False
        rest = p + 1 + k
        starts[rest[rest < n]] = True


def byte_level_starts(cp: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the matches of the byte-level pattern ('s|...| ?L+| ?N+| ?other+|\\s+(?!\\S)|\\s+)."""
    n = len(cp)
    if not n:
        return np.zeros(0, np.int64)
    cls = classes()[cp]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[n] = True
    starts = edge[:-1].copy()
    starts[1:] |= cls[1:] != cls[:-1]
    run = np.flatnonzero(starts)
    run_end = np.append(run[1:], n)
    followed = (cls[run] == SPACE) & ~edge[run_end]
    last = run_end[followed] - 1  # the last white space before something else stands alone or, a space, joins it
    starts[last] = True
    starts[run_end[followed][cp[last] == 32]] = False
    _contractions(cp, cls, run, run_end, starts[run], starts, edge)
    return np.flatnonzero(starts)


def word_level_spans(cp: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the matches of 's|...|L+|N|other+ ; white space is dropped."""
    n = len(cp)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z
    cls = classes()[cp]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[n] = True
    starts = edge[:-1].copy()
    starts[1:] |= cls[1:] != cls[:-1]
    run = np.flatnonzero(starts)
    run_end = np.append(run[1:], n)
    _contractions(cp, cls, run, run_end, np.ones(len(run), bool), starts, edge)
    starts |= cls == NUMBER
    s = np.flatnonzero(starts)
    e = np.append(s[1:], n)
    keep = cls[s] != SPACE
    return s[keep], e[keep]


def gather(offsets: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Positions of the concatenated variable-length entries `which`."""
    take = lengths[which]
    ends = np.cumsum(take)
    total = int(ends[-1]) if len(ends) else 0
    out = np.arange(total, dtype=np.int64)
    out += np.repeat(offsets[which] - (ends - take), take)
    return out


class PieceCoder:
    """Ids of pre-tokens, with a bounded memory of pieces already encoded.

    `encode` turns a list of distinct pieces into lists of ids; only pieces not remembered reach it.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 1_000_000):
        self.encode_new, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.keys = np.zeros(0, _U)
        self.at = np.zeros(0, np.int64)
        self.len = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    def __call__(self, cp: np.ndarray, start: np.ndarray, end: np.ndarray, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each has."""
        if not len(start):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        h = span_hashes(cp, start, end)
        unique, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(unique) > self.limit:
            self._reset()
        pos = np.searchsorted(self.keys, unique)
        found = np.zeros(len(unique), bool)
        if len(self.keys):
            found = self.keys[np.minimum(pos, len(self.keys) - 1)] == unique
        new = np.flatnonzero(~found)
        if len(new):
            got = self.encode_new([joined[a:b] for a, b in zip(start[first[new]].tolist(), end[first[new]].tolist())])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter((i for ids in got for i in ids), np.uint16, int(sizes.sum()))
            self.at = np.insert(self.at, pos[new], len(self.ids) + np.cumsum(sizes) - sizes)
            self.len = np.insert(self.len, pos[new], sizes)
            self.keys = np.insert(self.keys, pos[new], unique[new])
            self.ids = np.concatenate([self.ids, flat])
            pos = np.searchsorted(self.keys, unique)
        which = pos[inverse]
        return self.ids[gather(self.at, self.len, which)], self.len[which]


def decoded(buf: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray]:
    """The slice as one string, and the row offsets in code points."""
    lead = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=lead[1:])
    return buf.tobytes().decode("utf-8", "replace"), lead[offsets]


@functools.cache
def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 onwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    table.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in table)})
    return table


def with_added(tokenizer, text: str, at: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids and their ends a row, where rows of `text` that hold an added token's literal are encoded by the library."""
    literals = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    if not any(x in text for x in literals):
        return ids, ends
    parts, cut = np.split(ids, ends[:-1]), at.tolist()
    for k, (a, b) in enumerate(zip(cut, cut[1:])):
        row = text[a:b]
        if any(x in row for x in literals):
            parts[k] = np.array(tokenizer.encode(row, add_special_tokens=False).ids, ids.dtype)
    return np.concatenate(parts), np.cumsum([len(p) for p in parts])


def model_ids(tokenizer) -> Callable[[list[str]], list]:
    """Ids of pre-tokens by the library's byte-level model."""
    model, letters = tokenizer.model, byte_letters()

    def encode(pieces: list[str]) -> list:
        return [[t.id for t in model.tokenize(p.encode().decode("latin-1").translate(letters))] for p in pieces]

    return encode


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index connected to each of n vertices by the edges (a, b)."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            break
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        np.minimum.at(root, high, low)
        while True:  # follow the pointers to their ends
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
