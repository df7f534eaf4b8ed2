"""Vectorised words of UTF-8 text: spans and 64-bit hashes of all words of an Arrow column at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_WINDOW = 1 << 18

#: Bytes that belong to words: all but space and tab to carriage return.
BLANK_SEPARATED = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
#: Bytes that belong to words: digits, ASCII letters and every byte of other characters.
ALPHANUMERIC = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A random value for each byte; capital ASCII letters share the small letters' values.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
EXACT = _BYTE.copy()
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the offsets of its rows in them; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about `most` bytes of text each, one row at least."""
    lens = text_bytes(column)[1]
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(lens, lens[i] + most, "right")) - 1)
        yield i, min(j, len(column))
        i = j


def word_spans(body: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the offsets of the rows in them. Words never cross rows."""
    here = inside[body]
    n = len(body)
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:] = here[:-1]
    after[:-1] = here[1:]
    cuts = at[(at > 0) & (at < n)]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(here & ~before)
    ends = np.flatnonzero(here & ~after) + 1
    return starts, ends, np.searchsorted(starts, at, "left")


def _steps(lo: int, hi: int) -> np.ndarray:
    """A random odd multiplier for each place in a word."""
    return mix(np.arange(lo + 1, hi + 1, dtype=np.uint64) * _BASE) | _U(1)


_STEPS = _steps(0, _WINDOW)


def byte_values(table: np.ndarray):
    return lambda part: table[part]


def code_values(part: np.ndarray) -> np.ndarray:
    """A random value for each code point."""
    return mix(part.astype(np.uint64) + _U(1))


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, values) -> np.ndarray:
    """A 64-bit hash of each span of an array of symbols: the sum of each symbol's value times its place's multiplier.

    Multipliers are random and unrelated, so that no family of words collides by its structure. Two
    different words may still have one hash: where equality decides a result, use distinct_spans.
    """
    out = np.zeros(len(starts), np.uint64)
    size = ends - starts
    upto = np.cumsum(size)
    i = 0
    while i < len(starts):
        done = int(upto[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + _WINDOW, "right")))
        if size[i] > _WINDOW:
            total = _U(0)
            with np.errstate(over="ignore"):
                for k in range(0, int(size[i]), _WINDOW):
                    part = body[starts[i] + k : min(starts[i] + k + _WINDOW, ends[i])]
                    total += (values(part) * _steps(k, k + len(part))).sum(dtype=np.uint64)
            out[i] = total
        else:
            some = i + np.flatnonzero(size[i:j])
            if len(some):
                n = size[some]
                head = np.cumsum(n) - n
                place = np.arange(head[-1] + n[-1]) - np.repeat(head, n)
                symbols = body[np.repeat(starts[some], n) + place]
                out[some] = np.add.reduceat(values(symbols) * _STEPS[place], head)
        i = j
    return mix(out ^ mix(size.astype(np.uint64)))


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each word, capital and small ASCII letters alike (with EXACT: apart)."""
    return span_hashes(body, starts, ends, byte_values(table))


def differing(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Marks the spans whose symbols aren't those of the span that `other` names for them."""
    size = ends - starts
    wrong = size != size[other]
    check = np.flatnonzero(~wrong & (other != np.arange(len(other))) & (size > 0))
    upto = np.cumsum(size[check])
    i = 0
    while i < len(check):
        done = int(upto[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + _WINDOW, "right")))
        if j == i + 1:
            a, b, n = starts[check[i]], starts[other[check[i]]], size[check[i]]
            wrong[check[i]] = not np.array_equal(body[a : a + n], body[b : b + n])
        else:
            rows = check[i:j]
            n = size[rows]
            head = np.cumsum(n) - n
            place = np.arange(head[-1] + n[-1]) - np.repeat(head, n)
            apart = body[np.repeat(starts[rows], n) + place] != body[np.repeat(starts[other[rows]], n) + place]
            wrong[rows] = np.logical_or.reduceat(apart, head)
        i = j
    return wrong


def distinct_spans(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, of): one span of each distinct content, and for every span which of them it equals.

    Hashes bring equal spans together, and the symbols themselves decide: spans that share a hash but
    not their symbols are told apart.
    """
    _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
    of = of.reshape(-1)
    wrong = np.flatnonzero(differing(body, starts, ends, first[of]))
    if len(wrong):
        extra: dict[bytes, int] = {}
        found = first.tolist()
        for k in wrong.tolist():
            of[k] = extra.setdefault(body[starts[k] : ends[k]].tobytes(), len(first) + len(extra))
            if of[k] == len(found):
                found.append(k)
        first = np.array(found, np.int64)
    return first, of


def small_letters(body: np.ndarray) -> np.ndarray:
    """The bytes with capital ASCII letters made small."""
    return np.where((body >= 0x41) & (body <= 0x5A), body + np.uint8(32), body)


def normal_words(body: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All words in small letters, one blank between those of a row: the bytes, where words start and end in them, and the rows' offsets in the words."""
    body = small_letters(body)
    starts, ends, word_at = word_spans(body, at, inside)
    keep = inside[body]
    last = np.zeros(len(ends), bool)
    last[word_at[1:][np.diff(word_at) > 0] - 1] = True
    gaps = ends[~last]
    body[gaps] = 0x20
    keep[gaps] = True
    upto = np.concatenate([[0], np.cumsum(keep)])
    return body[keep].tobytes(), upto[starts], upto[ends], word_at


def exact_shingles(body: np.ndarray, at: np.ndarray, inside: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct runs of n words: their numbers, a hash of each, and the rows' offsets in them.

    Equal numbers mean equal words, by comparison of their bytes: words are numbered first, then
    pairs of numbers, one more word at a time. Capital and small ASCII letters are alike; a row of
    fewer words is one run of its own length.
    """
    body = small_letters(body)
    starts, ends, word_at = word_spans(body, at, inside)
    hashes = word_hashes(body, starts, ends, EXACT)
    _, of = distinct_spans(body, starts, ends, hashes)
    count = np.diff(word_at)
    number = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    run_at = np.concatenate([[0], np.cumsum(number)])
    head = np.repeat(word_at[:-1], number) + np.arange(run_at[-1]) - np.repeat(run_at[:-1], number)
    size = np.repeat(np.minimum(count, n), number)
    known, value = of[head] + 1, hashes[head] * _STEPS[0]
    for k in range(1, n):
        there = size > k
        nth = np.minimum(head + k, max(0, len(of) - 1))
        known = np.unique(known << 32 | np.where(there, of[nth] + 1, 0), return_inverse=True)[1].reshape(-1)
        value = value + np.where(there, hashes[nth], _U(0)) * _STEPS[k]
    row = np.repeat(np.arange(len(count)), number)
    pairs, one = np.unique(row << 32 | known, return_index=True)
    return pairs & 0xFFFFFFFF, mix(value[one]), np.searchsorted(pairs >> 32, np.arange(len(count) + 1))
