"""Words and hashes of many texts at once, as array operations on their UTF-8 bytes.

Words are runs of bytes of a class. Hashes have 64 bits; equal spans have equal hashes on every
machine, and two different spans meet with a chance of about 2**-64.
"""

from __future__ import annotations

import sys
from types import ModuleType

import numpy as np

_PRIME = 0x9E3779B97F4A7C15
_U = np.uint64


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Bytes of words that white space (space, tab to carriage return) divides.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit integers, one to one."""
    x = x + _U(_PRIME)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of each word, in order; a word never crosses the end of a text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = in_word[data]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def process_memo() -> dict:
    """What this process keeps between tasks. Code that travels with a task has new globals in
    each, so the memo hangs on the interpreter's list of modules."""
    return sys.modules.setdefault("_tallyhouse_memo", ModuleType("_tallyhouse_memo")).__dict__


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    memo = process_memo()
    if len(memo.get("powers", [()])[0]) < n:
        size = max(n, 1 << 16)
        base = 0xD1342543DE82EF95
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, _U)
            steps[0] = 1
            both.append(np.cumprod(steps))
        memo["powers"] = both
    up, down = memo["powers"]
    return up[:n], down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span, from one running sum over the bytes."""
    up, down = powers(len(data) + 1)
    values = mix(np.arange(256, dtype=_U))
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(values[data] * up[:-1], out=total[1:])
    own = (total[ends] - total[starts]) * down[starts]
    return mix(own ^ mix((ends - starts).astype(_U)))


def windows(hashes: np.ndarray, text: np.ndarray, width: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash of ``width`` words from each word on, and whether these lie in one text.

    With ``short``, a text of fewer words has one window, of all its words.
    """
    n = len(hashes)
    total = np.zeros(n, _U)
    full = np.ones(n, bool)
    for j in range(width):
        same = np.zeros(n, bool)
        if n > j:
            same[: n - j] = text[j:] == text[: n - j]
        word = np.zeros(n, _U)
        word[: max(n - j, 0)] = hashes[j:]
        total = total * _U(0xA0761D6478BD642F) + np.where(same, word, _U(0))
        full = same
    if short and n:
        first = np.ones(n, bool)
        first[1:] = text[1:] != text[:-1]
        length = np.bincount(text)
        full = full | (first & (length[text] < width))
    return mix(total), full
