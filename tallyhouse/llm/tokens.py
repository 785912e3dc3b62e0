"""Byte-level BPE of many texts at once.

The vocabulary's splitting rule is applied to all texts together as array operations, and each
different piece of text goes through the tokenizer once per worker; the ids are those that the
tokenizer gives for the whole text.
"""

from __future__ import annotations

import numpy as np

from tallyhouse.llm.vector import mix, powers, process_memo

_U = np.uint64
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
_CACHED = 1_000_000  # pieces a worker remembers


def _classes() -> np.ndarray:
    """Of each code point: letter, number, white space or other."""
    memo = process_memo()
    if "classes" not in memo:
        import regex

        # Decoded at once: a million characters joined one by one take 100 MB while a worker starts.
        points = np.append(np.arange(0xD800, dtype="<u4"), np.arange(0xE000, 0x110000, dtype="<u4"))
        every = points.tobytes().decode("utf-32-le")
        table = np.full(0x110000, _OTHER, np.uint8)
        for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
            for run in regex.finditer(pattern, every):
                points = np.frombuffer(run[0].encode("utf-32-le"), np.uint32)
                table[points] = kind
        memo["classes"] = table
    return memo["classes"]


def split_places(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where pieces start in the code points of texts that start at ``firsts``.

    A piece is a run of letters, of numbers or of other characters, with one blank before it; the
    common English contractions; or white space, of which the last character before a piece
    stands alone (or goes with the piece, if a blank).
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[points]
    starts_text = np.zeros(n + 1, bool)
    starts_text[firsts[firsts < n]] = True
    starts_text[n] = True
    change = np.ones(n, bool)
    change[1:] = (kind[1:] != kind[:-1]) | starts_text[1:n]
    space = kind == _SPACE
    run_end = np.ones(n, bool)
    run_end[:-1] = change[1:]
    # The last white space before other text: a piece of its own, or the blank of the next piece.
    last = np.flatnonzero(space & run_end & ~starts_text[1:])
    start = change.copy()
    start[last] = True
    blank = last[points[last] == 0x20]
    start[blank + 1] = False
    # Contractions: an apostrophe alone, right after something that is no blank, then the ending.
    quote = np.flatnonzero((points == 0x27) & start & run_end)
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        size = len(ending)
        fits = quote[quote + size < n]
        hit = np.ones(len(fits), bool)
        for k, c in enumerate(ending, 1):
            hit &= (points[fits + k] == ord(c)) & ~starts_text[fits + k]
        fits = fits[hit]
        start[fits + 1] = False
        after = fits + size + 1
        after = after[after < n]
        start[after] = np.where(space[after] | starts_text[after] | start[after], start[after], True)
    return np.flatnonzero(start)


class Encoder:
    def __init__(self, vocabulary: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[int, int] = {}
        self.sizes = np.zeros(1 << 16, np.int64)
        self.begins = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, hashes: list[int], texts: list[str]) -> None:
        for h, found in zip(hashes, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids = found.ids
            n = len(self.known)
            if n == len(self.sizes):
                self.sizes, self.begins = np.resize(self.sizes, 2 * n), np.resize(self.begins, 2 * n)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.resize(self.ids, 2 * len(self.ids))
            self.ids[self.used : self.used + len(ids)] = ids
            self.sizes[n], self.begins[n] = len(ids), self.used
            self.used += len(ids)
            self.known[h] = n

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Token ids of the texts that ``offsets`` cut from ``data`` (UTF-8)."""
        raw = data[offsets[0] : offsets[-1]].tobytes()
        text = raw.decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        per_byte = np.zeros(len(raw) + 1, np.int64)
        np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80, out=per_byte[1:])
        firsts = per_byte[offsets - offsets[0]]
        start = split_places(points, firsts[:-1])
        if len(self.known) > _CACHED:
            self.known.clear()
            self.used = 0
        if len(start):
            end = np.append(start[1:], len(points))
            hashes = _point_hashes(points, start, end)
            different, where, back = np.unique(hashes, return_index=True, return_inverse=True)
            numbers = different.tolist()
            new = [i for i, h in enumerate(numbers) if h not in self.known]
            if new:
                self._learn([numbers[i] for i in new], [text[start[where[i]] : end[where[i]]] for i in new])
            entry = np.fromiter(map(self.known.__getitem__, numbers), np.int64, len(numbers))[back]
            sizes = self.sizes[entry]
            total = np.cumsum(sizes)
            ids = self.ids[np.repeat(self.begins[entry] - total + sizes, sizes) + np.arange(total[-1])]
            total = np.append(0, total)
            cut = total[np.searchsorted(start, firsts)]
        else:
            ids, cut = np.zeros(0, np.uint32), np.zeros(len(firsts), np.int64)
        out = [ids[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]
        if any(s in text for s in self.special):  # their ids come before any splitting
            for k, (i, j) in enumerate(zip(firsts[:-1], firsts[1:], strict=True)):
                if any(s in text[i:j] for s in self.special):
                    out[k] = np.array(self.tokenizer.encode(text[i:j], add_special_tokens=False).ids, np.uint32)
        return out


def encoder(vocabulary: str) -> Encoder:
    """This process's encoder for a vocabulary file; it remembers the pieces it has met."""
    memo = process_memo()
    if memo.get("encoder", (None,))[0] != vocabulary:
        memo["encoder"] = (vocabulary, Encoder(vocabulary))
    return memo["encoder"][1]


def _point_hashes(points: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, down = powers(len(points) + 1)
    total = np.zeros(len(points) + 1, _U)
    np.cumsum(mix(points.astype(_U)) * up[:-1], out=total[1:])
    return mix((total[end] - total[start]) * down[start] ^ mix((end - start).astype(_U)))
