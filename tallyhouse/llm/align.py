"""Tokens of two tokenizers over the same text, aligned by bytes.

A byte-level BPE (A) reads a space and the text, a sentencepiece model (B) the text, to which it adds
that space itself. Where both tokenizers end a token at the same byte, a group ends.

The cuts come from the tokenizers: character offsets of A, spans of B's proto. These are coarse where
several tokens share one character (byte-level pieces of it, byte fallback); there the decoded bytes
of the tokens say where each ends. A coarse cut that the decoded bytes contradict shows that a token
does not stand for the bytes it covers, and the text then has no tokens.

Texts are cut into pieces that no token crosses, by the splitting rule of A and before runs of spaces
for B. Each different piece goes through its tokenizer once per worker. Both rules are checked against
the vocabulary files; a file that does not promise them gets whole texts.

How many documents hold a pair of ids linked is counted in SQL. The pairs of most documents (at most
``_FREQUENT`` by arithmetic) are copied to all tasks, so no task gets the rows of a frequent pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, free_name, numbered, slices, text_buffer
from tallyhouse.llm.tokens import split_places
from tallyhouse.llm.vector import process_memo, span_hashes

_REMEMBERED = 1_000_000  # pieces a worker keeps, and eight times as many tokens
_AT_ONCE = 4096  # pieces that a tokenizer gets together
_TOGETHER = 1 << 19  # bytes of texts that are aligned together; a longer text stays whole
Learned = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # ids, tokens of each piece, their ends, whether they hold
_FREQUENT = 65_536
_SPACE = 0x20
_SCHEMA = "{row} long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
_SPANS = ", a_ids array<int>, a_ends array<long>, b_ids array<int>, b_ends array<long>"


def refined(begins: np.ndarray, ends: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of tokens in bytes from the start of their piece, and for each piece whether they hold.

    ``counts`` are the tokens of each piece, none empty, ``begins`` and ``ends`` their coarse spans, ``sizes``
    their decoded lengths. A coarse end holds where the token has a span and the next one starts
    behind it; between such cuts tokens share characters and their sizes are summed. A piece whose
    sizes do not reach each of its cuts does not hold.
    """
    last = np.cumsum(counts) - 1
    piece = np.repeat(np.arange(len(counts)), counts)
    total = np.cumsum(sizes)
    exact = total - np.repeat(total[last - counts + 1] - sizes[last - counts + 1], counts)
    behind = np.append(begins[1:], 0) >= ends
    behind[last] = True
    wrong = behind & (ends > begins) & (exact != ends)
    return exact, np.bincount(piece[wrong], minlength=len(counts)) == 0


class _Bytes:
    """The bytes of all tokens of a vocabulary, by id."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self._begins = np.cumsum(self.sizes) - self.sizes
        self._data = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        last = np.cumsum(sizes)
        return self._data[np.repeat(self._begins[ids] - last + sizes, sizes) + np.arange(last[-1] if len(last) else 0)]


def _standing_for(tokens: _Bytes, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the tokens of pieces, and whether each piece's tokens are its bytes, cut by cut."""
    exact, good = refined(begins, ends, tokens.sizes[ids], counts)
    wanted = np.array([len(p) for p in pieces])
    of = np.repeat(np.arange(len(pieces)), counts)
    got = np.bincount(of, tokens.sizes[ids], minlength=len(pieces)).astype(np.int64)
    good &= got == wanted
    kept = np.flatnonzero(good)
    a, b = tokens.joined(ids[good[of]]), np.frombuffer(b"".join([pieces[k] for k in kept]), np.uint8)
    other = np.repeat(kept, wanted[kept])[a != b]
    good[other] = False
    return exact, good


class ByteLevel:
    """The byte-level BPE of a tokenizers file."""

    def __init__(self, path: str):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, processors

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        rule = json.loads(self.tokenizer.to_str())
        cuts = rule["pre_tokenizer"] or {}
        self.splits = rule["normalizer"] is None and cuts.get("type") == "ByteLevel" and cuts.get("use_regex", True) and not cuts.get("add_prefix_space")
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
        letters = self._letters()
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.tokens = _Bytes([bytes(letters[c] for c in names.get(i, "") if c in letters) for i in range(max(names) + 1)])

    @staticmethod
    def _letters() -> dict[str, int]:
        """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves,
        the others the letters from U+0100 on, in order."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        return {chr(b): b for b in printable} | {chr(0x100 + k): b for k, b in enumerate(rest)}

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.splits:
            return offsets[:-1]
        places = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        return places[split_places(points, np.searchsorted(places, offsets[:-1]))]

    def learn(self, pieces: list[bytes]) -> Learned:
        texts = [p.decode() for p in pieces]
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        ids = [f.ids for f in found]
        counts = np.array([len(i) for i in ids])
        spans = np.array([span for f in found for span in f.offsets], np.int64).reshape(-1, 2)
        # From characters of a piece to bytes of it, by way of all pieces' characters.
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        places = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        chars, sizes = np.array([len(t) for t in texts]), np.array([len(p) for p in pieces])
        first_char, first = np.repeat(np.cumsum(chars) - chars, counts), np.repeat(np.cumsum(sizes) - sizes, counts)
        begins, ends = (places[spans[:, k] + first_char] - first for k in (0, 1))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, counts.sum())
        return flat, counts, *_standing_for(self.tokens, pieces, flat, counts, begins, ends)


class SentencePiece:
    """The BPE of a sentencepiece model, which puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        tokens = [bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        self.tokens = _Bytes(tokens)
        # No entry goes on behind a space that follows other text, and spaces are neither merged nor cut.
        crosses = any("▁" in name.lstrip("▁") for name in names)
        probe = self.model.encode("  x  y ", num_threads=1)
        self.space = self.model.piece_to_id("▁")
        self.splits = not crosses and self.space in probe and b"".join(tokens[i] for i in probe) == b"   x  y "

    def starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not self.splits:
            return offsets[:-1]
        space = data == _SPACE
        start = space.copy()
        start[1:] &= ~space[:-1]
        start[offsets[:-1]] = True
        return np.flatnonzero(start)

    def learn(self, pieces: list[bytes]) -> Learned:
        found = self.model.encode([p[1:] for p in pieces], return_type="proto", num_threads=1)
        spans = [[(t.id, t.begin, t.end) for t in f.pieces] for f in found]
        for i, p in enumerate(pieces):
            if p == b" ":  # that ends a text; the model adds no space to nothing
                spans[i] = [(self.space, 0, 0)]
        counts = np.array([len(s) for s in spans])
        ids, begins, ends = np.array([t for s in spans for t in s], np.int64).reshape(-1, 3).T
        # Spans count from behind the space that the model has added, which the first token has too.
        begins, ends = begins + 1, ends + 1
        begins[np.cumsum(counts) - counts] = 0
        return ids, counts, *_standing_for(self.tokens, pieces, ids, counts, begins, ends)


class Remembered:
    """Token ids and ends of pieces of text; each different piece is encoded once."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self._clear()

    def _clear(self) -> None:
        self.recent, self.known = (np.zeros(0, np.uint64),) * 2  # sorted hashes; recent ones are merged when they are many
        self.recent_entry, self.entry = (np.zeros(0, np.int64),) * 2
        self.count = self.used = 0
        self.sizes, self.begins = np.zeros(1 << 12, np.int32), np.zeros(1 << 12, np.int64)
        self.good, self.hits = np.zeros(1 << 12, bool), np.zeros(1 << 12, np.int32)
        self.ids, self.ends = np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    @staticmethod
    def _merged(hashes: np.ndarray, entries: np.ndarray, more: np.ndarray, more_entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, entries = np.concatenate([hashes, more]), np.concatenate([entries, more_entries])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], entries[order]

    def _add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray, ends: np.ndarray, good: np.ndarray) -> None:
        """Adds pieces by their sorted hashes."""
        n, m = self.count + len(counts), self.used + len(ids)
        while n > len(self.sizes):
            self.sizes, self.begins, self.good, self.hits = (np.append(x, np.zeros_like(x)) for x in (self.sizes, self.begins, self.good, self.hits))
        while m > len(self.ids):
            self.ids, self.ends = (np.append(x, np.zeros_like(x)) for x in (self.ids, self.ends))
        new, tokens = slice(self.count, n), slice(self.used, m)
        self.sizes[new], self.good[new], self.hits[new] = counts, good, 0
        self.begins[new] = self.used + np.cumsum(counts) - counts
        self.ids[tokens], self.ends[tokens] = ids, ends
        self.recent, self.recent_entry = self._merged(self.recent, self.recent_entry, hashes, np.arange(self.count, n))
        if 8 * len(self.recent) > len(self.known):
            self.known, self.entry = self._merged(self.known, self.entry, self.recent, self.recent_entry)
            self.recent, self.recent_entry = self.recent[:0], self.recent_entry[:0]
        self.count, self.used = n, m

    def _forget(self) -> None:
        """Keeps the pieces that were met more than once, if these are few enough."""
        hashes, entries = self._merged(self.known, self.entry, self.recent, self.recent_entry)
        keep = self.hits[entries] > 1
        hashes, entries = hashes[keep], entries[keep]
        sizes, begins, good = self.sizes[entries], self.begins[entries], self.good[entries]
        last = np.cumsum(sizes, dtype=np.int64)
        at = np.repeat(begins - last + sizes, sizes) + np.arange(last[-1] if len(last) else 0)
        ids, ends = self.ids[at], self.ends[at]
        self._clear()
        if len(hashes) <= _REMEMBERED // 2 and len(ids) <= 4 * _REMEMBERED:
            self._add(hashes, ids, sizes, ends, good)

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        """Entries of hashes, -1 for those that are new."""
        out = np.full(len(hashes), -1, np.int64)
        for known, entries in ((self.known, self.entry), (self.recent, self.recent_entry)):
            if len(known):
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                out = np.where(known[at] == hashes, entries[at], out)
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all tokens of the texts that ``offsets`` cut from ``data``, where each ends, and
        for each text whether its tokens stand for its bytes."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.ones(len(offsets) - 1, bool)
        if self.count > _REMEMBERED or self.used > 8 * _REMEMBERED:
            self._forget()
        starts = self.tokenizer.starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = span_hashes(data, starts, ends)
        order = np.argsort(hashes)
        new = np.append(True, hashes[order][1:] != hashes[order][:-1])
        first = order[new]
        different = hashes[first]
        found = self._look_up(different)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            raw = data.tobytes()
            pieces = [raw[i:j] for i, j in zip(starts[first[missing]].tolist(), ends[first[missing]].tolist(), strict=True)]
            parts = [self.tokenizer.learn(pieces[i : i + _AT_ONCE]) for i in range(0, len(pieces), _AT_ONCE)]
            found[missing] = self.count + np.arange(len(missing))
            self._add(different[missing], *(np.concatenate(p) for p in zip(*parts, strict=True)))
        self.hits[found] += 1  # slices it was met in
        entry = np.empty(len(starts), np.int64)
        entry[order] = found[np.cumsum(new) - 1]
        sizes = self.sizes[entry].astype(np.int64)
        last = np.cumsum(sizes)
        at = np.repeat(self.begins[entry] - last + sizes, sizes) + np.arange(last[-1])
        text = np.searchsorted(offsets, starts, "right") - 1
        good = np.bincount(text, ~self.good[entry], minlength=len(offsets) - 1) == 0
        return self.ids[at].astype(np.int64), self.ends[at] + np.repeat(starts, sizes), good


def _remembered(kind: type, path: str) -> Remembered:
    """This process's tokenizer for a file, with the pieces it has met."""
    memo = process_memo()
    key = f"{kind.__name__}:{path}"
    if key not in memo:
        memo[key] = Remembered(kind(path))
    return memo[key]


def _decimals(ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Each number in decimals with one byte behind it (0: none), end to end, and the length of each."""
    most = int(ids.max(initial=0))
    memo = process_memo()
    if len(memo.get("decimals", ())) <= most:
        shown = np.arange(most + 1).astype(f"S{len(str(most))}")
        memo["decimals"] = shown.view(np.uint8).reshape(most + 1, -1)
    cells = np.concatenate([memo["decimals"][ids], after[:, None]], axis=1)
    return cells[cells > 0].tobytes(), (cells > 0).sum(axis=1)


def _with_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A space before each text that is not empty; which texts these are."""
    filled = np.flatnonzero(np.diff(offsets))
    spaced = np.insert(data[offsets[0] : offsets[-1]], offsets[filled] - offsets[0], _SPACE)
    return spaced, np.append(0, np.cumsum(np.diff(offsets)[filled] + 1)), filled


class Aligned:
    """The tokens of some texts, group by group. Texts without tokens are left out of all arrays."""

    def __init__(self, a: Remembered, b: Remembered, data: np.ndarray, offsets: np.ndarray):
        self.count = len(offsets) - 1
        spaced, firsts, filled = _with_spaces(data, offsets)
        found = [t.encode(spaced, firsts) for t in (a, b)]
        good = found[0][2] & found[1][2]
        if not good.all():  # read on with the others only, so that every end is a place where both could cut
            keep = np.flatnonzero(good)
            spaced = np.concatenate([np.zeros(0, np.uint8), *[spaced[firsts[k] : firsts[k + 1]] for k in keep]])
            firsts, filled = np.append(0, np.cumsum(np.diff(firsts)[keep])), filled[keep]
            found = [t.encode(spaced, firsts) for t in (a, b)]
        self.firsts, self.filled = firsts, filled
        (self.ids_a, self.ends_a, _), (self.ids_b, self.ends_b, _) = found
        text = np.repeat(filled, np.diff(firsts))  # of each byte
        self.text_a, self.text_b = text[self.ends_a - 1], text[self.ends_b - 1]
        in_a, in_b = (np.bincount(ends, minlength=len(spaced) + 1).astype(bool) for ends in (self.ends_a, self.ends_b))
        self._either = np.flatnonzero(in_a | in_b)
        self.common = np.flatnonzero(in_a & in_b)
        self.text_of_group = text[self.common - 1]
        # How many tokens and groups end before or at each byte.
        self._a, self._b, self._groups = (np.cumsum(x) for x in (in_a, in_b, in_a & in_b))

    def counts(self) -> tuple[np.ndarray, ...]:
        """Per text: tokens of A, of B, groups, links."""
        n_a, n_b, groups = (np.bincount(t, minlength=self.count) for t in (self.text_a, self.text_b, self.text_of_group))
        return n_a, n_b, groups, n_a + n_b - groups

    def written(self) -> list[str]:
        """Per text the SHA-256 of its groups, empty for a text without tokens."""
        group_a, group_b = (self._groups[e - 1] for e in (self.ends_a, self.ends_b))
        place_a = np.arange(len(group_a)) + np.append(0, self._b[self.common])[group_a]
        place_b = np.arange(len(group_b)) + np.append(0, self._a[self.common])[group_b + 1]
        total = len(group_a) + len(group_b)
        ids, after, text = np.zeros(total, np.int64), np.zeros(total, np.uint8), np.zeros(total, np.int64)

        def closes(group: np.ndarray) -> np.ndarray:
            return np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool)

        ids[place_a], text[place_a], after[place_a] = self.ids_a, self.text_a, np.where(closes(group_a), ord("|"), ord(","))
        ids[place_b], text[place_b], after[place_b] = self.ids_b, self.text_b, np.where(closes(group_b), ord(";"), ord(","))
        out = [""] * self.count
        if total:
            after[closes(text)] = 0
            raw, sizes = _decimals(ids, after)
            ends = np.cumsum(sizes)[closes(text)].tolist()
            for k, i, j in zip(text[closes(text)].tolist(), [0, *ends], ends, strict=False):
                out[k] = sha256(raw[i:j]).hexdigest()
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different linked id pairs of each text, as text, pair (A's id shifted by 32, plus B's) and how often."""
        at = self._either - 1  # each stretch between cuts is one link
        ids_a, ids_b, text = self.ids_a[self._a[at]], self.ids_b[self._b[at]], self.text_a[self._a[at]]
        wide = int(ids_b.max(initial=0)) + 1
        high = int(ids_a.max(initial=0)) + 1
        if self.count * high * wide >= 1 << 63:
            raise ValueError("vocabularies too large to write a text and two ids as one number")
        key = np.sort((text * high + ids_a) * wide + ids_b)
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        pair, text = key[first] % (high * wide), key[first] // (high * wide)
        return text, (pair // wide << 32) | pair % wide, np.diff(np.append(first, len(key)))


def _lists(text: np.ndarray, count: int, *values: pa.Array) -> list[pa.Array]:
    places = pa.array(np.searchsorted(text, np.arange(count + 1)), pa.int32())
    return [pa.ListArray.from_arrays(places, v) for v in values]


def aligned(docs: DataFrame, vocabulary: str, model: str, with_spans: bool = False) -> tuple[DataFrame, str]:
    """Per row of ``docs`` its alignment, as a stored table, and the name of its row number's column.

    Columns: the row number, doc_id, n_a, n_b, n_groups, n_links, groups_sha256 (ids of each group,
    ``a1,a2|b1;a3|b2``), pairs and times (different linked id pairs and their links); with
    ``with_spans`` also the ids and ends (bytes, counted with the space before the text) of all
    tokens. Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    no tokens: zeros, an empty text and empty lists. Long texts are read whole; repeated rows are
    rows of their own; an empty table gives an empty one.
    """
    source, row = numbered(docs.select("doc_id", "text"), "documents")
    schema = _SCHEMA.format(row=row, kind=dict(docs.dtypes)["doc_id"]) + (_SPANS if with_spans else "")
    names = [part.split(" ")[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _remembered(ByteLevel, vocabulary), _remembered(SentencePiece, model)
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            for i, j in slices(offsets, _TOGETHER):
                found = Aligned(a, b, data, offsets[i : j + 1])
                n = j - i
                counts = [pa.array(c, pa.int64()) for c in found.counts()]
                text, pair, times = found.pairs()
                lists = _lists(text, n, pa.array(pair, pa.int64()), pa.array(times, pa.int32()))
                if with_spans:
                    for owner, ids, ends in ((found.text_a, found.ids_a, found.ends_a), (found.text_b, found.ids_b, found.ends_b)):
                        begin = np.zeros(n, np.int64)
                        begin[found.filled] = found.firsts[:-1]
                        lists += _lists(owner, n, pa.array(ids, pa.int32()), pa.array(ends - begin[owner], pa.int64()))
                columns = [batch.column(0)[i:j], batch.column(1)[i:j], *counts, pa.array(found.written(), pa.string()), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut_lineage(source.select(row, "doc_id", "text").mapInArrow(run, schema), "aligned"), row


def pair_counts(found: DataFrame) -> DataFrame:
    """In how many documents each id pair is linked: pair, n, best (no other pair of its A id has more).
    Written to the shared folder. A vocabulary's ids bound the table of maxima."""
    counts = cut_lineage(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")), "pairs")
    of_a = F.shiftright("pair", 32)
    most = counts.groupBy(of_a.alias("a")).agg(F.max("n").alias("most"))
    return cut_lineage(counts.withColumn("a", of_a).join(F.broadcast(most), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def _link_sums(found: DataFrame, row: str, counts: DataFrame) -> DataFrame:
    """Per row with links: n_best and count_sum."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") > total / _FREQUENT  # of which there are fewer than _FREQUENT
    frequent = F.broadcast(counts.where(often))
    links = found.select(row, F.explode(F.arrays_zip("pairs", "times")).alias("l")).select(row, F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    sums: list[Callable] = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")]
    common = links.join(frequent, "pair").groupBy(row).agg(*sums)
    seldom = links.join(F.broadcast(counts.where(often).select("pair")), "pair", "left_anti").join(counts.where(~often), "pair").groupBy(row).agg(*sums)
    return common.unionByName(seldom).groupBy(row).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def report(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair no other of the
    same A id exceeds, ties included), count_sum (documents that hold a link's pair, over all links)
    and groups_sha256. Cases as in ``aligned``; other columns of any name are left out."""
    found, row = aligned(docs, vocabulary, model)
    sums = _link_sums(found, row, pair_counts(found))
    both = found.join(sums.withColumnRenamed(row, free_name(found, "_of")), F.col(row) == F.col(free_name(found, "_of")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return both.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256")
