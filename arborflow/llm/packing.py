"""Harmonic packing of tokenized documents into sequences.

A piece of length between C/(k+1) and C/k is of class k, and each bin of class k takes k pieces. Documents may be
cut, so a piece that would leave a large share of its slot empty is cut at a slot's exact length first. Every worker
fills its own bins in one pass; bins left open at its end are joined with each other. Nothing is shuffled.
"""

from __future__ import annotations

import re
import zlib
from array import array
from itertools import compress, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborflow.llm.common import as_batch, texts_of, worker_cache

CAPACITY = 4096
END = 2  # id that closes each document
SLACK = 1 / 32  # share of a slot that a whole piece may leave empty
CACHE_WORDS = 300_000  # words whose ids a worker keeps from one part of a task to the next; results do not depend on it
HELD_WORDS = 250_000  # words that a task holds at a time, whole texts, as numbers; results do not depend on it
ENCODED = 5_000  # pieces that the tokenizer gets at a time: what it returns is far larger than their ids
SLICE_ROWS = 500  # rows of a batch whose texts are copied at a time


def slot_counts(capacity: int) -> list:
    """Documents per bin of each class: 1 to 32, from there about an eighth more each."""
    counts = list(range(1, min(32, capacity) + 1))
    while counts[-1] * 9 // 8 <= capacity and counts[-1] < capacity:
        counts.append(max(counts[-1] + 1, counts[-1] * 9 // 8))
    return counts


def cut_lengths(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list:
    """(piece length, pieces per bin) of a document of so many tokens; the lengths add up to it."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest, counts = length % capacity, slot_counts(capacity)
    while rest:
        fit = max(k for k in counts if rest <= capacity // k)
        slot = capacity // fit
        if fit > 32 or slot - rest <= slack * slot:
            pieces.append((rest, fit))
            break
        fit = min(k for k in counts if capacity // k <= rest)
        pieces.append((capacity // fit, fit))
        rest -= capacity // fit
    return pieces


# Words of these characters only are lower-cased and cut alike by Python and by the tokenizer: no white space, nothing
# that composes with a neighbour, no letter whose lower case is two. The rest goes through the whole tokenizer.
PLAIN = re.compile("[!-~\u00a1-\u012f]+")
LETTERS = "a-z" + "".join(c for c in map(chr, range(0xA1, 0x130)) if c.isalpha())
NUMBERS = "0-9" + "".join(c for c in map(chr, range(0xA1, 0x130)) if c.isnumeric())
# Fixed value: how the tokenizer cuts a lower-cased word; its classes of letters and numbers, as far as plain words go.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^{LETTERS}{NUMBERS}]+")


class _Numbered(dict):
    """A number for each key, in order of first sight; `fresh` has the keys since it was last emptied."""

    def __init__(self, *first):
        super().__init__(zip(first, range(len(first))))
        self.fresh: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.fresh.append(key)
        return number

    def taken(self) -> list:
        fresh, self.fresh = self.fresh, []
        return fresh


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, twice as long as often as it takes to hold so many."""
    while len(array) < size:
        array = np.concatenate((array, np.zeros_like(array)))
    return array


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of spans, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class WordTokens:
    """Token ids of words, which the tokenizer never joins across white space; None stands for a text's closing id.

    Plain words are cut here and their pieces encoded by the tokenizer's merges alone, each piece once. A text's words
    become numbers as it is read; the ids of the most used words are kept.
    """

    def __init__(self, path: str, end: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.end = Tokenizer.from_file(path), end
        self.merges = Tokenizer(self.whole.model)  # the same merges, not a second copy
        self.merges.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self):
        self.places, self.pieces = _Numbered(None), _Numbered()
        self.flat, self.used = np.full(1 << 16, self.end, np.uint32), 1
        self.starts, self.sizes = np.zeros(1 << 14, np.int64), np.ones(1 << 14, np.int64)  # of words, None the first
        self.uses = np.zeros(1 << 14, np.int64)
        self.piece_starts, self.piece_sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _trim(self):
        """Lets go of all but the most used words, half of CACHE_WORDS at most; of the pieces, if they are as many."""
        words, half = len(self.places), CACHE_WORDS // 2
        uses = self.uses[:words]
        keep = uses > np.partition(uses, -half)[-half]
        keep[0] = False  # None comes back by itself
        kept, uses, sizes = list(compress(self.places, keep)), uses[keep], self.sizes[:words][keep]
        ids = self.flat[_spans(self.starts[:words][keep], sizes)]
        pieces, piece_sizes = self.pieces, self.piece_sizes[: len(self.pieces)]
        piece_ids = self.flat[_spans(self.piece_starts[: len(pieces)], piece_sizes)]
        self.clear()
        for word in kept:
            self.places[word]
        self.places.taken()
        place = slice(1, len(self.places))
        self.starts, self.sizes, self.uses = (_grown(a, place.stop) for a in (self.starts, self.sizes, self.uses))
        self.starts[place], self.sizes[place] = self._store(ids) + np.cumsum(sizes) - sizes, sizes
        self.uses[place] = uses // 2  # what was used long ago counts less
        if len(pieces) < half:
            self.pieces = pieces
            self.piece_starts, self.piece_sizes = _grown(self.piece_starts, len(pieces)), _grown(self.piece_sizes, len(pieces))
            self.piece_starts[: len(pieces)] = self._store(piece_ids) + np.cumsum(piece_sizes) - piece_sizes
            self.piece_sizes[: len(pieces)] = piece_sizes

    def _store(self, ids: np.ndarray) -> int:
        """Place of ids in the flat array."""
        self.flat = _grown(self.flat, self.used + len(ids))
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    @staticmethod
    def _batches(tokenizer, texts, size: int):
        """Each text's encoding, made so many at a time."""
        texts = iter(texts)
        while part := list(islice(texts, size)):
            yield from tokenizer.encode_batch_fast(part, add_special_tokens=False)

    def _encoded(self, pieces: list) -> tuple:
        """(ids, sizes) of pieces, 100 at a time; each ends with its only token that closes a word."""
        lines = [pieces[i : i + 100] for i in range(0, len(pieces), 100)]
        ids, sizes = [], []
        for line, found in zip(lines, self._batches(self.merges, (" ".join(line) for line in lines), ENCODED // 100)):
            own = np.array(found.ids, np.uint32)
            ends = np.flatnonzero(self.closing[own])
            if len(ends) != len(line) or ends[-1] != len(own) - 1:
                each = [e.ids for e in self.merges.encode_batch_fast(line, add_special_tokens=False)]
                own, ends = np.array([i for e in each for i in e], np.uint32), np.cumsum([len(e) for e in each]) - 1
            ids.append(own)
            sizes.append(np.diff(ends, prepend=-1))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, words: list):
        """Ids of words that were numbered one after the other, up to the last number."""
        numbers, counts, other, pieces = [], [], [], self.pieces
        for at, word in enumerate(words):
            text = word.decode()
            if word.isalpha():
                numbers.append(pieces[text.lower()])
                counts.append(1)
            elif PLAIN.fullmatch(text) and "<|" not in text:  # special tokens are the whole tokenizer's
                own = PIECES.findall(text.lower())
                numbers += [pieces[p] for p in own]
                counts.append(len(own))
            else:
                counts.append(0)
                other.append((at, text))
        fresh = pieces.taken()
        if fresh:
            ids, sizes = self._encoded(fresh)
            first = len(pieces) - len(fresh)
            self.piece_starts, self.piece_sizes = _grown(self.piece_starts, len(pieces)), _grown(self.piece_sizes, len(pieces))
            self.piece_sizes[first : len(pieces)] = sizes
            self.piece_starts[first : len(pieces)] = self._store(ids) + np.cumsum(sizes) - sizes

        numbers, counts = np.array(numbers, np.int64), np.array(counts, np.int64)
        owner = np.repeat(np.arange(len(words)), counts)
        sizes = np.bincount(owner, self.piece_sizes[numbers], len(words)).astype(np.int64)
        starts = np.zeros(len(words), np.int64)
        alone = counts[owner] == 1
        starts[owner[alone]] = self.piece_starts[numbers[alone]]  # a word of one piece has its ids
        several, joined = np.flatnonzero(counts > 1), numbers[~alone]
        if len(several):
            ids = self.flat[_spans(self.piece_starts[joined], self.piece_sizes[joined])]
            starts[several] = self._store(ids) + np.cumsum(sizes[several]) - sizes[several]
        for (at, _), found in zip(other, self._batches(self.whole, (text for _, text in other), ENCODED)):
            starts[at], sizes[at] = self._store(np.array(found.ids, np.uint32)), len(found.ids)
        first, end = len(self.places) - len(words), len(self.places)
        self.starts, self.sizes, self.uses = (_grown(a, end) for a in (self.starts, self.sizes, self.uses))
        self.starts[first:end], self.sizes[first:end] = starts, sizes

    def numbers(self, words):
        """A number for each word, good until `of_numbers` is asked for the ids of all numbers given out."""
        return map(self.places.__getitem__, words)

    def of_numbers(self, numbers: array) -> tuple:
        """(ids of all the numbered words in order, number of ids of each)."""
        fresh = self.places.taken()
        if fresh:
            self._learn(fresh)
        at = np.frombuffer(numbers, np.int32)
        sizes = self.sizes[at]
        ids = self.flat[_spans(self.starts[at], sizes)]
        self.uses[: len(self.places)] += np.bincount(at, minlength=len(self.places))
        if len(self.places) > CACHE_WORDS:
            self._trim()
        return ids, sizes

    def ids(self, words: list) -> tuple:
        """(ids of all the words in order, number of ids of each)."""
        return self.of_numbers(array("i", self.numbers(words)))


SCHEMA = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def _packer(path, capacity, end, slack):
    def run(batches):
        from pyspark import TaskContext

        tokens = worker_cache("packing", (path, end), lambda: WordTokens(path, end))
        following = [TaskContext.get().partitionId() << 36]
        open_bins: dict = {}  # class: pieces of its open bin
        cuts: dict = {}  # pieces of a document by its length
        out = {f.name: [] for f in SCHEMA}

        def close(pieces):
            offset = 0
            for piece in pieces:
                for name, value in zip(out, (*piece, following[0], offset)):
                    out[name].append(value)
                offset += piece[2]
            following[0] += 1

        def texts():
            keys, words, ends = [], array("i"), []
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(at, SLICE_ROWS)
                    for key, text in zip(part.column("doc_id").to_pylist(), texts_of(part, "text")):
                        keys.append(key)
                        words.extend(tokens.numbers((text or b"").split()))
                        words.append(0)  # the closing id
                        ends.append(len(words))
                        if len(words) > HELD_WORDS:
                            yield keys, words, ends
                            keys, words, ends = [], array("i"), []
            if keys:
                yield keys, words, ends

        for keys, words, ends in texts():
            ids, sizes = tokens.of_numbers(words)
            ids = ids.astype("<u4", copy=False)
            bounds = np.cumsum(sizes)[np.array(ends) - 1].tolist()
            begin = 0
            for key, bound in zip(keys, bounds):
                size = bound - begin
                pieces = cuts.get(size)
                if pieces is None:
                    pieces = cuts[size] = cut_lengths(size, capacity, slack)
                start = 0
                for length, fit in pieces:
                    crc = zlib.crc32(ids[begin + start : begin + start + length])
                    bin_ = open_bins.setdefault(fit, [])
                    bin_.append((key, start, length, crc, size))
                    start += length
                    if len(bin_) == fit:
                        close(open_bins.pop(fit))
                begin = bound
                if len(out["doc_id"]) > 20_000:
                    yield as_batch(out, SCHEMA)
                    out = {f.name: [] for f in SCHEMA}
        # A class leaves one open bin at most: join them, largest first, where they fit.
        joined: list = []
        for pieces in sorted(open_bins.values(), key=lambda p: -sum(x[2] for x in p)):
            size = sum(x[2] for x in pieces)
            home = next((j for j in joined if j[0] + size <= capacity), None)
            if home is None:
                joined.append([size, pieces])
            else:
                home[0] += size
                home[1] = home[1] + pieces
        for _, pieces in joined:
            close(pieces)
        yield as_batch(out, SCHEMA)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, slack: float = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is the closing id alone. Rows with equal or null ids are documents of their own. Sequence
    ids hold the worker's partition, so that workers need no common counter; a task that runs again on the same
    split gives the same bins. An empty table gives no rows.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(_packer(tokenizer, capacity, end, slack), ", ".join(f"{f.name} long" for f in SCHEMA))
