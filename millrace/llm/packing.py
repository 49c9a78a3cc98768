"""Documents packed into training sequences, in their order.

The tokens of all documents of a partition, one after the other, are cut into
windows of at most ``size`` tokens.  Cuts may fall at the end of a document
(free), at the end of a sentence, or, inside long sentences only, every so
many tokens.  Dynamic programming picks the cuts with the least padding plus
penalties for cut documents and sentences: the best cost of ending a window at
a boundary is that boundary's penalty plus the least, over all boundaries at
most ``size`` before it, of their cost and the padding; a monotone queue keeps
that least, so each boundary is pushed and popped once.

A partition is read as a stream and solved in blocks: the last open window of
a block starts the next one, so memory is bounded and no window is short but a
partition's last.  No text is shuffled.

A null text counts as empty; an empty text has the end token only.  Nulls in
``doc_id`` are kept.  Repeated rows are packed as often as they come.  Other
columns are not looked at.  An empty table has no sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from millrace.llm.common import LETTER, mix, portions, powers_of, raw

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
SENTENCE_CUT = 2.0  # penalty, in tokens of padding, of a cut between sentences
WORD_CUT = 16.0  # and of one inside a sentence
_BLOCK = 1 << 18  # tokens solved at once
_TOGETHER = 1 << 20  # bytes of text whose runs are told apart together
_STEP = 32  # tokens between possible cuts inside a sentence
_NEAR = 8  # sentence ends nearer than this count as one
_KNOWN = 500_000  # runs remembered by a worker, some 100 bytes each
_SPACE, _LETTER_KIND, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER_KIND
_KIND[48:58] = _DIGIT
_STOP = np.zeros(256, bool)
_STOP[[*b".!?"]] = True
# Capitals of ASCII, and second bytes of the Latin ones.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32
_LOWERED[0x80:0x9F] += 32
_ONE_RUN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[\x21-\x26\x28-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+").fullmatch


def cut_points(places: list[int], penalties: list[float], size: int, last: bool) -> list[int]:
    """The places to cut at, by dynamic programming.

    ``places`` rise from 0 in steps of at most ``size``.  With ``last`` the
    final place ends the last window; without, the last window stays open and
    the last cut is where it starts.
    """
    cost, before = [0.0], [0]
    queue: deque[int] = deque([0])
    worth = [0.0]  # cost plus place: what a window that starts there adds to
    for j in range(1, len(places)):
        here = places[j]
        while here - places[queue[0]] > size:
            queue.popleft()
        i = queue[0]
        c = penalties[j] + worth[i] + size - here
        cost.append(c)
        before.append(i)
        w = c + here
        worth.append(w)
        while queue and worth[queue[-1]] >= w:
            queue.pop()
        queue.append(j)
    end = len(places) - 1
    if not last:
        near = [j for j in range(len(places)) if places[-1] - places[j] < size]
        end = min(near, key=lambda j: (cost[j], -j))
    cuts = []
    while end:
        cuts.append(places[end])
        end = before[end]
    return cuts[::-1]


class Tokens:
    """Token ids of texts.

    The tokenizer lower-cases a text, cuts it into runs of letters, single
    digits and runs of other signs, and encodes each run alone; no run goes
    over white space.  Here runs are found with array operations over the
    bytes of many texts, and each kind of run is encoded once and remembered
    (a bounded number of them).  A word with a sign outside plain Latin text,
    with an apostrophe or with part of a special token is left whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for word, k in vocabulary.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.ids = np.zeros(1 << 16, "<u4")
        self.stops = np.zeros(1 << 14, np.int64)  # where each known run's ids end; the first is empty
        self.used = 0

    def _keep(self, ids: np.ndarray, counts: np.ndarray, hashes: list[int]) -> None:
        n, at = len(self.known), self.used
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(counts) + 1 > len(self.stops):
            self.stops = np.concatenate([self.stops, np.zeros_like(self.stops)])
        self.ids[at : at + len(ids)] = ids
        self.stops[n + 1 : n + 1 + len(counts)] = at + np.cumsum(counts)
        self.used = at + len(ids)
        self.known.update(zip(hashes, range(n, n + len(hashes)), strict=True))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, runs: list[bytes], hashes: list[int]) -> None:
        for at in range(0, len(runs), 1000):
            some = [r.decode("utf-8", "replace") for r in runs[at : at + 1000]]
            # A run's ids end with the first that ends a word.
            ids = np.array(self._encode([" ".join(some)])[0], "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some) and stops[-1] == len(ids) and all(map(_ONE_RUN, some)):
                counts = np.diff(stops, prepend=0)
            else:
                found = self._encode(some)
                counts = np.array([len(x) for x in found])
                ids = np.array([k for x in found for k in x], "<u4")
            self._keep(ids, counts, hashes[at : at + 1000])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
        """Ids of all texts together, each text's number of ids, and the
        places in it where a sentence or line ends."""
        data = np.frombuffer(b"\n".join(texts) + b"\n\n", np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        kind = _KIND[data]
        before, after = np.roll(data, 1), np.roll(data, -1)
        latin = (data == 0xC3) & (after >= 0x80) & (after != 0x97) & (after != 0xB7)
        odd = (data >= 0x80) & ~latin & ~np.roll(latin, 1)
        odd |= (data == 0x27) | ((data == 0x3C) & (after == 0x7C))
        odd |= (data < 0x20) & (kind != _SPACE) | (data == 0x7F)
        inside = kind != _SPACE
        starts_word = inside & (kind[np.arange(len(kind)) - 1] == _SPACE)
        starts_word[0] = inside[0]
        word = np.cumsum(starts_word)
        whole = np.zeros(int(word[-1]) + 1, bool)
        whole[word[odd]] = True
        whole = whole[word]
        starts = np.flatnonzero(starts_word | (inside & ~whole & ((kind != np.roll(kind, 1)) | (kind == _DIGIT))))
        if not len(starts):
            return np.zeros(0, "<u4"), np.zeros(len(texts), np.int64), [[] for _ in texts]
        stops_byte = np.flatnonzero(~inside)
        gap = stops_byte[np.searchsorted(stops_byte, starts)]
        ends = np.minimum(gap, np.append(starts[1:], len(data)))
        plain = np.where(whole, data, _LOWERED[data])
        powers, inverse = powers_of(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(LETTER[plain] * powers, out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
        kinds, first, each = np.unique(hashes, return_index=True, return_inverse=True)
        listed = kinds.tolist()
        new = [i for i, h in enumerate(listed) if h not in self.known]
        if len(self.known) + len(new) > _KNOWN:
            self._forget()
            new = list(range(len(listed)))
        if new:
            bytes_ = plain.tobytes()
            where = first[new]
            self._learn([bytes_[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)], [listed[i] for i in new])
        known = np.fromiter(map(self.known.__getitem__, listed), np.int64, len(listed))[each]
        begin, counts = self.stops[known], self.stops[known + 1] - self.stops[known]
        total = np.cumsum(counts)
        ids = self.ids[np.repeat(begin - (total - counts), counts) + np.arange(int(total[-1]))]
        text_of = np.searchsorted(np.cumsum(sizes), starts, "right")
        per_text = np.bincount(text_of, counts, len(texts)).astype(np.int64)
        ahead = (np.cumsum(per_text) - per_text)[text_of]
        line = np.cumsum(data == 10)[starts]
        sentence = _STOP[data[ends - 1]] & ~inside[ends]
        sentence[:-1] |= line[1:] > line[:-1]
        places, owner = (total - ahead)[sentence], text_of[sentence]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        listed_places = places.tolist()
        return ids, per_text, [listed_places[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_TOKENS: dict[str, Tokens] = {}


def _tokens(path: str) -> Tokens:
    if path not in _TOKENS:
        _TOKENS[path] = Tokens(path)
    return _TOKENS[path]


class _Stream:
    """The open documents of a partition and the boundaries in them."""

    def __init__(self, size: int, sequences: int):
        self.size, self.sequence = size, sequences
        self.documents: deque[tuple] = deque()  # (doc_id, ids, place of its first id)
        self.places, self.penalties = [0], [0.0]
        self.rows: list[tuple] = []

    def add(self, doc_id, ids: bytes, sentences: list[int]) -> None:
        """A document's ids, its end's included, and where sentences end."""
        first = self.places[-1]
        size = len(ids) >> 2
        place, places, penalties = 0, self.places, self.penalties
        for stop in sentences:
            while stop - place > 2 * _STEP:
                place += _STEP
                places.append(first + place)
                penalties.append(WORD_CUT)
            if stop - place >= _NEAR and stop < size - 1:  # not between the text and its end
                place = stop
                places.append(first + place)
                penalties.append(SENTENCE_CUT)
        while size - place > 2 * _STEP:
            place += _STEP
            places.append(first + place)
            penalties.append(WORD_CUT)
        places.append(first + size)
        penalties.append(0.0)
        self.documents.append((doc_id, ids, first))

    def cut(self, last: bool) -> None:
        """Solves what is open, writes full windows, keeps the open one."""
        cuts = cut_points(self.places, self.penalties, self.size, last)
        start = 0
        for stop in cuts:
            at = start
            while at < stop:
                doc_id, ids, first = self.documents[0]
                n = len(ids) >> 2
                upto = min(stop, first + n)
                piece = ids[(at - first) << 2 : (upto - first) << 2]
                self.rows.append((doc_id, at - first, upto - at, zlib.crc32(piece), n, self.sequence, at - start))
                at = upto
                if upto == first + n:
                    self.documents.popleft()
            start = stop
            self.sequence += 1
        kept = [(p - start, c) for p, c in zip(self.places, self.penalties, strict=True) if p > start]
        self.places, self.penalties = [0, *(p for p, _ in kept)], [0.0, *(c for _, c in kept)]
        self.documents = deque((d, ids, first - start) for d, ids, first in self.documents)

    def taken(self) -> pa.RecordBatch:
        names = [c.split()[0] for c in PIECES.split(", ")]
        columns = list(zip(*self.rows, strict=True)) or [[] for _ in names]
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def pack(documents: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """One row for each piece of a document in a sequence.

    ``sequence_id`` tells the partition and the sequence in it, as
    ``monotonically_increasing_id`` does; ``offset`` is the piece's place in
    the sequence.  A task that is run again gives the same rows.
    """
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(vocabulary)
        stream = _Stream(size, (TaskContext.get().partitionId()) << 33)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), raw(batch.column(1))
            for some in portions(texts, _TOGETHER):
                ids, counts, sentences = tokens.encode([t or b"" for t in texts[some]])
                data, at = ids.tobytes(), 0
                for doc_id, count, ends in zip(names[some], counts.tolist(), sentences, strict=True):
                    stream.add(doc_id, data[at << 2 : (at + count) << 2] + end, ends)
                    at += count
                    if stream.places[-1] >= _BLOCK:
                        stream.cut(last=False)
            if stream.rows:
                yield stream.taken()
        if stream.documents:
            stream.cut(last=True)
        if stream.rows:
            yield stream.taken()

    from pyspark.sql import functions as F

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)
