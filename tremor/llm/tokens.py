"""Token ids of whole texts with the ``tokenizers`` library.

Byte-level BPE never merges across pre-tokens, and a pre-token starts at
every space that is followed by a character other than white space, so a
text's ids are the concatenated ids of the pieces between such spaces. Arrow
cuts a group of texts at its spaces and numbers the distinct pieces; each
Python worker encodes a distinct piece once (a bounded cache, emptied when
full) and assembles texts by array indexing. Texts with other runs of white
space around a space are split by the library's own pattern. Tests hold the
result against the library's ``encode``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CACHE_PIECES = 1_200_000


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Cache(dict):
    """Piece -> number; a new one is queued for encoding, with the space it follows."""

    def __init__(self, before: str, queue: list[str]):
        super().__init__()
        self.before, self.queue, self.done = before, queue, 0

    def __missing__(self, piece: str) -> int:
        number = self[piece] = self.done + len(self.queue)
        self.queue.append(self.before + piece)
        return number


class Encoder:
    def __init__(self, path: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        vocabulary = self.tokenizer.get_vocab()
        self.id_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():  # the byte-level alphabet has one character per byte
            self.id_bytes[number] = len(token)
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self._reset()

    def _reset(self) -> None:
        self.queue: list[str] = []
        self.spaced, self.plain = _Cache(" ", self.queue), _Cache("", self.queue)
        self.n_words = 0
        self.starts = np.zeros(1 << 12, np.int32)
        self.lengths = np.zeros(1 << 12, np.int32)
        self.flat = np.zeros(1 << 14, self.dtype)
        self.used = 0

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def _encoded(self, queue: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of the pieces.

        The library's fast form keeps no word numbers; an id stands for a known number of bytes, so the pieces' ends are
        found by their bytes. Should they not fall on ids, the library's full form tells the words.
        """
        fast = self.tokenizer.encode_batch_fast([queue], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(fast.ids, self.dtype)
        ends = np.cumsum(self.id_bytes[ids])
        wanted = np.cumsum(pc.binary_length(pa.array(queue, pa.large_string())).to_numpy())
        after = np.searchsorted(ends, wanted, "right")
        if len(ids) and after[-1] == len(ids) and after[0] > 0 and np.array_equal(ends[after - 1], wanted):
            return ids, np.diff(after, prepend=0)
        full = self.tokenizer.encode(queue, is_pretokenized=True, add_special_tokens=False)
        return np.array(full.ids, self.dtype), np.bincount(np.array(full.word_ids, np.int64), minlength=len(queue))

    def _learn(self) -> None:
        queue = self.queue
        ids, lengths = self._encoded(queue)
        total, n = len(ids), self.n_words + len(queue)
        self.starts, self.lengths = self._room(self.starts, n), self._room(self.lengths, n)
        self.flat = self._room(self.flat, self.used + total)
        self.lengths[self.n_words : n] = lengths
        self.starts[self.n_words : n] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + total] = ids
        self.n_words = self.spaced.done = self.plain.done = n
        self.used += total
        queue.clear()

    def _numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(piece numbers of all texts in order, pieces per text); Arrow cuts the texts and tells the distinct pieces,
        so that only those are looked up in Python."""
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        at, index, names = cut.offsets.to_numpy().astype(np.int64), coded.indices.to_numpy(), coded.dictionary
        one = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
        names = pc.binary_join(one, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")  # no piece holds a space
        counts, first = np.diff(at), at[:-1]
        # pieces with white space at an end: where two of them meet (an empty one meets any), the pattern's tokens may cross the space
        bare = np.array([k for k, x in enumerate(names) if not x or x != x.strip()], np.int64)
        head, tail, empty = np.zeros((3, len(names)), bool)
        head[bare] = [names[k][:1].isspace() for k in bare]
        tail[bare] = [names[k][-1:].isspace() for k in bare]
        empty[bare] = [not names[k] for k in bare]
        crossed = head[index]
        crossed[1:] &= tail[index[:-1]]
        crossed[first] = False
        odd = np.logical_or.reduceat(crossed | empty[index], first)
        usual = np.repeat(~odd, counts)
        spaced = usual.copy()
        spaced[first] = False
        used = np.zeros(len(names), bool)
        used[index[spaced]] = True
        used = np.flatnonzero(used)
        number = np.zeros(len(names), np.int32)
        number[used] = np.fromiter(map(self.spaced.__getitem__, map(names.__getitem__, used.tolist())), np.int32, len(used))
        mine, plain = number[index], self.plain.__getitem__
        begin = np.flatnonzero(~odd)
        mine[first[begin]] = [plain(names[k]) for k in index[first[begin]].tolist()]
        if len(begin) == len(texts):
            return mine, counts
        others = [self.split(texts[k]) for k in np.flatnonzero(odd).tolist()]
        counts[odd] = [len(x) for x in others]
        usual_now = np.repeat(~odd, counts)
        numbers = np.empty(len(usual_now), np.int32)
        numbers[usual_now] = mine[usual]
        numbers[~usual_now] = np.fromiter(map(plain, chain.from_iterable(others)), np.int32, len(usual_now) - int(usual_now.sum()))
        return numbers, counts

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids per text), each text followed by ``end_id``."""
        if self.n_words > CACHE_PIECES:
            self._reset()
        if not texts:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        numbers, counts = self._numbers(texts)
        if self.queue:
            self._learn()
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths, dtype=np.int64)
        at = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        at += np.arange(len(at))
        before = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        sizes = np.diff(before) + 1
        out = np.empty(len(at) + len(texts), self.dtype)
        last = np.cumsum(sizes) - 1
        keep = np.ones(len(out), bool)
        keep[last] = False
        out[keep], out[last] = self.flat[at], end_id
        return out, sizes


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder (its cache serves all tasks of the worker)."""
    return Encoder(path)


def text_groups(texts: list[str | None], limit: int = 1 << 21):
    """(first, end) of consecutive texts of about ``limit`` characters."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        size += len(t or "") + 1
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)
