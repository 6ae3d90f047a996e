"""Token ids of whole texts by the ``tokenizers`` library, with a word cache.

For vocabularies that drop white space and lower the case (``word_bpe_49k``).
Their rules never build a token across white space, nor across the
border between an ASCII letter and ASCII punctuation other than an apostrophe,
so a text's ids are its pieces' ids in order. Each task keeps a table from a
piece's 64-bit hash to its ids: the library sees a piece when the table lacks
it, and numpy joins the ids. Texts that hold one of the vocabulary's special
strings go to the library whole. The table's size is bounded; a full one
starts anew. It stays with the worker, some 24 MB a core.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa

from wearlog.llm.words import LOWER, SMALL_CHUNK, WHITE, chunks, hash_spans

SLOTS = 1 << 20
STORE = 1 << 22
OTHER, BLANK, LETTER, MARK = 0, 1, 2, 3
KIND = np.zeros(256, np.uint8)
KIND[WHITE] = BLANK
KIND[97:123] = LETTER
KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = MARK
PLAIN = re.compile(r"[a-z]+|[!-&(-/:-@\[-`{-~]+")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class TextEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.special = [t.content.lower().encode() for t in self.library.get_added_tokens_decoder().values()]
        self.kind = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int32)
        self.size = np.zeros(SLOTS, np.int32)
        self.store = np.zeros(STORE, self.kind)
        self.used = 0

    def piece(self, word: str) -> list[int]:
        """Ids of one piece: by the model where the word is surely one unit for it, else by all of the library's steps."""
        if PLAIN.fullmatch(word):
            return [t.id for t in self.library.model.tokenize(word)]
        if word.isalpha() and max(word) < "̀" and word.lower() == word:
            return [t.id for t in self.library.model.tokenize(self.bytes_of(word)[0][0])]
        return self.library.encode(word, add_special_tokens=False).ids

    def learn(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray, keys: np.ndarray) -> None:
        flat, sizes = [], np.empty(len(keys), np.int32)
        for i, (s, n) in enumerate(zip(starts.tolist(), lens.tolist(), strict=True)):
            ids = self.piece(data[s : s + n].tobytes().decode("utf-8", "replace"))
            flat += ids
            sizes[i] = len(ids)
        if self.used + len(flat) > len(self.store):
            grown = np.zeros(max(2 * len(self.store), self.used + len(flat)), self.kind)
            grown[: self.used] = self.store[: self.used]
            self.store = grown
        self.store[self.used : self.used + len(flat)] = flat
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        self.keys[slot], self.size[slot] = keys, sizes
        self.at[slot] = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)

    def _cached(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = LOWER[raw]
        kind = KIND[data]
        ink = kind != BLANK
        fresh = np.zeros(len(data) + 1, bool)
        fresh[bounds] = True
        cut = fresh[1:-1] | (kind[:-1] + kind[1:] == LETTER + MARK) & (kind[:-1] >= LETTER) & (kind[1:] >= LETTER)
        edge = np.ones(len(data), bool)
        edge[1:] = cut | ~ink[:-1]
        starts = np.flatnonzero(ink & edge)
        edge[-1], edge[:-1] = True, cut | ~ink[1:]
        lens = np.flatnonzero(ink & edge) - starts + 1
        keys = hash_spans(data, starts, lens) | np.uint64(1 << 63)
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        at, size = np.empty(len(keys), np.int32), np.empty(len(keys), np.int32)
        todo = np.arange(len(keys))
        if self.used > STORE // 2:
            self.clear()
        while len(todo):
            hit = self.keys[slot[todo]] == keys[todo]
            got = todo[hit]
            at[got], size[got] = self.at[slot[got]], self.size[slot[got]]
            todo = todo[~hit]
            if len(todo):
                new, first = np.unique(keys[todo], return_index=True)
                # one piece a slot at a time; the others of that slot come in the next turn
                _, one = np.unique(new & np.uint64(SLOTS - 1), return_index=True)
                pick = todo[first[one]]
                self.learn(data, starts[pick], lens[pick], new[one])
        end = np.cumsum(size, dtype=np.int64)
        ids = self.store[np.repeat(at - (end - size), size) + np.arange(end[-1] if len(end) else 0)]
        upto = np.concatenate([[0], end])[np.searchsorted(starts, bounds)]
        return ids, upto

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the n + 1 positions that bound each text's ids."""
        if not len(raw):
            return np.zeros(0, self.kind), np.zeros(len(bounds), np.int64)
        low = LOWER[raw].tobytes()
        if not any(s in low for s in self.special):
            return self._cached(raw, bounds)
        parts = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if a == b:
                parts.append(np.zeros(0, self.kind))
            elif any(low.find(s, a, b) >= 0 for s in self.special):
                text = raw[a:b].tobytes().decode("utf-8", "replace")
                parts.append(np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind))
            else:
                parts.append(self._cached(raw[a:b], np.array([0, b - a]))[0])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> TextEncoder:
    """The task's encoder; one stays with a Python worker across its tasks."""
    return TextEncoder(path)


def encode_column(col: pa.Array, path: str, end_id: int):
    """Yields (first row, end row, ids, bounds): every whole text's ids followed by ``end_id``."""
    tool = encoder(path)
    for first, end, raw, bounds in chunks(col, SMALL_CHUNK):
        ids, at = tool.encode(raw, bounds)
        at = np.asarray(at, np.int64)
        out = np.full(len(ids) + end - first, end_id, tool.kind)
        own = np.ones(len(out), bool)
        own[at[1:] + np.arange(end - first)] = False
        out[own] = ids
        yield first, end, out, at + np.arange(end - first + 1)
