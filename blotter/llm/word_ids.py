"""Ids of words that repeat: a worker's tables of what it has met, for any tokenizer.

``WordIds`` is for texts whose blanks stand alone: they are cut at every blank, a
word's UTF-8 bytes are packed into three integers together with its length, and
numpy finds all words of a batch in an open hash table of packed words. Packed
words are equal exactly if the words are, so no two words share ids by chance.
Longer words are encoded where they stand and not kept.

``PartIds`` is for texts given as lists of parts of any shape, by a dict.

Both call the tokenizer once for all new words of a batch. What they keep is
bounded, and when it is full they start afresh, which changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

PACKED = 23
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
Encode = Callable[[list[str]], list[bytes]]


def _distinct(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, and for every place the number of its key."""
    order = np.lexsort(keys)
    other = np.ones(len(order), bool)
    other[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(other) - 1
    return order[other], which


class WordIds:
    """``ids(texts)``: each text's ids as little-endian unsigned 32-bit bytes.

    A word is encoded with ``prefix`` before it, the first one of a text with
    ``first_prefix``; ``encode`` takes those strings.
    """

    def __init__(self, encode: Encode, prefix: str = "", first_prefix: str | None = None, kept: int = 1_200_000):
        self.encode, self.kept = encode, kept
        self.prefixes = (prefix, prefix if first_prefix is None else first_prefix)
        self.clear()

    def clear(self) -> None:
        self.count = 0
        self.slots = np.full(1 << 22, -1, np.int32)
        self.keys = [np.zeros(1 << 16, np.uint64) for _ in range(3)]
        self.ends = np.zeros((1 << 16) + 1, np.int64)  # word e has flat[ends[e]:ends[e + 1]]
        self.flat = np.zeros(1 << 17, np.uint32)

    def _find(self, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Entry of every packed word, -1 for none, and the slot where it is or belongs."""
        mask = np.uint64(len(self.slots) - 1)
        home = keys[0] * _MIX[0] ^ keys[1] * _MIX[1] ^ keys[2] * _MIX[2]
        slot = ((home ^ home >> np.uint64(29)) & mask).astype(np.int64)
        entry = self.slots[slot]
        todo = np.flatnonzero(entry >= 0)
        while len(todo):
            at = entry[todo]
            wrong = self.keys[0][at] != keys[0][todo]
            for own, key in zip(self.keys[1:], keys[1:]):
                wrong |= own[at] != key[todo]
            todo = todo[wrong]
            slot[todo] = (slot[todo] + 1) & int(mask)
            entry[todo] = self.slots[slot[todo]]
            todo = todo[entry[todo] >= 0]
        return entry, slot

    def _append(self, coded: list[bytes]) -> None:
        sizes = np.fromiter((len(c) // 4 for c in coded), np.int64, len(coded))
        base, total = int(self.ends[self.count]), int(sizes.sum())
        while len(self.ends) <= self.count + len(coded):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.keys = [np.concatenate([k, np.zeros_like(k)]) for k in self.keys]
        while len(self.flat) < base + total:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[base:base + total] = np.frombuffer(b"".join(coded), "<u4")
        self.ends[self.count + 1:self.count + 1 + len(coded)] = base + np.cumsum(sizes)
        self.count += len(coded)

    def _learn(self, raw: bytes, starts, ends, first) -> None:
        """New entries for these words, in their order."""
        self._append(self.encode([self.prefixes[k] + raw[a:b].decode()
                                  for a, b, k in zip(starts.tolist(), ends.tolist(), first.tolist())]))

    def _insert(self, keys: list[np.ndarray], entries: np.ndarray) -> None:
        for own, key in zip(self.keys, keys):
            own[entries] = key
        while len(entries):
            _, slot = self._find(keys)
            _, one = np.unique(slot, return_index=True)  # of words that want one free slot, one gets it
            self.slots[slot[one]] = entries[one]
            rest = np.ones(len(entries), bool)
            rest[one] = False
            keys, entries = [k[rest] for k in keys], entries[rest]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        if self.count > self.kept:
            self.clear()
        raw = (" ".join(texts) + " ").encode()
        data = np.frombuffer(raw + bytes(PACKED + 1), np.uint8)
        ends = np.flatnonzero(data[:len(raw)] == 32)
        starts = np.concatenate([[0], ends[:-1] + 1])
        size = ends - starts
        after = np.cumsum(np.fromiter((t.count(" ") + 1 for t in texts), np.int64, len(texts)))  # words up to each text's end
        first = np.zeros(len(ends), bool)
        if self.prefixes[0] != self.prefixes[1]:
            first[np.concatenate([[0], after[:-1]])] = True
        at = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))  # eight bytes from every place
        keys = [at[starts + 8 * j] & _MASKS[np.clip(size - 8 * j, 0, 8 if j < 2 else 7)] for j in range(3)]
        keys[2] |= (np.minimum(size, PACKED + 1).astype(np.uint64) | first.astype(np.uint64) << np.uint64(5)) << np.uint64(56)
        long = size > PACKED
        entry = self._find(keys)[0]
        entry[long] = -1
        missing = np.flatnonzero((entry < 0) & ~long)
        if len(missing):
            one, which = _distinct([k[missing] for k in keys])
            new = missing[one]
            entry[missing] = self.count + which
            self._learn(raw, starts[new], ends[new], first[new])
            self._insert([k[new] for k in keys], entry[new])
        count, missing = self.count, np.flatnonzero(long)
        if len(missing):
            entry[missing] = self.count + np.arange(len(missing))
            self._learn(raw, starts[missing], ends[missing], first[missing])
        begin = self.ends[entry]
        size = self.ends[entry + 1] - begin
        stop = np.cumsum(size)
        out = self.flat[np.repeat(begin - (stop - size), size) + np.arange(stop[-1])].tobytes()
        self.count = count  # long words go
        cuts = (4 * stop[after - 1]).tolist()
        return [out[a:b] for a, b in zip([0, *cuts], cuts)]


class PartIds:
    """``ids(texts)`` of texts given as their parts."""

    def __init__(self, encode: Encode, kept: int = 700_000, chars: int = 64):
        self.encode, self.kept, self.chars = encode, kept, chars
        self.known: dict[str, bytes] = {}

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        if len(self.known) > self.kept:
            self.known.clear()
        new = list(set().union(*texts).difference(self.known)) if texts else []
        self.known.update(zip(new, self.encode(new)))
        out = [b"".join(map(self.known.__getitem__, parts)) for parts in texts]
        for p in new:
            if len(p) > self.chars:  # encoded again where it comes again
                del self.known[p]
        return out
