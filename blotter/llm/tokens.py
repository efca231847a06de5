"""Token ids of texts with the ``tokenizers`` library, word by word.

A byte-level BPE vocabulary splits a text into pieces before it merges
anything. A run of blanks always starts a new piece, and so does punctuation
right after letters. A text may be cut at such places, the parts encoded apart,
and the ids joined: the result is the same as for the whole text. Words repeat,
hence each worker keeps the ids of what it has met (:mod:`blotter.llm.word_ids`)
and calls the library for new words only, many at a time.

Texts where every blank stands alone are cut before each blank first, and only
new words are cut further; others are cut at the ends of all runs and words; texts with other white space than blank, tab, CR and
LF are encoded whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

from .word_ids import PartIds, WordIds

#: Blanks and Latin letters before ASCII punctuation, or blanks and what follows up to the next blank.
PARTS = re.compile(r"[ \t\n\r]*[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u02af]++(?=[!-/:-@\[-`{-~])"
                   r"|[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
BLANKS = " \t\n\r"
OTHER_SPACE = "".join(map(chr, (0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: A blank that may not stand alone.
RUNS = ("  ", "\n ", "\t ", "\r ")
#: Longer rows take longer per word.
WORDS_IN_A_ROW = 100


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """``ids(texts)``: for each text its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.vocabulary = self.tokenizer.get_vocab_size()
        # a byte-level token is spelled with one character per byte
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)
        self.parts = PartIds(self._encode_parts)
        self.words = WordIds(lambda words: self.parts.ids([PARTS.findall(w) for w in words]), prefix=" ", first_prefix="")

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a blank and end without one: encoded in rows, cut by their bytes.

        One call for many words costs half as much as a call for each.
        """
        rows = ["".join(words[at:at + WORDS_IN_A_ROW]) for at in range(0, len(words), WORDS_IN_A_ROW)]
        data = b"".join(self._encode(rows))
        ends = np.cumsum(self.token_bytes[np.frombuffer(data, "<u4")])
        stops = np.cumsum(np.fromiter((len(w.encode()) for w in words), np.int64, len(words)))
        cuts = np.searchsorted(ends, stops)
        if len(words) and not (cuts[-1] < len(ends) and np.array_equal(ends[cuts], stops)):
            return self._encode(words)  # no cut there after all: each by itself
        cuts = (4 * cuts + 4).tolist()
        return [data[i:j] for i, j in zip([0, *cuts], cuts)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        led = [p[0] in BLANKS and p[-1] not in BLANKS for p in parts]
        words = iter(self._encode_words([p for p, w in zip(parts, led) if w]))
        others = iter(self._encode([p for p, w in zip(parts, led) if not w]))
        return [next(words if w else others) for w in led]

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole, parted, worded = [], [], []
        for i, t in enumerate(texts):
            if any(c in t for c in OTHER_SPACE):
                whole.append(i)
            elif any(r in t for r in RUNS):
                parted.append(i)
            else:
                worded.append(i)
        for some, ids in ((whole, self._encode([texts[i] for i in whole])),
                          (parted, self.parts.ids([PARTS.findall(texts[i]) for i in parted])),
                          (worded, self.words.ids([texts[i] for i in worded]))):
            for i, x in zip(some, ids):
                out[i] = x
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


def text_batches(texts, ids=None, batch_bytes: int = 2_000_000):
    """Slices (start, stop) of a list of texts, each of about ``batch_bytes`` characters."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= batch_bytes:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
