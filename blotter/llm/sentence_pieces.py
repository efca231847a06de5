"""SentencePiece ids of whole texts by a table of distinct marked words, and back.

SentencePiece turns blanks into markers, puts one in front, and merges pieces. If
no piece of the vocabulary holds a marker behind another character, no merge
crosses from one marked word (a run of markers and what follows up to the next)
to another: the ids of a text are the ids of its marked words, one after another.

1. The marked words of all texts are counted: tasks count what they read, Spark
   adds the counts per word.
2. The most frequent ones, ``table_words`` at most and of at most ``table_chars``
   characters, are segmented once, by Spark tasks, and written: the table that
   every worker gets. Those two parameters bound its size, whatever the input.
3. Texts are read again in batches. The distinct words of a batch that the table
   lacks are segmented once and kept in the worker's own table (up to
   ``worker_words``, then it starts afresh from the common one), and every text
   gets its words' ids joined by position (:mod:`blotter.llm.word_ids`).

Words in the table or not, their ids come from the same call, so the bounds
change no result. Texts do not move; the shuffle holds one row per task and
distinct word. Counting is a pass over the texts, which only serves workers that
would each segment the frequent words again.

Whether words can be cut is found from the vocabulary and, for the normaliser,
from what it does to every character; for a model where they cannot, texts are
segmented whole.

Nulls and edges: a null text is an empty one and has no ids; blanks in runs, at
the start and at the end belong to the word behind them or stand alone; a marker
character in the text counts as a blank, as in the library; very long texts and
words go through whole; a null or repeated id is a row like any other; an empty
table gives no rows. Columns that are not named are ignored.
"""

from __future__ import annotations

import re
import uuid
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stored, text_or_empty
from .tokens import text_batches
from .word_ids import PartIds, WordIds

MARKER = "▁"
WORDS = re.compile(" +[^ ]*")
#: Distinct words that a task holds while it counts.
COUNTED = 300_000
BEFORE = "a"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def marked_words(text: str) -> list[str]:
    """The marked words in order, each without its first marker and with blanks for the others."""
    text = text.replace(MARKER, " ")
    if not text:
        return []
    if text[0] == " " or "  " in text:
        return [w[1:] for w in WORDS.findall(" " + text)]
    return text.split(" ")


class Segmenter:
    """A worker's model and the tables of what it has segmented; ids are little-endian unsigned 32-bit bytes."""

    def __init__(self, model: str, table: dict[str, bytes] | None = None, worker_words: int = 1_500_000):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        self.table, self.worker_words = table or {}, worker_words
        self.lead = len(self.model.encode(BEFORE, num_threads=1))
        self.apart = self._apart()
        self.words = WordIds(self._known, kept=len(self.table) + worker_words)
        self.parts = PartIds(self.segment, kept=worker_words)

    def _apart(self) -> bool:
        """Whether marked words can be segmented one by one."""
        m = self.model
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_byte(i))]
        if any(re.search(f"[^{MARKER}]{MARKER}", p) for p in pieces):
            return False
        if any(m.is_unused(i) for i in range(m.get_piece_size())):
            return False
        every = "".join(c + "a  b " for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff")
        return m.normalize(every) == MARKER + every.replace(" ", MARKER)  # words begin with a marker, nothing else changes

    def segment(self, words: list[str]) -> list[bytes]:
        coded = self.model.encode([f"{BEFORE} {w}" for w in words], num_threads=1)
        return [array("I", ids[self.lead:]).tobytes() for ids in coded]

    def _known(self, words: list[str]) -> list[bytes]:
        new = [w for w in words if w not in self.table]
        made = dict(zip(new, self.segment(new)))
        return [made[w] if w in made else self.table[w] for w in words]

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        if not self.apart:
            return [array("I", ids).tobytes() for ids in self.model.encode(texts, num_threads=1)]
        plain, parted = [], []
        for i, t in enumerate(texts):
            if t:
                (parted if t[0] == " " or "  " in t or MARKER in t else plain).append(i)
        for some, ids in ((plain, self.words.ids([texts[i] for i in plain])),
                          (parted, self.parts.ids([marked_words(texts[i]) for i in parted]))):
            for i, x in zip(some, ids):
                out[i] = x
        return out

    def text(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


_WORKER: dict[tuple, Segmenter] = {}


def segmenter(model: str, name: str = "", table=None, worker_words: int = 1_500_000) -> Segmenter:
    """One segmenter per worker process, model and table; ``table`` is a broadcast of (word, ids)."""
    key = (model, name, worker_words)
    if key not in _WORKER:
        _WORKER.clear()  # a worker serves one table at a time
        _WORKER[key] = Segmenter(model, dict(table.value) if table else None, worker_words)
    return _WORKER[key]


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): how often each marked word occurs in all texts."""
    def count(batches):
        seen: Counter[str] = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                               names=["word", "n"])
            seen.clear()
            return batch
        for batch in batches:
            for text in batch.column("text").to_pylist():
                seen.update(marked_words(text))
                if len(seen) > COUNTED:
                    yield rows()
        yield rows()

    texts = pick(docs, text=text_col).select(text_or_empty().alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, model: str, *, text_col: str = "text", table_words: int = 100_000,
               table_chars: int = 64) -> DataFrame:
    """(word, n, ids): the most frequent marked words, each segmented once; ids as bytes."""
    counts = stored(word_counts(docs, text_col).filter((F.col("n") > 1) & (F.char_length("word") <= table_chars)), "word-counts")
    often = counts.groupBy("n").agg(F.count("*").alias("words"))  # as many rows as there are different counts
    up_to = F.sum("words").over(Window.orderBy(F.desc("n")))
    least = often.select("n", up_to.alias("up_to")).filter(F.col("up_to") <= table_words).agg(F.min("n")).first()[0]
    frequent = counts.filter(F.col("n") >= F.lit(least).cast("long"))

    def code(batches):
        own = segmenter(model)
        for batch in batches:
            ids = own.segment(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    return stored(frequent.mapInArrow(code, "word string, n long, ids binary"), "word-table")


def sentence_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
                    table_words: int = 100_000, table_chars: int = 64, worker_words: int = 1_500_000) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of every row, as the library's encode and decode give them."""
    model = model or default_model()
    rows = pick(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty().alias("text"))
    table = word_table(docs, model, text_col=text_col, table_words=table_words, table_chars=table_chars)
    # at most table_words rows of table_chars characters
    words = docs.sparkSession.sparkContext.broadcast([(r.word, bytes(r.ids)) for r in table.select("word", "ids").collect()])
    name = uuid.uuid4().hex

    def code(batches):
        own = segmenter(model, name, words, worker_words)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in text_batches(texts):
                coded = own.ids(texts[a:b])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in coded])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.ListArray.from_arrays(offsets, values),
                     pa.array([own.text(x) for x in coded], pa.string())], names=["doc_id", "ids", "decoded"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(code, f"doc_id {kind}, ids array<int>, decoded string")
