"""Hierarchical packing of token ids into windows of several context sizes.

Tiers are context sizes, each a power of two (2048, 1024, ... by default). Every
task packs the documents of its own input split, in one streaming pass:

1. *Route.* A document longer than the longest tier fills whole windows of it;
   what is left, and every shorter document, goes to the smallest tier that
   holds it.
2. *Pack each tier*, longest first: a window starts with the longest waiting
   document of its tier.
3. *Fill the gap* from the same and shorter tiers: always the longest waiting
   piece that fits; when none fits, the shortest waiting piece is cut at the
   gap's end and its rest waits in the tier of its new length.
4. *Close the split.* When nothing is left to fill a gap, the open window is
   split at the tier sizes, longest first, and a last rest below the smallest
   tier at smaller powers of two. So no window of a split is padded.
5. *Balance step groups.* Windows are emitted longest first in rounds, and a
   step group closes whenever ``step_tokens`` are reached. As tiers are powers
   of two, each step group holds the same number of tokens but for a split's
   last one.

No shuffle is needed, and the state is one buffer of waiting documents
(``buffer_tokens``). Window ids are the split's number times 2^32 plus a count,
so they are unique without any global step; a task that is run again reads the
same split and gives the same windows.

Nulls and edges: a null text is an empty one and packs as its end id alone; a
null document id is kept as null; repeated rows pack once each; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_or_empty
from .tokens import default_vocabulary, encoder, text_batches

TIERS = (2048, 1024, 512, 256, 128, 64)
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long")


class _Packer:
    """Waiting pieces (document index, start, length) and the windows made of them."""

    def __init__(self, tiers):
        self.tiers = sorted(tiers, reverse=True)
        self.waiting: list[tuple[int, int, int]] = []  # (length, document, start), ascending
        self.windows: list[list[tuple[int, int, int]]] = []

    def add(self, doc: int, n: int) -> None:
        top, start = self.tiers[0], 0
        while n - start >= top:
            self.windows.append([(doc, start, top)])
            start += top
        if n > start:
            insort(self.waiting, (n - start, doc, start))

    def tier_of(self, length: int) -> int:
        return next(t for t in reversed(self.tiers) if t >= length)

    def pack(self, all_of_it: bool) -> None:
        """Make windows until one could not be filled; then close it or keep its pieces waiting."""
        while self.waiting:
            length, doc, start = self.waiting.pop()
            size = self.tier_of(length)
            window, gap = [(doc, start, length)], size - length
            while gap and self.waiting:
                at = bisect_right(self.waiting, (gap, 1 << 62, 0))
                if at:
                    n, d, s = self.waiting.pop(at - 1)
                else:
                    whole, d, s = self.waiting.pop(0)
                    n = gap
                    insort(self.waiting, (whole - n, d, s + n))
                window.append((d, s, n))
                gap -= n
            if not gap:
                self.windows.append(window)
            elif all_of_it:
                self.close(window)
            else:
                for d, s, n in window:
                    insort(self.waiting, (n, d, s))
                return

    def close(self, window) -> None:
        left = sum(n for _, _, n in window)
        pieces = window[::-1]
        powers = [1 << k for k in reversed(range(self.tiers[-1].bit_length() - 1))]
        for size in self.tiers + powers:
            while left >= size:
                made, room = [], size
                while room:
                    d, s, n = pieces.pop()
                    if n > room:
                        pieces.append((d, s + room, n - room))
                        n = room
                    made.append((d, s, n))
                    room -= n
                self.windows.append(made)
                left -= size


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   vocabulary: str | None = None, end_id: int = 1, tiers=TIERS,
                   buffer_tokens: int = 4_000_000, step_tokens: int = 64 * 2048,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place in it, window (``sequence_id``), place there, tier, step group.

    ``ids_crc32`` is the unsigned crc32 of the piece's ids as little-endian
    unsigned 32-bit integers; with ``with_ids`` the ids themselves follow in ``ids``.
    """
    if any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    vocabulary = vocabulary or default_vocabulary()
    plain = pick(docs, id=id_col, text=text_col).select(
        F.col("id").cast("long").alias("id"), text_or_empty().alias("text"))

    def pack(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        enc, end = encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        held: dict[int, tuple] = {}  # document index -> (id, its ids as bytes)
        packer, state = _Packer(tiers), {"seq": 0, "step": 0, "room": step_tokens, "doc": 0, "tokens": 0}

        def emit():
            rows = []
            for window in sorted(packer.windows, key=lambda w: -sum(p[2] for p in w)):
                size = sum(p[2] for p in window)  # a tier, or a smaller power of two
                if size > state["room"]:
                    state["step"], state["room"] = state["step"] + 1, step_tokens
                state["room"] -= size
                at = 0
                for doc, start, n in window:
                    doc_id, data = held[doc]
                    part = data[4 * start:4 * (start + n)]
                    rows.append((doc_id, start, n, zlib.crc32(part), len(data) // 4, base + state["seq"], at,
                                 size, base + state["step"], part))
                    at += n
                state["seq"] += 1
            packer.windows = []
            for a in range(0, len(rows), 10_000):
                cols = list(zip(*rows[a:a + 10_000]))
                arrays = [pa.array(c, pa.int64()) for c in cols[:7]] + [
                    pa.array(cols[7], pa.int32()), pa.array(cols[8], pa.int64())]
                if with_ids:
                    ids = [np.frombuffer(x, "<u4").astype("i4") for x in cols[9]]
                    arrays.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=NAMES + ["ids"] * with_ids)

        def flush(all_of_it):
            packer.pack(all_of_it)
            yield from emit()
            left = {d for _, d, _ in packer.waiting}
            for d in [d for d in held if d not in left]:
                state["tokens"] -= len(held.pop(d)[1]) // 4

        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            for a, b in text_batches(texts):
                for doc_id, data in zip(ids[a:b], enc.ids(texts[a:b])):
                    k = state["doc"] = state["doc"] + 1
                    held[k] = (doc_id, data + end)
                    packer.add(k, len(data) // 4 + 1)
                    state["tokens"] += len(data) // 4 + 1
                if state["tokens"] >= buffer_tokens:
                    yield from flush(False)
        yield from flush(True)

    return plain.mapInArrow(pack, PIECES + (", ids array<int>" if with_ids else ""))


NAMES = [c.split()[0] for c in PIECES.split(", ")]
