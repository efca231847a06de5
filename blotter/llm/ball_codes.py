"""Vector code compression: product codes whose codebooks are trained by ball k-means.

Components become integers (``floor(scale * x)``), a vector is cut into equal
parts, and each part position has a codebook of a few entries. Training repeats:
assign every part to the nearest entry, replace each entry by the floored mean
of its parts. All arithmetic is exact, so results do not depend on how rows are
spread over tasks.

Ball k-means (Xia et al., "A Fast Adaptive k-means with No Bounds", 2020) keeps
the assignment between rounds. The parts of an entry are a ball around it, whose
radius is the largest distance of its members, taken over the members that a
task holds in one batch. Only entries closer to the ball's entry than twice the
radius are its neighbours; a ball without neighbours, or whose entry and
neighbours did not move, stays as it is. Half the distances to the neighbours
cut the ball into a stable core and rings around it: the core's members stay
without any comparison, a member in ring t is compared with the t nearest
neighbours only. In whole numbers: an entry whose squared distance to the ball's
entry exceeds four times the member's own squared distance is farther away than
the ball's entry, and cannot tie with it.

On Spark a round is one pass over the vectors: Arrow batches come with the codes
of the last round, leave with new ones, and each batch adds its sums per entry.
The table is written (no shuffle, a lost executor costs its tasks of one round),
then only the sums are read back and added up by Spark; the driver gets at most
parts x entries x part width numbers. The first entries are the parts of the
``entries`` smallest ids.

Nulls and edges: rows whose vector is null or holds a null, NaN or infinite
component are dropped. Null ids and labels are kept; a null id ranks behind all
others when the first entries are chosen, equal ids rank by their components.
Shorter vectors than the longest count as filled up with zeros, and so does a
length that the number of parts does not divide; empty vectors have code 0
everywhere. Fewer rows than ``entries`` make smaller codebooks. Components of any
size are exact (large ones by Python integers); an error beyond 64 bits is null.
An empty table gives no rows and empty codebooks. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import pick, stored

EXACT = 1 << 53  # whole numbers below it are exact in double precision
LIMB = 1 << 40  # sums beyond it travel in pieces of 32 bits
SUMS = "array<struct<place:long,limb:int,value:long>>"


def _whole(x: float, scale: int) -> int:
    return math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale


def whole_parts(column: pa.ListArray, parts: int, width: int, scale: int, largest: int) -> np.ndarray:
    """The batch's vectors as whole numbers, (rows, parts, width of a part).

    Doubles where every sum of products with numbers up to ``largest`` stays
    exact, otherwise Python integers.
    """
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    filled = np.zeros((len(lengths), parts * width))
    filled[np.arange(parts * width) < lengths[:, None]] = flat
    most = max(largest, scale * (np.abs(flat).max() if len(flat) else 0) + 1)
    if 16 * max(width, 1) * most * most < EXACT:
        whole = np.floor(filled * scale)
    else:
        whole = np.array([_whole(x, scale) for x in filled.ravel().tolist()], object)
    return whole.reshape(len(lengths), parts, width)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each row's nearest entry (the lower one of a tie) and its squared distance."""
    d = (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best]


def ball_step(x: np.ndarray, book: np.ndarray, moved: list[bool], code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``nearest`` for rows whose nearest entry was ``code`` before the entries ``moved``."""
    gaps = ((book[:, None] - book[None]) ** 2).sum(2)
    distance = ((x - book[code]) ** 2).sum(1)
    old, code = code, code.copy()
    for i in np.unique(old):
        ball = np.flatnonzero(old == i)
        reach = 4 * distance[ball]
        near = sorted((gaps[i, j], j) for j in range(len(book))
                      if j != i and gaps[i, j] <= reach.max() and (moved[i] or moved[j]))
        if not near:
            continue  # the ball is stable
        ring = np.searchsorted(np.array([g for g, _ in near], book.dtype), reach, side="right")  # 0 is the core
        found, d = np.full(len(ball), i), distance[ball]
        for t, (_, j) in enumerate(near):
            at = np.flatnonzero(ring > t)
            other = ((x[ball[at]] - book[j]) ** 2).sum(1)
            better = (other < d[at]) | ((other == d[at]) & (j < found[at]))
            found[at[better]], d[at[better]] = j, other[better]
        code[ball], distance[ball] = found, d
    return code, distance


def _pieces(value: int):
    """A whole number as (limb, piece): pieces add up apart, and sum(piece << 32 * limb) is the number."""
    limb = 0
    while not -LIMB <= value < LIMB:
        yield limb, value & 0xFFFFFFFF
        value >>= 32
        limb += 1
    yield limb, value


def _sums(x: np.ndarray, codes: np.ndarray, entries: int) -> list[dict]:
    """Components' sums and rows per (part, entry), by place; counts stand behind all sums."""
    parts, width = x.shape[1:]
    out = []
    for p in range(parts):
        count = np.bincount(codes[:, p], minlength=entries)
        member = np.arange(entries)[:, None] == codes[:, p]
        total = member.astype(x.dtype) @ x[:, p]
        for e in np.flatnonzero(count):
            at = p * entries + int(e)
            out += [{"place": at * width + i, "limb": limb, "value": v}
                    for i in range(width) for limb, v in _pieces(int(total[e, i]))]
            out.append({"place": parts * entries * width + at, "limb": 0, "value": int(count[e])})
    return out


class _Round:
    """One assignment: the codebooks it uses and which entries moved since the last one."""

    def __init__(self, books: list, before: list | None, width: int, scale: int):
        self.books, self.before, self.width, self.scale = books, before, width, scale
        self.parts, self.entries = len(books), len(books[0])
        self.largest = max((abs(c) for book in books for entry in book for c in entry), default=0)

    def assign(self, vectors: pa.ListArray, codes: pa.BinaryArray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whole-number parts, codes (rows, parts) and squared distances (rows, parts)."""
        x = whole_parts(vectors, self.parts, self.width, self.scale, self.largest)
        code = np.zeros(x.shape[:2], np.uint8)
        error = np.zeros(x.shape[:2], x.dtype)
        if not self.width or not len(x):
            return x, code, error
        old = None if self.before is None else np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(code.shape)
        for p, book in enumerate(self.books):
            entries = np.array(book, x.dtype)
            if old is None:
                code[:, p], error[:, p] = nearest(x[:, p], entries)
            else:
                moved = [a != b for a, b in zip(book, self.before[p])]
                code[:, p], error[:, p] = ball_step(x[:, p], entries, moved, old[:, p])
        return x, code, error


def _binary(codes: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in codes], pa.binary())


def _train(table: DataFrame, step: _Round) -> DataFrame:
    """The table with new codes and, in the last row of each batch, the batch's sums."""
    names = ["id", "label", "vec", "code", "sums"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vec")
            x, codes, _ = step.assign(vectors, batch.column("code") if step.before else None)
            sums = [None] * (batch.num_rows - 1) + [_sums(x, codes, step.entries)]
            kind = pa.list_(pa.struct([("place", pa.int64()), ("limb", pa.int32()), ("value", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), vectors, _binary(codes), pa.array(sums, kind)], names=names)

    kinds = {f.name: f.dataType.simpleString() for f in table.schema}
    return table.mapInArrow(run, f"id {kinds['id']}, label {kinds['label']}, vec {kinds['vec']}, code binary, sums {SUMS}")


def _means(table: DataFrame, step: _Round) -> list:
    """The next codebooks: floored means of the members; an entry without any stays."""
    rows = (table.filter("sums is not null").select(F.explode("sums").alias("s"))
            .groupBy("s.place", "s.limb").agg(F.sum("s.value").alias("value")).collect())
    total: dict[int, int] = {}
    for r in rows:  # at most parts x entries x (width + 1) places
        total[r.place] = total.get(r.place, 0) + (r.value << 32 * r.limb)
    counts = step.parts * step.entries * step.width
    books = []
    for p, book in enumerate(step.books):
        books.append([])
        for e, entry in enumerate(book):
            at = p * step.entries + e
            n = total.get(counts + at, 0)
            books[-1].append([total[at * step.width + i] // n for i in range(step.width)] if n else entry)
    return books


def ball_codes(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> tuple[DataFrame, list]:
    """(id, label, code binary of one byte per part, error long) of every kept row, and the codebooks.

    Codebooks are lists by part, entry and position. ``scale`` is a power of two
    and ``entries`` at most 256. The vectors are read ``rounds + 3`` times and
    written once a round; nothing but sums is shuffled.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    kind = "float" if vectors.schema[vector_col].dataType.elementType == FloatType() else "double"
    rows = pick(vectors, id=id_col, label=label_col, vec=vector_col).withColumn("vec", F.col("vec").cast(f"array<{kind}>"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col("vec").isNotNull() & finite)
    width = -(-(kept.agg(F.max(F.size("vec"))).first()[0] or 0) // parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    start = [[_whole(x, scale) for x in r.vec] + [0] * (parts * width - len(r.vec)) for r in first]
    books = [[v[p * width:(p + 1) * width] for v in start] for p in range(parts)]
    if not start:
        return kept.select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error")), books
    table, before = kept, None
    for _ in range(rounds):
        step = _Round(books, before, width, scale)
        table = stored(_train(table, step), "ball-codes")
        before, books = books, _means(table, step)
    last = _Round(books, before, width, scale)

    def finish(batches):
        for batch in batches:
            _, codes, error = last.assign(batch.column("vec"), batch.column("code") if last.before else None)
            if error.dtype == object:
                sums = [e if e < 1 << 63 else None for e in error.sum(1).tolist()]
            else:
                sums = error.astype(np.int64).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), _binary(codes),
                                              pa.array(sums, pa.int64())], names=["id", "label", "code", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    return table.mapInArrow(finish, f"id {kinds['id']}, label {kinds['label']}, code binary, error long"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` (label, error) with ``label_error``: the errors of all rows with an equal label, nulls together.

    Errors are added up before they move; the sums, one row per label, are
    written, so that Spark broadcasts them where they are few and splits the
    rows of a frequent label where they are not. A null error counts as none.
    """
    codes = stored(codes, "ball-errors")
    sums = codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(20,0)")).alias("total"))
    sums = stored(sums.select(F.col("label").alias("of"), F.col("total").try_cast("long").alias("label_error")), "label-errors")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).drop("of")
