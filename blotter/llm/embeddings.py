"""Embedding near-duplicates by Euclidean p-stable hashing and exact cosines.

Vectors are scaled to length one, where a cosine of c is a distance of
sqrt(2 - 2c). A hash table quantises random Gaussian projections with cell
``width``; vectors equal in all cells of a table share a bucket there. Datar et
al. (2004) give the probability p(d) that two vectors at distance d fall into
one cell. From it follow the defaults, the same rule at every size: so many
projections that a vector shares a bucket with about ``strangers`` unrelated
ones (at right angles), and so many tables that a pair exactly at the threshold
meets in one of them with probability ``recall``; closer pairs meet more surely.

* *Classes first.* Rows with the same components are one class (hot vectors
  cost one entry); a class counts for all its rows.
* *Short codes next.* Each vector has a code of 256 signs of random projections.
  Codes of vectors at the threshold differ in a number of bits that follows a
  binomial law, and ``CODE_DEVIATIONS`` above its mean hardly any pair is missed
  (below one in a million), while unrelated codes differ in half their bits. Buckets
  are compared by codes, and a vector goes on to a bucket's exact check only if it
  has a partner there by code, and its set of partners in an earlier table was
  another: the first table that a pair shares brings both a new set, so both are
  sent there. So a vector travels once for each set of partners, not once per table.
* *Exact check.* A task compares a bucket's vectors by their cosines in double
  precision, in blocks of a matrix product, and keeps what reaches the
  threshold. A pair that meets in several tables counts in the first alone,
  which a task sees from the buckets that every row carries. So no pair is ever
  written: a task returns per class how many rows it is linked to, and one link
  to the smallest class of each group it found.
* *Large buckets.* Above ``block`` classes a bucket is dealt into blocks, and
  every pair of blocks is a task's group of its own. All pairs are still
  compared, in bounded memory.

Nulls and edges: vectors that are null, empty or zero, or hold null or
non-finite components, link with nothing and are returned with no links;
vectors of different lengths never link; rows with a null id are returned with
no links, a null component and kept false; repeated rows are vectors like
others (each the other's link); an empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import pick, stored
from .components import connected_components


def cell_probability(distance: float, width: float) -> float:
    """Probability that one projection puts two vectors at ``distance`` into the same cell."""
    r = width / distance
    return 1 - math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


CODE_BITS = 256
CODE_DEVIATIONS = 5.0


def code_radius(threshold: float) -> int:
    """Bits in which the codes of a pair at the threshold differ at most, but for one in a million."""
    p = math.acos(threshold) / math.pi
    return math.ceil(CODE_BITS * p + CODE_DEVIATIONS * math.sqrt(CODE_BITS * p * (1 - p)))


def table_shape(vectors: int, threshold: float, width: float, strangers: int, recall: float) -> tuple[int, int]:
    """(tables, projections per table) for so many vectors."""
    near = cell_probability(math.sqrt(2 - 2 * threshold), width)
    far = cell_probability(math.sqrt(2), width)
    projections = max(1, math.ceil(math.log(max(1, vectors / strangers)) / -math.log(far)))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - near**projections))), projections


def _unit(raw: bytes, kind: str) -> np.ndarray | None:
    """The vector scaled to length one in double precision; None if it has no direction."""
    v = np.frombuffer(raw, kind).astype(np.float64)
    largest = np.abs(v).max() if len(v) else 0.0
    if not np.isfinite(largest) or largest == 0.0:
        return None
    v = v / largest  # its square then neither overflows nor vanishes
    return v / np.sqrt(v @ v)


def component_kind(vectors: DataFrame, vector_col: str) -> str:
    """How a component is kept: as the 4-byte float it is, or else as 8 bytes."""
    return "<f4" if vectors.schema[vector_col].dataType.elementType == FloatType() else "<f8"


def vector_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, key, vec): vec is the components' bytes, key their digest; both null if it links with nothing."""
    kind = component_kind(vectors, vector_col)
    rows = pick(vectors, vec_id=id_col, vec=vector_col).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast("array<float>" if kind == "<f4" else "array<double>").alias("vec"))

    def read(batches):
        for batch in batches:
            vecs = batch.column("vec")
            flat, ends = vecs.values, vecs.offsets.to_numpy()
            null = np.asarray(flat.is_null())
            data = flat.fill_null(0.0).to_numpy(zero_copy_only=False)
            valid = np.asarray(vecs.is_valid()) & np.asarray(batch.column("vec_id").is_valid())
            keys, raws = [], []
            for i, ok in enumerate(valid):
                a, b = ends[i], ends[i + 1]
                raw = (data[a:b] + data.dtype.type(0)).astype(kind).tobytes() if ok and not null[a:b].any() else b""
                raw = raw if raw and _unit(raw, kind) is not None else None
                raws.append(raw)
                keys.append(raw and hashlib.sha256(raw).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(raws, pa.binary())],
                                             names=["vec_id", "key", "vec"])

    return rows.mapInArrow(read, "vec_id long, key binary, vec binary")


def hashed(classes: DataFrame, kind: str, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(node, buckets, code): the bucket of each class in every table, and its short code."""
    def make(batches):
        drawn: dict[int, tuple] = {}
        for batch in batches:
            units = [_unit(r, kind) for r in batch.column("vec").to_pylist()]
            sizes = np.array([len(u) for u in units])
            keys = np.zeros((len(units), tables), "<i8")
            codes = np.zeros((len(units), CODE_BITS // 8), np.uint8)
            for d in np.unique(sizes):
                if d not in drawn:
                    rng = np.random.default_rng([seed, int(d)])
                    drawn[d] = (rng.standard_normal((d, tables * projections)),
                                rng.uniform(0, width, tables * projections),
                                rng.integers(1, 1 << 62, (tables, projections)) | 1, rng.standard_normal((d, CODE_BITS)))
                lines, shift, mix, signs = drawn[d]
                at = np.flatnonzero(sizes == d)
                same = np.stack([units[i] for i in at])
                codes[at] = np.packbits(same @ signs > 0, axis=1)
                cells = np.floor((same @ lines + shift) / width).astype(np.int64)
                cells = cells.reshape(len(at), tables, projections)
                with np.errstate(over="ignore"):  # a bucket's name; vectors in it are compared whatever it holds
                    keys[at] = (cells * mix).sum(axis=2) * 31 + int(d)
            offsets = np.arange(0, keys.size + 1, tables, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel(), pa.int64())),
                 pa.array([c.tobytes() for c in codes], pa.binary())], names=["node", "buckets", "code"])

    return classes.select("node", "vec").mapInArrow(make, "node long, buckets array<long>, code binary")


def _grouped(batches, keys: tuple[str, ...], columns: tuple[str, ...]):
    """(key, {column: values}) of each run of equal keys in sorted batches."""
    last, held = None, None
    for batch in batches:
        cols = {c: batch.column(c).to_pylist() for c in columns}
        for k, key in enumerate(zip(*[batch.column(c).to_pylist() for c in keys])):
            if key != last:
                if last is not None:
                    yield last, held
                last, held = key, {c: [] for c in columns}
            for c in columns:
                held[c].append(cols[c][k])
    if last is not None:
        yield last, held


def _mixed(nodes: np.ndarray) -> np.ndarray:
    """Numbers that stand for nodes where sets of them are told apart by their exclusive or."""
    x = nodes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ x >> np.uint64(29)


def partners(dealt: DataFrame, radius: int) -> DataFrame:
    """(tab, bucket, blocks, node, mark): classes with a partner by code in a bucket; ``mark`` stands for the set of them."""
    names = ["tab", "bucket", "blocks", "node", "mark"]

    def compare(batches):
        for (tab, bucket, i, j, blocks), rows in _grouped(batches, ("tab", "bucket", "i", "j", "blocks"), ("node", "block", "code")):
            node, block = np.array(rows["node"], np.int64), np.array(rows["block"])
            codes = np.frombuffer(b"".join(rows["code"]), np.uint64).reshape(len(node), -1)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            marks, there, mixed = np.zeros(len(node), np.uint64), np.zeros(len(node), bool), _mixed(node)
            for a in range(0, len(left), 256):
                part = left[a:a + 256]
                apart = sum(np.bitwise_count(codes[part, w][:, None] ^ codes[right, w]).astype(np.int16) for w in range(codes.shape[1]))
                x, y = np.nonzero(apart <= radius)
                x, y = part[x], right[y]
                x, y = x[node[x] != node[y]], y[node[x] != node[y]]
                for own, other in ((x, y), (y, x)) if i != j else ((x, y),):
                    there[own] = True
                    np.bitwise_xor.at(marks, own, mixed[other])
            if there.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v] * int(there.sum()), pa.int64()) for v in (tab, bucket, blocks)]
                    + [pa.array(node[there], pa.int64()), pa.array(marks[there].view(np.int64), pa.int64())], names=names)

    found = dealt.mapInArrow(compare, "tab long, bucket long, blocks long, node long, mark long")
    return found.groupBy("tab", "bucket", "blocks", "node").agg(F.bit_xor("mark").alias("mark"))


def _compare(rows, tab: int, mates: tuple[int, int], threshold: float, kind: str):
    """Links of one bucket (or pair of its blocks): (node, linked rows) sums and star links."""
    units = [_unit(r, kind) for r in rows["vec"]]
    width = len(units[0])
    same = [i for i, u in enumerate(units) if len(u) == width]
    node, n, block = (np.array([rows[c][i] for i in same]) for c in ("node", "n", "block"))
    x = np.stack([units[i] for i in same])
    buckets = np.array([rows["buckets"][i] for i in same], np.int64)
    left = np.flatnonzero(block == mates[0])
    right = np.flatnonzero(block == mates[1]) if mates[0] != mates[1] else left
    sums, parent = np.zeros(len(node), np.int64), np.arange(len(node))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for a in range(0, len(left), 512):
        part = left[a:a + 512]
        near = x[part] @ x[right].T >= threshold
        i, j = np.nonzero(near)
        i, j = part[i], right[j]
        if mates[0] == mates[1]:
            i, j = i[i < j], j[i < j]
        for p, q in zip(i.tolist(), j.tolist()):
            p, q = root(p), root(q)
            if p != q:
                small, large = (p, q) if node[p] < node[q] else (q, p)
                parent[large] = small
        if tab:
            first = ~(buckets[i, :tab] == buckets[j, :tab]).any(axis=1)
            i, j = i[first], j[first]
        np.add.at(sums, i, n[j])
        np.add.at(sums, j, n[i])
    return [(int(node[k]), int(sums[k]), int(node[root(k)])) for k in range(len(node)) if sums[k] or root(k) != k]


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` of buckets (tab, bucket, blocks, node) by pairs of a bucket's blocks, together and sorted."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    mates = F.transform(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1),
                        lambda b: F.struct(F.least(b, own).alias("i"), F.greatest(b, own).alias("j")))
    rows = rows.select("tab", "bucket", "blocks", "node", *columns, own.alias("block"), F.explode(mates).alias("m"))
    return (rows.select("tab", "bucket", "m.i", "m.j", "blocks", "block", "node", *columns)
            .repartition("tab", "bucket", "i", "j").sortWithinPartitions("tab", "bucket", "i", "j"))


def bucket_links(classes: DataFrame, hashes: DataFrame, *, threshold: float, block: int, kind: str) -> DataFrame:
    """(node, linked, root): what each bucket adds to a class, and a link towards its group there.

    Buckets are counted, and lone ones dropped, on their names, and compared by
    codes; vectors are then sent out where they have a new set of partners.
    """
    named = hashes.select("node", "code", F.posexplode("buckets").alias("tab", "bucket"))
    sizes = stored(named.groupBy("tab", "bucket").agg(F.count("*").alias("entries")).filter(F.col("entries") > 1)
                   .select("tab", "bucket", F.ceil(F.col("entries") / block).cast("int").alias("blocks")), "bucket-sizes")
    met = stored(partners(_dealt(named.join(sizes, ["tab", "bucket"]), "code"), code_radius(threshold)), "partners")
    place = F.struct(F.col("tab").cast("int").alias("tab"), "bucket", F.col("blocks").cast("int").alias("blocks"))
    shared = (met.groupBy("node", "mark").agg(F.min(place).alias("place"))  # the first table with this set
              .groupBy("node").agg(F.collect_list("place").alias("places")))  # at most one entry per table
    sent = (classes.join(hashes.drop("code"), "node").join(shared, "node")
            .select("node", "n", "vec", "buckets", F.explode("places").alias("p"))
            .select("node", "n", "vec", "buckets", "p.tab", "p.bucket", "p.blocks"))
    dealt = _dealt(sent, "n", "buckets", "vec")

    def compare(batches):
        for (tab, _, i, j), held in _grouped(batches, ("tab", "bucket", "i", "j"), ("node", "n", "block", "buckets", "vec")):
            rows = _compare(held, tab, (i, j), threshold, kind) if len(held["node"]) > 1 else []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["node", "linked", "root"])

    return dealt.mapInArrow(compare, "node long, linked long, root long")


def embedding_groups(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
                     threshold: float = 0.9, tables: int | None = None, projections: int | None = None,
                     width: float = 3.0, strangers: int = 256, recall: float = 0.95, block: int = 2048,
                     seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row; links are cosines of at least ``threshold``."""
    kind = component_kind(vectors, vector_col)
    rows = stored(vector_rows(vectors, id_col, vector_col), "vectors")
    usable = F.col("key").isNotNull() & F.col("vec_id").isNotNull()
    classes = stored(rows.filter(usable).groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("n"), F.min("vec").alias("vec")), "vector-classes")
    if tables is None or projections is None:
        shape = table_shape(classes.count(), threshold, width, strangers, recall)
        tables, projections = tables or shape[0], projections or shape[1]
    # repeated ids may stand for several classes; a class is then named by its own number
    nodes = classes.withColumn("node", F.xxhash64("key"))
    hashes = stored(hashed(nodes, kind, tables, projections, width, seed), "vector-buckets")
    found = stored(bucket_links(nodes, hashes, threshold=threshold, block=block, kind=kind), "vector-links")
    roots = connected_components(found.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    named = (classes.select("key", F.xxhash64("key").alias("c"), F.col("node").alias("first_id"), "n")
             .join(linked.withColumnRenamed("node", "c"), "c", "left")
             .join(roots.withColumnRenamed("node", "c"), "c", "left")
             .withColumn("root", F.coalesce("root", "c")))
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_class = named.join(names, "root").select(
        "key", (F.col("n") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), "component_id")
    grouped = rows.filter(usable).select("vec_id", "key").join(per_class, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (grouped.unionByName(alone)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
