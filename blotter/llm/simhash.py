"""SimHash near-duplicates with BK-trees over shards of fingerprints.

Every text gets a 64-bit SimHash of its word shingles (repeats included): a bit
is set when it is set in over half of the shingles' XXH64 values. Fingerprints
that differ in at most ``radius`` bits are linked; linked texts form groups.

* *Shards.* The 64 bits are split into ``radius + 2`` blocks. Two fingerprints
  within the radius agree on at least two whole blocks, so each pair of blocks
  with its value names a shard, and every link lies inside at least one shard.
  Equal fingerprints are one entry, whatever number of texts bears them.
* *Crowded shards* (over ``crowded`` entries) are dealt again by parts of their
  free bits (those that the shard does not fix), of which again one must agree;
  what is still crowded is dealt again. Entries differ and each round leaves a
  shard two thirds of its free bits, so even where fingerprints are as dense as
  can be it ends: a shard with w free bits has at most 2^w entries.
* *Trees.* A task reads its shards one after another and grows a BK-tree for
  each: a child hangs on the edge numbered with its Hamming distance to the
  parent, and a search from a node at distance d follows only the edges from
  d - radius to d + radius. The tree travels with its shard instead of being
  broadcast, since a broadcast of all trees would pass every fingerprint
  through the driver. A task returns one link to the smallest entry of each
  group inside a shard instead of all pairs; that keeps every connection.
* *Groups* are the connected components of those links (``components``).

Nulls and edges: a null text is an empty one; texts without words have
fingerprint zero and link like any other; a null id takes part in links but is
never a group's name (a group of null ids only has a null name); repeated rows
share a group; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, stored, text_or_empty
from .components import connected_components

HASH_SEED = 42


def simhash(text: str, shingle: int) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest as h

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = max(0, len(words) - shingle)
    hashes = np.fromiter([h(line[a:b], HASH_SEED) for a, b in zip(starts[:k + 1].tolist(), ends[-(k + 1):].tolist())],
                         np.uint64, k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, k + 1, 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > k + 1, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 key_col: str | None = None) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``; with ``key_col``, a string column carried along as ``key``."""
    def make(batches):
        for batch in batches:
            made = [simhash(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(made, pa.int64())], names=[*kept, "fp"])

    kept = ["doc_id", "key"] if key_col else ["doc_id"]
    rows = pick(docs, doc_id=id_col, text=text_col, **({"key": key_col} if key_col else {}))
    rows = rows.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": text_or_empty()})
    return rows.mapInArrow(make, "doc_id long, " + ("key string, " if key_col else "") + "fp long")


def _bits(column, low: int, width: int):
    return F.shiftrightunsigned(column, low).bitwiseAND((1 << width) - 1) if width else F.lit(0).cast("long")


def _cut(bits: int, parts: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of ``parts`` neighbouring blocks of a ``bits``-bit value."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def shard_rows(entries: DataFrame, radius: int, crowded: int) -> DataFrame:
    """(shard, fp): each fingerprint in all shards where a link of it may lie.

    A shard is named by a hash of the bits that it fixes; two that share a name by
    chance only compare more.
    """
    blocks = _cut(64, radius + 2)
    keys = []
    for i, pair in enumerate(combinations(range(radius + 2), 2)):
        free, width = F.lit(0).cast("long"), 0
        for low, w in (blocks[j] for j in range(radius + 2) if j not in pair):
            free, width = F.shiftleft(free, w).bitwiseOR(_bits(F.col("fp"), low, w)), width + w
        name = F.xxhash64(F.lit(i), *[_bits(F.col("fp"), *blocks[j]) for j in pair])
        keys.append(F.struct(name.alias("shard"), free.alias("free"), F.lit(width).alias("width")))
    rows = entries.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.shard", "k.free", "k.width")
    small = []
    while True:
        hot = stored(rows.groupBy("shard").agg(F.count("*").alias("entries")).filter(F.col("entries") > crowded)
                     .select("shard", F.lit(True).alias("hot")), "crowded-shards")
        if not hot.limit(1).count():
            break
        known = rows.join(hot, "shard", "left")
        small.append(known.filter(F.col("hot").isNull()).select("shard", "fp"))
        full = known.filter("hot")
        # few bits are free: so few entries that it cannot be crowded, or that no part would be left to deal by
        narrow = (F.pow(F.lit(2), F.col("width")) <= crowded) | (F.col("width") <= radius)
        small.append(full.filter(narrow).select("shard", "fp"))
        rows = stored(full.filter(~narrow).select("fp", F.explode(_dealt(radius + 1)).alias("k"))
                      .select("fp", "k.shard", "k.free", "k.width"), "shards")
    small.append(rows.select("shard", "fp"))
    return reduce(DataFrame.unionByName, small)


def _dealt(parts: int):
    """A shard's rows again, once by each of ``parts`` neighbouring parts of its free bits."""
    out = []
    for k in range(parts):
        low, high = (F.expr(f"width * {j} div {parts}").cast("int") for j in (k, k + 1))

        def shifted(way: str, bits, by):
            return F.call_function(way, bits, by)

        one = F.lit(1).cast("long")
        value = shifted("shiftrightunsigned", F.col("free"), low).bitwiseAND(shifted("shiftleft", one, high - low) - 1)
        rest = shifted("shiftleft", shifted("shiftrightunsigned", F.col("free"), high), low).bitwiseOR(
            F.col("free").bitwiseAND(shifted("shiftleft", one, low) - 1))
        out.append(F.struct(F.xxhash64("shard", F.lit(k), value).alias("shard"), rest.alias("free"),
                            (F.col("width") - (high - low)).alias("width")))
    return F.array(*out)


class BKTree:
    """Fingerprints by Hamming distance: node i has children by their distance to it."""

    def __init__(self, radius: int):
        self.radius, self.values, self.edges = radius, [], []

    def insert_and_find(self, fp: int) -> list[int]:
        """Add ``fp``; the numbers of earlier entries within the radius."""
        values, edges, r = self.values, self.edges, self.radius
        found = []
        if values:
            todo = [0]
            while todo:
                i = todo.pop()
                d = (values[i] ^ fp).bit_count()
                if d <= r:
                    found.append(i)
                children = edges[i]
                if children:
                    for e in range(d - r, d + r + 1):
                        c = children.get(e)
                        if c is not None:
                            todo.append(c)
            i = 0
            while True:
                d = (values[i] ^ fp).bit_count()
                c = edges[i].get(d)
                if c is None:
                    edges[i][d] = len(values)
                    break
                i = c
        values.append(fp)
        edges.append({})
        return found


def _shard_links(fps: list[int], radius: int):
    """One link from every linked entry to the smallest entry of its group in this shard."""
    tree, parent = BKTree(radius), list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, fp in enumerate(fps):
        for j in tree.insert_and_find(fp & 0xFFFFFFFFFFFFFFFF):
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return [(fps[i], fps[root(i)]) for i in range(len(fps)) if root(i) != i]


def fingerprint_links(entries: DataFrame, *, radius: int = 2, crowded: int = 2000) -> DataFrame:
    """Links (src, dst) that connect exactly the fingerprints within ``radius`` bits (and chains of them)."""
    shards = shard_rows(entries, radius, crowded).repartition("shard").sortWithinPartitions("shard", "fp")

    def links(batches):
        last, open_ = None, []
        for batch in batches:
            keys = batch.column("shard").to_numpy(zero_copy_only=False)
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            out = []
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(fps)]):
                if a == 0 and last is not None and int(keys[0]) == last:
                    open_.extend(fps[a:b].tolist())
                else:
                    if len(open_) > 1:
                        out += _shard_links(open_, radius)
                    open_ = fps[a:b].tolist()
            last = int(keys[-1]) if len(fps) else last
            if out:
                yield _pairs(out)
        if len(open_) > 1 and (out := _shard_links(open_, radius)):
            yield _pairs(out)

    return shards.mapInArrow(links, "src long, dst long")


def _pairs(rows) -> pa.RecordBatch:
    src, dst = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   radius: int = 2, crowded: int = 2000, key_col: str | None = None) -> DataFrame:
    """(doc_id, fp, component_id) per row; component_id is the smallest id reachable over links.

    With ``key_col`` two columns more: that column as ``key``, and ``root``, the
    group's fingerprint name, which is there even where all ids are null.
    """
    rows = stored(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle, key_col=key_col), "simhash")
    entries = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = connected_components(fingerprint_links(entries.select("fp"), radius=radius, crowded=crowded))
    linked = entries.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = linked.join(names, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id", *(["key", "root"] if key_col else []))


def keep_one_each(groups: DataFrame) -> DataFrame:
    """Of ``simhash_groups(..., key_col=...)``: (doc_id, key) of the row that stays of each group.

    It is the row with the smallest id, nulls last, then the smallest key; one
    minimum per group, combined before the shuffle.
    """
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("best")
    return groups.groupBy("root").agg(best).select("best.doc_id", "best.key")
