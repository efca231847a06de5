"""Benchmark decontamination by SimHash of item-sized windows.

A document is contaminated by a benchmark item when some window of it, of the
item's own length in words, has a weighted (multiset) Jaccard similarity of
word shingles with the item of at least ``threshold``. Words are runs of
letters and digits, lower-cased, so neither punctuation nor layout hides a
passage; shingles have five words (fewer for an item shorter than that).

1. *Where windows are laid.* A window that reaches the threshold shares at least
   t of the item's m shingles (t follows from threshold and m), hence it holds
   one of any m - t + 1 of them. These anchors, the first ones of every item,
   are looked up among the documents' shingles, and windows of that item's
   length are laid at every start around a hit, for that item. No window that could
   pass is left out, and others need no fingerprint.
2. *Fingerprints.* Each window gets the 64-bit SimHash of its shingles.
3. *Multi-index Hamming blocks.* 64 bits fall into ``radius + 1`` blocks; two
   fingerprints within the radius agree on one whole block. Windows meet the items
   whose anchors they hold by (item, block, value), then the exact distance decides.
   So short blocks, which a wide radius needs, let no window meet strangers.
   The default radius of 18 bits is what windows at similarity 0.8 stay within
   nearly always, and others surely; ``radius=None`` leaves fingerprints out and
   checks every laid window, which finds all pairs.
4. *Exact check.* The weighted similarity of each candidate decides; an item's
   shingles are joined to what the distance admits.

DataFrame functions only. For each shingle size in the benchmark (five at most,
shorter ones only for items of under five words) and portion of its anchors,
documents are read twice: to find the anchors' places, which are written as a
table by a hash of the text, and to lay windows in the texts that have some. (Two
texts with one hash only get windows to check in vain.) Anchors are dealt to
portions one by one, by a hash, half of ``portion`` to each on average, so that no
portion comes near ``portion`` and an item of any length is divided; a portion's
anchors, fingerprints and block keys (``radius + 1`` an item) are broadcast. The
places are joined to the documents as Spark sees fit for their size; else only
found pairs are shuffled, to keep the best window of each (document, item).
Windows are cut out of a text in rows of about ``ROW_HASHES`` shingles.

Nulls and edges: null or empty texts have no windows; an item without words
never matches; a document shorter than an item is compared as one window; items
of any length are compared (over ``MOST`` shingles with wider counters); items
with a null id still count, with a null ``item_id``; documents with a null id,
and rows that repeat an id, share one row per item; empty tables give no rows.
Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stored

SHINGLE = 5
WORD_BREAK = r"[^\p{L}\p{N}]+"
LANE_BITS = 16
MOST = (1 << LANE_BITS - 2) - 1
#: Shingles of the windows that one row holds, or of one window if that is more.
ROW_HASHES = 65_536
#: Shingles of a window above which shared ones are counted in linear time.
LONG = 512


def words(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORD_BREAK), "")


def shingle_hashes(words_of_text: Column, size: int) -> Column:
    """The hash of every run of ``size`` words, in order; an empty array for fewer words.

    The words are bound as a lambda's variable, so that they are made once and
    not again for every run, whatever the optimizer merges.
    """
    def hashes(w: Column) -> Column:
        runs = F.sequence(F.lit(0), F.size(w) - size)
        made = F.transform(runs, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))
        return F.when(F.size(w) >= size, made).otherwise(F.array().cast("array<bigint>"))

    return F.get(F.transform(F.array(words_of_text), hashes), F.lit(0))


def _simhash(hashes: str, lane_bits: int) -> Column:
    most = (1 << lane_bits - 2) - 1
    ones = sum(1 << lane for lane in range(0, 64, lane_bits))
    offset = (F.lit(most) - F.size(hashes)).cast("long") * F.lit(ones)

    def lanes(b: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"),
                           lambda a, h: a + F.shiftrightunsigned(h, b).bitwiseAND(F.lit(ones)))

    def bits(b: int) -> Column:
        over = F.shiftrightunsigned(F.shiftleft(lanes(b), 1) + offset, lane_bits - 2).bitwiseAND(F.lit(ones))
        return F.shiftleft(over, b)

    return reduce(lambda x, y: x.bitwiseOR(y), [bits(b) for b in range(lane_bits)])


def simhash_of(hashes: str, longest: int | None = None) -> Column:
    """The 64-bit SimHash of an array of hashes (``longest`` at most, if given): a bit is set if it is in over half of them.

    Sixteen sums hold the 64 counts: sum b adds up bits b, b + 16, b + 32 and
    b + 48 of every hash in four lanes of 16 bits. In each lane, twice the count
    minus n plus 2^14 - 1 has bit 14 set exactly if the count is over n / 2. For
    over ``MOST`` hashes, 32 sums of two lanes of 32 bits do the same up to 2^30 - 1,
    which is more than an array of a row can hold.
    """
    short = _simhash(hashes, LANE_BITS)
    if longest is not None and longest <= MOST:
        return short
    return F.when(F.size(hashes) <= MOST, short).otherwise(_simhash(hashes, 2 * LANE_BITS))


def block_values(fingerprint: str, blocks: int) -> Column:
    """Array of structs (block, value) of a 64-bit fingerprint."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"),
                              F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def _shared(left, right, levels: int) -> Column:
    """Sum of the smaller multiplicity of every shingle.

    Of long arrays, the distinct shared ones count first, which is linear, and
    then in the same way what is left when one of each is taken away.
    """
    def count(array, h: Column) -> Column:
        return F.size(F.filter(array, lambda x: x == h))

    plain = F.aggregate(F.array_distinct(left), F.lit(0),
                        lambda a, h: a + F.least(count(left, h), count(right, h)))
    if not levels:
        return plain

    def repeats(array) -> Column:
        again = F.transform(F.array(F.sort_array(array)), lambda a: F.filter(a, lambda x, i: x.eqNullSafe(F.get(a, i - 1))))
        return F.get(again, F.lit(0))

    rest = F.get(F.transform(F.array(F.struct(repeats(left).alias("l"), repeats(right).alias("r"))),
                             lambda s: _shared(s["l"], s["r"], levels - 1)), F.lit(0))
    return F.when(F.greatest(F.size(left), F.size(right)) <= LONG, plain).otherwise(F.size(F.array_intersect(left, right)) + rest)


def weighted_similarity(left: str, right: str, longest: int | None = None) -> Column:
    """Sum of the smaller over sum of the larger multiplicity of every shingle."""
    shared = _shared(F.col(left), F.col(right), 0 if longest is not None and longest <= LONG else 3)
    both = F.size(left) + F.size(right)
    return F.get(F.transform(F.array(shared), lambda s: s / (both - s)), F.lit(0))  # counted once


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """(item_id, size, m, hashes, item_fp, anchors): one row per item that has words."""
    items = (pick(benchmark, item_id=id_col, text=text_col).withColumn("w", words("text")).filter(F.size("w") > 0)
             .withColumn("size", F.least(F.size("w"), F.lit(SHINGLE))))
    made = [items.filter(F.col("size") == k).withColumn("hashes", shingle_hashes(F.col("w"), k)) for k in range(1, SHINGLE + 1)]
    items = reduce(DataFrame.unionByName, made).withColumn("m", F.size("hashes"))
    # 2 t threshold-wise: shared / (2 m - shared) >= threshold; a shorter document only needs more of its own
    least = F.ceil(F.col("m") * threshold - 1e-9).cast("int")
    items = items.withColumn("anchors", F.array_distinct(F.slice("hashes", F.lit(1), F.col("m") - least + 1)))
    return items.select("item_id", "size", "m", "hashes", "anchors", simhash_of("hashes").alias("item_fp"))


def anchor_spots(texts: DataFrame, anchors: DataFrame, size: int) -> DataFrame:
    """(key, found): per text with this key, the items (item_no, m, spots) whose anchors stand in it, and where.

    Rows are exploded without their text or its other shingles, so long texts
    cost no more per word than short ones; copies of a text are one entry.
    """
    # the outer form keeps Spark from testing the array for emptiness in a filter, which would make it twice
    placed = texts.select("key", F.posexplode_outer(shingle_hashes(words("text"), size)).alias("pos", "h"))
    spots = (placed.join(F.broadcast(anchors), "h").groupBy("key", "item_no", "m")
             .agg(F.sort_array(F.collect_set("pos")).alias("spots")))
    return spots.groupBy("key").agg(F.collect_list(F.struct("item_no", "m", "spots")).alias("found"))


def _windows(texts: DataFrame, spots: DataFrame, size: int) -> DataFrame:
    """(doc_id, item_no, m, start, hashes): every window of m shingles that holds an anchor of the item, once.

    A window belongs to the first anchor in it, so an anchor's windows start
    after the anchor before it.
    """
    hashed = texts.join(spots, "key").select("doc_id", "found", shingle_hashes(words("text"), size).alias("all"))
    each = (hashed.select("doc_id", "all", F.explode_outer("found").alias("i"))
            .select("doc_id", "all", "i.item_no", "i.m", "i.spots"))
    m, n, at = F.col("m"), F.size("all"), F.col("spots")
    none = F.array().cast("array<int>")

    def starts(i: Column) -> Column:
        pos = F.get(at, i)
        after = F.coalesce(F.get(at, i - 1) + 1, F.lit(0))  # there is none before the first
        first = F.greatest(after, pos - m + 1)
        last = F.least(pos, F.greatest(F.lit(0), n - m))
        return F.when(first <= last, F.sequence(first, last)).otherwise(none)

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.size("spots") - 1), starts))
    each = each.select("doc_id", "item_no", "m", "all", every.alias("starts"),
                       F.greatest(F.lit(1), F.expr(f"int({ROW_HASHES} div m)")).alias("step"))
    rows = F.transform(F.sequence(F.lit(0), F.expr("int((size(starts) - 1) div step)")),
                       lambda b: F.slice("starts", b * F.col("step") + 1, F.col("step")))
    rows = F.when(F.size("starts") > 0, rows).otherwise(F.array().cast("array<array<int>>"))
    part = F.slice("all", F.get("starts", F.lit(0)) + 1, F.element_at("starts", -1) - F.get("starts", F.lit(0)) + m)
    cut = (each.select("doc_id", "item_no", "m", "all", F.explode_outer(rows).alias("starts")).filter(F.col("starts").isNotNull())
           .select("doc_id", "item_no", "m", "starts", part.alias("part")))
    windows = F.transform("starts", lambda s: F.struct(
        s.alias("start"), F.slice("part", s - F.get("starts", F.lit(0)) + 1, m).alias("hashes")))
    return (cut.select("doc_id", "item_no", "m", F.explode_outer(windows).alias("w"))
            .select("doc_id", "item_no", "m", "w.start", "w.hashes"))


def _candidates(windows: DataFrame, items: DataFrame, radius: int | None) -> DataFrame:
    """(..., item_fp, distance): windows within ``radius`` bits of the item that they were laid for."""
    diff = F.col("fp").bitwiseXOR(F.col("item_fp"))
    if radius is None:
        return (windows.join(F.broadcast(items.select("item_no", "item_fp")), "item_no")
                .withColumn("distance", F.bit_count(diff)))
    keys = items.select("item_no", "item_fp", F.explode(block_values("item_fp", radius + 1)).alias("k")).select(
        "item_no", "item_fp", "k.block", "k.value")
    blocked = windows.withColumn("k", F.explode(block_values("fp", radius + 1))).select("*", "k.block", "k.value").drop("k")
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    equal_before = reduce(lambda x, y: x | y, [
        (F.col("block") > i) & (diff.bitwiseAND(F.lit(_mask(a, b))) == 0) for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    # met once, at the first equal block
    return (blocked.join(F.broadcast(keys), ["item_no", "block", "value"]).withColumn("distance", F.bit_count(diff))
            .filter((F.col("distance") <= radius) & ~equal_before).drop("block", "value"))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", threshold: float = 0.8,
                 radius: int | None = 18, portion: int = 200_000) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, window_words, distance): the best window of every contaminated pair."""
    items = benchmark_items(benchmark, item_id_col, item_text_col, threshold).withColumn("item_no", F.monotonically_increasing_id())
    items = stored(items, "benchmark-items")
    longest, anchors = items.agg(F.max("m"), F.sum(F.size("anchors"))).first()
    texts = pick(docs, doc_id=id_col, text=text_col).withColumn("key", F.xxhash64("text"))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # at most five values
    portions = max(1, -(-2 * (anchors or 0) // portion))
    found = []
    for size in sizes:
        some = items.filter(F.col("size") == size)
        placed = some.select("item_no", "m", "item_fp", F.explode("anchors").alias("h"))
        for p in range(portions):
            mine = placed.filter(F.pmod(F.xxhash64("item_no", "h"), F.lit(portions)) == p)
            spots = stored(anchor_spots(texts, mine.select("item_no", "m", "h"), size), "anchor-spots")
            windows = _windows(texts, spots, size).withColumn("fp", simhash_of("hashes", longest))
            near = _candidates(windows, mine.select("item_no", "item_fp").distinct(), radius)
            near = (near.join(some.select("item_no", "item_id", F.col("hashes").alias("item_hashes")), "item_no")
                    .withColumn("similarity", weighted_similarity("item_hashes", "hashes", longest))
                    .filter(F.col("similarity") >= threshold))
            found.append(near.select("doc_id", "item_id", F.struct(
                "similarity", (-F.col("start")).alias("back"), (F.col("m") + size - 1).alias("words"), "distance").alias("best")))
    if not found:
        return texts.sparkSession.createDataFrame([], f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, item_id "
                                                  f"{items.schema['item_id'].dataType.simpleString()}, similarity double, "
                                                  "start_word int, window_words int, distance int")
    best = reduce(DataFrame.unionByName, found).groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "item_id", "best.similarity", (-F.col("best.back")).alias("start_word"),
                       F.col("best.words").alias("window_words"), "best.distance")


def _mask(low: int, high: int) -> int:
    value = (1 << high) - (1 << low)
    return value - (1 << 64) if value >= 1 << 63 else value
