"""Minimax contiguous partition of atomic groups into shards of near-equal bytes.

Rows with equal texts form an atomic group. Groups stand in one fixed order (a
hash of the text's digest), and a shard is a run of neighbouring groups. The
smallest feasible shard capacity is found by binary search, eight halvings of
the interval at a time: 255 capacities are checked together, each greedily (a
shard takes groups while they fit). The cuts then keep every shard within that
capacity and, where groups allow, near the mean.

Only DataFrame functions are used. Data-sized work is two aggregations to
groups, prefix sums inside hash buckets of the order (the buckets' totals, a
fixed number of rows, are summed once more), and one join back. A greedy step
asks "which group covers byte v of the ordered bytes?" for all capacities at
once: the groups are filtered to the asked range and equi-joined on a coarse
cell of the byte axis with the broadcast queries (at most 255 rows). The groups
are stored in the order of that axis, so a step reads only the files and pages of
its range. No prefix table is ever collected or put into one task.

A group may hold any share of the rows, also of rows with one id: its rows are
dealt to ``salts`` portions in turn, which are counted and numbered apart.

Nulls and edges: a null text has size 1 (no bytes plus 1), checksum 0 and forms
a group of its own, apart from the empty text; rows with a null id are rows like
others (numbered first within their portion); repeated rows each get a slot;
fewer groups than shards leave shards empty; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pick, stored, text_or_empty

BEFORE = (Window.unboundedPreceding, -1)
CANDIDATES = 255
CELLS = 4096
RESULT = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _running(df: DataFrame, part: str, order: str, column: str):
    w = Window.partitionBy(part).orderBy(order).rowsBetween(*BEFORE)
    return F.coalesce(F.sum(column).over(w), F.lit(0))


def ordered_groups(portions: DataFrame, buckets: int) -> DataFrame:
    """One row per group with its rows and bytes and how many stand before it in the order."""
    groups = (portions.groupBy("digest").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
              .withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets))))
    sums = groups.groupBy("bucket").agg(F.sum("n").alias("bucket_n"), F.sum("bytes").alias("bucket_bytes"))
    over = Window.orderBy("bucket").rowsBetween(*BEFORE)  # at most `buckets` rows
    ahead = sums.select("bucket", *[F.coalesce(F.sum(f"bucket_{c}").over(over), F.lit(0)).alias(f"ahead_{c}")
                                    for c in ("n", "bytes")])
    inside = groups.select("digest", "bucket", "n", "bytes",
                           _running(groups, "bucket", "digest", "n").alias("inside_n"),
                           _running(groups, "bucket", "digest", "bytes").alias("inside_bytes"))
    return (inside.join(F.broadcast(ahead), "bucket")
            .select("digest", "n", "bytes", (F.col("inside_n") + F.col("ahead_n")).alias("first"),
                    (F.col("inside_bytes") + F.col("ahead_bytes")).alias("start"))
            .withColumn("stop", F.col("start") + F.col("bytes")))


class _Line:
    """The groups as neighbouring intervals of the byte axis [0, total)."""

    def __init__(self, groups: DataFrame, total: int):
        self.groups, self.total = groups, total
        self.cell = max(1, total // CELLS)

    def covering(self, places: set[int]) -> dict[int, tuple[int, int]]:
        """For each place in [0, total): start and stop of the group that covers it."""
        if not places:
            return {}
        spark, cell = self.groups.sparkSession, self.cell
        values = F.array(*[F.lit(int(v)).cast("long") for v in sorted(places)])
        asked = spark.range(1).select(F.explode(values).alias("v")).select("v", F.expr(f"v div {cell}").alias("cell"))
        near = (self.groups.filter((F.col("stop") > min(places)) & (F.col("start") <= max(places)))
                .select("start", "stop", F.explode(F.sequence(F.floor(F.col("start") / cell).cast("long"),
                                                              F.floor((F.col("stop") - 1) / cell).cast("long"))).alias("cell")))
        found = (near.join(F.broadcast(asked), "cell")
                 .filter((F.col("start") <= F.col("v")) & (F.col("v") < F.col("stop")))
                 .select("v", "start", "stop"))
        return {r.v: (r.start, r.stop) for r in found.collect()}  # one row per asked place

    def greedy(self, capacities: list[int], shards: int) -> dict[int, list[int]]:
        """For each capacity the cuts that filling shard after shard gives (``shards - 1`` of them)."""
        cuts = {c: [] for c in capacities}
        at = dict.fromkeys(capacities, 0)
        for _ in range(shards - 1):
            asked = {c: at[c] + c for c in capacities if at[c] + c < self.total}
            got = self.covering(set(asked.values()))
            for c in capacities:
                at[c] = got[asked[c]][0] if c in asked else self.total
                cuts[c].append(at[c])
        return cuts

    def smallest_capacity(self, shards: int, largest: int) -> int:
        low = max(-(-self.total // shards), largest)
        high = -(-self.total // shards) + largest  # always feasible: a shard stops short by less than one group
        while low < high:
            step = max(1, -(-(high - low) // (CANDIDATES + 1)))
            tried = list(range(low, high, step))
            cuts = self.greedy(tried, shards)
            fits = [c for c in tried if self.total - cuts[c][-1] <= c]
            if fits:
                high = fits[0]
            below = [c for c in tried if c < high]
            low = below[-1] + 1 if below else high
        return high

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts nearest to equal shares of what is left, none beyond ``capacity``."""
        need = [self.total]  # from the back: the last place a cut may leave to the shards after it
        for _ in range(shards - 1):
            place = need[-1] - capacity
            start, stop = self.covering({place})[place] if place > 0 else (0, 0)
            need.append(start if start == place else stop)
        cuts, at = [], 0
        for left in range(shards, 1, -1):
            least, most = need[left - 1], at + capacity
            ideal = at + -(-(self.total - at) // left)
            places = {p for p in (min(ideal, self.total - 1), most) if p < self.total}
            got = self.covering(places)
            top = got[most][0] if most < self.total else self.total
            start, stop = got[min(ideal, self.total - 1)]
            best = start if ideal - start <= stop - ideal else stop
            at = min(max(best, least, at), top)
            cuts.append(at)
        return cuts


def minimax_shards(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text",
                   salts: int = 1024, buckets: int = 4096) -> DataFrame:
    """Every row with its size, checksum, shard and gapless slot in the shard (law ``bytes``).

    ``shard`` is 0-based; ``slot`` counts a shard's rows from 0; ``grown_shard``
    is null, as the law ties shards to sizes and not to ids.
    """
    rows = stored(pick(docs, id=id_col, text=text_col).select(
        F.col("id").alias("doc_id"),
        (F.octet_length(text_or_empty()) + 1).cast("long").alias("size"),
        F.crc32(text_or_empty()).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2("text", 256), F.lit(""))).alias("digest"),
        F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int").alias("salt")), "shard-rows")
    portions = rows.groupBy("digest", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    line = stored(ordered_groups(portions, buckets), "shard-line")
    groups = stored(line.repartitionByRange("start").sortWithinPartitions("start"), "shard-groups")
    total, largest = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    cuts: list[int] = []
    if total and shards > 1:
        line = _Line(groups, total)
        cuts = line.even_cuts(line.smallest_capacity(shards, largest), shards)
    shard = sum([(F.col("start") >= F.lit(c)).cast("int") for c in cuts], F.lit(0))
    placed = groups.withColumn("shard", shard)
    firsts = placed.groupBy("shard").agg(F.min("first").alias("shard_first"))  # one row per shard
    offsets = (portions.withColumn("ahead", _running(portions, "digest", "salt", "n"))
               .join(placed, "digest").join(F.broadcast(firsts), "shard")
               .select("digest", "salt", "shard",
                       (F.col("first") - F.col("shard_first") + F.col("ahead")).alias("offset")))
    turn = Window.partitionBy("digest", "salt").orderBy("doc_id")
    numbered = rows.withColumn("turn", F.row_number().over(turn) - 1)
    return (numbered.join(offsets, ["digest", "salt"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                    (F.col("offset") + F.col("turn")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
