"""Decontamination, sharding and WARC archives against brute force and round trips."""

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter.llm import decontaminate as D
from blotter.llm import warc as W
from blotter.llm.common import file_system, shared_folder
from blotter.llm.queries import op2_benchmark_decontamination, op7_warc_normaliser
from blotter.llm.sharding import minimax_shards
from conftest import SF_MID, SF_SMALL

# ---- decontamination


def shingles(text, size=None):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    k = size or min(5, len(words))
    return [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if words and k <= len(words) else [], k


def similarity(a, b):
    a, b = Counter(a), Counter(b)
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


def best_windows(docs, items, threshold=0.8):
    out = {}
    for doc_id, text in docs:
        for item_id, item in items:
            want, k = shingles(item)
            have, _ = shingles(text, k) if want else ([], 0)
            if not have or not set(want) & set(have):
                continue
            m = len(want)
            top = max(similarity(want, have[s:s + m]) for s in range(max(1, len(have) - m + 1)))
            if top >= threshold:
                out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), round(top, 6))
    return out


def test_simhash_column(spark):
    rng = random.Random(1)
    rows = [[rng.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 3, 46, 2000)] + [[5, 5, 9]]
    got = [r.f for r in spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, h array<long>").orderBy("i")
           .select(D.simhash_of("h").alias("f")).collect()]
    for r, f in zip(rows, got):
        assert f & (1 << 64) - 1 == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r) > len(r))


def test_contaminated_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([4, 5, 9, 14, 22, 40, 40, 57, 1, 90])]
    items += [(50, items[5][1]), (51, "the cat the cat the cat the cat the cat the cat"), (52, ""), (53, None), (None, items[6][1])]
    docs = []
    for d in range(160):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 30, 200]))]
        if d % 2:
            passage = rng.choice(items[:10])[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
            passage = passage[rng.choice([0, 0, 1, 3]):]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() + "," if rng.random() < 0.3 else w for w in passage]
        docs.append((d, " \n".join(words)))
    docs += [(500, "The CAT, the cat - the cat the cat the cat the cat the cat"), (501, None), (None, items[5][1]), (502, items[7][1]), (502, items[7][1])]
    ddf = spark.createDataFrame([(*r, 1, 2) for r in docs], "doc_id long, text string, m int, hashes int").repartition(4)
    idf = spark.createDataFrame([(*r, 3) for r in items], "item_id long, text string, fp int")
    want = best_windows(docs, items)
    for portion in (200_000, 20):
        got = {(r.doc_id, r.item_id): round(r.similarity, 6) for r in D.contaminated(ddf, idf, portion=portion).collect()}
        assert set(got) <= set(want)
        assert all(got[k] <= want[k] for k in got)
        missed = [k for k in want if k not in got]
        assert all(want[k] < 0.9 for k in missed) and len(missed) <= 0.1 * len(want), (missed, len(want))
        exact = [k for k, v in want.items() if v == 1.0]
        assert len(exact) > 30 and all(got[k] == 1.0 for k in exact)
    assert D.contaminated(ddf.limit(0), idf).collect() == []
    assert D.contaminated(ddf, idf.limit(0)).collect() == []


def test_every_pair_is_found_without_fingerprints_and_nearly_all_with_them(spark):
    """Recall by similarity: windows with some words changed, so that pairs lie between 0.8 and 1."""
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range([50, 80, 120][i % 3]))) for i in range(24)]
    docs = []
    for d in range(240):
        passage = rng.choice(items)[1].split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        docs.append((d, " ".join([rng.choice(vocabulary) for _ in range(20)] + passage + [rng.choice(vocabulary) for _ in range(20)])))
    want = best_windows(docs, items)
    ddf, idf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {r: {(x.doc_id, x.item_id): round(x.similarity, 6) for x in D.contaminated(ddf, idf, radius=r, portion=p).collect()}
             for r, p in ((None, 250), (18, 200_000))}
    assert found[None] == want and len(want) > 120
    for low, high, share in ((0.8, 0.85, 0.9), (0.85, 0.9, 0.97), (0.9, 1.01, 1.0)):
        pairs = [k for k, v in want.items() if low <= v < high]
        assert len(pairs) > 15 and sum(k in found[18] for k in pairs) >= share * len(pairs), (low, len(pairs), sum(k in found[18] for k in pairs))


def test_a_window_meets_only_items_whose_anchors_it_holds(spark):
    """Against thousands of items of one length, of which a document holds a passage of one."""
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(40))) for i in range(3000)]
    docs = spark.createDataFrame([(1, " ".join(rng.choice(vocabulary) for _ in range(100)) + " " + items[7][1])], "doc_id long, text string")
    some = D.benchmark_items(spark.createDataFrame(items, "item_id long, text string"), "item_id", "text", 0.8)
    some = some.withColumn("item_no", F.col("item_id"))
    anchors = some.select("item_no", "m", F.explode("anchors").alias("h"))
    texts = docs.withColumn("key", F.xxhash64("text"))
    windows = D._windows(texts, D.anchor_spots(texts, anchors, 5), 5).withColumn("fp", D.simhash_of("hashes"))
    assert {r.item_no for r in windows.select("item_no").distinct().collect()} == {7}
    assert D._candidates(windows, some, 18).count() <= windows.count()


@pytest.mark.parametrize("row_hashes", [1, 100, 65_536])
def test_windows_are_cut_alike_from_rows_of_any_size(spark, monkeypatch, row_hashes):
    monkeypatch.setattr(D, "ROW_HASHES", row_hashes)
    texts = spark.createDataFrame([(1, "a b c d e f g h i j " * 6), (2, "x a b c d e f g")], "doc_id long, text string").withColumn("key", F.xxhash64("text"))
    items = D.benchmark_items(spark.createDataFrame([(5, "b c d e f g h i")], "item_id long, text string"), "item_id", "text", 0.8)
    anchors = items.select(F.lit(0).cast("long").alias("item_no"), "m", F.explode("anchors").alias("h"))
    got = D._windows(texts, D.anchor_spots(texts, anchors, 5), 5).collect()
    assert len({(r.doc_id, r.start) for r in got}) == len(got) and all(len(r.hashes) == 4 for r in got)
    near = {s for k in range(6) for s in range(10 * k - 2, 10 * k + 2) if 0 <= s <= 52}  # the anchor stands at 10 k + 1
    assert {r.start for r in got if r.doc_id == 1} == near and {r.start for r in got if r.doc_id == 2} == {0}


def test_blocks_meet_every_fingerprint_within_the_radius(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(19)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 63) for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    both = df.select(D.block_values("a", 19).alias("x"), D.block_values("b", 19).alias("y"))
    assert both.filter(F.arrays_overlap("x", "y")).count() == 300


def test_decontamination_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id): r.similarity for r in op2_benchmark_decontamination(spark, SF_MID).collect()}
    assert got == best_windows(docs, items) and len(got) > 20


# ---- sharding


def smallest_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, used, room = (low + high) // 2, 1, (low + high) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        low, high = (low, mid) if used <= shards else (mid + 1, high)
    return low


def check_shards(rows, docs, shards):
    """Law, groups, slots and the smallest capacity for the order the operator chose."""
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows if r.doc_id is not None) == sorted(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs if d is not None)
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(0 <= k < shards for k in slots)
    texts = {}
    for r in rows:
        texts.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    groups = Counter()
    order = {}
    for r in rows:  # groups in the operator's order: by shard, then slot
        key = (r.text_crc32, r.size)
        groups[key] += r.size
        order[key] = min(order.get(key, (99, 0)), (r.shard, r.slot))
    sizes = [groups[k] for k in sorted(groups, key=order.get)]
    bytes_ = Counter()
    for r in rows:
        bytes_[r.shard] += r.size
    assert max(bytes_.values()) <= smallest_capacity(sizes, shards)
    return texts, bytes_


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards(spark, shards):
    rng = random.Random(shards)
    docs = [(i, "x" * rng.randrange(400) + str(i)) for i in range(300)] + [(1000 + i, "copy " * 9) for i in range(200)]
    docs += [(i, "pair") for i in (5000, 5001, 5001)] + [(None, "no id"), (None, "no id")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, shard int, digest int").repartition(5)
    rows = minimax_shards(df, shards, salts=16).collect()
    texts, bytes_ = check_shards(rows, docs, shards)
    assert all(len(s) == 1 for s in texts.values())
    if shards == 8:
        assert len(bytes_) == 8 and max(bytes_.values()) < 1.5 * min(bytes_.values())


def test_shards_of_few_null_and_no_rows(spark):
    docs = [(1, None), (2, ""), (3, None), (4, "é")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in minimax_shards(df, 8).collect()}
    assert {d: (r.size, r.text_crc32) for d, r in rows.items()} == {1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (3, zlib.crc32("é".encode()))}
    assert rows[1].shard == rows[3].shard and sorted((rows[1].slot, rows[3].slot)) == [0, 1]
    assert minimax_shards(df.limit(0), 8).collect() == []


@pytest.mark.parametrize("doc_id", [7, None])
def test_rows_of_one_id_and_text_are_numbered_in_portions(spark, doc_id):
    docs = spark.createDataFrame([(doc_id, "same")] * 2000 + [(i, f"text {i}") for i in range(50)], "doc_id long, text string").repartition(5)
    got = minimax_shards(docs, 8, salts=16).collect()
    for shard in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert len({r.shard for r in got if r.size == 5}) == 1 and len(got) == 2050


def test_one_group_with_most_bytes(spark):
    docs = [(i, "hot " * 30) for i in range(500)] + [(1000 + i, f"t{i}") for i in range(100)]
    rows = minimax_shards(spark.createDataFrame(docs, "doc_id long, text string"), 4, salts=8).collect()
    texts, _ = check_shards(rows, docs, 4)
    assert all(len(s) == 1 for s in texts.values())


# ---- WARC


def pages(spark):
    long_a, long_b = "a" * 1000, "é" * 600
    rows = [(1, "u1", long_a), (9, "u2", long_a), (4, None, long_a), (2, "u", long_b), (3, "u\r\nX: y", long_b + "!"), (5, "u", "short"),
            (6, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", long_a), (12, "u", "b" * 999), (13, "u", "b" * 999),
            (20, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 200), (30, "u", "z" * 3_000_000), (31, "u", "z" * 3_000_000)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3), rows


def test_round_trip(spark):
    df, rows = pages(spark)
    got = {r.page_id: r for r in W.archive_round_trip(df).collect()}
    assert len(got) == len(rows)
    newest = {"a" * 1000: 9, "z" * 3_000_000: 31}
    for page_id, url, html in rows:
        r, data = got[page_id], (html or "").encode()
        refers = newest.get(html) if newest.get(html) != page_id else None
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == ("revisit" if refers else "response", refers)
        assert r.target_uri == (None if url is None else url.replace("\r", "%0D").replace("\n", "%0A"))
    assert W.archive_round_trip(df.limit(0)).collect() == []


def test_files_are_monolithic_then_one_member_per_record(spark):
    df, rows = pages(spark)
    folder = shared_folder(spark, "warc")
    files = W.write_monolithic(W.plan_records(df), f"{folder}/a")
    members = W.normalise(files, f"{folder}/a", f"{folder}/b")
    _, root = file_system(folder)
    for f in files.collect():
        data = open(f"{root}/a/{f.warc}", "rb").read()
        one = zlib.decompressobj(31)
        one.decompress(data)
        assert one.eof and not one.unused_data  # a single member
    total = 0
    for m in members.collect():
        data = open(f"{root}/b/{m.warc}", "rb").read()
        places = [tuple(map(int, x.split())) for x in open(f"{root}/b/{m.idx}").read().splitlines()]
        assert [a for a, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) == len(data)
        assert all(gzip.decompress(data[a:a + n]).startswith(b"WARC/1.1\r\nWARC-Type: ") for a, n in places)
        total += len(places)
    assert total == len(rows)
    back = {r.page_id: r.payload for r in W.read_archives(members, f"{folder}/b").collect() if r.record_type == "response"}
    want = dict((r[0], (r[2] or "").encode()) for r in rows)
    assert all(back[k] == want[k] for k in back) and 9 in back and 1 not in back


def test_cut_off_streams_are_refused():
    record = W._record(1, "u", b"payload", None)
    assert list(W.split_records([record[:10], record[10:] + record])) == [record, record]
    with pytest.raises(ValueError):
        list(W.split_records([record[:-6]]))
    import io
    with pytest.raises(ValueError):
        list(W._inflated(io.BytesIO(gzip.compress(record)[:-4])))
    assert b"".join(W._inflated(io.BytesIO(gzip.compress(record) + gzip.compress(record)))) == 2 * record


def test_a_payload_of_most_pages_is_spread_over_archives(spark):
    hot = "the same page " * 200
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 < 2, F.lit(hot)).otherwise(
        F.concat(F.lit("own page "), F.repeat(F.col("id").cast("string"), 500))).alias("html")).repartition(16)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        files = W.write_monolithic(W.plan_records(pages), shared_folder(spark, "w")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum(r.records for r in files) == 4000 and max(r.records for r in files) < 1500


def test_query_columns(spark):
    df = op7_warc_normaliser(spark, SF_SMALL)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/pages.parquet").count()


def test_items_of_twenty_thousand_words(spark):
    rng = random.Random(6)
    words = [f"w{rng.randrange(4000)}" for _ in range(20_000)]
    item = " ".join(words)
    changed = " ".join(w if i % 100 else "other" for i, w in enumerate(words))
    docs = spark.createDataFrame([(1, "some words before " + item + " and after"), (2, changed), (3, " ".join(reversed(words)))], "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (8, "some words before this one here")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in D.contaminated(docs, items).collect()}
    assert got.keys() == {(1, 9), (2, 9)}
    assert (got[(1, 9)].similarity, got[(1, 9)].start_word, got[(1, 9)].window_words) == (1.0, 3, 20_000)
    assert 0.85 < got[(2, 9)].similarity < 0.95


def test_long_windows_are_hashed_and_compared_alike(spark):
    rng = random.Random(7)
    hashes = lambda n, kinds: [rng.choice(kinds) for _ in range(n)]
    some = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    rows = [(hashes(n, some[:k]), hashes(n + 5, some[k // 3:])) for n, k in ((20_000, 300), (16_384, 3), (900, 290), (600, 4), (40, 9))]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    got = df.select(D.simhash_of("a").alias("fp"), D.weighted_similarity("a", "b").alias("s"), "a", "b").collect()
    for r in got:
        n, (x, y) = len(r.a), (Counter(r.a), Counter(r.b))
        bits = sum(1 << b for b in range(64) if 2 * sum(c for h, c in x.items() if h >> b & 1) > n)
        assert r.fp & (1 << 64) - 1 == bits
        assert r.s == pytest.approx(sum((x & y).values()) / sum((x | y).values()))
