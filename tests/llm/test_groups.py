"""Components, SimHash groups and embedding groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from blotter.llm import simhash as H
from blotter.llm.components import connected_components
from blotter.llm.embeddings import embedding_groups
from blotter.llm.queries import op4_simhash_bk_trees
from conftest import SF_SMALL


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(1, 60)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    links += [(-5, n) for n in range(300, 340)] + [(7, 7), (1, 2)]
    df = spark.createDataFrame(links + [(None, 4)], "src long, dst long")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.root for r in connected_components(df).collect()} == union(links, nodes)
    assert connected_components(df.limit(0)).collect() == []


def fingerprint(text, k=3):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ")
             .replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    runs = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in ("", " \t", "One", "two Words", "a b c", "a b c d a b c", "É nbsp stays one\x0bword Ünder", "x " * 70_000):
        assert H.simhash(text, 3) & (1 << 64) - 1 == fingerprint(text)


def near(fps, radius):
    return [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_dense_fingerprints_are_dealt_into_small_shards(spark):
    fps = [0x1234_5678_0000_0000 | i for i in range(1 << 14)]  # each within two bits of 105 others
    entries = spark.createDataFrame([(f,) for f in fps], "fp long")
    shards = H.shard_rows(entries, 2, 2000).groupBy("shard").count()
    assert shards.agg({"count": "max"}).first()[0] <= 2000 and shards.count() > 50
    links = H.fingerprint_links(entries)
    assert {r.root for r in connected_components(links).collect()} == {fps[0]}


@pytest.mark.parametrize("crowded", [2000, 3])
def test_fingerprint_links_find_all_groups(spark, crowded):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 4, 12])):
            x = base
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 2, 3])):
                x ^= 1 << b
            fps.add(signed(x))
    fps = sorted(fps)
    links = H.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowded=crowded)
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = union(near(fps, 2), fps)
    assert {f: got.get(f, f) for f in fps} == want
    assert all(((r.src ^ r.dst) != 0) for r in links.collect())


def test_bk_tree_finds_exactly_the_radius():
    rng = random.Random(9)
    fps = [rng.getrandbits(12) for _ in range(400)]
    tree = H.BKTree(2)
    for i, fp in enumerate(fps):
        assert sorted(tree.insert_and_find(fp)) == [j for j in range(i) if (fps[j] ^ fp).bit_count() <= 2]


def test_simhash_groups_edges(spark):
    rows = [(5, "same words in this text here"), (3, "Same words in this text here"), (None, "same words in this text here"),
            (8, None), (9, ""), (4, " \n"), (None, "only a null id has this"), (7, "x y z " * 30_000), (7, "x y z " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, fp int, key string")
    got = sorted(((r.doc_id, r.component_id) for r in H.simhash_groups(df).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (None, 3), (8, 4), (9, 4), (4, 4), (None, None), (7, 7), (7, 7)], key=str)
    assert H.simhash_groups(df.limit(0)).collect() == []


def test_simhash_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    fps = {d: fingerprint(t) for d, t in docs.items()}
    ids = sorted(fps)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fps[a] ^ fps[b]).bit_count() <= 2]
    want = union(links, ids)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op4_simhash_bk_trees(spark, SF_SMALL).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in ids}


@pytest.mark.parametrize("block", [2048, 4])
def test_embedding_groups(spark, block):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 16))
    rows = []
    for c in centres:
        for _ in range(rng.integers(1, 8)):
            rows.append((c + rng.normal(0, rng.choice([0.02, 0.1, 0.25]), 16)).astype(np.float32).tolist())
    rows += [rows[0]] * 9 + [[2 * x for x in rows[0]]]
    ids = [int(i) for i in rng.permutation(len(rows)) + 10]
    bad = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] + [1.0] * 15), (904, [float("inf")] + [1.0] * 15),
           (905, [None] + [1.0] * 15), (906, [1.0, 2.0]), (907, [1.0, 2.0])]
    data = [(i, v, 0, 1) for i, v in zip(ids, rows)] + [(i, v, 0, 1) for i, v in bad] + [(None, rows[0], 0, 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, key int").repartition(3)
    got = {r.vec_id: r for r in embedding_groups(df, block=block).collect()}
    x = np.array(rows, np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    cos = x @ x.T
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if cos[i, j] >= 0.9]
    found = sum(got[i].n_links for i in ids)
    assert 0.9 * 2 * len(links) <= found <= 2 * len(links)
    if found == 2 * len(links):
        want = union(links, ids)
        assert {i: got[i].component_id for i in ids} == want
    assert all(got[i].kept == (got[i].component_id == i) for i in ids)
    for i in (900, 901, 902, 903, 904, 905):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[907].n_links, got[907].component_id, got[907].kept) == (1, 906, False)
    assert (got[None].n_links, got[None].component_id, got[None].kept) == (0, None, False)
    assert embedding_groups(df.limit(0)).collect() == []


def test_embedding_recall(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((400, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    away = rng.standard_normal((400, 32))
    away -= (away * base).sum(axis=1)[:, None] * base
    away /= np.linalg.norm(away, axis=1)[:, None]
    c = 0.905  # just above the threshold, the hardest pairs to meet
    rows = np.concatenate([base, c * base + np.sqrt(1 - c * c) * away])
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    got = embedding_groups(df).collect()
    x = rows / np.linalg.norm(rows, axis=1)[:, None]
    links = int((np.triu(x @ x.T, 1) >= 0.9).sum())
    assert sum(r.n_links for r in got) >= 0.9 * 2 * links
