"""Ball k-means codes, Merkle manifest and SentencePiece tables against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from blotter.llm import ball_codes as B
from blotter.llm import sentence_pieces as P
from blotter.llm.manifest import folded, merkle_manifest, siblings
from blotter.llm.word_ids import WordIds

MODEL = SentencePieceProcessor(model_file=P.default_model())


# --- ball k-means codes ---------------------------------------------------------------------------------

def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Every part against every entry, with Python integers."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v in kept), default=0) // parts)
    whole = [(i, v, [math.floor(x * scale) for x in v] + [0] * (parts * width - len(v))) for i, v in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[w[p * width:(p + 1) * width] for _, _, w in whole[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(w[p * width:(p + 1) * width], e)), k) for k, e in enumerate(books[p]))
                 for p in range(parts)] for _, _, w in whole]
    for _ in range(rounds):
        near = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [w[p * width:(p + 1) * width] for (_, _, w), n in zip(whole, near) if n[p][1] == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((str(i), bytes(k for _, k in n), sum(d for d, _ in n)) for (i, _, _), n in zip(whole, assign())), books


def vectors(count, dim=16, seed=1):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], rng.choice([None, 1, 2])) for i in range(count)]


EDGES = [(None, [0.5] * 16, 1), (None, None, None), (7, None, 1), (8, [float("nan")] * 16, 1), (9, [1.0, None], 2),
         (9, [float("inf")] * 16, 2), (3, [0.25] * 16, 1), (3, [0.25] * 16, 1), (5, [], None), (6, [1.0, -1.0, 0.1], 2),
         (2, [-0.00001] * 17, 1)]


@pytest.mark.parametrize("rows", [vectors(300), vectors(5), vectors(40) + EDGES, [(1, [], 0), (2, [], 0)],
                                  [(i, [1e300 * (i - 3), 2.5e17 * i, -1.0], 0) for i in range(40)],
                                  [(i, [float(i % 3)] * 8, 0) for i in range(50)]])
def test_codes_equal_plain_kmeans(spark, rows):
    df = spark.createDataFrame([(*r, b"x", "y") for r in rows],
                               "vec_id long, embedding array<double>, label int, code binary, vec string").repartition(3)
    codes, books = B.ball_codes(df)
    want, plain = plain_codes(rows)
    assert books == plain
    got = sorted((str(r.id), bytes(r.code), r.error) for r in codes.collect())
    assert got == [(i, c, e if e < 1 << 63 else None) for i, c, e in want]


def test_codes_of_floats_and_of_an_empty_table(spark):
    rows = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in vectors(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    codes, books = B.ball_codes(df)
    want, plain = plain_codes(rows)
    assert books == plain and sorted((str(r.id), bytes(r.code), r.error) for r in codes.collect()) == want
    sums = {}
    for r in codes.collect():
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert all(r.label_error == sums[r.label] for r in B.with_label_errors(codes).collect())
    none, books = B.ball_codes(df.limit(0))
    assert B.with_label_errors(none).collect() == [] and books == [[]] * 8


@settings(max_examples=200, deadline=None)
@given(st.data())
def test_a_ball_step_finds_the_nearest_entry(data):
    k, n, w = data.draw(st.integers(1, 6)), data.draw(st.integers(1, 20)), data.draw(st.integers(1, 3))
    numbers = st.integers(-3, 3).map(float)
    draw = lambda rows: np.array(data.draw(st.lists(st.lists(numbers, min_size=w, max_size=w), min_size=rows, max_size=rows)))
    x, before = draw(n), draw(k)
    after = np.where(np.array(data.draw(st.lists(st.booleans(), min_size=k, max_size=k)))[:, None], draw(k), before)
    moved = [not np.array_equal(a, b) for a, b in zip(before, after)]
    code, distance = B.ball_step(x, after, moved, B.nearest(x, before)[0])
    want, far = B.nearest(x, after)
    assert code.tolist() == want.tolist() and distance.tolist() == far.tolist()


# --- Merkle manifest ------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes, fanout):
    """Root and, per leaf, its (before, after) siblings up to it."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            first = at[i] // fanout * fanout
            run = nodes[first:first + fanout]
            path.append(("".join(run[:at[i] - first]), "".join(run[at[i] - first + 1:])))
            at[i] //= fanout
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain_manifest(rows, fanout):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = [plain_tree([leaf(r) for r in sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))], fanout)
             for k in keys]
    root, tops = plain_tree([t[0] for t in trees], fanout)
    out = []
    for k, (subroot, paths), top in zip(keys, trees, tops):
        ordered = sorted(groups[k], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        out += [(str(r[0]), leaf(r), subroot, root, "".join(a + b for a, b in p + top)) for r, p in zip(ordered, paths)]
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, key int, `a.b` int, pos int, root string"


def manifest_rows(n, langs, seed=2):
    rng = random.Random(seed)
    return [(rng.randrange(10 ** 9), rng.choice([None, "s", "ß"]), rng.choice(langs), rng.choice([None, i]), rng.choice([None, "", "Ab" * i]))
            for i in range(n)]


@pytest.mark.parametrize("rows,fanout", [
    (manifest_rows(1, [None]), 8), (manifest_rows(8, ["x"]), 8), (manifest_rows(9, ["x"]), 8), (manifest_rows(65, ["x", None]), 8),
    (manifest_rows(140, ["a", "b", "c", "d", "Z", "", None, "é", "zz", "日"]), 8), (manifest_rows(90, list("abcdefghijklm")), 3),
    ([(5, "s", "x", 1, "same")] * 30 + [(None, None, None, None, None)] * 9 + manifest_rows(20, ["x"]), 8)])
def test_manifest_equals_a_plain_tree(spark, rows, fanout):
    df = spark.createDataFrame([(*r, "l", 1, 2, 3, "r") for r in rows], SCHEMA).repartition(4)
    got = merkle_manifest(df, fanout=fanout, carry={"first": F.substring("text", 1, 1)})
    got = got.withColumn("again", folded(F.col("leaf"), F.col("path"))).withColumn("others", siblings(F.col("path"))).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.others) for r in got) == plain_manifest(rows, fanout)
    assert all(r.again == r.root for r in got)
    assert sorted(str(r.first) for r in got) == sorted(str(r[4] and r[4][:1]) if r[4] != "" else "" for r in rows)


def test_manifest_of_an_empty_table_and_of_tampered_rows(spark):
    df = spark.createDataFrame([(*r, "l", 1, 2, 3, "r") for r in manifest_rows(50, ["x", "y"])], SCHEMA)
    assert merkle_manifest(df.limit(0)).collect() == []
    other = merkle_manifest(df).withColumn("again", folded(F.sha2("leaf", 256), F.col("path")))
    assert other.filter(F.col("again") == F.col("root")).count() == 0


def test_a_row_that_repeats_is_put_in_order_by_many_tasks(spark, monkeypatch):
    from blotter.llm import manifest as M
    monkeypatch.setattr(M, "ROWS_OF_RANGE", 100)
    rows = spark.range(2000).select(F.lit("k").alias("key"), F.lit(1).alias("id"), F.col("id").alias("salt"))
    placed = M._in_order(rows, ["id", "salt"])
    assert sorted(r.pos for r in placed.select("pos").collect()) == list(range(2000))
    assert placed.select(F.spark_partition_id()).distinct().count() > 1


# --- SentencePiece --------------------------------------------------------------------------------------

ODD = [None, "", " ", "  ", "a ", " a", "   a  b", "▁", "a▁b", "▁▁x", "tab\tand\nline \n", "é é 漢字 🙂", "x" * 5000, "a b " * 4000,
       "</s> <unk> <0x41>", "a\x00b", "non breaking", "�", "​​", "word" * 30 + " " + "word" * 30]


def library(text):
    ids = MODEL.encode(text or "")
    return ids, MODEL.decode(ids)


@pytest.mark.parametrize("sizes", [{}, {"table_words": 2, "worker_words": 1}, {"table_words": 0}])
def test_pieces_equal_the_library(spark, sizes):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "same id"), (3, "same id")]
    rows += [(100 + i, f"some words {i} " * i) for i in range(40)]
    df = spark.createDataFrame([(*r, [1], "x", 2) for r in rows], "doc_id long, text string, ids array<int>, word string, n int").repartition(3)
    got = P.sentence_pieces(df, **sizes).collect()
    want = [(i, *library(t)) for i, t in rows]
    assert sorted((str(r.doc_id), list(r.ids), r.decoded) for r in got) == sorted((str(a), b, c) for a, b, c in want)


def test_pieces_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.sentence_pieces(df).collect() == []


SEGMENTER = P.Segmenter(P.default_model(), {"the": np.array(MODEL.encode("the"), "<u4").tobytes()}, 50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁\n\tathe.,é日\x00​"), st.characters(exclude_categories=["Cs"])),
                        max_size=30), max_size=5))
def test_marked_words_join_to_the_library_ids_of_any_text(texts):
    assert SEGMENTER.apart
    coded = SEGMENTER.ids(texts)
    assert [np.frombuffer(c, "<u4").tolist() for c in coded] == [MODEL.encode(t) for t in texts]
    assert [SEGMENTER.text(c) for c in coded] == [MODEL.decode(MODEL.encode(t)) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.text(alphabet=st.sampled_from("ab\x00é日x"), max_size=26), min_size=1, max_size=30).map(" ".join), max_size=6),
       st.integers(0, 20))
def test_packed_words_are_told_apart_exactly(texts, kept):
    def spell(words):  # each character becomes an id, so that joined ids spell the words
        return [np.array([ord(c) for c in w], "<u4").tobytes() for w in words]
    table = WordIds(spell, prefix="+", first_prefix="^", kept=kept)
    for part in (texts, texts[::-1], texts):
        got = ["".join(map(chr, np.frombuffer(b, "<u4"))) for b in table.ids(part)]
        assert got == ["^" + t.replace(" ", "+") for t in part]


def test_word_counts_are_those_of_all_texts(spark):
    df = spark.createDataFrame([(t,) for t in ["a b a", "a  b", None, "", " c"]], "text string").repartition(3)
    assert {r.word: r.n for r in P.word_counts(df).collect()} == {"a": 3, "b": 1, " b": 1, " c": 1}
