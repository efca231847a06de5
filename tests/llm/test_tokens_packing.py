"""Token files and packing against plain loops over the same documents."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm.common import shared_folder
from blotter.llm.packing import TIERS, pack_documents
from blotter.llm.token_files import read_token_files, write_token_files
from blotter.llm.tokens import Encoder, default_vocabulary

ENCODER = Encoder(default_vocabulary())
PLAIN = Tokenizer.from_file(default_vocabulary())
ODD = ["", " ", "a", "  two  blanks ", "tab\tand\nline\r\n\r\n end ", "non breaking   em", "\x1cfile\x0bvt \x85nel",
       "<|endoftext|> a<|endoftext|>b", "it's we'll 1234 5,6.7", "日本語 テキスト", "é combining", "x" * 5000, "a b " * 3000,
       "🙂🙂 🙂", "trailing \n", "\n\n\nleading", "don't  'tis   ''s"]


def ids_of(text, end):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_parts_encode_as_the_whole_text():
    assert [list(np.frombuffer(b, "<u4")) for b in ENCODER.ids(ODD)] == [PLAIN.encode(t, add_special_tokens=False).ids for t in ODD]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x1c 　'abZ1,.é日"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_parts_encode_as_the_whole_text_for_any_text(text):
    assert list(np.frombuffer(ENCODER.ids([text])[0], "<u4")) == PLAIN.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t) for i, t in enumerate(ODD)] + [(None, "no id"), (None, None), (6, "same id"), (6, "same id"), (1000, None)]
    rows += [(2000 + i, f"word{i} " * (37 * i % 900)) for i in range(60)]
    return spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "doc_id long, text string, part string, base int").repartition(5)


def test_token_files(spark, docs):
    folder = shared_folder(spark, "t")
    manifest = write_token_files(docs, folder, partitions=4)
    got = [tuple(r) for r in read_token_files(manifest, folder).collect()]
    def place(row):  # equal ids stand by the hash of their text
        mixed = xxhash.xxh64_intdigest(row[1].encode(), seed=42)
        return row[0] is not None, row[0] or 0, mixed - (1 << 64) if mixed >> 63 else mixed
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=place)
    want, start = [], 0
    for doc_id, text in rows:
        ids = ids_of(text, 0)
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert {r.width for r in manifest.collect()} == {2}


@pytest.mark.parametrize("text", ["same words", None])
def test_rows_that_share_an_id_are_dealt_to_many_files(spark, text):
    words = F.lit(text) if text else F.concat(F.lit("words "), F.col("id").cast("string"))
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), words.alias("text")).repartition(4)
    folder = shared_folder(spark, "t")
    manifest = write_token_files(docs, folder, partitions=6)
    assert max(r.n_docs for r in manifest.collect()) < 1000
    rows = sorted(read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    assert len(rows) == 3000 and all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))


def test_token_files_of_an_empty_table(spark, docs):
    folder = shared_folder(spark, "t")
    assert read_token_files(write_token_files(docs.limit(0), folder), folder).collect() == []


@pytest.mark.parametrize("buffer_tokens", [300, 4_000_000])
def test_packing(spark, docs, buffer_tokens):
    pieces = pack_documents(docs, buffer_tokens=buffer_tokens, step_tokens=4096, with_ids=True).collect()
    assert pieces == [] or set(pieces[0].asDict()) >= {"tier", "step_group"}
    placed = defaultdict(list)
    for p in pieces:
        placed[p.sequence_id].append(p)
        assert p.ids_crc32 == crc(p.ids) and p.length == len(p.ids) > 0
    small = 0
    for window in placed.values():
        window.sort(key=lambda p: p.offset)
        at = 0
        for p in window:
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0 and {p.tier for p in window} == {at}  # no window is padded
        small += at not in TIERS
    assert small <= 5 * 6  # the powers of two below the smallest tier, once per input split
    steps = defaultdict(int)
    for window in placed.values():
        steps[window[0].step_group] += window[0].tier
    assert max(steps.values()) <= 4096
    # every document's ids come back, whole and in order
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(ids_of(r.text, 1))
    back = defaultdict(list)
    for p in pieces:
        back[p.doc_id].append((p.doc_tokens, p.start, list(p.ids)))
    for doc_id, want in texts.items():
        if len(want) == 1:
            got = [x for _, _, ids in sorted(back[doc_id], key=lambda x: x[1]) for x in ids]
            assert got == want[0] and {n for n, _, _ in back[doc_id]} == {len(want[0])}
        else:
            assert sum(len(ids) for _, _, ids in back[doc_id]) == sum(map(len, want))


def test_packing_of_an_empty_table(spark, docs):
    assert pack_documents(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        pack_documents(docs, tiers=(100,))
