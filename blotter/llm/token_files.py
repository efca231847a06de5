"""Token-id files: flat unsigned integers plus 64-bit document offsets.

``write_token_files`` sorts documents by id, encodes them and writes, for every
partition, three flat little-endian files in a folder:

* ``tokens-PPPPP.bin``: the ids of its documents one after another, each
  document closed by the end id; uint16 when the vocabulary fits, else uint32;
* ``offsets-PPPPP.bin``: n + 1 int64 values, where each document starts inside
  the partition's ids;
* ``docs-PPPPP.bin``: n int64 document ids, then n bytes that are 0 where the id
  is null.

It returns the manifest: one row per partition with its file names, counts and
``base``, the number of ids in all partitions before it (a prefix sum over the
partitions' totals, one row each). ``read_token_files`` maps the files into
memory, or reads them by ranges where the store has no maps, and gives one row
per document.

Files are written under a name of the task attempt and the manifest names the
attempt that Spark kept, so a task that runs twice after a lost executor leaves
only an unused file.

Nulls and edges: a null text is an empty one (its only id is the end id); a null
document id sorts first and is read back as null; equal document ids keep one
entry per row, those rows ordered by the hash of their text, so that an id or a
row that repeats any number of times is dealt to many partitions; an empty table
gives an empty manifest and no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import file_system, pick, stored, text_or_empty
from .tokens import default_vocabulary, encoder, text_batches

MANIFEST = "part long, n_docs long, n_tokens long, width long, tokens_file string, offsets_file string, docs_file string"
PARTITION_BYTES = 256 << 20
#: Documents whose places a reader holds at a time.
READ_DOCS = 10_000
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text",
                      vocabulary: str | None = None, end_id: int = 0,
                      partitions: int | None = None) -> DataFrame:
    """Write the files to ``folder`` (a URI all executors reach); the manifest with bases.

    Texts are shuffled once, by ranges of the id. ``partitions`` defaults to one
    for each ``PARTITION_BYTES`` of texts, and to ``spark.sql.shuffle.partitions``
    at least; a task streams its documents and holds one Arrow batch of texts at a
    time.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), text_or_empty().alias("text"))
    n = partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                          -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PARTITION_BYTES))
    place = [F.col("id").asc_nulls_first(), "hash", "salt"]
    ordered = (rows.withColumns({"hash": F.xxhash64("text"), "salt": F.monotonically_increasing_id()})
               .repartitionByRange(n, *place).sortWithinPartitions(*place).select("id", "text"))

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        part = task.partitionId()
        enc = encoder(vocabulary)
        width = 2 if max(enc.vocabulary, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        store, root = file_system(folder)
        store.create_dir(root, recursive=True)
        names = [f"{kind}-{part:05d}-{task.taskAttemptId()}.bin" for kind in ("tokens", "offsets", "docs")]
        lengths, ids, known = [], [], []
        with store.open_output_stream(f"{root}/{names[0]}") as out:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                known.append(np.asarray(batch.column("id").is_valid()))
                ids.append(batch.column("id").fill_null(0).to_numpy())
                for a, b in text_batches(texts):
                    coded = [x + end for x in enc.ids(texts[a:b])]
                    lengths.append(np.array([len(x) // 4 for x in coded], "<i8"))
                    out.write(np.frombuffer(b"".join(coded), "<u4").astype(f"<u{width}").tobytes())
        if not lengths:
            return
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]).astype("<i8")
        for name, data in ((names[1], offsets.tobytes()),
                           (names[2], np.concatenate(ids).astype("<i8").tobytes()
                            + np.concatenate(known).astype("u1").tobytes())):
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
        yield pa.RecordBatch.from_pylist([{
            "part": part, "n_docs": len(offsets) - 1, "n_tokens": int(offsets[-1]), "width": width,
            "tokens_file": names[0], "offsets_file": names[1], "docs_file": names[2]}])

    parts = stored(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    return parts.select("*", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per document: id, first id's place over all files, number of ids, their checksum."""
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches):
        store, root = file_system(folder)

        def opened(name, kind):
            """A function that gives values from one place to another: mapped into memory, or read by range."""
            path, width = f"{root}/{name}", np.dtype(kind).itemsize
            if store.type_name == "local":
                size = store.get_file_info(path).size
                values = np.memmap(path, dtype=kind, mode="r") if size else np.empty(0, kind)
                return lambda a, b: values[a:b]
            file = store.open_input_file(path)
            return lambda a, b: np.frombuffer(file.read_at((b - a) * width, a * width), kind)

        for batch in batches:
            for row in batch.to_pylist():
                tokens = opened(row["tokens_file"], f"<u{row['width']}")
                offsets = opened(row["offsets_file"], "<i8")
                docs = opened(row["docs_file"], "u1")
                k = row["n_docs"]
                for a in range(0, k, READ_DOCS):
                    b = min(k, a + READ_DOCS)
                    at = offsets(a, b + 1)
                    ids = np.frombuffer(docs(8 * a, 8 * b).tobytes(), "<i8")
                    null = np.asarray(docs(8 * k + a, 8 * k + b)) == 0
                    crc = [zlib.crc32(tokens(i, j).astype("<u4").tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64(), mask=null), pa.array(at[:-1] + row["base"], pa.int64()),
                         pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.repartition(n, "part").mapInArrow(read, ROWS)
