"""WARC archives: monolithic gzip, its normaliser, a sidecar index, and a reader.

* ``plan_records`` decides per page whether it is a response or revisits another
  one with an equal payload.
* ``write_monolithic`` writes one WARC file per partition as a single gzip
  stream, the form that cannot be read from the middle.
* ``normalise`` inflates each such stream once, in chunks, rewrites every record
  as a gzip member of its own and writes a sidecar index (``.idx``): one line
  per record with the member's offset and length.
* ``read_archives`` follows the index: it seeks to each member, inflates it
  alone, and parses the record.

Files go to a folder that all executors reach, under the task attempt's name;
the written manifest names the attempts that Spark kept.

Nulls and edges: a null payload is an empty one; a null page id is stored
without an id header and read back as null (it may revisit, and is never
referred to unless its whole group has null ids, when all of the group are
responses); payloads shorter than ``least_bytes`` are always responses; rows that
repeat their group's largest page id are all responses; an empty table writes
nothing. Line breaks in a URI are stored percent-encoded. Other columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import file_system, pick, shared_folder, stored, text_or_empty

LEAST_BYTES = 1000
FILES = "part long, warc string, records long"
MEMBERS = "part long, warc string, idx string, records long"
RECORDS = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "target_uri string, payload binary")
CHUNK = 1 << 20


def plan_records(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html", uri_col: str | None = "url",
                 least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page_id, uri, payload, refers_to): of equal payloads the largest page id is the response (null refers_to).

    Payloads meet by their SHA-256; only groups of copies are looked up, and those,
    one narrow row a group, are a written table: where they are few, Spark
    broadcasts them and no payload moves; where they are many, payloads are
    shuffled once, small and single ones by keys of their own, and adaptive
    execution splits a group of any size, as it does with joins of scanned tables.
    """
    columns = {"page_id": id_col, "payload": payload_col} | ({"uri": uri_col} if uri_col else {})
    rows = pick(pages, **columns).withColumn("payload", text_or_empty("payload"))
    if not uri_col:
        rows = rows.withColumn("uri", F.lit(None).cast("string"))
    rows = rows.withColumn("page_id", F.col("page_id").cast("long"))
    large = F.octet_length("payload") >= least_bytes
    digest = F.sha2("payload", 256)
    groups = (rows.filter(large).select("page_id", digest.alias("digest")).groupBy("digest")
              .agg(F.max("page_id").alias("newest"), F.count("*").alias("copies"))
              .filter((F.col("copies") > 1) & F.col("newest").isNotNull()).drop("copies"))
    groups = stored(groups, "payload-groups")
    own = F.concat(F.lit("-"), F.monotonically_increasing_id().cast("string"))  # matches no digest
    joined = rows.withColumn("digest", F.when(large, digest).otherwise(own)).join(groups, "digest", "left")
    is_newest = F.coalesce(F.col("page_id") == F.col("newest"), F.lit(False))
    return joined.select("page_id", "uri", "payload", F.when(~is_newest, F.col("newest")).alias("refers_to"))


def _record(page_id, uri, payload: bytes, refers_to) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            "Content-Type: text/html; charset=utf-8", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if uri is not None:
        head.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = payload if refers_to is None else b""
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _parse(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    number = lambda f: int(f[len("<urn:page:"):-1]) if f else None
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if fields["WARC-Type"] == "response" and hashlib.sha1(body).digest() != digest:
        raise ValueError("payload and digest differ")
    return {"page_id": number(fields.get("WARC-Record-ID")), "payload_bytes": int(fields["X-Payload-Length"]),
            "payload_digest": digest.hex(), "record_type": fields["WARC-Type"],
            "refers_to": number(fields.get("WARC-Refers-To")), "target_uri": fields.get("WARC-Target-URI"),
            "payload": body if fields["WARC-Type"] == "response" else None}


def write_monolithic(records: DataFrame, folder: str, *, level: int = 4) -> DataFrame:
    """One ``.warc.gz`` per partition, a single gzip stream each; the manifest of what was written."""
    def write(batches):
        from pyspark import TaskContext

        task, store_root = TaskContext.get(), None
        out = gz = None
        n, name = 0, f"part-{task.partitionId():05d}-{task.taskAttemptId()}.warc.gz"
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("page_id", "uri", "payload", "refers_to")]):
                if out is None:
                    store, store_root = file_system(folder)
                    store.create_dir(store_root, recursive=True)
                    out, gz = store.open_output_stream(f"{store_root}/{name}", compression=None), zlib.compressobj(level, zlib.DEFLATED, 31)
                out.write(gz.compress(_record(row[0], row[1], row[2].encode(), row[3])))
                n += 1
        if out is not None:
            out.write(gz.flush())
            out.close()
            yield pa.RecordBatch.from_pylist([{"part": task.partitionId(), "warc": name, "records": n}])

    return stored(records.select("page_id", "uri", "payload", "refers_to").mapInArrow(write, FILES), "warc-files")


def split_records(chunks):
    """Whole records from the chunks of an inflated WARC stream, holding one record at a time."""
    buffer = bytearray()
    for chunk in chunks:
        buffer += chunk
        at = 0
        while True:
            end = buffer.find(b"\r\n\r\n", at)
            if end < 0:
                break
            head = bytes(buffer[at:end]).lower()
            i = head.rindex(b"\r\ncontent-length:") + len(b"\r\ncontent-length:")
            stop = end + 4 + int(head[i:].split(b"\r\n", 1)[0]) + 4
            if stop > len(buffer):
                break
            yield bytes(buffer[at:stop])
            at = stop
        del buffer[:at]
    if buffer.strip():
        raise ValueError("the stream ends inside a record")


def _inflated(f):
    """Chunks of bounded size of a gzip file that may hold one member or several."""
    unzip = zlib.decompressobj(31)
    while data := f.read(CHUNK):
        while data:
            if unzip.eof:
                unzip = zlib.decompressobj(31)
            yield unzip.decompress(data, CHUNK)
            data = unzip.unconsumed_tail or unzip.unused_data
    while tail := unzip.decompress(unzip.unconsumed_tail, CHUNK):
        yield tail
    if not unzip.eof:
        raise ValueError("the gzip stream is cut off")


def normalise(files: DataFrame, source: str, target: str, *, level: int = 4) -> DataFrame:
    """Rewrite each archive named in ``files`` with a gzip member per record, beside a sidecar index."""
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rewrite(batches):
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        store_in, root_in = file_system(source)
        store, root = file_system(target)
        store.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                name = row["warc"].removesuffix(".warc.gz") + f"-{attempt}.warc.gz"
                index, offset, count = name.removesuffix(".warc.gz") + ".idx", 0, 0
                with (store_in.open_input_stream(f"{root_in}/{row['warc']}", compression=None) as f,
                      store.open_output_stream(f"{root}/{name}", compression=None) as out,
                      store.open_output_stream(f"{root}/{index}") as idx):
                    for record in split_records(_inflated(f)):
                        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = gz.compress(record) + gz.flush()
                        out.write(member)
                        idx.write(f"{offset} {len(member)}\n".encode())
                        offset, count = offset + len(member), count + 1
                if count != row["records"]:
                    raise ValueError(f"{row['warc']} holds {count} records, not {row['records']}")
                yield pa.RecordBatch.from_pylist([{"part": row["part"], "warc": name, "idx": index, "records": count}])

    return stored(files.repartition(n, "part").mapInArrow(rewrite, MEMBERS), "warc-members")


def read_archives(members: DataFrame, folder: str, *, payloads: bool = True) -> DataFrame:
    """One row per record, each member found by the sidecar index and inflated by itself."""
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = RECORDS if payloads else RECORDS.rsplit(",", 1)[0]
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    shape = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    def read(batches):
        store, root = file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{root}/{row['idx']}") as f:
                    places = [tuple(map(int, x.split())) for x in f.read().decode().splitlines()]
                rows, size = [], 0
                with store.open_input_file(f"{root}/{row['warc']}") as f:
                    for offset, length in places:
                        f.seek(offset)
                        record = _parse(zlib.decompress(f.read(length), 31))
                        rows.append({c: record[c] for c in names})
                        size += record["payload_bytes"]
                        if size > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=shape)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=shape)

    return members.repartition(n, "part").mapInArrow(read, schema)


def archive_round_trip(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html",
                       uri_col: str | None = "url", folder: str | None = None, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write, normalise, and read back; ``folder`` defaults to a new one in the shared folder."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    records = plan_records(pages, id_col=id_col, payload_col=payload_col, uri_col=uri_col, least_bytes=least_bytes)
    files = write_monolithic(records, f"{folder}/monolithic")
    members = normalise(files, f"{folder}/monolithic", f"{folder}/members")
    return read_archives(members, f"{folder}/members", payloads=False)
