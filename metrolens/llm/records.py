"""Token-ID records: whole texts encoded and written as length-delimited binary files with an offset index.

Method: documents are range-partitioned by doc_id and sorted, so that the files one after another hold them in
ascending order. Each task encodes its documents and writes one record file and one index file.

Record: length (u64), masked CRC-32 of the length (u32), payload, masked CRC-32 of the payload (u32), all
little-endian. Payload: doc_id (i64), flag doc_id present (u8), bytes per id (u8), ids. Index: per record doc_id
(i64), offset (i64), whole length (i64): a shuffled reader seeks by it. The mask rotates the checksum right by 15
bits and adds a constant, so that checksums of data which holds checksums stay useful.

Files get a name of their own per task attempt; the manifest (Parquet, written by Spark when all tasks are done)
lists the files that count, so attempts of lost executors leave no trace in a result. Files go to any store that
pyarrow opens by the folder's URI (file, hdfs, s3, gs).

Nulls: a null text is empty, a null doc_id is kept as such and comes first. Repeated rows each give a record.
An empty table gives no files and an empty result. Other columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolens.llm.common import ship, text_rows
from metrolens.llm.tokens import encoded, encoder

ship(__name__)

MASK_DELTA = 0xA282EAD8  # fixed value: mask constant of the TFRecord format
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def open_store(uri: str):
    """(file system, path in it) of a URI or local path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked_crc(head)), payload, struct.pack("<I", masked_crc(payload))))


def unframe(read) -> bytes | None:
    """The next payload of ``read(n)``; None at the end. Raises on a broken checksum or a cut file."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked_crc(head[:8]):
        raise ValueError("record length is damaged")
    size = struct.unpack("<Q", head[:8])[0]
    body = read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked_crc(body[:size]):
        raise ValueError("record payload is damaged")
    return body[:size]


def pack_payload(doc_id, ids: np.ndarray) -> bytes:
    return struct.pack("<qBB", doc_id or 0, doc_id is not None, ids.dtype.itemsize) + ids.tobytes()


def unpack_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, present, width = struct.unpack_from("<qBB", payload)
    return doc_id if present else None, np.frombuffer(payload, f"<u{width}", offset=10)


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> DataFrame:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, write records below ``folder``.

    Returns the manifest: part int, file, index string, records, tokens, bytes long.
    """
    schema = "part int, file string, index string, records long, tokens long, bytes long"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        wide = enc.dtype if end_id < 1 << 8 * enc.dtype.itemsize else np.dtype("<u4")
        end = np.array([end_id], wide)
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        name = f"{root}/part-{part:06d}-{uuid.uuid4().hex}"
        at = n = tokens = 0
        index = []
        with store.open_output_stream(f"{name}.rec", buffer_size=READ_BYTES) as out:
            for batch in batches:
                for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(enc, batch.column(1))):
                    ids = np.concatenate((ids.astype(wide, copy=False), end))
                    rec = frame(pack_payload(doc_id, ids))
                    out.write(rec)
                    index.append((doc_id or 0, at, len(rec)))
                    at, n, tokens = at + len(rec), n + 1, tokens + len(ids)
        with store.open_output_stream(f"{name}.idx") as out:
            out.write(np.array(index, "<i8").tobytes())
        if n:
            yield pa.RecordBatch.from_pylist([{"part": part, "file": f"{name}.rec", "index": f"{name}.idx",
                                               "records": n, "tokens": tokens, "bytes": at}], schema=wanted)

    wanted = pa.schema([("part", pa.int32()), ("file", pa.string()), ("index", pa.string()), ("records", pa.int64()),
                        ("tokens", pa.int64()), ("bytes", pa.int64())])
    ordered = text_rows(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, schema).write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.parquet(f"{folder}/manifest")


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records below ``folder``: doc_id long, start long (ids of all records before it), n_tokens long, ids
    binary (little-endian unsigned 32-bit integers). Checksums are verified."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    files = manifest.count()  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    listed = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                with store.open_input_stream(file, buffer_size=READ_BYTES) as src:
                    while (payload := unframe(src.read)) is not None:
                        doc_id, ids = unpack_payload(payload)
                        rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                        start, held = start + len(ids), held + 4 * len(ids)
                        if held > BATCH_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    names, types = ["doc_id", "start", "n_tokens", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return (listed.select("file", "base").repartition(max(1, files), "file")
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))
