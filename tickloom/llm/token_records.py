"""Token ids as length-delimited binary records with masked checksums, and an offset index beside them.

A shard file is a run of records, each:

    u64 n        bytes of the payload
    u32          masked CRC-32 of those eight bytes
    n bytes      payload: u8 bytes per id (2 or 4), u8 1 if the document has no id, i64 doc_id, the ids
    u32          masked CRC-32 of the payload

All numbers are little-endian. The mask rotates a checksum right by 15 bits and adds 0xA282EAD8, so
that a checksum stored inside checksummed data does no harm. `<folder>/data` holds the shards in
ascending id order, `<folder>/index` (Parquet) one row per record: doc_id, shard, offset, n_bytes,
n_tokens, start (ids before it in the shard). A task that is run again writes a shard of a new name;
only shards named by the committed index count. Any order of index rows can be read, so a shuffled
read sorts the index, not the data.

Cases: a NULL or empty text is a record with the end id alone; a NULL id sorts first and reads back as
NULL; equal ids are ordered by text; an empty table gives an empty index; other columns are ignored.
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

from tickloom.llm.staging import new_folder, open_store
from tickloom.llm.token_ids import default_path, encoder
from tickloom.llm.words import slices, text_bytes
from tickloom.llm.workers import ship

INDEX = "doc_id long, shard string, offset long, n_bytes long, n_tokens long, start long"
RECORD = "doc_id long, shard string, offset long, start long, n_tokens long, ids binary"
#: Bytes of records read at once.
READ = 8 << 20


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    payload = struct.pack("<BBq", ids.dtype.itemsize, doc_id is None, doc_id or 0) + ids.tobytes()
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview) -> tuple[int | None, np.ndarray]:
    """The record that fills `data`; ValueError if a length or checksum is wrong."""
    (size,) = struct.unpack_from("<Q", data)
    if len(data) != size + 16 or struct.unpack_from("<I", data, 8)[0] != masked(data[:8]):
        raise ValueError("damaged record length")
    payload = data[12 : 12 + size]
    if struct.unpack_from("<I", data, 12 + size)[0] != masked(payload):
        raise ValueError("damaged record")
    width, missing, doc_id = struct.unpack_from("<BBq", payload)
    return None if missing else doc_id, np.frombuffer(payload, f"<u{width}", offset=10)


def write_records(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Encode every text, append `end_id`, write shards and index under `folder`; returns the index."""
    out = pa.schema([("doc_id", pa.int64()), ("shard", pa.string()), *((c, pa.int64()) for c in ("offset", "n_bytes", "n_tokens", "start"))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        store, base = open_store(f"{folder}/data")
        shard = f"part-{TaskContext.get().partitionId():07d}-{uuid.uuid4().hex}"
        sink, offset, start = None, 0, 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids, at = coder.encode(*text_bytes(part.column("text")))
                if sink is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(f"{base}/{shard}")
                end = np.array([end_id], ids.dtype)
                keys = part.column("doc_id").to_pylist()
                framed = [frame(key, np.concatenate([ids[at[i] : at[i + 1]], end])) for i, key in enumerate(keys)]
                sink.write(b"".join(framed))
                sizes = np.array([len(x) for x in framed], np.int64)
                counts = np.diff(at) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([shard] * len(keys)), *(pa.array(x, pa.int64()) for x in (offset + np.cumsum(sizes) - sizes, sizes, counts, start + np.cumsum(counts) - counts))],
                    schema=out,
                )
                offset, start = offset + int(sizes.sum()), start + int(counts.sum())
        if sink is not None:
            sink.close()

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(write, INDEX).write.parquet(f"{folder}/index")
    return read_index(docs.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of index rows, in their order, checked; neighbours in a shard are read at once."""
    out = pa.schema([("doc_id", pa.int64()), ("shard", pa.string()), ("offset", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(f"{folder}/data")
        source, opened = None, None
        for batch in batches:
            shards = batch.column("shard").to_pylist()
            offsets, sizes, counts, starts = (batch.column(c).to_numpy() for c in ("offset", "n_bytes", "n_tokens", "start"))
            first = 0
            while first < len(shards):
                last = first + 1
                while last < len(shards) and shards[last] == shards[first] and offsets[last] == offsets[last - 1] + sizes[last - 1] and offsets[last] + sizes[last] - offsets[first] <= READ:
                    last += 1
                if opened != shards[first]:
                    if source is not None:
                        source.close()
                    source, opened = store.open_input_file(f"{base}/{shards[first]}"), shards[first]
                source.seek(int(offsets[first]))
                data = memoryview(source.read(int(offsets[last - 1] + sizes[last - 1] - offsets[first])))
                got = [unframe(data[offsets[i] - offsets[first] : offsets[i] - offsets[first] + sizes[i]]) for i in range(first, last)]
                if any(len(ids) != n for (_, ids), n in zip(got, counts[first:last], strict=True)):
                    raise ValueError("index and record differ")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in got], pa.int64()), pa.array(shards[first:last]), pa.array(offsets[first:last]), pa.array(starts[first:last]), pa.array(counts[first:last]), pa.array([x.astype("<u4").tobytes() for _, x in got], pa.binary())],
                    schema=out,
                )
                first = last
        if source is not None:
            source.close()

    ship(index.sparkSession)
    return index.select("doc_id", "shard", "offset", "n_bytes", "n_tokens", "start").mapInArrow(read, RECORD)


def shard_starts(index: DataFrame) -> DataFrame:
    """shard, base: ids in all shards before it; the running total is over one row per shard."""
    shards = index.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def shuffled(index: DataFrame, seed: int) -> DataFrame:
    """Index rows in a random order that the seed fixes."""
    return index.orderBy(F.xxhash64(F.lit(seed), "shard", "offset"), "shard", "offset")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = pa.array([zlib.crc32(x.as_buffer()) for x in batch.column("ids")], pa.int64())
        kept = ["doc_id", "shard", "start", "n_tokens"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), crc], [*kept, "ids_crc32"])


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files read back."""
    folder = new_folder(spark, "records")
    index = write_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder, default_path())
    digests = read_records(index, folder).mapInArrow(_digest, "doc_id long, shard string, start long, n_tokens long, ids_crc32 long")
    start = (F.col("start") + F.col("base")).alias("start")
    return digests.join(shard_starts(index), "shard").select("doc_id", start, "n_tokens", "ids_crc32")
