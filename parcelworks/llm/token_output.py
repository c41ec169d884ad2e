"""Token-id output with bit-plane shuffling, and the reader for its files.

File format (little-endian throughout)::

    "BPLN"  u32 version=1  u32 block_ids
    chunk*        per block: one zstandard frame per plane
    trailer       zstandard frame: u32 blocks, u32 documents, then as int64
                  a row (first id, ids, file offset, plane lengths) per block,
                  a row (has id, doc_id, number of ids) per document
    u64 trailer_offset  u64 trailer_bytes  "BPLN"

Ids are cut into blocks of ``block_ids`` 32-bit values.  A block's 4 * n bytes
are transposed into 4 byte planes (all lowest bytes, then all second bytes,
...) or into 32 bit planes, and every plane is compressed by itself; the high
planes of token ids are nearly constant and almost vanish.  With the chunk
index a reader fetches any id range without decompressing the rest.

Writing: documents are range-partitioned by doc_id and sorted; each task
writes its range as files of about ``shard_ids`` ids to the shared folder and
returns one row per file.  Only files named in that committed table count, so
the files of a lost or repeated task attempt are never read.

Defined results: null text counts as empty (only the end id); documents with
a null doc_id come first; equal doc_ids are ordered by a hash of the text,
then the text; repeated rows are repeated documents; an empty table gives no
files and no documents; very long texts span any number of blocks; extra
columns are ignored.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, own_columns, stored
from .tokenizing import word_encoder

BLOCK_IDS = 1 << 16
MAGIC = b"BPLN"


def pack_block(ids: np.ndarray, bits: bool = False) -> tuple[list[bytes], int]:
    """The compressed planes of one block of u32 ids."""
    raw = np.ascontiguousarray(ids, "<u4")
    planes = raw.view(np.uint8).reshape(-1, 4).T
    if bits:
        planes = [np.packbits((raw >> np.uint32(b)) & np.uint32(1)) for b in range(32)]
    squeeze = zstandard.ZstdCompressor(level=3).compress
    return [squeeze(np.ascontiguousarray(p).tobytes()) for p in planes], len(raw)


def unpack_block(planes: list[bytes], n: int) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    raw = [np.frombuffer(expand(p, max_output_size=n + 8) if n else b"", np.uint8) for p in planes]
    if len(planes) == 32:
        out = np.zeros(n, np.uint32)
        for b, p in enumerate(raw):
            out |= np.unpackbits(p, count=n).astype(np.uint32) << np.uint32(b)
        return out
    return np.ascontiguousarray(np.stack(raw, axis=1)).view("<u4").ravel() if n else np.zeros(0, np.uint32)


def write_shard(ids: np.ndarray, documents: list[tuple[int | None, int]], block_ids: int = BLOCK_IDS, bits: bool = False) -> bytes:
    """One file: the ids and, in order, the (doc_id, number of ids) of its documents."""
    parts, index, at = [MAGIC + struct.pack("<II", 1, block_ids)], [], 12
    for first in range(0, len(ids), block_ids):
        planes, n = pack_block(ids[first : first + block_ids], bits)
        index.append([first, n, at, *map(len, planes)])
        parts += planes
        at += sum(map(len, planes))
    listed = [[doc is not None, doc or 0, n] for doc, n in documents]
    trailer = struct.pack("<II", len(index), len(listed)) + b"".join(np.array(x, "<i8").tobytes() for x in (index, listed))
    packed = zstandard.ZstdCompressor().compress(trailer)
    parts.append(packed + struct.pack("<QQ", at, len(packed)) + MAGIC)
    return b"".join(parts)


def _trailer(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    if data[:4] != MAGIC or data[-4:] != MAGIC:
        raise ValueError("not a bit-plane token file")
    at, size = struct.unpack("<QQ", data[-20:-4])
    raw = zstandard.ZstdDecompressor().decompress(data[at : at + size])
    blocks, documents = struct.unpack("<II", raw[:8])
    values = np.frombuffer(raw[8:], "<i8")
    split = len(values) - 3 * documents
    return values[:split].reshape(blocks, -1 if blocks else 7), values[split:].reshape(documents, 3)


def read_documents(data: bytes) -> list[tuple[int | None, int, int]]:
    """(doc_id, start, number of ids) of a file's documents."""
    rows = _trailer(data)[1]
    starts = np.cumsum(rows[:, 2]) - rows[:, 2]
    return [(int(d) if has else None, int(s), int(n)) for (has, d, n), s in zip(rows, starts, strict=True)]


def read_shard(data: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Ids [start, stop) of a file; only the blocks of that range are decompressed."""
    index = _trailer(data)[0]
    if stop is None:
        stop = int(index[-1, 0] + index[-1, 1]) if len(index) else 0
    out = []
    for row in index:
        first, count, offset = (int(x) for x in row[:3])
        if first < stop and first + count > start:
            planes = []
            for length in row[3:]:
                planes.append(data[offset : offset + int(length)])
                offset += int(length)
            out.append(unpack_block(planes, count)[max(0, start - first) : stop - first])
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


# Schemes of the shared folder -> how tasks open it (s3a and s3n are names that only Hadoop uses).
_STORES = {"": "local", "file": "local", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "abfs": "uri", "abfss": "uri"}
_S3 = {"access.key": "access_key", "secret.key": "secret_key", "session.token": "session_token", "endpoint": "endpoint_override", "endpoint.region": "region"}


def store_of(folder: str, settings: dict[str, str]) -> tuple[str, str, dict[str, str]]:
    """(kind, path, options) with which a task opens the shared folder; ``settings`` are the session's.

    Object stores take their keys from the session's ``spark.hadoop.fs.s3a.*``, where it has them.
    An unknown scheme raises here, before any work is done."""
    parts = urlsplit(folder)
    kind = _STORES.get(parts.scheme)
    if kind is None:
        raise ValueError(f"token files cannot be written to {parts.scheme}://, only to {', '.join(filter(None, _STORES))}")
    if kind == "local":
        return kind, re.sub("^file:(//)?", "", folder), {}
    if kind == "s3":
        held = {name: settings.get(f"spark.hadoop.fs.s3a.{key}") for key, name in _S3.items()}
        return kind, f"{parts.netloc}{parts.path}", {k: v for k, v in held.items() if v}
    if kind == "hdfs":
        return kind, parts.path, {"host": parts.hostname or "default", "port": parts.port or 0}
    return kind, f"{parts.netloc}{parts.path}" if kind == "gs" else folder, {}


def _put(store: tuple[str, str, dict[str, str]], name: str, data: bytes) -> None:
    """Write a file to the shared folder from a task."""
    from pyarrow import fs

    kind, path, options = store
    if kind == "uri":
        opened, path = fs.FileSystem.from_uri(path)
    else:
        made = {"local": "LocalFileSystem", "s3": "S3FileSystem", "gs": "GcsFileSystem", "hdfs": "HadoopFileSystem"}[kind]
        opened = getattr(fs, made)(**options)
    opened.create_dir(path, recursive=True)
    with opened.open_output_stream(f"{path}/{name}") as out:
        out.write(data)


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 1, shard_ids: int = 1 << 20) -> tuple[str, DataFrame]:
    """Write all documents' ids; returns the folder and the committed file table.

    The table has a row per file: part, shard, name, n_ids.  ``tokenizer`` is
    the path of a tokenizers file.  A task's memory is bounded by a shard plus
    its longest document.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    store = store_of(folder, dict(spark.sparkContext.getConf().getAll()))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (
        own_columns(docs, "doc_id", "text")
        .withColumn("text", F.coalesce("text", F.lit("")))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def encode(batches):
        encode_words = word_encoder(tokenizer)
        part, shard, held, ids, rows = 0, 0, 0, [], []
        end, run = struct.pack("<I", end_id), uuid.uuid4().hex

        def flush():
            name = f"{part:06d}-{shard:06d}-{run}.bpl"
            _put(store, name, write_shard(np.frombuffer(b"".join(ids), "<u4"), rows))
            return pd.DataFrame({"part": [part], "shard": [shard], "name": [name], "n_ids": [held]})

        for batch in batches:
            blobs = encode_words(batch["text"])
            for number, doc_id, blob in zip(batch["part"], batch["doc_id"].astype("Int64"), blobs, strict=True):
                part, length = int(number), len(blob) // 4 + 1
                rows.append((None if doc_id is pd.NA else int(doc_id), length))
                ids += [blob, end]
                held += length
                if held >= shard_ids:
                    yield flush()
                    shard, held, ids, rows = shard + 1, 0, [], []
        if rows:
            yield flush()

    made = ordered.mapInPandas(encode, "part int, shard int, name string, n_ids long")
    return folder, stored(made, "token-files")


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it: ids of earlier parts,
    of earlier files of the part, and within the file.  The running sum over
    parts has one row per task; contents are never shuffled.
    """
    spark = files.sparkSession
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")

    def decode(batches):
        for batch in batches:
            for path, data in zip(batch["path"], batch["content"], strict=True):
                ids = read_shard(data).astype("<u4").tobytes()
                listed = read_documents(data)
                yield pd.DataFrame(
                    {
                        "name": path.rpartition("/")[2],
                        "doc_id": pd.array([d for d, _, _ in listed], "Int64"),
                        "at": [s for _, s, _ in listed],
                        "n_tokens": [n for _, _, n in listed],
                        "ids_crc32": [zlib.crc32(ids[4 * s : 4 * (s + n)]) for _, s, n in listed],
                    }
                )

    parts = files.groupBy("part").agg(F.sum("n_ids").alias("held"))
    parts = parts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("base"))
    within = Window.partitionBy("part").orderBy("shard")
    firsts = files.join(parts, "part").select(
        "name", (F.col("base") + F.sum("n_ids").over(within) - F.col("n_ids")).alias("first")
    )
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.bpl").load(folder)
    found = read.select("path", "content").mapInPandas(
        decode, "name string, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return found.join(firsts, "name").select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
