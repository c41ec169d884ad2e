"""SRC3 / SNK5: fingerprint the raw input files.

One row per input file: logical table, base file name (never the local
path), byte size and SHA-256.  Spark's line reader (so the session's own
filesystem and credentials) streams the bytes into the hash batch by batch.
A file of up to ``PIECE`` bytes is read by one task, which may read several.
A larger one is cut into Spark's own splits, one task each: SHA-256 takes its
bytes in order, so a file's tasks follow one another and hand the state of the
hash on, while those of other files run beside them; a pass before that finds
the splits, so these files are read twice.  Memory is bounded by a
batch or the longest run of bytes without a line feed; no file is loaded whole
and none is too large.

The reader's scan settings keep small files whole and deal them together;
they live in sessions of their own, so the caller's stay as they are.  It
drops the line feeds, and a byte order mark at the start of a file; the file's
size tells which of them were there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelworks.sources.csv import required_files
from parcelworks.sources.schemas import LOGICAL_TABLES

# Manifest header of the published snapshot.
SCHEMA_VERSION = 1
DATASET = "Olist Brazilian E-Commerce Public Dataset"
SOURCE_URL = "https://www.kaggle.com/datasets/olistbr/brazilian-ecommerce"
LICENSE = "CC-BY-NC-SA-4.0"

# Names that Spark's line reader would decompress; their bytes come from the binary reader.
COMPRESSED = r"(?i)\.(gz|gzip|bz2|deflate|lz4|snappy|zst|zstd|xz)$"
BYTE_ORDER_MARK = b"\xef\xbb\xbf"
_BATCH_BYTES = 16 << 20
PIECE = 128 << 20  # bytes one task reads, Spark's default split
_FILES_AT_ONCE = 1000  # files whose pieces one job takes


def _hashing():
    """The classes Resumable and FileHash.

    Nothing in them refers to this package, which the executors need not have."""
    mark = BYTE_ORDER_MARK

    class Resumable:
        """SHA-256 whose state is bytes that another task can go on from.

        hashlib keeps its state to itself, so its library (libcrypto) is called: SHA256_CTX is a plain structure."""

        def __init__(self, state: bytes | None = None):
            import _hashlib
            import ctypes

            self.library = ctypes.CDLL(_hashlib.__file__)
            self.library.SHA256_Update.argtypes = [ctypes.c_void_p, ctypes.c_char_p, ctypes.c_size_t]
            self.own = ctypes.create_string_buffer(state or bytes(112), 112)
            if state is None:
                self.library.SHA256_Init(self.own)

        def update(self, data: bytes) -> None:
            self.library.SHA256_Update(self.own, data, len(data))

        def state(self) -> bytes:
            return self.own.raw

        def hexdigest(self) -> str:
            import ctypes

            digest, last = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self.own.raw, 112)
            self.library.SHA256_Final(digest, last)
            return digest.raw.hex()

    class FileHash:
        """SHA-256 of a file from its lines, with and without a byte order mark before them."""

        def __init__(self, key: str, size: int, made=hashlib.sha256):
            self.key, self.size, self.seen = key, size, -1
            self.plain, self.marked = made(), made()
            self.marked.update(mark)

        def add(self, lines: list[bytes]) -> None:
            data = b"\n".join(lines)
            if self.seen >= 0:
                data = b"\n" + data
            self.seen = max(self.seen, 0) + len(data)
            self.plain.update(data)
            self.marked.update(data)

        def hexdigest(self) -> str:
            missing = self.size - self.seen
            if missing not in (0, 1, 3, 4):
                raise ValueError(f"{self.seen} bytes read of a file of {self.size}: it changed while it was read")
            found = self.marked if missing >= 3 else self.plain
            if missing in (1, 4):
                found.update(b"\n")
            return found.hexdigest()

        def row(self) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"key": [self.key], "sha256": [self.hexdigest()]})

        def state(self) -> tuple[int, bytes, bytes]:
            return self.seen, self.plain.state(), self.marked.state()

        def resume(self, seen: int, plain: bytes, marked: bytes) -> None:
            self.seen, self.plain, self.marked = seen, Resumable(plain), Resumable(marked)

    return Resumable, FileHash


def _digester():
    """The task's function: (key, sha256) of the files whose lines follow each other."""
    _, FileHash = _hashing()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keys, sizes, lines = (batch[name].to_pylist() for name in ("key", "size", "line"))
            at = 0
            while at < len(keys):
                stop = at + 1
                while stop < len(keys) and keys[stop] == keys[at]:
                    stop += 1
                if held is None or held.key != keys[at]:
                    if held is not None:
                        yield held.row()
                    held = FileHash(keys[at], sizes[at])
                held.add(lines[at:stop])
                at = stop
        if held is not None:
            yield held.row()

    return digests


def _link(held: dict[str, tuple]):
    """The task's function: the lines of one piece added to its file's hash.

    ``held``: key -> (size, start of the last piece, state of the hash after it)."""
    Resumable, FileHash = _hashing()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = place = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, starts = (batch[name].unique().to_pylist() for name in ("key", "start"))
            if found is None:
                place = keys, starts
                size, last, state = held[keys[0]]
                found = FileHash(keys[0], size, Resumable)
                if state is not None:
                    found.resume(*state)
            if (keys, starts) != place or len(keys) > 1 or len(starts) > 1 or starts[0] <= last:
                raise ValueError(f"the pieces of {keys} are not read in their order")
            found.add(batch["line"].to_pylist())
        if found is not None:
            seen, plain, marked = found.state()
            yield pa.RecordBatch.from_pydict(
                {"key": [found.key], "start": place[1], "seen": [seen], "plain": [plain], "marked": [marked]}
            )

    return link


def _can_resume() -> bool:
    """Whether Python's hashlib rests on a library whose SHA-256 gives out its state."""
    try:
        Resumable, _ = _hashing()
        first = Resumable()
        first.update(BYTE_ORDER_MARK)
        second = Resumable(first.state())
        second.update(b"\n" * 100)
        return second.hexdigest() == hashlib.sha256(BYTE_ORDER_MARK + b"\n" * 100).hexdigest()
    except (ImportError, OSError, AttributeError):
        return False


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """key, size, start of the split, and bytes of every line of the files under ``path``."""
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("key"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    ).where(~F.col("key").rlike(COMPRESSED))


def _large_lines(spark: SparkSession, paths: list[str], piece: int) -> DataFrame:
    """The lines of the files over ``piece`` bytes: a partition is one piece of one file."""
    own = spark.newSession()
    # with an opening cost of a whole split, no two splits share a task
    own.conf.set("spark.sql.files.maxPartitionBytes", str(piece))
    own.conf.set("spark.sql.files.openCostInBytes", str(piece))
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))
    scans = [_lines(own, path).where(F.col("size") > piece) for path in dict.fromkeys(paths)]
    return reduce(DataFrame.unionByName, scans)


def _chained_digests(spark: SparkSession, paths: list[str], piece: int) -> list[tuple[str, str]]:
    """(key, sha256) of every file over ``piece`` bytes: the n-th pieces of all files are one job."""
    lines, context = _large_lines(spark, paths, piece), spark.sparkContext

    # which task has which piece is Spark's matter: a pass over the line starts tells; a piece without one adds nothing
    places = lines.select("key", "start", "size", F.spark_partition_id().alias("partition")).distinct().collect()
    pieces: dict[str, list] = {}
    for key, _, size, partition in sorted(places):
        pieces.setdefault(key, []).append((size, partition))
    Resumable, FileHash = _hashing()
    done, names = [], list(pieces)
    for at in range(0, len(names), _FILES_AT_ONCE):
        group = names[at : at + _FILES_AT_ONCE]
        held = {key: (pieces[key][0][0], -1, None) for key in group}
        for step in range(max(len(pieces[key]) for key in group)):
            now = [key for key in group if step < len(pieces[key])]
            link = _link({key: held[key] for key in now})
            linked = lines.mapInArrow(link, "key string, start long, seen long, plain binary, marked binary").rdd
            for r in context.runJob(linked, list, [pieces[key][step][1] for key in now]):
                held[r.key] = held[r.key][0], r.start, (r.seen, bytes(r.plain), bytes(r.marked))
        for key, (size, _, state) in held.items():
            whole = FileHash(key, size, Resumable)
            whole.resume(*state)
            done.append((key, whole.hexdigest()))
    return done


def _streaming_session(spark: SparkSession, largest: int, piece: int) -> SparkSession:
    """A session whose scans read every file of up to ``largest`` bytes in one task, and no task over ``piece``."""
    own = spark.newSession()
    # a file is not split when it is no larger than the split size, which the cost of opening a file bounds from below
    own.conf.set("spark.sql.files.maxPartitionBytes", str(piece))
    own.conf.set("spark.sql.files.openCostInBytes", str(max(largest, 4 << 20)))
    own.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))
    return own


def _listed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """key, filename and length of every file under ``paths``; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    # scans leave empty files out, Spark's own listing names them
    names = [re.sub("^file:/+", "file:/", name) for name in found.inputFiles()]
    rows = [(name, unquote(name.rpartition("/")[2])) for name in names]
    lengths = found.select(F.col("_metadata.file_path").alias("key"), "length")
    listing = spark.createDataFrame(rows, "key string, filename string")
    return listing.join(lengths, "key", "left").withColumn("length", F.coalesce("length", F.lit(0)))


def file_digests(spark: SparkSession, path: str, piece: int, chained: DataFrame) -> DataFrame:
    """filename, length and sha256 of every file under ``path``; ``spark`` is a streaming session,
    ``chained`` has the digests of the files over ``piece`` bytes."""
    is_packed = F.col("key").rlike(COMPRESSED)
    streamed = _lines(spark, path).where(F.col("size") <= piece).drop("start").mapInArrow(_digester(), "key string, sha256 string")
    packed = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path)
    packed = packed.select(F.col("_metadata.file_path").alias("key"), "content").where(is_packed)
    known = streamed.unionByName(packed.select("key", F.sha2("content", 256).alias("sha256"))).unionByName(chained)
    # files without a line have no row
    blank = F.when(F.col("length") == 0, F.sha2(F.lit(b""), 256)).when(F.col("length") == 3, F.sha2(F.lit(BYTE_ORDER_MARK), 256))
    listed = _listed(spark, [path]).join(known, "key", "left")
    return listed.select("filename", "length", F.coalesce("sha256", blank).alias("sha256"))


def file_fingerprints(spark: SparkSession, files: dict[str, str], piece: int = PIECE) -> DataFrame:
    """One row per file under each logical table's path (file or folder):
    position, logical_table, filename, bytes, sha256.

    Files over ``piece`` bytes are hashed here, the others when the rows are asked for.  Where the hash library
    keeps its state to itself, a file of any size is one task's."""
    paths = list(files.values())
    piece = piece if _can_resume() else 1 << 62
    lines = F.when(~F.col("key").rlike(COMPRESSED), F.col("length"))
    largest, over = _listed(spark, paths).agg(F.max(F.when(lines <= piece, lines)), F.max(lines) > piece).first()
    own = _streaming_session(spark, largest or 0, piece)
    chained = own.createDataFrame(_chained_digests(spark, paths, piece) if over else [], "key string, sha256 string")
    scans = [
        file_digests(own, path, piece, chained).select(F.lit(position).alias("position"), F.lit(table).alias("logical_table"), "*")
        for position, (table, path) in enumerate(files.items())
    ]
    listed = scans[0]
    for df in scans[1:]:
        listed = listed.unionByName(df)
    return listed.select(
        "position",
        "logical_table",
        "filename",
        F.col("length").alias("bytes"),
        "sha256",
    )


def snapshot_entries(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC3, distributed: one row per input file with the header fields
    repeated (any number of files: nothing is gathered into one row)."""
    files = required_files(spark, data_dir)
    entries = file_fingerprints(spark, {t: files[t] for t in LOGICAL_TABLES})
    return entries.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(DATASET).alias("dataset"),
        F.lit(SOURCE_URL).alias("source_url"),
        F.lit(LICENSE).alias("license"),
        "position",
        "logical_table",
        "filename",
        "bytes",
        "sha256",
    )


def build_snapshot_manifest(spark: SparkSession, data_dir: str) -> DataFrame:
    """SRC3 as one document: header fields plus the ordered file list.

    The list is gathered into a single row, so this form is for snapshots
    with a bounded number of files (the seven-file layout); ``run_snapshot``
    writes the distributed ``snapshot_entries`` form."""
    entries = snapshot_entries(spark, data_dir)
    listed = entries.groupBy().agg(
        F.sort_array(
            F.collect_list(F.struct("position", "filename", "logical_table", "bytes", "sha256"))
        ).alias("files")
    )
    return listed.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(DATASET).alias("dataset"),
        F.lit(SOURCE_URL).alias("source_url"),
        F.lit(LICENSE).alias("license"),
        F.transform(
            "files",
            lambda f: F.struct(
                f["logical_table"].alias("logical_table"),
                f["filename"].alias("filename"),
                f["bytes"].alias("bytes"),
                f["sha256"].alias("sha256"),
            ),
        ).alias("files"),
    )


def write_snapshot_manifest(manifest: DataFrame, out_path: str) -> str:
    """SNK5: write a manifest frame as JSON lines (the one-document form is
    a single line; the entries form is one line per file, in parallel)."""
    manifest.write.mode("overwrite").json(out_path)
    return out_path


_FILE = "logical_table string, filename string, bytes long, sha256 string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """logical_table, filename, bytes, sha256 of a stored manifest, entries or document."""
    stored = spark.read.schema(f"{_FILE}, files array<struct<{_FILE.replace(' ', ':').replace(',:', ', ')}>>").json(path)
    lines = stored.where("files is null").drop("files")
    return lines.unionByName(stored.select(F.inline("files")))


def manifest_changes(published: DataFrame, found: DataFrame) -> DataFrame:
    """logical_table, filename, status of every file of either manifest, with both sizes and digests.

    status: same, changed (other bytes), missing (published only), added
    (found only).  Files of one table that share a name (part folders) are
    paired in the order of their digests, equal ones first."""

    def counted(manifest: DataFrame, side: str) -> DataFrame:
        rows = manifest.select(*[c.split()[0] for c in _FILE.split(", ")])
        return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(side))

    file = ["logical_table", "filename", "bytes", "sha256"]
    both = counted(published, "before").join(counted(found, "after"), file, "full")
    both = both.select(*file, *[F.coalesce(side, F.lit(0)).alias(side) for side in ("before", "after")])
    same = both.select(*file, F.least("before", "after").alias("n"), F.lit("same").alias("status")).where("n > 0")

    def rest(of: str, other: str) -> DataFrame:
        left = both.withColumn("n", F.col(of) - F.col(other)).where("n > 0")
        each = left.select(*file, F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
        order = Window.partitionBy("logical_table", "filename").orderBy("sha256", "bytes", "copy")
        return each.withColumn("place", F.row_number().over(order)).drop("copy")

    key = ["logical_table", "filename", "place"]
    gone, new = (
        rest(of, other).withColumnsRenamed({"bytes": f"{name}_bytes", "sha256": f"{name}_sha256"})
        for of, other, name in (("before", "after", "published"), ("after", "before", "found"))
    )
    status = F.when(F.col("found_sha256").isNull(), "missing").when(F.col("published_sha256").isNull(), "added").otherwise("changed")
    differing = gone.join(new, key, "full").withColumn("status", status).drop("place")
    kept = same.select(
        "logical_table", "filename",
        *[F.col(c).alias(f"{name}_{c}") for name in ("published", "found") for c in ("bytes", "sha256")],
        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"), "status",
    ).drop("copy")
    return differing.unionByName(kept)
