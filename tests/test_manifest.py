"""Input fingerprint manifest (SRC3 / SNK5)."""

import hashlib
from pathlib import Path

from pyspark.sql import functions as F

from parcelworks.sources.manifest import (
    build_snapshot_manifest,
    file_fingerprints,
    write_snapshot_manifest,
)
from parcelworks.sources.schemas import DATASET_FILES


def test_manifest_hashes_without_local_paths(spark, clean_dir, tmp_path):
    manifest = build_snapshot_manifest(spark, clean_dir)
    row = manifest.first()
    assert row.schema_version == 1
    assert [f.logical_table for f in row.files] == list(DATASET_FILES)
    assert all(len(f.sha256) == 64 for f in row.files)
    for f in row.files:
        data = (Path(clean_dir) / f.filename).read_bytes()
        assert f.bytes == len(data)
        assert f.sha256 == hashlib.sha256(data).hexdigest()
    out = write_snapshot_manifest(manifest, str(tmp_path / "manifest"))
    text = "".join(p.read_text() for p in Path(out).glob("part-*"))
    assert clean_dir not in text
    assert "olist_orders_dataset.csv" in text


def test_names_with_spaces_percent_and_accents(spark, tmp_path):
    files = {}
    for n, name in enumerate(("with space", "per%20cent", "é")):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "data.csv").write_bytes(bytes([n]) * (n + 1))
        files[name] = str(folder)
    found = {r.logical_table: (r.bytes, r.sha256) for r in file_fingerprints(spark, files).collect()}
    assert found == {k: (n + 1, hashlib.sha256(bytes([n]) * (n + 1)).hexdigest()) for n, k in enumerate(files)}


def test_contents_of_every_shape(spark, tmp_path):
    """Line feeds, marks, carriage returns, empty files, no line feed at all, compressed names, binary data."""
    import gzip
    import os

    mark = b"\xef\xbb\xbf"
    contents = [
        b"", b"\n", b"\n\n", b"a", b"a\n", b"a\n\nb", b"a\r\nb\r\n", b"\r", mark, mark + b"\n", mark + b"a,b\n1,2", mark + mark + b"x\n",
        b"\xff\xfe\x00\n\x80", os.urandom(300_000), b"x" * 3_000_000, b"line of text\n" * 200_000,
    ]
    want = {}
    for n, data in enumerate(contents):
        (tmp_path / f"part {n} é%41.csv").write_bytes(data)
        want[f"part {n} é%41.csv"] = data
    (tmp_path / "more").mkdir()
    want["packed.csv.GZ"] = gzip.compress(b"a,b\n1,2\n")
    (tmp_path / "more" / "packed.csv.GZ").write_bytes(want["packed.csv.GZ"])
    found = {r.filename: (r.bytes, r.sha256) for r in file_fingerprints(spark, {"t": str(tmp_path)}).collect()}
    assert found == {name: (len(d), hashlib.sha256(d).hexdigest()) for name, d in want.items()}


def test_files_over_the_readers_limit(spark, tmp_path):
    """A file larger than Spark's binary reader may load is hashed, in one task, without loading it."""
    import pytest

    big, small = tmp_path / "big.csv", tmp_path / "small.csv"
    big.write_bytes(b"0123456789,abcdefghij\n" * 300_000)
    small.write_bytes(b"1,2\n")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str(1 << 20))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))  # the caller's splits do not matter
    try:
        with pytest.raises(Exception, match="maximum|exceeds|length"):
            spark.read.format("binaryFile").load(str(big)).select(F.sha2("content", 256)).collect()
        found = {r.filename: (r.bytes, r.sha256) for r in file_fingerprints(spark, {"t": str(tmp_path)}).collect()}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(1 << 19)
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in (big, small)}


def test_snapshot_job_writes_one_line_per_file(spark, clean_dir, tmp_path):
    from parcelworks.plans.jobs import run_snapshot

    out = run_snapshot(spark, clean_dir, str(tmp_path / "snapshot"))
    rows = spark.read.json(out).collect()
    assert len(rows) == 7
    assert {r.logical_table for r in rows} == set(DATASET_FILES)
    assert all(len(r.sha256) == 64 and r.schema_version == 1 for r in rows)
    text = "".join(p.read_text() for p in Path(out).glob("part-*"))
    assert clean_dir not in text


def test_large_files_are_read_in_pieces(spark, tmp_path):
    """A file over the piece size is hashed by several tasks, each of which reads one piece of it."""
    import os

    from parcelworks.sources.manifest import _large_lines

    piece, mark = 1 << 16, b"\xef\xbb\xbf"
    contents = [
        b"0123456789,abcdefghij\n" * 40_000, b"0123456789,abcdefghij\n" * 20_000 + b"end", b"\n" * 200_000, os.urandom(500_000),
        b"x" * 300_000, mark + b"a,b\r\n" * 60_000, mark + b"y" * 200_000 + b"\n" * 3, b"x" * piece, b"x" * (piece - 1) + b"\n\n",
        (b"z" * (piece - 1) + b"\n") * 4, b"1,2\n", b"", mark,
    ]
    for n, data in enumerate(contents):
        (tmp_path / f"part {n} [é]%41*.csv").write_bytes(data)
    (tmp_path / "packed.csv.gz").write_bytes(os.urandom(200_000))
    want = {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in tmp_path.iterdir()}
    one = tmp_path / "part 0 [é]%41*.csv"
    found = [(r.filename, r.bytes, r.sha256) for r in file_fingerprints(spark, {"t": str(tmp_path)}, piece).collect()]
    assert sorted(found) == sorted((name, *rest) for name, rest in want.items())
    held = _large_lines(spark, [str(tmp_path)], piece).where(F.col("key").contains("part%200"))
    sizes = held.select(F.length("line").alias("n")).rdd.mapPartitions(lambda rows: [sum(r.n + 1 for r in rows)]).collect()
    assert sum(sizes) == one.stat().st_size and max(sizes) <= piece + 22
