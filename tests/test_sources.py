"""Raw sources: the star-schema adapter's text and typed forms agree."""

import os

import pytest

from parcelworks.functions.compat import strict_int
from parcelworks.operators.staging import stage_all
from parcelworks.sources.csv import read_raw_table
from parcelworks.sources.schemas import RAW_COLUMNS
from parcelworks.sources.starschema import raw_tables_from_star

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_text_and_typed_raw_give_same_staging(spark):
    text_raw = raw_tables_from_star(spark, SF, as_text=True)
    typed_raw = raw_tables_from_star(spark, SF, as_text=False)
    for name, cols in RAW_COLUMNS.items():
        assert text_raw[name].columns == cols
        assert all(t == "string" for _, t in text_raw[name].dtypes)
    a, b = stage_all(text_raw), stage_all(typed_raw)
    for name in a:
        assert a[name].dtypes == b[name].dtypes, name
        assert a[name].exceptAll(b[name]).count() == 0, name
        assert b[name].exceptAll(a[name]).count() == 0, name


def test_folder_of_part_files_reads_like_one_file(spark, clean_dir, tmp_path):
    """At scale a logical table is a folder of CSV part files."""
    import shutil
    from pathlib import Path

    from parcelworks.sources.csv import read_raw_tables
    from parcelworks.sources.manifest import build_snapshot_manifest
    from parcelworks.sources.schemas import DATASET_FILES

    for table, name in DATASET_FILES.items():
        src = Path(clean_dir) / name
        if table == "order_items":
            folder = tmp_path / name
            folder.mkdir()
            header, *lines = src.read_text().splitlines()
            (folder / "part-0.csv").write_text("\n".join([header, *lines[:2]]) + "\n")
            (folder / "part-1.csv").write_text("\n".join([header, *lines[2:]]) + "\n")
        else:
            shutil.copy(src, tmp_path / name)
    split = read_raw_tables(spark, str(tmp_path))
    whole = read_raw_tables(spark, clean_dir)
    assert split["order_items"].exceptAll(whole["order_items"]).count() == 0
    assert split["order_items"].count() == whole["order_items"].count() == 5
    files = build_snapshot_manifest(spark, str(tmp_path)).first().files
    assert [f.filename for f in files if f.logical_table == "order_items"] == ["part-0.csv", "part-1.csv"]


def test_scale_conf_sizes_partitions():
    from parcelworks.session import scale_conf

    conf = scale_conf(100 * 2**40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 24


def test_columns_bound_by_header_name(spark, clean_dir, tmp_path):
    import shutil
    from pathlib import Path

    from parcelworks.sources.csv import read_raw_table, read_raw_tables
    from parcelworks.sources.schemas import DATASET_FILES

    for name in DATASET_FILES.values():
        shutil.copy(Path(clean_dir) / name, tmp_path / name)
    # sellers with columns reordered; reviews without the optional comment columns
    (tmp_path / DATASET_FILES["sellers"]).write_text(
        "seller_state,seller_id,seller_city,seller_zip_code_prefix,extra\n"
        "RS,v1,porto alegre,1100,x\nPR,v2,Curitiba,2200,y\nPE,v3,recife,3300,z\n"
    )
    (tmp_path / DATASET_FILES["reviews"]).write_text(
        "review_id,order_id,review_score,review_creation_date,review_answer_timestamp\n"
        "w1,a1,1,2019-03-09 00:00:00,2019-03-10 00:00:00\n"
    )
    raw = read_raw_tables(spark, str(tmp_path))
    assert raw["sellers"].columns == ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
    assert raw["sellers"].where("seller_id = 'v2'").first().seller_state == "PR"
    assert raw["reviews"].first().review_comment_title is None

    (tmp_path / "bad.csv").write_text("order_id,price\no1,1.0\n")
    with pytest.raises(ValueError, match="missing column"):
        read_raw_table(spark, "order_items", str(tmp_path / "bad.csv"))


def test_shuffle_sizing_only_raises_and_respects_user(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from parcelworks.plans.build import Build, partitions_for, row_bytes

    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    assert row_bytes(schema) == 44
    assert partitions_for([(10, schema)], 1 << 20, least=4) == 4  # tiny input: keep the session's setting
    assert partitions_for([(10**6, schema), (10**6, schema)], 1 << 20, least=4) == 84
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    build = Build(spark, "unused")
    build.rows["t"], build._schemas["t"] = 10**9, schema
    assert build._sized("x", ("t",)).conf.get(key) == str(build.partitions["x"]) and build.partitions["x"] > 300
    spark.conf.set(key, "7")
    try:
        assert build._sized("x", ("t",)).conf.get(key) == "7" and build.partitions["x"] == 7
    finally:
        spark.conf.unset(key)
        build.close()


def test_configure_applies_scale_settings(spark):
    from parcelworks.session import configure, scale_conf

    extra = scale_conf(10 * 2**30, 16)
    before = {k: spark.conf.get(k, None) for k in extra}
    try:
        configure(spark, extra=extra)
        assert spark.conf.get("spark.sql.shuffle.partitions") == extra["spark.sql.shuffle.partitions"] == "48"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_input_bytes_counts_folder_layout(spark, tmp_path):
    from parcelworks.session import input_bytes

    folder = tmp_path / "items"
    folder.mkdir()
    (folder / "part-0.csv").write_text("a\n1\n")
    (folder / "part-1.csv").write_text("a\n22\n")
    single = tmp_path / "one.csv"
    single.write_text("a\n333\n")
    assert input_bytes(spark, [str(folder), str(single)]) == 4 + 5 + 6


def test_part_files_with_another_header_raise(spark, tmp_path):
    folder = tmp_path / "sellers"
    folder.mkdir()
    (folder / "part-0.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\na,1,rio,RJ\n")
    (folder / "part-1.csv").write_text("seller_id,seller_zip_code_prefix,seller_state,seller_city\nb,2,RJ,rio\n")
    with pytest.raises(Exception, match="header"):
        read_raw_table(spark, "sellers", str(folder)).collect()


def test_strict_int_rounds_at_any_precision(spark):
    texts = ["0.4999999999", "1.49999999995", "-0.4999999999", "2.5", "-2.5", ".5", "7.", "1e1", "15e-1"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r[0] for r in frame.orderBy("i").select(strict_int("t")).collect()]
    assert found == [0, 1, 0, 3, -3, 1, 7, 10, 2]
