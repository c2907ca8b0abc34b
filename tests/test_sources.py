"""File sources on small files written by the test."""

import os
import tempfile

import pytest

from quarry.sources import csv as CSV
from quarry.sources import text as TX


def test_paragraph_source_splits_at_crlf_crlf(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "book.txt")
    with open(p, "w", newline="") as f:
        f.write("First para line one.\r\nline two. Next\r\n\r\nSecond para\r\n\r\nThird")
    rows = [r.paragraph for r in TX.scan_paragraphs(spark, p).collect()]
    assert rows == ["First para line one.\r\nline two. Next", "Second para", "Third"]


@pytest.mark.parametrize("group", [1, 7, 40, 1 << 16])
def test_manifest_source(spark, tmp_path, group):
    want, names = [], []
    for i in range(5):
        folder = tmp_path / f"d{i % 2}" / "x y"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f'{{"n": {i}}}', "", f"line é {i}"]
        (folder / f"part{i}.txt").write_text("\r\n".join(lines) if i == 3 else "\n".join(lines) + "\n")
        want += lines
        names.append((f"  {folder}/part{i}.txt\t", f"file://{folder}/part{i}.txt".replace(" ", "%20"), f"d{i % 2}/x y/part{i}.txt")[i % 3])
    manifest = tmp_path / "manifest.txt"
    manifest.write_text("\n" + "\n\n".join(names))
    got = TX.scan_manifest_lines(spark, str(manifest), group=group)
    assert sorted(r.value for r in got.collect()) == sorted(want) and got.columns == ["value"]
    assert got.rdd.getNumPartitions() == -(-manifest.stat().st_size // group)
    manifest.write_text(manifest.read_text() + "\nnowhere.txt\n")
    with pytest.raises(Exception, match="nowhere"):
        TX.scan_manifest_lines(spark, str(manifest), group=group).collect()
    assert TX.scan_manifest_lines(spark, str(manifest), group=group, missing="skip").count() == len(want)


def test_manifest_read_by_spark(spark, tmp_path):
    (tmp_path / "a").write_text("1\n2\n")
    manifest = tmp_path / "m"
    manifest.write_text(f"  {tmp_path}/a  \n\n")
    assert TX.read_manifest_paths(spark, str(manifest)) == [f"{tmp_path}/a"]
    assert TX.scan_manifest_lines(spark, str(manifest), listed=True).count() == 2
    manifest.write_text("")
    assert TX.scan_manifest_lines(spark, str(manifest)).count() == 0


def test_csv_rejects_do_not_depend_on_the_columns_read(spark, tmp_path):
    names = ["a", "b", "c"]
    lines = ["1,2,3", " 4 , 5.5 ,6", "x,2,3", "1,2,x", "1,2", "1,2,3,4", "", "   ", ",,", "7,8,9e2"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = CSV.scan_numeric_csv_rejects(spark, str(tmp_path), names)
    assert [tuple(r) for r in good.collect()] == [(1.0, 2.0, 3.0), (4.0, 5.5, 6.0), (None, None, None), (7.0, 8.0, 900.0)]
    assert [r.line for r in bad.collect()] == ["x,2,3", "1,2,x", "1,2", "1,2,3,4"]
    for cols in (["a"], ["b"], ["c"], ["c", "a"]):
        assert good.select(*cols).count() == len(good.select(*cols).collect()) == 4
    assert good.count() == 4 and bad.count() == 4
    with pytest.raises(Exception):
        CSV.scan_numeric_csv(spark, str(tmp_path), names).collect()


def test_numeric_csv_with_blanks(spark):
    d = tempfile.mkdtemp(prefix="quarry-src-")
    p = os.path.join(d, "particles.csv")
    with open(p, "w") as f:
        f.write(" 1.0, " + ", ".join(str(i) for i in range(28)) + "\n")
        f.write("0.0 ," + ",".join(f" {i}.5 " for i in range(28)) + "\n")
    df = CSV.scan_numeric_csv(spark, p, CSV.particle_columns())
    rows = df.collect()
    assert len(df.columns) == 29 and len(rows) == 2
    assert rows[0].label == 1.0 and rows[1].f28 == 27.5
    assert len(CSV.cover_columns()) == 55


def test_spread_only_when_too_few_splits(spark):
    from quarry.sources.tables import read_table, spread
    target = spark.sparkContext.defaultParallelism
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    spread_docs = spread(docs)
    assert spread_docs.rdd.getNumPartitions() >= min(target, docs.rdd.getNumPartitions() * target)
    assert spread_docs.count() == docs.count()
    many = spark.range(0, 1000, numPartitions=target * 2)
    assert spread(many) is many


def test_file_readers_round_trip(spark):
    from quarry.operators import features as FE
    from quarry.operators import series as S
    from quarry.sources import files as FI
    d = tempfile.mkdtemp(prefix="quarry-files-")
    spark.createDataFrame([("u1", 3), ("u2", 6)], FI.USER_GROUPS).write.parquet(os.path.join(d, "groups"))
    spark.createDataFrame([("u1", 3)], FI.USER_GROUPS).write.option("header", "true").csv(os.path.join(d, "groups_csv"))
    assert FI.read_user_groups(spark, os.path.join(d, "groups")).count() == 2
    assert FI.read_user_groups(spark, os.path.join(d, "groups_csv"), "csv").first().group_id == 3

    nested = spark.createDataFrame(
        [("st1", [("TMAX", 2000, [1.0, float("nan"), 3.0]), ("TMIN", 2000, [0.0, 1.0, 2.0])])], FI.STATION_SERIES)
    nested.write.parquet(os.path.join(d, "series"))
    flat = S.flatten_series(FI.read_station_series(spark, os.path.join(d, "series")))
    rows = {r.measurement: r["values"] for r in flat.collect()}
    assert rows["TMAX"] == [1.0, None, 3.0]          # NaN at rest becomes NULL

    proj = spark.createDataFrame([("st1", [1.0, 2.0, 3.0], [4.0, 5.0, 6.0], [7.0, 8.0, 9.0], 1.0, 2.0, 3.0, 4.0)],
                                 FI.STATION_PROJECTIONS)
    proj.write.parquet(os.path.join(d, "proj"))
    p = FI.read_station_projections(spark, os.path.join(d, "proj"))
    vec = p.select(FE.concat_vectors("TAVG_coeff", "TRANGE_coeff", "SNWD_coeff").alias("v")).first().v
    assert vec == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    cols = FE.split_array_column(p.drop("TRANGE_coeff", "SNWD_coeff"), "TAVG_coeff", 3).columns
    assert [c for c in cols if c.startswith("TAVG")] == ["TAVG_coeff1", "TAVG_coeff2", "TAVG_coeff3"]


def test_spread_bounds_the_rows_of_a_partition(spark, tmp_path):
    from quarry.sources.tables import spread
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = spread(df, 2, max_rows=50)
    assert got.rdd.getNumPartitions() == 20
    assert max(got.rdd.glom().map(len).collect()) <= 100 and sorted(r.id for r in got.collect()) == list(range(1000))
    assert spread(df, 1, max_rows=1000).rdd.getNumPartitions() == df.rdd.getNumPartitions()
