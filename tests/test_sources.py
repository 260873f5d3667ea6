import io
import json
import tarfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import sets, text
from millrace.sources import archives, dims, readers, sinks


def test_tar_archives(spark, tmp_path):
    for year in (2019, 2020):
        with tarfile.open(tmp_path / f"{year}.tar.gz", "w:gz") as tar:
            for station in "ab":
                body = f"STATION,TEMP\n{station},{year}\n{station},\n".encode()
                info = tarfile.TarInfo(f"{station}.csv")
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
            tar.addfile(tarfile.TarInfo("readme.txt"))
    got = archives.read_tar_csv(spark, str(tmp_path / "*.tar.gz"), ["STATION", "TEMP", "WIND"], block_bytes=20)
    rows = sorted((r.member, r.STATION, r.TEMP or "", r.WIND) for r in got.collect())
    assert rows == sorted((f"{s}.csv", s, t, None) for s in "ab" for t in ("", "", "2019", "2020"))


def test_archives_round_trip(spark, tmp_path):
    rows = [(y, f"m{m}", k, f'text, "{k}"\nline' if k % 3 else None) for y in ("a", "b", "c") for m in range(3) for k in range(40)] + [(None, "m", 1, "x")]
    df = spark.createDataFrame(rows, "year string, month string, k int, note string").repartition(4)
    path = str(tmp_path / "packed")
    written = {r.archive: r["rows"] for r in archives.write_tar_csv(df, path, "year", "month").collect()}
    assert written == {"a": 120, "b": 120, "c": 120}
    back = archives.read_tar_csv(spark, path, ["note", "k"], block_bytes=200)
    assert back.rdd.getNumPartitions() == 3
    got = sorted((r.archive.split("/")[-1][0], r.member[:-4], int(r.k), r.note) for r in back.collect())
    assert got == sorted(((y, m, k, n) for y, m, k, n in rows if y), key=lambda r: (r[0], r[1], r[2]))
    some = archives.read_tar_csv(spark, f"file://{path}/[ab]*.tar.gz", ["k"], members="m1*")
    assert {(r.archive.split("/")[-1], r.member) for r in some.collect()} == {("a.tar.gz", "m1.csv"), ("b.tar.gz", "m1.csv")}
    assert archives.read_tar_csv(spark, f"{path}/none*.tar", ["k"]).count() == 0


def test_tree_stops_at_depth(spark, tmp_path):
    node = lambda i, d, c=None: {"i": i, "s": f"n{i}", "d": d, "c": c or []}
    tree = {"c": [node(1, 1, [node(2, 2, [node(3, 3, [node(4, 4)])])]), node(5, 1)]}
    (tmp_path / "tree.json").write_text(json.dumps(tree, indent=1))
    df = readers.read_json(spark, str(tmp_path / "tree.json"), whole=True)
    assert sorted(r.i for r in readers.flatten_tree(df).collect()) == [1, 2, 3, 5]


def test_parquet_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    with pytest.raises(AnalysisException):
        sinks.write_table(spark.range(3), path)
    sinks.write_table(spark.range(5), path, overwrite=True)
    assert readers.read_table(spark, path).count() == 5
    size = sinks.disk_size(spark, path).first()
    assert size.files >= 1 and size.bytes > 0


def test_lines_are_appended(spark, tmp_path):
    path = str(tmp_path / "lines")
    for _ in range(2):
        sinks.write_lines(spark.range(2), F.concat(F.lit("row "), F.col("id")), path)
    assert sorted(r.value for r in readers.read_lines(spark, path).collect()) == ["row 0", "row 0", "row 1", "row 1"]


def test_month_paths_and_empty_frame(spark):
    assert readers.period_paths("f_{year}_{month}.csv", [2022], [1, 2]) == ["f_2022_1.csv", "f_2022_2.csv"]
    assert dims.inline_table(spark, [], "id string, x double").count() == 0
    assert dims.state_zones(spark).count() == 51


def test_later_batch_replaces_from_its_start(spark):
    rows = [("s", 1, 0), ("s", 2, 0), ("s", 4, 0), ("s", 3, 1), ("s", 5, 1), ("s", 5, 2)]
    df = spark.createDataFrame(rows, "symbol string, dt int, batch int")
    got = sorted((r.dt, r.batch) for r in readers.merge_batches(df, "symbol", "dt", "batch").collect())
    assert got == [(1, 0), (2, 0), (3, 1), (5, 2)]  # 4 of batch 0 lies past the start of batch 1


def test_union_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(map(tuple, sets.stack([a, b]).collect())) == [(1, "x"), (2, None)]


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=90), st.lists(st.sampled_from("abcd"), max_size=90))
def test_common_subsequence(a, b):
    assert text.common_subsequence(a, b) == lcs(a, b)


def test_rouge(spark):
    df = spark.createDataFrame([(1, "The cat sat on the mat", "the cat on a mat, the"), (2, "", "x")], "k int, p string, r string")
    one = {r.k: r for r in text.rouge_n(df, ["k"], "p", "r").collect()}
    assert one[1].overlap == 5 and one[1].precision == pytest.approx(5 / 6) and one[2].f1 == 0
    two = {r.k: r for r in text.rouge_n(df, ["k"], "p", "r", 2).collect()}
    assert two[1].overlap == 1 and two[1].n_pred == 5
    long = {r.k: r for r in text.rouge_l(df, ["k"], "p", "r").collect()}
    assert long[1].overlap == 4 and long[2].overlap == 0


def test_staged_tables_can_be_dropped(spark):
    from millrace.session import drop_staged, folders_of, stage, staged

    a = stage(spark.range(5))
    b = stage(a.where("id > 2"))
    (first,), (second,) = folders_of(a), folders_of(b)
    assert first != second and {first, second} <= set(staged())
    assert folders_of(a.join(b, "id")) == [first, second]
    assert drop_staged(spark, [first]) == 1 and first not in staged()
    assert b.count() == 2
    with pytest.raises(Exception):
        spark.read.parquet(first).count()
