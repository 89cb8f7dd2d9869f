import pytest
from mergewell.sources import entities, links, sinks
from pyspark.sql.utils import AnalysisException


def file(tmp_path, name, data):
    (tmp_path / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return f"file://{tmp_path}/{name}"


def test_headers_and_null_tokens(spark, tmp_path):
    path = file(tmp_path, "a.tsv", "Record ID\tCompany Name\tTOWN\tPostal Code\textra\n1\t Foo \tnan\t00000\tx\nnan\tNone\t\tnull\ty\n")
    rows = entities.read_source(spark, path, "s2").collect()
    assert rows[0].asDict() == {"id": "1", "name": "Foo", "address": "", "city": "", "state": "", "zip": "00000", "country": "", "phone": "", "category": "", "source_tag": "s2"}
    assert rows[1].id == "nan" and rows[1].name == "" and rows[1].zip == ""
    assert entities.resolve(["first", "Title", "name"])["id"] == "first"
    assert entities.resolve(["first", "Title", "name"])["name"] == "name"


def test_long_rows_go_and_short_rows_stay(spark, tmp_path):
    path = file(tmp_path, "b.tsv", 'id\tname\tcity\n1\tA\tX\n2\tB\n3\tC\tY\textra\n4\t"D\tE"\tZ\n')
    assert [tuple(r) for r in entities.read_delimited(spark, path).orderBy("id").collect()] == [("1", "A", "X"), ("2", "B", ""), ("4", "D\tE", "Z")]


def test_latin_1_and_missing_files(spark, tmp_path):
    path = file(tmp_path, "c.tsv", "id\tname\n1\tCafé\n".encode("latin-1"))
    assert [tuple(r) for r in entities.read_delimited(spark, path).collect()] == [("1", "Café")]
    with pytest.raises(AnalysisException):
        entities.read_delimited(spark, f"file://{tmp_path}/none.tsv")


def test_links(spark):
    two = spark.createDataFrame([("a", "x, y;z|nan"), ("b", ""), (" ", "q"), ("a", "x"), ("c", None)], "s string, m string")
    assert sorted(map(tuple, links.link_pairs(two).collect())) == [("a", "x"), ("a", "y"), ("a", "z")]
    assert {r.s1_id: r.target_ids for r in links.link_sets(two).collect()} == {"a": ["x", "y", "z"], "b": [], "c": []}
    wide = spark.createDataFrame([("a", "x,y", "NULL", " z ")], "s string, m string, n string, o string")
    assert sorted(map(tuple, links.link_pairs(wide).collect())) == [("a", "x,y"), ("a", "z")]
    assert links.link_pairs(two.select("s")).count() == 0


def test_last_row_of_an_id_counts(spark):
    rows = spark.createDataFrame([("1", "old", 1), ("1", "new", 5), ("2", "only", 2)], "id string, name string, pos int")
    assert sorted((r.id, r.name) for r in entities.last_of_each(rows, "pos").collect()) == [("1", "new"), ("2", "only")]


def test_sinks(spark, tmp_path):
    scored = spark.createDataFrame([("1", "b", 0.75), ("1", "a", 0.9), ("2", "c", 0.1)], "s1_id string, target_id string, score double")
    out = sinks.match_results(spark.createDataFrame([("1",), ("2",), ("3",)], "id string"), scored, 0.75)
    assert sorted(map(tuple, out.collect())) == [("1", "a,b"), ("2", ""), ("3", "")]
    assert sorted(r.score for r in sinks.formatted_scores(scored).collect()) == ["0.10000", "0.75000", "0.90000"]
    sinks.write_tsv(out.orderBy("source1_id"), f"file://{tmp_path}/r", single_file=True)
    (part,) = (tmp_path / "r").glob("part-*")
    assert part.read_text() == "source1_id\tmatched_id\n1\ta,b\n2\t\n3\t\n"
