import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from textmill.sources import readers as R
from textmill.sources import sinks as W


def test_text(spark, rows, tmp_path):
    (tmp_path / "b.txt").write_bytes("één\nbad \xff byte".encode("latin-1") + b"\n")
    (tmp_path / "a.txt").write_text("one\r\ntwo\n\nthree", encoding="utf-8")
    with gzip.open(tmp_path / "c.txt.gz", "wt", encoding="utf-8") as f:
        f.write("zip\nped\n")
    out = R.text_lines(spark, str(tmp_path / "a.txt"), "s")
    assert rows(out, "line_no", "text") == [(0, "one"), (1, "two"), (2, ""), (3, "three")]
    assert "bad � byte" in [r.text for r in R.text_lines(spark, str(tmp_path / "b.txt"), "s").collect()]
    assert rows(R.lines_unordered(spark, str(tmp_path / "c.txt.gz"), "s", 3), "text") == [("ped",), ("zip",)]
    both = R.read_all(spark, [R.Source("x", "text", str(tmp_path / "a*.txt")), R.Source("gone", "text", str(tmp_path / "no*.txt"))])
    assert both.count() == 4
    with pytest.raises(FileNotFoundError):
        R.read_all(spark, [R.Source("gone", "text", str(tmp_path / "no*"))])
    assert R.first_of(spark, [str(tmp_path / "no"), str(tmp_path / "a.txt")]).endswith("a.txt")


def test_parquet(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("t\nu", None, "x"), ("", "b", "y")], "a string, b string, c string").coalesce(1).write.parquet(path)
    assert rows(R.parquet_text(spark, path, "s", ["a", "b", "zz"]), "text") == [("b",), ("t u",)]
    assert rows(R.parquet_text(spark, path, "s", ["zz"]), "text") == [("",), ("b",)]
    assert rows(R.parquet_paragraphs(spark, path, "s", "a"), "line_no", "text") == [(0, "t"), (1, "u")]
    plan = R.parquet_text(spark, path, "s", ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:string,_tmp_metadata_row_index:bigint>" in plan
    out = R.splits(spark, {"train": path, "test": path}, "all", {"train": "fit"})
    assert rows(out.groupBy("part").count()) == [("fit", 2), ("test", 2)]


def test_json_and_tables(spark, rows, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"text": "a"}\n\nnot\n{"text": null}\n{"other": 1}\n', encoding="utf-8")
    assert rows(R.jsonl_field(spark, str(tmp_path / "l.jsonl")), "text") == [("",), ("",), ("a",)]
    (tmp_path / "m.jsonl").write_text('{"audio": "c/x.mp3", "text": "t"}\n\n{"audio": "/y", "text": "u", "dur": 1.5}\n', encoding="utf-8")
    assert rows(R.manifest(spark, str(tmp_path / "m.jsonl"), "/data/"), "audio", "dur") == [("/data/c/x.mp3", None), ("/y", 1.5)]
    (tmp_path / "bad.jsonl").write_text('{"audio": "x"}\n', encoding="utf-8")
    with pytest.raises(Exception, match="lacks"):
        R.manifest(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "worse.jsonl").write_text("{\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        R.pairs(spark, str(tmp_path / "worse.jsonl")).collect()
    (tmp_path / "t.tsv").write_text('path\tsentence\na\t"quoted\nb\tc "d" e\n', encoding="utf-8")
    assert rows(R.tsv(spark, str(tmp_path / "t.tsv"))) == [("a", '"quoted'), ("b", 'c "d" e')]
    (tmp_path / "t.csv").write_text('a,b\n"x, y",z\n', encoding="utf-8")
    assert rows(R.csv(spark, str(tmp_path / "t.csv"))) == [("x, y", "z")]
    (tmp_path / "w.combined").write_text("dictionary=main:en\n word=a,f=9\n word=b,f=3,possibly_offensive=true\n", encoding="utf-8")
    assert rows(R.wordlist(spark, str(tmp_path / "w.combined"))) == [("a", 9), ("b", 3)]


def test_configuration():
    assert R.config('// note\n{"a": {"x": 1}}') == {"a": {"x": 1}}
    assert R.with_defaults({"a": {"x": 1}}, {"a": {"x": 0, "y": 2}, "b": 3}) == {"a": {"x": 1, "y": 2}, "b": 3}
    assert R.layout_rows([["q", ["w", "é"], "e"], ["a"]]) == [("qwe", 0.0), ("a", 1.0)]
    assert R.url_is_safe("https://a.example/x") and not R.url_is_safe("http://a.example/x")


def test_sinks(spark, rows, tmp_path):
    df = spark.createDataFrame([("s", "ü\nx"), ("t", None)], "source string, text string")
    path = lambda name: str(tmp_path / name)
    assert W.guarded(df, path("g")) and not W.guarded(df, path("g")) and W.guarded(df, path("g"), force=True)
    W.by_source(df, path("by"))
    assert rows(spark.read.parquet(path("by")).filter("source = 's'"), "text") == [("ü\nx",)]
    W.lines(df.filter("text is not null"), path("lines"))
    assert rows(spark.read.text(path("lines"))) == [("ü x",)]
    W.jsonl(df, path("json"))
    assert '"ü\\nx"' in "".join(r.value for r in spark.read.text(path("json")).collect())
    clips = spark.createDataFrame([("/d/a.mp3", "x", 3600.0), ("/e/b.mp3", "y", None)], "audio string, text string, dur double")
    assert W.manifest(clips, path("m"), "/d") == 1.0
    assert rows(R.manifest(spark, path("m")), "audio") == [("/e/b.mp3",), ("a.mp3",)]
    words = spark.createDataFrame([("en", "a", 5, False), ("en", "b", 9, True)], "lang string, word string, f int, possibly_offensive boolean")
    W.wordlist(words, path("w"), "en", "x")
    assert [r.value for r in spark.read.text(path("w/1-words")).collect()] == [" word=b,f=9,possibly_offensive=true", " word=a,f=5"]
    assert rows(R.wordlist(spark, [path("w/0-header"), path("w/1-words")])) == [("a", 5), ("b", 9)]
    W.stats(df, path("stats"))
    assert spark.read.json(path("stats")).count() == 2
    res = spark.createDataFrame([("m", "s", 0.5), ("m", "t", 0.6)], "model string, set string, wer double")
    W.merge_results(spark, res, path("r"), ("model", "set"))
    W.merge_results(spark, res.limit(1).withColumn("wer", F.lit(0.1)), path("r"), ("model", "set"))
    assert rows(spark.read.parquet(path("r")), "wer") == [(0.1,), (0.6,)]


def test_checksums(spark, rows, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    good = hashlib.sha256(b"hello").hexdigest()
    found = W.checksums(spark, str(tmp_path))
    got = found.first()
    assert (got["size"], got["sha256"]) == (5, good)
    expected = spark.createDataFrame([(got["path"], 5, "no"), (got["path"], 6, good), ("gone", 1, "x"), (got["path"], 5, good)], "path string, size bigint, sha256 string")
    assert sorted(r.problem for r in W.mismatched(found, expected).collect()) == ["missing", "sha256", "size"]


def test_attribution(spark):
    notes = spark.createDataFrame([("b", "u", None, "n", None), ("a", "u|v", "MIT", "n", "Cite")], "source_name string, url string, license string, use_note string, citation string")
    res = spark.createDataFrame([("m", "s", 0.5, 1, 10), ("k", "t", 0.25, 0, 10)], "model string, set string, wer double, repetitions int, n int")
    page = W.attribution(notes, res)
    assert "u\\|v" in page and "check before publishing: b" in page and "* Cite" in page and "| m | 50.0% | n/a |" in page and "1 of 20" in page
    assert json.dumps(page)


def test_lines_keep_their_numbers_over_blocks(spark, tmp_path):
    for name, n in (("a.txt", 5000), ("b.txt", 30)):
        (tmp_path / name).write_text("".join(f"{name} {k}\n" for k in range(n)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        out = R.text_lines(spark, str(tmp_path), "s").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(out) == 5030 and all(r.text == f"{r.path.rpartition('/')[2]} {r.line_no}" for r in out)
