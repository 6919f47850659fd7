"""Scans and sinks on small files."""

import bz2
import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tabloom.operators import wiki as WK
from tabloom.sources import dumps, forests, generators, images, sinks, tables as SRC

MPG = "mpg double, cylinders long, horsepower long, name string"


def test_typed_csv_with_null_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mpg,cylinders,horsepower,name\n18.0,8,130,ford\n25.0,4,?,opel\nNA,4,90,?\n x ,5,,vw\n")
    rows = SRC.scan_csv(spark, str(tmp_path / "a.csv"), MPG).collect()
    assert [r["horsepower"] for r in rows] == [130, None, 90, None]
    assert [r["mpg"] for r in rows] == [18.0, 25.0, None, None] and rows[2]["name"] is None


def test_headerless_and_many_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"y{i}.csv").write_text(f"2020-01-0{i + 1},09:30:00,{i}.5\n")
    df = SRC.scan_many(spark, [str(tmp_path / f"y{i}.csv") for i in range(3)], "d string, t string, price double", header=False)
    ts = df.select(SRC.combine_ts(F.col("d"), F.col("t")).alias("ts")).agg(F.max("ts")).first()[0]
    assert df.count() == 3 and ts == dt.datetime(2020, 1, 3, 9, 30)


def test_inferred_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\n2,y\n")
    assert [f.dataType.simpleString() for f in SRC.scan_csv_inferred(spark, str(tmp_path / "a.csv")).schema] == ["int", "string"]


def test_only_used_columns_are_cast(spark, tmp_path):
    (tmp_path / "a.csv").write_text("mpg,cylinders,horsepower,name\n18.0,8,130,ford\n")
    plan = SRC.scan_csv(spark, str(tmp_path / "a.csv"), MPG).select("name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<name:string>" in plan


def test_word_vectors(spark, tmp_path):
    (tmp_path / "v.txt").write_text("the 0.5 1 -2\nnew york 1 2 3\nbroken 1\n")
    got = {r["word"]: r["vector"] for r in SRC.read_word_vectors(spark, str(tmp_path / "v.txt"), 3).collect()}
    assert got == {"the": [0.5, 1, -2], "new york": [1, 2, 3]}


def page(title, ns, id_, text, redirect=None):
    red = f'<redirect title="{redirect}" />' if redirect else ""
    return (f"  <page>\n    <title>{title}</title>\n    <ns>{ns}</ns>\n    <id>{id_}</id>\n    {red}\n    <revision>\n      <id>{id_ + 1000}</id>\n"
            f'      <text bytes="9" xml:space="preserve">{text}</text>\n    </revision>\n  </page>\n')


DUMP = ('<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" xml:lang="en">\n  <siteinfo><sitename>W</sitename></siteinfo>\n'
        + page("One", 0, 1, "{{Infobox town|a=1}} {{stub}} {{stub}} [[Two|label]] [[Two]] [[Three]]")
        + page("Two", 0, 2, "{{Infobox a}} {{Infobox b}} &amp; &lt;b&gt;")
        + page("Three", 0, 3, "plain") + page("Zwei", 0, 4, "x", "Two") + page("Template:T", 10, 5, "t") + page("Talk:One", 1, 6, "talk")
        + "</mediawiki>\n")


@pytest.fixture(scope="module")
def dump_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("dump")
    (d / "a.xml").write_text(DUMP)
    (d / "z.xml.bz2").write_bytes(bz2.compress(DUMP.encode()))
    return d


@pytest.mark.parametrize("name", ["a.xml", "z.xml.bz2"])
def test_dump_tables(spark, dump_dir, name):
    pages = dumps.read_wiki_dump(spark, str(dump_dir / name))
    made = {k: sorted(tuple(r) for r in v.collect()) for k, v in WK.wiki_tables(pages).items()}
    assert made["article"] == [(1, "One", "town", name), (2, "Two", "['a', 'b']", name), (3, "Three", "", name)]
    assert made["articleTemplate"] == [(1, "Infobox town"), (1, "stub"), (2, "Infobox a"), (2, "Infobox b")]
    assert made["articleLink"] == [(1, "Three"), (1, "Two")]
    assert made["redirect"] == [(4, "Zwei", "Two")] and made["template"] == [(5, "Template:T")]
    stats = WK.dump_stats(pages).first()
    assert tuple(stats) == (6, 3, 1, 1, 0)
    assert pages.filter("id = 2").first()["text"].endswith("& <b>")


@pytest.mark.parametrize("size", ["200b", "700b", "128m"])
def test_one_dump_file_is_read_in_splits(spark, dump_dir, size):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        pages = dumps.read_wiki_dump(spark, str(dump_dir / "a.xml"))
        assert sorted(r["id"] for r in pages.collect()) == [1, 2, 3, 4, 5, 6]
        assert (pages.rdd.getNumPartitions() > 1) == (size != "128m")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_damaged_page_is_counted_and_skipped(spark, tmp_path):
    (tmp_path / "d.xml").write_text("<mediawiki>" + page("Ok", 0, 1, "x") + "<page><title>Bad</page>" + page("Also", 0, 2, "y") + "</mediawiki>")
    pages = dumps.read_wiki_dump(spark, str(tmp_path / "d.xml"))
    stats = WK.dump_stats(pages).first()
    assert stats["total"] == 3 and stats["articles"] == 2 and stats["damaged"] == 1
    assert WK.route_pages(pages)["article"].count() == 2


def test_first_file_only(spark, dump_dir):
    assert {r["file"] for r in dumps.read_wiki_dump(spark, str(dump_dir), first_only=True).collect()} == {"a.xml"}


def test_sink_of_five_tables(spark, dump_dir, tmp_path):
    pages = dumps.read_wiki_dump(spark, str(dump_dir / "a.xml"))
    sinks.write_tables(WK.wiki_tables(pages), str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out/article"))
    assert back.columns == ["article_id", "title", "infobox", "file"] and back.count() == 3


def test_manifest(spark, tmp_path):
    (tmp_path / "ok.bz2").write_bytes(b"good")
    (tmp_path / "bad.bz2").write_bytes(b"bad")
    sha = hashlib.sha1(b"good").hexdigest()
    text = ('{"jobs":{"metacurrentdump":{"status":"done","files":{"ok.bz2":{"url":"/ok","sha1":"%s"},"bad.bz2":{"url":"/bad","sha1":"%s"},'
            '"gone.bz2":{"url":"/gone","sha1":"%s"}}}}}' % (sha, sha, sha))
    manifest = dumps.manifest_files(spark.createDataFrame([(text,)], "value string"))
    got = {r["file"]: (r["status"], r["should_download"]) for r in dumps.reconcile(manifest, dumps.file_hashes(spark, str(tmp_path))).collect()}
    assert got == {"ok.bz2": ("Exists", False), "bad.bz2": ("Corrupt", True), "gone.bz2": ("Missing", True)}


def test_latest_folders(spark):
    names = spark.createDataFrame([("/d/dl/20200101/a",), ("/d/dl/20210101/b",), ("/d/dl/latest/c",)], "path string")
    assert dumps.latest_dump(names).first()[0] == "20210101"
    links = spark.createDataFrame([("20200101/",), ("20210101/",), ("latest/",), ("20190101/",)], "href string")
    done = spark.createDataFrame([(20210101, "done")], "dump long, status string")
    wait = spark.createDataFrame([(20210101, "waiting"), (20200101, "done")], "dump long, status string")
    assert dumps.latest_complete(links, done).first()["dump"] == 20210101
    assert dumps.latest_complete(links, wait).first()["dump"] == 20200101


def test_image_listing_and_detector(spark, tmp_path):
    (tmp_path / "2021_03_04_cam.jpg").write_bytes(b"pp q p")
    (tmp_path / "2021_03_05_cam.jpg").write_bytes(b"")
    listed = {r["file"]: r["date"] for r in images.list_images(spark, str(tmp_path)).collect()}
    assert listed["2021_03_04_cam.jpg"] == dt.date(2021, 3, 4)
    files = spark.read.format("binaryFile").load(str(tmp_path))
    found = images.detect(files, lambda b: [("person", float(i)) for i, c in enumerate(b) if c == ord("p")], "name string, xmax double")
    assert found.count() == 3


def test_image_audit_reads_real_images(spark, tmp_path):
    import struct
    import zlib

    def png(w, h, gray=False):
        def chunk(kind, data):
            return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
        row = b"\x00" + b"\x10" * (w * (1 if gray else 3))
        return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0 if gray else 2, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(row * h)) + chunk(b"IEND", b""))

    for name, data in {"a.png": png(4, 4), "b.png": png(4, 4), "c.png": png(5, 5), "d.png": png(4, 6), "e.png": png(4, 4, True)}.items():
        (tmp_path / name).write_bytes(data)
    got = {r["file"]: r["problem"] for r in images.audit_images(images.read_images(spark, str(tmp_path))).collect()}
    assert got == {"c.png": "size", "d.png": "not square", "e.png": "mode"}


FOREST = """<?xml version="1.0"?>
<PMML version="4.3"><MiningModel><Segmentation multipleModelMethod="majorityVote">
   <Segment id="1"><True/><TreeModel modelName="m"><Node id="1"><True/><Node id="2" score="setosa"><SimplePredicate field="Petal.Length" operator="lessOrEqual" value="2.5"/></Node>
     <Node id="3"><SimplePredicate field="Petal.Length" operator="greaterThan" value="2.5"/><Node id="4" score="versicolor"><SimplePredicate field="Petal.Width" operator="lessOrEqual" value="1.7"/></Node>
     <Node id="5" score="virginica"><SimplePredicate field="Petal.Width" operator="greaterThan" value="1.7"/></Node></Node></Node></TreeModel></Segment>
   <Segment id="2"><True/><TreeModel><Node id="1" score="setosa"><True/></Node></TreeModel></Segment>
   <Segment id="3"><True/><TreeModel><Node id="1"><True/><Node id="2" score="virginica"><SimplePredicate field="Petal.Width" operator="greaterThan" value="1.0"/></Node>
     <Node id="3" score="setosa"><SimplePredicate field="Petal.Width" operator="lessOrEqual" value="1.0"/></Node></Node></TreeModel></Segment>
</Segmentation></MiningModel></PMML>
"""


def test_forest_scoring(spark, tmp_path):
    (tmp_path / "f.pmml").write_text(FOREST)
    nodes = forests.read_pmml_forest(spark, str(tmp_path / "f.pmml"))
    assert nodes.count() == 9 and nodes.filter("op is not null").count() == 6
    flowers = spark.createDataFrame([(1.4, 0.2), (6.0, 2.2), (4.0, 1.2)], "pl double, pw double")
    out = forests.score_pmml(flowers, nodes, ["setosa", "versicolor", "virginica"], {"Petal.Length": "pl", "Petal.Width": "pw"}).collect()
    assert [r["predicted"] for r in out] == ["setosa", "virginica", "setosa"]
    assert out[1]["probability_virginica"] == pytest.approx(2 / 3)


@pytest.mark.parametrize("name", sorted(generators.FUNCTIONS))
def test_generated_rows(spark, name):
    expr, ranges = generators.FUNCTIONS[name]
    df = generators.generate(spark.range(200), ranges, expr)
    r = df.agg(F.count("*").alias("n"), F.count("y").alias("y"), F.min("x1").alias("lo"), F.max("x1").alias("hi")).first()
    assert r["n"] == r["y"] == 200 and ranges[0][0] <= r["lo"] <= r["hi"] <= ranges[0][1]
    assert sorted(df.collect()) == sorted(generators.generate(spark.range(200), ranges, expr).collect())


def test_rejected_draws_are_replaced(spark):
    df = generators.generate(spark.range(300), [(-1.0, 1.0)], "case when x1 > 0 then sqrt(x1) end", tries=24)
    assert df.count() == 300 and df.filter("x1 <= 0").count() == 0


def test_fixed_format(spark, tmp_path):
    sinks.write_csv(spark.createDataFrame([(1.5, "a")], "x double, s string").coalesce(1), str(tmp_path / "o"), fmt="%10.5f")
    text = next((tmp_path / "o").glob("part*")).read_text()
    assert text == "x,s\n   1.50000,a\n"


def test_snapshot_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.1 + 0.2, None)], "a int, b double, c string")
    sinks.save_table(df, str(tmp_path / "t"))
    assert sinks.load_table(spark, str(tmp_path / "t")).collect() == df.collect()


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    from tabloom import session

    class Fake:
        class sparkContext:
            master = "yarn"

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        session.work_dir(Fake)
