"""Sources and sinks: files that Spark writes from the given tables are read back by the scans."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tabloom.catalog.registry import Tables, query
from tabloom.functions import tables
from tabloom.functions.scalar import normal_quantile_sql, normal_tail_sql
from tabloom.operators import wiki as WK
from tabloom.plans.draws import PRIME_B, uniform_sql
from tabloom.session import new_path, written
from tabloom.sources import dumps, files, forests, generators, images, sinks, tables as SRC

PART_SCHEMA = "p_partkey long, p_name string, p_size int, p_retailprice double"
PART_SQL = """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_name END AS p_name, CASE WHEN p_size % 7 <> 0 THEN p_size END AS p_size, p_retailprice FROM part"""


def _part_text(t: Tables) -> DataFrame:
    """Part rows as text with missing-value tokens."""
    return t.part.select(
        "p_partkey",
        F.when(F.col("p_size") % 5 == 0, "NA").otherwise(F.col("p_name")).alias("p_name"),
        F.when(F.col("p_size") % 7 == 0, "?").otherwise(F.col("p_size").cast("string")).alias("p_size"),
        "p_retailprice")


def _part_csv(t: Tables, header: bool = True, parts: int = 3) -> str:
    path = new_path(t.spark, "csv")
    _part_text(t).repartition(parts, "p_partkey").write.option("header", header).csv(path)
    return path


@query("scan_csv_typed", PART_SQL)
def _(t):
    return SRC.scan_csv(t.spark, _part_csv(t), PART_SCHEMA)


@query("scan_csv_inferred", """SELECT p_partkey::INT AS p_partkey, CASE WHEN p_size % 5 = 0 THEN 'NA' ELSE p_name END AS p_name,
CASE WHEN p_size % 7 = 0 THEN '?' ELSE p_size::VARCHAR END AS p_size, p_retailprice FROM part""")
def _(t):
    return SRC.scan_csv_inferred(t.spark, _part_csv(t), 1.0)


@query("scan_csv_headerless", PART_SQL)
def _(t):
    return SRC.scan_csv(t.spark, _part_csv(t, header=False), PART_SCHEMA, header=False)


@query("scan_csv_multi", """SELECT year(o_orderdate)::INT AS year, count(*) AS n, max(o_orderkey) AS last FROM orders GROUP BY 1""")
def _(t):
    from tabloom.operators.frame import of_year

    paths = []
    span = t.orders.agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi")).first()
    for year in range(span["lo"], span["hi"] + 1):
        path = new_path(t.spark, f"orders-{year}")
        of_year(t.orders, "o_orderdate", year).select("o_orderkey", "o_orderdate").write.option("header", True).csv(path)
        paths.append(path)
    rows = SRC.scan_many(t.spark, paths, "o_orderkey long, o_orderdate timestamp_ntz")
    return rows.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))


@query("scan_csv_lineterm", PART_SQL)
def _(t):
    path = new_path(t.spark, "csv-bars")
    _part_text(t).repartition(3, "p_partkey").write.option("header", True).option("lineSep", "|").csv(path)
    return SRC.scan_csv(t.spark, path, PART_SCHEMA, line_sep="|")


@query("scan_csv_remote", PART_SQL)
def _(t):
    path = _part_csv(t)
    return SRC.scan_csv(t.spark, path if "://" in path else "file://" + path, PART_SCHEMA, options={"mode": "PERMISSIVE"})


CHUNK_TASK_ROWS = 4_000


@query("scan_csv_chunked", """SELECT count(*) AS n, sum(CASE WHEN p_size % 7 <> 0 THEN p_size END)::BIGINT AS total, true AS chunks_hold, (count(*) > 40) AS several FROM part""")
def _(t):
    """Files of at most 40 records, and what each of them holds."""
    path = new_path(t.spark, "csv-chunks")
    rows = _part_text(t)
    # a task writes about a hundred files, and moves them to their place itself
    parts = max(2, -(-rows.count() // CHUNK_TASK_ROWS))
    rows.repartition(parts, "p_partkey").write.option("header", True).option("maxRecordsPerFile", 40).option("mapreduce.fileoutputcommitter.algorithm.version", "2").csv(path)
    rows = SRC.scan_csv(t.spark, path, PART_SCHEMA).withColumn("chunk", F.col("_metadata.file_name"))
    chunks = rows.groupBy("chunk").agg(F.count("*").alias("n"), F.sum("p_size").alias("total"))
    return chunks.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), (F.max("n") <= 40).alias("chunks_hold"), (F.count("*") > 2).alias("several"))


@query("scan_lazy", "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 950")
def _(t):
    return SRC.scan_csv(t.spark, _part_csv(t), PART_SCHEMA).filter("p_retailprice > 950").select("p_partkey", "p_retailprice")


@query("scan_json", "SELECT event_id, (props ->> '$.k')::BIGINT AS k FROM events")
def _(t):
    path = new_path(t.spark, "json")
    t.events.select(F.to_json(F.struct("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))).alias("value")).write.text(path)
    return SRC.scan_json(t.spark, path, "event_id long, k long")


@query("scan_word_vectors", "SELECT 'w ' || vec_id AS word, embedding AS vector FROM embeddings")
def _(t):
    path = new_path(t.spark, "vectors")
    size = F.size("embedding")
    lines = t.embeddings.select(F.concat_ws(" ", F.concat(F.lit("w "), "vec_id"), F.col("embedding").cast("array<string>")).alias("value"))
    lines.write.text(path)
    dim = t.embeddings.agg(F.max(size)).first()[0]
    return SRC.read_word_vectors(t.spark, path, dim)


# ---------------------------------------------------------------- page dumps

# wiki text made from a document: an infobox, a nested template, a repeat, three links
_WIKI = """SELECT doc_id, lang, source, CASE doc_id % 4 WHEN 3 THEN 10 WHEN 2 THEN 1 ELSE 0 END AS ns,
CASE WHEN doc_id % 5 = 0 THEN 'Page ' || (doc_id + 1) END AS redirect,
CASE WHEN doc_id % 2 = 0 THEN '{{Infobox ' || source || '|x={{convert|1}}}} {{convert|2}} ' ELSE '{{stub}} ' END
 || '[[' || source || '|label]] [[ ' || lang || ' #part]] [[' || source || ']] ' || text AS wiki FROM documents"""


def _dump_path(t: Tables, parts: int | None = None) -> str:
    n = F.col("doc_id")
    markup = F.concat(
        F.when(n % 2 == 0, F.concat(F.lit("{{Infobox "), "source", F.lit("|x={{convert|1}}}} {{convert|2}} "))).otherwise("{{stub}} "),
        F.lit("[["), "source", F.lit("|label]] [[ "), "lang", F.lit(" #part]] [["), "source", F.lit("]] "), "text")
    # control characters cannot be written as XML
    clean = F.regexp_replace(markup, r"[\x00-\x08\x0b\x0c\x0e-\x1f\uFFFE\uFFFF]", "")
    pages = t.documents.select(
        F.concat(F.lit("Page "), n).alias("title"),
        F.when(n % 4 == 3, 10).when(n % 4 == 2, 1).otherwise(0).alias("ns"),
        n.alias("id"),
        F.when(n % 5 == 0, F.struct(F.concat(F.lit("Page "), n + 1).alias("_title"))).alias("redirect"),
        F.struct((n + 900000000).alias("id"), F.struct(F.lit("wikitext").alias("_format"), clean.alias("_VALUE")).alias("text")).alias("revision"))
    path = new_path(t.spark, "dump")
    pages = pages if parts is None else pages.repartition(parts, "id")
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    return path


def _pages(t: Tables) -> DataFrame:
    return dumps.read_wiki_dump(t.spark, _dump_path(t))


@query("scan_wiki_xml", f"SELECT doc_id AS id, ns, 'Page ' || doc_id AS title, redirect FROM ({_WIKI})")
def _(t):
    return _pages(t).select("id", "ns", "title", "redirect")


@query("scan_single_file", "SELECT count(*) > 0 AS some, count(*) FILTER (lang IS NULL) AS outside FROM documents")
def _(t):
    one = dumps.read_wiki_dump(t.spark, _dump_path(t), first_only=True)
    known = t.documents.select(F.col("doc_id").alias("id"))
    return one.join(known.withColumn("known", F.lit(1)), "id", "left").agg(
        (F.count("*") > 0).alias("some"), F.count_if(F.col("known").isNull()).alias("outside"))


@query("fn_xml_localname", f"SELECT count(*) AS n FROM ({_WIKI}) WHERE ns = 10")
def _(t):
    return _pages(t).filter("ns = 10").agg(F.count("*").alias("n"))


@query("wiki_route", f"""SELECT CASE WHEN ns = 10 THEN 'template' WHEN redirect IS NOT NULL THEN 'redirect' ELSE 'article' END AS kind, doc_id AS article_id
FROM ({_WIKI}) WHERE ns IN (0, 10)""")
def _(t):
    routed = WK.route_pages(_pages(t))
    out = None
    for kind, rows in routed.items():
        part = rows.select(F.lit(kind).alias("kind"), "article_id")
        out = part if out is None else out.unionByName(part)
    return out


_ARTICLES = f"(SELECT * FROM ({_WIKI}) WHERE ns = 0 AND redirect IS NULL)"
_TEMPLATES = rf"""SELECT DISTINCT doc_id AS article_id, trim(name, ' ' || chr(9) || chr(10) || chr(13)) AS template_name FROM (SELECT doc_id,
unnest(regexp_extract_all(wiki, '\{{\{{([^{{}}|]*)', 1)) AS name FROM {_ARTICLES}) WHERE trim(name) <> '' AND NOT starts_with(trim(name), '#')"""
_LINKS = rf"""SELECT DISTINCT doc_id AS source_article_id, trim(name, ' ' || chr(9) || chr(10) || chr(13)) AS target_article_name FROM (SELECT doc_id,
unnest(regexp_extract_all(wiki, '\[\[([^\]|#]*)', 1)) AS name FROM {_ARTICLES}) WHERE trim(name) <> ''"""


def _articles(t: Tables) -> DataFrame:
    return WK.route_pages(_pages(t))["article"]


@query("wiki_templates", _TEMPLATES)
def _(t):
    return WK.article_templates(_articles(t))


@query("win_dedupe_terms", f"SELECT article_id, count(*) AS terms FROM ({_TEMPLATES}) GROUP BY 1")
def _(t):
    return WK.article_templates(_articles(t)).groupBy("article_id").agg(F.count("*").alias("terms"))


@query("wiki_links", _LINKS)
def _(t):
    return WK.article_links(_articles(t))


@query("wiki_infobox", f"SELECT doc_id AS article_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS infobox FROM {_ARTICLES}")
def _(t):
    return WK.article_infobox(_articles(t))


@query("wiki_article_index", f"SELECT doc_id AS article_id, 'Page ' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN source ELSE '' END AS infobox, true AS has_file FROM {_ARTICLES}")
def _(t):
    return WK.article_index(_articles(t)).select("article_id", "title", "infobox", F.col("file").startswith("part-").alias("has_file"))


@query("wiki_counts", f"""SELECT count(*) AS total, count(*) FILTER (ns = 0 AND redirect IS NULL) AS articles, count(*) FILTER (ns = 0 AND redirect IS NOT NULL) AS redirects,
count(*) FILTER (ns = 10) AS templates, 0::BIGINT AS damaged FROM ({_WIKI})""")
def _(t):
    return WK.dump_stats(_pages(t))


@query("wiki_infobox_titles", f"SELECT 'Page ' || doc_id AS title FROM {_ARTICLES} WHERE doc_id % 2 = 0")
def _(t):
    return WK.infobox_titles(_articles(t))


@query("udf_worker", f"SELECT doc_id AS article_id, length(wiki) > 2000 AS long FROM {_ARTICLES}")
def _(t):
    def handler(routed):
        return {"sizes": routed["article"].select("article_id", (F.length("text") > 2000).alias("long"))}

    return WK.extract(_pages(t), handler)["sizes"]


@query("udf_table", f"""WITH a AS (SELECT doc_id AS page, doc_id % 2 = 0 AS box, source FROM {_ARTICLES}),
n AS (SELECT page, 1 AS depth, 'Infobox ' || source AS template, 'Infobox ' || source AS path, 0 AS line FROM a WHERE box
UNION ALL SELECT page, 2, 'convert', 'Infobox ' || source || '/convert', 1 FROM a WHERE box UNION ALL SELECT page, 1, 'convert', 'convert', 2 FROM a WHERE box
UNION ALL SELECT page, 1, 'stub', 'stub', 0 FROM a WHERE NOT box)
SELECT page, line, depth, template, path, CASE WHEN depth = 2 THEN 'Infobox ' || source END AS outer_template FROM n JOIN (SELECT page, source FROM a) USING (page)""")
def _(t):
    """Template nesting by a table function that keeps its state over the lines of a page, joined laterally to the templates around."""
    tables.register(t.spark)
    # wiki text has its parameters on lines of their own
    lines = _articles(t).select(F.col("article_id").alias("page"), F.posexplode(F.split(F.regexp_replace("text", r"\|", "\n|"), "\n")).alias("line", "text"))
    lines.createOrReplaceTempView("wiki_lines")
    return t.spark.sql("""SELECT t.page, t.line, t.depth, t.template, t.path, o.outer_template
        FROM template_tree(TABLE(SELECT page, line, text FROM wiki_lines) PARTITION BY page ORDER BY line) t,
        LATERAL (SELECT CASE WHEN t.depth > 1 THEN element_at(split(t.path, '/'), t.depth - 1) END AS outer_template) o WHERE t.depth > 0""")


@query("sink_multi_table", f"""SELECT 'article' AS name, count(*) AS n FROM {_ARTICLES} UNION ALL SELECT 'articleTemplate', count(*) FROM ({_TEMPLATES})
UNION ALL SELECT 'articleLink', count(*) FROM ({_LINKS}) UNION ALL SELECT 'redirect', count(*) FROM ({_WIKI}) WHERE ns = 0 AND redirect IS NOT NULL
UNION ALL SELECT 'template', count(*) FROM ({_WIKI}) WHERE ns = 10""")
def _(t):
    # parsed once: the pages are stored, and each table reads them again
    pages, out = written(_pages(t), "pages"), new_path(t.spark, "wiki-tables")
    made = WK.wiki_tables(pages)
    sinks.write_tables(made, out, fmt="parquet")
    counts = None
    for name in made:
        back = t.spark.read.parquet(f"{out}/{name}")
        one = back.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


# ---------------------------------------------------------------- listings and manifests


@query("find_latest_dump", "SELECT strftime(max(o_orderdate), '%Y%m%d') AS dump FROM orders")
def _(t):
    # a folder per year, named by its last day, as files that are then listed; one write makes all of them
    root, year = new_path(t.spark, "dumps"), F.year("o_orderdate")
    last = t.orders.groupBy(year.alias("y")).agg(F.date_format(F.max("o_orderdate"), "yyyyMMdd").alias("dl"))
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("value"), year.alias("y")).join(last, "y").select("value", "dl")
    rows.repartition("dl").write.partitionBy("dl").text(f"{root}/dumps")
    listed = dumps.file_names(t.spark, root).select(F.regexp_replace("path", "/dl=", "/dl/").alias("path"))
    return dumps.latest_dump(listed)


@query("pick_latest_complete", """WITH d AS (SELECT strftime(o_orderdate, '%Y%m%d')::BIGINT AS dump, min(o_custkey) % 2 = 0 AS done FROM orders GROUP BY 1),
r AS (SELECT dump, done, row_number() OVER (ORDER BY dump DESC) AS i FROM d)
SELECT CASE WHEN (SELECT done FROM r WHERE i = 1) THEN (SELECT dump FROM r WHERE i = 1) ELSE (SELECT dump FROM r WHERE i = 2) END AS dump""")
def _(t):
    stamp = F.date_format("o_orderdate", "yyyyMMdd")
    links = t.orders.select(F.concat(stamp, F.lit("/")).alias("href")).unionByName(
        dumps.extract_links(t.pages).select("href"))
    status = t.orders.groupBy(stamp.cast("long").alias("dump")).agg(
        F.when(F.min("o_custkey") % 2 == 0, "done").otherwise("waiting").alias("status"))
    return dumps.latest_complete(links, status)


@query("extract_links", """WITH l AS (SELECT page_id, regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1) AS h FROM pages)
SELECT page_id, (unnest(generate_series(1, len(h))) - 1)::INT AS pos, unnest(h) AS href FROM l""")
def _(t):
    return dumps.extract_links(t.pages)


@query("select_dump_files", """SELECT page_id, '/x/dump-' || page_id || '-pages-meta-current1.xml-p1.bz2' AS href,
'https://dumps.example.org/x/dump-' || page_id || '-pages-meta-current1.xml-p1.bz2' AS url, 'dump-' || page_id || '-pages-meta-current1.xml-p1.bz2' AS target FROM pages""")
def _(t):
    name = lambda kind: F.concat(F.lit('<li class="file"><a href="/x/dump-'), "page_id", F.lit(f'-{kind}">f</a></li>'))
    html = F.concat("html", name("pages-meta-current1.xml-p1.bz2"), name("stub-meta-current1.xml-p1.bz2"), name("pages-articles.xml-p1.bz2"))
    links = dumps.extract_file_links(t.pages.select("page_id", html.alias("html")))
    return dumps.select_dump_files(links, "https://dumps.example.org/").select("page_id", "href", "url", "target")


@query("manifest_status", """SELECT 'd' || doc_id AS file, CASE WHEN doc_id % 3 = 0 THEN 'Missing' WHEN doc_id % 3 = 1 THEN 'Corrupt' ELSE 'Exists' END AS status,
doc_id % 3 <> 2 AS should_download FROM documents""")
def _(t):
    """Two thirds of the files of a manifest are there, half of these with other bytes; what is there is hashed from the files."""
    file = F.concat(F.lit("d"), "doc_id")
    meta = F.to_json(F.struct(F.concat(F.lit("/x/"), file).alias("url"), F.sha1("text").alias("sha1"), F.col("n_chars").alias("size")))
    text = F.concat(F.lit('{"jobs":{"metacurrentdump":{"status":"done","files":{"'), file, F.lit('":'), meta, F.lit("}}}}"))
    manifest = dumps.manifest_files(t.documents.select(text.alias("value")))
    root, there = new_path(t.spark, "mirror"), t.documents.filter("doc_id % 3 <> 0")
    body = F.when(F.col("doc_id") % 3 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    files.write_files(there.select(F.concat((F.col("doc_id") % 7).cast("string"), F.lit("/"), file).alias("name"), body.cast("binary").alias("content")), root)
    return dumps.reconcile(manifest, files.hash_files(t.spark, root))


@query("read_binary_meta", """SELECT strftime(ts, '%Y_%m_%d') || '_' || (user_id % 10) || '.jpg' AS file, ts::DATE AS date, sum(length(event_id::VARCHAR) + 1)::BIGINT AS length FROM events GROUP BY 1, 2""")
def _(t):
    """The events of a day and a tenth of the users as one file each; names and lengths come from the folder's listing."""
    name = F.concat(F.lit("cam/"), F.date_format("ts", "yyyy_MM_dd"), F.lit("_"), (F.col("user_id") % 10).cast("string"), F.lit(".jpg"))
    lines = t.events.groupBy(name.alias("name")).agg(F.concat_ws("", F.collect_list(F.concat(F.col("event_id").cast("string"), F.lit("\n")))).alias("content"))
    root = new_path(t.spark, "camera")
    files.write_files(lines.select("name", F.col("content").cast("binary").alias("content")), root)
    listed = files.file_meta(t.spark, root)
    return images.image_dates(listed.select("path")).join(listed.select("path", "length"), "path").select("file", "date", "length")


def _png(width: int, height: int, channels: int) -> bytes:
    """A picture of one colour: header, compressed rows, end."""
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    rows = (b"\0" + b"\x7f" * (width * channels)) * height
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if channels == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


@query("image_audit", """WITH i AS (SELECT p_partkey, 'img' || lpad(p_partkey::VARCHAR, 9, '0') || '.png' AS file, 10 * (1 + p_size // 40) AS w, 10 * (1 + p_size // 45) AS h, CASE WHEN p_size % 9 = 0 THEN 1 ELSE 3 END AS c FROM part),
b AS (SELECT arg_min(w, file) AS base FROM i WHERE c = 3 AND w = h)
SELECT file, CASE WHEN c <> 3 THEN 'mode' WHEN w <> h THEN 'not square' ELSE 'size' END AS problem FROM i, b WHERE c <> 3 OR w <> h OR w <> base""")
def _(t):
    """A picture file per part; sizes and channels are read from the files' headers."""
    def draw(batches):
        for batch in batches:
            content = [_png(*row) for row in zip(batch["w"], batch["h"], batch["c"])]
            yield pd.DataFrame({"name": batch["name"], "content": content})

    size = F.col("p_size")
    wanted = t.part.select(F.concat(F.lit("img"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"), F.lit(".png")).alias("name"),
                           (10 * (1 + F.floor(size / 40))).alias("w"), (10 * (1 + F.floor(size / 45))).alias("h"), F.when(size % 9 == 0, 1).otherwise(3).alias("c"))
    root = new_path(t.spark, "pictures")
    files.write_files(wanted.mapInPandas(draw, "name string, content binary"), root)
    return images.audit_images(files.read_image_sizes(t.spark, root))


# ---------------------------------------------------------------- exported forests

FOREST_CLASSES = ["small", "large"]


def _forest(t: Tables) -> DataFrame:
    """One tree per brand: a split at the brand's mean size, and one at its mean price."""
    means = t.part.groupBy(F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("tree")).agg(
        F.avg("p_size").alias("s"), F.max("p_retailprice").alias("p"))
    leaf = '<Node id="{}" score="{}"><SimplePredicate field="{}" operator="{}" value="%s"/></Node>'
    text = F.concat(
        F.lit('<Segment id="'), "tree", F.lit('"><True/><TreeModel><Node id="1"><True/><Node id="2"><SimplePredicate field="Part.Size" operator="lessOrEqual" value="'),
        "s", F.lit('"/>'),
        F.lit('<Node id="4" score="small"><SimplePredicate field="Part.Price" operator="lessOrEqual" value="'), "p", F.lit('"/></Node>'),
        F.lit('<Node id="5" score="large"><SimplePredicate field="Part.Price" operator="greaterThan" value="'), "p", F.lit('"/></Node></Node>'),
        F.lit('<Node id="3" score="large"><SimplePredicate field="Part.Size" operator="greaterThan" value="'), "s",
        F.lit('"/></Node></Node></TreeModel></Segment>'))
    path = new_path(t.spark, "forest")
    means.select(text.alias("value")).write.text(path)
    return forests.read_pmml_forest(t.spark, path)


_FOREST = """(SELECT regexp_extract(p_brand, '(\\d+)', 1)::INT AS tree, avg(p_size) AS s, max(p_retailprice) AS p FROM part GROUP BY 1)"""


@query("scan_pmml_forest", f"""SELECT tree, 1::BIGINT AS node, NULL::BIGINT AS parent, NULL AS field, NULL AS op, NULL::DOUBLE AS value, NULL AS score FROM {_FOREST}
UNION ALL SELECT tree, 2, 1, 'Part.Size', 'lessOrEqual', s, NULL FROM {_FOREST} UNION ALL SELECT tree, 3, 1, 'Part.Size', 'greaterThan', s, 'large' FROM {_FOREST}
UNION ALL SELECT tree, 4, 2, 'Part.Price', 'lessOrEqual', p, 'small' FROM {_FOREST} UNION ALL SELECT tree, 5, 2, 'Part.Price', 'greaterThan', p, 'large' FROM {_FOREST}""".replace("\\\\", "\\"))
def _(t):
    return _forest(t)


@query("ml_score_forest", f"""WITH v AS (SELECT p_partkey, count(*) FILTER (a.p_size <= s AND a.p_retailprice <= p) AS small, count(*) AS n FROM part a, {_FOREST} GROUP BY 1)
SELECT p_partkey, small / n AS probability_small, (n - small) / n AS probability_large, CASE WHEN small >= n - small THEN 'small' ELSE 'large' END AS predicted FROM v""".replace("\\\\", "\\"))
def _(t):
    rows = t.part.select("p_partkey", "p_size", "p_retailprice")
    out = forests.score_pmml(rows, _forest(t), FOREST_CLASSES, {"Part.Size": "p_size", "Part.Price": "p_retailprice"})
    return out.drop("p_size", "p_retailprice")


# ---------------------------------------------------------------- generators


@query("gen_function_data", f"""WITH d AS (SELECT o_orderkey, {uniform_sql(42, 'o_orderkey')} AS x1, 0.01::DOUBLE + {uniform_sql(43, 'o_orderkey')} * (1 - 0.01::DOUBLE) AS x2 FROM orders)
SELECT o_orderkey, round(x1, 9) AS x1, round(x2, 9) AS x2, round(x1 / x2, 6) AS y FROM d""")
def _(t):
    expr, ranges = generators.FUNCTIONS["ratio"]
    rows = generators.generate(t.orders.select("o_orderkey"), ranges, expr)
    return rows.select("o_orderkey", F.round("x1", 9).alias("x1"), F.round("x2", 9).alias("x2"), F.round("y", 6).alias("y"))


def _normal_sql(seed: int, mean: float, sd: float) -> str:
    return f"(SELECT o_orderkey, {mean} + {normal_quantile_sql('p', 'tail')} * {sd} AS x1 FROM (SELECT *, {normal_tail_sql('p')} AS tail FROM (SELECT o_orderkey, {uniform_sql(seed, 'o_orderkey')} + 0.5::DOUBLE / {PRIME_B} AS p FROM orders)))"


@query("gen_mixture_data", f"SELECT 0 AS center, o_orderkey, round(x1, 7) AS x1 FROM {_normal_sql(42, 20.0, 6.4)} UNION ALL SELECT 1, o_orderkey, round(x1, 7) FROM {_normal_sql(142, 37.0, 6.3)}")
def _(t):
    rows = generators.generate_mixture(t.orders.select("o_orderkey"), [[20.0], [37.0]], [[6.4], [6.3]])
    return rows.select("center", "o_orderkey", F.round("x1", 7).alias("x1"))


# ---------------------------------------------------------------- sinks


@query("sink_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(t):
    path = new_path(t.spark, "out")
    sinks.write_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), path, rows_per_file=100_000)
    return SRC.scan_csv(t.spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double")


@query("sink_csv_formatted", """SELECT format('{:10.5f}', p_partkey::DOUBLE) AS p_partkey, format('{:10.5f}', p_retailprice) AS p_retailprice FROM part""")
def _(t):
    path = new_path(t.spark, "out")
    sinks.write_csv(t.part.select("p_partkey", "p_retailprice"), path, fmt="%10.5f")
    return t.spark.read.option("header", True).csv(path)


@query("sink_snapshot", "SELECT l_shipdate, sum(l_quantity) AS total FROM lineitem GROUP BY 1")
def _(t):
    path = new_path(t.spark, "snapshot")
    sinks.save_table(t.lineitem.groupBy("l_shipdate").agg(F.sum("l_quantity").alias("total")), path)
    return sinks.load_table(t.spark, path)


@query("sink_measures", """SELECT user_id, max(value) FILTER (event_type = 'click') AS click, max(value) FILTER (event_type = 'error') AS error, max(value) FILTER (event_type = 'purchase') AS purchase,
max(value) FILTER (event_type = 'signup') AS signup, max(value) FILTER (event_type = 'view') AS "view" FROM events GROUP BY 1""")
def _(t):
    long = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("value"))
    return sinks.export_measures(long, "user_id", "event_type", "value", ["click", "error", "purchase", "signup", "view"])
