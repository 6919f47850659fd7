"""Page dumps, dump listings and manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tabloom.functions.scalar import basename, url_join

PAGE_SCHEMA = ("id long, ns int, title string, redirect struct<_title:string>, "
               "revision struct<id:long,text:string>, _corrupt_record string")
PAGE_START = "<page>"


def parse_pages(records: DataFrame) -> DataFrame:
    """Page records (value, file), cut at the page start tag, to id, ns, title, redirect, text, file, damaged.

    The page id is the one outside the revision.
    """
    end = F.instr("value", "</page>")
    # what stands before the first page has no end tag either, but no title; a page whose end is cut off is kept as damaged
    page = (end > 0) | F.col("value").contains("<title>")
    body = F.when(end > 0, F.concat(F.substring("value", F.lit(1), end - 1), F.lit("</page>"))).otherwise(F.col("value"))
    xml = F.concat(F.lit(PAGE_START), body)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    pages = records.filter(page).select("file", F.from_xml(xml, PAGE_SCHEMA, options).alias("p"))
    return pages.select(
        "p.id",
        "p.ns",
        "p.title",
        F.nullif("p.redirect._title", F.lit("")).alias("redirect"),
        F.col("p.revision.text").alias("text"),
        "file",
        F.col("p._corrupt_record").isNotNull().alias("damaged"),
    )


def read_wiki_dump(spark: SparkSession, path: str | Sequence[str], first_only: bool = False) -> DataFrame:
    """Pages of ``.xml`` or ``.xml.bz2`` dumps.

    The file is split at page start tags by the text source, so that even one huge plain or
    bz2 file is read by many tasks (the XML source takes a whole file per task); each page
    is then parsed by the built-in XML function. A page that does not parse is kept with
    ``damaged`` set.
    """
    if first_only:
        path = first_file(spark, path if isinstance(path, str) else path[0])
    text = spark.read.option("lineSep", PAGE_START).text(path if isinstance(path, str) else list(path))
    return parse_pages(text.select("value", F.col("_metadata.file_name").alias("file")))


def file_names(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; only the listing is used, no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", "modificationTime"))


def first_file(spark: SparkSession, path: str) -> str:
    return file_names(spark, path).agg(F.min("path")).first()[0]


def latest_dump(names: DataFrame, c: str = "path") -> DataFrame:
    """The newest dated folder right below ``dl/``."""
    stamp = F.regexp_extract(c, r"(?:^|/)dl/(\d+)(?:/|$)", 1)
    return names.select(stamp.alias("dump")).filter("dump <> ''").agg(F.max("dump").alias("dump"))


def latest_complete(links: DataFrame, status: DataFrame, href: str = "href", fallback: int = 2) -> DataFrame:
    """The numerically largest dump link, or the next one while the largest is not done.

    ``status`` has (dump long, status string).
    """
    number = F.substring_index(href, "/", 1).try_cast("long")
    dumps = links.select(number.alias("dump")).filter("dump is not null").distinct()
    newest = dumps.orderBy(F.desc("dump")).limit(fallback)
    newest = newest.join(status, "dump", "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    top, second = F.max("dump"), F.min("dump")
    top_done = F.max_by("status", "dump") == "done"
    return newest.agg(F.when(top_done, top).otherwise(second).alias("dump"))


def extract_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Every ``href`` of an ``<a>`` tag: (key, pos, href), in page order."""
    found = F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("pos", "href"))


def extract_file_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Links inside ``<li class="file">`` items only: (key, pos, href)."""
    items = F.regexp_extract_all(html, F.lit(r'(?s)<li[^>]*class="file"[^>]*>(.*?)</li>'), F.lit(1))
    return extract_links(pages.select(key, F.array_join(items, "\n").alias("_items")), key, "_items")


def select_dump_files(links: DataFrame, base: str | Column, contains: Sequence[str] = ("-current", "xml-"),
                      excludes: Sequence[str] = ("-stub",), href: str = "href") -> DataFrame:
    """Keep links by name, resolve them and add the target file name."""
    test = F.lit(True)
    for part in contains:
        test = test & F.col(href).contains(part)
    for part in excludes:
        test = test & ~F.col(href).contains(part)
    url = url_join(base, href)
    return links.filter(test).withColumn("url", url).withColumn(
        "target", basename(F.parse_url(F.col("url"), F.lit("PATH"))))


def manifest_files(status: DataFrame, c: str = "value", job: str = "metacurrentdump") -> DataFrame:
    """A status document (JSON text) as rows: job status, file, url, sha1, size."""
    meta = T.StructType.fromDDL("url string, sha1 string, size long")
    jobs = T.MapType(T.StringType(), T.StructType([
        T.StructField("status", T.StringType()),
        T.StructField("files", T.MapType(T.StringType(), meta)),
    ]))
    doc = F.from_json(c, T.StructType([T.StructField("jobs", jobs)]))
    one = doc["jobs"][job]
    return (status.select(one["status"].alias("job_status"), F.explode(one["files"]).alias("file", "meta"))
            .select("job_status", "file", "meta.url", "meta.sha1", "meta.size"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(file, sha1_local) of every file; a file larger than a row can hold (2 GB) fails loudly rather than being skipped."""
    return (spark.read.format("binaryFile").load(path)
            .select(basename("path").alias("file"), F.sha1("content").alias("sha1_local")))


def reconcile(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Missing, Corrupt or Exists per manifest entry, and whether to fetch it."""
    joined = manifest.join(files, "file", "left")
    state = (F.when(F.col("sha1_local").isNull(), "Missing")
             .when(~F.col("sha1_local").eqNullSafe(F.col("sha1")), "Corrupt")
             .otherwise("Exists"))
    return (joined.withColumn("status", state)
            .select("file", "status", (F.col("status") != "Exists").alias("should_download")))
