"""Article, redirect, template and link tables from page dumps."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.scalar import after_prefix, strip

# fixed values: name spaces and the infobox name prefix
NS_ARTICLE, NS_TEMPLATE = 0, 10
INFOBOX = "Infobox "
# fixed values: start of a template (not of a triple-brace parameter) and of a link
TEMPLATE_PATTERN = r"(?<!\{)\{\{(?!\{)([^{}|]*)"
LINK_PATTERN = r"\[\[([^\]|#]*)"
COMMENT_PATTERN = r"(?s)<!--.*?-->"


def page_kind() -> Column:
    """template, redirect, article, or null for every other name space."""
    return (F.when(F.col("ns") == NS_TEMPLATE, "template")
            .when((F.col("ns") == NS_ARTICLE) & F.col("redirect").isNotNull(), "redirect")
            .when(F.col("ns") == NS_ARTICLE, "article"))


def route_pages(pages: DataFrame) -> dict[str, DataFrame]:
    good = pages.filter(~F.col("damaged")) if "damaged" in pages.columns else pages
    kind = page_kind()
    return {
        "article": good.filter(kind == "article").select(F.col("id").alias("article_id"), "title", "text", "file"),
        "redirect": good.filter(kind == "redirect").select(F.col("id").alias("article_id"), "title", "redirect"),
        "template": good.filter(kind == "template").select(F.col("id").alias("article_id"), "title"),
    }


def template_names(text: str) -> Column:
    """Trimmed names of all templates of a text in order, nested ones too; no parser functions."""
    plain = F.regexp_replace(text, COMMENT_PATTERN, "")
    names = F.transform(F.regexp_extract_all(plain, F.lit(TEMPLATE_PATTERN), F.lit(1)), strip)
    return F.filter(names, lambda n: (n != "") & ~n.startswith("#"))


def link_names(text: str) -> Column:
    names = F.transform(F.regexp_extract_all(text, F.lit(LINK_PATTERN), F.lit(1)), strip)
    return F.filter(names, lambda n: n != "")


def article_templates(articles: DataFrame) -> DataFrame:
    """(article_id, template_name), each template once per article."""
    return articles.select("article_id", F.explode(F.array_distinct(template_names("text"))).alias("template_name"))


def article_links(articles: DataFrame) -> DataFrame:
    """(source_article_id, target_article_name), each target once per article."""
    return articles.select(F.col("article_id").alias("source_article_id"),
                           F.explode(F.array_distinct(link_names("text"))).alias("target_article_name"))


def infobox_column(text: str = "text") -> Column:
    """No infobox: empty; one: its name; several: the list as text."""
    boxes = F.filter(template_names(text), lambda n: n.startswith(INFOBOX))
    names = F.transform(boxes, lambda n: after_prefix(n, INFOBOX))
    listed = F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
    return F.when(F.size(names) > 1, listed).otherwise(F.coalesce(F.get(names, F.lit(0)), F.lit("")))


def article_infobox(articles: DataFrame) -> DataFrame:
    return articles.select("article_id", infobox_column().alias("infobox"))


def article_index(articles: DataFrame) -> DataFrame:
    """(article_id, title, infobox, file) in one pass; nothing has to be joined."""
    return articles.select("article_id", "title", infobox_column().alias("infobox"), "file")


def wiki_tables(pages: DataFrame) -> dict[str, DataFrame]:
    routed = route_pages(pages)
    articles = routed["article"]
    return {
        "article": article_index(articles),
        "articleTemplate": article_templates(articles),
        "articleLink": article_links(articles),
        "redirect": routed["redirect"],
        "template": routed["template"],
    }


def dump_stats(pages: DataFrame) -> DataFrame:
    """Counters of a dump; damaged pages are counted and otherwise skipped."""
    kind = F.when(~F.col("damaged"), page_kind()) if "damaged" in pages.columns else page_kind()
    damaged = F.count_if("damaged") if "damaged" in pages.columns else F.lit(0).cast("long")
    return pages.agg(
        F.count("*").alias("total"), F.count_if(kind == "article").alias("articles"),
        F.count_if(kind == "redirect").alias("redirects"), F.count_if(kind == "template").alias("templates"),
        damaged.alias("damaged"))


def infobox_titles(articles: DataFrame) -> DataFrame:
    return articles.filter(F.col("text").contains("{{" + INFOBOX.strip())).select("title")


Handler = Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]]


def extract(pages: DataFrame, handler: Handler) -> dict[str, DataFrame]:
    """Run a caller's handler: it gets the routed frames and returns its output tables."""
    return dict(handler(route_pages(pages)))
