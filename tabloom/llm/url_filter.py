"""URL verdicts: longest rules first, then an empirical-Bayes reputation of hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import join_per_key
from tabloom.session import written

#: Prior strengths (pseudo counts): least and largest, and the one of a level that shows nothing.
LEAST_STRENGTH, MOST_STRENGTH, DEFAULT_STRENGTH = 1.0, 10_000.0, 10.0
#: Standard deviations between the posterior mean and its bound, and the share of bad pages that the bound may not exceed.
Z, LIMIT = 1.645, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host without user, port and closing dot."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r"\.?(:[0-9]*)?$", "")


def domain_of(site: Column, two_part: Sequence[str] = ()) -> Column:
    """Registered domain: the last two labels, three where the last two are a public suffix in ``two_part``.
    An address of digits is its own domain."""
    last = lambda n: F.substring_index(site, ".", -n)
    named = F.when(last(2).isin(list(two_part)), last(3)).otherwise(last(2)) if two_part else last(2)
    return F.when(site.rlike(r"(^|\.)[0-9]+$"), site).otherwise(named)


def suffix_of(domain: Column) -> Column:
    """The domain without its first label; empty for a domain of one label or an address."""
    whole = domain.rlike(r"(^|\.)[0-9]+$") | (F.instr(domain, ".") == 0)
    return F.when(whole, F.lit("")).otherwise(F.regexp_replace(domain, r"^[^.]*\.", ""))


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, pages, rules): a host with the rules of itself and the domains it belongs to, the longest first."""
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    met = hosts.select("host", F.explode(ends).alias("rule_host")).join(rules, "rule_host")
    own = F.struct((-F.length("rule")).alias("size"), "rule", "rule_path", "rule_verdict")
    return hosts.join(met.groupBy("host").agg(F.sort_array(F.collect_set(own)).alias("rules")), "host", "left")


def _strength(groups: DataFrame, parent: str) -> float:
    """Pseudo counts of a beta prior, from how much the shares of the groups differ around that of their parents.

    The usual estimate from an analysis of variance: squares between groups of one parent against squares inside groups.
    """
    own = groups.groupBy(parent).agg(F.count("*").alias("k"), F.sum("n").alias("nn"), F.sum("bad").alias("bb"), F.sum(F.col("n") * F.col("n")).alias("n2"),
                                     F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"))
    s = own.agg(F.sum(F.col("k")).alias("k"), F.count("*").alias("p"), F.sum("nn").alias("n"), F.sum("bb").alias("bad"),
                F.sum(F.col("n2") / F.col("nn")).alias("sizes"), F.sum("q").alias("q"), F.sum(F.col("bb") * F.col("bb") / F.col("nn")).alias("parents")).first()
    if not s["n"] or s["k"] <= s["p"] or s["n"] <= s["k"]:
        return DEFAULT_STRENGTH
    between, inside = (s["q"] - s["parents"]) / (s["k"] - s["p"]), (s["bad"] - s["q"]) / (s["n"] - s["k"])
    size = (s["n"] - s["sizes"]) / (s["k"] - s["p"])
    whole = between + (size - 1) * inside
    if whole <= 0:
        return DEFAULT_STRENGTH
    alike = (between - inside) / whole
    return MOST_STRENGTH if alike <= 0 else min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / alike - 1))


def reputation(counts: DataFrame, two_part: Sequence[str] = (), z: float = Z) -> DataFrame:
    """Add ``bad_share`` and ``bound`` to hosts with counts (host, n, bad) of labelled pages; other columns stay.

    The share of bad pages of a suffix is drawn to that of all pages, of a registered domain to its suffix's, of a host to its
    domain's, each time without the pages of the group itself. How strongly is estimated on each level from the differences between its groups. ``bad_share`` is the posterior mean
    of the host, ``bound`` is ``z`` standard deviations below it (not below 0). A host without labelled pages has its
    domain's share, a table without any 0.5.
    """
    domain = domain_of(site_of(F.col("host")), two_part)
    placed = counts.withColumn("domain", domain).withColumn("suffix", suffix_of(F.col("domain")))
    seen = written(placed.filter("n > 0").groupBy("suffix", "domain", "host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "host-counts")
    total = lambda *by: seen.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    base = (whole["bad"] + 0.5) / (whole["n"] + 1)
    by_suffix, by_domain = total("suffix"), total("suffix", "domain")
    m0 = _strength(by_suffix.withColumn("root", F.lit(0)), "root")
    m1, m2 = _strength(by_domain, "suffix"), _strength(seen, "domain")
    suffixes = by_suffix.select("suffix", F.col("n").alias("n_s"), F.col("bad").alias("bad_s"))
    domains = by_domain.select("domain", F.col("n").alias("n_d"), F.col("bad").alias("bad_d"))
    near = placed.join(domains, "domain", "left").join(suffixes, "suffix", "left").na.fill(0, ["n_s", "bad_s", "n_d", "bad_d"])
    # what a group learns from the one above comes from the other groups there: its own pages count once
    of_suffix = (F.col("bad_s") - F.col("bad_d") + m0 * base) / (F.col("n_s") - F.col("n_d") + m0)
    prior = (F.col("bad_d") - F.col("bad") + m1 * of_suffix) / (F.col("n_d") - F.col("n") + m1)
    a, b = F.col("bad") + m2 * prior, F.col("n") - F.col("bad") + m2 * (1 - prior)
    mean = a / (a + b)
    spread = F.sqrt(mean * (1 - mean) / (a + b + 1))
    return near.select(*counts.columns, mean.alias("bad_share"), F.greatest(F.lit(0.0), mean - z * spread).alias("bound"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url", key: str = "page_id", outcomes: DataFrame | None = None,
                two_part: Sequence[str] = (), z: float = Z, limit: float = LIMIT) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict`` (allow or block), ``bad_share`` and ``bound`` to every page; input columns of
    these names are replaced, all others stay, whatever their names.

    A rule (verdict, host, path) fits its host and all subdomains if the page's path starts with the rule's; of several the
    longest (host and path together) holds, of equally long ones the first by name. Pages without a rule are judged by the reputation of their host: they
    are blocked if even the lower bound of its share of bad pages is above ``limit``. Labelled pages are those of ``outcomes``
    (``key``, ``bad``; one row per page, rows with nulls are left out), or without it the pages that a rule fits.

    A null url, or one without ``://``, has an empty host and path and is judged as a host of that name. Repeated rows are judged
    alike and stay; urls of any length are read whole; an empty table gives an empty one.
    """
    results = ["host", "path", "rule", "verdict", "bad_share", "bound"]
    if {url, key} & set(results):
        raise ValueError("url and key columns may not be named like the results")
    kept = [c for c in pages.columns if c not in results]
    # the input row is one struct from here on, so that no column of it meets one of these helpers
    parsed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
                          F.struct(host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")).alias("at"))
    listed = pages.sparkSession.createDataFrame([(h, p, v, h + p) for v, h, p in rules], "rule_host string, rule_path string, rule_verdict string, rule string")
    hosts = written(_host_rules(parsed.groupBy(F.col("at.host").alias("host")).agg(F.count("*").alias("pages")), listed), "host-rules")
    met = F.get(F.filter("rules", lambda r: F.startswith(F.col("at.path"), r["rule_path"])), F.lit(0)).alias("met")
    if outcomes is None:
        ruled = join_per_key(parsed.select("at"), hosts, F.col("at.host"), "host", "pages").select("host", met).filter("met is not null")
        labelled = ruled.select("host", (F.col("met.rule_verdict") == "block").alias("bad"))
    else:
        own = outcomes.select(F.col(f"`{key}`").alias("page"), F.col("bad").cast("boolean").alias("bad")).filter("bad is not null")
        labelled = parsed.join(own, F.col("row")[key] == F.col("page")).select("at.host", "bad")
    counts = labelled.groupBy("host").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    hosts = written(reputation(hosts.join(counts, "host", "left").na.fill(0, ["n", "bad"]), two_part, z), "host-reputation")
    by_host = F.when(F.col("bound") > limit, "block").otherwise("allow")
    judged = join_per_key(parsed, hosts, F.col("at.host"), "host", "pages").select("row", "at", met, by_host.alias("by_host"), "bad_share", "bound")
    return judged.select("row.*", "at.host", "at.path", F.col("met.rule").alias("rule"),
                         F.coalesce("met.rule_verdict", "by_host").alias("verdict"), "bad_share", "bound")
