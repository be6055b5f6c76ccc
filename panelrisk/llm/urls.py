"""URL filter: given rules first, then the reputation of the host by empirical Bayes. DataFrame functions only."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelrisk.llm.scratch import Scratch
from panelrisk.operators.joining import lookup_join

# Verdict, host and path of the rules of the registered query.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Public suffixes of two labels that are told apart from registered domains (a parameter).
TWO_LABELS = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.kr", "co.in", "com.cn", "com.mx")
LIMIT = 0.5  # share of bad pages that must be exceeded
SURE = 1.645  # standard deviations between the mean of the posterior and its bound
WEAKEST, STRONGEST = 1.0, 1000.0  # least and largest weight of a prior, in pages

LEVELS = ("host", "domain", "suffix")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty for null or without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Longest fitting rule (as host and path in one text) and its verdict; null without one.

    The rules are a short list that is tested rule by rule.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        name, verdict = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def domain_and_suffix(host: Column, two_labels: Sequence[str] = TWO_LABELS) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, without user and port.

    An address of numbers, and a host of one label, are their own domain and suffix.
    """
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    bare = F.regexp_replace(bare, "\\.+$", "")
    last = [F.substring_index(bare, ".", -k) for k in (1, 2, 3)]
    two = last[1].isin(*two_labels)
    whole = bare.rlike("^[0-9.]+$") | bare.startswith("[") | (F.instr(bare, ".") == 0)
    suffix = F.when(whole, bare).when(two, last[1]).otherwise(last[0])
    domain = F.when(whole, bare).when(two, last[2]).otherwise(last[1])
    return domain, suffix


def _weight(children: DataFrame) -> DataFrame:
    """Weight of the prior of one level, one row: from the variance between children of one parent.

    ``children`` holds n, bad and the n, bad of the parent (pn, pbad). The share of
    variance between children (analysis of variance of 0/1 outcomes) gives the
    weight, kept within its bounds; without two children of one parent it is the
    weakest one.
    """
    p, mean = F.try_divide("bad", "n"), F.try_divide("pbad", "pn")
    sums = children.where("n > 0").agg(
        F.sum(F.col("n") * (p - mean) * (p - mean)).alias("between"),
        F.sum(F.col("n") * p * (1 - p)).alias("within"),
        F.sum("n").cast("double").alias("pages"),
        F.count(F.lit(1)).cast("double").alias("children"),
        F.sum(F.try_divide("n", "pn")).alias("parents"),
        F.sum(F.col("n") * F.try_divide("n", "pn")).alias("squares"),
    )
    freedom = F.col("children") - F.col("parents")
    between = F.try_divide("between", freedom)
    within = F.coalesce(F.try_divide("within", F.col("pages") - F.col("children")), F.lit(0.0))
    size = F.try_divide(F.col("pages") - F.col("squares"), freedom)
    share = F.try_divide(between - within, between + (size - 1) * within)
    # parents is a sum of shares: one per parent up to rounding
    weight = F.when(freedom < 0.5, WEAKEST).when(share <= 0, STRONGEST).otherwise(F.try_divide(F.lit(1.0), share) - 1)
    return sums.select(F.coalesce(F.least(F.greatest(weight, F.lit(WEAKEST)), F.lit(STRONGEST)), F.lit(WEAKEST)).alias("weight"))


def host_bounds(counts: DataFrame, sure: float = SURE) -> DataFrame:
    """Posterior of the share of bad pages of every host (host, labelled, bad_rate, bound).

    ``counts`` holds host, n labelled pages and bad ones. Rates are shrunk from all
    pages to suffix, from suffix to domain and from domain to host by beta priors whose
    weights come from the data. The bound is ``sure`` deviations below the mean.
    """
    store = Scratch(counts.sparkSession, "urls")
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = store.write(counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")

    def summed(rows, *keys):
        return rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    domains = store.write(summed(hosts, "domain", "suffix"), "domains")
    suffixes = store.write(summed(domains, "suffix"), "suffixes")
    everything = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()

    def under(children, parents, keys):
        return lookup_join(children, parents.select(*keys, F.col("n").alias("pn"), F.col("bad").alias("pbad")), keys)

    weights = [
        _weight(rows).first()["weight"] for rows in (
            suffixes.withColumns({"pn": F.lit(everything["n"]), "pbad": F.lit(everything["bad"])}),
            under(domains, suffixes, ["suffix"]),
            under(hosts.drop("suffix"), summed(domains, "domain"), ["domain"]))]
    prior = F.lit((everything["bad"] + 1.0) / (everything["n"] + 2.0))
    shrunk = suffixes.select("suffix", ((F.col("bad") + weights[0] * prior) / (F.col("n") + weights[0])).alias("prior"))
    for rows, key, parent, weight in ((domains, "domain", "suffix", weights[1]), (hosts, "host", "domain", weights[2])):
        keep = [key, "n", "bad", parent] if key == "domain" else [key, "n", "bad", parent, "suffix"]
        on = [parent] if key == "domain" else ["domain", "suffix"]
        a = F.col("bad") + weight * F.col("prior")
        b = F.col("n") - F.col("bad") + weight * (1 - F.col("prior"))
        shrunk = lookup_join(rows.select(*keep), shrunk, on)
        if key == "domain":
            shrunk = shrunk.select("domain", "suffix", (a / (a + b)).alias("prior"))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return shrunk.select(
        "host", F.col("n").alias("labelled"), (a / (a + b)).alias("bad_rate"), (a / (a + b) - sure * spread).alias("bound"))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, outcomes: DataFrame | None = None, limit: float = LIMIT
) -> DataFrame:
    """Verdict on every URL: the longest fitting rule, else the reputation of its host.

    ``outcomes`` holds labelled pages (url, bad boolean). Without it, the pages a rule
    decides are the labelled ones. A host is blocked where the lower bound of its
    share of bad pages exceeds ``limit``; a host without labelled pages is judged by
    its domain, suffix and all pages. Null URLs and those without ``://`` have the
    empty host; repeated rows are judged row by row; an empty table gives no row;
    other columns do not matter.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("ruled"))
    if outcomes is None:
        labelled = rows.select("host", F.col("ruled").isNotNull().alias("known"), (F.col("ruled") == "block").alias("bad"))
    else:
        other = outcomes.select(host_and_path(F.col("url"))[0].alias("host"), F.lit(True).alias("known"), "bad")
        unknown = rows.select("host", F.lit(False).alias("known"), F.lit(False).alias("bad"))
        labelled = unknown.unionByName(other)
    counts = labelled.groupBy("host").agg(
        F.sum(F.col("known").cast("long")).alias("n"),
        F.sum(F.coalesce(F.col("bad") & F.col("known"), F.lit(False)).cast("long")).alias("bad"))
    bounds = host_bounds(counts)
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return lookup_join(rows, bounds, ["host"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "labelled")
