"""URL filter: explicit rules first, then the reputation of the host by empirical Bayes.

Labelled page outcomes are counted by host, registered domain and suffix. Each level's rate is shrunk towards the
level above through a beta-binomial prior, whose strength is fitted to how much the groups of that level differ
(method of moments on the intra-class correlation): suffixes towards the rate over all pages, registered domains
towards their suffix, hosts towards their registered domain. A host is blocked if the lower bound of its posterior
bad rate lies above the threshold, so little evidence never blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmgrid.llm.common import lower_ascii
from filmgrid.session import written

#: block a host if its bad rate is above this ...
MAX_BAD_RATE = 0.5
#: ... with this many standard deviations of the posterior in between (95 % one-sided)
DEVIATIONS = 1.645
#: bounds of the fitted correlation inside a group; prior strength is 1 / correlation - 1 pages, so 10 to 999
CORRELATION = (0.001, 1 / 11)
#: the rate over all pages is itself shrunk to a half by so many pages
BASE_PAGES = 10


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path as in the contract of the query; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. The suffix is the last label, the domain the last two; a port is left out."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    return F.substring_index(name, ".", -2), F.substring_index(name, ".", -1)


def _strength(groups: DataFrame) -> DataFrame:
    """One row ``c``: prior strength fitted to groups ``(n, k, prior)``."""
    rate = F.col("k") / F.col("n")
    noise = F.col("prior") * (1 - F.col("prior"))
    excess = F.sum(F.col("n") * (rate - F.col("prior")) * (rate - F.col("prior"))) - F.sum(noise)
    possible = F.sum(noise * (F.col("n") - 1))
    fitted = F.when(possible > 0, excess / possible).otherwise(CORRELATION[1])
    fitted = F.least(F.greatest(fitted, F.lit(CORRELATION[0])), F.lit(CORRELATION[1]))
    return groups.agg((1 / fitted - 1).alias("c"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Adds ``alpha`` and ``beta`` of the posterior and its mean ``rate``."""
    c = _strength(groups.where("n > 0")).scalar()
    with_c = groups.withColumn("c", c)
    alpha, beta = F.col("k") + F.col("c") * F.col("prior"), F.col("n") - F.col("k") + F.col("c") * (1 - F.col("prior"))
    return with_c.withColumns({"alpha": alpha, "beta": beta}).withColumn("rate", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def host_reputation(outcomes: DataFrame, max_bad_rate: float = MAX_BAD_RATE, deviations: float = DEVIATIONS) -> DataFrame:
    """``(host, n, k, rate, lower, verdict)`` from pages ``(host, bad)``; ``bad`` null means unlabelled.

    Hosts without a labelled page take the rate of their registered domain, or of their suffix. Without any label the
    rate is a half everywhere and no host is blocked. Null hosts count as the empty host.
    """
    bad = F.col("bad").cast("int")
    hosts = outcomes.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(bad), F.lit(0)).alias("k")
    )
    domain, suffix = host_levels(F.col("host"))
    # written, since every level and every strength looks at it again: the pages are counted once
    hosts = written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    base = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + BASE_PAGES / 2) / (F.coalesce(F.sum("n"), F.lit(0)) + BASE_PAGES)).alias("m")).scalar()
    suffixes = _shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("prior", base))
    domains = hosts.groupBy("suffix", "domain").agg(*counts).join(suffixes.select("suffix", F.col("rate").alias("prior")), "suffix")
    domains = _shrunk(domains)
    hosts = _shrunk(hosts.join(domains.select("domain", "suffix", F.col("rate").alias("prior")), ["domain", "suffix"]))
    total = F.col("alpha") + F.col("beta")
    spread = F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1)))
    lower = F.greatest(F.lit(0.0), F.col("rate") - deviations * spread)
    verdict = F.when(F.col("lower") > max_bad_rate, "block").otherwise("allow")
    return hosts.withColumn("lower", lower).select("host", "n", "k", "rate", "lower", verdict.alias("verdict"))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, rules)``: all rules ``(rule_host, rule_path, action)`` of a host and of the domains above it, longest first."""
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    above = hosts.select("host", F.explode(ends).alias("rule_host"))
    entry = F.struct(
        (-F.length(F.concat("rule_host", "rule_path"))).alias("order"), F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "action"
    )
    return above.join(rules, "rule_host").groupBy("host").agg(F.array_sort(F.collect_list(entry)).alias("rules"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` for every row of ``pages (page_id, url)``.

    ``labels (page_id, bad)`` may lack pages, repeat them (any bad outcome counts) and hold nulls (no outcome). A rule
    ``(host, path, action)`` fits its host and all subdomains where the path starts with the rule's; the longest rule
    wins, and of equally long ones the first in the order of the text. Pages without a rule get their host's verdict.
    Repeated pages give repeated rows; a null url has an empty host and path and the empty host's verdict. No pages give
    an empty result, no labels let every host's verdict rest on no outcomes. Other columns are not looked at.
    """
    if not isinstance(rules, DataFrame):
        rules = pages.sparkSession.createDataFrame([tuple(r) for r in rules], "rule_host string, rule_path string, action string")
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    outcomes = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    reputation = host_reputation(parsed.select("page_id", "host").join(outcomes, "page_id", "left").select("host", "bad"))
    known = reputation.select("host", F.col("verdict").alias("by_host"))
    known = known.join(rules_by_host(known.select("host"), rules), "host", "left")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    # one row for each host: the join neither drops nor repeats pages, and a frequent host can be split
    judged = parsed.join(known, "host", "left").withColumn("first", F.get(fitting, F.lit(0)))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("first.rule").alias("rule"),
        F.coalesce("first.action", "by_host").alias("verdict"),
    )
