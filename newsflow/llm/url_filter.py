"""URL filters: explicit rules, else the host's reputation from labelled pages.

Reputation is empirical Bayes. Good and bad labelled pages are counted per host, registered domain and suffix. Each
level's rate is shrunk to the level above through a beta-binomial prior whose strength is fitted to that level's
spread (method of moments), and a page passes while the upper bound of its host's posterior rate of good pages
reaches a limit: hosts go only when the labels speak against them. Everything is DataFrame functions.

Defined cases: a null url, or one without ``://``, has an empty host and path, and the prior of all pages decides.
Labels that are null or lack a page count for nothing. Repeated pages count each time. Without any label every page
passes that no rule blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.tables import ascii_lower, materialize

Rule = tuple[str, str]  # verdict, host followed by the path prefix

# Suffixes of more than one label under which domains are registered; more can be passed in.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does. ``rules`` is a short, fixed list."""
    found = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, slash, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(slash + rule_path)
        found = F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found["rule"], found["verdict"]


def suffix_and_domain(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple[Column, Column]:
    """(suffix, registered domain) of a host; a port is ignored, and a host of one label is its own domain."""
    name = F.regexp_replace(host, r":\d*$", "")
    two, three = F.substring_index(name, ".", -2), F.substring_index(name, ".", -3)
    is_long = two.isin(*long_suffixes)
    return F.when(is_long, two).otherwise(F.substring_index(name, ".", -1)), F.when(is_long, three).otherwise(two)


def _strength(groups: DataFrame, prior: Column, least: float, most: float) -> DataFrame:
    """One row: pseudo-counts of a beta prior around ``prior`` that explain the spread of ``good / n`` over groups."""
    weight = prior * (1 - prior)
    spread = F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - prior, 2))
    expected = F.sum(weight)
    total = F.sum(F.col("n") * weight)
    rho = F.try_divide(spread - expected, total - expected)
    return groups.agg(
        F.coalesce(F.greatest(F.least(F.try_divide(F.lit(1.0), rho) - 1, F.lit(most)), F.lit(least)), F.lit(most)).alias("s"),
        (F.coalesce(rho, F.lit(0.0)) <= 0).alias("flat"),
    ).select(F.when(F.col("flat"), F.lit(most)).otherwise(F.col("s")).alias("s"))


def host_reputation(
    labelled: DataFrame, least: float = 2.0, most: float = 1000.0, z: float = 1.96
) -> tuple[DataFrame, DataFrame]:
    """From (host, suffix, domain, good) rows: (host, rate, lower, upper) per host, and one row (rate, lower, upper) for
    hosts without labels. Each level is stored before the next reads it. ``upper`` and ``lower`` are the posterior mean plus and minus ``z`` posterior deviations."""
    hosts = materialize(labelled.groupBy("suffix", "domain", "host").agg(F.count("*").alias("n"), F.sum("good").alias("good")), "hosts")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    # One pseudo-page of each outcome, so that the overall rate is defined without any label.
    overall = suffixes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("p"))

    def shrink(groups: DataFrame) -> DataFrame:
        s = _strength(groups, F.col("prior"), least, most).scalar()
        return groups.withColumn("s", s).withColumn("rate", (F.col("good") + F.col("s") * F.col("prior")) / (F.col("n") + F.col("s")))

    overall = materialize(overall, "overall")
    suffixes = materialize(shrink(suffixes.withColumn("prior", overall.scalar())).select("suffix", F.col("rate").alias("prior")), "suffixes")
    domains = materialize(shrink(domains.join(suffixes, "suffix")).select("suffix", "domain", F.col("rate").alias("prior")), "domains")
    hosts = materialize(shrink(hosts.join(domains, ["suffix", "domain"])), "hosts")

    def bounded(df: DataFrame, size: Column, *keep: str) -> DataFrame:
        sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
        return df.select(
            *keep, "rate", F.greatest(F.col("rate") - z * sd, F.lit(0.0)).alias("lower"), F.least(F.col("rate") + z * sd, F.lit(1.0)).alias("upper")
        )

    return (
        bounded(hosts, F.col("n") + F.col("s"), "host"),
        bounded(overall.withColumnRenamed("p", "rate"), F.lit(least)),
    )


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = (), min_rate: float = 0.8, **options: float
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict and the bounds of the host's rate of good pages.

    ``outcomes``: (page_id, good 0/1), one row per labelled page. ``options`` go to ``host_reputation``.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    suffix, domain = suffix_and_domain(F.col("host"))
    good = outcomes.filter("good IS NOT NULL").select("page_id", F.col("good").cast("int").alias("good"))
    labelled = judged.join(good, "page_id").select("host", suffix.alias("suffix"), domain.alias("domain"), "good")
    known, unknown = host_reputation(labelled, **options)
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    upper = F.coalesce(F.col("upper"), unknown.select("upper").scalar())
    return judged.join(known, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(upper >= min_rate, "allow").otherwise("block")).alias("verdict"),
        "rate",
        "lower",
        upper.alias("upper"),
    )
