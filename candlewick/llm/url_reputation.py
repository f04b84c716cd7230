"""URL filters: empirical-Bayes reputation of hosts, and exceptions by rule.

Labelled page outcomes are counted per host, registered domain and suffix.
Each level's good share has a beta prior around its parent's posterior mean;
the prior's strength is fitted to the spread between the level's own groups
(method of moments of the beta-binomial).  A host passes if a lower bound of
its posterior reaches ``min_good``.  The tables of counts have one row per
host at most; pages are touched twice, for counting and for the verdict.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import written

#: (verdict, rule); a rule is host/path
Rule = tuple[str, str]
#: strength of a prior (in pages): fitted, within these bounds
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    return F.coalesce(F.get(F.split(url, "://", 2), F.lit(1)), F.lit(""))


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path
    starts the url's path, as ``struct<rule, verdict>`` or NULL.  ``rules`` is a
    short list of exceptions; of equal ones ``block`` wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        own, _, tail = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + tail)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def domain_levels(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """``(registered domain, suffix)``: the suffix is the last label, or the longest
    of ``suffixes`` (such as ``co.uk``) that ends the host; the domain has one label more."""
    suffix = F.substring_index(host, ".", -1)
    labels = F.lit(1)
    for s in sorted(suffixes, key=len):
        ends = (host == s) | host.endswith("." + s)
        suffix, labels = F.when(ends, F.lit(s)).otherwise(suffix), F.when(ends, F.lit(s.count(".") + 1)).otherwise(labels)
    parts = F.split(host, r"\.")
    size = F.size(parts)
    domain = F.array_join(F.slice(parts, F.greatest(F.lit(1), size - labels), F.least(size, labels + 1)), ".")
    return domain, suffix


def _strength(groups: DataFrame) -> Column:
    """One value: the beta prior's pseudo-count from groups ``(n, k)``."""
    sums = groups.agg(F.sum("n").alias("N"), F.sum("k").alias("K"), F.sum(F.col("n") * F.col("n")).alias("Q"),
                      F.sum(F.when(F.col("n") > 0, F.col("k") * F.col("k") / F.col("n"))).alias("R"),
                      F.count_if(F.col("n") > 0).alias("G"))
    total, good = F.col("N").cast("double"), F.col("K").cast("double")
    share = F.try_divide(good, total)
    spread = F.try_divide(F.col("R") - total * share * share, share * (1 - share))
    extra = total - F.try_divide(F.col("Q").cast("double"), total) - (F.col("G") - 1)
    rho = F.try_divide(spread - (F.col("G") - 1), F.when(extra > 0, extra))
    low, high = 1 / (MOST_STRENGTH + 1), 1 / (LEAST_STRENGTH + 1)
    rho = F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(rho, F.lit(high))))
    return sums.select((1 / rho - 1).alias("strength")).scalar()


def host_reputation(outcomes: DataFrame, *, suffixes: Sequence[str] = (), z: float = 1.645) -> DataFrame:
    """``(host, n, k, good_share, good_bound)`` from ``outcomes(host, good int)``, a row
    per page; ``good`` is 1, 0, or NULL where the page has no label.

    ``good_share`` is the posterior mean, ``good_bound`` that less ``z``
    posterior deviations.  Hosts without labels have their domain's prior;
    without any label the prior is one half."""
    domain, suffix = domain_levels(F.col("host"), suffixes)
    counted = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    hosts = written(counted.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    total = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = total(hosts, "suffix", "domain")
    tops = total(domains, "suffix")
    base = tops.agg(((F.sum("k") + 0.5) / (F.sum("n") + 1)).alias("prior")).scalar()

    def posterior(groups, out):
        strength = _strength(groups)
        return groups.withColumn(out, (strength * F.col("prior") + F.col("k")) / (strength + F.col("n")))

    tops = posterior(tops.withColumn("prior", base), "top_share")
    domains = posterior(domains.join(tops.select("suffix", F.col("top_share").alias("prior")), "suffix"),
                        "domain_share")
    known = hosts.join(domains.select("domain", "suffix", F.col("domain_share").alias("prior")),
                       ["domain", "suffix"]).withColumn("strength", _strength(hosts))
    whole = F.col("strength") + F.col("n")
    share = (F.col("strength") * F.col("prior") + F.col("k")) / whole
    deviation = F.sqrt(share * (1 - share) / (whole + 1))
    return known.select("host", "n", "k", share.alias("good_share"), (share - z * deviation).alias("good_bound"))


def judge_urls(pages: DataFrame, labels: DataFrame, *, rules: Sequence[Rule] = (), suffixes: Sequence[str] = (),
               min_good: float = 0.6, z: float = 1.645, good: Column | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict, labelled, good_share, good_bound)`` per page.

    The outcome of a page is ``good`` (default: ``quality``) of the rows of
    ``labels(doc_id, ...)`` with its page_id; each label counts once.
    ``verdict`` is the longest matching rule's, else ``allow`` if the host's
    ``good_bound`` is at least ``min_good``, else ``block``.  A NULL url or one
    without ``://`` has empty host and path and the reputation of all such
    pages.  Rows with a NULL page_id are judged like any other; repeated rows
    are judged and counted each; other columns are not read."""
    known = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    marks = labels.select(F.col("doc_id").alias("page_id"),
                          (F.col("quality") if good is None else good).cast("int").alias("good"))
    hosts = host_reputation(known.join(marks, "page_id", "left").select("host", "good"), suffixes=suffixes, z=z)
    judged = known.join(hosts, "host").withColumn("_r", matching_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("good_bound") >= min_good, F.lit("allow")).otherwise(F.lit("block"))
    return judged.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                         F.coalesce(F.col("_r.verdict"), own).alias("verdict"), F.col("n").alias("labelled"),
                         "good_share", "good_bound")
