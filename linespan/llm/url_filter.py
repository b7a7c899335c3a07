"""URL rules and empirical-Bayes host reputation.

Rules name a host and the start of a path; the longest rule that fits a url
decides. Other urls are judged by the reputation of their host. Labelled page
outcomes are counted per host. A beta-binomial prior passes from the suffix to
the registered domain to the host: each level's mean is shrunk to that of the
level above, with a strength estimated from how much the counts at that level
spread, and always from the labels of the other units, so that no label counts
twice. A host is blocked when the lower bound of its posterior share of bad
pages (mean less ``z`` standard deviations of the beta posterior) is above
``limit``. Hosts without labels take their domain's or suffix's share as prior.

Null urls and urls without ``://`` have an empty host and path; they fall
under no rule and are judged like any unlabelled host. Labels that contradict
each other count as bad. Repeated rows are judged each for itself. Empty
tables give no rows, and without labels nothing is blocked. Only the named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linespan.llm.common import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Verdict, host and path of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Second-level names under which countries register domains.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

BLOCK_LIMIT = 0.5
BOUND_Z = 1.645
# Correlation of labels within a level stays in this range.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.5


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules) -> Column:
    """The longest rule that fits, as struct(length, rule, verdict); else null.

    ``rules`` is a list the caller writes; it is part of the plan.
    """
    fits = [
        F.when(
            ((host == name) | host.endswith(f".{name}")) & path.startswith(start),
            F.struct(
                F.lit(len(name) + len(start)).alias("length"),
                F.lit(name + start).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for verdict, name, start in rules
    ]
    return F.array_max(F.array(*fits))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host, or three under a country's second level."""
    labels = F.split(host, "\\.")
    count = F.size(labels)
    country = (F.length(F.element_at(labels, -1)) == 2) & F.element_at(labels, -2).isin(*SECOND_LEVEL)
    return (
        F.when(count <= 2, host)
        .when(country, F.array_join(F.slice(labels, -3, 3), "."))
        .otherwise(F.array_join(F.slice(labels, -2, 2), "."))
    )


def suffix_of(domain: Column) -> Column:
    return F.regexp_replace(domain, "^[^.]*\\.", "")


def strength(counts: DataFrame, mean: str) -> float:
    """Pseudo-labels the prior of a level is worth.

    Moments of the beta-binomial: the squared deviations of the counts from
    their expectation exceed the binomial variance by a share that gives the
    correlation of labels within a unit. One number comes back to the driver.
    """
    n, bad, m = F.col("labelled"), F.col("bad"), F.col(mean)
    variance = m * (1 - m)
    sums = counts.agg(
        F.sum(F.pow(bad - n * m, 2) - n * variance).alias("surplus"),
        F.sum(n * (n - 1) * variance).alias("room"),
    ).first()
    spread = sums["surplus"] / sums["room"] if sums["room"] else LEAST_SPREAD
    bounded = max(LEAST_SPREAD, min(MOST_SPREAD, spread))
    return (1 - bounded) / bounded


def prior_without_own(whole: str, above: str, worth: float) -> Column:
    """Posterior mean of a level for one of its units, from the labels of all the others."""
    labelled = F.col(f"{whole}_labelled") - F.col("labelled")
    bad = F.col(f"{whole}_bad") - F.col("bad")
    return (bad + worth * F.col(above)) / (labelled + worth)


def host_reputation(hosts: DataFrame, *, z: float = BOUND_Z) -> DataFrame:
    """Return host, posterior mean, and its lower bound. ``hosts``: host, labelled, bad.

    A unit's prior leaves out the unit's own labels, which count once, in its posterior.
    """
    named = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn(
        "suffix", suffix_of(F.col("domain"))
    )
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    domains = settle(named.groupBy("suffix", "domain").agg(*sums), "url-domains")
    total = domains.agg(*sums).first()
    overall = ((total["bad"] or 0) + 1.0) / ((total["labelled"] or 0) + 2.0)
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("overall", F.lit(overall))
    suffix_worth = strength(suffixes, "overall")
    of_domain = domains.join(
        suffixes.select("suffix", "overall", F.col("labelled").alias("suffix_labelled"), F.col("bad").alias("suffix_bad")),
        "suffix",
    ).withColumn("domain_prior", prior_without_own("suffix", "overall", suffix_worth))
    domain_worth = strength(of_domain, "domain_prior")
    of_host = named.join(
        of_domain.select(
            "domain", "domain_prior", F.col("labelled").alias("domain_labelled"), F.col("bad").alias("domain_bad")
        ),
        "domain",
    ).withColumn("host_prior", prior_without_own("domain", "domain_prior", domain_worth))
    worth = strength(of_host, "host_prior")
    share = (F.col("bad") + worth * F.col("host_prior")) / (F.col("labelled") + worth)
    deviation = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("labelled") + worth + 1))
    return of_host.withColumn("share", share).select(
        "host", "labelled", "share", (F.col("share") - z * deviation).alias("bound")
    )


def judged(
    pages: DataFrame, outcomes: DataFrame, *, key: str = "page_id", url: str = "url", rules=RULES,
    limit: float = BLOCK_LIMIT, z: float = BOUND_Z,
) -> DataFrame:
    """Return key, host, path, rule, verdict, share and bound per page.

    ``outcomes``: page key and ``bad`` (0 or 1), any number of rows a page.
    """
    address = F.col(f"`{url}`")
    parts = settle(
        pages.select(F.col(f"`{key}`").alias("page_key"), host_of(address).alias("host"), path_of(address).alias("path")),
        "url-parts",
    )
    known = outcomes.where("bad IS NOT NULL").groupBy(F.col(f"`{key}`").alias("page_key")).agg(F.max("bad").alias("bad"))
    hosts = (
        parts.join(known, "page_key", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    )
    reputation = host_reputation(settle(hosts, "url-hosts"), z=z)
    # The rules are matched before the join; null rules leave the host's verdict.
    rated = parts.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules)).join(
        reputation, "host", "left"
    )
    own = F.when(F.col("bound") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return rated.select(
        F.col("page_key").alias(key), "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), own).alias("verdict"), "share", "bound",
    )
