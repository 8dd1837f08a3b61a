"""URL filter by empirical-Bayes host reputation.

A labelled page is a good or a bad outcome of its host.  Hosts have few labels,
so their rate is shrunk: suffixes towards the whole, registered domains towards
their suffix, hosts towards their domain, each level through a beta-binomial
prior whose concentration is estimated from all groups of that level by the
method of moments.  A page is kept if the lower bound of its host's posterior is
high enough; a host without labels has its domain's prior, and so on up.

Outcomes are summed by host once, into a written table; the three levels are
aggregates of it, and the three concentrations and the overall rate are one row.
The bound is the normal one, which is rough for hosts of fewer than about five
labels.

Defined results: a null URL or one without a host has null bounds and is not
kept; labels without a page, and null labels, count for nothing; a page with
several labels counts each, and a repeated page row counts its labels once more;
URLs of any length are read whole; without any label every host has the rate 1/2
and the widest prior.  Columns beyond those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from .exchange import cut

LEAST, Z = 0.5, 1.645
_MOST_RHO, _LEAST_RHO = 0.999, 0.0001


def _concentration(groups: DataFrame, name: str) -> DataFrame:
    """One row: the concentration of the prior that groups (n, s, centre) share."""
    sums = groups.agg(
        F.sum(F.pow(F.col("s") / F.col("n") - F.col("centre"), 2) * F.col("n") / (F.col("centre") * (1 - F.col("centre")))).alias("q"),
        F.count("*").alias("g"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
    )
    spare = F.col("n") - F.col("n2") / F.col("n") - (F.col("g") - 1)
    rho = F.when(spare > 0, (F.col("q") - (F.col("g") - 1)) / spare).otherwise(F.lit(_LEAST_RHO))
    rho = F.coalesce(F.least(F.greatest(rho, F.lit(_LEAST_RHO)), F.lit(_MOST_RHO)), F.lit(_LEAST_RHO))
    return sums.select(((1 - rho) / rho).alias(name))


def host_reputation(pages: DataFrame, labels: DataFrame, least: float = LEAST, z: float = Z, page_id: str = "page_id", label_id: str = "doc_id") -> DataFrame:
    """(page_id, host, domain, suffix, labelled, mean, lower, keep) of every page.

    A label is good if its quality is 1 and its toxic is 0.  Means and bounds are
    rounded to nine digits.
    """
    urls = pages.select(F.col(page_id).alias("page_id"), U.host(F.col("url")).alias("host"))
    good = ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("bigint")
    outcomes = labels.select(F.col(label_id).alias("page_id"), good.alias("good")).where("good IS NOT NULL")
    counts = urls.where("host IS NOT NULL").join(outcomes, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("s"))
    hosts = cut(counts.select("host", U.domain_of(F.col("host")).alias("domain"), U.public_suffix(F.col("host")).alias("suffix"), "n", "s"))
    whole = hosts.agg(((F.coalesce(F.sum("s"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("p0"))

    by_suffix = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).crossJoin(F.broadcast(whole)).withColumnRenamed("p0", "centre")
    by_suffix = cut(by_suffix)
    k0 = _concentration(by_suffix, "k0")
    of_suffix = cut(by_suffix.crossJoin(F.broadcast(k0)).select("suffix", ((F.col("s") + F.col("k0") * F.col("centre")) / (F.col("n") + F.col("k0"))).alias("suffix_mean")))

    by_domain = cut(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).join(of_suffix, "suffix").withColumnRenamed("suffix_mean", "centre"))
    k1 = _concentration(by_domain, "k1")
    of_domain = cut(by_domain.crossJoin(F.broadcast(k1)).select("domain", ((F.col("s") + F.col("k1") * F.col("centre")) / (F.col("n") + F.col("k1"))).alias("domain_mean")))

    by_host = hosts.join(of_domain, "domain").withColumnRenamed("domain_mean", "centre")
    k2 = _concentration(by_host, "k2")

    urls = urls.withColumns({"domain": U.domain_of(F.col("host")), "suffix": U.public_suffix(F.col("host"))})
    known = urls.join(hosts.select("host", "n", "s"), "host", "left").join(of_domain, "domain", "left").join(of_suffix, "suffix", "left")
    wide = known.crossJoin(F.broadcast(cut(whole.crossJoin(k2))))
    prior = F.coalesce("domain_mean", "suffix_mean", "p0")
    a = F.col("k2") * prior + F.coalesce("s", F.lit(0))
    b = F.col("k2") * (1 - prior) + F.coalesce("n", F.lit(0)) - F.coalesce("s", F.lit(0))
    some = F.col("host").isNotNull()
    mean = F.when(some, a / (a + b))
    lower = F.when(some, F.greatest(a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), F.lit(0.0)))
    return wide.select(
        "page_id", "host", "domain", "suffix", F.coalesce("n", F.lit(0)).cast("bigint").alias("labelled"), F.round(mean, 9).alias("mean"), F.round(lower, 9).alias("lower"), F.coalesce(F.round(lower, 9) >= least, F.lit(False)).alias("keep")
    )


def _k(groups: str, name: str) -> str:
    return f"""SELECT (1 - rho) / rho AS {name} FROM (SELECT coalesce(least(greatest(CASE WHEN n - n2 / n - (g - 1) > 0 THEN (q - (g - 1)) / (n - n2 / n - (g - 1)) ELSE {_LEAST_RHO} END, {_LEAST_RHO}), {_MOST_RHO}), {_LEAST_RHO}) AS rho
  FROM (SELECT sum(pow(s / n - centre, 2) * n / (centre * (1 - centre))) AS q, count(*) AS g, sum(n) AS n, sum(n * n) AS n2 FROM {groups}))"""


ORACLE = rf"""
WITH u AS (SELECT page_id, nullif(regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.+$', ''), '') AS host FROM pages),
urls AS (SELECT page_id, host, {U.sql_suffix("host")[1]} AS domain, {U.sql_suffix("host")[0]} AS suffix FROM u),
hosts AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END)::DOUBLE AS s FROM urls JOIN labels ON page_id = doc_id WHERE host IS NOT NULL AND (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY ALL),
whole AS (SELECT (coalesce(sum(s), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1) AS p0 FROM hosts),
by_suffix AS (SELECT suffix, sum(n) AS n, sum(s) AS s, any_value(p0) AS centre FROM hosts, whole GROUP BY suffix),
k0 AS ({_k("by_suffix", "k0")}),
of_suffix AS (SELECT suffix, (s + k0 * centre) / (n + k0) AS suffix_mean FROM by_suffix, k0),
by_domain AS (SELECT domain, suffix, sum(n) AS n, sum(s) AS s, any_value(suffix_mean) AS centre FROM hosts JOIN of_suffix USING (suffix) GROUP BY domain, suffix),
k1 AS ({_k("by_domain", "k1")}),
of_domain AS (SELECT domain, (s + k1 * centre) / (n + k1) AS domain_mean FROM by_domain, k1),
by_host AS (SELECT hosts.*, domain_mean AS centre FROM hosts JOIN of_domain USING (domain)),
k2 AS ({_k("by_host", "k2")}),
wide AS (SELECT urls.*, coalesce(n, 0) AS n, k2 * coalesce(domain_mean, suffix_mean, p0) + coalesce(s, 0) AS a, k2 * (1 - coalesce(domain_mean, suffix_mean, p0)) + coalesce(n, 0) - coalesce(s, 0) AS b
  FROM urls LEFT JOIN (SELECT host, n, s FROM hosts) h USING (host) LEFT JOIN of_domain USING (domain) LEFT JOIN of_suffix USING (suffix), whole, k2),
bound AS (SELECT page_id, host, domain, suffix, n::BIGINT AS labelled, CASE WHEN host IS NOT NULL THEN round(a / (a + b), 9) END AS mean,
  CASE WHEN host IS NOT NULL THEN round(greatest(a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0), 9) END AS lower FROM wide)
SELECT *, coalesce(lower >= {LEAST}, false) AS keep FROM bound
"""
