"""URL filters: explicit rules, then empirical-Bayes host reputation.

A page's address names the document it was made from (the number that ends its
path), so a labelled document gives its page an outcome: bad if toxic or of low
quality.  Bad rates are shrunk level by level through beta-binomial priors: a
suffix towards all pages, a registered domain towards its suffix, a host towards
its domain.  The strength of each prior is estimated from the spread of the rates
below it (method of moments).  A host is blocked when the lower posterior bound
of its bad rate exceeds ``times`` the rate of all labelled pages, so when it is
credibly worse than the average; hosts without labels get their domain's prior.
DataFrame functions only; counts are partially aggregated, so a host with a third of
all pages costs one row for each task.

The registered domain is one label more than the suffix, which is the last label or
one of ``SUFFIXES``; an IP address is its own domain under an empty suffix.

Defined results: a null address, or one without ``://``, has an empty host and
path; an empty host is judged like any other; pages without a label, or with a
null in one of its two columns, say nothing; without any label every rate is 0 and
nothing is blocked but by a rule; repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the production rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Suffixes of several labels under which domains are registered.
SUFFIXES = tuple(
    "ac.at ac.cn ac.id ac.il ac.in ac.jp ac.kr ac.nz ac.th ac.uk ac.za asn.au co.at co.id co.il co.in co.jp co.ke co.kr co.nz co.th "
    "co.uk co.ve co.za com.ar com.au com.bd com.br com.cn com.co com.ec com.eg com.es com.gr com.hk com.mx com.my com.ng com.pe com.ph "
    "com.pk com.pl com.pt com.ro com.ru com.sa com.sg com.tr com.tw com.ua com.uy com.ve com.vn ed.jp edu.ar edu.au edu.br edu.cn "
    "edu.hk edu.mx edu.pl edu.sg edu.tr edu.tw firm.in gen.in gob.ar gob.mx go.id go.jp go.kr go.th gov.au gov.br gov.cn gov.hk gov.il "
    "gov.in gov.sg gov.tr gov.tw gov.uk gov.za govt.nz id.au ind.in iwi.nz ltd.uk me.uk mil.br ne.jp ne.kr net.ar net.au net.br net.cn "
    "net.hk net.il net.in net.nz net.pl net.tr net.tw net.uk net.za nhs.uk nom.br or.at or.id or.jp or.kr org.ar org.au org.br org.cn "
    "org.hk org.il org.in org.mx org.nz org.pl org.sg org.tr org.tw org.uk org.za plc.uk police.uk res.in sch.id sch.uk school.nz".split()
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_address(pages: DataFrame) -> DataFrame:
    """page_id, host and path of each page."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    return pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )


def rule_columns(rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def page_outcomes(addressed: DataFrame, labels: DataFrame) -> DataFrame:
    """host and bad (0 or 1) of every page whose document is labelled."""
    document = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    named = addressed.select("host", F.when(document != "", document.cast("long")).alias("doc_id")).where("doc_id is not null")
    toxic, quality = F.col("toxic").cast("int"), F.col("quality").cast("int")
    # greatest skips nulls, and half a label says nothing.
    bad = F.when(toxic.isNotNull() & quality.isNotNull(), F.greatest(toxic, 1 - quality))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad"))
    marked = marked.where("doc_id is not null and bad is not null")
    marked = marked.groupBy("doc_id").agg(F.max("bad").alias("bad"))
    return named.join(marked, "doc_id").select("host", "bad")


def levels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> list[Column]:
    """Suffix and registered domain of a host; of several suffixes the longest."""
    plain = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    suffix, domain = F.substring_index(plain, ".", -1), F.substring_index(plain, ".", -2)
    for labels in sorted({s.count(".") + 1 for s in suffixes}):
        told = F.substring_index(plain, ".", -labels)
        found = told.isin([s for s in suffixes if s.count(".") + 1 == labels])
        suffix = F.when(found, told).otherwise(suffix)
        domain = F.when(found, F.substring_index(plain, ".", -labels - 1)).otherwise(domain)
    address = plain.rlike(r"^([0-9.]+|\[.*)$")
    return [F.when(address, "").otherwise(suffix).alias("suffix"), F.when(address, plain).otherwise(domain).alias("domain")]


def _strength(counts: DataFrame) -> tuple[float, float]:
    """Mean rate and prior strength from the spread of the rows' rates."""
    n, bad, rows, square = counts.where("n > 0").agg(
        F.sum("n"), F.sum("bad"), F.count("*"), F.sum(F.col("bad") * F.col("bad") / F.col("n"))
    ).first()
    if not n or n <= rows:
        return (bad or 0) / n if n else 0.0, 1.0
    mean = bad / n
    noise = mean * (1 - mean)
    if not noise:
        return mean, 1.0
    spread = (square / n - mean * mean) - noise * rows / n
    shared = min(max(spread / (noise * (1 - rows / n)), 1e-4), 0.5)
    return mean, 1 / shared - 1


def host_reputation(addressed: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Per host: n, bad, rate (posterior mean), bound (lower posterior bound) and average
    (the rate of all labelled pages)."""
    counts = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = addressed.select("host").distinct().join(counts, "host", "left").na.fill(0, ["n", "bad"])
    hosts = hosts.select("host", "n", "bad", *levels(F.col("host")))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    mean, by_suffix = _strength(suffixes)
    _, by_domain = _strength(domains)
    _, by_host = _strength(hosts)

    def shrunk(prior: Column | float, strength: float) -> Column:
        return (F.col("bad") + strength * prior) / (F.col("n") + F.lit(strength))

    suffixes = suffixes.select("suffix", shrunk(F.lit(mean), by_suffix).alias("above"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", "suffix", shrunk(F.col("above"), by_domain).alias("prior")
    )
    rate = shrunk(F.col("prior"), by_host)
    deviation = F.sqrt(rate * (1 - rate) / (F.col("n") + F.lit(by_host) + 1))
    return hosts.join(domains, ["suffix", "domain"]).select(
        "host", "n", "bad", rate.alias("rate"), (rate - z * deviation).alias("bound"), F.lit(float(mean)).alias("average")
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules=RULES, times: float = 1.0, z: float = 1.645
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, with its host's labelled
    pages (n), bad ones, rate and bound."""
    addressed = with_address(pages)
    reputation = host_reputation(addressed, page_outcomes(addressed, labels), z)
    rule, verdict = rule_columns(rules)
    method = F.when(F.col("bound") > times * F.col("average"), "block").otherwise("allow")
    return addressed.join(reputation, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        "n", "bad", "rate", "bound",
    )
