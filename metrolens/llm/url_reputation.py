"""URL filter: explicit rules, then empirical-Bayes host reputation.

Method: labelled pages give each host n outcomes, of which some are bad. Rates are shrunk through beta-binomial
priors from the top down: suffix towards all pages, registered domain towards its suffix, host towards its domain.
The weight of each prior (its pseudo-count) is estimated from the data: (1 - rho) / rho with the analysis-of-variance
estimate of the intra-class correlation rho between the groups of that level, kept within RHO. A host is blocked if
the lower bound of its posterior bad rate, mean - Z * sd, is above BLOCK_ABOVE. A page without host is allowed.

Outcomes: a page's url ends with the number of the document it shows (last path segment, ``.html`` and a final slash
aside); that document's label is bad if it is toxic or of quality 0. The registered domain is the host's last two
labels, the suffix its last one.

Host: between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end; a null url or one without ``://`` has neither. A rule fits its host and all subdomains if
the url's path starts with the rule's; of several the longest wins.

Hosts are counted with partial aggregates and joined as rows, so a hot host is no hot task. Nulls in labels count as
not bad; labels without document number are left out. Repeated rows are judged each. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrolens.llm.common import broadcast_if_small, settled

#: Fixed values of the contract: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
Z, BLOCK_ABOVE = 1.2816, 0.3
RHO = (0.001, 0.5)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda i: F.coalesce(F.regexp_extract(url, URL, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits; null if none does."""
    rule = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def prior_weight(groups: DataFrame) -> DataFrame:
    """One row: rate (of all), weight (pseudo-count) from groups (n, bad)."""
    s = groups.agg(F.count(F.lit(1)).cast("double").alias("k"), F.sum("n").cast("double").alias("t"), F.sum("bad").cast("double").alias("b"),
                   F.sum(F.col("n") * F.col("n")).cast("double").alias("nn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q"))
    between = (F.col("q") - F.col("b") * F.col("b") / F.col("t")) / (F.col("k") - 1)
    within = (F.col("b") - F.col("q")) / (F.col("t") - F.col("k"))
    n0 = (F.col("t") - F.col("nn") / F.col("t")) / (F.col("k") - 1)
    s = s.select((F.col("b") / F.col("t")).alias("rate"), F.when((F.col("k") > 1) & (F.col("t") > F.col("k")), between).alias("x"),
                 F.when((F.col("k") > 1) & (F.col("t") > F.col("k")), within).alias("y"), F.when(F.col("k") > 1, n0).alias("n0"))
    down = F.col("x") + (F.col("n0") - 1) * F.col("y")
    rho = F.coalesce(F.when(down > 0, (F.col("x") - F.col("y")) / down), F.lit(RHO[0]))
    rho = F.least(F.greatest(rho, F.lit(RHO[0])), F.lit(RHO[1]))
    return s.select("rate", ((1 - rho) / rho).alias("weight"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """From (host, bad int) rows: host, n, bad, bad_rate (posterior mean), bad_low (its lower bound)."""
    parts = F.split("host", r"\.")
    hosts = settled(outcomes.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad")).select(
        "*", F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2)).alias("domain"), F.element_at(parts, -1).alias("suffix")))
    pooled = lambda *by: hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes, domains = pooled("suffix"), pooled("domain", "suffix")
    # Three rows of one line each, read by the driver: rate and prior weight of every level.
    (top, ws), (_, wd), (_, wh) = ((r["rate"], r["weight"]) for r in (prior_weight(g).first() for g in (suffixes, domains, hosts)))
    if top is None:
        return hosts.select("host", "n", "bad", F.lit(0.0).alias("bad_rate"), F.lit(0.0).alias("bad_low"))
    shrunk = lambda mean, w: (F.col("bad") + mean * w) / (F.col("n") + w)
    suffixes = suffixes.select("suffix", shrunk(F.lit(top), ws).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", shrunk(F.col("suffix_rate"), wd).alias("domain_rate"))
    rated = hosts.join(domains, ["domain", "suffix"]).select("host", "n", "bad", shrunk(F.col("domain_rate"), wh).alias("bad_rate"))
    sd = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("n") + wh + 1))
    return rated.withColumn("bad_low", F.col("bad_rate") - Z * sd)


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) of the pages whose document has a label."""
    host, path = host_and_path(F.col("url"))
    number = F.expr("try_cast(nullif(regexp_extract(path, '/([0-9]+)([.]html)?/?$', 1), '') as bigint)")
    shown = pages.select(host.alias("host"), path.alias("path")).select("host", number.alias("doc_id"))
    bad = (F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))).cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), bad.alias("bad")).filter("doc_id is not null")
    return shown.filter("host != '' and doc_id is not null").join(known, "doc_id").select("host", "bad")


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, host_n, bad_low (6 decimals)."""
    reputation = settled(host_reputation(page_outcomes(pages, labels)))
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.join(broadcast_if_small(reputation.select("host", "n", "bad_low"), 128), "host", "left")
    own = F.when(F.coalesce("bad_low", F.lit(0.0)) > BLOCK_ABOVE, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                       F.coalesce("n", F.lit(0)).alias("host_n"), F.round("bad_low", 6).alias("bad_low"))
