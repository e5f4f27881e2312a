"""URL filters with empirical-Bayes host reputation.

Explicit rules (host and path prefix, for the host and its subdomains; the
longest that fits wins) decide first. Other pages are judged by their host:
labelled page outcomes are shrunk through beta-binomial priors, the share of
bad pages of all for a suffix, a suffix's for a registered domain, a domain's
for a host. The strength of each level's prior is estimated from how much its
members differ (method of moments). A page is blocked if even the lower bound
of its host's posterior is above ``max_bad``. Only DataFrame functions are used.

The suffix is the last label of the host, the registered domain the last two.
A few hosts may hold most pages: hosts with over a thousandth of all pages
(fewer than 1000) are broadcast, all others joined by host.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is judged as the host ''; a host without outcomes has
its domain's or suffix's reputation; without any outcome at all nothing is
blocked but by rule; null outcomes are no outcomes; repeated rows give repeated
rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm.common import materialize

#: fixed rules of the registered query
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))

HOST = r"(?s)^.*?://([^/?#]*)"
PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_of(rules: tuple[tuple[str, str], ...], values: int) -> Column:
    """The longest rule that fits `host` and `path`, or its verdict; else null."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        at, _, rest = rule[0].partition("/")
        good = ((F.col("host") == at) | F.col("host").endswith("." + at)) & F.col("path").startswith("/" + rest)
        fits.append(F.when(good, F.lit(rule[values])))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


@dataclass(frozen=True)
class Priors:
    """Share of bad pages of all, and the strength of each level's prior."""

    share: float
    suffix: float
    domain: float
    host: float


#: strongest and weakest prior, as the correlation of two pages of one member (so a
#: prior is worth 49 pages at most: the outcomes of a member itself always count)
LEAST, MOST = 0.02, 0.9


def strength(members: DataFrame) -> float:
    """Strength of a level's beta prior, by the method of moments, from its
    members' pages n, bad ones x and prior mean m."""
    row = members.agg(
        F.sum((F.col("x") - F.col("n") * F.col("m")) ** 2 / (F.col("m") * (1 - F.col("m")))).alias("seen"),
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("n") - 1.0)).alias("pairs")).first()
    rho = (row["seen"] - row["n"]) / row["pairs"] if row["pairs"] else MOST
    rho = min(MOST, max(LEAST, rho))
    return 1 / rho - 1


def shrunk(x: str, n: str, m: str, s: float) -> Column:
    return (F.col(x) + s * F.col(m)) / (F.col(n) + s)


def reputation(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> tuple[DataFrame, Priors]:
    """(host, pages, lower bound of the share of bad pages, for every host of
    ``pages``; the priors). ``pages`` has host; ``outcomes`` has host and bad (0/1)."""
    counts = outcomes.where("bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("x"))
    hosts = (pages.groupBy("host").agg(F.count("*").alias("pages")).join(counts, "host", "full")
             .select("host", F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("x", F.lit(0)).alias("x"),
                     domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix")))
    hosts = materialize(spark, hosts, "hosts")
    total, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("x"), F.lit(0))).first()
    share = (bad + 0.5) / (total + 1)  # never 0 or 1
    sums = [F.sum("n").alias("n"), F.sum("x").alias("x")]
    domains = materialize(spark, hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("m", F.lit(share))
    s1 = strength(suffixes)
    suffixes = materialize(spark, suffixes.select("suffix", shrunk("x", "n", "m", s1).alias("m")), "suffixes")
    domains = domains.join(suffixes, "suffix")
    s2 = strength(domains)
    domains = materialize(spark, domains.select("domain", shrunk("x", "n", "m", s2).alias("m")), "means")
    # a domain may hold most hosts: the few large ones are broadcast
    held = spread_join(spark, hosts, domains, "domain", "left")
    s3 = strength(held)
    a = F.col("x") + s3 * F.col("m")
    b = F.col("n") - F.col("x") + s3 * (1 - F.col("m"))
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    out = held.select("host", "pages", (mean - z * sd).alias("low"))
    return out, Priors(share, s1, s2, s3)


def spread_join(spark: SparkSession, rows: DataFrame, small: DataFrame, key: str, how: str, part: int = 1000) -> DataFrame:
    """``rows`` join ``small`` (unique ``key``): keys with over 1/part of the rows,
    fewer than ``part`` of them, are joined by broadcast, the others by key."""
    counts = materialize(spark, rows.groupBy(key).agg(F.count("*").alias("__rows")), "keys")
    total = counts.agg(F.coalesce(F.sum("__rows"), F.lit(0))).first()[0]
    hot = [r[0] for r in counts.where(F.col("__rows") * part > total).select(key).collect()]  # fewer than `part`
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    most = rows.where(is_hot).join(F.broadcast(small.where(is_hot)), key, how)
    return most.unionByName(rows.where(~is_hot).join(small, key, how))


def judge(spark: SparkSession, pages: DataFrame, outcomes: DataFrame, keys: list[str], url: str = "url",
          rules: tuple[tuple[str, str], ...] = RULES, max_bad: float = 0.4) -> DataFrame:
    """``keys``, host, path, rule (or null), verdict and the host's lower bound
    ``low`` for every row of ``pages``. ``outcomes`` has the url and bad (0/1)."""
    pages = pages.select(*keys, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    labelled = outcomes.select(host(F.col(url)).alias("host"), F.col("bad").cast("long").alias("bad"))
    hosts, _ = reputation(spark, pages, labelled)
    low = materialize(spark, hosts.select("host", "low"), "reputation")
    out = spread_join(spark, pages, low, "host", "left")
    method = F.when(F.col("low") > max_bad, "block").otherwise("allow")
    return out.select(*keys, "host", "path", rule_of(rules, 0).alias("rule"), F.coalesce(rule_of(rules, 1), method).alias("verdict"), "low")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages: the number that ends a page's path names the document
    it shows; the page is bad if that document is labelled as of low quality or
    as toxic."""
    number = F.regexp_extract(path(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1)
    known = (labels.where("doc_id IS NOT NULL").groupBy("doc_id")
             .agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")))
    return (pages.select("url", F.when(number != "", number).cast("long").alias("doc_id")).where("doc_id IS NOT NULL")
            .join(known, "doc_id").select("url", "bad"))


def _oracle(max_bad: float = 0.4, z: float = 1.645) -> str:
    rules = ", ".join(f"('{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}', '{v}')" for r, v in RULES)

    def strength_of(t: str) -> str:
        return f"""(SELECT 1 / rho - 1 AS s FROM (SELECT least({MOST}, greatest({LEAST}, CASE WHEN coalesce(sum(n * (n - 1.0)), 0) = 0 THEN {MOST}
            ELSE (sum((x - n * m) ** 2 / (m * (1 - m))) - sum(n)) / sum(n * (n - 1.0)) END)) AS rho FROM {t}))"""

    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
known AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
outcomes AS (SELECT host, bad FROM (SELECT host, TRY_CAST(nullif(regexp_extract(path, '/(\\d{{1,18}})(?:\\.html)?/?$', 1), '') AS BIGINT) AS doc_id FROM p)
             JOIN known USING (doc_id)),
hosts AS (SELECT host, coalesce(n, 0) AS n, coalesce(x, 0) AS x,
                 CASE WHEN len(string_split(host, '.')) > 1 THEN string_split(host, '.')[-2] || '.' || string_split(host, '.')[-1] ELSE host END AS domain,
                 string_split(host, '.')[-1] AS suffix
          FROM (SELECT DISTINCT host FROM p) LEFT JOIN (SELECT host, count(*) AS n, sum(bad) AS x FROM outcomes GROUP BY host) USING (host)),
total AS (SELECT (sum(x) + 0.5) / (sum(n) + 1) AS share FROM hosts),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY domain, suffix),
s0 AS (SELECT suffix, sum(n) AS n, sum(x) AS x, any_value(share) AS m FROM d0, total GROUP BY suffix),
s1 AS (SELECT suffix, (x + s * m) / (n + s) AS m FROM s0, {strength_of('s0')}),
d1 AS (SELECT domain, n, x, m FROM d0 JOIN s1 USING (suffix)),
d2 AS (SELECT domain, (x + s * m) / (n + s) AS m FROM d1, {strength_of('d1')}),
h1 AS (SELECT host, n, x, m FROM hosts JOIN d2 USING (domain)),
h2 AS (SELECT host, x + s * m AS a, n - x + s * (1 - m) AS b FROM h1, {strength_of('h1')}),
low AS (SELECT host, a / (a + b) - {z} * sqrt(a * b / ((a + b) ** 2 * (a + b + 1))) AS low FROM h2),
rules(under, start, rule, verdict) AS (VALUES {rules}),
fit AS (SELECT DISTINCT host, path, arg_max(rule, length(rule)) OVER w AS rule, arg_max(verdict, length(rule)) OVER w AS ruled
        FROM (SELECT DISTINCT host, path FROM p) JOIN rules ON (host = under OR ends_with(host, '.' || under)) AND starts_with(path, start)
        WINDOW w AS (PARTITION BY host, path))
SELECT page_id, p.host, p.path, rule, coalesce(ruled, CASE WHEN low > {max_bad} THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN low USING (host) LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path"""


ORACLE = _oracle()
