"""URL filters by empirical-Bayes host reputation.

Rules label some pages; the share of blocked ones among a host's labelled pages is its reputation.  Few outcomes say
little, so they are shrunk through beta-binomial priors: a suffix towards all pages, a registered domain towards its
suffix, a host towards its domain.  A page without a rule is blocked if even the lower posterior bound of its host is
above the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Weight of each prior, in pages; standard deviations below the mean; share of bad pages that blocks a host.
STRENGTH, BOUND, LIMIT = 4.0, 1.64, 0.5

# Second-level suffixes below which names are registered.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "or.jp", "ne.jp", "com.br", "com.cn", "co.in", "co.kr", "co.nz", "co.za", "com.mx", "com.tr")


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict), or null."""
    out = F.lit(None)
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _domains(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix."""
    two = F.substring_index(host, ".", -2)
    deep = two.isin(*SECOND_LEVEL)
    return F.when(deep, F.substring_index(host, ".", -3)).otherwise(two), F.when(deep, two).otherwise(F.substring_index(host, ".", -1))


def judge(pages: DataFrame, rules: tuple = RULES, strength: float = STRENGTH, bound: float = BOUND, limit: float = LIMIT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad_low (the host's lower posterior bound, null under a rule).

    A null url and one without `://` have an empty host and path and no rule; their host is one like any other.  Repeated
    rows are outcomes of their own; of rules equally long, which then fit the same pages, the later one in order counts.
    A page without an id is judged too; other columns are ignored; an empty table gives an empty result.
    """
    host, path = host_and_path()
    rows = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    domain, suffix = _domains(F.col("host"))
    # a row for each host, counted before anything is shuffled
    hosts = rows.groupBy("host").agg(F.count("r").alias("n"), F.count_if(F.col("r.verdict") == "block").alias("bad")).select("host", "n", "bad", domain.alias("domain"), suffix.alias("suffix"))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("d_n"), F.sum("bad").alias("d_bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("d_n").alias("s_n"), F.sum("d_bad").alias("s_bad"))
    whole = suffixes.agg(F.sum("s_n").alias("a_n"), F.sum("s_bad").alias("a_bad"))  # one row
    shrunk = lambda bad, n, prior: (F.col(bad) + strength * prior) / (F.col(n) + strength)
    everywhere = (F.col("a_bad") + 1) / (F.col("a_n") + 2)
    suffixes = suffixes.crossJoin(F.broadcast(whole)).select("suffix", shrunk("s_bad", "s_n", everywhere).alias("s_share"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", shrunk("d_bad", "d_n", F.col("s_share")).alias("d_share"))
    a, b = F.col("bad") + strength * F.col("d_share"), F.col("n") - F.col("bad") + strength * (1 - F.col("d_share"))
    low = a / (a + b) - bound * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    judged = hosts.join(domains, ["domain", "suffix"]).select("host", low.alias("low"))
    out = rows.join(judged, "host", "left")
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("low") > limit, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), F.when(F.col("r").isNull(), F.col("low")).alias("bad_low"))


#: The same in SQL, over the table pages.
SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), rows_ AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule FROM rows_
), outcomes AS (
  SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END AS said FROM ruled
), hosts AS (
  SELECT host, count(said) AS n, count(*) FILTER (WHERE said = 'block') AS bad, string_split(host, '.') AS parts FROM outcomes GROUP BY host
), levels AS (
  SELECT host, n, bad, array_to_string(parts[greatest(1, len(parts) - 1):], '.') AS two, array_to_string(parts[greatest(1, len(parts) - 2):], '.') AS three, parts[len(parts)] AS one FROM hosts
), named AS (
  SELECT host, n, bad, CASE WHEN two IN {SECOND_LEVEL} THEN three ELSE two END AS domain, CASE WHEN two IN {SECOND_LEVEL} THEN two ELSE one END AS suffix FROM levels
), alls AS (SELECT sum(n) AS n, sum(bad) AS bad FROM named
), suffixes AS (
  SELECT suffix, (sum(named.bad) + {STRENGTH} * (any_value(alls.bad) + 1e0) / (any_value(alls.n) + 2)) / (sum(named.n) + {STRENGTH}) AS share FROM named, alls GROUP BY suffix
), domains AS (
  SELECT domain, named.suffix, (sum(bad) + {STRENGTH} * any_value(share)) / (sum(n) + {STRENGTH}) AS share FROM named JOIN suffixes ON named.suffix = suffixes.suffix GROUP BY domain, named.suffix
), posterior AS (
  SELECT host, bad + {STRENGTH} * share AS a, n - bad + {STRENGTH} * (1 - share) AS b FROM named JOIN domains ON named.domain = domains.domain AND named.suffix = domains.suffix
), lows AS (SELECT host, a / (a + b) - {BOUND} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS low FROM posterior)
SELECT page_id, o.host, path, rule, coalesce(said, CASE WHEN low > {LIMIT} THEN 'block' ELSE 'allow' END) AS verdict FROM outcomes o JOIN lows ON o.host = lows.host
"""
