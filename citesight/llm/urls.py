"""URL filters: fixed rules, else an empirical-Bayes reputation of the host.

Labelled page outcomes (bad = toxic or low quality) are counted per host,
registered domain and suffix.  Each level's posterior mean is the prior mean
of the level below (all pages -> suffix -> domain -> host); the prior's
strength comes from the spread between the groups of a level (method of
moments).  A page is blocked when its host is surely worse than most: when the
lower bound of the host's posterior bad rate is above ``lift`` times the rate of
all labelled pages (``CERTAIN`` at most, so that it can be reached).

Counts are partial aggregates, so a host with a third of all pages is one row a
task; statistics of a level are one row.

Defined cases: null url or none with ``://`` has empty host and path and is
judged by the overall rate; repeated labels of a page count once (bad if any
says so); unlabelled hosts take their domain's posterior; empty tables work;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: (host, path, verdict); the longest that fits wins.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Suffixes of two labels under which domains are registered.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
Z = 1.645
LIFT = 1.5
CERTAIN = 0.9
STRENGTH = (2.0, 1000.0)
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased.
    Path: from there up to ``? #`` or the end."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UP, _LOW), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict (both else null)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def domain_and_suffix(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host (user info and port left out)."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(list(suffixes))
    return (F.when(long, F.substring_index(bare, ".", -3)).otherwise(two),
            F.when(long, two).otherwise(F.substring_index(bare, ".", -1)))


def _strength(groups: DataFrame) -> float:
    """Prior strength of a level from ``n``, ``bad``, ``prior`` of its groups."""
    g = groups.where("n > 0").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2)).alias("ss"),
        F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("pq")).first()
    if not g["n"] or not g["pq"]:
        return STRENGTH[1]
    pq = g["pq"] / g["n"]
    between = (g["ss"] - g["k"] * pq) / g["n"]
    return min(max(pq / between - 1, STRENGTH[0]), STRENGTH[1]) if between > 0 else STRENGTH[1]


def host_reputation(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``pages`` (page_id, host) and ``outcomes`` (page_id, bad) -> one row per
    host: ``host, n, bad, bad_rate, bad_lower`` and ``overall``, the rate of all."""
    said = outcomes.groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    judged = pages.join(said, "page_id", "left")
    hosts = judged.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = materialize(hosts.withColumn("domain", domain).withColumn("suffix", suffix))
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    level = F.lit((total[1] + 1.0) / (total[0] + 2.0))

    def shrink(groups: DataFrame) -> DataFrame:
        s = _strength(groups)
        a = F.col("bad") + F.col("prior") * s
        return groups.withColumn("rate", a / (F.col("n") + s)).withColumn("_s", F.lit(s))

    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = shrink(materialize(hosts.groupBy("suffix").agg(*sums).withColumn("prior", level)))
    domains = shrink(materialize(hosts.groupBy("suffix", "domain").agg(*sums).join(
        suffixes.select("suffix", F.col("rate").alias("prior")), "suffix")))
    known = shrink(materialize(hosts.join(
        domains.select("suffix", "domain", F.col("rate").alias("prior")), ["suffix", "domain"])))
    size = F.col("n") + F.col("_s")
    sd = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    return known.select("host", "n", "bad", F.col("rate").alias("bad_rate"), (F.col("rate") - Z * sd).alias("bad_lower"),
                        level.alias("overall"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                lift: float = LIFT) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_lower`` of every page."""
    host, path = host_and_path()
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    rep = materialize(host_reputation(p.select("page_id", "host"), outcomes).select("host", "bad_lower", "overall"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_lower") > F.least(F.lit(lift) * F.col("overall"), F.lit(CERTAIN)), "block").otherwise("allow")
    return p.join(rep, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.round("bad_lower", 6).alias("bad_lower"))


def _shrunk(table: str) -> str:
    return f"""(SELECT *, (bad + prior * s) / (n + s) AS rate FROM {table}, (SELECT CASE
    WHEN coalesce(sum(n), 0) = 0 OR sum(n * prior * (1 - prior)) = 0 THEN {STRENGTH[1]}::DOUBLE
    WHEN sum(n * pow(bad / n - prior, 2)) - count(*) * sum(n * prior * (1 - prior)) / sum(n) <= 0 THEN {STRENGTH[1]}::DOUBLE
    ELSE least(greatest((sum(n * prior * (1 - prior)) / sum(n))
      / ((sum(n * pow(bad / n - prior, 2)) - count(*) * sum(n * prior * (1 - prior)) / sum(n)) / sum(n)) - 1,
      {STRENGTH[0]}::DOUBLE), {STRENGTH[1]}::DOUBLE) END AS s FROM {table} WHERE n > 0))"""


_TWO = ", ".join(f"'{s}'" for s in SUFFIXES)
_FIT = "\n".join(f"  WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h + p}|{v}'"
                 for h, p, v in sorted(RULES, key=lambda r: -len(r[0] + r[1])))
ORACLE_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
p AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), '{_UP}', '{_LOW}') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY 1),
c AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad,
  string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS l
  FROM p LEFT JOIN o ON o.doc_id = p.page_id GROUP BY 1),
h AS (SELECT host, n, bad, CASE WHEN array_to_string(l[-2:], '.') IN ({_TWO}) THEN array_to_string(l[-3:], '.')
    ELSE array_to_string(l[-2:], '.') END AS domain,
  CASE WHEN array_to_string(l[-2:], '.') IN ({_TWO}) THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix FROM c),
s0 AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad,
  (SELECT (coalesce(sum(bad), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) FROM h) AS prior FROM h GROUP BY 1),
s1 AS {_shrunk('s0')},
d0 AS (SELECT suffix, domain, sum(h.n)::DOUBLE AS n, sum(h.bad)::DOUBLE AS bad, any_value(s1.rate) AS prior
  FROM h JOIN s1 USING (suffix) GROUP BY 1, 2),
d1 AS {_shrunk('d0')},
h0 AS (SELECT host, h.n::DOUBLE AS n, h.bad::DOUBLE AS bad, d1.rate AS prior FROM h JOIN d1 USING (suffix, domain)),
h1 AS {_shrunk('h0')},
v AS (SELECT page_id, host, path, rate - {Z}::DOUBLE * sqrt(rate * (1 - rate) / (n + s + 1)) AS bad_lower,
  (SELECT any_value(prior) FROM s0) AS overall, CASE
{_FIT}
  END AS fit FROM p LEFT JOIN h1 USING (host))
SELECT page_id, host, path, split_part(fit, '|', 1) AS rule,
  coalesce(split_part(fit, '|', 2), CASE WHEN bad_lower > least({LIFT}::DOUBLE * overall, {CERTAIN}::DOUBLE) THEN 'block' ELSE 'allow' END) AS verdict,
  round(bad_lower, 6) AS bad_lower
FROM v"""
