"""Judging urls by rules and, where no rule fits, by the reputation of their host.

Labelled pages are good or bad. Hosts lie in registered domains, these in suffixes, these in the whole
table. At every level the bad share of a group has a beta prior: its mean is the posterior mean of the
group above, and one precision per level is estimated by moments from how much more the bad counts of
its groups differ than chance explains. So a host with few labels leans on its domain, a domain on
its suffix, and a host without labels has what its domain says. A host is blocked when the lower bound of
its posterior bad share, ``Z`` deviations below the mean, is above ``LIMIT``.

A host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, its letters A-Z made small;
the path goes on to ``?``, ``#`` or the end. A rule fits its host and all subdomains when the path
begins with its own; the longest rule wins. User names, ports and a dot at the end do not count for
domain and suffix. An address in numbers is its own domain and suffix.

Null urls and urls without ``://``: host and path are empty; they are a host of their own, judged alike.
Null id: judged like the others, but has no label. Repeated rows: each has its row; an id counts once
for a host. Several labels of an id: bad if one of them is; null labels are none. No labels or an empty
table: nothing is blocked but by a rule. Very long urls are read whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import join_busy
from dossierlake.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
# Suffixes of two labels under which names are registered; a parameter of the operator.
SUFFIXES = ("ac.uk", "co.jp", "co.in", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "org.au", "org.uk")
ADDRESS = r"^([0-9]+\.){3}[0-9]+$|^\["
LIMIT = 0.5
Z = 1.645
# Correlation of two labels of one group: least, most, and where no group has two labels.
RHO = (0.001, 0.5, 0.1)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def fitting_rule(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Name and verdict of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        entry = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, entry).otherwise(found)
    return found


def domain_and_suffix(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    name = F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), r"\.?(:[0-9]*)?$", "")
    labels = F.split(name, r"\.")
    pair = F.array_join(F.slice(labels, -2, 2), ".")
    # Labels of the suffix; a name that is nothing but a suffix is its own domain.
    wide = F.when((F.size(labels) > 1) & pair.isin(*suffixes), 2).otherwise(1)

    def last(n: Column) -> Column:
        n = F.least(n, F.size(labels))
        return F.when(name.rlike(ADDRESS), name).otherwise(F.array_join(F.slice(labels, -n, n), "."))

    return last(wide + 1), last(wide)


def _precision(groups: DataFrame, mean: Column) -> Column:
    """Precision of the priors of one level: groups have labels n, bad ones k and a prior mean."""
    rows = groups.select("n", "k", mean.alias("m"))
    chance = F.col("m") * (1 - F.col("m"))
    excess = F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2) - F.col("n") * chance)
    room = F.sum(F.col("n") * (F.col("n") - 1) * chance)
    rho = F.coalesce(F.least(F.greatest(excess / F.nullif(room, F.lit(0.0)), F.lit(RHO[0])), F.lit(RHO[1])), F.lit(RHO[2]))
    return rows.agg((1 / rho - 1).alias("precision")).scalar()


def _counts(groups: DataFrame, *key: str) -> DataFrame:
    return groups.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("n", "k", "pages")])


def host_posteriors(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Per host: pages, labels n, bad ones k, and the parameters a and b of its bad share's posterior.

    ``pages`` has page_id and host, ``outcomes`` page_id and bad (boolean).
    """
    known = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL")
    known = known.groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    labelled = pages.where("page_id IS NOT NULL").distinct().join(known, "page_id")
    labelled = labelled.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("k"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages")).join(labelled, "host", "left")
    domain, suffix = domain_and_suffix(F.col("host"), suffixes)
    hosts = hosts.select(
        "host", domain.alias("domain"), suffix.alias("suffix"), "pages",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "k")],
    )
    hosts = materialize(hosts, "hosts")
    everything = hosts.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m")).scalar()
    above = _counts(hosts, "suffix")
    above = _posterior_mean(above, everything, _precision(above, everything)).select("suffix", "mean", "pages")
    domains = _counts(hosts, "suffix", "domain")
    domains = materialize(join_busy(domains, above, "suffix"), "domains")
    domains = _posterior_mean(domains, F.col("mean"), _precision(domains, F.col("mean")))
    domains = domains.select("domain", "mean", "pages")
    hosts = materialize(join_busy(hosts, domains, "domain"), "host-priors")
    weight = _precision(hosts, F.col("mean"))
    return hosts.select(
        "host", "pages", "n", "k",
        (F.col("k") + weight * F.col("mean")).alias("a"),
        (F.col("n") - F.col("k") + weight * (1 - F.col("mean"))).alias("b"),
    )


def _posterior_mean(groups: DataFrame, mean: Column, precision: Column) -> DataFrame:
    return groups.withColumn("mean", (F.col("k") + precision * mean) / (F.col("n") + precision))


def lower_bound(a: Column, b: Column, z: float = Z) -> Column:
    """Mean of a beta distribution, less so many standard deviations."""
    total = a + b
    return a / total - F.lit(z) * F.sqrt(a * b / (total * total * (total + 1)))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule] = (),
    limit: float = LIMIT,
    suffixes: Sequence[str] = SUFFIXES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every row.

    ``outcomes`` has page_id and bad. Rules are configuration and part of the plan.
    """
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    hosts = host_posteriors(rows.select("page_id", "host"), outcomes, suffixes)
    blocked = lower_bound(F.col("a"), F.col("b")) > limit
    hosts = materialize(hosts.select("host", "pages", blocked.alias("blocked")), "host-verdicts")
    found = fitting_rule(rules, F.col("host"), F.col("path"))
    judged = join_busy(rows, hosts, "host").withColumn("found", found)
    by_host = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("found.name").alias("rule"),
        F.coalesce("found.verdict", by_host).alias("verdict"),
    )


OUTCOMES = """
outcomes AS (
  SELECT doc_id AS page_id, max((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::INT) AS bad
  FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY 1)"""


def page_outcomes(labels: DataFrame) -> DataFrame:
    """page_id and bad: quality 0 or toxic 1. Rows with neither label say nothing."""
    said = labels.where("quality IS NOT NULL OR toxic IS NOT NULL")
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    return said.select(F.col("doc_id").cast("long").alias("page_id"), bad.alias("bad"))


def _sql_precision(table: str, mean: str) -> str:
    excess = f"sum((k - n * {mean}) ** 2 - n * {mean} * (1 - {mean}))"
    room = f"nullif(sum(n * (n - 1) * {mean} * (1 - {mean})), 0)"
    return f"(SELECT 1 / coalesce(least(greatest({excess} / {room}, {RHO[0]}), {RHO[1]}), {RHO[2]}) - 1 FROM {table})"


def sql(rules: Sequence[Rule], limit: float = LIMIT, suffixes: Sequence[str] = SUFFIXES) -> str:
    """DuckDB's form of ``judge`` over the tables pages and labels."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = [f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN " for r in ordered]
    names = " ".join(f"{f}'{r.name}'" for f, r in zip(fits, ordered, strict=True))
    verdicts = " ".join(f"{f}'{r.verdict}'" for f, r in zip(fits, ordered, strict=True))
    two = ", ".join(f"'{s}'" for s in suffixes)
    return f"""
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
{OUTCOMES},
names AS (
  SELECT DISTINCT host, regexp_replace(regexp_replace(host, '^.*@', '', 's'), '\\.?(:[0-9]*)?$', '') AS name FROM parts),
split AS (
  SELECT host, name, string_split(name, '.') AS l,
         CASE WHEN array_to_string(string_split(name, '.')[-2:], '.') IN ({two}) THEN 2 ELSE 1 END AS w FROM names),
levels AS (
  SELECT host, CASE WHEN regexp_matches(name, '{ADDRESS}') THEN name ELSE array_to_string(l[-(w + 1):], '.') END AS domain,
         CASE WHEN regexp_matches(name, '{ADDRESS}') THEN name ELSE array_to_string(l[-w:], '.') END AS suffix FROM split),
labelled AS (
  SELECT host, count(*) AS n, sum(bad) AS k FROM (SELECT DISTINCT page_id, host FROM parts) JOIN outcomes USING (page_id) GROUP BY 1),
hosts AS (SELECT host, domain, suffix, coalesce(n, 0) AS n, coalesce(k, 0) AS k FROM levels LEFT JOIN labelled USING (host)),
s1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM hosts) AS m FROM hosts GROUP BY 1),
s2 AS (SELECT *, {_sql_precision('s1', 'm')} AS p FROM s1),
d1 AS (SELECT domain, sum(h.n) AS n, sum(h.k) AS k, any_value((s2.k + s2.p * s2.m) / (s2.n + s2.p)) AS m
       FROM hosts h JOIN s2 USING (suffix) GROUP BY domain),
d2 AS (SELECT *, {_sql_precision('d1', 'm')} AS p FROM d1),
h1 AS (SELECT host, h.n, h.k, (d2.k + d2.p * d2.m) / (d2.n + d2.p) AS m FROM hosts h JOIN d2 USING (domain)),
h2 AS (SELECT *, {_sql_precision('h1', 'm')} AS p FROM h1),
h3 AS (SELECT host, k + p * m AS a, n - k + p * (1 - m) AS b FROM h2),
h4 AS (SELECT host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {limit} AS blocked FROM h3)
SELECT page_id, host, path, CASE {names} END AS rule,
       coalesce(CASE {verdicts} END, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parts JOIN h4 USING (host)
"""
