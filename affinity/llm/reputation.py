"""URL filter: listed rules, and for other pages the reputation of their host.

Reputation is empirical Bayes over labelled page outcomes. Bad and labelled pages are counted per
host, registered domain and suffix; each level's rate is the prior mean of the level below, with a
strength that the spread of rates at that level shows (moments of the beta-binomial), so a host
with few labels leans on its domain, a domain on its suffix, a suffix on all pages. A host is
blocked if the lower bound of its posterior bad rate, mean less ``Z`` standard deviations of the
beta posterior, is above ``BAD_RATE``.

Counts are combined before they are shuffled, a host's rows meet in no task, and only the table of
hosts, written once, is joined to the pages, where a hot host's pages can be split.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule, and the
verdict of the empty host, which is judged like any other; pages without outcome count as
unlabelled; an outcome that is null is none; repeated rows count and are returned each; without
any outcome all hosts are allowed. Only ``page_id`` and ``url`` are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.stage import written


#: Fixed rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Suffixes of two labels under which names are registered; all others are one label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
Z = 1.645
BAD_RATE = 0.5
#: Strength of a prior whose level shows no spread, or too little data for it; least and most.
STRENGTH, LEAST, MOST = 10.0, 1.0, 200.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts_of(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substr(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    split = r"^([^/?#]*)([^?#]*)"
    return (F.translate(F.regexp_extract(rest, split, 1), _UPPER, _LOWER),
            F.regexp_extract(rest, split, 2))


def with_parts(pages: DataFrame) -> DataFrame:
    """``page_id, host, path`` of every row."""
    host, path = parts_of(F.col("url"))
    return pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for where, start, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        name = F.when(fits, F.lit(where + start)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def levels_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host; an address in digits is its own domain.

    A domain is its name and its suffix: the address ``3.4`` is another domain than that of ``a.3.4``.
    """
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    last = F.substring_index(bare, ".", -1)
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*LONG_SUFFIXES)
    digits = bare.rlike(r"^[0-9.]+$")
    suffix = F.when(digits, F.lit("")).when(long, two).otherwise(last)
    domain = F.when(digits, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(children: DataFrame) -> DataFrame:
    """One row ``strength`` from rows ``k, n, parent_k, parent_n`` with n above 0."""
    mean = (F.col("parent_k") + 0.5) / (F.col("parent_n") + 1.0)
    terms = children.where("n > 0").select(
        (F.col("n") * F.pow(F.col("k") / F.col("n") - mean, 2) / (mean * (1 - mean))).alias("spread"),
        (1 - F.col("n") / F.col("parent_n")).alias("free"),
        (F.col("n") - F.col("n") * F.col("n") / F.col("parent_n")).alias("weight"))
    sums = terms.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("spread", "free", "weight")])
    excess, room = F.col("spread") - F.col("free"), F.col("weight") - F.col("free")
    rho = excess / room
    return sums.select(
        F.when((room <= 0) | (excess <= 0), F.when(room <= 0, F.lit(STRENGTH)).otherwise(F.lit(MOST)))
        .otherwise(F.greatest(F.lit(LEAST), F.least(F.lit(MOST), (1 - rho) / rho))).alias("strength"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """``host, mean, bound, blocked`` of every host from rows ``host, bad`` (null: unlabelled)."""
    hosts = written(outcomes.groupBy("host").agg(
        F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).cast("double").alias("k"),
        F.count("bad").cast("double").alias("n")))
    domain, suffix = levels_of(F.col("host"))
    hosts = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "k", "n")

    def total(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("k").alias("k"), F.sum("n").alias("n"))

    domains = written(total(hosts, "domain", "suffix"))
    suffixes = written(total(domains, "suffix"))
    everything = suffixes.agg(F.coalesce(F.sum("k"), F.lit(0.0)).alias("all_k"),
                              F.coalesce(F.sum("n"), F.lit(0.0)).alias("all_n"))

    def under(rows: DataFrame, parents: DataFrame, *keys: str) -> DataFrame:
        named = parents.select(*keys, F.col("k").alias("parent_k"), F.col("n").alias("parent_n"))
        return rows.join(named, list(keys))

    top = everything.select(F.col("all_k").alias("parent_k"), F.col("all_n").alias("parent_n"))
    # The single rows below hold one number each.
    of_suffix = _strength(suffixes.crossJoin(F.broadcast(top))).withColumnRenamed("strength", "s1")
    of_domain = _strength(under(domains, suffixes, "suffix")).withColumnRenamed("strength", "s2")
    of_host = _strength(under(hosts, domains, "domain", "suffix")).withColumnRenamed("strength", "s3")
    numbers = everything.crossJoin(of_suffix).crossJoin(of_domain).crossJoin(of_host).first()
    s1, s2, s3 = (F.lit(float(numbers[s])) for s in ("s1", "s2", "s3"))
    mean0 = F.lit((numbers["all_k"] + 0.5) / (numbers["all_n"] + 1.0))

    suffixes = suffixes.select("suffix", ((F.col("k") + s1 * mean0) / (F.col("n") + s1)).alias("mean1"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", "suffix", ((F.col("k") + s2 * F.col("mean1")) / (F.col("n") + s2)).alias("mean2"))
    a, b = F.col("k") + s3 * F.col("mean2"), F.col("n") - F.col("k") + s3 * (1 - F.col("mean2"))
    mean = a / (a + b)
    return (hosts.join(domains, ["domain", "suffix"])
            .select("host", mean.alias("mean"),
                    (mean - Z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("bound"))
            .withColumn("blocked", F.col("bound") > BAD_RATE))


def judge(pages: DataFrame, outcomes: DataFrame,
          rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    ``outcomes`` has rows ``host, bad``, one per page: true or false where a label says so.
    """
    blocked = written(host_reputation(outcomes).where("blocked").select("host", "blocked"))
    judged = with_parts(pages).join(blocked, "host", "left")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", name.alias("rule"),
                         F.coalesce(verdict, learnt).alias("verdict"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, bad`` per page: the labels of the document whose number ends the page's path.

    Bad is a document of quality 0 or toxic; a document labelled twice is bad if one label says so.
    """
    number = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.html?|/)?$", 1)
    numbered = with_parts(pages).select(
        "host", F.when(number != "", number.cast("long")).alias("doc_id"))
    bad = (labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")))
    return numbered.join(bad, "doc_id", "left").select("host", "bad")


ORACLE_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
  FROM parts),
bad AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL OR toxic IS NULL THEN NULL
    ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
outcome AS (
  SELECT s.host, b.bad FROM split s LEFT JOIN bad b
  ON b.doc_id = try_cast(nullif(regexp_extract(s.path, '/([0-9]{{1,18}})(?:\\.html?|/)?$', 1), '') AS BIGINT)),
counted AS (
  SELECT host, coalesce(sum(bad), 0)::DOUBLE AS k, count(bad)::DOUBLE AS n,
    regexp_replace(host, ':[0-9]*$', '') AS bare FROM outcome GROUP BY host),
labelled AS (
  SELECT *, string_split(bare, '.') AS l, regexp_matches(bare, '^[0-9.]+$') AS digits FROM counted),
longer AS (
  SELECT *, array_to_string(l[-2:], '.') AS two, array_to_string(l[-3:], '.') AS three FROM labelled),
hosts AS (
  SELECT host, k, n,
    CASE WHEN digits THEN bare WHEN two IN {LONG_SUFFIXES} THEN three ELSE two END AS domain,
    CASE WHEN digits THEN '' WHEN two IN {LONG_SUFFIXES} THEN two ELSE l[-1] END AS suffix FROM longer),
domains AS (SELECT domain, suffix, sum(k) AS k, sum(n) AS n FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(k) AS k, sum(n) AS n FROM domains GROUP BY suffix),
every AS (SELECT coalesce(sum(k), 0) AS k, coalesce(sum(n), 0) AS n FROM suffixes),
children AS (
  SELECT 1 AS level, c.k, c.n, p.k AS pk, p.n AS pn FROM suffixes c CROSS JOIN every p WHERE c.n > 0
  UNION ALL SELECT 2, c.k, c.n, p.k, p.n FROM domains c JOIN suffixes p USING (suffix) WHERE c.n > 0
  UNION ALL SELECT 3, c.k, c.n, p.k, p.n FROM hosts c JOIN domains p USING (domain, suffix) WHERE c.n > 0),
terms AS (
  SELECT level, n * pow(k / n - m, 2) / (m * (1 - m)) AS spread, 1 - n / pn AS free, n - n * n / pn AS weight
  FROM (SELECT *, (pk + 0.5) / (pn + 1.0) AS m FROM children)),
sums AS (SELECT level, sum(spread) - sum(free) AS excess, sum(weight) - sum(free) AS room FROM terms GROUP BY level),
strength AS (
  SELECT v.level, CASE WHEN coalesce(room, 0) <= 0 THEN {STRENGTH} WHEN excess <= 0 THEN {MOST}
    ELSE greatest({LEAST}, least({MOST}, (1 - excess / room) / (excess / room))) END AS s
  FROM (VALUES (1), (2), (3)) v(level) LEFT JOIN sums USING (level)),
s AS (SELECT max(CASE level WHEN 1 THEN s END) AS s1, max(CASE level WHEN 2 THEN s END) AS s2,
  max(CASE level WHEN 3 THEN s END) AS s3 FROM strength),
m1 AS (SELECT suffix, (c.k + s1 * (e.k + 0.5) / (e.n + 1.0)) / (c.n + s1) AS mean1
  FROM suffixes c CROSS JOIN every e CROSS JOIN s),
m2 AS (SELECT domain, suffix, (k + s2 * mean1) / (n + s2) AS mean2 FROM domains JOIN m1 USING (suffix) CROSS JOIN s),
post AS (SELECT host, k + s3 * mean2 AS a, n - k + s3 * (1 - mean2) AS b
  FROM hosts JOIN m2 USING (domain, suffix) CROSS JOIN s),
reputation AS (
  SELECT host, a / (a + b) - {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) > {BAD_RATE} AS blocked
  FROM post),
ruled AS (
  SELECT page_id, host, path, CASE
    {{rules}} END AS rule FROM split)
SELECT page_id, host, path, rule,
  CASE {{verdicts}} WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN reputation USING (host)
"""


def oracle_sql(rules: Sequence[tuple[str, str, str]] = RULES) -> str:
    """The same as ``judge`` over ``page_outcomes``, in SQL."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = "\n    ".join(f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%' THEN '{h}{p}'"
                         for h, p, _ in ordered)
    verdicts = " ".join(f"WHEN rule = '{h}{p}' THEN '{v}'" for h, p, v in ordered)
    return ORACLE_SQL.replace("{rules}", fits).replace("{verdicts}", verdicts)
