"""URL filter by explicit rules and empirical-Bayes host reputation.

Rules name a host and a path; a rule fits its host and all subdomains where the url's path
starts with the rule's path, and the longest rule decides. Every other url is judged by its
host's reputation: labelled page outcomes (bad or not) are counted for hosts, registered
domains and public suffixes, and each node's share of bad pages has a beta prior centred on
its parent's posterior mean. How strong the prior is comes from the data, level by level: the
spread of the children's shares around the overall share, beyond what binomial counts alone
would show (method of moments of the beta-binomial). A url is blocked when the lower bound
of its host's posterior, mean - Z standard deviations, exceeds ``BLOCK_ABOVE``: a host is
blocked on evidence, never for lack of it.

Scale: counts are partial aggregates; of pages only the url is read. A host with a third of
all rows is spread over as many reducers as there are input partitions when the reputation
is attached. Rules are a parameter of at most ``MAX_RULES`` entries, part of the expression.

Defined results: a null url or one without ``://`` has empty host and path and the reputation
of the empty host; upper-case A to Z in hosts is lowered, everything else is kept; null
outcomes and outcomes of unknown pages do not count; repeated rows are judged alike, and
repeated outcomes of a page count each; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import stage

Z = 1.645
BLOCK_ABOVE = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
MAX_RULES = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Public suffixes of two labels.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.uk", "org.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr",
                      "com.br", "com.mx", "com.ar", "co.in", "com.cn", "com.tr", "co.za"]

# (verdict, host, path)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(rest_of(url), F.lit("")), "^([^/?#]*)([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(rest_of(url), F.lit("")), "^([^/?#]*)([^?#]*)", 2)


def suffix_of(host: Column) -> Column:
    """Last label, or the last two where they are a public suffix together."""
    two = F.regexp_extract(host, "([^.]*[.][^.]*)$", 1)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.regexp_extract(host, "([^.]*)$", 1))


def domain_of(host: Column) -> Column:
    """Registered domain: the public suffix and one label more."""
    two = F.regexp_extract(host, "([^.]*[.][^.]*)$", 1)
    three = F.regexp_extract(host, "([^.]*[.][^.]*[.][^.]*)$", 1)
    longer = F.when(two.isin(TWO_LABEL_SUFFIXES) & (three != ""), three).otherwise(two)
    return F.when(longer == "", host).otherwise(longer)


def matched_rules(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits; null without one. Of equally long
    rules the one with the longer host wins, then ``block``."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit an expression")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def _shrunk(level: DataFrame, parents: DataFrame, node: str, parent: str) -> DataFrame:
    """``level`` (node, parent, n, bad) with prior, strength and posterior parameters a, b."""
    joined = level.join(parents.select(F.col(parent), F.col("mean").alias("prior")), parent)
    # method of moments: spread of shares about the prior, weighted by n, against n (k - 1) binomial spread
    share, m = F.try_divide(F.col("bad"), F.col("n")), F.col("prior")  # no outcomes, no share
    spread = joined.agg(F.sum(F.col("n") * (share - m) * (share - m)).alias("s"),
                        F.sum(F.when(F.col("n") > 0, m * (1 - m))).alias("v"), F.sum(F.col("n") * m * (1 - m)).alias("nv"))
    # E[s] = v + rho * (nv - v)
    rho = (F.col("s") - F.col("v")) / F.nullif(F.col("nv") - F.col("v"), F.lit(0.0))
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1 / (MAX_STRENGTH + 1))), F.lit(1 / (MIN_STRENGTH + 1)))
    strength = spread.select((1 / rho - 1).alias("strength"), F.lit(1).alias("one"))
    out = joined.withColumn("one", F.lit(1)).join(F.broadcast(strength), "one").drop("one")  # a single row
    a = F.col("bad") + F.col("strength") * m
    b = F.col("n") - F.col("bad") + F.col("strength") * (1 - m)
    return out.withColumn("mean", a / (a + b)).withColumn(
        "lower", F.col("mean") - Z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (a + b + 1))).drop("prior")


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, bad, mean, lower) of every host of ``pages`` (page_id, host), from
    ``outcomes`` (page_id, bad). Hosts without outcomes carry their domain's mean, and so on."""
    counts = pages.groupBy("page_id", "host").count().join(
        outcomes.where("bad is not null").groupBy("page_id").agg(
            F.count("*").alias("n"), F.sum(F.col("bad").cast("bigint")).alias("bad")), "page_id", "left")
    hosts = counts.groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                                       F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = stage(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))),
                  "host-counts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    root = hosts.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("mean")).withColumn("root", F.lit(""))
    of_suffix = _shrunk(suffixes.withColumn("root", F.lit("")), root, "suffix", "root").drop("root")
    of_domain = _shrunk(domains, of_suffix, "domain", "suffix")
    of_host = _shrunk(hosts.drop("suffix"), of_domain, "host", "domain")
    return of_host.select("host", "n", "bad", "mean", "lower")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_mean, bad_lower of every page."""
    url = F.col("url")
    rows = stage(pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                              F.spark_partition_id().alias("salt")), "url-hosts")
    known = reputations(rows, outcomes)
    parts = rows.select("host", "salt").distinct()
    out = rows.join(parts.join(known, "host"), ["host", "salt"])
    text, verdict = matched_rules(F.col("host"), F.col("path"), rules)
    own = F.when(F.coalesce(F.col("lower"), F.lit(0.0)) > BLOCK_ABOVE, "block").otherwise("allow")
    return out.select("page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
                      F.col("mean").alias("bad_mean"), F.col("lower").alias("bad_lower"))


def outcomes_from_labels(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Outcomes of pages that hold a labelled document, whose number is in the url's path: bad
    when it is toxic or of low quality."""
    number = F.regexp_extract(path_of(F.col("url")), "^/[^/]*/([0-9]{1,18})", 1)
    holds = pages.select("page_id", F.nullif(number, F.lit("")).cast("bigint").alias("doc_id"))
    bad = labels.select("doc_id", ((F.col("toxic") > 0) | (F.col("quality") <= 0)).cast("int").alias("bad"))
    return holds.join(bad, "doc_id").select("page_id", "bad")


def oracle() -> str:
    """DuckDB SQL for page_id, host, path, rule and verdict over ``pages`` and ``labels``."""
    two = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    cases = sorted(RULES, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[0] == "block"), reverse=True)

    def chain(value) -> str:
        return "CASE " + " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
                                  f"THEN '{value(k, h, p)}'" for k, h, p in cases) + " END"

    def shrunk(out: str, level: str, parents: str, parent: str) -> str:
        return f"""{out}_j AS (SELECT l.*, p.mean AS prior FROM {level} l JOIN {parents} p USING ({parent})),
        {out}_m AS (SELECT SUM(n * (bad / n - prior) * (bad / n - prior)) AS s, SUM(prior * (1 - prior)) AS v,
                    SUM(n * prior * (1 - prior)) AS nv FROM (SELECT * REPLACE (n::DOUBLE AS n, bad::DOUBLE AS bad)
                    FROM {out}_j WHERE n > 0)),
        {out}_s AS (SELECT 1 / least(greatest(COALESCE((s - v) / NULLIF(nv - v, 0), 0), {1 / (MAX_STRENGTH + 1)!r}),
                    {1 / (MIN_STRENGTH + 1)!r}) - 1 AS k FROM {out}_m),
        {out}_a AS (SELECT j.*, bad + k * prior AS a, n - bad + k * (1 - prior) AS b FROM {out}_j j, {out}_s),
        {out} AS (SELECT *, a / (a + b) AS mean,
                  a / (a + b) - {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS lower FROM {out}_a)"""

    return f"""
    WITH cut AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                 FROM pages),
    urls AS (SELECT page_id, translate(regexp_extract(COALESCE(rest, ''), '^([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
                    regexp_extract(COALESCE(rest, ''), '^([^/?#]*)([^?#]*)', 2) AS path FROM cut),
    outcomes AS (SELECT page_id, ((toxic > 0) OR (quality <= 0))::BIGINT AS bad FROM urls JOIN labels
                 ON doc_id = TRY_CAST(regexp_extract(path, '^/[^/]*/([0-9]{{1,18}})', 1) AS BIGINT)),
    of_page AS (SELECT page_id, COUNT(*) AS n, SUM(bad) AS bad FROM outcomes WHERE bad IS NOT NULL GROUP BY 1),
    counted AS (SELECT host, COALESCE(SUM(n), 0)::BIGINT AS n, COALESCE(SUM(bad), 0)::BIGINT AS bad
                FROM (SELECT DISTINCT page_id, host FROM urls) LEFT JOIN of_page USING (page_id) GROUP BY 1),
    named AS (SELECT *, regexp_extract(host, '([^.]*[.][^.]*)$', 1) AS two,
                     regexp_extract(host, '([^.]*[.][^.]*[.][^.]*)$', 1) AS three FROM counted),
    hosts AS (SELECT host, n, bad, CASE WHEN two IN ({two}) AND three <> '' THEN three WHEN two <> '' THEN two ELSE host END AS domain,
                     CASE WHEN two IN ({two}) THEN two ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix FROM named),
    domains AS (SELECT domain, suffix, SUM(n) AS n, SUM(bad) AS bad FROM hosts GROUP BY ALL),
    suffixes AS (SELECT suffix, 0 AS root, SUM(n) AS n, SUM(bad) AS bad FROM hosts GROUP BY suffix),
    base AS (SELECT 0 AS root, (SUM(bad) + 0.5) / (SUM(n) + 1) AS mean FROM hosts),
    {shrunk('of_suffix', 'suffixes', 'base', 'root')},
    {shrunk('of_domain', 'domains', '(SELECT suffix, mean FROM of_suffix)', 'suffix')},
    {shrunk('of_host', '(SELECT host, domain, n, bad FROM hosts)', '(SELECT domain, mean FROM of_domain)', 'domain')}
    SELECT page_id, host, path, {chain(lambda k, h, p: h + p)} AS rule,
           COALESCE({chain(lambda k, h, p: k)}, CASE WHEN lower > {BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict
    FROM urls JOIN of_host USING (host)"""
