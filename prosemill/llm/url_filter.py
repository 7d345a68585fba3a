"""URL filter: allow and block rules, and for other urls an empirical-Bayes reputation of the host.

Labelled outcomes of pages (1 good, 0 bad) are counted per host name.  Beta-binomial priors shrink them level by level: the
registered domain towards its public suffix, the host towards its registered domain, the suffix towards the whole.  What a
host is shrunk towards is made without its own outcomes, and its domain's prior without the domain's, so that no
outcome counts twice.  Each level's prior strength is the method-of-moments estimate of the overdispersion of its groups,
(1 - rho) / rho with rho held in [0.001, 0.9] and 0.1 where it can't be estimated.  The verdict is `allow` if the host's
posterior mean less `z` posterior standard deviations is `least` or more.

The host name is the host without user, port and final dot.  Its suffix is its last label, or its last two if they are
in SUFFIXES; the registered domain has one label more.  A numeric address is its own domain and suffix.

A null url, or one without `://`, has an empty host and path; it is judged by the reputation of the empty host.
Outcomes whose id or label is null count nowhere, repeated ones each time; without any, all hosts have the prior mean 1/2.
Each page row gives one row; an empty table gives none.  DataFrame expressions only; host tables are joined as Spark's
size checks decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Suffixes of two labels under which names are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au", "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "com.hk", "com.sg", "com.tw", "edu.tw", "org.tw", "com.my", "co.id", "or.id", "co.th", "or.th", "com.vn", "com.ph",
    "ac.in", "co.in", "gov.in", "net.in", "org.in", "com.pk", "com.bd", "ac.il", "co.il", "org.il", "com.tr", "edu.tr", "gov.tr", "com.sa", "com.eg",
    "ac.za", "co.za", "org.za", "co.ke", "com.ng", "com.br", "gov.br", "net.br", "org.br", "com.ar", "com.mx", "org.mx", "com.co", "com.pe", "com.ve", "com.uy",
    "com.pl", "net.pl", "org.pl", "com.ua", "com.ru", "co.at", "or.at", "com.pt", "com.gr", "com.ro", "co.hu",
    "blogspot.com", "github.io", "gitlab.io", "netlify.app", "pages.dev", "vercel.app", "web.app", "wordpress.com",
)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Rules are carried in the plan, so their number has a bound.
MOST_RULES = 10_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def name_of(host: Column) -> Column:
    """The host without user, port and final dot."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"\.$", "")


def with_levels(names: DataFrame) -> DataFrame:
    """names (host, ...) with the registered domain and the suffix of each."""
    labels = F.split("host", r"\.")
    last = lambda n: F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - n + 1), F.lit(n)), ".")
    numeric = F.col("host").rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | F.startswith(F.col("host"), F.lit("["))
    two = last(2).isin(*SUFFIXES)
    return names.withColumns({"domain": F.when(numeric, F.col("host")).when(two, last(3)).otherwise(last(2)), "suffix": F.when(numeric, F.col("host")).when(two, last(2)).otherwise(last(1))})


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """struct(size, host_size, block, rule, verdict) of the longest rule that fits; of equally long ones that with the
    longer host, then a block."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES}")
    by: dict[str, list[Column]] = {}
    for verdict, rule_host, rule_path in rules:
        rule = rule_host + rule_path
        by.setdefault(rule_host, []).append(F.struct(F.lit(len(rule)).alias("size"), F.lit(len(rule_host)).alias("host_size"), F.lit(int(verdict == "block")).alias("block"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(rule_path).alias("path")))
    if not by:
        return F.lit(None).cast("struct<size:int,host_size:int,block:int,rule:string,verdict:string,path:string>")
    table = F.create_map(*(x for host_, found in by.items() for x in (F.lit(host_), F.array(*found))))
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.flatten(F.transform(parents, lambda x: F.filter(F.coalesce(F.try_element_at(table, x), F.array().cast("array<struct<size:int,host_size:int,block:int,rule:string,verdict:string,path:string>>")), lambda r: F.startswith(path, r["path"]))))
    return F.array_max(fits)


def _strength(groups: DataFrame) -> Column:
    """Scalar: the prior's strength from groups (n, k), n > 0."""
    total = groups.agg(F.sum("n").alias("N"), F.sum("k").alias("K"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count("*").alias("m"), F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"))
    p = (F.col("K") + 1) / (F.col("N") + 2)
    pq = p * (1 - p)
    spread = F.col("kk") - 2 * p * F.col("K") + p * p * F.col("N")  # sum of n (k/n - p)^2
    below = pq * (F.col("N") - F.col("n2") / F.col("N") - (F.col("m") - 1))
    rho = F.when(below > 0, (spread - pq * (F.col("m") - 1)) / below)
    rho = F.greatest(F.lit(0.001), F.least(F.lit(0.9), F.coalesce(rho, F.lit(0.1))))
    return total.select((1 / rho - 1).alias("strength")).scalar()


def reputation(hosts: DataFrame, labelled: DataFrame, z: float) -> DataFrame:
    """(host, n, k, posterior_mean, lower_bound) of every host name, from labelled (host, n, k)."""
    labelled = stored(with_levels(labelled), "host-outcomes")  # read for each level and its strength
    both = lambda prefix: (F.sum("n").alias(f"{prefix}n"), F.sum("k").alias(f"{prefix}k"))
    domains = stored(labelled.groupBy("domain", "suffix").agg(*both("")), "domain-outcomes")
    suffixes = stored(domains.groupBy("suffix").agg(*both("")), "suffix-outcomes")
    whole = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mean")).scalar()
    of = lambda df, key, prefix: df.select(key, F.col("n").alias(f"{prefix}n"), F.col("k").alias(f"{prefix}k"))
    rows = with_levels(hosts).join(of(labelled, "host", ""), "host", "left").join(of(domains, "domain", "d"), "domain", "left").join(of(suffixes, "suffix", "s"), "suffix", "left")
    rows = rows.fillna(0, ["n", "k", "dn", "dk", "sn", "sk"]).withColumns({"s0": _strength(suffixes), "s1": _strength(domains), "s2": _strength(labelled)})
    rows = rows.withColumn("m0", (F.col("sk") - F.col("dk") + F.col("s0") * whole) / (F.col("sn") - F.col("dn") + F.col("s0")))
    rows = rows.withColumn("m1", (F.col("dk") - F.col("k") + F.col("s1") * F.col("m0")) / (F.col("dn") - F.col("n") + F.col("s1")))
    rows = rows.withColumn("posterior_mean", (F.col("k") + F.col("s2") * F.col("m1")) / (F.col("n") + F.col("s2")))
    sd = F.sqrt(F.col("posterior_mean") * (1 - F.col("posterior_mean")) / (F.col("n") + F.col("s2") + 1))
    return rows.select("host", "n", "k", "posterior_mean", (F.col("posterior_mean") - z * sd).alias("lower_bound"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, least: float = 0.7, z: float = 1.645,
                id_col: str = "page_id", url_col: str = "url", outcome_id: str = "page_id", outcome_col: str = "good") -> DataFrame:
    """(id, host, path, rule, verdict, labelled, good, posterior_mean, lower_bound) per page row."""
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path")).withColumn("name", name_of(F.col("host")))
    marked = outcomes.select(F.col(outcome_id).alias("id"), F.col(outcome_col).cast("long").alias("good")).where("id is not null and good in (0, 1)")
    counted = rows.select("id", F.col("name").alias("host")).join(marked, "id").groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("k"))
    hosts = reputation(rows.select(F.col("name").alias("host")).distinct(), counted, z)
    judged = rows.join(hosts.withColumnRenamed("host", "name"), "name").withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("fit.verdict"), F.when(F.col("lower_bound") >= least, "allow").otherwise("block"))
    return judged.select("id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.col("n").alias("labelled"), F.col("k").alias("good"), "posterior_mean", "lower_bound")
