"""URL filters with empirical-Bayes host reputation (operator 2).

Rules decide first. Every other url gets the verdict of its host's reputation:
labelled page outcomes are shrunk through beta-binomial priors, from the whole
table to the suffix, to the registered domain, to the host, and a host is
blocked when the upper posterior bound of its share of good pages is too low.
DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: (verdict, host and path) of the registered query.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Public suffixes of more than one label (registries, then hosting services under which
#: strangers have names); any other suffix is the last label. ``judge_urls`` takes another list.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "nhs.uk", "plc.uk", "police.uk", "sch.uk",
    "com.au", "net.au", "org.au", "edu.au", "gov.au", "id.au", "co.nz", "net.nz", "org.nz", "ac.nz", "govt.nz",
    "co.jp", "ac.jp", "go.jp", "ne.jp", "or.jp", "co.kr", "go.kr", "or.kr", "ac.kr",
    "com.cn", "net.cn", "org.cn", "edu.cn", "gov.cn", "com.hk", "com.tw", "org.tw", "edu.tw", "com.sg", "edu.sg", "gov.sg",
    "com.my", "com.ph", "com.vn", "co.id", "ac.id", "go.id", "co.th", "ac.th", "go.th", "or.th",
    "co.in", "net.in", "org.in", "ac.in", "gov.in", "nic.in", "com.pk", "com.bd",
    "com.br", "net.br", "org.br", "gov.br", "edu.br", "com.mx", "org.mx", "gob.mx", "edu.mx", "com.ar", "gob.ar", "com.co", "com.pe",
    "com.ve", "com.ec", "com.uy", "co.za", "org.za", "ac.za", "gov.za", "com.ng", "co.ke", "com.gh", "com.eg", "co.il", "org.il",
    "ac.il", "com.tr", "org.tr", "edu.tr", "gov.tr", "com.sa", "com.ua", "com.pl", "org.pl", "com.pt", "com.gr", "co.at", "or.at",
    "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app", "web.app", "workers.dev",
    "wordpress.com", "s3.amazonaws.com", "s3-website.us-east-1.amazonaws.com")
#: A host is blocked when its mean share of good pages plus Z standard deviations is under MIN_GOOD.
MIN_GOOD = 0.5
Z = 2.0
#: Rules are compiled into one expression, so their number is bounded.
MAX_RULES = 1000
#: Bounds of the estimated correlation of pages within a group, and its value when nothing can be estimated.
RHO = (0.001, 0.9, 0.1)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_labels(suffixes: Sequence[str]) -> list[tuple[int, list[str]]]:
    """Suffixes by their number of labels, fewest first."""
    out: dict[int, list[str]] = {}
    for x in suffixes:
        out.setdefault(x.count(".") + 1, []).append(x)
    return sorted(out.items())


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest of ``suffixes`` that ends the host by whole labels, else its last label; an address is its own suffix."""
    out = F.substring_index(host, ".", -1)
    for labels, known in _by_labels(suffixes):  # the last one, with most labels, is asked first
        end = F.substring_index(host, ".", -labels)
        out = F.when(end.isin(*known), end).otherwise(out)
    return F.when(host.rlike(r"^[0-9.:]*$|^\["), host).otherwise(out)


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; an address is its own domain."""
    labels = F.size(F.split(suffix, r"\.")) + 1
    return F.when(suffix == host, host).otherwise(F.call_function("substring_index", host, F.lit("."), -labels))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits (equal length: block first), null where none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text = verdict = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):  # the last one wins
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(slash + p)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def _strength(groups: DataFrame, mu: str) -> float:
    """Prior strength of a level by moments: excess of the groups' variance over the binomial's."""
    v = F.col(mu) * (1 - F.col(mu))
    d = F.col("k") - F.col("n") * F.col(mu)
    row = groups.where("n > 0").agg(F.sum(d * d), F.sum(F.col("n") * v), F.sum(F.col("n") * (F.col("n") - 1) * v)).first()
    rho = RHO[2] if not row[2] else min(RHO[1], max(RHO[0], (row[0] - row[1]) / row[2]))
    return 1 / rho - 1


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Posterior of every host: mean, deviation, n and k.

    ``outcomes`` has host and good (1, 0, or null where a page is unlabelled).
    A host without labels has its domain's mean, and so on up; without any
    label every mean is one half. Three one-row aggregates reach the driver.
    """
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"), suffixes)).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    hosts = stored(hosts, "url_hosts")
    n, k = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    mu = F.lit(float((k + 1) / (n + 2)))

    def level(groups: DataFrame, name: str) -> tuple[DataFrame, float]:
        s = _strength(groups, "mu0")
        return groups.withColumn(name, (s * F.col("mu0") + F.col("k")) / (s + F.col("n"))), s

    def grouped(*by):
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    suffixes, _ = level(grouped("suffix").withColumn("mu0", mu), "mean")
    suffixes = suffixes.select("suffix", F.col("mean").alias("mu0"))
    domains, _ = level(grouped("suffix", "domain").join(suffixes, "suffix"), "mean")
    domains = domains.select("suffix", "domain", F.col("mean").alias("mu0"))
    out, s = level(hosts.join(domains, ["suffix", "domain"]), "mean")
    m = F.col("mean")
    return out.select("host", "n", "k", "mean", F.sqrt(m * (1 - m) / (s + F.col("n") + 1)).alias("deviation"))


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = tuple(RULES), key: str = "page_id",
               url: str = "url", label_key: str = "doc_id", min_good: float = MIN_GOOD, z: float = Z,
               suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Host, path, rule, verdict, mean and bound of every page's url, one row per input row.

    A null url or one without ``://`` has an empty host and path and is judged
    as the host of that name. Null keys and repeated rows are judged like any
    other; only key and url are read. Labels are outcomes by page: good where
    quality is 1 and toxic is not 1 (null: unlabelled); repeated ones count each.
    """
    urls = pages.select(F.col(key).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    good = labels.where(F.col("quality").isNotNull()).select(
        F.col(label_key).alias("page_id"),
        ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)).cast("int").alias("good"))
    known = reputation(urls.select("page_id", "host").join(good, "page_id", "left").select("host", "good"), suffixes)
    bound = F.col("mean") + z * F.col("deviation")
    text, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return urls.join(known, "host").select(  # a hot host is one skewed key, which Spark splits
        F.col("page_id").alias(key), "host", "path", text.alias("rule"),
        F.coalesce(verdict, F.when(bound < min_good, "block").otherwise("allow")).alias("verdict"), "mean", bound.alias("bound"))


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 2 over all pages; outcomes are the labels of the same id."""
    return judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).select(
        "page_id", "host", "path", "rule", "verdict")


def _level_sql(groups: str) -> str:
    return (f"(select 1 / case when coalesce(sum(n * (n - 1) * mu0 * (1 - mu0)), 0) = 0 then {RHO[2]} else "
            f"least({RHO[1]}, greatest({RHO[0]}, (sum((k - n * mu0) * (k - n * mu0)) - sum(n * mu0 * (1 - mu0))) "
            f"/ sum(n * (n - 1) * mu0 * (1 - mu0)))) end - 1 from {groups} where n > 0)")


def _suffix_sql() -> str:
    return " ".join(f"when array_to_string(p[-{labels}:], '.') in ({', '.join(repr(x) for x in known)}) then array_to_string(p[-{labels}:], '.')"
                    for labels, known in reversed(_by_labels(SUFFIXES)))


SQL = f"""
with u as (
  select page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}'), '') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
o as (select u.host, case when quality = 1 and coalesce(toxic, 0) <> 1 then 1 when quality is not null then 0 end as good
      from u left join (select * from labels where quality is not null) l on l.doc_id = u.page_id),
h0 as (select host, count(good) as n, coalesce(sum(good), 0) as k, string_split(host, '.') as p from o group by host),
h1 as (select *, case when regexp_matches(host, '^[0-9.:]*$|^\\[') then host
                      {_suffix_sql()}
                      else p[-1] end as suffix from h0),
h as (select *, case when suffix = host then host
                     else array_to_string(p[-(len(string_split(suffix, '.')) + 1):], '.') end as domain from h1),
s0 as (select suffix, sum(n) as n, sum(k) as k, (select (sum(k) + 1.0::double) / (sum(n) + 2) from h) as mu0 from h group by suffix),
s1 as (select suffix, (s * mu0 + k) / (s + n) as mean from s0, (select {_level_sql('s0')} as s)),
d0 as (select h.suffix, domain, sum(n) as n, sum(k) as k, any_value(mean) as mu0 from h join s1 using (suffix) group by h.suffix, domain),
d1 as (select suffix, domain, (s * mu0 + k) / (s + n) as mean from d0, (select {_level_sql('d0')} as s)),
g0 as (select host, n, k, mean as mu0 from h join d1 using (suffix, domain)),
g as (select host, (s * mu0 + k) / (s + n) as mean, s, n from g0, (select {_level_sql('g0')} as s)),
f as (select u.*, mean + {Z} * sqrt(mean * (1 - mean) / (s + n + 1)) as bound,
      [r for r in [{', '.join(f"{{'v': '{v}', 'h': '{r.partition('/')[0]}', 'p': '/{r.partition('/')[2]}'}}" for v, r in RULES)}]
       if (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p)] as fits
      from u join g using (host)),
w as (select *, list_sort([{{'len': length(r.h || r.p), 'b': (r.v = 'block')::int, 't': r.h || r.p, 'v': r.v}} for r in fits])[-1] as best from f)
select page_id, host, path, best.t as rule, coalesce(best.v, case when bound < {MIN_GOOD} then 'block' else 'allow' end) as verdict from w
"""
