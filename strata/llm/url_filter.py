"""URL filters: listed rules first, then an empirical-Bayes host reputation.

Labelled page outcomes (good 1 / bad 0) are counted per host.  Counts roll up
host -> registered domain -> suffix -> all.  Each level's rate is shrunk
towards its parent by a beta prior; the prior's strength is fitted by moments
from how far the level's groups spread around their parents.  A host is
blocked when even the upper bound of its posterior good rate
(mean + ``z`` standard deviations) stays below ``min_good``; a host without
labels takes its domain's, suffix's or the overall posterior.

A registered domain is a suffix and one more label; suffixes of two labels are
those listed in ``SUFFIXES`` (others count as domains of their last label), and an
IP address is a domain of its own.  User and port are no part of either.

Everything is DataFrame code.  Counting is pre-aggregated, so a host with a
third of all pages is one partial row per task; pages meet the host table in
one join that Spark broadcasts or splits by measured size.

Null url or one without ``://``: host and path are empty strings, no rule
fits and the verdict is that of the overall rate.  Null labels are ignored;
repeated pages are judged alike.  An empty table gives an empty result; with
no labels at all the overall rate is the neutral 1/2 and nothing is blocked.
Other columns of the input are not touched (nothing is joined by their names).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Text after the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


# Suffixes of two labels under which strangers register names.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "com.au", "net.au", "org.au", "edu.au", "gov.au", "co.nz", "org.nz",
    "co.jp", "ne.jp", "or.jp", "ac.jp", "go.jp", "co.kr", "or.kr", "com.cn", "net.cn", "org.cn", "com.tw", "org.tw", "com.hk",
    "com.sg", "com.my", "co.th", "co.id", "com.vn", "com.ph", "co.in", "org.in", "com.pk", "com.br", "net.br", "org.br", "com.ar",
    "com.mx", "com.co", "com.pe", "com.tr", "org.tr", "com.ua", "com.pl", "org.pl", "co.il", "org.il", "co.za", "org.za", "com.ng",
    "co.ke", "com.eg", "com.sa", "github.io", "gitlab.io", "blogspot.com", "wordpress.com", "tumblr.com", "herokuapp.com",
    "netlify.app", "vercel.app", "pages.dev", "workers.dev", "web.app", "firebaseapp.com", "appspot.com", "azurewebsites.net",
    "cloudfront.net", "amazonaws.com", "weebly.com", "wixsite.com", "livejournal.com", "substack.com", "medium.com",
)
ADDRESS = r"^([0-9]{1,3}\.){3}[0-9]{1,3}$|:|\["
ADDRESS_SUFFIX = "(address)"


def _bare(host: Column) -> Column:
    """Without user and port."""
    return F.regexp_replace(host, "^.*@|:[0-9]*$", "")


def suffix_of(host: Column) -> Column:
    """The listed suffix of two labels that the host lies under, else its last label.
    Addresses have a suffix of their own."""
    bare = _bare(host)
    two = F.substring_index(bare, ".", -2)
    return (F.when(bare.rlike(ADDRESS), F.lit(ADDRESS_SUFFIX)).when(two.isin(*SUFFIXES) & (bare != two), two)
            .otherwise(F.substring_index(bare, ".", -1)))


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one more label.  An address is its own."""
    bare = _bare(host)
    two = F.substring_index(bare, ".", -2)
    return (F.when(bare.rlike(ADDRESS), bare).when(two.isin(*SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest fitting rule as ``<verdict> <rule>``, or null.  ``rules``
    holds (verdict, ``host/path``) pairs; a rule fits its host and all its
    subdomains when the url's path starts with the rule's path."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, tail = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + tail)
        out = F.when(fits, F.lit(f"{verdict} {rule}")).otherwise(out)
    return out


def _shrunk(groups: DataFrame, parents: DataFrame | float, key: str, parent: str, label: str) -> DataFrame:
    """Beta posterior of each group under its parent's rate.

    ``groups``: (key, parent, n, k); ``parents``: (parent, rate), or one rate for
    all.  The prior
    strength s follows from the moment estimate of the between-group variance
    v of rates: s = m(1-m)/v - 1, held in [1, 1000].
    """
    if isinstance(parents, float):
        g = stored(groups.withColumn("m", F.lit(parents)), f"url-{label}")
    else:
        g = stored(groups.join(parents.select(parent, F.col("rate").alias("m")), parent, "left"), f"url-{label}")
    spread = F.col("k") / F.col("n") - F.col("m")
    base = F.col("m") * (1 - F.col("m"))
    total, noise, mean = g.where("n >= 2").agg(
        F.sum(F.col("n") * spread * spread) / F.sum("n"), F.sum(base) / F.sum("n"),
        F.sum(F.col("n") * base) / F.sum("n")).first()  # three numbers
    s = 1.0 if total is None else min(1000.0, max(1.0, mean / (total - noise) - 1)) if total > noise else 1000.0
    a = s * F.col("m") + F.col("k")
    b = s * (1 - F.col("m")) + F.col("n") - F.col("k")
    return (g.withColumn("a", a).withColumn("b", b).withColumn("rate", F.col("a") / (F.col("a") + F.col("b")))
            .withColumn("sd", F.sqrt(F.col("a") * F.col("b")
                                     / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b"))
                                        * (F.col("a") + F.col("b") + 1))))
            .select(key, parent, "n", "k", "rate", "sd"))


def host_reputation(hosts: DataFrame, z: float = 1.645, min_good: float = 0.5) -> DataFrame:
    """(host, n, rate, upper, blocked) from (host, n labelled, k good), one row a host."""
    g = stored(hosts.select("host", "n", "k", domain_of(F.col("host")).alias("domain"),
                            suffix_of(F.col("host")).alias("suffix")), "url-hosts")
    dom = g.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suf = dom.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("top", F.lit(0))
    # Beta(1, 1) over everything keeps the overall rate strictly inside (0, 1).
    zero = F.lit(0)
    top = float(g.agg((F.coalesce(F.sum("k"), zero) + 1) / (F.coalesce(F.sum("n"), zero) + 2)).first()[0])
    s = _shrunk(suf, top, "suffix", "top", "suffixes")
    d = _shrunk(dom, s, "domain", "suffix", "domains")
    h = _shrunk(g.select("host", "domain", "n", "k"), d, "host", "domain", "rated")
    upper = F.col("rate") + F.lit(z) * F.col("sd")
    return stored(h.select("host", "n", "rate", upper.alias("upper"), (upper < min_good).alias("blocked")),
                  "url-reputation")


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]],
                z: float = 1.645, min_good: float = 0.5) -> DataFrame:
    """Judge every page: (page_id, host, path, rule, verdict, good_rate, good_upper).

    ``pages``: page_id, url.  ``outcomes``: url of labelled pages and ``good``
    (1 or 0; null ignored).  A rule's verdict wins; otherwise ``block`` for
    hosts whose posterior bound is below ``min_good``, else ``allow``.
    """
    p = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = p.select("host", F.lit(0).alias("n"), F.lit(0).alias("k"))
    told = (outcomes.where("good is not null")
            .select(host_of(F.col("url")).alias("host"), F.lit(1).alias("n"), F.col("good").cast("int").alias("k")))
    hosts = seen.unionByName(told).groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    rep = host_reputation(hosts, z, min_good)
    judged = p.join(rep, "host", "left").withColumn("hit", rule_for(F.col("host"), F.col("path"), rules))
    return judged.select(
        "page_id", "host", "path", F.substring_index("hit", " ", -1).alias("rule"),
        F.when(F.col("hit").isNotNull(), F.substring_index("hit", " ", 1))
        .when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"),
        F.col("rate").alias("good_rate"), F.col("upper").alias("good_upper"))
