"""URL filter: list rules, else an empirical-Bayes reputation of the host.

Labelled page outcomes (bad or not) are counted for each host.  Rates are
shrunk down a tree: the suffix's rate towards that of all pages, the registered
domain's towards its suffix's, the host's towards its domain's.  Each step is
a beta-binomial posterior whose prior has the parent's posterior mean (from its
other pages, so that none counts twice) and a strength estimated from the spread of all rates of that level around their
parents (method of moments, within ``strength``).  A host without labels has
its domain's rate, and so on up.  A page is blocked if the lower bound of the
host's posterior, ``z`` standard deviations below its mean, is above ``limit``:
a few bad pages do not block a host, many do.

Only DataFrame functions are used; the tables that meet are counts by host.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelsight.llm.tables import staged


@dataclass(frozen=True)
class Reputation:
    limit: float = 0.5
    z: float = 2.0
    strength: tuple[float, float] = (2.0, 200.0)
    #: A suffix has two labels if the second is a country's (two letters) and
    #: the first one of these, or if it is one of ``suffixes``, under which
    #: other people's names are given out; all others have one.
    second: tuple[str, ...] = ("ac", "co", "com", "edu", "gob", "gov", "go", "gv", "ltd", "mil", "ne", "net", "nhs", "nom", "or",
                               "org", "plc", "sch")
    suffixes: tuple[str, ...] = ("github.io", "gitlab.io", "blogspot.com", "wordpress.com", "herokuapp.com", "netlify.app", "pages.dev")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    h = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(h, ascii_uppercase, ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest of ``rules`` (like ``example.com/en/``) that fits: its host
    is the url's or one above it, and the url's path starts with its path."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r), len(r.split("/", 1)[0]), r)):
        name, _, rest = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(r)).otherwise(out)
    return out


def _registered(h: Column, rep: Reputation) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address is its own domain,
    and all addresses have one suffix."""
    name = F.regexp_replace(F.regexp_replace(h, "^[^@]*@", ""), ":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    long = two.rlike(f"^(?:{'|'.join(rep.second)})\\.[a-z]{{2}}$") | two.isin(*rep.suffixes)
    address = name.rlike("^[0-9.]+$|^\\[")
    return (F.when(address, name).when(long, F.substring_index(name, ".", -3)).otherwise(two),
            F.when(address, F.lit("[address]")).when(long, two).otherwise(F.substring_index(name, ".", -1)))


def _shrunk(level: DataFrame, m: str, bounds: tuple[float, float]) -> DataFrame:
    """``level`` (columns n, y and the parent's mean ``m``) with the prior
    strength k of the level."""
    seen = level.where("n > 0").select(F.col("n").cast("double").alias("n"), F.col("y").cast("double").alias("y"),
                                       F.col(m).alias("m"))
    s = seen.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                 F.sum("y").alias("y"), F.sum(F.col("n") * (F.col("y") / F.col("n") - F.col("m")) ** 2).alias("s")).first()
    lo, hi = bounds
    k = hi
    if s["k"] > 1 and s["n"] > 0:
        mean = s["y"] / s["n"]
        noise = mean * (1 - mean)
        room = s["n"] - s["nn"] / s["n"]
        spread = (s["s"] - (s["k"] - 1) * noise) / room if room > 0 else 0.0
        if spread > 0:
            k = min(hi, max(lo, noise / spread - 1))
    return level.withColumn("k", F.lit(float(k)))


def reputations(outcomes: DataFrame, rep: Reputation = Reputation()) -> DataFrame:
    """(host, n, bad, mean, bound) of every host in ``outcomes`` (host, bad):
    the labelled pages, the bad ones, and mean and lower bound of the
    posterior of its bad rate.  ``bad`` null: a page without label."""
    domain, suffix = _registered(F.col("host"), rep)
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.count(F.when(F.col("bad"), 1)).alias("y")).select(
        "host", domain.alias("domain"), suffix.alias("suffix"), "n", "y")
    hosts = staged(hosts, "url-hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    every = tops.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    all_n, all_y = every["n"] or 0, every["y"] or 0
    others = F.lit(all_n) - F.col("n")
    tops = _shrunk(tops.withColumn("m", F.when(others > 0, (F.lit(all_y) - F.col("y")) / others)
                                   .otherwise(F.lit(all_y / all_n if all_n else 0.0))), "m", rep.strength)

    def under(level: DataFrame, parents: DataFrame, name: str) -> DataFrame:
        """``level`` with the posterior mean of each row's parent, its own
        pages left out, and the strength of the level."""
        up = parents.select(F.col(name).alias("_p"), F.col("n").alias("pn"), F.col("y").alias("py"), F.col("k").alias("pk"),
                            F.col("m").alias("pm"))
        m = (F.col("py") - F.col("y") + F.col("pk") * F.col("pm")) / (F.col("pn") - F.col("n") + F.col("pk"))
        j = level.join(up, F.col(name) == F.col("_p")).withColumn("m", m)
        return _shrunk(j.select(*level.columns, "m"), "m", rep.strength)

    domains = under(domains, tops, "suffix")
    hosts = under(hosts, domains, "domain").withColumn("mean", (F.col("y") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k")))
    total = F.col("n") + F.col("k")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return hosts.select("host", "n", F.col("y").alias("bad"), "mean", (F.col("mean") - rep.z * sd).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], rep: Reputation = Reputation(),
          url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every row of ``pages``.

    ``rules``: rule to verdict; ``outcomes``: (host, bad) of labelled pages.
    A null url has an empty host and path; a host that ``outcomes`` lacks has
    no bound and is allowed unless a rule says otherwise.  Repeated rows and
    rows with null ids stay; an empty table gives no rows."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col(url)).alias("host"),
                     path(F.col(url)).alias("path"))
    r = reputations(outcomes, rep).select(F.col("host").alias("_h"), "bound")
    j = p.join(r, F.col("host") == F.col("_h"), "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules)))
    own = F.when(F.col("bound") > rep.limit, F.lit("block")).otherwise(F.lit("allow"))
    verdict = own
    for rule, said in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(said)).otherwise(verdict)
    return j.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bound")


def labelled(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """(host, bad) of every page: whether the document that its path names by
    number is labelled as of low quality or toxic (null: not labelled; a
    document labelled more than once is bad if one label says so)."""
    number = F.regexp_extract(path(F.col(url)), "/([0-9]{1,18})", 1)
    p = pages.select(host(F.col(url)).alias("host"), F.when(number != "", number).cast("long").alias("_n"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(bad).alias("bad"))
    return p.join(known, F.col("_n") == F.col("_id"), "left").select("host", "bad")
