"""URL filters: rules of hosts and paths, and for the rest the reputation of the host.

Reputation is empirical Bayes.  Labelled pages are counted per host, registered domain and suffix.  How
much children differ from their parent is estimated at each level from the counts themselves; the rate
of bad pages of a host then starts from a beta prior that comes down from all pages over the suffix and
the domain, where each labelled page speaks once, at the closest level it shares with the host.  A host
is blocked when its rate lies beyond ``LIMIT`` with a probability of at least ``SURE``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import stored, table
from siltstone.session import control_rows

LIMIT = 0.5  # rate of bad pages that a blocked host exceeds
SURE = 0.95  # posterior probability of that
RHO_LEAST, RHO_MOST = 0.001, 0.5  # correlation within a parent; bounds of the estimate
RHO_UNKNOWN = 0.1  # where no child has two labelled pages

# The rules of the query, as host and path.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
# Suffixes of two labels under which domains are registered; a parameter, since they change with time.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")

_RULE = T.StructType([T.StructField(n, T.StringType()) for n in ("rule", "verdict")])


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``rule, verdict`` of a short list.  ``judge`` takes long lists as a table of the same columns."""
    return control_rows(spark, [{"rule": r, "verdict": v} for r, v in rules], _RULE)


def located(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def _tails(host: Column, depth: int) -> Column:
    """The last one, two, ... ``depth`` labels of a host, each joined up."""
    labels = F.split(host, r"\.")
    sizes = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(depth)))
    return F.transform(sizes, lambda k: F.array_join(F.slice(labels, -k, k), "."))


def candidates(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, _rules``: the rules of each host or one it lies under, the longest first.

    Of rules equal in length that of the longer host comes first, then ``block``.  Hosts without a
    rule are left out.  Only as many labels of a host are looked at as the rules have."""
    split = F.regexp_extract("rule", r"^[^/]*", 0)
    listed = rules.distinct().withColumns({"_at": split, "_path": F.substring("rule", F.length(split) + 1, F.length("rule"))})
    depth = listed.agg(F.max(F.size(F.split("_at", r"\.")))).first()[0] or 1
    order = F.struct(
        (-F.length("rule")).alias("length"), (-F.length("_at")).alias("at"), (F.col("verdict") != "block").alias("allows"),
        F.col("rule"), F.col("_path").alias("path"), F.col("verdict"),
    )
    own = hosts.select("host", F.explode(_tails(F.col("host"), depth)).alias("_at"))
    return own.join(listed, "_at").groupBy("host").agg(F.array_sort(F.collect_list(order)).alias("_rules"))


def domains(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``hosts`` with ``_domain`` (the registered one) and ``_suffix``; user names and ports do not count.

    An address in digits is its own domain and has no suffix."""
    plain = F.regexp_replace(F.regexp_replace("host", r"^.*@", ""), r":[0-9]*$", "")
    labels = F.split(plain, r"\.")
    last = lambda k: F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(k)), F.least(F.size(labels), F.lit(k))), ".")
    digits = plain.rlike(r"^([0-9.]*|\[.*\])$")
    double = last(2).isin(*suffixes) if suffixes else F.lit(False)
    return hosts.withColumns(
        {
            "_domain": F.when(digits, plain).when(double, last(3)).otherwise(last(2)),
            "_suffix": F.when(digits, "").when(double, last(2)).otherwise(last(1)),
        }
    )


def _rho(children: DataFrame) -> float:
    """Correlation of labels within a parent, by moments: by how much the children's bad pages ``k``
    of ``n`` vary beyond chance around their parent's rate ``_k`` of ``_n``.

    One row comes back.  Terms are rounded to decimals first, so their sum does not depend on order."""
    m = (F.col("_k") + 0.5) / (F.col("_n") + 1.0)
    chance = m * (1 - m)
    exact = lambda c: F.sum(c.cast("decimal(38,6)")).cast("double")
    beyond, pairs = children.where("n > 1").agg(
        exact(F.pow(F.col("k") - F.col("n") * m, 2.0) - F.col("n") * chance),
        exact(F.col("n").cast("double") * (F.col("n") - 1) * chance),
    ).first()
    return min(RHO_MOST, max(RHO_LEAST, beyond / pairs)) if pairs else RHO_UNKNOWN


def tails(a: np.ndarray, b: np.ndarray, x: float) -> np.ndarray:
    """Probabilities that beta variables with parameters ``a`` and ``b`` exceed ``x``.

    The continued fraction of the incomplete beta function, from the side on which it converges fast."""
    turned = x > (a + 1) / (a + b + 2)
    p, q = np.where(turned, b, a), np.where(turned, a, b)
    y = np.where(turned, 1.0 - x, x)
    front = [
        math.lgamma(u + v) - math.lgamma(u) - math.lgamma(v) + u * math.log(w) + v * math.log1p(-w) - math.log(u)
        for u, v, w in zip(p.tolist(), q.tolist(), y.tolist())
    ]
    tiny = 1e-300
    c, d = np.ones_like(y), 1.0 - (p + q) * y / (p + 1)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    f, going = d.copy(), np.ones(len(y), bool)
    m = 0
    while going.any():
        m += 1
        even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
        step = np.ones_like(y)
        for part in (even, odd):
            d = 1.0 + part * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + part / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            step = step * d * c if part is odd else step
            f = np.where(going, f * d * c, f)
        going &= np.abs(step - 1.0) > 1e-13
    below = np.exp(front) * f
    return np.where(turned, below, 1.0 - below)


def _below(strength: Column, rho: float) -> Column:
    """Strength of the prior of a child whose parent's rate is known with ``strength``: the beta
    distribution with the variance of both steps together."""
    s = 1.0 / rho - 1.0
    return (strength + 1) * (s + 1) / (strength + s + 1) - 1


def reputations(counts: DataFrame, suffixes: Sequence[str] = SUFFIXES, limit: float = LIMIT) -> DataFrame:
    """``host, n, k, prior_rate, prior_strength, rate, beyond`` from ``host, n, k`` (labelled and bad pages).

    ``rate`` is the posterior mean, ``beyond`` the probability that the host's rate of bad pages exceeds
    ``limit``.  Hosts without labelled pages (n = 0) get what their domain, suffix and all pages say."""
    spark = counts.sparkSession
    hosts = stored(domains(counts, suffixes), "hosts")
    by_domain = stored(hosts.groupBy("_domain", "_suffix").agg(F.sum("n").alias("_nd"), F.sum("k").alias("_kd")), "domains")
    by_suffix = stored(by_domain.groupBy("_suffix").agg(F.sum("_nd").alias("_ns"), F.sum("_kd").alias("_ks")), "suffixes")
    all_n, all_k = by_suffix.agg(F.coalesce(F.sum("_ns"), F.lit(0)), F.coalesce(F.sum("_ks"), F.lit(0))).first()

    in_domain = hosts.join(by_domain, ["_domain", "_suffix"])
    in_suffix = by_domain.join(by_suffix, "_suffix")
    rho_host = _rho(in_domain.select("n", "k", F.col("_nd").alias("_n"), F.col("_kd").alias("_k")))
    rho_domain = _rho(in_suffix.select(F.col("_nd").alias("n"), F.col("_kd").alias("k"), F.col("_ns").alias("_n"), F.col("_ks").alias("_k")))
    rho_suffix = _rho(by_suffix.select(F.col("_ns").alias("n"), F.col("_ks").alias("k"), F.lit(all_n).alias("_n"), F.lit(all_k).alias("_k")))

    def learned(df: DataFrame, n: Column, k: Column) -> DataFrame:
        """The beta distribution ``_m, _t`` (mean, strength) after ``k`` bad pages of ``n``."""
        return df.withColumns({"_m": (F.col("_t") * F.col("_m") + k) / (F.col("_t") + n), "_t": F.col("_t") + n})

    c = F.col
    # What other suffixes, other domains of the suffix, other hosts of the domain say, one after the other.
    known = in_domain.join(by_suffix, "_suffix").withColumns({"_m": F.lit(0.5), "_t": F.lit(1.0)})
    known = learned(known, F.lit(all_n) - c("_ns"), F.lit(all_k) - c("_ks")).withColumn("_t", _below(c("_t"), rho_suffix))
    known = learned(known, c("_ns") - c("_nd"), c("_ks") - c("_kd")).withColumn("_t", _below(c("_t"), rho_domain))
    known = learned(known, c("_nd") - c("n"), c("_kd") - c("k")).withColumn("_t", _below(c("_t"), rho_host))
    known = known.select("host", "n", "k", c("_m").alias("prior_rate"), c("_t").alias("prior_strength"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = batch["prior_rate"] * batch["prior_strength"] + batch["k"]
            good = (1 - batch["prior_rate"]) * batch["prior_strength"] + batch["n"] - batch["k"]
            beyond = tails(bad.to_numpy(float), good.to_numpy(float), limit)
            yield batch.assign(rate=bad / (bad + good), beyond=beyond)

    return known.mapInPandas(run, "host string, n long, k long, prior_rate double, prior_strength double, rate double, beyond double")


def judge(
    df: DataFrame, rules: DataFrame, outcomes: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
    suffixes: Sequence[str] = SUFFIXES, limit: float = LIMIT, sure: float = SURE,
) -> DataFrame:
    """``id, host, path, rule, verdict, rate, beyond`` of every page.

    ``rules`` holds ``rule`` (host and path, such as ``net/es/``) and ``verdict`` (allow or block).
    ``outcomes`` holds labelled pages as ``url, bad`` (boolean, null: not labelled); without it, the pages
    that a rule judges are the labelled ones.  A page without a rule is blocked when its host's rate of bad
    pages exceeds ``limit`` with a probability of at least ``sure``.

    A null url, or one without ``://``, has an empty host and path and is judged by all pages together;
    repeated rows are judged each and count each; very long urls are read whole; further columns are left out;
    an empty table gives an empty result, an empty table of rules leaves all to the reputation, which without any
    labelled page allows.  Pages are shuffled twice at most, by host and without their content; a hot host is
    split by AQE, and counted on the map side."""
    host, path = located(F.col(url_col))
    pages = df.select(F.col(id_col).alias("_id"), host.alias("host"), path.alias("_path"))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("_pages"))
    # Stored, so that the join reads plain rows on both sides and AQE can split a hot host.
    ruled = pages.join(stored(candidates(hosts, rules), "rules"), "host", "left")
    first = F.filter("_rules", lambda r: F.startswith(F.col("_path"), r["path"]))
    ruled = ruled.withColumn("_first", F.get(first, F.lit(0))).select(
        "_id", "host", "_path", F.col("_first.rule").alias("_rule"), F.col("_first.verdict").alias("_verdict")
    )
    ruled = stored(ruled, "ruled")
    if outcomes is None:
        labelled = ruled.select("host", (F.col("_verdict") == "block").alias("bad"))
    else:
        other = outcomes.select(located(F.col("url"))[0].alias("host"), F.col("bad").cast("boolean"))
        labelled = ruled.select("host", F.lit(None).cast("boolean").alias("bad")).unionByName(other)
    counts = labelled.groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("k"))
    known = stored(reputations(counts, suffixes, limit), "reputations").select("host", "rate", "beyond")
    by_host = F.when(F.col("beyond") >= sure, "block").otherwise("allow")
    return ruled.join(known, "host").select(
        F.col("_id").alias(id_col), "host", F.col("_path").alias("path"), F.col("_rule").alias("rule"),
        F.coalesce("_verdict", by_host).alias("verdict"), "rate", "beyond",
    )


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, judged by the fixed rules and the reputation learned from them."""
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))
