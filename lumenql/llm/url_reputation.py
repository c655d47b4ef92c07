"""URL filtering by explicit rules and an empirical-Bayes host reputation, DataFrame expressions only.

Labelled page outcomes (good or not) are counted by host, registered domain and suffix.
A level's rates scatter around its parent's; how much gives the parent's beta prior its
weight: from pairs of outcomes of one child,
``sum k(k-1) / sum n(n-1) = p*p + rho*p*(1-p)`` and the weight is ``1/rho - 1``. The
posterior of a host is shrunk to its domain's, that to its suffix's, that to all pages'.
A page is blocked if, by its beta posterior, the good rate lies below the least rate with
the wanted probability; the posterior's distribution function is a continued fraction,
expanded in SQL expressions. Counts are whole numbers, so the result does not depend on
the order of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log, pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bind, materialize

#: Suffixes of two labels under which domains are registered; a parameter, a few dozen in practice.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(verdict, host, slash + path)


@dataclass(frozen=True)
class Prior:
    """Least good rate, posterior probability that blocks, and the range of a prior's weight."""

    least: float = 0.75
    certainty: float = 0.8
    weakest: float = 1.0
    strongest: float = 200.0


def _log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive number, by Stirling's series eight places up."""
    w = z + 8
    rising = F.log(z)
    for k in range(1, 8):
        rising = rising + F.log(z + k)
    return (w - 0.5) * F.log(w) - w + F.lit(0.5 * log(2 * pi)) + 1 / (12 * w) - 1 / (360 * w * w * w) + 1 / (1260 * w * w * w * w * w) - rising


def _fraction(x: Column, a: Column, b: Column) -> Column:
    """The incomplete beta function's continued fraction at ``x`` below the mean, by Lentz's method."""
    tiny = F.lit(1e-300)
    safe = lambda v: F.when(F.abs(v) < tiny, tiny).otherwise(v)
    steps = F.sequence(F.lit(1), (F.ceil(5 * F.sqrt(F.greatest(a, b))) + 50).cast("int"))

    def step(acc: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        one = F.struct((1 / safe(1 + even * acc["d"])).alias("d"), safe(1 + even / acc["c"]).alias("c"), acc["h"].alias("h"))

        def then(s: Column, coefficient: Column) -> Column:
            return bind(F.struct((1 / safe(1 + coefficient * s["d"])).alias("d"), safe(1 + coefficient / s["c"]).alias("c"), s["h"].alias("h")), lambda t: F.struct(t["d"].alias("d"), t["c"].alias("c"), (t["h"] * t["d"] * t["c"]).alias("h")))

        return bind(bind(one, lambda t: F.struct(t["d"].alias("d"), t["c"].alias("c"), (t["h"] * t["d"] * t["c"]).alias("h"))), lambda t: then(t, odd))

    first = 1 / safe(1 - (a + b) * x / (a + 1))
    zero = F.struct(first.alias("d"), F.lit(1.0).alias("c"), first.alias("h"))
    return F.aggregate(steps, zero, step, lambda acc: acc["h"])


def below(least: float, a: Column, b: Column) -> Column:
    """The chance that a Beta(a, b) rate lies below ``least``; a rate without spread lies at its end."""

    def at(v: Column) -> Column:
        x, y = F.lit(float(least)), F.lit(1 - float(least))
        front = F.exp(v["a"] * F.log(x) + v["b"] * F.log(y) + _log_gamma(v["a"] + v["b"]) - _log_gamma(v["a"]) - _log_gamma(v["b"]))
        lower = x * (v["a"] + v["b"] + 2) < v["a"] + 1
        return F.when(lower, front * _fraction(x, v["a"], v["b"]) / v["a"]).otherwise(1 - front * _fraction(y, v["b"], v["a"]) / v["b"])

    inside = bind(F.struct(a.alias("a"), b.alias("b")), at)
    return F.when(a <= 0, F.lit(1.0)).when(b <= 0, F.lit(0.0)).otherwise(inside)


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls; of equal rules the last one counts.

    Rules are parameters, and each is an expression of the plan.
    """
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def levels(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix of a host, its port left out."""
    parts = F.split(F.regexp_replace(host, r":[0-9]*$", ""), r"\.")
    last = lambda n: F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")
    two = last(2).isin(*TWO_LABEL_SUFFIXES)
    return F.when(two, last(3)).otherwise(last(2)), F.when(two, last(2)).otherwise(last(1))


def _weight(n: Column, k: Column, nn: Column, kk: Column, prior: Prior) -> Column:
    """Weight of the prior that a level gives to its children, from their paired outcomes."""
    p = k / n
    rho = (kk / nn - p * p) / (p * (1 - p))
    least, most = 1 / (prior.strongest + 1), 1 / (prior.weakest + 1)
    rho = F.when((nn > 0) & (p > 0) & (p < 1), F.least(F.greatest(rho, F.lit(least)), F.lit(most))).otherwise(F.lit(least))
    return 1 / rho - 1


def reputation(outcomes: DataFrame, prior: Prior = Prior()) -> dict[str, DataFrame]:
    """Posterior mean and weight (pseudo-counts) at each level: ``all``, ``suffix``, ``domain``, ``host``.

    ``outcomes`` has ``host`` and ``good`` (0 or 1); rows with a null or an empty host do not count.
    """
    rows = outcomes.where("host <> '' and good is not null")
    domain, suffix = levels(F.col("host"))
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("k"))
    hosts, _ = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "host-outcomes")
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1))
    total = lambda d, *by: d.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), pairs("n").alias("nn"), pairs("k").alias("kk"))
    domains, _ = materialize(total(hosts, "domain", "suffix"), "domain-outcomes")
    suffixes, _ = materialize(total(domains, "suffix"), "suffix-outcomes")
    everything = total(suffixes).where("n > 0").select((F.col("k") / F.col("n")).alias("mean"), _weight(F.col("n"), F.col("k"), F.col("nn"), F.col("kk"), prior).alias("down"))

    def shrink(children: DataFrame, parents: DataFrame, on: str | None, own_weight: bool) -> DataFrame:
        up = parents.select(*([F.col(on).alias("__on")] if on else []), F.col("mean").alias("__mean"), F.col("down").alias("__down"))
        both = children.join(up, F.col(on) == F.col("__on")) if on else children.join(F.broadcast(up))
        mean = (F.col("k") + F.col("__down") * F.col("__mean")) / (F.col("n") + F.col("__down"))
        out = both.withColumns({"mean": mean, "weight": F.col("n") + F.col("__down")})
        return out.withColumn("down", _weight(F.col("n"), F.col("k"), F.col("nn"), F.col("kk"), prior)) if own_weight else out

    suffixes, _ = materialize(shrink(suffixes, everything, None, True), "suffixes")
    domains, _ = materialize(shrink(domains, suffixes, "suffix", True), "domains")
    hosts = shrink(hosts, domains, "domain", False)
    pick = lambda d, key: d.select(key, "mean", "weight", *(["down"] if "down" in d.columns else []))
    return {"all": everything, "suffix": pick(suffixes, "suffix"), "domain": pick(domains, "domain"), "host": pick(hosts, "host")}


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], url_col: str = "url", prior: Prior = Prior()) -> DataFrame:
    """Adds ``host, path, rule, verdict`` and ``bad``, the chance that the host's good rate lies below the least.

    A rule's verdict holds where one fits. Otherwise the deepest level that has labels
    speaks: the host, else its domain, its suffix, or all pages; a host without labels of
    its own is a draw from its parent's prior. Without any label all pages are allowed.
    Null, empty and other urls without ``://`` have an empty host and path, fit no rule, and
    are allowed, as they belong to no level; very long ones are read whole. Columns of those five names are replaced, repeated rows
    are judged each, and an empty table gives no row.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    base = pages.drop("host", "path", "rule", "verdict", "bad").withColumns({"host": host, "path": path})
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": name, "__verdict": verdict})
    known = reputation(outcomes, prior)
    domain, suffix = levels(F.col("host"))
    # One row for each host that occurs, so that the levels meet hosts and not pages.
    hosts = base.groupBy("host").agg(F.lit(1).alias("one")).select("host", domain.alias("domain"), suffix.alias("suffix"))
    found = hosts
    for level in ("host", "domain", "suffix"):
        of = known[level].select(F.col(level).alias("__key"), *(F.col(c).alias(f"{level}_{c}") for c in known[level].columns[1:]))
        found = found.join(of, F.col(level) == F.col("__key"), "left").drop("__key")
    top = known["all"].select(F.col("mean").alias("all_mean"), F.col("down").alias("all_down"))
    found = found.join(F.broadcast(top), F.lit(True), "left")
    mean = F.coalesce("host_mean", "domain_mean", "suffix_mean", "all_mean")
    weight = F.coalesce("host_weight", "domain_down", "suffix_down", "all_down")
    told = found.select(F.hash("host").alias("__part"), F.col("host").alias("__host"), F.struct(mean.alias("mean"), weight.alias("weight")).alias("p"))
    bad = F.coalesce(below(prior.least, F.col("p.mean") * F.col("p.weight"), (1 - F.col("p.mean")) * F.col("p.weight")), F.lit(0.0))
    told, _ = materialize(told.select("__part", "__host", bad.alias("bad")), "reputations")
    # Joined on two keys, so that the pages of a frequent host keep an exchange that can be split.
    out = base.join(told, (F.hash("host") == F.col("__part")) & (F.col("host") == F.col("__host")), "left")
    method = F.when((F.col("host") != "") & (F.col("bad") >= prior.certainty), "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("__verdict", method)).drop("__verdict", "__part", "__host")
