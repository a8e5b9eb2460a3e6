"""Host reputation by empirical Bayes: labelled pages, shrunk from host to registered domain to suffix to all pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from terraquilt.session import broadcast_if_small

#: Some suffixes of two labels under which anybody registers names, registries' and hosting services'; others have one
#: label. A fixed, partial list: give ``suffixes`` for more.
MORE_LABEL_SUFFIXES = (
    "ac.jp", "ac.nz", "ac.uk", "ac.za", "asn.au", "blogspot.com", "cloudfront.net", "co.id", "co.il", "co.in", "co.jp", "co.ke", "co.kr",
    "co.nz", "co.th", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.co", "com.eg", "com.hk", "com.mx", "com.my", "com.ng",
    "com.pe", "com.ph", "com.pk", "com.pl", "com.sa", "com.sg", "com.tr", "com.tw", "com.ua", "com.ve", "com.vn", "edu.au", "edu.cn",
    "firebaseapp.com", "github.io", "gitlab.io", "go.jp", "gov.au", "gov.br", "gov.cn", "gov.in", "gov.uk", "herokuapp.com", "me.uk",
    "ne.jp", "net.au", "net.br", "net.cn", "net.nz", "netlify.app", "nhs.uk", "or.jp", "or.kr", "org.au", "org.br", "org.cn", "org.nz",
    "org.uk", "pages.dev", "sch.uk", "vercel.app", "web.app", "wordpress.com",
)
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = "://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def site_of(host: Column) -> Column:
    """The host without user part and port, as its groups have it; it stays what it is in results."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def _is_address(site: Column) -> Column:
    return site.rlike("^[0-9]{1,3}([.][0-9]{1,3}){3}$") | site.startswith("[")


def _labels_of_suffix(site: Column, suffixes: Sequence[str]) -> Column:
    """How many labels the longest known suffix has that is not all of the site; 1 without one."""
    by_labels: dict[int, list[str]] = {}
    for suffix in suffixes:
        by_labels.setdefault(suffix.count(".") + 1, []).append(suffix)
    found = F.lit(1)
    for labels in sorted(by_labels):
        tail = F.substring_index(site, ".", -labels)
        found = F.when(tail.isin(*by_labels[labels]) & (site != tail), labels).otherwise(found)
    return found


def _last(site: Column, labels: Column) -> Column:
    return F.array_join(F.slice(F.split(site, "[.]"), -F.least(labels, F.size(F.split(site, "[.]"))), labels), ".")


def suffix_of(host: Column, suffixes: Sequence[str] = MORE_LABEL_SUFFIXES) -> Column:
    """The suffix of a host without its port and user; an address is its own."""
    site = site_of(host)
    return F.when(_is_address(site), site).otherwise(_last(site, _labels_of_suffix(site, suffixes)))


def domain_of(host: Column, suffixes: Sequence[str] = MORE_LABEL_SUFFIXES) -> Column:
    """The suffix and one label before it; a host without more labels, and an address, is its own domain."""
    site = site_of(host)
    return F.when(_is_address(site), site).otherwise(_last(site, _labels_of_suffix(site, suffixes) + 1))


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest (host, path, verdict) that fits, or NULL.

    A rule fits its host and all hosts below it, if the path starts with the rule's.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in ranked
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _concentration(counts: DataFrame, group: str) -> DataFrame:
    """One row: the prior strength of a level, from the spread of its groups' rates (moments of the beta-binomial).

    The correlation is held between 0.001 and 0.5, so a prior weighs as 1 to 999 pages.
    """
    groups = counts.groupBy(group).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where(F.col("n") > 0)
    p = F.col("p")
    total = groups.agg((F.sum("bad") / F.sum("n")).alias("p"))
    spread = groups.crossJoin(F.broadcast(total)).agg(  # one row
        F.first("p").alias("p"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2)).alias("s"),
        (F.count(F.lit(1)) - 1).alias("free"),
        (F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("m"),
    )
    pq = p * (F.lit(1.0) - p)
    rho = (F.col("s") / pq - F.col("free")) / (F.col("m") - F.col("free"))
    usable = (pq > 0) & (F.col("m") > F.col("free"))
    rho = F.least(F.greatest(F.when(usable, rho).otherwise(F.lit(0.001)), F.lit(0.001)), F.lit(0.5))
    return spread.select((F.lit(1.0) / rho - F.lit(1.0)).alias("strength"))


def host_posteriors(pages: DataFrame, z: float = 1.645, suffixes: Sequence[str] = MORE_LABEL_SUFFIXES) -> DataFrame:
    """Per host of ``pages`` (host, bad: 1, 0 or NULL without a label): n, bad, mean, lower.

    A level's groups are taken as draws from a beta distribution around the posterior mean of the
    level above: all pages, suffix, domain, host. Its strength comes from all groups of the level. mean is the
    posterior mean of the host's bad rate, lower its bound at z standard deviations below.
    Without a label at all the mean is 0.5 with the strength of one page. Pages are summed by
    host before anything else, so no host meets in one task.
    """
    hosts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn(
        "suffix", suffix_of(F.col("host"), suffixes)
    )
    hosts = hosts.checkpoint()
    everything = hosts.agg(((F.sum("bad") + F.lit(0.5)) / (F.sum("n") + F.lit(1.0))).alias("prior"))
    level = hosts.crossJoin(F.broadcast(everything))
    for name in ("suffix", "domain", "host"):
        strength = _concentration(hosts, name)
        sums = hosts.groupBy(name).agg(F.sum("n").alias("_n"), F.sum("bad").alias("_bad"))
        level = level.join(sums, name).crossJoin(F.broadcast(strength)).withColumn(
            "_a", F.col("_bad") + F.col("prior") * F.col("strength")
        ).withColumn("_b", F.col("_n") - F.col("_bad") + (F.lit(1.0) - F.col("prior")) * F.col("strength"))
        level = level.withColumn("prior", F.col("_a") / (F.col("_a") + F.col("_b")))
        if name != "host":
            level = level.drop("_n", "_bad", "strength", "_a", "_b")
    total = F.col("_a") + F.col("_b")
    deviation = F.sqrt(F.col("_a") * F.col("_b") / (total * total * (total + F.lit(1.0))))
    return level.select("host", "n", "bad", F.col("prior").alias("mean"), (F.col("prior") - F.lit(z) * deviation).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = (), limit: float = 0.5,
               z: float = 1.645, key: str = "page_id", url: str = "url", suffixes: Sequence[str] = MORE_LABEL_SUFFIXES) -> DataFrame:
    """Verdict for every page: its longest rule's, else block where the host's bad rate is surely over ``limit``.

    ``outcomes`` has ``key`` and bad (0 or 1), for some pages; keys there must be unique. A page
    whose key is NULL has no outcome. A NULL url, or one without ``://``, has an empty host and path,
    which is judged as a host like any other. For the groups above it a host counts without user part
    and port, an address is a domain of its own, and ``suffixes`` are those of more than one label. Only the named columns are
    read and returned.
    """
    parsed = pages.select(
        F.col(key).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    marked = parsed.select("page_id", "host").join(
        outcomes.select(F.col(key).alias("page_id"), F.col("bad").cast("long").alias("bad")), "page_id", "left"
    )
    hosts = broadcast_if_small(host_posteriors(marked, z, suffixes).select("host", "mean", "lower"))
    judged = parsed.join(hosts, "host").withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("lower") > F.lit(limit), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        F.col("page_id").alias(key), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), F.col("mean").alias("bad_rate"), F.col("lower").alias("bad_rate_lower"),
    )


def outcomes_from_labels(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Outcomes of pages whose url ends in the number of a labelled document: bad if its quality is 0 or it is toxic."""
    number = F.regexp_extract(url_path(F.col(url)), "/([0-9]{1,18})(?:[.]html|/)?$", 1)
    named = pages.select(F.col(key), F.when(number != "", number.cast("long")).alias("doc_id"))
    known = labels.where(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")
    )
    return named.join(known, "doc_id").groupBy(key).agg(F.max("bad").alias("bad"))
