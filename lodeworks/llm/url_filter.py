"""URL filtering by rules and by the reputation of hosts.

Rules settle the pages that they fit. All others are judged by their host: the labelled
pages of a host, a registered domain and a suffix are counted, and beta-binomial priors
shrink the share of bad pages from level to level. A host with few labels is close to its
domain, a domain with few labels to its suffix. How strongly each level is shrunk is
estimated from how much more the groups of that level differ than chance explains. A
host's pages are blocked only if the lower bound of its posterior lies above a limit.

Everything is DataFrame expressions. Pages are reduced to counts per host before any
shuffle, and rules and priors are looked up for hosts, not for pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Public suffixes of two labels that are told from registered domains.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz", "co.za")
#: A key is frequent if it holds this part of all rows, so that this many can be at most.
FREQUENT = 1000
#: Prior observations where the labels tell nothing, and the bounds of the estimate.
STRENGTH, WEAKEST, STRONGEST = 10.0, 1.0, 1000.0


def url_host(url: Column) -> Column:
    """What stands behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _levels(hosts: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    """Add ``domain`` and ``suffix`` of each host, without user and port.

    The suffix is the last label, or the last two if they are a known public suffix; the
    domain has one label more. A host of one label or four numbers is all three.
    """
    bare = F.regexp_replace("host", r"^[^@]*@|:[0-9]*$", "")
    labels = F.split(bare, r"\.")
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    count = F.size(labels)
    width = F.when((count > 2) & last(2).isin(*suffixes), 2).otherwise(1)
    whole = (count <= width) | bare.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return hosts.withColumns(
        {
            "suffix": F.when(whole, bare).when(width == 2, last(2)).otherwise(last(1)),
            "domain": F.when(whole, bare).when((width == 2) & (count > 2), last(3)).otherwise(last(2)),
        }
    )


def _widened(left: DataFrame, right: DataFrame, key: str, share: Column, salt: str) -> DataFrame:
    """``left`` with the columns of ``right``, where a key may hold most rows of ``left``.

    ``share`` is the part of all left rows that have a row's key. Frequent keys, at most
    ``FREQUENT``, go to every task; their rows are then dealt out by ``salt`` instead of
    meeting in one task, and only rows of other keys look for a match there.
    """
    names = [c for c in right.columns if c != key]
    row = F.struct(*names)
    frequent = share * F.lit(FREQUENT) >= 1
    few = right.where(frequent).select(key, row.alias("_few"))
    many = right.where(~frequent).select(F.col(key).alias("_key"), row.alias("_many"))
    scattered = F.concat(F.lit("\x00"), F.xxhash64(salt).cast("string"))
    return (
        left.join(F.broadcast(few), key, "left")
        .withColumn("_own", F.when(F.col("_few").isNull(), F.col(key)).otherwise(scattered))
        .join(many, F.col("_own") == F.col("_key"), "left")
        .withColumn("_found", F.coalesce("_few", "_many"))
        .select(*left.columns, *(F.col(f"_found.{c}").alias(c) for c in names))
    )


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior observations of a level, by the moments of its groups around their priors.

    For ``n`` labels, ``x`` of them bad, the expected square of ``x - n m`` is
    ``n m (1 - m) (1 + (n - 1) r)``; ``r`` is solved for over all groups, and the beta
    prior with that correlation has ``1 / r - 1`` observations.
    """
    n, x = F.col("n"), F.col("x")
    spread = n * mean * (1 - mean)
    told = groups.agg(
        F.sum((x - n * mean) ** 2 - spread).alias("excess"), F.sum((n - 1) * spread).alias("room")
    ).first()
    if not told["room"]:
        return STRENGTH
    correlation = told["excess"] / told["room"]
    if correlation <= 1 / (STRONGEST + 1):
        return STRONGEST
    return max(WEAKEST, 1 / correlation - 1)


def _shrunk(mean: Column, strength: float) -> Column:
    return (F.col("x") + mean * strength) / (F.col("n") + strength)


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``host, n_pages, n, x``: rows, labelled rows and bad ones among these, per host.

    ``pages`` has ``page_id, host`` and ``outcomes`` has ``page_id, bad``.
    """
    known = (
        outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL")
        .groupBy(F.col("page_id").cast("long").alias("_labelled"))
        .agg(F.max("bad").alias("bad"))
    )
    # Rows of one id and host are one row before they are shuffled.
    rows = pages.where("page_id IS NOT NULL").groupBy("page_id", "host").agg(F.count("*").alias("n"))
    labelled = rows.join(known, F.col("page_id") == F.col("_labelled")).select(
        "host", F.lit(0).cast("long").alias("n_pages"), "n", F.when(F.col("bad"), F.col("n")).otherwise(0).alias("x")
    )
    nothing = F.lit(0).cast("long")
    return (
        pages.select("host", F.lit(1).cast("long").alias("n_pages"), nothing.alias("n"), nothing.alias("x"))
        .unionByName(labelled)
        .groupBy("host")
        .agg(*(F.sum(c).alias(c) for c in ("n_pages", "n", "x")))
    )


def reputations(
    counts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES, deviations: float = 1.645
) -> DataFrame:
    """Posterior share of bad pages for every host of ``host, n_pages, n, x``.

    Returns these and ``domain, suffix``, the posterior mean ``bad_mean`` and its lower
    bound ``bad_least``: the mean less ``deviations`` standard deviations of the beta
    posterior. No labels at all leave every host at one half.
    """
    hosts = staged(_levels(counts, suffixes), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).first()
    root = F.lit(((total["x"] or 0) + 1) / ((total["n"] or 0) + 2))

    counted = [F.count("*").alias("members"), F.sum("n").alias("n"), F.sum("x").alias("x")]
    domains = staged(hosts.groupBy("domain", "suffix").agg(*counted), "domains")
    by_suffix = domains.groupBy("suffix").agg(*counted)
    strength = _strength(by_suffix, root)
    n_domains = F.lit(float(max(domains.count(), 1)))
    domains = _widened(
        domains,
        by_suffix.select("suffix", _shrunk(root, strength).alias("suffix_mean"),
                         F.col("members").alias("suffix_members")),
        "suffix",
        F.col("suffix_members") / n_domains,
        "domain",
    )
    domains = staged(domains, "domain-priors")
    strength = _strength(domains, F.col("suffix_mean"))
    n_hosts = F.lit(float(max(hosts.count(), 1)))
    hosts = _widened(
        hosts,
        domains.select("domain", _shrunk(F.col("suffix_mean"), strength).alias("domain_mean"),
                       F.col("members").alias("domain_members")),
        "domain",
        F.col("domain_members") / n_hosts,
        "host",
    )
    hosts = staged(hosts, "host-priors")
    strength = _strength(hosts, F.col("domain_mean"))
    mean = _shrunk(F.col("domain_mean"), strength)
    variance = mean * (1 - mean) / (F.col("n") + strength + 1)
    return hosts.select(
        "host", "domain", "suffix", "n_pages", "n", "x",
        mean.alias("bad_mean"),
        F.greatest(F.lit(0.0), mean - deviations * F.sqrt(variance)).alias("bad_least"),
    )


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """For each host the rules of its own name and of all it is a subdomain of, longest first."""
    labels = F.split("host", r"\.")
    names = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    wanted = rules.select(
        F.col("host").alias("name"),
        F.struct(
            (-F.length(F.concat("host", "path"))).alias("order"),
            F.col("verdict"),
            F.col("path"),
            F.concat("host", "path").alias("rule"),
        ).alias("entry"),
    )
    return (
        hosts.select("host", F.explode(names).alias("name"))
        .join(wanted, "name")
        .groupBy("host")
        .agg(F.sort_array(F.collect_set("entry")).alias("rules"))
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: DataFrame,
    *,
    limit: float = 0.5,
    deviations: float = 1.645,
    suffixes: tuple[str, ...] = SUFFIXES,
) -> DataFrame:
    """A verdict on every row of ``page_id, url``; further columns are not read.

    ``outcomes`` has ``page_id, bad`` (repeated ids: bad if any row says so; null ids and
    null outcomes tell nothing). ``rules`` has ``host, path, verdict`` (``allow`` or
    ``block``): a rule fits its host and all subdomains where the path starts with the
    rule's; of several the longest wins, of equally long ones ``allow``; null hosts never
    fit, a null path is empty. Pages that no rule fits are blocked if their host's posterior share
    of bad pages is above ``limit`` with the certainty of ``deviations``, else allowed.

    Returns ``page_id, host, path, rule, verdict, bad_mean, bad_least``. A null URL, or one
    without ``://``, has an empty host and path, and such pages are judged as one host.
    Repeated rows are judged and counted one by one; no pages, no rows.
    """
    parsed = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    )
    counts = host_counts(parsed, outcomes)
    hosts = staged(reputations(counts, suffixes, deviations), "reputations")
    n_pages = F.lit(float(max(hosts.agg(F.sum("n_pages")).first()[0] or 0, 1)))
    wanted = rules.where("host IS NOT NULL").select("host", F.coalesce("path", F.lit("")).alias("path"), "verdict")
    told = hosts.join(_host_rules(hosts, wanted), "host", "left").select(
        "host", "n_pages", "bad_mean", "bad_least", "rules"
    )
    told = staged(told, "host-verdicts")
    own = parsed.withColumn("salt", F.xxhash64("page_id", "path"))
    fits = F.get(F.filter("rules", lambda x: F.startswith(F.col("path"), x["path"])), F.lit(0))
    method = F.when(F.col("bad_least") > limit, "block").otherwise("allow")
    return (
        _widened(own, told, "host", F.col("n_pages") / n_pages, "salt")
        .withColumn("fits", fits)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fits.rule").alias("rule"),
            F.coalesce("fits.verdict", method).alias("verdict"),
            "bad_mean",
            "bad_least",
        )
    )
