"""URL filters: host-suffix and path-prefix expressions against a list of rules."""

from pyspark.sql import functions as F

PREFIX_HEX = 8


def url_parts(url):
    """(host, path) of a URL column: the host A-Z lower-cased; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _folder(path):
    """The path up to its last slash, that included; empty without one."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _suffixes(host, most):
    """The host and its parents of at most ``most`` labels, as text after label boundaries."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.greatest(F.lit(1), n - (most - 1)), n),
        lambda i: F.array_join(F.slice(labels, i, n), "."),
    )


def _prefixes(path, most):
    """The empty path and the path up to each of its first ``most`` slashes."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most))),
        lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, 1, i), "/"), F.lit("/"))),
    )


def _expression(host, path):
    return F.concat(host, F.lit("\n"), path)


def judge_urls(pages, rules, id_column="page_id", url_column="url", otherwise="allow"):
    """One row per page: id, host, path, rule, verdict.

    ``rules`` has columns host, path and verdict (allow or block). A rule fits
    its host and all subdomains if the URL's path starts with the rule's path.
    Each distinct (host, path) is expanded into every host suffix with every
    path prefix that ends in a slash, of no more labels and slashes than any
    rule has, as longer ones meet none; a rule is listed under its host and its
    path up to the last slash. Both sides meet on the first 32 bits of the
    SHA-256 of that expression; the full digest and the rest of the path are
    confirmed afterwards. The longest rule (host and path together, then host)
    wins; of equal rules with different verdicts, block does.

    Defined results: a null URL or one without ``://`` has empty host and path,
    no rule and the verdict ``otherwise``. Rules with a null host or path are
    never met. Repeated pages give repeated rows, null ids stay. Other columns
    of either table are ignored, whatever their names. Empty tables give no
    rows, or only verdicts ``otherwise``.

    A host with a third of all pages is reduced to its distinct paths before
    the expansion, and rows come back by a join on (host, path), which
    adaptive execution can split.
    """
    host, path = url_parts(F.col(url_column))
    pages = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    listed = (
        rules.select("host", "path", "verdict")
        .where("host is not null and path is not null and verdict is not null")
        .select(
            F.concat("host", "path").alias("rule"),
            F.col("host").alias("rule_host"),
            F.col("path").alias("rule_path"),
            "verdict",
            F.sha2(_expression(F.col("host"), _folder(F.col("path"))), 256).alias("rule_digest"),
        )
        .withColumn("short", F.left("rule_digest", F.lit(PREFIX_HEX)))
    )
    slashes = F.size(F.split(_folder(F.col("rule_path")), "/")) - 1
    labels, depth = listed.agg(F.max(F.size(F.split("rule_host", r"\."))), F.max(slashes)).first()
    expanded = (
        pages.where("host <> ''")
        .select("host", "path")
        .distinct()
        .withColumn("suffix", F.explode(_suffixes(F.col("host"), labels or 1)))
        .withColumn("prefix", F.explode(_prefixes(F.col("path"), depth or 0)))
        .select("host", "path", F.sha2(_expression(F.col("suffix"), F.col("prefix")), 256).alias("digest"))
        .withColumn("short", F.left("digest", F.lit(PREFIX_HEX)))
    )
    won = (
        expanded.join(listed, "short")
        .where((F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("size"),
                    F.length("rule_host").alias("host_size"),
                    "verdict",
                    "rule",
                )
            ).alias("won")
        )
        .select("host", "path", "won.rule", F.col("won.verdict").alias("found"))
    )
    return pages.join(won, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("found", F.lit(otherwise)).alias("verdict")
    )
