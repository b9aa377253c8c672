"""URL filters: rules are intervals of reversed-host keys, met by a sorted sweep."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import stored
from marketbars.session import work_dir

ALLOW, BLOCK = "allow", "block"
# What urls get that no rule fits.
DEFAULT = ALLOW
# Places swept in one sorted run, unless a host has more rules than that.
RUN = 2000
OPENS, PLACE, CLOSES = 0, 1, 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(url, "://([^/?#]*)", 1)
    lowered = F.translate(found, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def key_of(reversed_labels: Column) -> Column:
    """``org.example.`` of example.org; the keys of its subdomains begin with it."""
    return F.concat(F.array_join(reversed_labels, "."), F.lit("."))


def _one_each(rules: DataFrame) -> DataFrame:
    """base (reversed-host key), path, rule, verdict, size; of equal rules a blocking one wins."""
    host = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    return (
        rules.select(host.alias("host"), "path", "verdict")
        .dropna()
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            key_of(labels(F.col("host"))).alias("base"),
            "path",
            F.concat("host", "path").alias("rule"),
            "verdict",
            F.length(F.concat("host", "path")).alias("size"),
            F.length("host").alias("host_size"),
        )
    )


def _sweep(probes: DataFrame, rules: DataFrame, runs: DataFrame) -> DataFrame:
    """Every place below a rule, with the innermost rule around it.

    In the order of the keys a rule opens at its own key and closes behind all keys that begin
    with it, so that rules are nested or apart. The number of open rules is the height of the
    stack; the rule on top is the last that opened at this height.
    """
    no_rule = F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>")
    places = probes.join(runs, "base").select(
        "base",
        F.pmod(F.xxhash64("host", "path"), F.col("n_runs")).alias("run"),
        F.concat("base", "path").cast("binary").alias("key"),
        F.lit(PLACE).alias("kind"),
        F.lit(0).alias("step"),
        no_rule.alias("opened"),
        "host",
        "path",
    )
    opened = F.struct("size", "host_size", "rule", "verdict")
    key = F.concat("base", "path").cast("binary")
    # No text holds the byte 0xFF: behind every key that begins with the rule's.
    behind = F.concat(key, F.unhex(F.lit("FF")))
    turns = F.array(
        F.struct(key.alias("key"), F.lit(OPENS).alias("kind"), F.lit(1).alias("step")),
        F.struct(behind.alias("key"), F.lit(CLOSES).alias("kind"), F.lit(-1).alias("step")),
    )
    turned = (
        rules.join(runs, "base")
        .withColumn("run", F.explode(F.sequence(F.lit(0), F.col("n_runs") - 1)))
        .withColumn("turn", F.explode(turns))
    )
    bounds = turned.select(
        "base",
        "run",
        "turn.key",
        "turn.kind",
        "turn.step",
        F.when(F.col("turn.kind") == OPENS, opened).alias("opened"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
    )
    swept = Window.partitionBy("base", "run").orderBy("key", "kind")
    same_height = Window.partitionBy("base", "run", "height").orderBy("key", "kind")
    so_far = Window.unboundedPreceding, Window.currentRow
    return (
        places.unionByName(bounds)
        .withColumn("height", F.sum("step").over(swept.rowsBetween(*so_far)))
        .filter((F.col("height") > 0) & (F.col("kind") != CLOSES))
        .withColumn("top", F.last("opened", True).over(same_height.rowsBetween(*so_far)))
        .filter(F.col("kind") == PLACE)
        .select("host", "path", "top")
    )


def judge(
    pages: DataFrame, rules: DataFrame, default: str = DEFAULT, run: int = RUN
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains
    if the url's path starts with the rule's; of several the longest (host and path together, then
    the longer host) wins. ``rule`` is host and path of the winner, null where none fits and
    ``default`` holds.

    Rules and urls meet as keys of reversed hosts and paths, a url once for each of its parent
    domains that has rules, in runs sorted by key. A domain with more than ``run`` different
    places is dealt to several runs, each with all rules of the domain: at most twice as many
    rows as places and rules together. Repeated urls are settled once and joined back.

    A null url, or one without ``://``, has an empty host and path. Repeated rows, null page_ids
    and equal ones are kept as they are. Rules with a null are left out, of equal ones with
    different verdicts the blocking one holds. Without rules all urls get ``default``; an empty
    table gives no rows. Other columns are not read.
    """
    spark = pages.sparkSession
    folder = work_dir(spark, "url-rules")
    urls = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    rules = stored(_one_each(rules), f"{folder}/rules")
    parts = F.size(F.split("base", r"\.")) - 1
    deepest = rules.agg(F.max(parts)).first()[0]
    if deepest is None:
        none = F.lit(None).cast("string")
        return urls.withColumns({"rule": none, "verdict": F.lit(default)})
    ruled = stored(rules.groupBy("base").agg(F.count("*").alias("n_rules")), f"{folder}/ruled")
    # A parent domain of more labels than any rule has need not be looked up.
    parents = F.transform(
        F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(deepest))),
        lambda n: key_of(F.slice("labels", 1, n)),
    )
    probes = (
        urls.select("host", "path")
        .distinct()
        .withColumn("labels", labels(F.col("host")))
        .select("host", "path", F.explode(parents).alias("base"))
        .join(ruled.select("base"), "base")
    )
    probes = stored(probes, f"{folder}/probes")
    wide = F.greatest(F.lit(run), F.col("n_rules"))
    runs = (
        probes.groupBy("base")
        .agg(F.count("*").alias("held"))
        .join(ruled, "base")
        .select("base", F.ceil(F.col("held") / wide).alias("n_runs"))
    )
    swept = _sweep(probes, rules, stored(runs, f"{folder}/runs"))
    best = stored(
        swept.groupBy("host", "path").agg(F.max("top").alias("top")), f"{folder}/best"
    )
    return urls.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("top.rule").alias("rule"),
        F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )
