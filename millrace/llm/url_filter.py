"""URL filters: allow and block rules matched to urls by a sort-merge range join.

A rule is a host with all its subdomains and a path prefix. Both become one canonical
key, the host's labels in reverse order, a separator and the path::

    example.com, /en/   ->   com.example.\\0/en/

A url gives one probe key for each of its host's suffixes (``com.``, ``com.example.``
...). A rule fits the url exactly if its key is a prefix of one of these probes, that
is, if the probe lies in the interval of keys that start with the rule's key. Such
intervals are nested or disjoint, so one pass over rules and probes in key order is
enough: the sweep carries the rule that began last with the stack of rules around it,
and those of the stack that have ended by the probe's key are popped.

The probes are dealt evenly to cells by a hash of the url and not by host, so a host
with a third of all urls makes no hot task; each cell gets its own copy of the rules,
which are the small side. Everything is DataFrame functions.

Defined cases
  * null url, or no ``://``: host and path are empty, no rule fits;
  * A-Z of the host are lower-cased, nothing else is; a port is part of the host;
  * the path may be empty, and then a rule with path ``/`` does not fit;
  * among fitting rules the longest host and path together wins, then the longer host,
    then block before allow;
  * rules with a null host, null verdict or empty host fit nothing, a null path is an empty one;
  * repeated rows, null ids: one result row for each input row; no rows: no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
_SEPARATOR = "\u0000"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _suffix_keys(host: Column) -> Column:
    """``com.``, ``com.example.``, ...: the reversed keys of all suffixes of a host, shortest first."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.concat(F.array_join(F.slice(labels, F.lit(1), i), "."), F.lit(".")),
    )


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """One row per rule key with the stack of rules whose interval encloses it, itself included."""
    path = F.coalesce(F.col("path"), F.lit(""))
    host = F.translate(F.col("host"), string.ascii_uppercase, string.ascii_lowercase)
    clean = (
        rules.where(F.col("host").isNotNull() & (F.col("host") != "") & F.col("verdict").isNotNull())
        .select(F.element_at(_suffix_keys(host), -1).alias("host_key"), path.alias("path"),
                F.concat(host, path).alias("rule"), F.col("verdict"), F.length(host).alias("host_length"))
        .withColumn("entry", F.struct(
            F.length("rule").alias("length"), F.col("host_length"), (F.col("verdict") == BLOCK).alias("blocks"),
            F.concat("host_key", F.lit(_SEPARATOR), "path").alias("key"), F.col("rule"), F.col("verdict")))
    )
    entries = clean.groupBy("host_key", "path").agg(F.max("entry").alias("entry"))
    outer = entries.select("host_key", F.col("path").alias("prefix"), F.col("entry").alias("enclosing"))
    inner = entries.select("host_key", "path", F.explode(F.transform(
        F.sequence(F.lit(0), F.length("path")), lambda n: F.substr(F.col("path"), F.lit(1), n))).alias("prefix"))
    return (
        inner.join(outer, ["host_key", "prefix"]).groupBy("host_key", "path")
        .agg(F.collect_list("enclosing").alias("stack"))
        .select(F.concat("host_key", F.lit(_SEPARATOR), "path").alias("key"), "stack")
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, default: str = ALLOW,
    id_col: str = "page_id", url_col: str = "url", cells: int | None = None,
) -> DataFrame:
    """Id, host, path, winning rule (host and path, or null) and verdict for every row of `pages`.

    `rules` has host, path and verdict (allow or block). `cells` is the number of
    independent sweeps, by default the session's number of shuffle partitions.
    """
    cells = cells or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    host, path = url_parts(F.col("url"))
    urls = (
        pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
        .withColumns({"cell": F.pmod(F.xxhash64("id", "url"), F.lit(cells)), "host": host, "path": path})
        .drop("url")
    )
    probes = urls.select("*", F.posexplode(_suffix_keys(F.col("host"))).alias("suffix", "suffix_key")).select(
        "cell", F.concat("suffix_key", F.lit(_SEPARATOR), "path").alias("key"), F.lit(1).alias("kind"),
        "id", "host", "path", "suffix", F.lit(None).cast(_stack_type()).alias("stack"))
    starts = _rule_stacks(rules).select(
        F.explode(F.sequence(F.lit(0), F.lit(cells - 1)).cast("array<bigint>")).alias("cell"), "key", F.lit(0).alias("kind"),
        F.lit(None).cast(urls.schema["id"].dataType).alias("id"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), F.lit(None).cast("int").alias("suffix"), "stack")
    sweep = (
        Window.partitionBy("cell").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    active = F.filter("stack", lambda entry: F.startswith(F.col("key"), entry["key"]))
    best = (
        starts.unionByName(probes).withColumn("stack", F.last("stack", ignorenulls=True).over(sweep))
        .where("kind = 1").withColumn("best", F.array_max(active))
        # the same cells: no further shuffle; a url's first suffix counts its repeated rows
        .groupBy("cell", "id", "host", "path").agg(
            F.max("best").alias("best"), F.sum((F.col("suffix") == 0).cast("int")).alias("copies"))
    )
    return best.select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def _stack_type() -> str:
    return ("array<struct<length:int,host_length:int,blocks:boolean,key:string,rule:string,verdict:string>>")
