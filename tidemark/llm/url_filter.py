"""URL filters: fixed host and path rules, then mined association rules.

Labelled URLs become sets of tokens (scheme, domains, path words, query keys,
...) plus their label; Spark's FP-growth finds the frequent combinations, and
those that imply a block with enough support and confidence become rules.  A
rule is indexed under the rarest of its tokens: only URLs that hold that
token are tested against the whole rule, so no URL meets every rule.

Tokens of the same labelled URLs are mined as one, their representative; a
URL's tokens are mapped to representatives before they are matched, so a URL
that holds any of them meets the same rules as if all were mined.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: So many frequent tokens at most are broadcast; more are joined by key.
BROADCAST_TOKENS = 200_000

_BLOCK = "label=block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with its subdomains and a path prefix."""
    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls; of equally long ones the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(r.host + r.path))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, every domain suffix, path words (numbers
    as ``#``), extension, query keys and pairs, fragment.  Null: no tokens."""
    host, path = host_and_path(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
                           lambda i: F.concat(F.lit("host:"), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    words = F.filter(F.split(F.lower(path), r"[/._-]+"), lambda w: w != "")
    words = F.transform(words, lambda w: F.concat(F.lit("path:"), F.regexp_replace(w, r"[0-9]+", "#")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    keys = F.transform(pairs, lambda p: F.concat(F.lit("key:"), F.substring_index(p, "=", 1)))
    pairs = F.transform(pairs, lambda p: F.concat(F.lit("pair:"), p))
    others = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))),
                     F.when(F.instr(url, "#") > 0, F.concat(F.lit("fragment:"), F.substring_index(url, "#", -1))))
    out = F.array_distinct(F.filter(F.concat(suffixes, words, keys, pairs, others), lambda t: t.isNotNull()))
    return F.when(url.contains("://"), out).otherwise(F.array().cast("array<string>"))


def mine_block_rules(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6) -> DataFrame:
    """``(rule_id, tokens, first, confidence, support)`` from ``labelled(url, block)``: see ``mine``."""
    return mine(labelled, min_support, min_confidence)[0]


def mine(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """``(rule_id, tokens, first, confidence, support)`` from ``labelled(url, block)``, and
    ``(t, stands)``: each frequent token with its representative.

    A rule says: URLs with all ``tokens`` are blocked.  ``first`` is its token
    with the fewest labelled URLs, under which it is indexed.  Of tokens that
    always occur together in the labelled URLs the first stands for all, so a
    frequent URL pattern of many tokens does not multiply into its subsets.
    URLs or labels that are null do not count; repeated rows count as often as
    they come.
    """
    empty = "rule_id long, tokens array<string>, first string, confidence double, support double"
    label = F.when(F.col("block"), F.lit(_BLOCK)).otherwise(F.lit("label=allow"))
    sets = labelled.where("url is not null and block is not null").select(
        F.monotonically_increasing_id().alias("n"), url_tokens(F.col("url")).alias("tokens"), label.alias("label"))
    sets = checkpointed(sets)
    least = math.ceil(min_support * sets.count())
    if not least:
        return (labelled.sparkSession.createDataFrame([], empty),
                labelled.sparkSession.createDataFrame([], "t string, stands string"))
    each = sets.select("n", F.explode("tokens").alias("t"))
    # Tokens of the same URLs (equal counts and two 64-bit digests of the rows): one stands for all.
    alike = (each.groupBy("t").agg(F.count("*").alias("freq"), F.expr("bit_xor(xxhash64(n))").alias("d1"),
                                   F.expr("bit_xor(xxhash64(n, 1))").alias("d2"))
             .where(F.col("freq") >= least))
    alike = checkpointed(alike)
    classes = alike.groupBy("freq", "d1", "d2").agg(F.min("t").alias("stands"), F.collect_list("t").alias("ts"))
    stands = checkpointed(classes.select(F.explode("ts").alias("t"), "stands"))
    kept = stands.where("t = stands").select("t")
    # Frequent tokens: at most the tokens of a URL over the support, whatever the number of URLs.
    side = F.broadcast(kept) if kept.count() <= BROADCAST_TOKENS else kept
    held = each.join(side, "t").groupBy("n").agg(F.collect_list("t").alias("tokens"))
    sets = checkpointed(sets.select("n", "label").join(held, "n", "left").select(
        F.concat(F.coalesce("tokens", F.array().cast("array<string>")), F.array("label")).alias("items")))
    parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence,
                     numPartitions=parts).fit(sets)
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("t"), "freq")
    rules = (model.associationRules.where(F.col("consequent") == F.array(F.lit(_BLOCK)))
             .where(~F.array_contains("antecedent", "label=allow"))
             .select(F.array_sort("antecedent").alias("tokens"), "confidence", "support"))
    rules = rules.withColumn("rule_id", F.xxhash64("tokens"))
    first = (rules.select("rule_id", F.explode("tokens").alias("t")).join(single, "t")
             .groupBy("rule_id").agg(F.min(F.struct("freq", "t")).alias("least")))
    return checkpointed(rules.join(first, "rule_id").select(
        "rule_id", "tokens", F.col("least.t").alias("first"), "confidence", "support")), stands


def match_rules(urls: DataFrame, rules: DataFrame, stands: DataFrame) -> DataFrame:
    """``(url, tokens, confidence)``: the best rule of each distinct URL that one fits.

    A URL's tokens count as their representatives (``stands``); others are in no rule.  Best is the highest confidence, then support, then the first token list in order."""
    each = urls.where("url is not null").select("url").distinct().select("url", F.explode(url_tokens(F.col("url"))).alias("t"))
    side = F.broadcast(stands) if stands.count() <= BROADCAST_TOKENS else stands
    sets = each.join(side, "t").groupBy("url").agg(F.collect_set("stands").alias("have"))
    probe = sets.withColumn("t", F.explode("have"))
    hits = (probe.join(rules, F.col("t") == F.col("first"))
            .where(F.size(F.array_except("tokens", "have")) == 0))
    best = F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "tokens")).alias("best")
    return hits.groupBy("url").agg(best).select("url", "best.tokens", (-F.col("best.c")).alias("confidence"))


def url_filter(pages: DataFrame, rules: list[Rule], labelled: DataFrame, min_support: float = 0.002,
               min_confidence: float = 0.6, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined, confidence)`` for every row.

    A fixed rule decides; otherwise a mined rule blocks, else the page is
    allowed.  ``mined`` and ``confidence``: the mined rule that decided.  Null
    URLs and those without ``://`` have empty host and path and are allowed;
    null or repeated ids and repeated rows are passed through; without labels
    nothing is mined; extra columns are ignored.
    """
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), url.alias("url"))
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "fixed": verdict})
    mined = match_rules(rows.where("rule is null"), *mine(labelled, min_support, min_confidence))
    mined = mined.select(F.col("url").alias("u"), F.array_join("tokens", " ").alias("mined"), "confidence")
    out = rows.join(mined, (F.col("url") == F.col("u")) & F.col("rule").isNull(), "left")
    return out.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("fixed", F.when(F.col("mined").isNotNull(), "block"), F.lit("allow")).alias("verdict"),
        "mined", "confidence")
