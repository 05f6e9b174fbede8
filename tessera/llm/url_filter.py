"""URL filter (operator 1), DataFrame functions only.

A list holds canonical URLs to block and rules (host and path prefix, allow
or block, valid for the host and all its subdomains; the longest fitting
rule wins, then its verdict counts; without a fitting rule a listed URL is
blocked and any other allowed). Every distinct URL is turned into its
possible keys: host suffix + path prefix for the lengths that rules have,
and its canonical form. A blocked Bloom filter over the list's keys (blocks
of 8 words of 64 bits, one bit per word) lets possible hits pass; an exact
hash join with the list removes the false positives.

Scale: equal URLs are judged once (combined map-side); the filter is a table
of blocks, built by bit_or per block, broadcast up to ``BROADCAST_BLOCKS``
rows and joined by block number beyond; keys that do not hit never reach
the exact join; frequent keys there meet a single list row, so their
partition can be split.

Null URLs and URLs without "://" have an empty host and path, fit no rule
and are allowed. Rows may repeat, ids may be null; other columns do not
matter; long URLs are handled whole; an empty table gives an empty result,
an empty list allows everything. Of two rules with the same host and path
the block counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm._store import written

BITS_PER_KEY = 16
BROADCAST_BLOCKS = 1 << 18  # 18 MB of filter
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Query parameters that do not change the page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))


def with_parts(df: DataFrame) -> DataFrame:
    """``url`` taken apart: host (A-Z lower-cased) and path; empty if absent."""
    df = df.withColumn("_rest", F.coalesce(rest(F.col("url")), F.lit("")))
    return (df.withColumn("host", F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), UPPER, LOWER))
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)))


def canonical() -> Column:
    """Canonical form from host, path and _rest: no scheme, www., fragment,
    tracking parameters or closing slash; the other parameters sorted."""
    query = F.regexp_extract("_rest", r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    page = F.regexp_replace(F.regexp_replace("host", r"^www\.", ""), r"\.$", "")
    return F.concat(page, F.regexp_replace("path", r"/+$", ""), F.lit("?"), kept)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) of rule strings like ``example.com/en/``; the host is
    lower-cased, a rule without a slash counts for all paths of its host."""
    return spark.createDataFrame(rules, "rule string, verdict string")


def list_table(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """One row per key: key, rule, verdict, host labels and path length (of
    rules). ``urls`` has a column ``url`` of URLs to block."""
    r = rules.dropna(subset=["rule", "verdict"]).withColumn("_host", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER))
    r = r.withColumn("_path", F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)"))
    r = (r.withColumn("key", F.concat(F.lit("r "), "_host", "_path"))
         .groupBy("key").agg(F.min("rule").alias("rule"), F.max("verdict").alias("verdict"),
                             F.max(F.size(F.split("_host", r"\."))).alias("labels"), F.max(F.length("_path")).alias("length")))
    u = (with_parts(urls.select("url").dropna()).filter("host <> ''").select(F.concat(F.lit("u "), canonical()).alias("key")).distinct()
         .select("key", F.lit(None).cast("string").alias("rule"), F.lit("block").alias("verdict"),
                 F.lit(None).cast("int").alias("labels"), F.lit(None).cast("int").alias("length")))
    return r.unionByName(u)


def place(blocks: int) -> tuple[Column, list[Column]]:
    """The block of column ``key`` and its bit in each of the block's 8 words."""
    return (F.pmod(F.xxhash64("key"), F.lit(blocks)),
            [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64(key, 1), {6 * j}) & 63 AS int))") for j in range(8)])


def bloom(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The filter over n keys: (_block, _w0 .. _w7), and the block count."""
    blocks = max(1, -(-n * BITS_PER_KEY // 512))
    block, bits = place(blocks)
    return (keys.select(block.alias("_block"), *[b.alias(f"_w{j}") for j, b in enumerate(bits)])
            .groupBy("_block").agg(*[F.bit_or(f"_w{j}").alias(f"_w{j}") for j in range(8)])), blocks


def may_contain(keys: DataFrame, filter_: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key may be in the filter."""
    block, bits = place(blocks)
    probed = keys.withColumn("_block", block).join(F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_, "_block")
    hit = F.lit(True)
    for j, b in enumerate(bits):
        hit = hit & (F.col(f"_w{j}").bitwiseAND(b) != 0)
    return probed.filter(hit).select(*keys.columns)


def filter_urls(pages: DataFrame, rules: DataFrame, blocked: DataFrame) -> DataFrame:
    """All columns of ``pages`` (which has ``url``) with host, path, rule
    (null without a fitting one) and verdict; such input columns are replaced."""
    listed = written(list_table(rules, blocked), "url-list")
    n = listed.count()
    # the few numbers of labels and path lengths that rules have
    labels = sorted(x[0] for x in listed.select("labels").dropna().distinct().collect())
    lengths = sorted(x[0] for x in listed.select("length").dropna().distinct().collect())
    filter_, blocks = bloom(listed.select("key"), n)
    urls = with_parts(pages.select("url").dropna().distinct()).filter("host <> ''")
    part = F.split("host", r"\.")
    suffixes = F.array(*[F.when(F.size(part) >= k, F.array_join(F.slice(part, F.greatest(F.size(part) - k + 1, F.lit(1)), F.lit(k)), "."))
                         for k in labels]) if labels else F.array().cast("array<string>")
    prefixes = F.array(*[F.when(F.length("path") >= k, F.expr(f"substring(path, 1, {k})")) for k in lengths]) \
        if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.concat(F.lit("r "), h, p))))
    keys = F.concat(keys, F.array(F.concat(F.lit("u "), canonical())))
    probes = urls.select("url", F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"))
    hits = may_contain(probes, filter_, blocks).join(listed.select("key", "rule", "verdict"), "key")
    # longest rule; a listed URL (no rule) counts least
    found = hits.groupBy("url").agg(F.max(F.struct(
        F.coalesce(F.length("rule"), F.lit(-1)).alias("n"), "verdict", "rule")).alias("_hit"))
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_rest", "_hit")]
    out = with_parts(pages.select(*[F.col(f"`{c}`") for c in own])).join(found, "url", "left")
    return out.select(*[F.col(f"`{c}`") for c in own], "host", "path", F.col("_hit.rule").alias("rule"),
                      F.coalesce(F.col("_hit.verdict"), F.lit("allow")).alias("verdict"))
