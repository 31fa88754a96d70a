"""URL verdicts: rules for hosts and paths, and a list of canonical URLs behind a blocked Bloom filter.

The list may be as large as the corpus, and nearly all URLs are not on it. The filter has one block of 512
bits for every 32 listed URLs; a URL sets one bit in each of the eight words of a single block. It is built
by an aggregate per block, and a URL that lacks one of its bits is surely not listed. What passes goes to
an exact join with the list, which removes the false positives, so that verdicts are exact. Up to
`FILTER_BYTES` the filter is broadcast; beyond, it is joined by the number of the block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.common import cut

# (verdict, rule); a rule is a host with its subdomains, followed by the beginning of the path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
KEYS_PER_BLOCK = 32
WORDS = 8
FILTER_BYTES = 16 << 20
_ROW_BYTES = 8 * (WORDS + 2)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first `://`; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without `www.`, path without closing slashes, query without tracking parameters; null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), r"^&", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for outcome, text in sorted(rules, key=lambda r: len(r[1])):  # later, that is longer, ones win
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(outcome)).otherwise(verdict)
    return rule, verdict


def _masks(key: Column) -> list[Column]:
    """One bit in each word of a block."""
    second = F.xxhash64(key, F.lit("bits"))
    bits = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), bit) for bit in bits]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 ...) of the distinct canonical URLs `key`."""
    words = [mask.alias(f"m{i}") for i, mask in enumerate(_masks(F.col("key")))]
    set_bits = listed.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("block"), *words)
    return set_bits.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row of `pages`.

    `listed` has a column `url`; a page whose canonical URL is that of a listed one is blocked unless a rule
    fits. A url that is null or has no `://` has an empty host and path and is never listed: allowed. Null
    ids and repeated rows each give a row; other columns are not read. Empty tables give no rows, or no hits.
    """
    keys = cut(listed.select(canonical(F.col("url")).alias("key")).where("key is not null").distinct())
    blocks = max(1, -(-keys.count() // KEYS_PER_BLOCK))
    bloom = bloom_filter(keys, blocks)
    if blocks * _ROW_BYTES <= FILTER_BYTES:
        bloom = F.broadcast(bloom)
    url = F.col(url_col)
    rows = pages.select(
        F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("key")
    )
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    tested = rows.join(bloom, "block", "left")
    has = [F.col(f"w{i}").bitwiseAND(mask) == mask for i, mask in enumerate(_masks(F.col("key")))]
    possible = F.coalesce(F.col("key").isNotNull() & reduce(Column.__and__, has), F.lit(False))
    tested = tested.select("page_id", "host", "path", "key", possible.alias("possible"))
    clear = tested.where(~F.col("possible")).withColumn("listed", F.lit(False))
    exact = keys.withColumn("on_list", F.lit(True)).hint("shuffle_hash")
    hits = tested.where("possible").join(exact, "key", "left")
    hits = hits.select("page_id", "host", "path", "key", "possible", F.coalesce("on_list", F.lit(False)).alias("listed"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return clear.unionByName(hits).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "listed")


def repeated_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(url): the urls of pages whose canonical URL was fetched for more than one page, one for each."""
    groups = pages.select(canonical(F.col(url_col)).alias("key"), F.col(url_col).alias("url")).where("key is not null")
    return groups.groupBy("key").agg(F.count("*").alias("n"), F.min("url").alias("url")).where("n > 1").select("url")
