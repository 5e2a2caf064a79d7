"""URL filters: a blocked Bloom filter of the listed URLs before an exact join with the list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, by_value, durable

BITS_PER_RULE = 16
#: A block is 8 words of 64 bits, and a key sets one bit in each.
WORDS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased. Path: from there up to ? # or the end.

    Both are empty for null and for urls without ://.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def parse_rules(rules: DataFrame) -> DataFrame:
    """(rule, action) as (rule, action, host, path, labels, key): a rule is a host, then a path from its first slash on.

    Rules that are null are ignored; of a rule that is listed with both actions, block holds.
    """
    host = F.translate(F.regexp_extract("rule", r"^[^/]*", 0), UPPER, LOWER)
    listed = rules.where("rule IS NOT NULL").groupBy("rule").agg(F.max("action").alias("action"))
    parts = listed.select("rule", "action", host.alias("host"), F.substring("rule", F.length(host) + 1, F.length("rule")).alias("path"))
    return parts.withColumn("labels", F.size(F.split("host", r"\.", -1))).withColumn("key", rule_key(F.col("host"), F.col("path")))


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


class BlockedBloom:
    """A Bloom filter whose keys each touch one block of 512 bits, as a table of the blocks that are not empty.

    Probes are joined with their block, so the filter may have any size: a small one is broadcast,
    a larger one is dealt out by block like the probes.
    """

    def __init__(self, keys: DataFrame, count: int):
        self.blocks = max(1, -(-count * BITS_PER_RULE // (64 * WORDS)))
        words = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), self.bit("key", i))).alias(f"word{i}") for i in range(WORDS)]
        self.table = durable(keys.groupBy(self.block("key").alias("block")).agg(*words))

    def block(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.blocks)).cast("long")

    def bit(self, key: str, word: int) -> Column:
        """The bit of a key in one of its block's words."""
        return F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 6 * word).bitwiseAND(F.lit(63)).cast("int")

    def passing(self, probes: DataFrame) -> DataFrame:
        """The probes (key, ...) that may be in the filter."""
        placed = probes.withColumn("block", self.block("key")).join(broadcast_if_small(self.table), "block")
        held = F.lit(True)
        for i in range(WORDS):
            held = held & (F.call_function("shiftright", F.col(f"word{i}"), self.bit("key", i)).bitwiseAND(F.lit(1).cast("long")) == 1)
        return placed.where(held).select(*probes.columns)


def filter_urls(pages: DataFrame, rules: DataFrame, *, url_col: str = "url", default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict (columns of these names are replaced, but for the url's own).

    rules: (rule, action). A rule fits its host and all subdomains where the url's path starts
    with the rule's; the longest fitting rule wins (of equal length the longer host, then the
    later in code point order). Without one the verdict is `default`.

    Each distinct url is asked once, and of the hosts each distinct one. A host and those above it pass
    the Bloom filter of listed hosts and are joined with these, which tells how long the paths of a
    host's rules are; the url's path, cut to these lengths, gives its canonical keys. Keys that pass the Bloom filter
    of listed rules are joined with the list. The list may have any length and any shapes.

    A host has as many hosts above it as labels, so a domain that half of all urls are in is asked for
    by its distinct hosts only. Urls of any length are judged whole. Null urls and those without :// have an empty host and path and fit no rule with a host.
    Repeated rows each get their verdict; empty tables and an empty list give what they should.
    Other columns of any name stay as they are.
    """
    host, path = host_and_path(F.col(f"`{url_col}`"))
    kept = [c for c in pages.columns if c == url_col or c not in ("host", "path", "rule", "verdict")]
    url = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), host.alias("host"), path.alias("path"))
    parsed = url.withColumn("url_md5", F.md5(rule_key(F.col("host"), F.col("path")).cast("binary")))
    listed = durable(parse_rules(rules))
    hosts = durable(listed.groupBy(F.col("host").alias("key")).agg(F.collect_set(F.length("path")).alias("lengths")))

    asked = parsed.groupBy("url_md5").agg(F.first("host").alias("host"), F.first("path").alias("path"))
    labels = F.split("host", r"\.", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    suffixes = asked.select("host").distinct().select("host", F.explode(above).alias("key"))
    fitting = BlockedBloom(hosts, hosts.count()).passing(suffixes).join(broadcast_if_small(hosts), "key")
    by_host = durable(fitting.groupBy("host").agg(F.collect_list(F.struct("key", "lengths")).alias("above")))
    fits = asked.join(broadcast_if_small(by_host), "host").select("url_md5", "path", F.explode("above").alias("x")).select("url_md5", "path", "x.key", "x.lengths")
    cut = fits.select("url_md5", "path", "key", F.explode("lengths").alias("n")).where(F.col("n") <= F.length("path"))
    keys = cut.select("url_md5", rule_key(F.col("key"), F.expr("substring(path, 1, n)")).alias("key"))
    hits = BlockedBloom(listed, listed.count()).passing(keys).join(broadcast_if_small(listed), "key")
    best = F.max(F.struct(F.length("rule"), F.length("host"), "rule", "action")).alias("best")
    decided = durable(hits.groupBy("url_md5").agg(best).select("url_md5", "best.rule", "best.action"))
    out = parsed.join(decided, "url_md5", "left").withColumn("verdict", F.coalesce("action", F.lit(default)))
    return out.select("page.*", *[c for c in ("host", "path", "rule", "verdict") if c not in kept])


by_value(__name__)
