"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS_PER_BLOCK = 8
#: Keys for each block of 512 bits, and the least and most blocks: the largest filter has 64 MB.
KEYS_PER_BLOCK, LEAST_BLOCKS, MOST_BLOCKS = 32, 1 << 6, 1 << 20


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Scheme, ``www.``, query, fragment, a trailing slash and ``.html`` make no difference."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"(?:\.html?|/+)$", ""))


def rule_of(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null where none does. A rule fits its host and all subdomains."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _place(key: Column, blocks: int) -> list[Column]:
    """The block of a key and one bit in each of the block's words."""
    bits = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    masks = [F.call_function("shiftleft", one, F.shiftrightunsigned(bits, 6 * j).bitwiseAND(F.lit(63).cast("long")).cast("int")).alias(f"_m{j}") for j in range(WORDS_PER_BLOCK)]
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("_block"), *masks]


def blocks_for(n: int) -> int:
    """Blocks for ``n`` keys: a power of two with at most 32 keys a block, where ``MOST_BLOCKS`` allows. A fuller filter lets more rows through to the exact join."""
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, 1 << (-(-n // KEYS_PER_BLOCK) - 1).bit_length() if n else 0))


def build_filter(keys: DataFrame, key: str = "key", blocks: int = 1 << 16) -> DataFrame:
    """At most ``blocks`` rows of 512 bits, whatever the list holds: bounded, so it may be broadcast."""
    placed = keys.where(F.col(key).isNotNull()).select(*_place(F.col(key), blocks))
    return placed.groupBy("_block").agg(*[F.bit_or(f"_m{j}").alias(f"_w{j}") for j in range(WORDS_PER_BLOCK)])


def url_filter(pages: DataFrame, listed: DataFrame, rules: Sequence[UrlRule], url: str = "url", blocks: int | None = None) -> DataFrame:
    """Judge every row of ``pages``: columns ``row`` (the input's columns), ``host``, ``path``, ``rule``, ``verdict``.

    ``listed`` has a column ``url`` of URLs to block. The rule's verdict wins; else ``block`` for a
    listed canonical URL and ``allow`` for the rest. Possible hits of the Bloom filter go to an exact
    hash join, all other rows are never shuffled. Null urls and urls without ``://`` have an empty host
    and path, fit no rule and are never listed; very long ones are read whole. Repeated rows are each judged; repeated list entries, and several of one
    canonical form, count once. The filter has ``blocks`` blocks, or as many as the size of the list asks for."""
    names = listed.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("key")).where("key <> ''").distinct()
    names = staged(names, "listed")  # an unpartitioned scan, so that AQE can split a hot key's join
    blocks = blocks or blocks_for(names.count())
    bits = F.broadcast(build_filter(names, blocks=blocks))
    own = pages.select(F.struct("*").alias("row")).select("row", host_of(F.col(f"row.`{url}`")).alias("host"), path_of(F.col(f"row.`{url}`")).alias("path"))
    own = own.withColumn("_r", rule_of(F.col("host"), F.col("path"), rules)).withColumn("_key", canonical(F.col("host"), F.col("path")))
    probe = own.select("*", *_place(F.col("_key"), blocks)).join(bits, "_block", "left")
    maybe = F.col("_r").isNull() & (F.col("_key") != "")
    for j in range(WORDS_PER_BLOCK):
        maybe = maybe & (F.col(f"_w{j}").bitwiseAND(F.col(f"_m{j}")) == F.col(f"_m{j}"))
    probe = probe.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).select("row", "host", "path", "_r", "_key", "_maybe")
    sure = probe.where("not _maybe").select("row", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", F.lit("allow")).alias("verdict"))
    hits = probe.where("_maybe").join(names.hint("shuffle_hash").withColumn("_in", F.lit(True)), F.col("_key") == F.col("key"), "left")
    hits = hits.select("row", "host", "path", F.lit(None).cast("string").alias("rule"), F.when(F.col("_in"), "block").otherwise("allow").alias("verdict"))
    return sure.unionByName(hits)
