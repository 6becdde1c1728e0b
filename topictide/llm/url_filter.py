"""URL filter: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

A listed URL sets eight bits in one 256-bit block. The filter is a table (block, four words) of at most
``max_blocks`` rows, which bounds what is broadcast; a longer list only makes it pass more false positives. What it
passes goes to an exact hash join with the list, so the verdict never depends on the filter's size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topictide.llm.common import ascii_lower

WORDS = 4  # 64-bit words of a block
PROBES = 8  # one byte of the second hash each


@dataclass(frozen=True)
class HostRule:
    """``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    HostRule("block", "net", "/"),
    HostRule("allow", "example.net", "/en/"),
    HostRule("block", "example.com", "/de/"),
    HostRule("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to the next ``/``, ``?`` or ``#``; empty without ``://`` or url."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes, sorted query without tracking
    parameters; no scheme, no fragment. Null where the URL is null or has no ``://``."""
    host = F.regexp_replace(host_of(url), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    rest = F.array_join(parts, "&")
    whole = F.concat(host, path, F.when(rest != "", F.concat(F.lit("?"), rest)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), whole)


def rule_for(host: Column, path: Column, rules: tuple[HostRule, ...]) -> tuple[Column, Column]:
    """(name, verdict) of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks))


def _masks(url: Column) -> list[Column]:
    """The bits of a URL in each word of its block."""
    second = F.xxhash64(F.lit("bits"), url)
    at = [F.shiftrightunsigned(second, 8 * k).bitwiseAND(F.lit(255)) for k in range(PROBES)]
    words = []
    for w in range(WORDS):
        mask = F.lit(0).cast("long")
        for p in at:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))
            mask = mask.bitwiseOR(F.when(F.shiftright(p, 6) == w, bit).otherwise(F.lit(0).cast("long")))
        words.append(mask)
    return words


def bloom_blocks(listed: DataFrame, n_blocks: int, url_col: str = "url") -> DataFrame:
    """(block, w0..w3) of the canonical URLs in ``listed``."""
    url = F.col(url_col)
    masks = [m.alias(f"w{i}") for i, m in enumerate(_masks(url))]
    bits = listed.where(url.isNotNull()).select(_block(url, n_blocks).alias("block"), *masks)
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def blocks_for(n: int, bits: int = 16, most: int = 1 << 19) -> int:
    """Blocks for n keys at ``bits`` each, and never more than ``most`` (20 MB)."""
    return min(most, max(1, n * bits // (64 * WORDS)))


def possible(rows: DataFrame, key: str, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """``rows`` with ``possible``: false only if the filter rules the key out (null keys always are)."""
    masks = [m.alias(f"m{i}") for i, m in enumerate(_masks(F.col(key)))]
    probe = rows.select("*", _block(F.col(key), n_blocks).alias("block"), *masks)
    hit = F.col(key).isNotNull()
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    # at most n_blocks rows of five longs
    return probe.join(F.broadcast(blocks), "block", "left").select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("possible"))


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: tuple[HostRule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    bits_per_url: int = 16,
    max_blocks: int = 1 << 19,
) -> DataFrame:
    """(id, host, path, rule, canonical, possible, listed, verdict), one row per row of ``pages``.

    ``listed``: a table with a column ``url`` of canonical URLs, repeats and nulls allowed. A rule's verdict goes
    before the list's; a page that neither knows is allowed. Null URLs and such without ``://`` have an empty host and path
    and no canonical form. Repeated pages are judged alike; other columns are not read; empty tables give empty results.
    """
    urls = listed.select(F.col("url").alias("canonical")).where("canonical is not null").distinct()
    n_blocks = blocks_for(urls.count(), bits_per_url, max_blocks)
    blocks = bloom_blocks(urls, n_blocks, "canonical")

    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", host_of(url).alias("host"), path_of(url).alias("path"), canonical_url(url).alias("canonical"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("ruled"))

    probed = possible(rows, "canonical", blocks, n_blocks)
    hits = probed.where("possible").join(urls.withColumn("listed", F.lit(True)), "canonical", "left")
    rest = probed.where("not possible").withColumn("listed", F.lit(False))
    judged = hits.withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(rest)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", "canonical", "possible", "listed",
        F.coalesce("ruled", by_list).alias("verdict"),
    )


def tracker_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(url): canonical URLs of pages on hosts with a label ``ads`` or ``ads-...``; the list of the registered query."""
    url = F.col(url_col)
    return pages.where(host_of(url).rlike(r"(^|\.)ads(-|\.)")).select(canonical_url(url).alias("url")).distinct()
