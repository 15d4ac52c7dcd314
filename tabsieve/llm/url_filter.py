"""URL filter: rules by host and path, then a blocked Bloom filter of listed
canonical URLs and an exact hash join.

Rules decide first; the longest that fits wins.  The other URLs are brought to
a canonical form and tested against a Bloom filter whose bits of one URL lie in
one block of 8 lanes of 64 bits, so that a test reads one row of the filter
table.  The filter has at most ``MAX_BLOCKS`` rows whatever the list's size, so
it is always broadcast; a longer list only lets more URLs through by mistake.
What passes, and nothing else, is shuffled: an exact join with the list removes
the false positives.  URLs that make up a large share of the possible hits are
joined from a small broadcast table, so no task holds them all.

Nulls and odd rows: a null URL or one without ``://`` has empty host and path,
fits no rule, has no canonical form and is allowed.  Rows are judged one by
one, repeated rows and null ids included; null entries of the list are left
out, an empty list blocks nothing.  Columns of the input are returned as they
are in ``row``, so their names cannot clash.

Everything is made of DataFrame functions."""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsieve.llm.common import prepare

#: Most rows of the filter table, 72 bytes each.
MAX_BLOCKS = 1 << 18
LANES = 8
LANE_BITS = 64
#: Bits of the filter for each listed URL, as long as MAX_BLOCKS allows.
BITS_PER_URL = 16
#: A URL with at least one in so many possible hits is joined by broadcast, so
#: that table has at most as many rows.
HOT_SHARE = 1_000
#: A page whose HTML consists of these marks to this share is junk.
JUNK_MARKS = "#*$%"
JUNK_SHARE = 0.03


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def _up_to(text: Column, *marks: str) -> Column:
    for m in marks:
        text = F.substring_index(text, m, 1)
    return text


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(_lower_ascii(_up_to(_after_scheme(url), "/", "?", "#")), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = _after_scheme(url)
    host = _up_to(rest, "/", "?", "#")
    return F.coalesce(_up_to(F.substring(rest, F.length(host) + 1, F.length(rest)), "?", "#"), F.lit(""))


def canonical(url: Column) -> Column:
    """Form in which URLs of one page agree: no scheme, no leading ``www.``, no
    default port, no fragment, no slash at the end, parameters sorted and
    without those that only follow a visitor.  Null without a host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r"\.?(:80|:443)?$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    plain = _up_to(url, "#")
    asked = F.instr(plain, "?")
    query = F.when(asked > 0, F.substring(plain, asked + 1, F.length(plain))).otherwise(F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|gclid|fbclid|ref)(=|$)")))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&")))
                                       .otherwise(F.lit(""))))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _block(url: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(n_blocks)).cast("int")


def _lane_bits(url: Column) -> list[Column]:
    """One bit in each lane, six bits of a second hash a lane."""
    h = F.xxhash64(url, F.lit("lanes"))
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(LANE_BITS - 1)).cast("int"))
            for i in range(LANES)]


def bloom(listed: DataFrame, url: str = "canonical") -> tuple[DataFrame, int]:
    """Filter table (block, lane0..lane7) of the listed URLs and its number of
    blocks.  Written to the checkpoint folder."""
    n = listed.count()
    n_blocks = max(1, min(MAX_BLOCKS, -(-n * BITS_PER_URL // (LANES * LANE_BITS))))
    bits = _lane_bits(F.col(url))
    rows = listed.select(_block(F.col(url), n_blocks).alias("block"), *[b.alias(f"lane{i}") for i, b in enumerate(bits)])
    return rows.groupBy("block").agg(*[F.bit_or(f"lane{i}").alias(f"lane{i}") for i in range(LANES)]).checkpoint(), n_blocks


def listing(urls: DataFrame, url: str = "url") -> DataFrame:
    """Distinct canonical URLs of a table of URLs, for :func:`judge`."""
    return (urls.select(canonical(F.col(url)).alias("canonical")).filter("canonical is not null").distinct()
            .checkpoint())


def junk_urls(pages: DataFrame) -> DataFrame:
    """URLs of pages whose HTML is to ``JUNK_SHARE`` made of ``JUNK_MARKS``."""
    marks = F.length("html") - F.length(F.translate("html", JUNK_MARKS, ""))
    return pages.filter(marks >= JUNK_SHARE * F.greatest(F.length("html"), F.lit(1))).select("url")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """(row, host, path, rule, verdict) of every row of ``pages``: ``row`` holds
    its columns, ``rule`` the rule that decided or null, ``verdict`` allow or
    block.  ``listed`` comes from :func:`listing`."""
    prepare(pages.sparkSession)
    filter_table, n_blocks = bloom(listed)
    host, path = host_of(F.col("row")[url]), path_of(F.col("row")[url])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    seen = (pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
            .withColumns({"host": host, "path": path})
            .withColumns({"rule": rule, "ruled": verdict, "canonical": canonical(F.col("row")[url])})
            .withColumn("block", F.when(F.col("ruled").isNull(), _block(F.col("canonical"), n_blocks))))
    probed = seen.join(F.broadcast(filter_table), "block", "left")
    hit = F.lit(True)
    for i, bit in enumerate(_lane_bits(F.col("canonical"))):
        hit = hit & (F.col(f"lane{i}").bitwiseAND(bit) == bit)
    probed = probed.withColumn("possible", F.coalesce(hit, F.lit(False)) & F.col("block").isNotNull())
    columns = ["row", "host", "path", "rule"]

    passed = probed.filter(~F.col("possible")).select(*columns, F.coalesce("ruled", F.lit("allow")).alias("verdict"))
    hits = probed.filter("possible").select(*columns, "canonical").checkpoint()
    return passed.unionByName(_exact(hits, listed).select(*columns, "verdict"))


def _exact(hits: DataFrame, listed: DataFrame) -> DataFrame:
    """``verdict`` block for hits whose canonical URL is listed, else allow.
    The list is matched with the distinct URLs of the hits; a URL's rows meet
    its answer by broadcast if they are many, else by a hash join."""
    marked = listed.select("canonical", F.lit(True).alias("found"))
    known = hits.groupBy("canonical").agg(F.count("*").alias("n")).join(marked.hint("shuffle_hash"), "canonical", "left").checkpoint()
    least = max(1, hits.count() // HOT_SHARE)
    hot = known.filter(F.col("n") > least).select("canonical", F.coalesce("found", F.lit(False)).alias("hot"))
    rest = known.filter((F.col("n") <= least) & F.col("found")).select("canonical", "found")
    split = hits.join(F.broadcast(hot), "canonical", "left")
    often = split.filter("hot is not null").withColumn("blocked", F.col("hot")).drop("hot")
    seldom = (split.filter("hot is null").drop("hot").join(rest.hint("shuffle_hash"), "canonical", "left")
              .withColumn("blocked", F.coalesce("found", F.lit(False))).drop("found"))
    return often.unionByName(seldom).withColumn("verdict", F.when(F.col("blocked"), "block").otherwise("allow"))


def keep_allowed(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """Rows of ``pages`` that are allowed, with their columns."""
    return judge(pages, listed, rules, url).filter("verdict = 'allow'").select("row.*")
