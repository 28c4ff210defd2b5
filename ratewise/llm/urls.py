"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact
hash join.

A URL is judged by the longest rule that fits it, else by the block list.  List
entries and URLs are brought to one canonical form (scheme, user, port, fragment,
tracking parameters and trailing slashes go, parameters are sorted); an entry
without path or parameters lists a whole host with its subdomains, any other entry
one canonical URL.  So a URL has a few keys: its own canonical form and the root of
each domain it belongs to.

*Blocked Bloom filter.*  A key's hash picks one block of six 64-bit words and one
bit in each word, so a probe touches one cache line.  The blocks are built on the
executors by a grouped bitwise OR.  The filter grows with the list (16 bits a key)
up to ``MAX_BLOCKS`` blocks (48 MB, the proven bound of what reaches the driver and
is broadcast); a longer list only raises the share of false positives.  Rows that
miss, nearly all, are decided where they were read and never shuffled.

*Exact join.*  The keys of possible hits, distinct, meet the list in an equi-join;
what the join does not confirm was a false positive.

Cases: null URLs and such without ``://`` have an empty host and path, fit no rule
and are on no list, so they are allowed; empty hosts likewise; repeated rows are
judged alike and all kept; very long URLs are whole; an empty list blocks nothing;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain, read, stored


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str     # the host and all its subdomains
    path: str     # a prefix of the path


# --- fixed values -------------------------------------------------------------
#: Rules of the query's contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
#: The tables hold no block list, so the query lists the pages of hosts that have
#: one of these words in their name.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "poker", "porn", "spam",
                "warez", "xxx")
#: Parameters that name a way to a page, not a page.
TRACKING = "utm_[^=]*|gclid|fbclid|ref"
# ------------------------------------------------------------------------------

WORDS = 6            # 64-bit words of a block; one bit in each for every key
BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``, else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER),
                      F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_host(url: Column) -> Column:
    """The host without user, port and trailing dots."""
    return F.regexp_replace(F.regexp_replace(host_of(url), r"^.*@", ""), r"\.*(:[0-9]*)?$", "")


def canonical(url: Column) -> Column:
    """``host/path?a=1&b=2``; null where there is no host."""
    host = canonical_host(url)
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^?#]*\?([^#]*)", 1)
    kept = F.sort_array(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(
        f"^(?:{TRACKING})(?:=|$)")))
    return F.when(host != "", F.concat(
        host, F.when(path == "", F.lit("/")).otherwise(path),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))))


def _keys(url: Column, longest: int) -> Column:
    """The canonical URL and ``domain/`` of every domain of its host that is not
    longer than the longest listed host."""
    host = canonical_host(url)
    tail = F.right(host, F.lit(longest + 1))  # a longer domain cannot be listed
    labels = F.split(tail, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)),
                          lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    roots = F.transform(F.filter(domains, lambda d: (d != "") & (F.length(d) <= longest)),
                        lambda d: F.concat(d, F.lit("/")))
    return F.when(canonical(url).isNotNull(), F.array_distinct(F.concat(F.array(canonical(url)), roots)))


def by_rules(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule (host and path together, then host)
    that fits, else nulls.  Rules are a short parameter: each is an expression."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):
        fits = (host.eqNullSafe(r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


# --- blocked Bloom filter -------------------------------------------------------

def bloom_filter(keys: DataFrame, n_keys: int) -> np.ndarray:
    """The filter of the distinct ``keys(key)`` as an array of blocks of ``WORDS``
    words; at most ``MAX_BLOCKS`` rows reach the driver."""
    need = max(1, -(-n_keys * BITS_PER_KEY // (64 * WORDS)))
    blocks = min(MAX_BLOCKS, 1 << (need - 1).bit_length())
    h = F.xxhash64("key")
    word = lambda j: F.bit_or(F.expr(
        f"shiftleft(1L, CAST(shiftright(h, {6 * j}) & 63 AS INT))")).alias(f"w{j}")
    rows = keys.select(h.alias("h")).groupBy(
        (F.shiftrightunsigned("h", 6 * WORDS) % blocks).cast("int").alias("block")).agg(
        *[word(j) for j in range(WORDS)]).toPandas()
    out = np.zeros((blocks, WORDS), np.uint64)
    out[rows["block"].to_numpy()] = rows[[f"w{j}" for j in range(WORDS)]].to_numpy().view(np.uint64)
    return out


def probe(blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the filter (never false for one that is)."""
    h = hashes.view(np.uint64)
    rows = blocks[((h >> np.uint64(6 * WORDS)) % np.uint64(len(blocks))).astype(np.int64)]
    out = np.ones(len(h), bool)
    for j in range(WORDS):
        out &= (rows[:, j] >> ((h >> np.uint64(6 * j)) & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _flag(batches: Iterable[pa.RecordBatch], blocks) -> Iterator[pa.RecordBatch]:
    """Replaces ``hashes`` by ``maybe``: whether a key of the row may be listed."""
    for batch in batches:
        lists = batch.column("hashes")
        parents = lists.value_parent_indices() if hasattr(lists, "value_parent_indices") else \
            pa.compute.list_parent_indices(lists)
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
        maybe = np.zeros(len(batch), bool)
        if len(values):
            maybe[np.asarray(parents)[probe(blocks.value, values)]] = True
        names = [n for n in batch.schema.names if n != "hashes"]
        yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(maybe)],
                                         names=[*names, "maybe"])


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Iterable[Rule] = ()) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict)`` for every row of ``pages(page_id,
    url)``: the verdict of the longest fitting rule, else ``block`` for a URL on the
    list ``listed(url)`` and ``allow`` for any other."""
    spark = pages.sparkSession
    entries = stored(plain(listed, url="string").select(canonical(F.col("url")).alias("key"))
                     .where("key IS NOT NULL").distinct(), "listed")
    size = entries.agg(F.count(F.lit(1)), F.max(F.length(F.regexp_extract("key", "^[^/]*", 0)))).first()
    blocks = spark.sparkContext.broadcast(bloom_filter(entries, int(size[0])))
    url = F.col("url")
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    rows = plain(pages, page_id="long", url="string").select(
        "page_id", "url", host_of(url).alias("host"), path_of(url).alias("path")).select(
        "*", rule.alias("rule"), verdict.alias("verdict"))
    hashes = F.when(F.col("verdict").isNull(), F.transform(
        F.coalesce(_keys(url, int(size[1] or 0)), F.array().cast("array<string>")),
        lambda k: F.xxhash64(k)))
    flagged = stored(rows.withColumn("hashes", hashes).mapInArrow(
        lambda batches: _flag(batches, blocks),
        "page_id long, url string, host string, path string, rule string, verdict string, "
        "maybe boolean"), "judged")
    # only possible hits are exploded and shuffled, a repeated URL once
    hits = flagged.where("maybe").select("url").distinct().select(
        "url", F.explode(_keys(url, int(size[1] or 0))).alias("key"))
    on_list = hits.join(entries, "key", "left_semi").select("url").distinct().withColumn(
        "listed", F.lit(True))
    sure = flagged.where("NOT maybe").withColumn("listed", F.lit(False))
    checked = flagged.where("maybe").join(on_list, "url", "left")
    return sure.unionByName(checked).select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("verdict", F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"))


def listed_by_name(pages: DataFrame, words: Iterable[str] = LISTED_WORDS) -> DataFrame:
    """A block list ``(url)``: the URLs, and the whole hosts, of pages whose host's
    name holds one of the words."""
    host = canonical_host(F.col("url"))
    bad = F.arrays_overlap(F.split(host, "[^a-z0-9]+"), F.array(*[F.lit(w) for w in words]))
    return plain(pages, url="string").where(bad).select(F.explode(F.array(
        F.col("url"), F.concat(F.lit("http://"), host))).alias("url"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, listed_by_name(pages), RULES).drop("url")


def _sql_rule(r: Rule) -> str:
    return (f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')")


_LONGEST_FIRST = sorted(RULES, key=lambda r: -len(r.host) - len(r.path))

OP13_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
ruled AS (
  SELECT *, CASE {' '.join(f"WHEN {_sql_rule(r)} THEN '{r.host}{r.path}'" for r in _LONGEST_FIRST)} END AS rule,
         CASE {' '.join(f"WHEN {_sql_rule(r)} THEN '{r.verdict}'" for r in _LONGEST_FIRST)} END AS ruling,
         string_split_regex(regexp_replace(host, '^.*@', ''), '[^a-z0-9]+') AS names
  FROM parts)
SELECT page_id, host, path, rule,
       coalesce(ruling, CASE WHEN list_has_any(names, [{', '.join(f"'{w}'" for w in LISTED_WORDS)}])
                             THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""
