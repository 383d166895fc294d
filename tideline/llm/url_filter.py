"""URL lists: a blocked Bloom filter of listed keys in front of an exact hash join.

A listed key is host + path, as `example.com/en/`; it fits its host and all subdomains, if the url's path starts with
the key's path; of those that fit the longest decides. From each url come the keys that could fit it: each host suffix
that begins at a label, with as many labels as some listed host, before each path prefix as long as some listed path of
hosts with so many labels. Those that the filter passes, all true ones and few others, go to an exact hash join.

The filter is split into blocks of eight 32-bit words. A key's hash names the block and one bit in each word, so a probe
reads one block. Blocks are made by aggregation (a bit_or of each word), never on the driver.

All urls are judged once each: repeated urls are one row from the first shuffle's map side on. The filter and the list
are broadcast while they are under BROADCAST_ROWS rows, else they are joined by shuffles.

Very long urls give as many keys as the list has shapes that fit, no more. Null urls and urls without "://" have an empty host and path, fit no key and get the default verdict. Ties (a key listed
twice) go to block. Repeated rows are all kept. Empty lists and tables give default verdicts and no rows. Columns of
the input other than those named are not read; clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import met, settled, table

WORDS = 8
#: Fixed odd numbers, one per word, that spread a hash over the bits of the words.
SALTS = (0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31)
#: Listed keys per block: 16 bits a key.
KEYS_PER_BLOCK = 16
#: Up to so many rows a list or filter is broadcast (under 100 bytes a row).
BROADCAST_ROWS = 200_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first :// up to /, ? or # with A-Z lower-cased, and from there up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    low = F.xxhash64(key, F.lit(2)).bitwiseAND(F.lit(0x7FFFFFFF))
    place = [F.shiftrightunsigned((low * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int") for s in SALTS]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in place]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """block and its words w0..w7, for the blocks that have keys."""
    own = keys.select(_block(F.col(key), blocks).alias("block"), *(b.alias(f"b{i}") for i, b in enumerate(_bits(F.col(key)))))
    return own.groupBy("block").agg(*(F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def bloom_filtered(probes: DataFrame, key: str, keys: DataFrame, listed: str, rows: int) -> DataFrame:
    """The rows of probes whose key may be in keys (of which there are about rows): all that are, few that aren't."""
    blocks = max(1, -(-rows // KEYS_PER_BLOCK))
    words = bloom_blocks(keys, listed, blocks)
    hit = None
    for i, b in enumerate(_bits(F.col(key))):
        one = F.col(f"w{i}").bitwiseAND(b) != 0
        hit = one if hit is None else hit & one
    with_block = probes.withColumn("block", _block(F.col(key), blocks))
    return with_block.join(_small(words, blocks), "block").where(hit).select(*probes.columns)


def judged(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow", keep: list[str]) -> DataFrame:
    """The columns in keep, host, path, rule and verdict for each row of pages. rules: host, path and verdict."""
    listed = rules.where("host is not null and path is not null").groupBy((F.concat("host", "path")).alias("key"), "host", "path").agg(F.max("verdict").alias("verdict"))
    # a row for each number of labels, with the path lengths that listed hosts of so many have: no more rows than a host has
    # labels, no more lengths than a path has places, however long the list is
    shapes = listed.groupBy(F.size(F.split("host", r"\.")).alias("many")).agg(F.collect_set(F.length("path")).alias("lengths"))
    count = listed.count()
    urls = pages.select(F.col(url).alias("url")).distinct()
    host, path = host_and_path(F.col("url"))
    urls = urls.select("url", F.split(host, r"\.").alias("labels"), path.alias("path"), host.alias("host")).where("host <> ''")
    suffixes = urls.select("url", "labels", "path", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("many"))
    fitting = suffixes.join(F.broadcast(shapes), "many").select("url", F.array_join(F.slice("labels", -F.col("many"), F.col("many")), ".").alias("suffix"), "path", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("length"))
    probes = fitting.select("url", F.concat("suffix", F.substr("path", F.lit(1), F.col("length"))).alias("key"))
    possible = bloom_filtered(probes, "key", listed, "key", count)
    fits = possible.join(_small(listed, count).hint("shuffle_hash") if count > BROADCAST_ROWS else _small(listed, count), "key")
    best = fits.groupBy("url").agg(F.max(F.struct(F.length("key"), F.length("host"), "verdict", "key")).alias("best")).select("url", F.col("best.key").alias("rule"), F.col("best.verdict").alias("found"))
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(*keep, F.col(url).alias("__url"))
    # urls of which there are many rows are dealt out; null ones, and those without a host, have no rule to look up
    joined = met(rows, settled(best.withColumnRenamed("url", "__url"), "op3-best"), "__url", "left")
    return joined.select(*keep, host.alias("host"), path.alias("path"), "rule", F.coalesce("found", F.lit(default)).alias("verdict"))


#: The listed keys that the query judges by.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    rules = spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in RULES))))
    return judged(table(spark, sf_dir, "pages"), rules, keep=["page_id"])


OP3_SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM u
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r(rh, rp, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT page_id, host, path, rh || rp AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS rn
  FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM m WHERE rn = 1
"""
