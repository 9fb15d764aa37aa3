"""URL filters: a blocked Bloom filter of the listed canonical URLs, then an exact join.

A listed entry is a canonical URL prefix, host and path in one (``example.net/en/``): it fits its
host and all subdomains where the URL's path starts with the entry's. For each URL, every listed
entry that could fit is one of few keys: a suffix of its host at a label border, with a prefix of
its path of a length that occurs in the list. Those keys are tested against the filter, and only
possible hits go on to an equi-join with the list, which removes what the filter let by. All
steps are DataFrame expressions.

Null URLs and those without ``://`` have neither host nor path and fit nothing. A URL that occurs
more than once is judged once and comes back as often. The longest entry wins; of two of the same
length, the later in text order. An entry listed twice with different verdicts blocks.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of 4 words of 64 bits: 1 Mbit, some 10 bits for each of 100,000 entries. A longer list
#: needs more blocks, or the join gets more false hits; the verdicts are the same.
BLOCKS = 4096
_WORDS = 4


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), path


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit for each word of the key's block."""
    spread = F.xxhash64(key, F.lit(1))
    places = [F.shiftright(spread, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places]


def bloom_filter(keys: DataFrame, key: str = "key", blocks: int = BLOCKS) -> DataFrame:
    """At most ``blocks`` rows: the block's number and the words that its keys set."""
    bits = [F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))]
    return keys.where(F.col(key).isNotNull()).groupBy(_block(F.col(key), blocks).alias("block")).agg(*bits)


def possible_hits(rows: DataFrame, bloom: DataFrame, key: str, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and a few others."""
    found = rows.withColumn("block", _block(F.col(key), blocks)).join(F.broadcast(bloom), "block")
    for i, mask in enumerate(_masks(F.col(key))):
        found = found.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return found.drop("block", *[f"w{i}" for i in range(_WORDS)])


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    blocks: int = BLOCKS,
) -> DataFrame:
    """Judge every row's URL by ``listed`` (entry, verdict): id, host, path, rule and verdict.

    ``rule`` is the entry that decides, null where none fits; the verdict is then ``default``.
    Other columns of ``pages`` are not read, whatever their names. No rows in, none out; with an
    empty list, every URL gets the default.
    """
    host_of, path_of = split_url(F.col("entry_url"))
    rules = (
        listed.where(F.col("entry").isNotNull())
        .groupBy(F.col("entry").alias("key"))
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("entry_url", F.concat(F.lit("://"), "key"))
        .select("key", "verdict", host_of.alias("h"), F.length(path_of).alias("n"))
        .select("key", "verdict", "n", _labels(F.col("h")).alias("labels"))
    )
    shapes = rules.select("labels", "n").distinct()
    host, path = split_url(F.col("url"))
    urls = (
        pages.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .agg(F.count("*").alias("copies"))
        .withColumns({"host": host, "path": path})
    )
    # A shape is how many labels and path characters an entry has: few, whatever the list's length.
    most = shapes.agg(F.collect_set(F.struct("labels", "n")).alias("shapes"))
    keyed = (
        urls.where(F.col("host") != "")
        .withColumn("shapes", most.scalar())
        .select("id", "url", "host", "path", F.explode("shapes").alias("s"))
        .where((F.col("s.labels") <= _labels(F.col("host"))) & (F.col("s.n") <= F.length("path")))
        .select(
            "id",
            "url",
            F.concat(
                F.call_function("substring_index", "host", F.lit("."), -F.col("s.labels")),
                F.substring("path", F.lit(1), F.col("s.n")),
            ).alias("key"),
        )
    )
    best = (
        possible_hits(keyed, bloom_filter(rules, blocks=blocks), "key", blocks)
        .join(rules.select("key", "verdict"), "key")
        .groupBy(F.col("id").alias("hit_id"), F.col("url").alias("hit_url"))
        .agg(F.max(F.struct(F.length("key"), "key", "verdict")).alias("best"))
    )
    same = F.col("id").eqNullSafe(F.col("hit_id")) & F.col("url").eqNullSafe(F.col("hit_url"))
    return (
        urls.join(best, same, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            F.col("best.key").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
