"""URL filters: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

The filter is broadcast and lets through every listed URL and a few others; only what it lets through meets the list in
a hash join, which removes the false hits. Everything else is judged where it is read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topiclog.llm import bloom
from topiclog.llm.base import others, stored

# (verdict, host, path): a rule holds for its host and all subdomains.
RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"), ("block", "com", "/de/"),
)
# Parameters that do not change what a URL shows.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"
COLUMNS = ("page_id", "host", "path", "rule", "verdict")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null and without ://."""
    found = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end; empty for null and without ://."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for the addresses of a page: no scheme, www., trailing slashes, fragment or tracking
    parameters; other parameters sorted. Null without a host."""
    name = F.regexp_replace(host(url), "^www\\.", "")
    query = F.regexp_extract(_after_scheme(url), "^[^?#]*\\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    asked = F.array_join(F.array_sort(kept), "&")
    return F.when(name != "", F.concat(
        name, F.regexp_replace(path(url), "/+$", ""), F.when(asked != "", F.concat(F.lit("?"), asked)).otherwise(F.lit(""))))


def _first_rule(rules) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    found = None
    for verdict, name, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == name) | F.endswith(F.col("host"), F.lit("." + name))) & F.startswith(F.col("path"), F.lit(start))
        answer = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, answer) if found is None else found.when(fits, answer)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def judged(pages: DataFrame, listed: DataFrame, rules=RULES, url_col: str = "url", listed_col: str = "canonical") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    The verdict is that of the longest rule that fits, else block if the canonical URL is in ``listed`` (a column of canonical
    URLs, repeats and nulls allowed), else allow. A null url, or one without ://, has empty host and path, fits no rule and is
    not listed. Columns with the names of the result are replaced; rows are kept one for one, repeated or not.

    The filter has 16 bits per listed URL up to 2^20 blocks of 64 bits; a longer list lets more URLs through to the
    join, never fewer. Both sides of the join are shuffled, so a URL that very many pages share is split.
    """
    names = ("host", "path", "rule", "verdict")
    known = stored(listed.select(F.col(listed_col).alias("__listed")).where("__listed is not null").distinct(), "listed")
    blocks = bloom.blocks_for(known.count())
    words = stored(bloom.built(known, "__listed", blocks), "bloom")
    rows = (
        pages.select(*others(pages, names), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"),
                     canonical(F.col(url_col)).alias("__canonical"))
        .withColumn("__rule", _first_rule(rules))
    )
    tried = bloom.marked(rows, "__canonical", words, blocks, "__possible")
    ask = F.col("__possible") & F.col("__rule").isNull()
    hits = tried.where(ask).join(known.hint("shuffle_hash"), F.col("__canonical") == F.col("__listed"), "left")
    method = F.when(F.col("__listed").isNotNull(), "block").otherwise("allow")

    def result(frame: DataFrame, otherwise: Column) -> DataFrame:
        return frame.select(*others(pages, names), "host", "path", F.col("__rule.rule").alias("rule"),
                            F.coalesce(F.col("__rule.verdict"), otherwise).alias("verdict"))

    return result(hits, method).unionByName(result(tried.where(~ask), F.lit("allow")))


def shared_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """(canonical) of the addresses that more than one row of ``pages`` has."""
    return (
        pages.select(canonical(F.col(url_col)).alias("canonical")).where("canonical is not null")
        .groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("canonical")
    )


ORACLE = r"""
WITH split AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'),
                     lambda p: p <> '' AND NOT regexp_full_match(p, '(utm_[^=]*|ref|fbclid|gclid)(=.*)?')) AS asked
  FROM split
), urls AS (
  SELECT page_id, host, path, CASE WHEN regexp_replace(host, '^www\.', '') <> '' THEN
         regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
         || CASE WHEN len(asked) > 0 THEN '?' || array_to_string(list_sort(asked), '&') ELSE '' END END AS canonical
  FROM parts
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM urls
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN canonical IN (SELECT canonical FROM urls WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""
