"""URL filters by a temporal list join.

List entries are dated: at its date an entry adds a pattern to a list or takes it off. Consecutive entries of a pattern
become validity intervals, and a capture is judged by the intervals that hold at the time of its fetch. Patterns are
hosts, which cover their subdomains, and URL prefixes at path borders; a URL has one key for each pattern that could
cover it, so the join is one on equal keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablemend.llm.names import free_name

# What stands before a colon is a scheme only if slashes follow; otherwise it is a host with a port.
_URL = r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?([^/?#]*)([^?#]*)"
# A URL of this host depth and path depth has at most their sum of keys.
_FOREVER = "9999-12-31 00:00:00"


def host(url: str | Column) -> Column:
    """Host in lower case, without login, port or final dot."""
    authority = F.lower(F.regexp_extract(url, _URL, 1))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""), r"\.$", "")


def path(url: str | Column) -> Column:
    """Path without query and fragment, without a final slash."""
    return F.regexp_replace(F.regexp_extract(url, _URL, 2), "/+$", "")


def _path_parts(url: str | Column) -> Column:
    return F.filter(F.split(path(url), "/"), lambda p: p != "")


def pattern_key(pattern: str | Column) -> Column:
    """A pattern in the form of a URL's keys: scheme, login, port, query and final slash gone, the host in lower case.

    Paths keep their case. A pattern without a host covers nothing.
    """
    return F.when(host(pattern) != "", F.array_join(F.concat(F.array(host(pattern)), _path_parts(pattern)), "/"))


def url_keys(url: str | Column) -> Column:
    """All patterns that cover a URL: its host and the domains above, and the host with every start of its path."""
    labels = F.split(host(url), r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    parts = _path_parts(url)
    prefixes = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.concat(host(url), F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host(url) != "", F.array_distinct(F.concat(domains, prefixes)))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals [valid_from, valid_to) from entries (list, pattern, action, dated).

    The action is `add` or `remove`. Patterns are first brought to the form of `pattern_key`, so an entry also ends what
    another way of writing its pattern began. Of entries of one list and pattern at one time, a removal counts. An addition holds
    until the next entry's date that differs in its action, or for ever; repeated additions do not split it. Entries with
    a null in list, pattern or date, or another action, are left out.
    """
    keyed = entries.withColumn("pattern", pattern_key("pattern"))
    known = keyed.where(
        F.col("list").isNotNull()
        & F.col("pattern").isNotNull()
        & F.col("dated").isNotNull()
        & F.col("action").isin("add", "remove")
    )
    once = known.groupBy("list", "pattern", "dated").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "pattern").orderBy("dated")
    changes = once.withColumn("before", F.lag("action").over(order)).where(
        F.col("before").isNull() | (F.col("before") != F.col("action"))
    )
    ended = changes.withColumn("valid_to", F.lead("dated").over(order)).where("action = 'add'")
    forever = F.lit(_FOREVER).cast(entries.schema["dated"].dataType)
    return ended.select(
        "list", "pattern", F.col("dated").alias("valid_from"), F.coalesce("valid_to", forever).alias("valid_to")
    )


def listed_at_fetch(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at") -> DataFrame:
    """Captures with their columns, each once for every interval that covers it at its fetch: `hit` (underscores are
    added where a column has that name) with list, pattern, valid_from, valid_to.

    An interval holds from its start to just before its end. Captures without a URL, host or time are in no list. Rows
    that repeat are each judged. A frequent host makes a large group on the captures' side only; a pattern has as many
    intervals as its list had changes. The keys of a URL are as many as it has domain labels and path parts.
    """
    rows = captures.select(
        F.struct("*").alias("row"), F.col(fetched).alias("at"), F.explode(url_keys(url)).alias("key")
    )
    valid = intervals(entries).withColumn("of", F.col("pattern"))
    covered = (F.col("key") == F.col("of")) & (F.col("at") >= F.col("valid_from")) & (F.col("at") < F.col("valid_to"))
    return rows.join(valid, covered).select("row.*", F.struct("list", "pattern", "valid_from", "valid_to").alias(free_name(captures.columns, "hit")))


def judge(
    captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_at"
) -> DataFrame:
    """Every capture once, with its key, url, fetch time, `blocked`, the number of covering `hits` and the first of them
    by list and pattern (`hit_list`, `hit_pattern`).

    Captures are told apart by key, URL and time: rows that repeat all three are one result each, with equal verdicts.
    """
    slim = captures.select(F.col(key).alias("page"), F.col(url).alias("url"), F.col(fetched).alias("at"))
    hits = (
        listed_at_fetch(slim.distinct(), entries, "url", "at")
        .groupBy("page", "url", "at")
        .agg(F.count("*").alias("hits"), F.min(F.struct("hit.list", "hit.pattern")).alias("first"))
        .select(F.col("page").alias("of_page"), F.col("url").alias("of_url"), F.col("at").alias("of_at"), "hits", "first")
    )
    same = (
        F.col("page").eqNullSafe(F.col("of_page")) & (F.col("url") == F.col("of_url")) & (F.col("at") == F.col("of_at"))
    )
    return slim.join(hits, same, "left").select(
        F.col("page").alias(key),
        F.col("url").alias(url),
        F.col("at").alias(fetched),
        F.col("hits").isNotNull().alias("blocked"),
        F.coalesce("hits", F.lit(0)).alias("hits"),
        F.col("first.list").alias("hit_list"),
        F.col("first.pattern").alias("hit_pattern"),
    )
