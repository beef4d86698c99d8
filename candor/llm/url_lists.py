"""URL filtering with dated lists.

List entries are dated events: from ``day`` on, ``pattern`` (a domain) is or is not listed in ``category``. Consecutive
events of one pattern and category become validity intervals ``[valid_from, valid_to)``. A capture is judged as of
its fetch day: it is blocked if its host, or a parent domain of it, is in an interval that holds that day.

Hosts are looked up, not captures: each distinct host meets the list once, so a host with a third of all
captures costs one row there; captures then join their host's intervals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candor.llm.common import cut

# Hosts and intervals that are broadcast, counted together: about 50 MB as a hashed relation.
MAX_BROADCAST_SPANS = 300_000
# The authority ends at the first of / ? # and backslash; the host stands after its last @, an address in brackets is whole, and a port is left out.
HOST = r"^[a-z][a-z0-9+.-]*://([^/?#\\]*@)?(\[[^\]/?#\\@]*\]|[^/?#\\:@\[\]]*)"
ADDRESS = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"


def host_of(url: Column) -> Column:
    """Lower-case host, without user, port and final dot; an IPv6 address keeps its brackets; NULL where there is none."""
    host = F.rtrim(F.regexp_extract(F.lower(url), HOST, 2), F.lit("."))
    return F.when(host != "", host)


def parent_domains(host: Column) -> Column:
    """The host and all domains above it, longest first; an address has none above it."""
    labels = F.split(host, r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host.rlike(ADDRESS), F.array(host)).otherwise(names)


def validity_intervals(entries: DataFrame) -> DataFrame:
    """``pattern, category, valid_from, valid_to`` of ``entries(pattern, category, day, listed)``.

    Events of one day count as one: a removal wins. Rows with a NULL are left out. A pattern has at most one
    event a day, which bounds the window's groups.
    """
    known = entries.select(F.lower("pattern").alias("pattern"), "category", "day", "listed").dropna()
    daily = known.groupBy("pattern", "category", "day").agg(F.min("listed").alias("listed"))
    w = Window.partitionBy("pattern", "category").orderBy("day")
    return daily.withColumn("valid_to", F.lead("day").over(w)).where("listed").select("pattern", "category", F.col("day").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", day: str = "fetched_on") -> DataFrame:
    """``key, host, fetched_on, blocked, categories, pattern`` for every capture.

    ``categories`` are those active on the day (sorted, comma-joined), ``pattern`` the longest active domain. Captures without
    a host or day are not blocked. Repeated rows are each answered; other columns are ignored.
    """
    caps = captures.select(F.col(key).alias(key), host_of(F.col(url)).alias("host"), F.col(day).alias("fetched_on"))
    spans = (validity_intervals(entries).groupBy("pattern")
             .agg(F.collect_list(F.struct("category", "valid_from", "valid_to")).alias("spans")))
    domains = caps.where("host is not null").select("host").distinct().select("host", F.explode(parent_domains(F.col("host"))).alias("pattern"))
    named = F.transform("spans", lambda s: F.struct(F.col("pattern").alias("pattern"), s["category"].alias("category"),
                                                    s["valid_from"].alias("valid_from"), s["valid_to"].alias("valid_to")))
    hosts = cut(domains.join(spans, "pattern").groupBy("host").agg(F.flatten(F.collect_list(named)).alias("spans")))
    size = hosts.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    small = size <= MAX_BROADCAST_SPANS
    # Captures without a host stay out of the join, where they would be one key.
    known = caps.where("host is not null").join(F.broadcast(hosts) if small else hosts, ["host"], "left")
    joined = known.unionByName(caps.where("host is null"), allowMissingColumns=True)
    now = F.col("fetched_on")
    active = F.coalesce(F.filter("spans", lambda s: (s["valid_from"] <= now) & (s["valid_to"].isNull() | (now < s["valid_to"]))), F.array())
    longest = F.array_max(F.transform("active", lambda s: F.struct(F.length(s["pattern"]).alias("n"), s["pattern"].alias("pattern"))))
    return joined.withColumn("active", active).select(
        key, "host", "fetched_on", (F.size("active") > 0).alias("blocked"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("active", lambda s: s["category"]))), ",").alias("categories"),
        longest["pattern"].alias("pattern"))


# ---------------------------------------------------------------------------------------------
# Captures and list entries derived from a table of pages (which has neither days nor lists)
# ---------------------------------------------------------------------------------------------

FIRST_DAY, DAYS, EVENTS = "2020-01-01", 1461, 6
CATEGORIES = ("adult", "malware", "phishing", "spam")


def _number(hexes: Column, first: int, n: int) -> Column:
    return F.conv(F.substring(hexes, first, n), 16, 10).cast("int")


def dated_captures(pages: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Pages with a fetch day taken from the key's MD5."""
    h = F.md5(F.concat(F.lit("fetch|"), F.col(key).cast("string")))
    return pages.select(key, url, F.date_add(F.lit(FIRST_DAY).cast("date"), _number(h, 1, 4) % DAYS).alias("fetched_on"))


def dated_entries(pages: DataFrame, url: str = "url") -> DataFrame:
    """Up to ``EVENTS`` list events per host, on the host or its parent domain, all taken from MD5 of host and number."""
    hosts = pages.select(host_of(F.col(url)).alias("host")).where("host is not null").distinct()
    each = hosts.select("host", F.explode(F.array(*map(F.lit, range(EVENTS)))).alias("k"))
    h = each.withColumn("h", F.md5(F.concat_ws("|", "host", F.col("k").cast("string")))).where(_number(F.col("h"), 1, 1) < 8)
    parent = F.regexp_replace("host", r"^[^.]*\.", "")
    return h.select(
        F.when(_number(F.col("h"), 2, 1) < 12, F.col("host")).otherwise(parent).alias("pattern"),
        F.element_at(F.array(*map(F.lit, CATEGORIES)), _number(F.col("h"), 3, 1) % 4 + 1).alias("category"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _number(F.col("h"), 4, 4) % DAYS).alias("day"),
        (_number(F.col("h"), 8, 1) < 10).alias("listed"))
