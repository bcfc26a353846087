"""URL rules by a sort-merge range join; DataFrame functions only.

A rule is (host, path, verdict). It fits its host and every subdomain, if the url's path starts with the rule's path; of
the fitting rules the one with the longest text host + path wins (then the longer host, then block before allow).

Keys. A host's canonical key is its labels reversed, each closed by a separator (``example.org`` -> ``org!example!``), so a
host and its subdomains are one interval of keys: from the key itself up to the key followed by the largest character. A
path prefix is an interval in the same way. Intervals of prefixes are nested or disjoint.

Sweep (``_innermost``). Points (urls) and interval starts (rules) are sorted together; a running window keeps the last
interval that has started. Each rule carries the stack of rules around it, so at a point the active rules are those
of that stack which still hold the point's key (the others have been popped). Two sweeps run: hosts against rule hosts, and
then each active host's paths against that host's rule paths.

Scale. Keys are dealt to ranges by bounds from a sample of `SAMPLE` keys; a key that fills several ranges is salted over
them by a hash of the row, and rules are copied to each range and salt they overlap. Rules are small beside urls, but never
broadcast; no range holds more than about a 1/`RANGES` part of the points.

Defined results: a null url, or one without "://", has empty host and path, no rule and the default verdict; empty tables give
no rows; repeated rows are judged each; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import table

RANGES = 64
SAMPLE = 20 * RANGES
#: Separates labels in a canonical key; sorts below every other character of a host.
SEP = "\u0001"
LAST = "\U0010ffff"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def with_host_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    cut = F.regexp_extract(rest, r"(?s)^([^/?#]*)(/[^?#]*)?", 1)
    path = F.regexp_extract(rest, r"(?s)^([^/?#]*)(/[^?#]*)?", 2)
    return pages.withColumns({"host": lower_az(cut), "path": path})


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), SEP), F.lit(SEP))


def _bounds(points: DataFrame, key: str, row: Column) -> list[str]:
    """Range bounds: quantiles of a fixed-size sample by a hash of the row; repeated bounds stand for hot keys."""
    rows = points.select(key, F.xxhash64(row, F.col(key)).alias("_h")).orderBy("_h").limit(SAMPLE).select(key).collect()
    keys = sorted(r[0] for r in rows)
    return [keys[i * len(keys) // RANGES] for i in range(1, RANGES)] if keys else []


def slot(key: Column, bounds: list[Column], strict: bool = False) -> Column:
    """How many of the sorted bounds are <= key (strict: < key), by binary search over a constant array."""
    if not bounds:
        return F.lit(0)
    held = F.array(*bounds)
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(s: Column, _: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        at = F.element_at(held, mid + 1)
        below = (at < key) if strict else (at <= key)
        return F.when(lo >= hi, s).when(below, F.struct((mid + 1).alias("lo"), hi.alias("hi"))).otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve)["lo"]


def _innermost(points: DataFrame, rules: DataFrame, row: Column) -> DataFrame:
    """points (key, ...) with `stack`: the rules (array of structs, field `lo`) whose interval [lo, lo + LAST) holds key.

    rules: (lo, stack), distinct lo; its stack holds the rule itself and the rules around it, outermost first."""
    bounds = [F.lit(b) for b in _bounds(points, "key", row)]
    kept = [c for c in points.columns]
    if bounds:
        first, last = slot(F.col("key"), bounds, True), slot(F.col("key"), bounds, False)
        points = points.withColumns({"_first": first, "_last": last})
        points = points.withColumn("_range", (F.col("_first") + F.pmod(F.xxhash64(row, F.col("key")), F.col("_last") - F.col("_first") + 1)).cast("int")).drop("_first", "_last")
        end = F.concat("lo", F.lit(LAST))
        rules = rules.withColumn("_range", F.explode(F.sequence(slot(F.col("lo"), bounds, True), slot(end, bounds, False))))
    else:
        points, rules = points.withColumn("_range", F.lit(0)), rules.withColumn("_range", F.lit(0))
    starts = rules.select("_range", F.col("lo").alias("key"), F.lit(0).alias("_kind"), F.col("stack").alias("_stack"))
    rows = points.withColumns({"_kind": F.lit(1), "_stack": F.lit(None).cast(rules.schema["stack"].dataType)})
    swept = rows.unionByName(starts, allowMissingColumns=True)
    # A range lists its points in key order; a rule that started in an earlier range was copied here and sorts first.
    last = Window.partitionBy("_range").orderBy("key", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = swept.withColumn("_open", F.last("_stack", ignorenulls=True).over(last)).filter("_kind = 1")
    active = F.filter(F.coalesce("_open", F.array().cast(rules.schema["stack"].dataType)), lambda r: F.col("key").startswith(r["lo"]))
    return swept.select(*kept, active.alias("stack"))


def _stacked(rules: DataFrame) -> DataFrame:
    """rules (lo, ...), distinct lo -> (lo, stack): structs of the rules whose lo is a prefix of this rule's, outermost first.

    A rule meets those around it by the prefixes of its own key: an equi-join as long as the rule table."""
    inner = rules.select(F.col("lo").alias("_in"), F.explode(F.transform(F.sequence(F.lit(1), F.length("lo")), lambda n: F.substring("lo", F.lit(1), n))).alias("lo"))
    around = inner.join(rules.select("lo", F.struct(*rules.columns).alias("_rule")), "lo")
    return around.groupBy(F.col("_in").alias("lo")).agg(F.array_sort(F.collect_list("_rule")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every url; rules: (host, path, verdict)."""
    rules = rules.select(lower_az(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host != ''")
    best = F.min_by("verdict", F.struct((F.col("verdict") != "block").alias("b"), "verdict"))
    rules = rules.groupBy("host", "path").agg(best.alias("verdict")).withColumn("lo", host_key(F.col("host")))
    urls = with_host_path(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    row = F.struct("_id", "path")
    # First sweep: the innermost rule host around each url's host.
    hosts = _stacked(rules.select("lo").distinct())
    found = _innermost(urls.withColumn("key", host_key(F.col("host"))), hosts, row)
    # Each rule host also takes over the rules of the hosts around it; of several for one path the innermost host's stays.
    of = hosts.select(F.col("lo").alias("_at"), F.explode("stack.lo").alias("lo")).join(rules, "lo")
    own = of.groupBy("_at", "path").agg(F.max_by(F.struct("host", "verdict"), F.length("lo")).alias("v"))
    paths = _stacked(own.select(F.concat("_at", F.lit(SEP), "path").alias("lo"), F.col("v.host"), "path", F.col("v.verdict")))
    # Second sweep: that host's rule paths around each url's path. A url under no rule host has a key that no rule holds.
    at = F.element_at("stack", -1)["lo"]
    asked = found.withColumn("key", F.when(F.size("stack") > 0, F.concat(at, F.lit(SEP), "path")).otherwise(F.lit("")))
    held = _innermost(asked.drop("stack"), paths, row)
    fit = F.transform("stack", lambda r: F.struct(F.length(r["host"]) + F.length(r["path"]), F.length(r["host"]), (r["verdict"] == "block").alias("b"), F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict")))
    won = F.array_max(fit)
    return held.select(F.col("_id").alias(id_col), "host", "path", won["rule"].alias("rule"), F.coalesce(won["verdict"], F.lit(default)).alias("verdict"))


RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against five nested rules."""
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


OP8_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)(/[^?#]*)?', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)(/[^?#]*)?', 2) AS path FROM cut
), rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.rverdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE n = 1
"""
