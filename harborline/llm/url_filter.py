"""URL filters with redirect equivalence; DataFrame functions only.

Rules of hosts and path prefixes judge urls; the longest that fits wins. Urls tied together by redirects and canonical
links form components; a url that no rule fits is blocked if its component holds a blocked url and no url that a rule
allows. Explicit rules always stand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

#: (host, path, verdict) of the production rules.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

HOT = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' for null or no ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url):
    """After the host up to ?, # or the end; '' for null or no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address(url):
    """What redirects and canonical links name: host, path and query, without scheme and fragment; null without ://."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    full = F.concat(host_of(url), F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url)), query)
    return F.when(F.instr(url, "://") > 0, full)


def plain(value):
    """An attribute's value with the character references of &, quotes, /, = and ? decoded, &amp; last."""
    for pattern, to in ((r"&(?:#0*47|#x0*2f|sol);", "/"), (r"&(?:#0*61|#x0*3d|equals);", "="), (r"&(?:#0*63|#x0*3f|quest);", "?"), (r"&(?:quot|#0*34|#x0*22);", '"'), (r"&(?:apos|#0*39|#x0*27);", "'"), (r"&(?:amp|#0*38|#x0*26);", "&")):
        value = F.regexp_replace(value, "(?i)" + pattern, to)
    return value


def resolved(base, to):
    """A link's target as an absolute url, on the url of its page: RFC 3986 for hierarchical urls; other schemes (no ://) stay as they are."""
    scheme, host = F.regexp_extract(base, r"(?s)^(.*?://)", 1), host_of(base)
    target_path, tail = F.regexp_extract(to, r"(?s)^([^?#]*)", 1), F.regexp_extract(to, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1)
    merged = F.when(to.startswith("/"), target_path).otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), target_path))
    # segments in order: . stays nowhere, .. takes the last away; a . or .. at the end leaves a folder
    parts = F.slice(F.split(merged, "/"), 2, 1 << 30)
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda done, x: F.when(x == ".", done).when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x))))
    path = F.concat(F.lit("/"), F.array_join(walked, "/"))
    path = F.when(merged.rlike(r"/\.\.?$") & ~path.endswith("/"), F.concat(path, F.lit("/"))).otherwise(path)
    same = F.when(path_of(base) == "", F.lit("/")).otherwise(path_of(base))
    query = F.regexp_extract(base, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    relative = F.when(to.startswith("?"), F.concat(same, to)).when(to.startswith("#"), F.concat(same, query)).otherwise(F.concat(path, tail))
    return F.when(to.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), to).when(to.startswith("//"), F.concat(F.lit("http:"), to)).otherwise(F.concat(scheme, host, relative))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses tied by the canonical links and immediate redirects of a page; relative targets resolved on the page's url.

    Links inside comments, scripts and styles are none.
    """
    h, u = F.col(html), F.col(url)
    attr = r"""(?is)<(?:link)\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
    move = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?\s*([^"'\s>;]+(?:;[^"'\s>;]+)*)"""
    named = F.lower(h).contains("canonical") | F.lower(h).contains("refresh")
    hidden = r"""(?is)<!--(?:>|->|.*?(?:-->|\z))|<(script|style)\b[^>]*>.*?(?:</\1\b|\z)"""
    shown = F.regexp_replace(h, hidden, " ")
    every = F.concat(F.regexp_extract_all("shown", F.lit(attr), F.lit(1)), F.regexp_extract_all("shown", F.lit(move), F.lit(1)))
    targets = pages.where(named & h.isNotNull() & u.isNotNull()).select(u.alias("from_url"), shown.alias("shown")).select("from_url", F.explode(every).alias("to")).where("to <> ''")
    targets = targets.select("from_url", plain(F.col("to")).alias("to"))
    return targets.select(address(F.col("from_url")).alias("a"), address(resolved(F.col("from_url"), F.col("to"))).alias("b")).where("a is not null and b is not null")


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Of (host, path): the longest rule that fits, and its verdict; null where none does.

    Every host is expanded to its parent domains, which meet rules by equality; rules of a host travel as one array. Hosts
    with more than 1 / HOT of all rows, so fewer than HOT of them, meet their rules by a broadcast, the others by a shuffle.
    """
    by_host = rules.groupBy(F.col("host").alias("rule_host")).agg(F.collect_set(F.struct(F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))).alias("rules"))
    hosts = written(urls.groupBy("host").agg(F.count("*").alias("n")), "hosts")
    rows = hosts.agg(F.sum("n")).first()[0] or 0
    labels = F.split("host", r"\.")
    parents = F.expr("transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels) - i + 1), '.'))")
    fits = hosts.withColumn("labels", labels).select("host", F.explode(parents).alias("rule_host")).join(by_host, "rule_host")
    fits = fits.select("host", "rule_host", F.explode("rules").alias("r"))
    rule = F.concat("rule_host", "r.rule_path")
    fits = fits.select("host", F.struct(F.length(rule).alias("size"), F.col("r.rule_path").alias("rule_path"), rule.alias("rule"), F.col("r.rule_verdict").alias("verdict")).alias("r"))
    fits = fits.groupBy("host").agg(F.sort_array(F.collect_list("r"), asc=False).alias("fits"))
    fits = written(hosts.join(fits, "host", "left"), "fits")
    hot = F.broadcast(fits.where(F.col("n") * HOT > rows).drop("n"))
    found = urls.join(hot, "host").unionByName(urls.join(hot, "host", "left_anti").join(fits.drop("n"), "host", "left")).withColumn("best", F.expr("try_element_at(filter(fits, f -> startswith(path, f.rule_path)), 1)"))
    return found.withColumn("rule", F.col("best.rule")).withColumn("rule_verdict", F.col("best.verdict")).drop("fits", "best")


def judge(pages: DataFrame, rules: DataFrame, more_links: DataFrame | None = None) -> DataFrame:
    """One row for each page: page_id, host, path, rule, verdict.

    more_links: further (a, b) addresses, such as a redirect log. Urls that are null or hold no :// have empty host and
    path; no rule fits, and they are allowed. Of rules of equal length that fit, the one whose path, then verdict is greater
    stands. Repeated pages and null ids are judged like others, a row each; very long urls and pages are read whole. Empty
    tables give no rows; further columns are ignored.
    """
    p = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    edges = links(p)
    if more_links is not None:
        edges = edges.union(more_links.select("a", "b"))
    edges = written(edges.distinct(), "links")
    urls = p.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address(F.col("url")).alias("address"))
    own = ruled(urls, rules)
    if edges.isEmpty():
        return own.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", F.lit("allow")).alias("verdict"))
    member = written(components(edges), "aliases")
    named = member.select("node", "component", F.substring_index("node", "/", 1).alias("host"), F.concat(F.lit("/"), F.substring_index(F.expr("substring(node, instr(node, '/') + 1)"), "?", 1)).alias("path"))
    said = ruled(named, rules).groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("allowed"), F.max(F.col("rule_verdict") == "block").alias("blocked"))
    spread = member.join(said, "component").select(F.col("node").alias("address"), (F.coalesce("blocked", F.lit(False)) & ~F.coalesce("allowed", F.lit(False))).alias("alias_blocked"))
    out = own.join(spread, "address", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.coalesce("alias_blocked", F.lit(False)), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def rule_table(spark, rules=RULES) -> DataFrame:
    rows = F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(r, ("host", "path", "verdict"), strict=True)]) for r in rules])
    return spark.range(1).select(F.explode(rows).alias("r")).select("r.*")


# The tables' pages hold no links, so the rules alone decide there; with links, tests compare against brute force.
ORACLE_SQL = r"""
with u as (select page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') path from pages),
r(h, p, v) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
f as (select u.page_id, max(struct_pack(n := length(h || p), rule := h || p, v := v)) best from u join r on (u.host = h or ends_with(u.host, '.' || h)) and starts_with(u.path, p) group by 1)
select u.page_id, u.host, u.path, f.best.rule as rule, coalesce(f.best.v, 'allow') as verdict from u left join f using (page_id)
"""
