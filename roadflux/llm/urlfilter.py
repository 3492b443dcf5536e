"""URL filter with redirect equivalence, in DataFrame operations only.

A url that a rule fits gets that rule's verdict (the longest rule wins).  The
others are judged by equivalence: redirects (``meta refresh``) and canonical
links found in the pages, plus any given (src, dst) table, tie urls into
connected components.  In a component an explicit allow takes precedence over a
block, and a block passes to every alias; without either the url is allowed.

A few rules are compiled into the plan; a longer list, or a table of rules, is joined
by host suffix and path prefix, so any number of rules will do.

Link targets are resolved as a browser would: entities are decoded, a scheme
counts at the start only, ``//host``, ``/path``, ``?query`` and relative paths
follow the page, ``.`` and ``..`` are removed.  All links of a page count.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule, no aliases and verdict allow.  A null html has no links; self-links, links to a place
in the page (``#x``), to other kinds of address (``mailto:``) and
without a target are ignored.  Repeated rows are judged alike.  Ties between
rules of equal length go to allow.  Null rules are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_UPPER, checkpointed, rekey
from .components import connected_components

#: Beyond this a list of rules is joined; the plan, not the result, depends on it.
MAX_RULES = 100
Rules = list[tuple[str, str]] | DataFrame
#: The entities that may stand in an address; the ampersand is decoded last.
ENTITIES = [("quot", '"'), ("apos", "'"), ("#39", "'"), ("lt", "<"), ("gt", ">"), ("#47", "/"), ("#x2[fF]", "/"), ("#58", ":"), ("#x3[aA]", ":"), ("amp", "&"), ("#38", "&"), ("#x26", "&")]


def with_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """df with host, path, full (path and query, no fragment) and node of a url column.

    Every step is a column of its own, so no expression is repeated in the plan.
    node is the key of the url's equivalence node: host, path (at least /, without
    dot segments) and query, whatever the scheme and fragment; null without a host part.
    """
    rest, host, after, path, full, node = (f"{prefix}{x}" for x in ("rest", "host", "after", "path", "full", "node"))
    known = F.instr(url, "://") > 0
    df = df.withColumn(rest, F.when(known, F.substr(F.col(url), F.instr(url, "://") + 3)).otherwise(""))
    df = df.withColumns({host: F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ASCII_UPPER, ASCII_UPPER.lower()), after: F.regexp_replace(rest, "^[^/?#]*", "")})
    df = df.withColumns({path: F.regexp_extract(after, "^[^?#]*", 0), full: F.regexp_extract(after, "^[^#]*", 0)})
    query = F.substr(F.col(full), F.length(path) + 1)
    key = F.concat(F.col(host), undotted(F.col(path)), query)
    return df.withColumn(node, F.when(known, F.xxhash64(key))).drop(rest, after)


def undotted(path: Column) -> Column:
    """A path without ``.`` and ``..``; the empty path is /."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)),
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))),
    )
    ends = F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path == "", "/").when(path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"), ends)).otherwise(path)


def fitting_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """struct(verdict, rule) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def rule_hits(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, hit) of distinct places(host, path) that one of rules(verdict, rule) fits; hit as by ``fitting_rule``.

    Every host suffix that can be a rule's host meets the rules' hosts, then every path prefix
    of a length that this host's rules have meets the rules themselves: all equi-joins.
    """
    rules = rules.where("verdict is not null and rule is not null").select("verdict", "rule", F.substring_index("rule", "/", 1).alias("name"), F.concat(F.lit("/"), F.regexp_replace("rule", "^[^/]*/?", "")).alias("start")).distinct()
    rules = checkpointed(rules)
    labels = rules.agg(F.max(F.size(F.split("name", r"\.")))).first()[0] or 0
    own = F.split("host", r"\.")
    few = F.slice(own, F.greatest(F.size(own) - labels + 1, F.lit(1)), F.lit(max(labels, 1)))
    suffixes = F.transform(F.sequence(F.lit(1), F.size("few")), lambda i: F.array_join(F.slice("few", i, F.size("few")), "."))
    spread = places.select("host", "path").distinct().withColumn("few", few).select("host", "path", F.explode(suffixes).alias("name"))
    lengths = rules.select("name", F.length("start").alias("n")).distinct().groupBy("name").agg(F.collect_list("n").alias("lengths"))
    cut = spread.join(lengths, "name").select("host", "path", "name", F.explode("lengths").alias("n")).where(F.length("path") >= F.col("n"))
    met = cut.withColumn("start", F.substr(F.col("path"), F.lit(1), F.col("n"))).join(rules, ["name", "start"])
    best = F.max(F.struct(F.length("rule").alias("size"), (F.col("verdict") == "allow").alias("allow"), F.struct("verdict", "rule").alias("hit")))
    return met.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.hit")


def link_targets(pages: DataFrame) -> DataFrame:
    """(src, dst) urls of canonical links and meta refreshes, relative targets resolved."""
    links = F.regexp_extract_all("html", F.lit(r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"), F.lit(0))
    metas = F.regexp_extract_all("html", F.lit(r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"), F.lit(0))
    target = lambda tag, name: F.regexp_extract(tag, rf"(?is)\b{name}\s*=\s*[\"']?([^\"'\s>]+)", 1)
    tags = F.concat(F.transform(links, lambda x: target(x, "href")), F.transform(metas, lambda x: target(x, "url")))
    likely = F.lower("html").rlike("http-equiv|canonical")
    to = reduce(lambda out, e: F.regexp_replace(out, f"&{e[0]};", e[1]), ENTITIES, F.col("tag"))
    found = pages.where(F.col("url").contains("://") & likely).select("url", F.explode(tags).alias("tag")).select("url", to.alias("to"))
    found = found.where((F.col("to") != "") & ~F.col("to").startswith("#") & (F.col("to").rlike("^[A-Za-z][A-Za-z0-9+.-]*://") | ~F.col("to").rlike("^[A-Za-z][A-Za-z0-9+.-]*:")))
    found = with_parts(found, "url").withColumn("scheme", F.substring_index("url", "://", 1))
    root = F.concat("scheme", F.lit("://"), "host")
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace("path", "[^/]*$", ""), "^/", ""))
    resolved = (
        F.when(F.col("to").rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat("scheme", F.lit(":"), "to"))
        .when(F.col("to").startswith("/"), F.concat(root, "to"))
        .when(F.col("to").startswith("?"), F.concat(root, F.when(F.col("path") == "", "/").otherwise(F.col("path")), "to"))
        .otherwise(F.concat(root, folder, "to"))
    )
    return found.select(F.col("url").alias("src"), resolved.alias("dst"))


def judged(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, component) for every row of pages(page_id, url, html)."""
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    links = link_targets(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")))
    links = links.where("src is not null and dst is not null")
    if isinstance(rules, list) and len(rules) > MAX_RULES:
        rules = pages.sparkSession.createDataFrame(rules, "verdict string, rule string")
    # a checkpoint, as filters on the nodes would otherwise be pushed below and repeat all of this
    tied = checkpointed(with_parts(with_parts(links, "src", "s_"), "dst", "d_").select("src", "dst", "s_node", "d_node"))
    parts = connected_components(tied.select(F.col("s_node").alias("u"), F.col("d_node").alias("v")))

    def with_hit(df: DataFrame) -> DataFrame:
        df = with_parts(df, "url")
        if isinstance(rules, DataFrame):
            return df.join(rule_hits(df, rules), ["host", "path"], "left")
        return df.withColumn("hit", fitting_rule(rules, F.col("host"), F.col("path")))

    ends = with_hit(tied.select(F.explode(F.array("src", "dst")).alias("url"))).where("hit is not null")
    told = ends.groupBy("node").agg(F.max(F.col("hit.verdict") == "allow").alias("allow"), F.max(F.col("hit.verdict") == "block").alias("block"))
    whole = parts.join(told.select(rekey("node"), "allow", "block"), "node").groupBy("component").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    aliases = parts.join(whole.select(rekey("component"), "allow", "block"), "component", "left").select(rekey("node"), "component", "allow", "block")

    own = with_hit(pages.select("page_id", "url")).join(aliases, "node", "left")
    inherited = F.when(F.coalesce("allow", F.lit(False)), "allow").when(F.coalesce("block", F.lit(False)), "block").otherwise("allow")
    return own.select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", inherited).alias("verdict"), "component")
