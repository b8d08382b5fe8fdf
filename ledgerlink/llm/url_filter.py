"""URL filter: rules first, then a tree of path templates per host.

Every host gets a tree over the segments of its paths. Segments that look like
numbers, dates or hashes, and those too rare among their siblings, become
wildcards of their shape. Sibling branches then merge if their next segments and
their labels do not differ by more than a Hoeffding bound. What a rule decides,
and what a label says, counts as labelled; the share of blocked among labelled
pages of a node, smoothed towards that of the node above, rejects a template.

The tree is grown level by level, for all hosts at once, over the distinct paths
with their counts. A node keeps a bounded number of branches (a literal needs
its share of the node's pages, wildcards are few), so only bounded groups are
gathered, however large a host is.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import log, sqrt

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlink.llm.common import ascii_lower, saved

#: Fixed rules of the query: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: A literal segment is kept if it has this share of its node's pages, and at least so many.
LITERAL_SHARE, LITERAL_PAGES = 0.02, 4
#: Chance to hold two alike branches for different.
ALPHA = 0.05
#: Pages that the rate of the node above counts for.
SMOOTHING = 10.0
#: Least smoothed share of not blocked pages.
LEAST_PURITY = 0.5
#: Segments of a template; what lies deeper is one segment.
DEPTH = 6
_END, _REST = "<end>", "<rest>"
#: Suffixes that stay in a wildcard; any other suffix is ".*".
_SUFFIXES = ("html", "htm", "php", "asp", "aspx", "jsp", "pdf", "xml", "json", "txt", "jpg", "png", "gif")
#: (wildcard, pattern of the whole segment without suffix, always a wildcard); the first that fits counts.
SHAPES = (
    ("<num>", "[0-9]+", True),
    ("<date>", "[0-9]{4}-[0-9]{1,2}(-[0-9]{1,2})?", True),
    ("<uuid>", "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", True),
    ("<hex>", "(?=[a-fA-F]*[0-9])[0-9a-fA-F]{8,}", True),
    ("<slug>", "[^-_]+([-_]+[^-_]+){2,}", False),
    ("<mixed>", "(?s:.*[0-9].*)", False),
    ("<word>", "(?s:.*)", False),
)


def host_of(url: Column) -> Column:
    """The host in lower case (A-Z only): after the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]], pick: int | None = None) -> Column:
    """The longest rule that fits, as ``host + path``, or its verdict if ``pick`` is 0; else null.

    A rule fits its host and all subdomains if the path starts with the rule's.
    Of equally long rules the first in order of verdict, host and path counts.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    found = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule[1]) | F.endswith(host, F.lit("." + rule[1]))) & F.startswith(path, F.lit(rule[2]))
        found = F.when(fits, rule[0] if pick == 0 else rule[1] + rule[2]).otherwise(found)
    return found


def shape(segment: Column, always_only: bool = False) -> Column:
    """The wildcard of a segment; with ``always_only`` other segments stay as they are."""
    stem = F.regexp_replace(segment, r"\.[A-Za-z][A-Za-z0-9]{0,4}$", "")
    ending = ascii_lower(F.regexp_extract(segment, r"\.([A-Za-z][A-Za-z0-9]{0,4})$", 1))
    suffix = (
        F.when(ending == "", "").when(ending.isin(*_SUFFIXES), F.concat(F.lit("."), ending)).otherwise(".*")
    )
    found = segment
    for name, pattern, always in reversed(SHAPES):
        if always or not always_only:
            found = F.when(F.regexp(stem, F.lit(f"^(?:{pattern})$")), F.concat(F.lit(name), suffix)).otherwise(found)
    wild = F.regexp(segment, F.lit(r"^<[a-z]+>(\.[a-z*]+)?$"))
    return F.when(wild, segment).otherwise(found)


def segments_of(path: Column, depth: int = DEPTH) -> Column:
    """The segments with the always variable ones as wildcards; empty segments are left out.

    Opening brackets of literals are doubled, so that no literal looks like a
    wildcard or a merged branch.
    """
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    doubled = lambda s: F.replace(F.replace(s, F.lit("<"), F.lit("<<")), F.lit("{"), F.lit("{{"))
    safe = F.transform(F.slice(parts, 1, depth), lambda s: shape(doubled(s), True))
    return F.when(F.size(parts) > depth, F.concat(safe, F.array(F.lit(_REST)))).otherwise(safe)


def _differ(a: dict, n_a: float, b: dict, n_b: float, alpha: float) -> bool:
    """Whether two sets of counts differ in any share by more than the Hoeffding bound."""
    room = sqrt(0.5 * log(2 / alpha)) * (1 / sqrt(n_a) + 1 / sqrt(n_b))
    return any(abs(a.get(k, 0) / n_a - b.get(k, 0) / n_b) > room for k in {**a, **b})


def _merge_node(rows: pd.DataFrame, alpha: float, smoothing: float) -> pd.DataFrame:
    """The branches of one node: tokens alike in next segments and labels share one.

    Tokens come by falling number of pages and join the first branch that they
    do not differ from. A branch without labels never joins one with labels.
    """
    tokens = []
    for token, part in rows.groupby("token", sort=True):
        follow = dict(zip(part["next"], part["n"], strict=True))
        tokens.append((-part["n"].sum(), token, follow, part["labelled"].sum(), part["blocked"].sum()))
    branches: list[list] = []
    for size, token, follow, labelled, blocked in sorted(tokens, key=lambda t: t[:2]):
        for branch in branches:
            if (branch[2] > 0) != (labelled > 0) or _differ(branch[1], branch[0], follow, -size, alpha):
                continue
            if labelled and _differ({1: branch[3]}, branch[2], {1: blocked}, labelled, alpha):
                continue
            break
        else:
            branch = [0, {}, 0, 0, []]
            branches.append(branch)
        branch[0] -= size
        branch[1] = {k: branch[1].get(k, 0) + follow.get(k, 0) for k in {**branch[1], **follow}}
        branch[2] += labelled
        branch[3] += blocked
        branch[4].append(token)
    first = rows.iloc[0]
    out = {}
    for _, _, labelled, blocked, names in branches:
        name = names[0] if len(names) == 1 else "{" + "|".join(sorted(names)) + "}"
        rate = float((blocked + smoothing * first["rate"]) / (labelled + smoothing))
        out |= {token: {"branch": name, "rate": rate} for token in names}
    return pd.DataFrame([{"host": first["host"], "node": first["node"], "branches": out}])


def path_templates(paths: DataFrame, alpha: float = ALPHA, smoothing: float = SMOOTHING) -> DataFrame:
    """(host, key, template, rate) of (host, key, segments, n, labelled, blocked) rows.

    ``rate`` is the smoothed share of blocked among the labelled pages of the
    template, by way of the nodes above it, the host and all pages. Where nothing
    is labelled it is one half.
    """
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    rows = saved(paths, "url-paths")
    whole = rows.agg(*sums, F.max(F.size("segments")).alias("deep")).first()
    if whole.n is None:
        return rows.select("host", "key", F.lit("").alias("template"), F.lit(0.5).alias("rate"))
    base = (whole.blocked + 1) / (whole.labelled + 2)
    hosts = rows.groupBy("host").agg(*sums[1:]).select(
        "host", ((F.col("blocked") + smoothing * base) / (F.col("labelled") + smoothing)).alias("rate")
    )
    rows = saved(rows.withColumn("node", F.lit("")).join(hosts, "host"), "url-level")
    for level in range(whole.deep):
        rows = saved(_next_level(rows, level, alpha, smoothing), "url-level")
    return rows.select("host", "key", F.col("node").alias("template"), "rate")


def _next_level(rows: DataFrame, level: int, alpha: float, smoothing: float) -> DataFrame:
    """``rows`` with the branch of their segment ``level`` added to ``node``, and its rate."""
    columns = rows.columns
    at = F.get("segments", F.lit(level))
    after = F.get("segments", F.lit(level + 1))
    here = rows.where(F.size("segments") > level).withColumn("segment", at)
    node = ["host", "node"]
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    follows = here.groupBy(*node, "rate", "segment", F.coalesce(shape(after), F.lit(_END)).alias("next")).agg(*sums)
    children = follows.groupBy(*node, "segment").agg(F.sum("n").alias("pages"))
    totals = children.groupBy(*node).agg(F.sum("pages").alias("total"))
    enough = (F.col("pages") >= LITERAL_PAGES) & (F.col("pages") >= LITERAL_SHARE * F.col("total"))
    literals = children.join(totals, node).where(enough).select(*node, "segment", F.lit(True).alias("literal"))
    token = F.when(F.col("literal"), F.col("segment")).otherwise(shape(F.col("segment")))
    tokens = (
        follows.join(literals, [*node, "segment"], "left")
        .groupBy(*node, "rate", token.alias("token"), "next").agg(*sums)
    )
    merged = tokens.groupBy(*node).applyInPandas(
        lambda part: _merge_node(part, alpha, smoothing),
        "host string, node string, branches map<string,struct<branch:string,rate:double>>",
    )
    taken = F.coalesce(F.try_element_at("branches", "segment"), F.try_element_at("branches", shape(F.col("segment"))))
    return (
        rows.withColumn("segment", at).join(merged, node, "left")
        .withColumn("taken", F.when(F.col("segment").isNotNull(), taken))
        .withColumn("node", F.when(F.col("taken").isNotNull(), F.concat("node", F.lit("/"), "taken.branch")).otherwise(F.col("node")))
        .withColumn("rate", F.coalesce("taken.rate", "rate"))
        .select(*columns)
    )


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]] = RULES,
    blocked: Column | None = None,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(key, host, path, rule, verdict, template, purity) of every row of ``pages``.

    ``verdict`` is that of the longest rule that fits; without one, ``block`` if
    the template's smoothed purity is below :data:`LEAST_PURITY`, else
    ``allow``. ``blocked`` (a boolean column, null if unknown) labels pages that no
    rule decides. A null URL, or one without ``://``, has an empty host and path and is
    judged like any other. Repeated rows give repeated results and count as
    often; null keys stay; other columns are ignored; an empty table gives an
    empty result.
    """
    rules = list(rules)
    label = F.lit(None).cast("boolean") if blocked is None else blocked
    split = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), label.alias("label"))
    host, path = F.col("host"), F.col("path")
    ruled = split.select(
        key, "host", "path", segments_of(path).alias("segments"),
        longest_rule(host, path, rules).alias("rule"), longest_rule(host, path, rules, 0).alias("ruled"),
        "label",
    ).withColumn("key", F.array_join("segments", "/"))
    known = F.coalesce(F.col("ruled") == "block", F.col("label"))
    paths = ruled.groupBy("host", "key").agg(
        F.any_value("segments").alias("segments"),
        F.count(F.lit(1)).alias("n"),
        F.count(known).alias("labelled"),
        F.count(F.when(known, 1)).alias("blocked"),
    )
    templates = path_templates(paths)
    purity = 1 - F.col("rate")
    return ruled.join(templates, ["host", "key"]).select(
        key, "host", "path", "rule",
        F.coalesce("ruled", F.when(purity < LEAST_PURITY, "block").otherwise("allow")).alias("verdict"),
        "template", purity.alias("purity"),
    )
