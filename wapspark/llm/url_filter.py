"""URL filters by path-template trees (operator 1).

Explicit rules decide what they fit. The rest is judged by a tree of path
templates for each host, grown level by level over all its paths at once:

* a segment that carries little of its parent's traffic is variable and
  becomes a wildcard, so a node has at most 1 / ``LITERAL_SHARE`` children
  beside the wildcard;
* children whose labelled shares a two-proportion test can't tell apart become
  one branch; children without labels become one branch, too;
* a template's share of blocked labels is smoothed by its parent's, from the
  whole table's down to its own, and it is rejected from ``REJECT`` on.

With ``across_hosts`` such trees are grown over all hosts, over the hosts of
each domain (a host's last two labels) and over each host, each within the one
before: a segment that is not kept takes its token of the wider tree, and only
branches of one token there may become one. So a host's template stands within
one template of its domain and that one within one over all hosts; level by
level its share is smoothed by the domain's, and that one by all hosts', and
all urls of one host and template have one verdict. A template that has no
labels in its host has those of other hosts. A segment whose labelled share
differs from its siblings' then stays whatever its traffic.

A tree that stands within no other tells the first ``DEPTH`` segments apart
everywhere, and further ones wherever the labels below still differ, however
deep; the rest of a path whose labels agree is one token.

Labels are the rules' verdicts on the urls that they fit; a frame of labels by
url may be given instead. Paths are counted once per host before a level is
grown, so repeated pages and large hosts shrink first, and only the few kept
children of a node meet in one task.

Defined results: a null url, or one without ``://``, has an empty host and
path and is judged like any other template; rows repeat and null ids are
carried through; without labels nothing is rejected. In a template's names,
``* { | }`` and the backslash of a segment itself follow a backslash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wapspark.session import ensure_checkpoint_dir, scratch_path

DEPTH = 4             # segments told apart everywhere; deeper ones where labels differ
LITERAL_SHARE = 0.05  # least share of its parent's urls for a segment to stay
LITERAL_URLS = 5      # and least number
SMOOTHING = 5.0       # labels that a parent's share counts for
REJECT = 0.7
Z = 1.96              # of the test that keeps branches apart
WILDCARD, REST = "*", "**"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between ``://`` and / ? # or the end, with A-Z folded; and
    from there up to ? # or the end. Both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as a struct of its
    text and verdict, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
                     ).otherwise(out)
    return out


def _alike(a: tuple, b: tuple) -> bool:
    """Whether two branches' (blocked, labelled) could be one's."""
    (x, n), (y, m) = a, b
    p = (x + y) / (n + m)
    spread = (p * (1 - p) * (1 / n + 1 / m)) ** 0.5
    return spread == 0 or abs(x / n - y / m) / spread < Z


def _name(segments: list[str]) -> str:
    return segments[0] if len(segments) == 1 else "{" + "|".join(sorted(segments)) + "}"


def merge_branches(children: pd.DataFrame) -> pd.DataFrame:
    """Tokens of the kept children of one node: in order of their blocked
    share, each joins the branch before it if they are alike."""
    rows = sorted(zip(children["seg"], children["bad"], children["lab"]),
                  key=lambda r: (r[2] == 0, r[1] / r[2] if r[2] else 0, r[0]))
    branches: list[tuple[list[str], int, int]] = []
    for seg, bad, lab in rows:
        if branches:
            names, x, n = branches[-1]
            if (n == 0) == (lab == 0) and (lab == 0 or _alike((x, n), (bad, lab))):
                branches[-1] = ([*names, seg], x + bad, n + lab)
                continue
        branches.append(([seg], bad, lab))
    first = children.iloc[0]
    return pd.DataFrame([(first["host"], first["prefix"], seg, _name(names))
                         for names, _, _ in branches for seg in names],
                        columns=["host", "prefix", "seg", "token"])


def _differs(bad: Column, lab: Column, all_bad: Column, all_lab: Column) -> Column:
    """Whether a segment's labels could not be its labelled siblings'."""
    n, x = all_lab - lab, all_bad - bad
    p = all_bad / all_lab
    gap = F.abs(F.try_divide(bad, lab) - F.try_divide(x, n))
    spread = F.sqrt(p * (1 - p) * (F.try_divide(F.lit(1), lab) + F.try_divide(F.lit(1), n)))
    return F.coalesce((lab > 0) & (n > 0) & (spread > 0) & (gap >= Z * spread), F.lit(False))


def _differing_nodes(deeper: DataFrame) -> DataFrame:
    """Nodes (host, prefix) whose labels differ."""
    return deeper.groupBy("host", "prefix").agg(
        F.sum("bad").alias("b"), F.sum("lab").alias("l")).filter(
        "0 < b and b < l").select("host", "prefix", F.lit(WILDCARD).alias("within"))


def _grow(rows: DataFrame, keep_differing: bool = False) -> DataFrame:
    """``rows`` (host, path, n, bad, lab, and ``wide`` if they are to stand
    within another tree's templates) with ``tokens``, their template."""
    spark, nested = rows.sparkSession, "wide" in rows.columns
    segments = F.transform(F.filter(F.split("path", "/", -1), lambda s: s != ""),
                           lambda s: F.regexp_replace(s, r"([\\*{|}])", r"\\$1"))
    rows = rows.withColumn("segs", segments).withColumn("tokens", F.array().cast("array<string>"))
    columns = [c for c in rows.columns if c != "tokens"]
    goes_on = (F.size("segs") > F.size("tokens")) & ~F.array_contains("tokens", REST)
    depth = 0
    while not rows.filter(goes_on).isEmpty():
        at = rows.withColumn("prefix", F.array_join("tokens", "/"))
        # The token of the tree around it, or else whether the node is divided.
        if nested:
            at = at.withColumn("within", F.get("wide", F.lit(depth)))
        elif depth < DEPTH:
            at = at.withColumn("within", F.lit(WILDCARD))
        else:
            at = at.join(_differing_nodes(at.filter(goes_on)), ["host", "prefix"], "left")
            at = at.withColumn("within", F.coalesce("within", F.lit(REST)))
        at = at.withColumn("seg", F.when(goes_on & (F.col("within") != REST),
                                         F.get("segs", F.lit(depth))))
        child = at.filter("seg is not null").groupBy("host", "prefix", "within", "seg").agg(
            *[F.sum(c).alias(c) for c in ("n", "bad", "lab")])
        parent = child.groupBy("host", "prefix").agg(
            F.sum("n").alias("all"), F.sum("bad").alias("all_bad"), F.sum("lab").alias("all_lab"))
        both = child.join(parent, ["host", "prefix"])
        large = (F.col("n") >= LITERAL_URLS) & (F.col("n") >= LITERAL_SHARE * F.col("all"))
        # Dealt anew, the few that stay leave the join free to split a large node.
        token = both.filter(large).drop("all", "all_bad", "all_lab").repartition(
            "host", "prefix", "seg").groupBy("host", "prefix", "within").applyInPandas(
            merge_branches, "host string, prefix string, seg string, token string")
        if keep_differing:
            # Any number of a node's segments: each is a branch, without a group.
            small = both.filter(~large & _differs(*map(F.col, ("bad", "lab", "all_bad", "all_lab"))))
            token = token.union(small.select("host", "prefix", "seg", F.col("seg").alias("token")))
        rows = at.join(token, ["host", "prefix", "seg"], "left").select(*columns, F.when(
            goes_on, F.concat("tokens", F.array(F.coalesce("token", "within")))
            ).otherwise(F.col("tokens")).alias("tokens"))
        # A level reads the one above twice: uncut, the plan would double each time.
        # Read again as a table, for a checkpoint keeps its plan's size estimate,
        # and that squares with each level's joins.
        path = scratch_path(spark, "url-level")
        rows.write.parquet(path)
        rows = spark.read.schema(rows.schema).parquet(path)
        depth += 1
    return rows.drop("segs")


def _lines(rows: DataFrame) -> DataFrame:
    """Per host and template (with its ``wide``, if any) its ``line``: blocked
    and all labels of its prefixes, from the root down."""
    wide = [F.first(c).alias(c) for c in ("wide",) if c in rows.columns]
    template = rows.groupBy("host", "tokens").agg(
        F.sum("bad").alias("bad"), F.sum("lab").alias("lab"), *wide)
    steps = template.select("*", F.explode(F.sequence(F.lit(0), F.size("tokens"))).alias("d"))
    steps = steps.withColumn("prefix", F.expr("slice(tokens, 1, d)"))
    node = steps.groupBy("host", "prefix").agg(F.sum("bad").alias("b"), F.sum("lab").alias("l"))
    return steps.drop("bad", "lab").join(node, ["host", "prefix"]).groupBy("host", "tokens").agg(
        F.array_sort(F.collect_list(F.struct("d", "b", "l"))).alias("line"), *wide)


def _share(line: Column, overall: float) -> Column:
    """The smoothed share at the end of a line."""
    return F.aggregate(line, F.lit(overall), lambda rate, x:
                       (x["b"] + SMOOTHING * rate) / (x["l"] + SMOOTHING))


def _per_host(paths: DataFrame) -> DataFrame:
    """Host, path, tokens and line of the trees of single hosts."""
    grown = _grow(paths)
    return grown.join(_lines(grown), ["host", "tokens"]).select("host", "path", "tokens", "line")


def _domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def _over_hosts(paths: DataFrame) -> DataFrame:
    """As ``_per_host``, each level of a line led by its domain's and, before
    that, by that of all hosts."""
    sums = [F.sum(c).alias(c) for c in ("n", "bad", "lab")]
    domains = paths.groupBy(_domain(F.col("host")).alias("host"), "path").agg(*sums).checkpoint()
    everywhere = domains.groupBy("path").agg(*sums).select(
        F.lit("").alias("host"), "path", "n", "bad", "lab").checkpoint()
    top = _grow(everywhere, True)
    middle = _grow(domains.join(top.select("path", F.col("tokens").alias("wide")), "path"), True)
    own = _grow(paths.withColumn("domain", _domain(F.col("host"))).join(middle.select(
        F.col("host").alias("domain"), "path", F.col("tokens").alias("wide")),
        ["domain", "path"]).drop("domain"), True)
    # A template stands within one of the wider tree, of as many levels.
    above = _lines(top).select(F.col("tokens").alias("wide"), F.col("line").alias("top"))
    above = _lines(middle).join(above, "wide").select(
        F.col("host").alias("domain"), F.col("tokens").alias("wide"),
        F.zip_with("top", "line", lambda a, b: F.array(a, b)).alias("above"))
    line = _lines(own).withColumn("domain", _domain(F.col("host"))).join(
        above, ["domain", "wide"]).select("host", "tokens", F.flatten(F.zip_with(
            "above", "line", lambda a, b: F.array_append(a, b))).alias("line"))
    return own.join(line, ["host", "tokens"]).select("host", "path", "tokens", "line")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", labels: DataFrame | None = None,
          across_hosts: bool = False) -> DataFrame:
    """Per row: the id, ``host``, ``path``, ``rule`` (null without one),
    ``verdict`` (allow or block), ``template`` and ``blocked_share``.

    ``labels`` (url, blocked boolean) replaces the rules' verdicts as labels;
    ``across_hosts`` lets labels count for other hosts' templates."""
    ensure_checkpoint_dir(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    paths = rows.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count_if(F.col("fit.verdict") == "block").alias("bad"),
        F.count("fit.verdict").alias("lab"))
    if labels is not None:
        given = labels.select(*[c.alias(n) for n, c in zip(("host", "path"), host_and_path(
            F.col("url")))], "blocked").groupBy("host", "path").agg(
            F.count_if("blocked").alias("bad"), F.count("blocked").alias("lab"))
        zero = F.lit(0).cast("long")
        paths = paths.select("host", "path", "n").join(given, ["host", "path"], "left").select(
            "host", "path", "n", F.coalesce("bad", zero).alias("bad"),
            F.coalesce("lab", zero).alias("lab"))
    paths = paths.checkpoint()
    total = paths.agg(F.sum("bad").alias("bad"), F.sum("lab").alias("lab")).first()
    overall = float((total["bad"] or 0) / total["lab"]) if total["lab"] else 0.0
    judged = (_over_hosts(paths) if across_hosts else _per_host(paths)).select(
        "host", "path", F.concat(F.lit("/"), F.array_join("tokens", "/")).alias("template"),
        _share(F.col("line"), overall).alias("blocked_share"))
    verdict = F.when(F.col("blocked_share") >= REJECT, "block").otherwise("allow")
    return rows.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", verdict).alias("verdict"), "template", "blocked_share")
