"""URL filters by a path-template tree.

Rules decide the URLs that they fit; those verdicts are the labels from which the rest is judged. Each
host has a tree of path segments. Down the tree, a segment stays literal where it has a fair share of
its parent's URLs; all others are variable and become ``*``. Siblings whose shares of blocked URLs don't
differ significantly are merged into one branch (``{de,nl}``). A template's purity is the share of
blocked URLs among its labelled ones, smoothed by its parent's, the host's by that of all URLs; URLs of
templates at or over ``IMPURE`` are blocked.

Segments below ``DEPTH`` are one variable rest (``**``), a step of its own: longer paths have a template
and a purity apart from the path that ends there. Only counts are grouped: by host and segment,
combined before they are shuffled.

Defined results: a null URL, or one without ``://``, has an empty host and path and is a template of its
own; URLs that no label reaches are judged by the share of all; without any label everything is allowed;
repeated rows are judged alike; existing columns of the added names are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored

#: Levels of the tree; least share and number of a parent's URLs that keep a segment literal.
DEPTH, SHARE, LEAST = 3, 0.05, 3
#: Labelled URLs that a parent's purity counts for; purity from which a template is blocked; the normal
#: deviate from which shares differ.
PRIOR, IMPURE, DEVIATE = 4.0, 0.9, 1.96

# Verdict and URL prefix (host and path); the longest that fits wins.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Stands for a segment that a path doesn't have: no segment can hold it.
NONE = "/"
#: The step for all segments below DEPTH.
REST = "**"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits (struct of verdict and rule), else null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def _segment(k: int) -> Column:
    """The k-th segment of the path, from 1; all below ``DEPTH`` are the rest."""
    path = F.col("_path")
    segments = F.split(F.when(path.startswith("/"), F.substring(path, 2, F.length(path))).otherwise(path), "/")
    own = F.get(segments, k - 1) if k <= DEPTH else F.when(F.size(segments) > DEPTH, REST)
    return F.when(path == "", NONE).otherwise(F.coalesce(own, F.lit(NONE)))


def parsed(pages: DataFrame, url: str, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``pages`` with _host, _path, _rule and the segments _s1, _s2, ..."""
    own = pages.withColumns({"_host": host_of(F.col(url)), "_path": path_of(F.col(url))})
    return own.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules)).withColumns(
        {f"_s{k}": _segment(k) for k in range(1, DEPTH + 2)})


def _generalised(rows: DataFrame, literal: DataFrame, k: int) -> DataFrame:
    """``rows`` with _t<k>: the segment where it is literal, else the wild card."""
    keys = ["_host", *(f"_t{i}" for i in range(1, k)), f"_s{k}"]
    segment = F.col(f"_s{k}")
    step = F.when((segment == NONE) | F.col("_literal"), segment).otherwise("*")
    return rows.join(literal, keys, "left").withColumn(f"_t{k}", step).drop("_literal", f"_s{k}")


def _literals(counts: DataFrame, k: int) -> DataFrame:
    """The segments of level k that stay literal: at most 1 / SHARE for each parent."""
    parent = ["_host", *(f"_t{i}" for i in range(1, k))]
    own = counts.groupBy(*parent, f"_s{k}").agg(F.sum("n").alias("_n")).where(F.col("_n") >= LEAST)
    total = counts.groupBy(*parent).agg(F.sum("n").alias("_total"))
    return own.join(total, parent).where(F.col("_n") >= SHARE * F.col("_total")).select(
        *parent, f"_s{k}", F.lit(True).alias("_literal"))


def _branches(nodes: DataFrame, parent: list[str], step: str) -> DataFrame:
    """``nodes`` with the labels of the merged branch that each belongs to, and its name.

    Siblings stand in the order of their blocked shares; a branch ends where the next share differs
    significantly. Siblings without labels are a branch apart. A parent has few children.
    """
    tried = F.col("labelled") + 2.0
    nodes = nodes.withColumn("_known", F.col("labelled") > 0).withColumn("_p", (F.col("blocked") + 1.0) / tried)
    nodes = nodes.withColumn("_v", F.col("_p") * (1 - F.col("_p")) / tried)
    w = Window.partitionBy(*parent, "_known").orderBy("_p", step)
    differs = F.abs(F.col("_p") - F.lag("_p").over(w)) > DEVIATE * F.sqrt(F.col("_v") + F.lag("_v").over(w))
    nodes = nodes.withColumn("_new", F.coalesce(differs, F.lit(False)).cast("int"))
    nodes = nodes.withColumn("_branch", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    own = Window.partitionBy(*parent, "_known", "_branch")
    names = F.array_sort(F.collect_set(step).over(own))
    name = F.when(F.size(names) > 1, F.concat(F.lit("{"), F.array_join(names, ","), F.lit("}"))).otherwise(names[0])
    return (nodes.withColumns({"labelled": F.sum("labelled").over(own), "blocked": F.sum("blocked").over(own), "_name": name})
            .drop("_known", "_p", "_v", "_new", "_branch"))


def templates(counts: DataFrame) -> DataFrame:
    """(_host, _t1, ..., template, purity) from the counts of generalised paths."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    all_ = counts.agg(*sums).first()
    prior = (all_["blocked"] or 0) / max(1, all_["labelled"] or 0)
    smoothed = (F.col("blocked") + PRIOR * F.col("_parent")) / (F.col("labelled") + PRIOR)
    nodes = counts.groupBy("_host").agg(*sums).withColumn("_parent", F.lit(prior)).select(
        "_host", F.col("_host").alias("template"), smoothed.alias("purity"))
    for k in range(1, DEPTH + 2):
        parent = ["_host", *(f"_t{i}" for i in range(1, k))]
        own = _branches(counts.groupBy(*parent, f"_t{k}").agg(*sums), parent, f"_t{k}")
        above = nodes.withColumnsRenamed({"purity": "_parent", "template": "_above"})
        step = F.when(F.col(f"_t{k}") == NONE, "").otherwise(F.concat(F.lit("/"), F.col("_name")))
        purity = smoothed
        if k > DEPTH:  # a node without longer paths stays as it is
            own = own.withColumn("_longer", F.max(F.col(f"_t{k}") == REST).over(Window.partitionBy(*parent)))
            step = F.when(F.col(f"_t{k}") == NONE, "").otherwise(f"/{REST}")
            purity = F.when(F.col("_longer"), smoothed).otherwise(F.col("_parent"))
        nodes = own.join(above, parent).select(
            *parent, f"_t{k}", F.concat("_above", step).alias("template"), purity.alias("purity"))
    return nodes


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule (or null), verdict, template and purity."""
    rows = parsed(pages, url, rules)
    rule = F.col("_rule")
    steps = [f"_s{k}" for k in range(1, DEPTH + 2)]
    counts = stored(rows.groupBy("_host", *steps).agg(
        F.count("*").alias("n"), F.count(rule).alias("labelled"),
        F.count(F.when(rule["verdict"] == "block", 1)).alias("blocked")), "url-counts")
    for k in range(1, DEPTH + 1):
        literal = stored(_literals(counts, k), f"url-literals-{k}")
        counts, rows = _generalised(counts, literal, k), _generalised(rows, literal, k)
    counts, rows = (df.withColumnRenamed(f"_s{DEPTH + 1}", f"_t{DEPTH + 1}") for df in (counts, rows))
    keys = ["_host", *(f"_t{k}" for k in range(1, DEPTH + 2))]
    judged = rows.join(stored(templates(stored(counts, "url-paths")), "url-templates").withColumnsRenamed(
        {"template": "_template", "purity": "_purity"}), keys, "left")
    learned = F.when(F.col("_purity") >= IMPURE, "block").otherwise("allow")
    return judged.withColumns({
        "host": F.col("_host"), "path": F.col("_path"), "rule": rule["rule"],
        "verdict": F.coalesce(rule["verdict"], learned), "template": F.col("_template"), "purity": F.col("_purity"),
    }).drop(*keys, "_path", "_rule", "_template", "_purity")
