"""URL filter: rules first, then a path-template tree learned per host.

A url's path is a chain of segments. Segments that vary by shape (numbers,
hex strings) are wildcards at once. Level by level, down to the end of the
longest path, each branch of a host's tree becomes a wildcard if its labelled
block rate can't be told from that of its siblings (a two-proportion test), so
similar branches and branches without labels merge. A template's purity is its
share of blocked labels, smoothed towards its parent's purity, the host's
towards the rate of all labels; templates of high purity are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyprep.llm.common import Scratch, sized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain, and its path as a prefix."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    """The path's segments, wildcards where the shape varies."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.when(
        s.rlike(r"^[0-9]+(\.[A-Za-z]{1,5})?$") | s.rlike(r"^[0-9a-fA-F-]{8,}$"), F.lit("*")).otherwise(s))


#: Levels of a tree that are planned together when purities are summed.
LEVELS_AT_ONCE = 4


def learn_templates(urls: DataFrame, scratch: Scratch, z: float, strength: float) -> DataFrame:
    """(host, segs, template, purity) from (host, segs, label): a row per distinct chain of segments."""
    sums = [F.sum("lab").alias("lab"), F.sum("blk").alias("blk")]
    p = urls.groupBy("host", "segs").agg(F.count("label").alias("lab"), F.coalesce(F.sum("label"), F.lit(0)).alias("blk"))
    p = scratch.cut(p.withColumn("t", F.col("segs")), "chains")
    depth, made = p.agg(F.max(F.size("t"))).first()[0] or 0, "chains"
    for level in range(depth):
        c = p.where(F.size("t") > level).groupBy("host", F.slice("t", 1, level).alias("pre"), F.col("t")[level].alias("seg")).agg(*sums)
        up = c.groupBy(F.col("host").alias("h"), F.col("pre").alias("pp")).agg(F.sum("lab").alias("ul"), F.sum("blk").alias("ub"), F.count("*").alias("kids"))
        c = c.join(up, (F.col("host") == F.col("h")) & (F.col("pre") == F.col("pp"))).where("seg <> '*' and kids > 1")
        rest_lab, pooled = F.col("ul") - F.col("lab"), F.col("ub") / F.col("ul")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("lab") + 1 / rest_lab))
        gap = F.abs(F.col("blk") / F.col("lab") - (F.col("ub") - F.col("blk")) / rest_lab)
        # a branch without labels can't be told from the others; the only one with labels can
        same = F.when(F.col("lab") == 0, F.lit(True)).when(rest_lab == 0, F.lit(False)).otherwise(gap <= z * spread)
        wild = scratch.cut(c.where(same).select(F.col("host").alias("wh"), F.col("pre").alias("wp"), F.col("seg").alias("ws")), f"wild-{level}")
        p = p.join(sized(wild, 128), (F.col("host") == F.col("wh")) & (F.slice("t", 1, level) == F.col("wp")) & (F.get("t", F.lit(level)) == F.col("ws")), "left")
        star = F.concat(F.slice("t", 1, level), F.array(F.lit("*")), F.slice(F.col("t"), level + 2, depth + 1))
        p = scratch.cut(p.withColumn("t", F.when(F.col("wh").isNotNull(), star).otherwise(F.col("t"))).drop("wh", "wp", "ws"), f"level-{level}")
        scratch.drop(made, f"wild-{level}")
        made = f"level-{level}"
    rate = p.agg(F.sum("blk").alias("b"), F.sum("lab").alias("l")).first()
    p = p.withColumn("purity", F.lit(rate["b"] / rate["l"] if rate["l"] else 0.0))
    for level in range(depth + 1):
        s = p.groupBy(F.col("host").alias("h"), F.slice("t", 1, level).alias("pp")).agg(F.sum("lab").alias("sl"), F.sum("blk").alias("sb"))
        p = p.join(s, (F.col("host") == F.col("h")) & (F.slice("t", 1, level) == F.col("pp")))
        # shorter chains end where they are: their last purity stands
        smoothed = (F.col("sb") + strength * F.col("purity")) / (F.col("sl") + strength)
        p = p.withColumn("purity", F.when(F.size("t") >= level, smoothed).otherwise(F.col("purity"))).drop("h", "pp", "sl", "sb")
        if level % LEVELS_AT_ONCE == LEVELS_AT_ONCE - 1:
            p = scratch.cut(p, f"purity-{level}")
            scratch.drop(made)
            made = f"purity-{level}"
    return p.select("host", "segs", F.concat(F.lit("/"), F.array_join("t", "/")).alias("template"), "purity")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", z: float = 1.96, strength: float = 10.0, reject: float = 0.8) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every row.

    ``rules`` are (allow or block, host, path). Urls that a rule fits have its
    verdict and are the labelled rows that the tree learns from; others are
    blocked if their template's purity is at least ``reject``. Paths of any
    length are learned whole, a level after the other. Null urls and
    urls without '://' have an empty host and path, and no labels there means
    they are allowed. Repeated rows are judged alike; other columns are not
    read; an empty table gives an empty result.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    u = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = first_rule(rules, F.col("host"), F.col("path"))
    u = u.withColumn("rule", rule).withColumn("given", verdict).withColumn("segs", segments(F.col("path")))
    u = scratch.cut(u.withColumn("label", (F.col("given") == "block").cast("long")), "urls")
    t = scratch.cut(learn_templates(u, scratch, z, strength), "templates")
    t = t.withColumnsRenamed({"host": "th", "segs": "ts"})
    out = u.join(sized(t, 256), (F.col("host") == F.col("th")) & (F.col("segs") == F.col("ts")), "left")
    learned = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("given", learned).alias("verdict"), "template", "purity")
