"""URL filter by path templates, in DataFrame operations only.

Paths are generalised host by host into a tree of templates: a segment that varies becomes a wildcard, sibling
branches that cannot be told apart by their shape become one, and each template gets the share of blocked pages among
its labelled ones, smoothed towards the share of its host and of all pages. Templates of a high share are rejected.
Labels come from the fixed rules; a page that no rule fits has the verdict of its template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.staging import write_shared

# Fixed values: (verdict, rule); a rule is a host and the start of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
VARIABLE = r"^([0-9]+|[0-9a-f]{8,}|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2})(\.[a-z]{1,5})?$"


@dataclass(frozen=True)
class Settings:
    """Templates have ``depth`` segments; deeper ones end in ``**``.

    A place in the tree varies if it has ``many`` values and fewer than ``mean_pages`` pages a value. Branches of a host
    are compared with its largest one that has ``least_labelled`` labelled pages, or its largest where none has. One
    merges into it where the test on their shares of the commonest tail stays below ``z`` and, if both have enough
    labelled pages, that on their shares of blocked ones does too. Shares are smoothed with ``weight`` pages of the
    level above. A merged template is rejected from ``reject`` on, with at least ``least_labelled`` labelled pages.
    """

    depth: int = 3
    many: int = 20
    mean_pages: float = 5.0
    z: float = 2.0
    weight: float = 5.0
    reject: float = 0.8
    least_labelled: int = 3


def parts(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty for NULL and for a url without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, SPLIT, 1), UPPER, LOWER), F.regexp_extract(url, SPLIT, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; NULL if none does."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, settings: Settings = Settings(), rules=RULES, taught: Column | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, template, share, template_verdict and verdict.

    ``share`` is the smoothed share of blocked pages of the page's merged template, ``template_verdict`` what follows
    from it, whatever the rules say of the page itself. Where ``taught`` is given, only ruled pages for which it holds
    count as labelled. A NULL or unparsable url has an
    empty host and path and the template of no segment. Repeated pages count as often as they come; other columns are
    ignored; an empty input gives no row.
    """
    host, path = parts(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"), *([] if taught is None else [taught.alias("taught")]))
    fit = split.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    ruled = fit.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("ruled"),
        _pattern(F.col("path"), settings.depth).alias("pattern"),
        F.when(F.lit(True) if taught is None else F.col("taught"), F.col("fit.verdict")).alias("label"),
    )
    patterns = ruled.groupBy("host", "pattern").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"),
        F.count_if(F.col("label") == "block").alias("blocked"),
    )
    verdicts = _templates(_generalised(_written(patterns), settings), settings)
    return ruled.join(verdicts, ["host", "pattern"], "left").select(
        "page_id", "host", "path", "rule", "template", "share",
        F.when(F.col("rejected"), "block").otherwise("allow").alias("template_verdict"),
        F.coalesce("ruled", F.when(F.col("rejected"), "block").otherwise("allow")).alias("verdict"),
    )


def _written(df: DataFrame) -> DataFrame:
    """Patterns are few beside pages, but every level reads them twice: each step is a written table."""
    return write_shared(df, "url-templates")[0]


def _pattern(path: Column, depth: int) -> Column:
    """The path with segments that vary by their form as ``*``, cut to ``depth`` segments, its last slash kept."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    shown = F.transform(F.slice(segments, 1, depth), lambda s: F.regexp_replace(s, VARIABLE, "*$3"))
    deeper = F.when(F.size(segments) > depth, "/**").otherwise("")
    slash = F.when(path.endswith("/") & (F.size(segments) > 0), "/").otherwise("")
    return F.concat(F.array_join(F.transform(shown, lambda s: F.concat(F.lit("/"), s)), ""), deeper, slash)


def _generalised(patterns: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``head`` and ``tail`` of the template: level by level, segments of a place that varies become ``*``."""
    segments = F.split(F.regexp_replace("pattern", "/$", ""), "/")
    tree = patterns.withColumn("segments", segments).withColumn("prefix", F.lit(""))
    for level in range(1, settings.depth + 1):
        here = tree.withColumn("segment", F.try_element_at("segments", F.lit(level + 1)))
        values = here.where("segment is not null").groupBy("host", "prefix", "segment").agg(F.sum("n").alias("n"))
        place = values.groupBy("host", "prefix").agg(F.count("*").alias("values"), F.sum("n").alias("pages"))
        varies = (F.col("values") >= settings.many) & (F.col("pages") < settings.mean_pages * F.col("values"))
        marked = place.select("host", "prefix", varies.alias("varies"))
        shown = F.when(F.col("varies") & ~F.col("segment").startswith("*"), "*").otherwise(F.col("segment"))
        longer = F.when(F.col("segment").isNull(), F.col("prefix")).otherwise(F.concat("prefix", F.lit("/"), shown))
        head = {"head": F.coalesce(shown, F.lit(""))} if level == 1 else {}
        longer_tree = here.join(marked, ["host", "prefix"], "left").withColumns({"prefix": longer} | head)
        tree = _written(longer_tree.drop("varies", "segment"))
    deeper = F.when(F.col("pattern").rlike(r"/[*][*]/?$"), "/**").otherwise("")
    slash = F.when(F.col("pattern").endswith("/"), "/").otherwise("")
    rest = F.substr("prefix", F.length("head") + 2)
    return tree.select("host", "pattern", "n", "labelled", "blocked", "head", F.concat(rest, deeper, slash).alias("tail"))


def _templates(tree: DataFrame, settings: Settings) -> DataFrame:
    """Verdict of each (host, pattern) by its merged template."""
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    tails = tree.groupBy("host", "tail").agg(F.sum("n").alias("n"))
    common = tails.groupBy("host").agg(F.max(F.struct("n", "tail")).alias("top")).select("host", F.col("top.tail").alias("common"))
    counted = tree.join(common, "host").withColumn("n_common", F.when(F.col("tail") == F.col("common"), F.col("n")).otherwise(0))
    branches = counted.groupBy("host", "head").agg(*sums, F.sum("n_common").alias("n_common"))
    kinds = _written(branches.withColumn("known", F.col("labelled") >= settings.least_labelled))
    largest = kinds.groupBy("host").agg(F.max(F.struct("known", "n", "head", "labelled", "blocked", "n_common")).alias("r"))
    alike = _alike("n_common", "n", "r.n_common", "r.n", settings.z) & (
        ~F.col("known") | ~F.col("r.known") | _alike("blocked", "labelled", "r.blocked", "r.labelled", settings.z)
    )
    merged = kinds.join(largest, "host").select(
        "host", "head", F.when(alike, F.col("r.head")).otherwise(F.col("head")).alias("branch")
    )
    named = _written(tree.join(merged, ["host", "head"]).drop("n"))
    hosts = tree.groupBy("host").agg(*sums)
    overall = tree.agg((F.sum("blocked") / F.greatest(F.sum("labelled"), F.lit(1))).alias("overall")).scalar()
    smooth = lambda above: (F.col("blocked") + settings.weight * above) / (F.col("labelled") + settings.weight)
    by_host = hosts.select("host", smooth(overall).alias("host_share"))
    templates = named.groupBy("host", "branch", "tail").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
    shares = templates.join(by_host, "host").withColumn("share", F.round(smooth(F.col("host_share")), 6))
    rejected = (F.col("share") >= settings.reject) & (F.col("labelled") >= settings.least_labelled)
    judged = shares.select("host", "branch", "tail", "share", rejected.alias("rejected"))
    template = F.concat(F.lit("/"), "branch", "tail")
    return named.join(judged, ["host", "branch", "tail"]).select(
        "host", "pattern", template.alias("template"), "share", "rejected"
    )


def _alike(hits: str, of: str, other_hits: str, other_of: str, z: float) -> Column:
    """Whether two shares pass as equal in the two-proportion test (squared, so that no root is taken)."""
    a, n, b, m = (F.col(c).cast("double") for c in (hits, of, other_hits, other_of))
    pooled = F.try_divide(a + b, n + m)
    variance = pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), m))
    gap = F.try_divide(a, n) - F.try_divide(b, m)
    return gap * gap <= z * z * variance
