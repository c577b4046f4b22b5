"""URL filter by association rules.

FP-growth mines combinations of URL tokens that go with bad pages; rules below a confidence or a support are pruned.
Pages are matched through an inverted index from token to rule: a rule fits a page that has all its tokens. Listed
rules for hosts and paths go first. Everything is DataFrame functions and Spark's own FP-growth.

Defined cases: a NULL url or one without ``://`` has an empty host, path and token set, fits no rule and is allowed.
Repeated pages each get a row. Without labelled pages, or without bad ones, there are no mined rules. Labels with
NULLs count as good. Extra columns are ignored.
"""

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlake.llm.stash import Stash

BAD = "label:bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class ListedRule:
    """A verdict for a host with its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    rest = F.coalesce(_rest(url), F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Sorted distinct tokens: labels of the host, parts of the path and names of the query, digits as ``#``."""
    query = F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^?#]*\\?([^#]*)", 1)

    def parts(text: Column, at: str, kind: str) -> Column:
        plain = F.regexp_replace(text, "[0-9]+", "#")
        return F.transform(F.filter(F.split(plain, at), lambda x: x != ""), lambda x: F.concat(F.lit(kind), x))

    names = F.regexp_replace(query, "=[^&]*", "")
    found = F.concat(parts(host_of(url), "[.:]", "h:"), parts(path_of(url), "/", "p:"), parts(names, "&", "q:"))
    return F.array_sort(F.array_distinct(found))


def mine_rules(
    labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.6, min_rows: int = 20
) -> DataFrame:
    """Rules ``tokens, confidence, support`` for bad pages from ``labelled(tokens, bad)``.

    A rule needs ``min_support`` of the pages, and ``min_rows`` of them, to be bad and have its tokens.
    """
    bad = F.when(F.coalesce("bad", F.lit(False)), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = labelled.select(F.concat("tokens", bad).alias("items")).where(F.size("items") > 0)
    n = baskets.count()
    if not n:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support double")
    support = min(1.0, max(min_support, min_rows / n))
    model = FPGrowth(minSupport=support, minConfidence=min_confidence).fit(baskets)
    return model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support"
    )


def match_rules(patterns: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens, mined_rule, confidence`` of the patterns that fit a rule; the most confident, then longest, wins.

    An inverted index holds a row per rule and token. A rule fits if as many of its tokens are met as it has.
    """
    index = rules.select(
        F.col("tokens").alias("mined_rule"), "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token")
    )
    own = patterns.select("tokens", F.explode("tokens").alias("token"))
    met = own.join(index, "token").groupBy("tokens", "mined_rule").agg(
        F.count("*").alias("met"), F.first("n").alias("n"), F.first("confidence").alias("confidence")
    )
    best = F.max(F.struct("confidence", "n", "mined_rule")).alias("best")
    return met.where("met = n").groupBy("tokens").agg(best).select("tokens", "best.mined_rule", "best.confidence")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    listed: list[ListedRule],
    min_support: float = 0.002,
    min_confidence: float = 0.6,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every page.

    ``pages`` has ``page_id`` and ``url``, ``labels`` has ``page_id`` and ``bad``. The longest fitting listed rule
    decides; if none fits, a page that fits a mined rule is blocked and others are allowed. Pages with the same tokens
    are matched once, so a host with a third of all pages costs no more than any other.
    """
    spark = pages.sparkSession
    stash = Stash(spark)
    rows = pages.select("page_id", "url", url_tokens(F.col("url")).alias("tokens"))
    marks = labels.select("page_id", "bad").where("page_id IS NOT NULL")
    rules = stash.keep(mine_rules(rows.join(marks, "page_id"), min_support, min_confidence), "rules")
    patterns = stash.keep(rows.select("tokens").distinct(), "patterns")
    blocked = stash.keep(match_rules(patterns, rules), "blocked")
    url = F.col("url")
    host, path = F.col("host"), F.col("path")
    by_length = sorted(listed, key=lambda r: (-len(r.text), r.text, r.verdict))
    rule = F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(host, path), F.lit(r.text)) for r in by_length])
    said = F.coalesce(F.lit(None).cast("string"), *[F.when(r.fits(host, path), F.lit(r.verdict)) for r in by_length])
    mined = F.when(F.col("mined_rule").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return (
        rows.join(blocked, "tokens", "left")
        .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "mined_rule", "confidence")
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, mined).alias("verdict"),
                "mined_rule", "confidence")
    )
