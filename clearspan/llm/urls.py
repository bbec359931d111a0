"""URL rules by expressions of host suffix and path prefix.

Each URL is expanded into the texts ``host suffix + path prefix`` that a rule could have. They
are matched to the rules on a short prefix of their SHA-256 digest, then on the whole digest; of the
rules that fit, the longest text wins, and of equally long ones block wins over allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "host string, path string, verdict string"
DEFAULT_VERDICT = "allow"
#: Hex digits of the digest that the join uses: 32 bits.
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and every parent domain of it."""
    labels = F.split(host, r"\.")
    all_of = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    return F.filter(all_of, lambda s: s != "")


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    """The beginnings of the path that are as long as the path of some rule."""
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, RULE_SCHEMA)


def _digests(df: DataFrame, expression: Column) -> DataFrame:
    hashed = df.withColumn("__digest", F.sha2(expression, 256))
    return hashed.withColumn("__short", F.substring("__digest", 1, SHORT))


def matched(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """The winning rule of each (host, path) that some rule fits: ``host, path, rule, verdict``."""
    usable = rules.where("host <> '' AND path IS NOT NULL").select(
        F.concat("host", "path").alias("rule"), F.col("path").alias("rule_path"), "verdict"
    )
    lengths = sorted(r[0] for r in usable.select(F.length("rule_path")).distinct().collect())
    # Rules of one text: block before allow, as "block" sorts after "allow".
    usable = usable.groupBy("rule").agg(F.max("verdict").alias("verdict"), F.first("rule_path").alias("rule_path"))
    listed = _digests(usable, F.col("rule")).select(
        F.col("__short").alias("__rule_short"), F.col("__digest").alias("__rule_digest"), "rule", "verdict"
    )
    pairs = hosts.where("host <> ''").withColumn("__suffix", F.explode(host_suffixes(F.col("host"))))
    pairs = pairs.withColumn("__prefix", F.explode(path_prefixes(F.col("path"), lengths)))
    tried = _digests(pairs, F.concat("__suffix", "__prefix"))
    hits = tried.join(listed, F.col("__short") == F.col("__rule_short")).where("__digest = __rule_digest")
    best = F.max(F.struct(F.length("rule").alias("n"), F.col("verdict"), F.col("rule"))).alias("best")
    return hits.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    A rule (host, path, verdict) fits its host and all subdomains if the path of the URL starts with
    the rule's. Without a rule ``rule`` is null and the verdict is ``default``. A null URL, or one
    without ``://``, has an empty host and path and fits no rule. Repeated rows are judged each; a
    null ``page_id`` stays null. Other columns of ``pages`` are neither read nor returned. Rules
    with an empty host or a null path fit nothing; without rules all URLs get the default. URLs of any length are
    taken whole; an empty table gives no rows.
    """
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    parsed = urls.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    winners = matched(parsed.select("host", "path").distinct(), rules)
    found = winners.select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), "rule", F.col("verdict").alias("__verdict")
    )
    joined = parsed.join(found, (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")), "left")
    verdict = F.coalesce("__verdict", F.lit(default)).alias("verdict")
    return joined.select("page_id", "host", "path", "rule", verdict)
