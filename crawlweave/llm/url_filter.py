"""URL filters by hash prefixes.

Every distinct URL is expanded in two steps. Its host suffixes are joined to the hosts that rules have, on a few bytes of
their digests, and full digests confirm. Where a suffix is some rule's host, the path prefixes as long as that host's rules
are made and joined to the rules in the same way. The longest rule decides. So the expressions of a URL follow the dots in
its host and the lengths of the rules for that very host, however many other rules there are and however long they are.

There is one plan for rules of every number: both sides are dealt out by the digest prefix and a salt of the URL, as a
suffix like ``com`` occurs in nearly every URL; where the rules are small, Spark itself sends them to every task by their
measured size. A URL that occurs a million times is judged once.

A null URL, or one without ``://``, has an empty host and path, fits no rule and gets the default verdict. Repeated
rows stay repeated. Rules with a null host or verdict are ignored, a null path counts as empty; of equal rules a
block wins, and of equally long ones the one with the longer host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import ascii_lower
from crawlweave.session import stage

#: Copies of every rule, each for a share of the URLs.
SALTS = 16
#: Hexadecimal digits of the digest that are joined on.
PREFIX_DIGITS = 8

def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ``A``-``Z`` lower-cased; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digested(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumn("_digest", digest).withColumn("_prefix", F.conv(F.substring("_digest", 1, PREFIX_DIGITS), 16, 10).cast("long"))


def prepare_rules(rules: DataFrame) -> DataFrame:
    """``host``, ``path``, ``verdict`` to distinct rules."""
    kept = rules.select(
        F.col("host").alias("_host"), F.coalesce(F.col("path"), F.lit("")).alias("_path"), F.col("verdict").alias("_verdict")
    ).where("_host is not null and _host <> '' and _verdict is not null")
    one = kept.groupBy("_host", "_path").agg(F.max("_verdict").alias("_verdict"))
    return stage(one.withColumn("_rule", F.concat("_host", "_path")), "rules")


def suffixes(host: Column) -> Column:
    """The host and what follows each of its dots."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _met(made: DataFrame, expression: Column, known: DataFrame, named: Column) -> DataFrame:
    """Rows of ``made`` whose expression is that of a row in ``known``: joined by digest prefix and salt, confirmed by the full digest."""
    salted = _digested(known, named).withColumnRenamed("_digest", "_full").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    made = _digested(made, expression).withColumn("_salt", F.pmod(F.xxhash64("_h", "_p"), F.lit(SALTS)).cast("int"))
    met = made.join(stage(salted, "digests"), ["_prefix", "_salt"]).where("_digest = _full")
    return met.drop("_prefix", "_salt", "_digest", "_full")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; columns of those names are replaced."""
    ready = prepare_rules(rules)
    hosts = ready.groupBy("_host").agg(F.collect_set(F.length("_path")).alias("_lengths"))
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    distinct = pages.where("host <> ''").select(F.col("host").alias("_h"), F.col("path").alias("_p")).distinct()
    suffixed = distinct.select("_h", "_p", F.explode(suffixes(F.col("_h"))).alias("_suffix"))
    at_home = _met(suffixed, F.col("_suffix"), hosts, F.col("_host")).select("_h", "_p", "_suffix", F.explode("_lengths").alias("_n"))
    whole = at_home.where(F.length("_p") >= F.col("_n")).withColumn("_start", F.substring(F.col("_p"), F.lit(1), F.col("_n")))
    met = _met(whole, F.concat("_suffix", "_start"), ready, F.col("_rule"))
    rank = F.struct(F.length("_rule").alias("n"), F.length("_host").alias("h"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))
    best = met.groupBy("_h", "_p").agg(F.max(rank).alias("_best"))
    joined = pages.join(best, (F.col("host") == F.col("_h")) & (F.col("path") == F.col("_p")), "left")
    columns = {"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}
    return joined.withColumns(columns).drop("_h", "_p", "_best")
