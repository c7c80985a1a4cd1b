"""Operator 10: URL filtering by mined association rules.

Each URL becomes a set of tokens (scheme, host labels and suffixes, words of
the path, file ending, query keys; numbers become '#'). FP-growth over the
labelled pages mines token combinations that go with bad labels; a rule
survives with enough support, confidence and lift. Rules match by an inverted
index: each is filed under its rarest token, distinct token sets are looked up
by token, and a rule holds if the set has all of its tokens.

A page's label is that of the document whose number stands alone in its path;
bad means toxic = 1 or quality = 0, of several labels the worst counts.

``verdicts`` first applies a policy of (host, path) rules, longest fit first,
and takes the mined rules' word for the rest.

Defined results: a null URL, or one without '://', has empty host and path and
no tokens, so no rule matches it; pages without label are judged but not
learnt from; without labelled or bad pages nothing is blocked by mining;
repeated rows are judged alike; other columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_lower, join_on, written

MIN_SUPPORT = 0.001
#: Labelled pages that a rule's tokens and label share at least.
MIN_COUNT = 20
MIN_CONFIDENCE = 0.5
MIN_LIFT = 1.5
BAD = "label=bad"

#: (host, path, verdict)
POLICY = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
          ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    cutting = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (ascii_lower(F.coalesce(F.regexp_extract(url, cutting, 1), F.lit(""))),
            F.coalesce(F.regexp_extract(url, cutting, 2), F.lit("")))


def policy_rule(host: Column, path: Column, policy=POLICY) -> tuple[Column, Column]:
    """Text (host and path) and verdict of the longest policy rule that fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(policy, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column) -> Column:
    """Sorted distinct tokens of a URL; empty without '://'."""
    host, path = parts(url)
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    query = F.regexp_extract(url, r"(?s)://[^?#]*\?([^#]*)", 1)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    last_two = F.when(F.size(labels) > 1, F.array(F.concat(F.lit("site:"), F.array_join(F.slice(labels, -2, 2), "."))))
    words = F.filter(F.split(path, r"[^A-Za-z0-9_\-]+"), lambda x: x != "")
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, "^([^=]*)", 1)), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    none = F.array().cast("array<string>")
    number = lambda x: F.when(x.rlike("^[0-9]+$"), F.lit("#")).otherwise(ascii_lower(x))
    found = F.concat(
        F.array(F.concat(F.lit("scheme:"), ascii_lower(scheme))),
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        F.coalesce(last_two, none),
        F.transform(words, lambda x: F.concat(F.lit("path:"), number(x))),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
        F.when(ending != "", F.array(F.concat(F.lit("ending:"), ending))).otherwise(none))
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(found))).otherwise(none)


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens and ``bad`` (0 or 1) of the labelled pages."""
    bad = F.greatest((F.col("toxic") == 1).cast("int"), (F.col("quality") == 0).cast("int"))
    lab = labels.groupBy("doc_id").agg(F.max(bad).alias("bad")).where("doc_id is not null and bad is not null")
    number = F.regexp_extract(parts(F.col("url"))[1], r"/([0-9]+)(?:\.[A-Za-z0-9]+)?/?$", 1)
    p = pages.select(tokens(F.col("url")).alias("tokens"), number.try_cast("long").alias("doc_id"))
    return p.where("doc_id is not null and size(tokens) > 0").join(lab, "doc_id").select("tokens", "bad")


def mine(pages: DataFrame, labels: DataFrame, support: float = MIN_SUPPORT, count: int = MIN_COUNT,
         confidence: float = MIN_CONFIDENCE, lift: float = MIN_LIFT) -> DataFrame:
    """Rules: ``needs`` (sorted tokens), ``confidence``, ``lift``, ``key`` (the rarest token)."""
    spark = pages.sparkSession
    rows = written(labelled(pages, labels), "url-labelled")
    n = rows.count()
    kind = T.StructType([T.StructField("needs", T.ArrayType(T.StringType())), T.StructField("confidence", T.DoubleType()),
                         T.StructField("lift", T.DoubleType()), T.StructField("key", T.StringType())])
    if not n or not rows.where("bad = 1").take(1):
        return spark.createDataFrame([], kind)
    baskets = rows.select(F.when(F.col("bad") == 1, F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=max(support, count / n), minConfidence=confidence).fit(baskets)
    rules = (model.associationRules.where(F.array_contains("consequent", BAD)).where(F.col("lift") >= lift)
             .select(F.array_sort("antecedent").alias("needs"), "confidence", "lift"))
    often = rows.select(F.explode("tokens").alias("key")).groupBy("key").agg(F.count("*").alias("often"))
    filed = rules.select("*", F.explode("needs").alias("key")).join(often, "key")
    rarest = F.min(F.struct("often", "key"))["key"]
    return filed.groupBy("needs", "confidence", "lift").agg(rarest.alias("key")).select(*kind.names)


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct token sets that a rule matches: ``tokens``, ``confidence`` of the best rule."""
    sets = pages.select(tokens(F.col("url")).alias("tokens")).groupBy("tokens").agg(F.lit(1).alias("one"))
    looked = sets.select("tokens", F.explode("tokens").alias("key")).join(rules, "key")
    holds = F.size(F.array_except("needs", "tokens")) == 0
    return looked.where(holds).groupBy("tokens").agg(F.max("confidence").alias("confidence"))


def verdicts(pages: DataFrame, labels: DataFrame, policy=POLICY, **limits) -> DataFrame:
    hits = written(matched(pages, written(mine(pages, labels, **limits), "url-rules")), "url-sets")
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), tokens(F.col("url")).alias("tokens"))
    rule, verdict = policy_rule(F.col("host"), F.col("path"), policy)
    rows = join_on(rows, hits, ["tokens"], "left")
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "confidence")


def op10(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return verdicts(pages, labels)
