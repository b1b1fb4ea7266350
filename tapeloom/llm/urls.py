"""URL filters: longest-prefix lists first, association rules mined by FP-growth for the rest."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.shared import cut

#: Fixed values: (host, path, verdict). A rule fits its host and all subdomains where the path starts with the rule's.
LISTED = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: The item that marks a bad URL in a transaction; no URL token has this form.
BAD = "label=bad"


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; A-Z in lower case. Empty where there is none."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2**31 - 1))
    name = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def path(url: Column) -> Column:
    """After the host up to ?, # or the end. Empty where there is no ://."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.lit(2**31 - 1))
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def listed(host_: Column, path_: Column, rules: tuple[tuple[str, str, str], ...] = LISTED) -> Column:
    """Struct of rule and verdict of the longest rule (host and path together) that fits, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # later ones win
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path_.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(host_: Column, path_: Column, url: Column) -> Column:
    """Distinct tokens of a URL: the domain and its labels, words of the path, keys and values of the query."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    labels = F.transform(F.split(host_, r"\."), lambda x: F.concat(F.lit("h:"), x))
    domain = F.array(F.concat(F.lit("d:"), F.regexp_extract(host_, r"([^.]+\.[^.]+\.[^.]+)$", 1)))
    words = F.transform(F.split(path_, r"[/._-]+"), lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, r"[0-9]+", "0")))
    pairs = F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("q:"), x))
    parts = F.flatten(F.array(labels, domain, words, pairs))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) > 2))


def mine(labelled: DataFrame, min_rows: int = 5, min_confidence: float = 0.6, max_length: int = 3) -> DataFrame:
    """Association rules from URL tokens to the bad label.

    labelled: page_id, tokens, bad. Spark's FP-growth finds the frequent token sets that hold the label; a rule
    stays if its support, its confidence and its length pass and no shorter rule inside it is as sure.
    Returns antecedent (array), confidence, support and lift. Support is a number of URLs, min_rows, whatever else
    there is: unrelated URLs change no rule's support. Longer sets are mined and then left out, so the work grows with
    the subsets of those tokens of a URL that min_rows URLs share. None for no rows.
    """
    n = labelled.count()
    schema = "antecedent array<string>, confidence double, support double, lift double"
    if not n:
        return labelled.sparkSession.createDataFrame([], schema)
    baskets = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_rows / n, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules.where(F.array_contains("consequent", BAD) & (F.size("antecedent") <= max_length))
        .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support", "lift")
        .where("lift > 1")
    )
    rules = cut(rules)
    shorter = rules.select(F.col("antecedent").alias("inner"), F.col("confidence").alias("c"), F.explode("antecedent").alias("t"))
    longer = rules.select("antecedent", "confidence", F.explode("antecedent").alias("t"))
    beaten = (
        longer.join(shorter, "t")
        .where((F.size("inner") < F.size("antecedent")) & (F.col("c") >= F.col("confidence")) & (F.size(F.array_except("inner", "antecedent")) == 0))
        .select("antecedent")
        .distinct()
    )
    return rules.join(beaten, "antecedent", "left_anti")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The surest rule that fits each URL, by an inverted index.

    urls: page_id, tokens. A rule is indexed under the one of its tokens that the fewest rules share, URLs under
    all their tokens; where they meet, the whole rule is checked. Returns page_id, mined_rule, confidence for
    the URLs that a rule fits; ties go to the rule that sorts first.
    """
    listed_ = rules.select("antecedent", "confidence", F.explode("antecedent").alias("token"))
    common = listed_.groupBy("token").count()
    index = (
        listed_.join(common, "token")
        .groupBy("antecedent", "confidence")
        .agg(F.min(F.struct("count", "token"))["token"].alias("token"))
    )
    posted = urls.select("page_id", "tokens", F.explode("tokens").alias("token"))
    best = F.min(F.struct((-F.col("confidence")).alias("by"), F.array_join("antecedent", "&").alias("rule"), F.col("confidence").alias("confidence")))
    hits = posted.join(index, "token").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    return hits.groupBy("page_id").agg(best.alias("b")).select("page_id", F.col("b.rule").alias("mined_rule"), F.col("b.confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id", **limits) -> DataFrame:
    """A verdict on every URL: the longest listed rule's, else block where a mined rule fits, else allow.

    labels: ``label_id``, quality, toxic; a URL is bad where quality is 0 or toxic is 1. Rules are mined from all
    labelled URLs. Returns page_id, host, path, rule (null unless listed), verdict, mined_rule and confidence
    (null unless a mined rule fits). A null URL or one without :// has empty host and path and is judged all the
    same. Repeated rows stay; null ids are judged too. Without labels nothing is mined. Other columns are ignored.
    """
    h, p = host(F.col("url")), path(F.col("url"))
    split = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url")).withColumn("host", h).withColumn("path", p)
    every = split.withColumn("tokens", tokens(F.col("host"), F.col("path"), F.col("url"))).drop("url")
    bad = labels.select(F.col(label_id).alias("page_id"), ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad"))
    bad = bad.groupBy("page_id").agg(F.max("bad").alias("bad"))
    rules = cut(mine(every.join(bad, "page_id").select("page_id", "tokens", "bad"), **limits))
    # rows with the same tokens share one answer
    distinct = every.where(F.size("tokens") > 0).select("tokens").distinct().select(F.col("tokens").alias("page_id"), "tokens")
    found = match(distinct, rules).withColumnRenamed("page_id", "_t")
    judged = every.join(found, F.col("tokens") == F.col("_t"), "left").withColumn("l", listed(F.col("host"), F.col("path")))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("l.rule").alias("rule"),
        F.coalesce(F.col("l.verdict"), F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        "mined_rule",
        "confidence",
    )
