"""Merkle-tree fingerprints over sections, paragraphs and passages; column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import shuffle_partitions

#: A passage: up to 48 characters, ending early after full stops, so that an edit moves no later sentence's cuts.
PASSAGE = r"[^.]{1,48}[.]*|[.]+"


def tree(text: Column) -> Column:
    """Passage digests: an array of sections (split at blank lines) of paragraphs (lines) of passages."""
    return F.transform(
        F.split(text, "\n\n"),
        lambda s: F.transform(F.split(s, "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PASSAGE), F.lit(0)), lambda x: F.md5(x))),
    )


def root(tree_: Column) -> Column:
    """Digest of the whole: passages make paragraphs, paragraphs sections, sections the root."""
    sections = F.transform(tree_, lambda s: F.md5(F.concat_ws("", F.transform(s, lambda p: F.md5(F.concat_ws("", p))))))
    return F.sha2(F.concat_ws("", sections), 256)


def as_string(root_: Column, tree_: Column) -> Column:
    """``root:`` and the tree: ``/`` between sections, ``;`` between paragraphs, ``,`` between passages (12 hex digits)."""
    paragraphs = lambda s: F.concat_ws(";", F.transform(s, lambda p: F.concat_ws(",", F.transform(p, lambda x: F.substring(x, 1, 12)))))
    return F.concat(root_, F.lit(":"), F.concat_ws("/", F.transform(tree_, paragraphs)))


def likeness(tree_a: Column, root_a: Column, tree_b: Column, root_b: Column) -> Column:
    """1 for equal roots, else the share of distinct passages that both trees hold (Jaccard)."""
    a, b = F.flatten(F.flatten(tree_a)), F.flatten(F.flatten(tree_b))
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_union(a, b))
    return F.when(root_a == root_b, F.lit(1.0)).when(either == 0, F.lit(0.0)).otherwise(both / either)


def differing(tree_a: Column, tree_b: Column) -> Column:
    """Where two trees differ: an array of (section, paragraph), from 0, by place; a branch that only one has differs."""
    n = F.greatest(F.size(tree_a), F.size(tree_b))

    def of_section(i: Column) -> Column:
        a, b = F.get(tree_a, i), F.get(tree_b, i)
        m = F.greatest(F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0)), F.lit(1))
        places = F.transform(F.sequence(F.lit(0), m - 1), lambda j: F.struct(i.alias("section"), j.alias("paragraph"), F.get(a, j).eqNullSafe(F.get(b, j)).alias("same")))
        return F.transform(F.filter(places, lambda x: ~x["same"]), lambda x: F.struct(x["section"].alias("section"), x["paragraph"].alias("paragraph")))

    return F.flatten(F.transform(F.sequence(F.lit(0), n - 1), of_section))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds ``tree``, ``root`` and ``fingerprint`` to id and text. Null text counts as empty."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return base.withColumn("tree", tree(F.col("text"))).withColumn("root", root(F.col("tree"))).withColumn("fingerprint", as_string(F.col("root"), F.col("tree")))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document with the text of the next by descending id; after the last comes the first.

    Ids are cut into ranges at approximate quantiles; texts move once, to their range, with the first
    document of the range that follows added as a guest so that the last one finds its next there.
    Equal ids are ordered by a hash of the text; one id's rows stay in one range. Null ids come last. Ids must be whole
    numbers, as ranges are cut between them; others are an error.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise ValueError(f"{id_col} must be of a whole number type")
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    n = shuffle_partitions(docs.sparkSession)
    cuts = base.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("c")).first()["c"] if n > 1 else []
    cuts = sorted(set(cuts or []))  # one number for each partition
    # range 0 holds the largest ids; null ids are a range of their own
    where = F.size(F.filter(F.lit(cuts) if cuts else F.array().cast("array<bigint>"), lambda c: c >= F.col("doc_id")))
    ranged = base.withColumn("_range", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(where))
    firsts = [r for r in ranged.groupBy("_range").agg(F.max(F.struct("doc_id", "_h")).alias("f")).orderBy("_range").collect()]  # a row for each range
    guests = docs.sparkSession.createDataFrame(
        [(firsts[i]["f"]["doc_id"], firsts[i]["f"]["_h"], firsts[i - 1]["_range"]) for i in range(len(firsts))], "g_id long, g_h long, g_range int"
    )
    invited = (
        base.join(F.broadcast(guests), base["doc_id"].eqNullSafe(F.col("g_id")) & (F.col("_h") == F.col("g_h")))
        .select("doc_id", "text", "_h", F.col("g_range").alias("_range"), F.lit(1).alias("_guest"))
        .dropDuplicates(["_range"])
    )
    every = ranged.select("doc_id", "text", "_h", "_range", F.lit(0).alias("_guest")).unionByName(invited)
    # ranges are numbered, so each is a partition of its own
    every = every.repartitionById(len(cuts) + 2, F.col("_range").cast("int"))
    order = Window.partitionBy(F.col("_range").cast("int")).orderBy(F.col("_guest"), F.col("doc_id").desc_nulls_last(), F.col("_h").desc())
    return every.withColumn("next_text", F.lead("text").over(order)).where(F.col("_guest") == 0).select("doc_id", "text", "next_text")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint each text and its edited text (second half replaced by the start of the next document).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null text is
    empty text: its fingerprint is that of no passage, and equal texts, empty ones too, have likeness 1. Repeated
    rows stay. A single document is its own next. An empty table gives an empty result.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    df = with_next(docs, id_col, text_col).withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    for c, name in (("text", "a"), ("edited", "b"), ("next_text", "c")):
        df = df.withColumn(f"t{name}", tree(F.col(c)))
    for name in "abc":
        df = df.withColumn(f"r{name}", root(F.col(f"t{name}")))
    return df.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        as_string(F.col("ra"), F.col("ta")).alias("fingerprint"),
        as_string(F.col("rb"), F.col("tb")).alias("edited_fingerprint"),
        likeness(F.col("ta"), F.col("ra"), F.col("tb"), F.col("rb")).alias("near_edited"),
        likeness(F.col("ta"), F.col("ra"), F.col("tc"), F.col("rc")).alias("near_next"),
    )
