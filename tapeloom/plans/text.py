"""Social-text plans: tags, sentiment, lexicon scores and hourly summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.plans.registry import query
from tapeloom.plans.standins import view

#: Weights of crypto terms in the sentiment lexicon.
LEXICON = {
    "hodl": 3.5, "moon": 3.5, "ath": 3.0, "pump": 2.5, "bull": 2.5, "bullish": 2.5, "buy": 2.0, "fud": -3.0, "rekt": -3.5, "dump": -3.0, "bear": -2.5, "bearish": -2.5, "sell": -2.0, "scam": -4.0, "rug": -4.0, "ponzi": -4.0,
    "hack": -4.0, "dip": -1.0, "liquidation": -3.0, "etf": 2.5, "blackrock": 2.0, "whale": 1.5,
}
#: Weights of words of the stand-in's language, so that the lexicon meets its texts.
STAND_IN = {"the": 0.5, "with": 1.0, "idiot": -3.0, "worthless": -2.0, "et": 0.2, "und": 0.3, "de": -0.1}


def lexicon_sentiment(posts: DataFrame, lexicon: dict[str, float], id_col: str = "post_id", text_col: str = "text") -> DataFrame:
    """compound: summed weights s of a post's words as s / sqrt(s^2 + 15), 0 without any; n_hits: words with a weight.

    Words are exploded and joined with the lexicon (a table of fixed size, broadcast), then summed by post.
    """
    table = posts.sparkSession.createDataFrame(list(lexicon.items()), "word string, weight double")
    words = posts.select(id_col, F.explode(F.regexp_extract_all(F.lower(F.coalesce(text_col, F.lit(""))), F.lit("[a-z]+"), F.lit(0))).alias("word"))
    hits = words.join(F.broadcast(table), "word").groupBy(id_col).agg(F.sum("weight").alias("s"), F.count(F.lit(1)).alias("n_hits"))
    out = posts.select(id_col).join(hits, id_col, "left")
    s = C.zero("s")
    return out.select(id_col, (s / F.sqrt(s * s + 15)).alias("compound"), F.coalesce("n_hits", F.lit(0)).alias("n_hits"))


@query(
    "m56_lexicon_sentiment",
    "with l as (select * from (values " + ", ".join(f"('{w}', {x}::double)" for w, x in (LEXICON | STAND_IN).items()) + """) v(word, weight)), w as (select post_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) as word from v_posts),
      h as (select post_id, sum(weight) as s, count(*) as n from w join l using (word) group by 1) select p.post_id, coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) as compound, coalesce(n, 0) as n_hits from v_posts p left join h using (post_id)""",
    "compound",
)
def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexicon_sentiment(view(spark, sf_dir, "v_posts"), LEXICON | STAND_IN)


def first_topic(text: Column, topics: dict[str, str], otherwise: str) -> Column:
    """The first topic whose pattern the text holds (substring semantics)."""
    return C.label_by([(text.rlike(p), t) for t, p in topics.items()], otherwise)


@query(
    "m55_message_enriched",
    r"""select post_id, trim(regexp_replace(regexp_replace(text, 'https?://\S+', '', 'g'), '\s+', ' ', 'g')) = '' as is_blank, case when lower(text) like '%with%' and lower(text) like '%und%' then 'BTC_ETH' when lower(text) like '%with%' then 'BTC' when lower(text) like '%und%' then 'ETH' else 'GENERAL' end as coin_focus,
      case when regexp_matches(lower(text), 'idiot|worthless') then 'SECURITY' when regexp_matches(lower(text), 'license|copyright') then 'REGULATION' else 'GENERAL_NEWS' end as topic,
      len(regexp_extract_all(text, '[0-9]+')) as number_count, len(regexp_extract_all(text, 'https?://\S+')) as url_count, md5(lower(text)) as content_hash,
      case when engagement >= 10000 then 'VIRAL' when engagement >= 3000 then 'HIGH' when engagement >= 1000 then 'MEDIUM' else 'LOW' end as importance, array_to_string(list_filter(['a', 'b', 'c'], lambda t: (t = 'a' and lower(text) like '%the%') or (t = 'b' and lower(text) like '%de%') or (t = 'c' and lower(text) like '%@%')), ',') as tags from v_posts""",
)
def message_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning, focus, first-match topic, counts, content hash, importance, tags."""
    t, low = F.col("text"), F.lower("text")
    url = r"https?://\S+"
    btc, eth = low.contains("with"), low.contains("und")
    tags = F.array(F.when(low.contains("the"), "a"), F.when(low.contains("de"), "b"), F.when(low.contains("@"), "c"))
    return view(spark, sf_dir, "v_posts").select(
        "post_id", (F.trim(F.regexp_replace(F.regexp_replace(t, url, ""), r"\s+", " ")) == "").alias("is_blank"), C.label_by([(btc & eth, "BTC_ETH"), (btc, "BTC"), (eth, "ETH")], "GENERAL").alias("coin_focus"),
        first_topic(low, {"SECURITY": "idiot|worthless", "REGULATION": "license|copyright"}, "GENERAL_NEWS").alias("topic"), F.regexp_count(t, F.lit("[0-9]+")).cast("long").alias("number_count"), F.regexp_count(t, F.lit(url)).cast("long").alias("url_count"),
        F.md5(low).alias("content_hash"), C.label_by([(F.col("engagement") >= 10000, "VIRAL"), (F.col("engagement") >= 3000, "HIGH"), (F.col("engagement") >= 1000, "MEDIUM")], "LOW").alias("importance"), F.array_join(F.array_compact(tags), ",").alias("tags"),
    )


@query(
    "m12_social_summary",
    """select channel, lang, count(*) as posts, count(*) filter (sentiment >= 0.05) as positive, count(*) filter (sentiment <= -0.05) as negative, count(*) filter (sentiment >= 0.05) / count(*) as positive_ratio, sum(sentiment * engagement) / nullif(sum(engagement), 0) as weighted_sentiment,
      count(*) filter (regexp_matches(lower(text), 'idiot|worthless')) as toxic_mentions, arg_max(post_id, (engagement, post_id)) as top_post, count(distinct md5(text)) as distinct_texts from v_posts group by 1, 2""",
    "positive_ratio weighted_sentiment",
)
def social_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20, A21, A29, M12, M13."""
    s = F.col("sentiment")
    return view(spark, sf_dir, "v_posts").groupBy("channel", "lang").agg(
        F.count(F.lit(1)).alias("posts"), F.count_if(s >= 0.05).alias("positive"), F.count_if(s <= -0.05).alias("negative"), (F.count_if(s >= 0.05) / F.count(F.lit(1))).alias("positive_ratio"), C.weighted_avg(s, F.col("engagement")).alias("weighted_sentiment"),
        F.count_if(F.lower("text").rlike("idiot|worthless")).alias("toxic_mentions"), C.arg_first(F.col("post_id"), F.col("engagement"), F.col("post_id")).alias("top_post"), F.count_distinct(F.md5("text")).alias("distinct_texts"),
    )


@query(
    "m14_social_fusion",
    """with a as (select channel, avg(sentiment) as r, count(*) as rn from v_posts where lang in ('en', 'fr') group by 1), b as (select channel, avg(sentiment) as t, count(*) as tn from v_posts where lang in ('de', 'es') and channel <> 'src3' group by 1)
      select coalesce(a.channel, b.channel) as channel, (coalesce(r * rn, 0) + coalesce(t * tn, 0)) / nullif(coalesce(rn, 0) + coalesce(tn, 0), 0) as blended_sentiment, abs(r - t) as sentiment_gap, coalesce(rn, 0) + coalesce(tn, 0) as total_mentions,
        case when r is null or t is null then 'SINGLE_SOURCE' when r > 0 and t > 0 then 'AGREE_BULLISH' when r < 0 and t < 0 then 'AGREE_BEARISH' else 'DIVERGENT' end as agreement_state from a full outer join b on a.channel = b.channel""",
    "blended_sentiment sentiment_gap",
)
def social_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources blended by their mentions, with their agreement."""
    posts = view(spark, sf_dir, "v_posts")
    a = posts.where("lang in ('en', 'fr')").groupBy("channel").agg(F.avg("sentiment").alias("r"), F.count(F.lit(1)).alias("rn"))
    b = posts.where("lang in ('de', 'es') and channel <> 'src3'").groupBy("channel").agg(F.avg("sentiment").alias("t"), F.count(F.lit(1)).alias("tn"))
    j = a.join(b, "channel", "full_outer")
    r, t = F.col("r"), F.col("t")
    n = F.coalesce("rn", F.lit(0)) + F.coalesce("tn", F.lit(0))
    return j.select(
        "channel", C.safe_div(C.zero(r * F.col("rn")) + C.zero(t * F.col("tn")), n).alias("blended_sentiment"), F.abs(r - t).alias("sentiment_gap"), n.alias("total_mentions"),
        C.label_by([(r.isNull() | t.isNull(), "SINGLE_SOURCE"), ((r > 0) & (t > 0), "AGREE_BULLISH"), ((r < 0) & (t < 0), "AGREE_BEARISH")], "DIVERGENT").alias("agreement_state"),
    )
