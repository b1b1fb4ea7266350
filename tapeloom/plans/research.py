"""Text enrichment by rule (M54, M55), audits (M44, Q11), bulk days (M53), and research on the model's features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.mlops import metrics, training
from tapeloom.operators import dedupe, joins, series
from tapeloom.plans import legs, wide
from tapeloom.plans.registry import added, added_sql, doubles_of, grouped, grouped_sql, query
from tapeloom.plans.standins import view

# --- M54, M55 ----------------------------------------------------------------------------------------------------------

#: Words by asset, event, direction and topic, and weights of channels. A word counts wherever the text holds it.
BTC_POST, ETH_POST = ("btc", "bitcoin", "satoshi"), ("eth", "ethereum", "vitalik")
EVENTS = {
    "ETF": ("etf",), "SEC": ("sec", "lawsuit"), "HACK": ("hack", "exploit"), "WHALE": ("whale",), "LIQUIDATION": ("liquidation", "rekt"), "FED": ("fed", "powell", "rate cut"), "BLACKROCK": ("blackrock",), "BULLRUN": ("bullrun", "ath", "new high"), "BEARMARKET": ("bear market", "crash", "dump"),
}
CHANNEL_WEIGHTS = {"src1": 1.5, "src2": 1.5, "src3": 1.2}
BTC_MESSAGE, ETH_MESSAGE = ("btc", "bitcoin", "$btc"), ("eth", "ethereum", "$eth")
BULLISH, BEARISH = ("buy", "bull", "bullish", "breakout", "pump", "moon", "long", "accumulate"), ("sell", "bear", "bearish", "dump", "liquidation", "crash", "panic", "short")
TOPICS = {
    "AIRDROP_PROMO": ("airdrop", "giveaway", "claim", "whitelist", "presale"), "REGULATION": ("sec", "etf", "lawsuit", "court", "banned", "gensler", "regulation", "gov"), "HACK_SCAM": ("hack", "exploit", "stolen", "phishing", "rug", "scam", "compromised"),
    "TECH_ANALYSIS": ("support", "resistance", "rsi", "ma", "fibonacci", "chart", "breakout"), "MACRO_POLITICS": ("ufo", "alien", "war", "debt", "president", "doj", "election", "biden", "trump", "putin", "gdp"),
}
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "))
#: Fixed values; groups are non-capturing and digits are spelled out, as both engines need.
URL, CASHTAG, HASHTAG, MONEY = r"https?://[^\s]+", r"\$[A-Za-z0-9]+", r"#[A-Za-z0-9_]+", r"\$[0-9]+[kKmMbB]?|[0-9]+(?:\.[0-9]+)?%"


def holds(text: Column, words: tuple[str, ...]) -> Column:
    """How many of the words the text holds, each counted once."""
    return sum((text.contains(w).cast("int") for w in words), F.lit(0))


def strip_html(text: Column) -> Column:
    out = F.regexp_replace(text, "<[^>]+>", " ")
    for entity, plain in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def enrich_posts(posts: DataFrame) -> DataFrame:
    """Posts that stay (not removed, 20 characters or more, English, the first of equal texts) with asset, tags and weights.

    Age is an input column, so reruns agree; an age below an hour counts as one.
    """
    full = F.trim(F.concat_ws(". ", "title", "body"))
    kept = posts.withColumn("full_text", full).where("body not in ('[removed]', '[deleted]') and length(full_text) >= 20 and lang = 'en'")
    kept = dedupe.keep_latest(kept.withColumn("content_hash", F.md5("full_text")), ["content_hash"], [-F.col("post_id")])
    low = F.lower("full_text")
    btc, eth = holds(low, BTC_POST), holds(low, ETH_POST)
    tags = F.array_compact(F.array(*[F.when(holds(low, words) > 0, tag) for tag, words in EVENTS.items()]))
    hours = F.greatest(F.col("hours_old"), F.lit(1))
    weight = F.lit(1.0)
    for channel, w in CHANNEL_WEIGHTS.items():
        weight = F.when(F.col("channel") == channel, w).otherwise(weight)
    inter = F.col("score") * 1.0 + F.col("comments") * 3.0
    velocity = (F.col("score") + F.col("comments")) / hours
    final = inter / F.pow(hours.cast("double"), F.lit(0.3)) * weight
    return kept.select(
        "post_id", "channel", "content_hash", C.label_by([((btc > eth) & (btc > 0), "BTC"), ((eth > btc) & (eth > 0), "ETH")], "GENERAL").alias("asset"), F.array_join(tags, ",").alias("event_tags"), velocity.alias("engagement_velocity"),
        inter.alias("interaction_weight"), final.alias("final_weight"), (F.col("compound") * final).alias("weighted_sentiment"), (velocity > 100).alias("is_viral"), F.md5(strip_html(F.col("full_text"))).alias("stripped_hash"),
    )


_COUNT = lambda x, words: " + ".join(f"contains({x}, '{w}')::int" for w in words)
_ANY = lambda x, words: " or ".join(f"contains({x}, '{w}')" for w in words)
_STRIP = "regexp_replace(full_text, '<[^>]+>', ' ', 'g')"
for _a, _b in ENTITIES:
    _STRIP = f"replace({_STRIP}, '{_a.replace(chr(39), chr(39) * 2)}', '{_b.replace(chr(39), chr(39) * 2)}')"
query(
    "m54_posts_enriched",
    rf"""with p as (select *, trim(title || '. ' || body) as full_text from v_messages where body not in ('[removed]', '[deleted]') and lang = 'en'), d as (select *, md5(full_text) as content_hash, lower(full_text) as low, row_number() over (partition by md5(full_text) order by post_id) as rn from p where length(full_text) >= 20),
      k as (select *, {_COUNT('low', BTC_POST)} as b, {_COUNT('low', ETH_POST)} as e, greatest(hours_old, 1) as h, score * 1.0e0 + comments * 3.0e0 as inter, case channel {' '.join(f"when '{c}' then {w}e0" for c, w in CHANNEL_WEIGHTS.items())} else 1e0 end as w from d where rn = 1)
      select post_id, channel, content_hash, case when b > e and b > 0 then 'BTC' when e > b and e > 0 then 'ETH' else 'GENERAL' end as asset, concat_ws(',', {', '.join(f"case when {_ANY('low', x)} then '{t}' end" for t, x in EVENTS.items())}) as event_tags, (score + comments) / h::double as engagement_velocity,
        inter as interaction_weight, inter / power(h::double, 0.3) * w as final_weight, compound * inter / power(h::double, 0.3) * w as weighted_sentiment, (score + comments) / h::double > 100 as is_viral, md5(trim(regexp_replace({_STRIP}, '\s+', ' ', 'g'))) as stripped_hash from k""",
    "engagement_velocity interaction_weight final_weight weighted_sentiment",
)(lambda spark, sf_dir: enrich_posts(view(spark, sf_dir, "v_messages")))


def enrich_messages(messages: DataFrame) -> DataFrame:
    """Cleaned text, focus, signal, first topic, engagement, importance, tags and counts."""
    raw = F.concat_ws(" ", "title", "body")
    clean = F.trim(F.regexp_replace(F.regexp_replace(raw, URL, ""), r"\s+", " "))
    m = messages.withColumns({"raw_text": raw, "clean_text": clean})
    low = F.lower("clean_text")
    btc, eth = holds(low, BTC_MESSAGE) > 0, holds(low, ETH_MESSAGE) > 0
    score = F.greatest(F.col("views") * 0.01 + F.col("forwards") * 5.0 + F.col("replies") * 10.0 + F.col("reactions") * 2.0, F.lit(1.0))
    m = m.withColumn("engagement_score", score)
    found = lambda text, pattern: F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))), ",")
    e = F.col("engagement_score")
    return m.select(
        "post_id", "channel", F.md5("clean_text").alias("clean_hash"), C.label_by([(btc & eth, "BTC_ETH"), (btc, "BTC"), (eth, "ETH")], "GENERAL").alias("coin_focus"), C.label_by([(holds(low, BULLISH) > 0, "BULLISH"), (holds(low, BEARISH) > 0, "BEARISH")], "NEUTRAL").alias("signal_type"),
        C.label_by([(holds(low, words) > 0, t) for t, words in TOPICS.items()], "GENERAL_NEWS").alias("topic"), "engagement_score", (F.col("compound") * e).alias("weighted_sentiment"), C.label_by([(e >= 10000, "VIRAL"), (e >= 3000, "HIGH"), (e >= 1000, "MEDIUM")], "LOW").alias("importance"),
        F.when(F.col("clean_text") == "", 0).otherwise(F.size(F.split("clean_text", " "))).cast("long").alias("word_count"), F.regexp_count("raw_text", F.lit(MONEY)).cast("long").alias("financial_mentions_count"), found(F.col("clean_text"), CASHTAG).alias("cashtags"), found(F.col("clean_text"), HASHTAG).alias("hashtags"), found(F.col("raw_text"), URL).alias("urls"),
    )


_FOUND = lambda x, p: f"array_to_string(list_sort(list_distinct(regexp_extract_all({x}, '{p}'))), ',')"
query(
    "m55_messages_enriched",
    rf"""with r as (select *, title || ' ' || body as raw_text from v_messages), c as (select *, trim(regexp_replace(regexp_replace(raw_text, '{URL}', '', 'g'), '\s+', ' ', 'g')) as clean_text, greatest(views * 0.01e0 + forwards * 5e0 + replies * 10e0 + reactions * 2e0, 1e0) as engagement_score from r), k as (select *, lower(clean_text) as low from c)
      select post_id, channel, md5(clean_text) as clean_hash, case when ({_ANY('low', BTC_MESSAGE)}) and ({_ANY('low', ETH_MESSAGE)}) then 'BTC_ETH' when {_ANY('low', BTC_MESSAGE)} then 'BTC' when {_ANY('low', ETH_MESSAGE)} then 'ETH' else 'GENERAL' end as coin_focus,
        case when {_ANY('low', BULLISH)} then 'BULLISH' when {_ANY('low', BEARISH)} then 'BEARISH' else 'NEUTRAL' end as signal_type, case {' '.join(f"when {_ANY('low', w)} then '{t}'" for t, w in TOPICS.items())} else 'GENERAL_NEWS' end as topic, engagement_score, compound * engagement_score as weighted_sentiment,
        case when engagement_score >= 10000 then 'VIRAL' when engagement_score >= 3000 then 'HIGH' when engagement_score >= 1000 then 'MEDIUM' else 'LOW' end as importance, case when clean_text = '' then 0 else len(string_split(clean_text, ' ')) end as word_count, len(regexp_extract_all(raw_text, '{MONEY}')) as financial_mentions_count,
        {_FOUND('clean_text', CASHTAG)} as cashtags, {_FOUND('clean_text', HASHTAG)} as hashtags, {_FOUND('raw_text', URL)} as urls from k""",
    "engagement_score weighted_sentiment",
)(lambda spark, sf_dir: enrich_messages(view(spark, sf_dir, "v_messages")))

# --- M44, Q11, M53, J11 -----------------------------------------------------------------------------------------------

AUDIT = {
    "total_check_count": "count(*)", "passed_check_count": "count(*) filter (where success)", "failed_check_count": "count(*) filter (where not success)", "failed_critical_count": "count(*) filter (where not success and severity = 'critical')", "failed_warning_count": "count(*) filter (where not success and severity = 'warning')", "latest_audit_at": "max(audit_ts)",
}
AUDIT_STATUS = {"audit_status": "case when failed_critical_count > 0 then 'FAILED' when failed_warning_count > 0 then 'WARNING' when total_check_count = 0 then 'MISSING' else 'PASSED' end"}
_RECENT = "audit_ts >= timestamp{ntz} '2024-01-30 00:00:00' - interval '48' hour"
query("q11_audit_failures", f"select * from ({added_sql(f'({grouped_sql(f"(select * from v_audit where {_RECENT.format(ntz='')}) a", ["table_name"], AUDIT)}) g', AUDIT_STATUS)}) q")(
    lambda spark, sf_dir: added(grouped(view(spark, sf_dir, "v_audit").where(_RECENT.format(ntz="_ntz")), ["table_name"], AUDIT), AUDIT_STATUS)
)
query("m44_failed_checks", f"select audit_id, audit_ts, table_name, expectation_type, severity from v_audit where not success and {_RECENT.format(ntz='')}")(
    lambda spark, sf_dir: view(spark, sf_dir, "v_audit").where(f"not success and {_RECENT.format(ntz='_ntz')}").select("audit_id", "audit_ts", "table_name", "expectation_type", "severity")
)


@query("m44_audit_latest", f"select * from ({added_sql(f'({grouped_sql("(select * from (select *, rank() over (partition by table_name order by date_trunc('hour', audit_ts) desc) as nth from v_audit) x where nth = 1) a", ["table_name"], AUDIT)}) g', AUDIT_STATUS)}) q")
def audit_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hour's audit of each table."""
    a = view(spark, sf_dir, "v_audit").withColumn("at_hour", F.date_trunc("hour", "audit_ts"))
    last = a.groupBy("table_name").agg(F.max("at_hour").alias("at_hour"))  # a row a table
    return added(grouped(a.join(last, ["table_name", "at_hour"]), ["table_name"], AUDIT), AUDIT_STATUS)


_BULK = ["price_date", *legs.MACRO_WIDE, *legs.MACRO, *(c for c in (*legs.ETF_WIDE, *legs.ETF))]
query("m53_bulk_daily", f"select {', '.join(_BULK)} from ({legs.MACRO_SQL}) m full join ({legs.ETF_SQL}) e using (price_date)", doubles_of(legs.MACRO_WIDE, legs.MACRO, legs.ETF_WIDE, legs.ETF), 7)(
    lambda spark, sf_dir: legs.macro_features(spark, sf_dir).join(legs.etf_features(spark, sf_dir), "price_date", "full_outer").select(*_BULK)
)


@query(
    "j11_reserve_with_fallback",
    """with a as (select exchange, avg(actual_reserve_usd) as reserve, max(exchange_tier) as tier from v_exch_obs where obs_id % 3 = 0 and exchange <> 'ex2' group by 1), b as (select exchange, avg(actual_reserve_usd) as reserve, max(bank_run_risk) as tier from v_exch_obs where obs_id % 3 = 1 and exchange <> 'ex4' group by 1)
      select obs_id, f.exchange, coalesce(a.reserve, b.reserve) as reserve, coalesce(a.tier, b.tier) as tier from v_funding f left join a using (exchange) left join b using (exchange)""",
    "reserve",
)
def reserve_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of a dimension, from a second source where the first has none."""
    obs = view(spark, sf_dir, "v_exch_obs")
    one = lambda rest, gone, tier: obs.where((F.col("obs_id") % 3 == rest) & (F.col("exchange") != gone)).groupBy("exchange").agg(F.avg("actual_reserve_usd").alias("reserve"), F.max(tier).alias("tier"))
    return joins.join_with_fallback(view(spark, sf_dir, "v_funding").select("obs_id", "exchange"), one(0, "ex2", "exchange_tier"), one(1, "ex4", "bank_run_risk"), ["exchange"])


# --- L13, L14, L18, L19, L23 --------------------------------------------------------------------------------------------

_W = "partition by symbol order by hour_ts"
_PAST = lambda n: f"({_W} rows between {n} preceding and 1 preceding)"
_R1 = {"_r": f"(close_price - lag(close_price) over ({_W})) / nullif(lag(close_price) over ({_W}), 0)"}
RESEARCH = {
    **{f"return_1h_lag_{n}h": f"lag(_r, {n}) over ({_W})" for n in (1, 4, 8, 12)}, **{f"return_1h_rolling_{f}_{n}h": f"case when count(_r) over {_PAST(n)} >= {max(2, n // 2)} then {a}(_r) over {_PAST(n)} end" for n in (4, 12, 24) for f, a in (("mean", "avg"), ("std", "stddev_samp"))},
    "_v": f"case when count(_r) over {_PAST(24)} >= 12 then stddev_samp(_r) over {_PAST(24)} end", "volume_zscore_past": f"(quote_volume - avg(quote_volume) over {_PAST(24)}) / nullif(stddev_samp(quote_volume) over {_PAST(24)}, 0)",
}
RESEARCH2 = {
    "high_volatility_flag": f"case when _v > avg(_v) over {_PAST(168)} then 1e0 else 0e0 end", "high_liquidity_flag": "case when volume_zscore_past >= 1 then 1e0 else 0e0 end", "up_trend_flag": "case when return_1h_rolling_mean_12h > 0 then 1e0 else 0e0 end",
    "click_x_return_1h_lag_1h": "case when symbol = 'click' then return_1h_lag_1h else 0e0 end", "click_x_volume_zscore": "case when symbol = 'click' then volume_zscore_past else 0e0 end",
}
_L14 = ["hour_ts", "symbol", *(c for c in RESEARCH if c[0] != "_"), *RESEARCH2]
query("l14_research_feature_set", f"select {', '.join(_L14)} from ({added_sql(f'({added_sql(f"({added_sql('v_hourly', _R1)}) a", RESEARCH)}) b', RESEARCH2)}) c", " ".join(_L14[2:]), 7)(
    lambda spark, sf_dir: added(added(added(view(spark, sf_dir, "v_hourly"), _R1), RESEARCH), RESEARCH2).select(*_L14)
)

_NAIVE = {"_up": f"case when lead(close_price, 4) over ({_W}) is null then null when lead(close_price, 4) over ({_W}) > close_price then 1 else 0 end", "_guess": f"case when close_price < avg(close_price) over {_PAST(24)} then 1 else 0 end"}


@query(
    "l13_walk_forward_hours",
    rf"""with p as (select hour_ts, _up as actual, _guess as predicted from ({added_sql('v_hourly', _NAIVE)}) x where _up is not null), t as (select hour_ts, row_number() over (order by hour_ts) - 1 as n, count(*) over () as total from (select distinct hour_ts from p) d), b as (select unnest(range(0, 4)) as fold, (select max(total) from t) as total),
      s as (select fold, total, cast(floor(total * 0.5) as bigint) as s from b), c as (select fold, s + cast(floor((total - s) / 4.0 * fold) as bigint) as a, case when fold = 3 then total else s + cast(floor((total - s) / 4.0 * (fold + 1)) as bigint) end as z from s),
      x as (select fold, case when n < a then 'train' else 'test' end as role, avg((actual = predicted)::int) as acc from p join t using (hour_ts) join c on n < z group by 1, 2), y as (select fold, max(acc) filter (role = 'train') as train_accuracy, max(acc) filter (role = 'test') as test_accuracy from x group by 1)
      select fold, train_accuracy, test_accuracy, stddev_samp(test_accuracy) over () as fold_spread, train_accuracy - test_accuracy > 0.08 or stddev_samp(test_accuracy) over () > 0.06 as is_overfit from y""",
    "train_accuracy test_accuracy fold_spread",
)
def walk_forward_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds over hours, of which there are few beside rows; overfit by the gap or by the spread of the folds."""
    p = added(view(spark, sf_dir, "v_hourly"), _NAIVE).where("_up is not null").select("hour_ts", F.col("_up").alias("actual"), F.col("_guess").alias("predicted"))
    m = metrics.classification(series.walk_forward(p, "hour_ts", 4), ["fold", "role"], [0, 1])
    g = m.groupBy(F.col("fold").cast("long").alias("fold")).agg(F.max(F.when(F.col("role") == "train", F.col("accuracy"))).alias("train_accuracy"), F.max(F.when(F.col("role") == "test", F.col("accuracy"))).alias("test_accuracy"))
    spread = g.agg(F.stddev_samp("test_accuracy").alias("fold_spread"))  # one row
    return g.crossJoin(F.broadcast(spread)).withColumn("is_overfit", (F.col("train_accuracy") - F.col("test_accuracy") > 0.08) | (F.col("fold_spread") > 0.06))


_SHARE = f"({' + '.join(f'case when {c} is not null then 1 else 0 end' for c in wide.CONTRACT)}) / {len(wide.CONTRACT)}e0"


@query("l18_completeness_by_split", f"select dataset_split_name, count(*) as row_count, avg(c) as mean_completeness, quantile_cont(c, 0.1) as p10_completeness, min(c) as min_completeness from (select dataset_split_name, {_SHARE} as c from {wide._SET_SQL}) x group by 1", "mean_completeness p10_completeness min_completeness")
def completeness_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L18 over all features of the contract."""
    c = wide.training_dataset(spark, sf_dir).select("dataset_split_name", F.expr(_SHARE).alias("c"))
    return c.groupBy("dataset_split_name").agg(F.count(F.lit(1)).alias("row_count"), F.avg("c").alias("mean_completeness"), F.percentile("c", 0.1).alias("p10_completeness"), F.min("c").alias("min_completeness"))


#: Family of a feature by parts of its name, in order.
GROUPS = (
    (("etf", "ibit", "gbtc"), "etf"), (("stablecoin", "usdc", "usdt_supply"), "stablecoin"), (("funding", "basis", "leverage", "arbitrage"), "funding_derivatives"), (("sentiment", "social"), "sentiment"), (("sp500", "nasdaq", "gold", "vix", "oil", "macro", "safe_haven"), "macro"),
    (("volume", "liquidity", "taker_buy"), "volume_liquidity"), (("return", "volatility", "momentum", "price"), "market_price"), (("risk", "stress"), "risk_scores"),
)


def feature_group(name: Column) -> Column:
    return C.label_by([(F.greatest(*[name.contains(t) for t in tokens], F.lit(False)), g) for tokens, g in GROUPS], "other")


@query(
    "l19_contract_groups",
    f"with s as (select * from {wide._SET_SQL}), f as (" + " union all ".join(f"select '{c}' as feature, corr({c}, future_return_4h) as r, avg(({c} is null)::int) as m from s" for c in wide.CONTRACT) + ") select case " + " ".join("when " + " or ".join(f"contains(feature, '{t}')" for t in tokens) + f" then '{g}'" for tokens, g in GROUPS)
    + " else 'other' end as feature_group, count(*) as feature_count, max(abs(case when isnan(r) then null else r end)) as best_correlation, avg(m) as mean_missing_rate from f group by 1",
    "best_correlation mean_missing_rate",
)
def contract_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families of all contract features with their best correlation to the label, in one aggregate pass."""
    r = metrics.target_correlation(wide.training_dataset(spark, sf_dir), "future_return_4h", wide.CONTRACT)
    best = F.max(F.abs(F.when(~F.isnan("correlation"), F.col("correlation"))))
    return r.groupBy(feature_group(F.col("feature")).alias("feature_group")).agg(F.count(F.lit(1)).alias("feature_count"), best.alias("best_correlation"), F.avg("missing_rate").alias("mean_missing_rate"))


#: Families of engineered features by parts of their names.
FAMILIES = {"original_only": (), "lag_rolling_returns": ("return_1h_lag", "return_1h_rolling"), "regime_features": ("_flag",), "symbol_aware_features": ("click_x",), "microstructure_liquidity": ("volume_zscore",)}
_BASE = ["close_price", "quote_volume", "taker_buy_ratio"]


@query("l23_feature_ablation")
def feature_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base features with each family in turn, fitted on train and scored on validation. Fitting is iterative, so there is no SQL for it."""
    df = added(added(added(view(spark, sf_dir, "v_hourly"), _R1), RESEARCH), RESEARCH2)
    df = series.time_split(series.forward_labels(df, "close_price", series.by(["symbol"], ["hour_ts"]), {4: 0.003}), ["symbol"], "hour_ts", [(0.7, "train"), (0.85, "validation"), (1.1, "test")]).where("future_direction_4 is not null").persist()  # each fit scans it several times
    out = None
    for family, tokens in FAMILIES.items():
        names = [*_BASE, *(c for c in (*RESEARCH, *RESEARCH2) if c[0] != "_" and any(t in c for t in tokens))]
        frame = training.training_frame(df, names, ["symbol"], "future_direction_4", ["UP", "DOWN", "FLAT"], ["split_name"])
        train = training.balanced_weights(frame.where("split_name = 'train'"))
        labels = [r[0] for r in train.select("label_text").distinct().orderBy("label_text").collect()]  # the classes
        scored = training.score(training.pipeline(names, ["symbol"], "logistic").fit(train), frame.where("split_name = 'validation'"), labels)
        one = scored.agg(F.lit(family).alias("family"), F.lit(len(names)).alias("feature_count"), F.avg((F.col("predicted") == F.col("label_text")).cast("int")).alias("validation_accuracy"))
        out = one if out is None else out.unionByName(one)
    return out
