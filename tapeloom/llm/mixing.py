"""Mixing sources to target weights by a min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.shared import WORD, cut, own_name, prefix_sums

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A document is taken so often at most.
MAX_REPEATS = 3
#: Up to so many membership patterns, the plan is broadcast; with more it is joined by a shuffle.
BROADCAST_PATTERNS = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(sizes: list[int], weights: list[float], repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight, none above ``repeats`` times its size; what is cut off is shared anew by weight."""
    total, out, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        by = sum(weights[i] for i in open_)
        share = {i: left * weights[i] / by for i in open_}
        full = [i for i in open_ if share[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = share[i]
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
            open_.discard(i)
    return out


def _components(members: list[list[int]], sources: int) -> list[list[int]]:
    """Patterns in groups that share no source with one another."""
    head = list(range(sources))

    def root(s: int) -> int:
        while head[s] != s:
            head[s] = head[head[s]]
            s = head[s]
        return s

    for m in members:
        for s in m[1:]:
            head[root(s)] = root(m[0])
    groups: dict[int, list[int]] = {}
    for p, m in enumerate(members):
        groups.setdefault(root(m[0]) if m else -1, []).append(p)
    return list(groups.values())


def route(capacity: list[int], members: list[list[int]], quota: list[int], repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Words that each pattern gives to each source. A flow never leaves a component, so each is solved by itself."""
    flow: list[dict[int, int]] = [{} for _ in members]
    for own in _components(members, len(quota)):
        sources = sorted({s for p in own for s in members[p]})
        at = {s: i for i, s in enumerate(sources)}
        for p, f in zip(own, _route([capacity[p] for p in own], [[at[s] for s in members[p]] for p in own], [quota[s] for s in sources], repeats), strict=True):
            flow[p] = {sources[i]: words for i, words in f.items()}
    return flow


def _route(capacity: list[int], members: list[list[int]], quota: list[int], repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Words that each pattern gives to each source: a min-cost flow.

    The k-th repetition of a pattern costs k - 1 a word, so costs are convex. All other arcs are free, so the
    cheapest augmenting paths are those from patterns at their lowest repetition: the flow is filled one
    repetition at a time, each to a maximum flow that may re-route what was placed before.
    """
    n, used, flow, filled = len(capacity), [0] * len(capacity), [dict.fromkeys(m, 0) for m in members], [0] * len(quota)
    givers: list[list[int]] = [[] for _ in quota]
    for p, m in enumerate(members):
        for s in m:
            givers[s].append(p)
    for level in range(1, repeats + 1):
        # what fits at once; the paths below re-route it where that makes room
        for p, m in enumerate(members):
            for s in m:
                room = min(level * capacity[p] - used[p], quota[s] - filled[s])
                if room > 0:
                    flow[p][s] += room
                    used[p] += room
                    filled[s] += room
        while True:
            came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None for p in range(n) if used[p] < level * capacity[p]}
            queue, end = deque(came), None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    for s in members[x]:
                        if ("s", s) not in came:
                            came["s", s] = (kind, x)
                            if filled[s] < quota[s]:
                                end = ("s", s)
                                break
                            queue.append(("s", s))
                else:
                    for p in givers[x]:
                        if flow[p][x] > 0 and ("p", p) not in came:
                            came["p", p] = (kind, x)
                            queue.append(("p", p))
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            first = path[0][1]
            room = min(level * capacity[first] - used[first], quota[end[1]] - filled[end[1]])
            for (ka, a), (_, b) in zip(path, path[1:], strict=False):
                if ka == "s":  # takes back from pattern b
                    room = min(room, flow[b][a])
            for (ka, a), (_, b) in zip(path, path[1:], strict=False):
                if ka == "p":
                    flow[a][b] += room
                else:
                    flow[b][a] -= room
            used[first] += room
            filled[end[1]] += room
    return flow


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    members_col: str | None = None,
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    repeats: int = MAX_REPEATS,
    seed: int = 42,
    keep: list[str] | None = None,
) -> DataFrame:
    """Take documents so that each source's words come near its target, with as few repetitions as possible.

    ``members_col`` is an array of the sources that hold a document (overlapping sources); by default each
    document belongs to ``source_col`` alone, null being a source of its own that sorts last. Documents are
    aggregated by membership pattern; only these totals (a row for each pattern) reach the driver, where the
    flow routes words to sources. A pattern that gives q whole repetitions and a rest takes all its documents
    q times and, for the rest, documents in the order of a seeded hash, each while its middle is within the rest.

    Returns doc_id, the ``keep`` columns, size (words), source_size (words of its source, of all its sources
    where it has several), target (likewise), copies and taken (words, repeats counted). Null text has 0 words.
    Repeated rows are separate documents; rows equal in id and size are interchangeable. An empty table gives an
    empty result. The same input and seed give the same rows. Any number of patterns is solved; the driver holds
    a row of each (some 200 bytes), however many documents share it.
    """
    members = F.col(members_col) if members_col else F.array(F.col(source_col))
    kept = keep or []
    narrow = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            *(F.col(c).alias(f"_k_{c}") for c in kept),
            F.array_sort(F.array_distinct(members)).alias("_members"),
            word_count(F.col(text_col)).alias("size"),
        ).withColumn("_draw", F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12), 16, 10).cast("long"))
    )
    spark = docs.sparkSession
    totals = narrow.groupBy("_members").agg(F.sum("size").alias("size")).collect()  # a row for each pattern
    patterns = sorted(totals, key=lambda r: [(x is None, x or "") for x in r["_members"]])
    names = sorted({s for r in patterns for s in r["_members"]}, key=lambda x: (x is None, x or ""))
    at = {s: i for i, s in enumerate(names)}
    sizes = [sum(r["size"] for r in patterns if s in r["_members"]) for s in names]
    # a word in several sources counts once in what is shared out
    share = [w * 1.0 for w in (weights[i % len(weights)] for i in range(len(names)))]
    targets = capped_targets(sizes, share, repeats)
    every, all_words = sum(sizes), sum(r["size"] for r in patterns)
    if every > all_words:
        targets = [t * all_words / every for t in targets]
    flows = route([r["size"] for r in patterns], [[at[s] for s in r["_members"]] for r in patterns], [round(t) for t in targets], repeats)
    rows = []
    for i, (r, f) in enumerate(zip(patterns, flows, strict=True)):
        words, given = r["size"], sum(f.values())
        rows.append((i, list(r["_members"]), given // words if words else 0, given % words if words else 0, sum(sizes[at[s]] for s in r["_members"]), float(sum(targets[at[s]] for s in r["_members"]))))
    schema = "_pattern int, _m array<string>, _whole long, _rest long, source_size long, target double"
    plan = spark.createDataFrame(rows, schema)
    plan = F.broadcast(plan) if len(rows) <= BROADCAST_PATTERNS else plan
    tagged = narrow.join(plan, F.col("_members").eqNullSafe(F.col("_m"))).drop("_members", "_m")
    drawn = prefix_sums(tagged, ["_pattern"], [F.col("_draw"), F.col("doc_id"), F.col("size")], "size")
    extra = (F.col("before") * 2 + F.col("size") <= F.col("_rest") * 2) & (F.col("_rest") > 0)
    copies = (F.col("_whole") + F.when(extra, 1).otherwise(0)).cast("int")
    return drawn.select(
        "doc_id",
        *(F.col(f"_k_{c}").alias(c) for c in kept),
        "size",
        "source_size",
        F.round("target", 3).alias("target"),
        copies.alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix itself: the documents, with all their columns, each as often as it is taken; those not taken are gone.

    Takes what ``mix`` takes: null text has no words and is never taken, null sources are a source, equal rows are
    documents of their own that share what is taken. Columns may have any names; an empty table gives an empty one.
    """
    row, key, id_, copies, times = (own_name(x, docs) for x in ("_row", "_key", "_id", "_copies", "_n"))
    hashed = F.xxhash64(*docs.columns)
    plan = mix(docs.withColumn(row, hashed), id_col, text_col, source_col=source_col, keep=[row], **options)
    taken = plan.groupBy("doc_id", row).agg(F.sum("copies").cast("int").alias(copies)).where(F.col(copies) > 0)
    taken = cut(taken.withColumnsRenamed({"doc_id": id_, row: key}))
    every = docs.withColumn(row, hashed).join(taken, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(row) == F.col(key)))
    if docs.select(hashed.alias("k")).groupBy("k").count().where("count > 1").isEmpty():
        once = every
    else:  # equal rows share their copies
        once = every.dropDuplicates([id_, row])
    return once.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).select(docs.columns)
