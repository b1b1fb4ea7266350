"""Repair of conversations: Knuth's lightest derivation over the edits of a conversation's rows.

The roles of a repaired conversation are an optional system turn, then pairs of user and assistant. An item [p, k, q]
says that the first k rows can be edited so that the roles lead from state p to state q of that pattern; its value is
(cost, audit), the edits' initials in order. An edit deduces [p, k + 1, q'] (or, inserting, [p, k, q']) from [p, k, q];
two spans that meet in a state deduce their join. These functions are monotone in each value and never less than one:
at equal cost the audits of one item aren't prefixes of each other, as only inserts, which cost, consume no row. So the
least value on the agenda is final when it is popped, and the first final goal is the cheapest repair.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeloom.llm.shared import cut, shuffle_partitions

#: What edits cost; a truncated row that stays adds its own.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern of role initials (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES = range(4)
ACCEPTED = (0, 3)
#: (state, initial) -> state
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: The user or assistant turn that may follow a state.
NEXT = {0: "u", 1: "u", 3: "u", 2: "a"}
ROLE = {"u": "user", "a": "assistant"}
#: A conversation is worked on in segments of at most so many rows and about so many characters.
ROWS, CHARS = 256, 2_000_000
#: So many neighbouring spans of a conversation are joined at once.
FAN = 32
_BLANK = re.compile(r"[^\x20\x09-\x0D]")

Value = tuple[int, str]


def lightest(axioms: Iterable[tuple[object, Value]], deduce: Callable[[object, Value], Iterable[tuple[object, Value]]], goal: object = None) -> dict[object, Value]:
    """Final values of items, until ``goal`` is final or the agenda is empty (Knuth 1977).

    ``deduce`` gives the items that follow from an item that has just become final and those that were before.
    """
    agenda = [(value, item) for item, value in axioms]
    heapq.heapify(agenda)
    best, final = {}, {}
    while agenda:
        value, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if item == goal:
            break
        for other, new in deduce(item, value):
            if other not in final and (other not in best or new < best[other]):
                best[other] = new
                heapq.heappush(agenda, (new, other))
    return final


def _edits(initial: str, fault: str, state: int) -> Iterator[tuple[int, int, str]]:
    """State, cost and initial of every edit of a row that may be made in a state."""
    yield state, DELETE, "D"
    if fault in ("blank", "duplicate"):
        return
    more = TRUNCATED if fault == "truncated" else 0
    if (state, initial) in STEP:
        yield STEP[state, initial], KEEP + more, "K"
    yield STEP[state, NEXT[state]], REROLE + more, "R"


GOAL = (9, 9, 9)


def spans(initials: list[str], faults: list[str], whole: bool = False) -> dict[tuple[int, int], Value]:
    """Lightest (cost, audit) from each state to each over all the rows; if ``whole``, only from the start to the goal, as (0, 0)."""
    n = len(initials)

    def deduce(item: tuple[int, int, int], value: Value) -> Iterator[tuple[object, Value]]:
        p, k, q = item
        cost, audit = value
        yield (p, k, STEP[q, NEXT[q]]), (cost + INSERT, audit + "I")
        if k < n:
            for to, more, letter in _edits(initials[k], faults[k], q):
                yield (p, k + 1, to), (cost + more, audit + letter)
        elif whole and q in ACCEPTED:
            yield GOAL, value

    starts = [0] if whole else STATES
    final = lightest([((p, 0, p), (0, "")) for p in starts], deduce, GOAL if whole else None)
    if whole:
        return {(0, 0): final[GOAL]}
    return {(p, q): value for (p, k, q), value in final.items() if k == n}


def joined(parts: list[dict[tuple[int, int], Value]]) -> dict[tuple[int, int], Value]:
    """Lightest values over neighbouring spans: [0, j, p, q] and [j, j + 1, q, r] deduce [0, j + 1, p, r]."""

    def deduce(item: tuple[int, int, int], value: Value) -> Iterator[tuple[object, Value]]:
        p, j, q = item
        if j < len(parts):
            for r in STATES:
                if (q, r) in parts[j]:
                    cost, audit = parts[j][q, r]
                    yield (p, j + 1, r), (value[0] + cost, value[1] + audit)

    final = lightest([((p, 0, p), (0, "")) for p in STATES], deduce)
    return {(p, q): value for (p, j, q), value in final.items() if j == len(parts)}


def faults(roles: list[str], texts: list[str], earlier: Iterable[int] = ()) -> list[str]:
    """The first fault of each row: blank, duplicate, truncated or none; earlier: rows whose role and text an earlier segment has."""
    seen, out = set(), []
    before = set(earlier)
    for i, both in enumerate(zip(roles, texts, strict=True)):
        text = both[1]
        if not _BLANK.search(text):
            out.append("blank")
        elif both in seen or i in before:
            out.append("duplicate")
        else:
            out.append("" if text.rstrip("\t\n\v\f\r ")[-1] in ".!?" else "truncated")
        seen.add(both)
    return out


def repaired(audit: str, roles: list[str], texts: list[str], state: int = 0) -> tuple[list[str], int]:
    """The lines ``role:text`` that an audit leaves, and the state after them."""
    lines, rows = [], zip(roles, texts, strict=True)
    for letter in audit:
        if letter == "I":
            lines.append(f"{ROLE[NEXT[state]]}:")
            state = STEP[state, NEXT[state]]
            continue
        role, text = next(rows)
        if letter == "D":
            continue
        lines.append(f"{role if letter == 'K' else ROLE[NEXT[state]]}:{text}")
        state = STEP[state, role[:1] if letter == "K" else NEXT[state]]
    return lines, state


def damage(rows: DataFrame) -> DataFrame:
    """The fixed faults of the test: conv_id, turn, role, text after damage. A dropped row stays with null role and text.

    Nulls in conv_id and turn are one space in what is hashed; null roles and texts are one space.
    """
    filled = rows.select("conv_id", "turn", *(F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")))
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    drawn = filled.withColumn("_k", (F.crc32(named.cast("binary")) % 20).cast("int"))
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    stays = F.col("_k") != 0
    changed = drawn.select(
        "conv_id",
        F.when(stays, F.col("turn")).alias("turn"),
        F.when(stays, F.when(F.col("_k") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(stays, text).alias("text"),
        F.explode(F.when(F.col("_k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return changed.drop("_copy")


def _segments(rows: DataFrame) -> DataFrame:
    """Runs of a conversation's rows in order, of bounded size: _key, conv_id, pid, seg, open, turns, roles, texts.

    Rows are range-partitioned by conversation and order, so a conversation of any size lies in neighbouring tasks.
    (pid, seg) orders its segments. ``open``: the conversation may have more than this segment. Rows without a role
    were dropped: they only say that there is such a conversation.
    """
    source = rows.select(F.concat_ws(":", F.isnull("conv_id"), F.col("conv_id").cast("string")).alias("_key"), "conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    order = ["_key", "turn", "role", "text"]
    # equal rows, however many, are dealt apart by their place in the input
    tied = source.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(shuffle_partitions(rows.sparkSession), *order, "_tie").sortWithinPartitions(*order).drop("_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seg = TaskContext.get().partitionId(), 0
        held, chars, first = [], 0, True  # the rows of the segment at hand; whether its conversation is the partition's first

        def out(open_: bool) -> pa.RecordBatch:
            nonlocal seg, held, chars
            there = [r for r in held if r[3] is not None]
            row = [[held[0][0]], [held[0][1]], [pid], [seg], [open_], *([[r[i] for r in there]] for i in (2, 3, 4))]
            seg, held, chars = seg + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)], _SEGMENT)

        kinds = None
        split = False  # whether an earlier segment of the conversation has left
        for batch in batches:
            kinds = [pa.string(), batch.column("conv_id").type, pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string())]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield out(first or split)
                    first = split = False
                elif len(held) >= ROWS or chars > CHARS:
                    yield out(True)
                    split = True
                if row[3] is None and held:
                    continue
                held.append(row)
                chars += len(row[4] or "")
        if held:
            yield out(True)

    schema = T.StructType([T.StructField("_key", T.StringType()), source.schema["conv_id"], *(T.StructField(c, T.IntegerType()) for c in ("pid", "seg")), T.StructField("open", T.BooleanType()), T.StructField("turns", T.ArrayType(T.LongType())), *(T.StructField(c, T.ArrayType(T.StringType())) for c in ("roles", "texts"))])
    return ranged.mapInArrow(run, schema)


_SEGMENT = ["_key", "conv_id", "pid", "seg", "open", "turns", "roles", "texts"]


def _gaps() -> Column:
    return F.coalesce(F.col("_high") - F.col("_low") + 1 - F.col("_turns"), F.lit(0)).alias("gaps")


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _closed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Conversations that are one segment: their counts and repair."""
    for batch in batches:
        out = []
        for conv, turns, roles, texts in zip(batch["conv_id"], batch["turns"], batch["roles"], batch["texts"], strict=True):
            roles, texts = list(roles), list(texts)
            found = faults(roles, texts)
            initials = [r[:1] for r in roles]
            cost, audit = spans(initials, found, whole=True)[0, 0]
            lines, _ = repaired(audit, roles, texts)
            known = {int(t) for t in turns if t == t and t is not None}
            gaps = max(known) - min(known) + 1 - len(known) if known else 0
            out.append((conv, gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), _illegal(initials), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
        yield pd.DataFrame(out, columns=_RESULT)


_RESULT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
_TABLE = "_key string, ordinal long, sizes array<int>, p array<int>, q array<int>, cost array<long>, audit array<string>"


def _table_row(table: dict[tuple[int, int], Value]) -> tuple[list, ...]:
    at = sorted(table)
    return [p for p, _ in at], [q for _, q in at], [table[x][0] for x in at], [table[x][1] for x in at]


def _tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of every segment its counts, faults apart, and the table of its spans."""
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            roles, texts = list(r.roles), list(r.texts)
            found = faults(roles, texts, r.earlier if r.earlier is not None else ())
            initials = [x[:1] for x in roles]
            out.append((r.key, r.ordinal, *(found.count(x) for x in ("blank", "duplicate", "truncated")), _illegal(initials), "".join(x or "\0" for x in initials[:1]), "".join(x or "\0" for x in initials[-1:]), [len(roles)], *_table_row(spans(initials, found))))
        yield pd.DataFrame(out, columns=["_key", "ordinal", "blank", "duplicate", "truncated", "illegal", "first", "last", "sizes", "p", "q", "cost", "audit"])


def _join_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("ordinal")
    parts = [{(p, q): (int(c), a) for p, q, c, a in zip(r.p, r.q, r.cost, r.audit, strict=True)} for r in group.itertuples()]
    sizes = [int(n) for r in group.itertuples() for n in r.sizes]
    return pd.DataFrame([(key[0], key[1], sizes, *_table_row(joined(parts)))], columns=["_key", "ordinal", "sizes", "p", "q", "cost", "audit"])


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A conversation's lightest audit, cut into its segments' parts; ordinal -1 has the whole of it and its cost."""
    for batch in batches:
        for r in batch.itertuples(index=False):
            cost, audit = min((int(c), a) for p, q, c, a in zip(r.p, r.q, r.cost, r.audit, strict=True) if p == 0 and q in ACCEPTED)
            rows = [m.end() for m in re.finditer("[KRD]", audit)]
            out, at, done = [(r.key, -1, cost, audit)], 0, 0
            for i, n in enumerate(r.sizes):
                done += int(n)
                end = len(audit) if i == len(r.sizes) - 1 else rows[done - 1] if done else 0
                out.append((r.key, i, 0, audit[at:end]))
                at = end
            yield pd.DataFrame(out, columns=["_key", "ordinal", "cost", "audit"])


def _hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each conversation's repaired lines; segments come in order, and only one is held."""
    key, state, hashed, any_ = None, 0, hashlib.sha256(), False
    for batch in batches:
        out = []
        for r in batch.itertuples(index=False):
            if r.key != key:
                if key is not None:
                    out.append((key, hashed.hexdigest()))
                key, state, hashed, any_ = r.key, 0, hashlib.sha256(), False
            lines, state = repaired(r.audit, list(r.roles), list(r.texts), state)
            if lines:
                hashed.update((("\n" if any_ else "") + "\n".join(lines)).encode())
                any_ = True
        yield pd.DataFrame(out, columns=["_key", "repaired_sha256"])
    if key is not None:
        yield pd.DataFrame([(key, hashed.hexdigest())], columns=["_key", "repaired_sha256"])


def _open(segments: DataFrame) -> DataFrame:
    """Conversations of any number of segments, the same result as ``_closed``."""
    numbered = Window.partitionBy("_key").orderBy("pid", "seg")  # narrow: a row a segment
    number = cut(segments.select("_key", "pid", "seg").withColumn("ordinal", (F.row_number().over(numbered) - 1).cast("long")))
    where = F.struct("pid", "seg").alias("at")
    each = segments.select("_key", where, F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "row"))
    each = each.select("_key", "at", "i", F.md5(F.concat(F.length("row.roles").cast("string"), F.lit(":"), "row.roles", "row.texts")).alias("h"))
    each = each.groupBy("_key", "h", "at").agg(F.min("i").alias("i"))  # later ones in a segment are seen there
    firsts = each.groupBy("_key", "h").agg(F.min("at").alias("first"))
    earlier = each.join(firsts, ["_key", "h"]).where(F.col("at") > F.col("first")).groupBy("at").agg(F.collect_list("i").alias("earlier"))
    with_number = segments.join(number.drop("_key"), ["pid", "seg"])
    faulty = with_number.join(earlier.select("at.pid", "at.seg", "earlier"), ["pid", "seg"], "left").select(F.col("_key").alias("key"), "ordinal", "roles", "texts", "earlier")
    tables = cut(faulty.mapInPandas(_tables, "_key string, ordinal long, blank long, duplicate long, truncated long, illegal long, first string, last string, sizes array<int>, p array<int>, q array<int>, cost array<long>, audit array<string>"))

    spans_ = tables.select("_key", "ordinal", "sizes", "p", "q", "cost", "audit")
    most = tables.agg(F.max("ordinal")).first()[0] or 0
    while most > 0:  # some log(segments) rounds
        spans_ = spans_.groupBy("_key", F.floor(F.col("ordinal") / FAN).alias("up")).applyInPandas(_join_group, _TABLE)
        most //= FAN
    pieces = cut(spans_.withColumnRenamed("_key", "key").mapInPandas(_pieces, "_key string, ordinal long, cost long, audit string"))

    at = Window.partitionBy("_key").orderBy("ordinal")
    turns = with_number.select("_key", "conv_id", "ordinal", *(F.expr(f"{f}(filter(turns, t -> t is not null))").alias(c) for f, c in (("array_min", "_low"), ("array_max", "_high"))), F.expr("size(array_distinct(filter(turns, t -> t is not null)))").alias("_turns"))
    edges = tables.select("_key", "ordinal", "blank", "duplicate", "truncated", "illegal", "first", "last").join(turns, ["_key", "ordinal"])
    # segments without rows, or without turns, are passed over when neighbours meet
    last_role = F.last(F.when(F.col("last") != "", F.col("last")), ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, -1))
    last_turn = F.last("_high", ignorenulls=True).over(at.rowsBetween(Window.unboundedPreceding, -1))
    met = edges.withColumn("_meet", ((F.col("first") != "") & ~F.concat(last_role, "first").isin("su", "ua", "au")).cast("long")).withColumn("_again", (last_turn == F.col("_low")).cast("long"))
    counts = met.groupBy("_key").agg(
        F.first("conv_id").alias("conv_id"), F.min("_low").alias("_low"), F.max("_high").alias("_high"), (F.sum("_turns") - F.coalesce(F.sum("_again"), F.lit(0))).alias("_turns"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), (F.sum("illegal") + F.coalesce(F.sum("_meet"), F.lit(0))).alias("illegal"),
    )
    lines = with_number.join(pieces.where("ordinal >= 0").drop("cost"), ["_key", "ordinal"]).select(F.col("_key").alias("key"), "ordinal", "roles", "texts", "audit")
    # the hash of a conversation is serial by its nature; a task streams through its segments
    hashes = lines.repartition(shuffle_partitions(segments.sparkSession), "key").sortWithinPartitions("key", "ordinal").mapInPandas(_hashes, "_key string, repaired_sha256 string")
    totals = pieces.where("ordinal < 0").drop("ordinal")
    return counts.join(totals, "_key").join(hashes, "_key").select("conv_id", _gaps(), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(rows: DataFrame) -> DataFrame:
    """Cheapest repair of every conversation. rows: conv_id, turn, role, text, as ``damage`` gives them.

    Rows of a conversation are taken by turn (nulls first), then role, then text, so equal turns have a defined order
    and repeated rows are equal neighbours. A null conv_id is a conversation of its own. Rows with a null role only
    say that the conversation exists. Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256, a row a conversation. Further columns of ``rows`` are left out.

    A conversation that lies within one task and segment is repaired at once. One of more rows is cut into segments,
    each of which gives the lightest span from every state to every other; neighbouring spans are joined in rounds.
    The audit and the hash are one value a conversation, so these grow with its rows.
    """
    segments = cut(_segments(rows))
    conv = T.StructType([segments.schema["conv_id"], *(T.StructField(c, T.StringType() if c in ("audit", "repaired_sha256") else T.LongType()) for c in _RESULT[1:])])
    closed = segments.where("not open").select("conv_id", "turns", "roles", "texts").mapInPandas(_closed, conv)
    open_ = segments.where("open")
    return closed.unionByName(_open(open_))
