"""Repair of conversations as a shortest path, found by an auction.

A conversation is a lattice: a node is (rows read, state of the grammar), an arc is an edit with an integer cost. The
auction keeps a price for each node, at most the cost of the way from it to the end. A path grows from an origin: its
last node raises its price to the cheapest of (arc + price of its head) and leaves the path (contraction), or, where
the price is that already, the path takes the cheapest arc (extension). When the path arrives, every price on it is
the exact cost of its node's way. Prices stay for later origins, and a path also arrives at a node whose price is known
to be exact. Origins are taken every few rows from the end, so that work is in proportion to the rows.

Converged prices expose the tight arcs, on which cost equals the drop in price. The edits are traced along them,
smallest letter first; a node whose price is not yet known to be exact is made an origin before its arc is judged.

Conversations that span segments (``turns``) are solved by segment: the costs between a segment's states of entry and
of exit, one small matrix a segment, give the prices at its end, and then each segment is traced on its own.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendcast.llm.shared import written
from trendcast.llm.turns import _arrow_types, as_batch, same, segments, streamed, turns

# Costs of the edits, letters in ASCII order, and the grammar (s?(ua)+)? as a machine.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
KEEP = ({"s": AFTER_SYSTEM, "u": AFTER_USER}, {"u": AFTER_USER}, {"a": AFTER_ASSISTANT}, {"u": AFTER_USER})
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE_TO = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
ACCEPTED = (START, AFTER_ASSISTANT)
LEGAL_PAIRS = ("su", "ua", "au")
NEVER = 1 << 60
STRIDE = 8
FAULTS = ("blank", "duplicate", "truncated")

EDIT = "edit:string,turn:long,was:string,role:string,fault:string,text:string"
SEGMENT = ("n_rows long, first_turn long, last_turn long, n_turns long, first_role string, last_role string, blank long, "
           f"duplicate long, truncated long, illegal long, cost long, edits array<struct<{EDIT}>>")


class Auction:
    """The lattice of a run of rows, given by one symbol each: role initial (or ``-``), then ``d`` for a row that must be
    deleted, ``t`` for a truncated one, or ``-``. ``exits`` are the costs of the way from each state after the last row.

    Edits that read no row belong in front of the next row, so only the ``last`` run has them after its rows.
    """

    def __init__(self, symbols: list[str], exits=None, last: bool = True):
        self.n, self.last = len(symbols), last
        self.exits = exits or [0 if q in ACCEPTED else NEVER for q in range(4)]
        self.arcs = [self._arcs(s, q) for s in symbols for q in range(4)] + [
            [("I", NEXT[q] - q, INSERT)] if last else [] for q in range(4)]
        self.prices = [0] * len(self.arcs)
        self.exact = [False] * len(self.arcs)

    @staticmethod
    @lru_cache(256)
    def _arcs(symbol: str, q: int) -> list[tuple[str, int, int]]:
        """(letter, step to the head, cost), smallest letter first."""
        role, state = symbol
        out = [("D", 4, DELETE), ("I", NEXT[q] - q, INSERT)]
        if state != "d":
            extra = TRUNCATED if state == "t" else 0
            if role in KEEP[q]:
                out.append(("K", 4 + KEEP[q][role] - q, extra))
            out.append(("R", 4 + NEXT[q] - q, REROLE + extra))
        return out

    def settle(self, origin: int) -> int:
        """Grow a path from ``origin`` until it arrives; its price is then exact. A node from which the rows left cannot
        be so dear has no way."""
        prices, exact, arcs, end = self.prices, self.exact, self.arcs, 4 * self.n
        path = [origin]
        while not exact[origin]:
            node = path[-1]
            best, to = NEVER, -1
            if node >= end and self.exits[node - end] < NEVER:
                best = self.exits[node - end]
            for _, step, cost in arcs[node]:
                if cost + prices[node + step] < best:
                    best, to = cost + prices[node + step], node + step
            if best - min(self.exits) > 2 * (self.n - node // 4) + 20:
                prices[node], exact[node] = NEVER, True
                if len(path) > 1:
                    path.pop()
            elif prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            elif to < 0 or exact[to]:
                for node in path:
                    exact[node] = True
            else:
                path.append(to)
        return prices[origin]

    def converge(self) -> None:
        for row in range(self.n - self.n % STRIDE, 0, -STRIDE):
            for q in range(4):
                self.settle(4 * row + q)

    def trace(self, entry: int = START) -> tuple[str, int]:
        """The letters of the cheapest edits from a state, least in ASCII order, and the state after them."""
        node, letters, end = entry, [], 4 * self.n
        if self.settle(node) >= NEVER:
            return "", -1
        while True:
            price = self.prices[node]
            if node >= end and self.exits[node - end] == price:
                return "".join(letters), node - end
            for letter, step, cost in self.arcs[node]:
                if cost + self.prices[node + step] == price and cost + self.settle(node + step) == price:
                    letters.append(letter)
                    node += step
                    break

    def matrix(self) -> list[int]:
        return [self.settle(q) for q in range(4)]


def solved(symbols: tuple[str, ...]) -> tuple[str, int]:
    """The edits of a whole conversation and their cost."""
    auction = Auction(list(symbols))
    auction.converge()
    return auction.trace()[0], auction.prices[START]


@lru_cache(50_000)
def solved_short(symbols: tuple[str, ...]) -> tuple[str, int]:
    return solved(symbols)


def symbol(role: str, fault: str | None) -> str:
    return (role[:1] if role[:1] in "sua" and role else "-") + (
        "d" if fault in ("blank", "duplicate") else "t" if fault == "truncated" else "-")


def faults(rows: list[tuple[str, str]]) -> list[str | None]:
    """The first fault of each (role, text): blank, seen before, or without an end of sentence."""
    seen, out = set(), []
    for role, text in rows:
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        kept = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
        out.append("blank" if not kept else "duplicate" if key in seen else None if kept[-1] in ".!?" else "truncated")
        seen.add(key)
    return out


def edited(letters: str, rows: list[tuple], entry: int = START) -> list[tuple]:
    """The edits with the rows they make: (edit, turn, role before, role after, fault, text); rows come as (turn, role,
    fault, text)."""
    out, state, at = [], entry, 0
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            out.append((letter, None, None, ROLE_TO[state], None, ""))
            continue
        turn, role, fault, text = rows[at]
        at += 1
        if letter == "D":
            out.append((letter, turn, role, None, fault, text))
            continue
        state = KEEP[state][role[:1]] if letter == "K" else NEXT[state]
        out.append((letter, turn, role, role if letter == "K" else ROLE_TO[state], fault, text))
    return out


def _of_segment(conv_id, at, rows) -> tuple:
    """What ``SEGMENT`` lists, as if the segment were the whole conversation. Rows are (turn, role, gone, text)."""
    rows = [(turn, role, text) for turn, role, gone, text in rows if not gone]
    found = faults([r[1:] for r in rows])
    symbols = tuple(map(symbol, (r[1] for r in rows), found))
    letters, cost = (solved_short if len(rows) <= 32 else solved)(symbols)
    known = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return (
        len(rows), known[0] if known else None, known[-1] if known else None, len(set(known)),
        initials[0] if rows else None, initials[-1] if rows else None, *(found.count(f) for f in FAULTS),
        sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])), cost,
        edited(letters, [(turn, role, f, text) for (turn, role, text), f in zip(rows, found)]))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, gone, text): faults made by the checksum of ``conv_id:turn``, nulls reading as one space.

    Of 20 remainders, 0 drops a row, 1 empties its text, 2 takes its sentence ends away, 3 repeats it, 4 makes it a
    user's. Dropped rows stay, marked as gone and without text, so that their conversation is known.
    """
    rows = turns(conversations, " ")
    space = F.lit(" ")
    fate = F.crc32(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space),
                               F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    rows = rows.withColumn("fate", fate)
    text = F.when(F.col("fate").isin(0, 1), "").when(
        F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    twice = F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       (F.col("fate") == 0).alias("gone"), text.alias("text"), twice.alias("copy")).drop("copy")


def repair(rows: DataFrame, **bounds: int) -> DataFrame:
    """The cheapest edits of every conversation: one row for each segment: conv_id, ``at``, ``SEGMENT`` and
    ``segments``, how many the conversation has.

    ``rows`` are conversations (conv_id, turn, role, text), or what ``damaged`` returns; other columns are not looked
    at. A null role or text reads as one space, a null conv_id is a conversation of its own, null turns come first,
    ties go by role and text. Equal rows are told apart and all but the first are duplicates. A conversation all of
    whose rows are gone has one segment without edits; an empty table gives no rows. ``edits`` of the segments of a
    conversation, in order of ``at``, are its edits; ``text`` and ``fault`` are those of the row edited.
    """
    if "gone" not in rows.columns:
        rows = turns(rows, " ").withColumn("gone", F.lit(False))
    rows = rows.select("conv_id", "turn", "role", "gone", "text")
    found = written(segments(rows, _of_segment, SEGMENT, **bounds), "repaired")
    several = written(found.groupBy("conv_id").agg(F.count("*").alias("segments"), F.max("at").alias("end")).where(
        "segments > 1").withColumnRenamed("conv_id", "several_id"), "in-segments")
    if several.isEmpty():
        return found.withColumn("segments", F.lit(1).cast("long"))
    parts = written(found.join(several, same(found["conv_id"], several["several_id"])).drop("several_id"), "segments")
    whole = found.join(several, same(found["conv_id"], several["several_id"]), "left_anti").withColumn(
        "segments", F.lit(1).cast("long"))
    return whole.unionByName(_joined_segments(parts))


def _later_duplicates(parts: DataFrame) -> DataFrame:
    """(l_id, l_at, later): numbers of the rows of a segment that an earlier segment of the conversation has."""
    rows = parts.select("conv_id", "at", F.posexplode(F.filter("edits", lambda e: e["edit"] != "I")).alias("no", "e")).where(
        "e.fault is null or e.fault = 'truncated'").select(
        "conv_id", "at", "no", F.sha2(F.concat_ws(":", F.length("e.was"), "e.was", "e.text"), 256).alias("key"))
    firsts = rows.groupBy(F.col("conv_id").alias("f_id"), F.col("key").alias("f_key")).agg(F.min("at").alias("first"))
    later = rows.join(firsts, same(rows["conv_id"], firsts["f_id"]) & (rows["key"] == firsts["f_key"])).where("at > first")
    return later.groupBy(F.col("conv_id").alias("l_id"), F.col("at").alias("l_at")).agg(F.collect_list("no").alias("later"))


def _rows_of(edits, later) -> list[tuple]:
    rows = [(e["turn"], e["was"], e["fault"], e["text"]) for e in edits if e["edit"] != "I"]
    for no in later or ():
        rows[no] = (rows[no][0], rows[no][1], "duplicate", rows[no][3])
    return rows


def _converged(rows: list[tuple], exits, last: bool) -> Auction:
    auction = Auction([symbol(r[1], r[2]) for r in rows], exits, last)
    auction.converge()
    return auction


def _per_segment(df: DataFrame, of, schema: str, inputs: list[str]) -> DataFrame:
    """conv_id, at and ``of`` of the named columns of each segment, a few segments at a time."""
    id_type = df.schema["conv_id"].dataType.simpleString()
    full = f"conv_id {id_type}, at long, {schema}"
    types = _arrow_types(df.sparkSession, full)
    names = ["conv_id", "at", *[part.split()[0] for part in re.split(r",\s*(?![^<]*>)", schema)]]

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                block = batch.slice(start, 16)
                out = [(conv_id, at, *of(*row)) for conv_id, at, *row in zip(*(c.to_pylist() for c in block.columns))]
                if out:
                    yield as_batch(out, names, types)

    return df.select("conv_id", "at", *inputs).mapInArrow(run, full)


def _ways(edits, later, last) -> tuple:
    """Costs from each state of entry to each state of exit; for the last segment, to the end."""
    rows = _rows_of(edits, later)
    if last:
        return (_converged(rows, None, True).matrix(),)
    return ([c for exit_state in range(4) for c in _converged(
        rows, [0 if q == exit_state else NEVER for q in range(4)], False).matrix()],)


def _exits(ways) -> list[tuple[int, list[int]]]:
    """The prices at the end of each segment of a conversation, from its last segment on."""
    out, price = [], [0 if q in ACCEPTED else NEVER for q in range(4)]
    for n, (at, costs) in enumerate(sorted(((w["at"], w["costs"]) for w in ways), reverse=True)):
        out.append((at, price))
        if not n:
            price = list(costs)
        else:
            price = [min(NEVER, min(costs[4 * to + q] + price[to] for to in range(4))) for q in range(4)]
    return out


def _routes(edits, later, last, exits) -> tuple:
    auction = _converged(_rows_of(edits, later), exits, last)
    routes = [auction.trace(q) for q in range(4)]
    return [r[0] for r in routes], [r[1] for r in routes]


def _entries(routes) -> list[tuple[int, int]]:
    out, state = [], START
    for at, exits in sorted((r["at"], r["exit_states"]) for r in routes):
        out.append((at, state))
        state = exits[state]
    return out


def _final(edits, later, entry, letters) -> tuple:
    rows = _rows_of(edits, later)
    out = edited(letters[entry], rows, entry)
    found = [r[2] for r in rows]
    kept = sum(TRUNCATED for e in out if e[0] in "KR" and e[4] == "truncated")
    cost = kept + sum({"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[e[0]] for e in out)
    return (*(found.count(f) for f in FAULTS), cost, out)


def _by_conversation(df: DataFrame, column: str, of, fields: str) -> DataFrame:
    """(g_id, g_at, ...): ``of`` of the collected (at, column) of a conversation, one small struct for each segment."""
    name = fields.split(":")[0]
    spread = F.udf(of, f"array<struct<at:long,{fields}>>")
    grouped = df.groupBy("conv_id").agg(F.collect_list(F.struct("at", column)).alias("all"))
    return grouped.select(F.col("conv_id").alias("g_id"), F.explode(spread("all")).alias("g")).select(
        "g_id", F.col("g.at").alias("g_at"), F.col(f"g.{name}").alias(name))


def _joined_segments(parts: DataFrame) -> DataFrame:
    """The edits of conversations that have several segments."""
    later = _later_duplicates(parts)
    parts = parts.withColumn("last", F.col("at") == F.col("end"))
    parts = written(parts.join(later, same(parts["conv_id"], later["l_id"]) & (parts["at"] == later["l_at"]), "left").drop(
        "l_id", "l_at", "end"), "segments-with-duplicates")
    ways = _per_segment(parts, _ways, "costs array<long>", ["edits", "later", "last"])
    exits = _by_conversation(ways, "costs", _exits, "exits:array<long>")
    priced = parts.join(exits, same(parts["conv_id"], exits["g_id"]) & (parts["at"] == exits["g_at"])).drop("g_id", "g_at")
    routes = written(_per_segment(priced, _routes, "letters array<string>, exit_states array<int>",
                                  ["edits", "later", "last", "exits"]), "routes")
    entries = _by_conversation(routes, "exit_states", _entries, "entry:int")
    chosen = routes.join(entries, same(routes["conv_id"], entries["g_id"]) & (routes["at"] == entries["g_at"])).select(
        F.col("conv_id").alias("c_id"), F.col("at").alias("c_at"), "letters", "entry")
    ready = parts.join(chosen, same(parts["conv_id"], chosen["c_id"]) & (parts["at"] == chosen["c_at"]))
    schema = f"blank long, duplicate long, truncated long, cost long, edits array<struct<{EDIT}>>"
    final = _per_segment(ready, _final, schema, ["edits", "later", "entry", "letters"]).withColumnsRenamed(
        {"conv_id": "e_id", "at": "e_at"})
    kept = parts.drop("edits", "later", "last", "blank", "duplicate", "truncated", "cost")
    return kept.join(final, same(kept["conv_id"], final["e_id"]) & (kept["at"] == final["e_at"])).drop("e_id", "e_at")


AUDIT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
         "repaired_sha256 string")


def _audited(parts) -> tuple:
    """The report on one conversation, from its segments in order."""
    digest, audit, counts, illegal, n_turns = hashlib.sha256(), [], [0] * 4, 0, 0
    least = before = role = None
    empty = True
    for n_rows, first, last, turns_here, first_role, last_role, own_illegal, *own, edits in parts:
        counts = [a + b for a, b in zip(counts, own)]
        if n_rows:
            illegal += own_illegal + (role is not None and role + first_role not in LEGAL_PAIRS)
            role = last_role
        if first is not None:
            least = first if least is None else least
            n_turns += turns_here - (first == before)
            before = last
        for e in edits:
            audit.append(e["edit"])
            if e["edit"] != "D":
                digest.update(("" if empty else "\n").encode() + f"{e['role']}:{e['text']}".encode())
                empty = False
    gaps = 0 if least is None else before - least + 1 - n_turns
    return (gaps, *counts[:3], illegal, counts[3], "".join(audit), digest.hexdigest())


def audits(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id and ``AUDIT``, from the segments that ``repair`` returns.

    Conversations of one segment are reported in place; only those of several are brought together, as a stream.
    """
    order = ["n_rows", "first_turn", "last_turn", "n_turns", "first_role", "last_role", "illegal", "blank", "duplicate",
             "truncated", "cost", "edits"]
    kept = F.filter("edits", lambda e: e["edit"] != "D")
    text = F.array_join(F.transform(kept, lambda e: F.concat(e["role"], F.lit(":"), e["text"])), "\n")
    gaps = F.when(F.col("first_turn").isNull(), F.lit(0)).otherwise(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"))
    whole = repaired.where("segments = 1").select(
        "conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost",
        F.array_join(F.transform("edits", lambda e: e["edit"]), "").alias("audit"),
        F.sha2(text.cast("binary"), 256).alias("repaired_sha256"))
    return whole.unionByName(streamed(
        repaired.where("segments > 1").select("conv_id", "at", *order), _audited, AUDIT))
