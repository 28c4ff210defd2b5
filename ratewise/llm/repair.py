"""Conversation structure repair by a persistent audit DP.

The turns of a conversation, in order, are kept, given the role of user or
assistant, deleted, or have an empty turn put before them, so that the role
initials read ``(s?(ua)+)?`` at the least cost; among the cheapest edit sequences
("audits") the least in ASCII order wins.  Four states (nothing yet, after the
system turn, after a user turn, after an assistant turn) each keep one best audit.

*Persistent prefixes.*  An audit is a linked node: parent, edit, depth, ancestors at
powers of two and a rolling hash, so all states share their prefixes and an edit
costs one node.

*Ties.*  Two audits of equal cost are compared at their longest common prefix, found
by jumping up from the largest power of two while the hashes differ.  Equal hashes
of different nodes are verified edit by edit, so a collision cannot change a result.
(Equal costs at one place mean the shorter audit is no prefix of the longer one, so
the order of two prefixes stays when edits follow.)

*Bounded memory.*  Rows come sorted by conversation and turn and are streamed.  What
all open audits share is final: it is written out at intervals and its nodes and
texts are forgotten, so a conversation of any length holds only the rows that are
still open, and 16 bytes a turn to know repeated ones.  A conversation is one audit,
hence one task works on it; that task never gathers it.

Cases: null role or text is one space; null turns sort first; rows of one turn are
ordered by role, then text; repeated rows are duplicates; a null ``conv_id`` is a
conversation of its own; very long texts are whole; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain, read, small_batches
from .spelling import crc32_sql

# Fixed values of the contract: costs and the edits' initials.
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 4, 3, 3, 3
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
SPACE = "[^\\x20\\x09-\\x0D]"

# States: nothing kept yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER,
         (USER, "a"): ASSISTANT}
_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # of a new or changed role
_ROLE = {USER: "user", ASSISTANT: "assistant"}

_BASE, _MOD = 1_000_003, (1 << 61) - 1
_FLUSH_NODES = 4096


class Audits:
    """Persistent strings of edits; node 0 is the empty one."""

    def __init__(self, mod: int = _MOD):
        self.mod = mod
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [()]

    def add(self, parent: int, edit: str) -> int:
        ups = [parent]
        while len(self.up[ups[-1]]) >= len(ups):
            ups.append(self.up[ups[-1]][len(ups) - 1])
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % self.mod)
        self.up.append(tuple(ups))
        return len(self.edit) - 1

    def lift(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``."""
        while (rest := self.depth[node] - depth) > 0:
            node = self.up[node][rest.bit_length() - 1]
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth spell the same edits."""
        if x == y:
            return True
        if self.hash[x] != self.hash[y]:
            return False
        while x != y:  # verify
            if self.edit[x] != self.edit[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether the edits of ``x`` sort before those of ``y``."""
        depth = min(self.depth[x], self.depth[y])
        a, b = self.lift(x, depth), self.lift(y, depth)
        if self.same(a, b):
            return self.depth[x] < self.depth[y]
        for k in reversed(range(len(self.up[a]))):
            if k < len(self.up[a]) and not self.same(self.up[a][k], self.up[b][k]):
                a, b = self.up[a][k], self.up[b][k]
        return self.edit[a] < self.edit[b]

    def shared(self, x: int, y: int) -> int:
        """The deepest node that both descend from."""
        depth = min(self.depth[x], self.depth[y])
        x, y = self.lift(x, depth), self.lift(y, depth)
        for k in reversed(range(len(self.up[x]))):
            if k < len(self.up[x]) and self.up[x][k] != self.up[y][k]:
                x, y = self.up[x][k], self.up[y][k]
        return x if x == y else self.up[x][0]

    def edits(self, node: int, above: int = 0) -> str:
        """The edits from node ``above`` down to ``node``."""
        out = []
        while node != above:
            out.append(self.edit[node])
            node = self.up[node][0]
        return "".join(reversed(out))


class Repair:
    """The DP over the turns of one conversation, fed in order."""

    def __init__(self, mod: int = _MOD, flush_nodes: int = _FLUSH_NODES):
        self.mod, self.flush_nodes = mod, flush_nodes
        self.audits, self.limit = Audits(mod), flush_nodes
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}  # state -> (cost, node)

    def _offer(self, best: dict[int, tuple[int, int]], state: int, cost: int, parent: int,
               edit: str) -> None:
        old = best.get(state)
        if old is None or cost <= old[0]:
            node = self.audits.add(parent, edit)
            if old is None or cost < old[0] or self.audits.less(node, old[1]):
                best[state] = (cost, node)

    def _insert(self) -> None:
        """Empty turns before the next row.  No cheapest audit needs more than two:
        user then assistant.

        Then states go that cannot win any more.  After an assistant turn all can follow
        that can follow a system turn, and but for one system turn, deleted instead
        of kept, all that can follow nothing.  Without this the audit that deletes all
        would stay open for ever."""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if state in self.best:
                cost, node = self.best[state]
                self._offer(self.best, _NEXT[state], cost + INSERT_COST, node, INSERT)
        least = self.best[ASSISTANT][0]
        for state, margin in ((START, DELETE_COST), (SYSTEM, 0)):
            if state in self.best and self.best[state][0] > least + margin:
                del self.best[state]

    def turn(self, initial: str, fault: str | None) -> None:
        self._insert()
        new: dict[int, tuple[int, int]] = {}
        extra = TRUNCATED_COST if fault == "truncated" else 0
        for state, (cost, node) in self.best.items():
            self._offer(new, state, cost + DELETE_COST, node, DELETE)
            if fault not in ("blank", "duplicate"):
                kept = _KEPT.get((state, initial))
                if kept is not None:
                    self._offer(new, kept, cost + extra, node, KEEP)
                self._offer(new, _NEXT[state], cost + extra + REROLE_COST, node, REROLE)
        self.best = new

    def settled(self) -> str:
        """Edits that are final, because all states share them (now and then)."""
        a = self.audits
        if len(a.edit) < self.limit:
            return ""
        nodes = [node for _, node in self.best.values()]
        top = nodes[0]
        for node in nodes[1:]:
            top = a.shared(top, node)
        done = a.edits(top)
        kept, moved = Audits(self.mod), {}
        for state, (cost, node) in self.best.items():  # only what is open stays
            chain = []
            while node != top and node not in moved:
                chain.append(node)
                node = a.up[node][0]
            at = moved.get(node, 0)
            for old in reversed(chain):
                at = moved[old] = kept.add(at, a.edit[old])
            self.best[state] = (cost, at)
        self.audits = kept
        self.limit = max(self.flush_nodes, 4 * len(kept.edit))
        return done

    def rest(self) -> str:
        """The remaining edits of the cheapest audit."""
        self._insert()
        ends = [self.best[s] for s in (START, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or (c == cost and self.audits.less(n, node)):
                cost, node = c, n
        return self.audits.edits(node)


# --- streaming over sorted rows ---------------------------------------------------

EDIT_SCHEMA = ("conv_id long, seq long, edit string, turn long, role string, text string, "
               "fault string, new_role string, cost long")
_ARROW = pa.schema([("conv_id", pa.int64()), ("seq", pa.int64()), ("edit", pa.string()),
                    ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                    ("fault", pa.string()), ("new_role", pa.string()), ("cost", pa.int64())])
_OUT_ROWS = 500


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in batch.schema.names))


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The edits of every conversation as rows of ``EDIT_SCHEMA``."""
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        dp, seen, waiting = Repair(), set(), []
        state, seq, consumed = START, 0, 0

        def told(edits: str) -> Iterator[tuple]:
            nonlocal state, seq, consumed
            for edit in edits:
                if edit == INSERT:
                    state = _NEXT[state]
                    out = (None, None, "", None, _ROLE[state], INSERT_COST)
                else:
                    turn, role, text, fault = waiting[consumed]
                    consumed += 1
                    if edit == KEEP:
                        state = _KEPT[state, role[:1]]
                    elif edit == REROLE:
                        state = _NEXT[state]
                    new = None if edit == DELETE else role if edit == KEEP else _ROLE[state]
                    cost = DELETE_COST if edit == DELETE else (REROLE_COST if edit == REROLE else 0) + (
                        TRUNCATED_COST if fault == "truncated" else 0)
                    out = (turn, role, text, fault, new, cost)
                turn, role, text, fault, new, cost = out
                yield conv, seq, edit, turn, role, text, fault, new, cost
                seq += 1
            del waiting[:consumed]
            consumed = 0

        for _, turn, role, text, present, fault in rows:
            if not present:
                continue
            mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"),
                                   digest_size=16).digest()
            if fault != "blank" and mark in seen:
                fault = "duplicate"
            seen.add(mark)
            waiting.append((turn, role, text, fault))
            dp.turn(role[:1], fault)
            yield from told(dp.settled())
        yield from told(dp.rest())
        if not seq:  # nothing to tell: the conversation is still named
            yield conv, 0, None, None, None, None, None, None, 0


def _batched(rows: Iterable[tuple], schema: pa.Schema, size: int = _OUT_ROWS) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)],
                                             schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)],
                                         schema=schema)


def repair_conversations(conversations: DataFrame, present: str | None = None) -> DataFrame:
    """The edits of the cheapest audit of every conversation, in order: ``(conv_id, seq,
    edit, turn, role, text, fault, new_role, cost)``.  The rows with a ``new_role`` are the
    repaired conversation; inserted rows have no turn.  Rows whose column ``present`` is
    false only name their conversation.  A conversation without edits is one row with a
    null edit.  Each partition holds whole conversations in order."""
    small_batches(conversations.sparkSession)
    there = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(False))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), there.alias("present"))
    last = F.regexp_extract("text", f"({SPACE})[\\x20\\x09-\\x0D]*\\z", 1)
    fault = F.when(~F.col("text").rlike(SPACE), F.lit("blank")).when(
        ~last.isin(".", "!", "?"), F.lit("truncated"))
    ordered = rows.withColumn("fault", fault).repartition("conv_id").sortWithinPartitions(
        "conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(lambda batches: _batched(_repaired(batches), _ARROW), EDIT_SCHEMA)


# --- the query's contract ------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, present)``: rows dropped, emptied, stripped of sentence
    ends, repeated or turned into user rows by the CRC-32 of ``conv_id:turn``."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = plain(conversations, conv_id="long", turn="long", role="string", text="string").select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(name.cast("binary")) % 20).alias("harm"))
    harm = F.col("harm")
    text = F.when(harm.isin(0, 1), F.lit("")).when(
        harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(harm == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (harm != 0).alias("present"),
                       F.explode(F.when(harm == 3, F.array(F.lit(0), F.lit(1))).otherwise(
                           F.array(F.lit(0)))).alias("copy")).drop("copy")


SUMMARY_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                  "cost long, audit string, repaired_sha256 string")
_SUMMARY = pa.schema([("conv_id", pa.int64())] + [(n, pa.int64()) for n in (
    "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for conv, rows in groupby(_rows(batches), key=lambda r: r[0]):
        faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        low = high = before = None
        turns = illegal = cost = 0
        audit, sha, kept = [], hashlib.sha256(), False
        for _, _, edit, turn, role, text, fault, new_role, price in rows:
            cost += price
            audit.append(edit or "")
            if fault:
                faults[fault] += 1
            if edit not in (None, INSERT):
                if turn is not None:
                    low = turn if low is None else low
                    turns += turn != high  # rows come by turn
                    high = turn
                if before is not None:
                    illegal += before + role[:1] not in ("su", "ua", "au")
                before = role[:1]
            if new_role is not None:
                sha.update(f"{chr(10) if kept else ''}{new_role}:{text}".encode("utf-8", "surrogatepass"))
                kept = True
        yield (conv, 0 if low is None else high - low + 1 - turns, *faults.values(), illegal, cost,
               "".join(audit), sha.hexdigest())


def summarise(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair_conversations``, whose partitions hold whole
    conversations in order: counts of faults, cost, audit and a digest of the result."""
    return edits.mapInArrow(lambda batches: _batched(_summaries(batches), _SUMMARY), SUMMARY_SCHEMA)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(repair_conversations(damaged(read(spark, sf_dir, "conversations")), "present"))


# --- DuckDB: the same DP on strings of cost and audit ------------------------------------

def _sql_dp() -> str:
    """One step over all rows of a place: a state is its cost in eight digits and its
    audit, so that the least string is the cheapest, then the least audit."""
    none = "'~'"

    def plus(state: str, cost: str, edit: str) -> str:
        return (f"CASE WHEN {state} = {none} THEN {none} ELSE lpad(CAST(CAST(substr({state}, 1, 8) AS BIGINT)"
                f" + {cost} AS VARCHAR), 8, '0') || substr({state}, 9) || '{edit}' END")

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN initial = '{initial}' AND fault <= 1 THEN {plus(state, 'late', 'K')} ELSE {none} END"

    def rerole(state: str) -> str:
        return f"CASE WHEN fault <= 1 THEN {plus(state, '3 + late', 'R')} ELSE {none} END"

    return f"""
filled AS (  -- empty turns before the row
  SELECT conv_id, place, s0, s1, v2 AS s2, least(s3, {plus('v2', '3', 'I')}) AS s3 FROM (
    SELECT *, least(s2, {plus('s0', '3', 'I')}, {plus('s1', '3', 'I')}, {plus('s3', '3', 'I')}) AS v2
    FROM states) f)
SELECT f.conv_id, f.place + 1 AS place,
       {plus('s0', '4', 'D')} AS s0,
       least({plus('s1', '4', 'D')}, {keep('s0', 's')}) AS s1,
       least({plus('s2', '4', 'D')}, {keep('s0', 'u')}, {keep('s1', 'u')}, {keep('s3', 'u')},
             {rerole('s0')}, {rerole('s1')}, {rerole('s3')}) AS s2,
       least({plus('s3', '4', 'D')}, {keep('s2', 'a')}, {rerole('s2')}) AS s3
FROM filled f JOIN faulty r ON r.conv_id = f.conv_id AND r.place = f.place + 1"""


def _sql_fill() -> str:
    step = ("lpad(CAST(CAST(substr({0}, 1, 8) AS BIGINT) + 3 AS VARCHAR), 8, '0') || substr({0}, 9) || 'I'")
    up = lambda s: f"CASE WHEN {s} = '~' THEN '~' ELSE {step.format(s)} END"
    return f"""
ends AS (
  SELECT conv_id, least(s0, s3, {up('v2')}) AS best FROM (
    SELECT d.*, least(s2, {up('s0')}, {up('s1')}, {up('s3')}) AS v2
    FROM dp d JOIN sizes z ON z.conv_id = d.conv_id AND z.n = d.place) e)"""


OP12_SQL = f"""
WITH RECURSIVE harmed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("(conv_id || ':' || turn)")} % 20 AS harm
  FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM harmed JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR harm = 3 WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM rows),
repeated AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS again FROM placed),
faulty AS (  -- fault 0 none, 1 truncated, 2 blank, 3 duplicate
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '{SPACE}') THEN 2 WHEN again > 1 THEN 3
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 1 ELSE 0 END AS fault,
         CASE WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS late,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS earlier
  FROM repeated),
sizes AS (
  SELECT h.conv_id, coalesce(max(place), 0) AS n FROM (SELECT DISTINCT conv_id FROM harmed) h
  LEFT JOIN placed p USING (conv_id) GROUP BY h.conv_id),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS place, '00000000' AS s0, '~' AS s1, '~' AS s2, '~' AS s3 FROM sizes
  UNION ALL
  (WITH states AS (SELECT * FROM dp),{_sql_dp()})),{_sql_fill()},
-- the result again from the audit: the i-th edit, the rows it has used, the roles so far
steps AS (
  SELECT conv_id, substr(best, 9) AS audit, unnest(range(1, length(best) - 7)) AS i FROM ends),
edits AS (
  SELECT conv_id, i, substr(audit, i, 1) AS edit,
         length(replace(substr(audit, 1, i), 'I', '')) AS place FROM steps),
kept AS (
  SELECT e.conv_id, e.i, edit, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, role, initial,
         sum(CASE WHEN edit = 'K' AND initial = 's' THEN 0 ELSE 1 END) OVER (
           PARTITION BY e.conv_id ORDER BY e.i) AS pair_place
  FROM edits e LEFT JOIN faulty r ON r.conv_id = e.conv_id AND r.place = e.place AND edit <> 'I'
  WHERE edit <> 'D'),
told AS (
  SELECT conv_id, string_agg((CASE WHEN edit = 'K' THEN role WHEN pair_place % 2 = 1 THEN 'user'
                                   ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY i) AS body
  FROM kept GROUP BY conv_id),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate,
         count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT z.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(substr(best, 1, 8) AS BIGINT) AS cost,
       substr(best, 9) AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM sizes z JOIN ends USING (conv_id) LEFT JOIN counts USING (conv_id) LEFT JOIN told USING (conv_id)
"""
