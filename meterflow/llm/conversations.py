"""Conversation structure repair: conversations streamed in turn order, their cheapest edits found by dynamic programming."""
from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .store import step

SPACES = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"
SALTS = 16
SPILL_BYTES = 4 << 20

RETYPE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

# States of what has been written: nothing, a system row, a user row last, an assistant row last. A row of
# the other two roles may follow in one way only, so the initials of the edits fix the roles.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Edits that take one row, in the order of their initials; an insert comes right before the row that needs it.
SEGMENTS = ["D", "IK", "IR", "K", "R"]
_CODE = {s: i for i, s in enumerate(SEGMENTS)}
_LEGAL = {"su", "ua", "au"}


def _moves(initial: str) -> list[tuple[int, int, int, int]]:
    """(state before, state after, segment, cost) of the edits that keep or retype a row. Retyping what may be kept, or inserting two
    rows before one, leads to a state that costs less otherwise."""
    found = []
    for before in range(4):
        wanted, other = ("a", "u") if before == USER else ("u", "a")
        after = {"u": USER, "a": ASSISTANT}
        if before == EMPTY and initial == "s":
            found.append((before, SYSTEM, _CODE["K"], 0))
        found.append((before, after[wanted], *((_CODE["K"], 0) if initial == wanted else (_CODE["R"], RETYPE))))
        found.append((before, after[other], *((_CODE["IK"], INSERT) if initial == other else (_CODE["IR"], INSERT + RETYPE))))
    return found


MOVES = {initial: _moves(initial) for initial in ("s", "u", "a", "")}


class Backpointers:
    """For every row and state the state before and the segment, a byte each; past ``SPILL_BYTES`` they go to a scratch file of
    the task, which is gone with it (a task that runs again writes its own)."""

    def __init__(self, limit: int = SPILL_BYTES):
        self.limit, self.held, self.file, self.spilled = limit, bytearray(), None, 0

    def add(self, entry: bytes) -> None:
        self.held += entry
        if len(self.held) >= self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.write(self.held)
            self.spilled += len(self.held)
            self.held.clear()

    def backwards(self) -> Iterator[bytes]:
        """The entries of all rows, the last first."""
        part = bytes(self.held)
        at = self.spilled
        while True:
            for end in range(len(part), 0, -4):
                yield part[end - 4:end]
            if not at:
                break
            size = min(self.limit - self.limit % 4, at)
            at -= size
            self.file.seek(at)
            part = self.file.read(size)
        if self.file:
            self.file.close()


class Conversation:
    """What is carried along one conversation: counters, and per state the cost, the rank among the best edits so far and the hash
    of the repaired rows. Its size does not depend on the number of rows but for the backpointers.

    The best edits of two states differ at some initial (equal initials lead to one state), so their
    order stays what it is however they go on, and a rank is enough to settle ties.
    """

    def __init__(self, limit: int = SPILL_BYTES):
        self.cost, self.rank = [0, None, None, None], [0, 0, 0, 0]
        self.hash = [hashlib.sha256(), None, None, None]
        self.back = Backpointers(limit)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.previous = self.last = None

    def row(self, turn: int | None, role: str, text: str, blank: bool, seen: bool, truncated: bool) -> None:
        initial = role[:1]
        if self.previous is not None:
            self.illegal += self.previous[1][:1] + initial not in _LEGAL
            seen = seen or (turn, role, text) == self.previous
        self.previous = (turn, role, text)
        if turn is not None and turn != self.last:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        if blank or seen:
            self.blank += blank
            self.duplicate += not blank
            self.cost = [c if c is None else c + DELETE for c in self.cost]
            self.back.add(_DELETED)
            return
        self.truncated += truncated
        cost, rank = self.cost, self.rank
        best: list = [None if c is None else (c + DELETE, r, 0, s) for s, (c, r) in enumerate(zip(cost, rank))]
        extra = UNFINISHED if truncated else 0
        for before, after, segment, price in MOVES[initial if initial in MOVES else ""]:
            if cost[before] is not None:
                option = (cost[before] + price + extra, rank[before], segment, before)
                if best[after] is None or option < best[after]:
                    best[after] = option
        order = sorted((s for s in range(4) if best[s] is not None), key=lambda s: best[s][1:3])
        hashes, body = list(self.hash), text.encode("utf-8", "replace")
        for state in order:
            self.cost[state] = best[state][0]
            _, _, segment, before = best[state]
            if segment:
                new = hashes[before].copy()
                new.update(_lines(before, state, SEGMENTS[segment], role) + body)
                self.hash[state] = new
        self.rank = [order.index(s) if s in order else 0 for s in range(4)]
        self.back.add(bytes(0 if b is None else b[2] << 2 | b[3] for b in best))

    def end(self) -> tuple:
        """Counts, cost, audit and hash."""
        tails = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
        cost, _, _, state = min((self.cost[s] + INSERT * len(t), self.rank[s], t, s) for s, t in tails.items() if self.cost[s] is not None)
        final, audit = self.hash[state], bytearray(tails[state].encode())
        final.update({"": b"", "I": b"\nassistant:", "II": b"\nuser:\nassistant:"}[tails[state]])
        for entry in self.back.backwards():
            segment, state = entry[state] >> 2, entry[state] & 3
            audit += SEGMENTS[segment][::-1].encode()
        audit.reverse()
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit.decode(), final.hexdigest()


_DELETED = bytes(range(4))


def _lines(before: int, after: int, segment: str, role: str) -> bytes:
    """What an edit writes before a row's text."""
    own = role if segment[-1] == "K" else "user" if after == USER else "assistant"
    start = "" if before == EMPTY else "\n"
    inserted = "" if segment[0] != "I" else "assistant:\n" if before == USER else "user:\n"
    return f"{start}{inserted}{own}:".encode("utf-8", "replace")


COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in the order of (conversation, turn, role, text), whatever batches they come in, to one row per conversation."""
    names = ["conv", *[c.split()[0] for c in COLUMNS.split(", ")]]
    name, state, done = None, None, []
    for batch in batches:
        for conv, there, known, turn, role, text, blank, seen, truncated in zip(*(batch[c].tolist() for c in _SENT)):
            if state is None or conv != name:
                if state is not None:
                    done.append((name, *state.end()))
                name, state = conv, Conversation()
            if there:
                state.row(turn if known else None, role, text, blank, seen, truncated)
        if done:
            yield pd.DataFrame(done, columns=names)
            done = []
    if state is not None:
        yield pd.DataFrame([(name, *state.end())], columns=names)


_SENT = ["conv", "there", "known", "turn", "role", "text", "blank", "seen", "truncated"]


def repair(rows: DataFrame, there: str | None = None, id_column: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Faults of every conversation and the cheapest edits that make its roles ``(s?(ua)+)?``.

    Rows are taken by turn (nulls first), at one turn by role and text. Blank rows and rows whose role and text were there before must go;
    others may be kept, retyped to user or assistant, or deleted, and rows without text inserted. One row per id (null is an id):
    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``. A null role or text is one
    space. Rows where the column ``there`` is false only say that their conversation exists; one without rows has zeros, an empty audit and the hash
    of nothing. Further columns are not read.

    The first of equal rows is found by an aggregate over hashes, combined before its shuffle; only repeated ones are joined back,
    salted, so that a row repeated throughout a hot conversation is split. Rows are then dealt by conversation, sorted,
    and streamed: a conversation of any length needs the same memory, its backpointers are spilled at 4 bytes a row. Its audit is one value.
    """
    blank_text = lambda c: F.btrim(c, F.lit(SPACES))
    own = rows.select(F.col(id_column).cast("string").alias("conv"), (F.col(there) if there else F.lit(True)).alias("there"),
                      F.col(turn).isNotNull().alias("known"), F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("turn"),
                      F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    own = own.withColumns({"h": F.xxhash64("role", "text"), "blank": blank_text(F.col("text")) == "",
                           "truncated": ~F.right(blank_text(F.col("text")), F.lit(1)).isin(*ENDINGS)})
    place = F.struct("known", "turn")
    again = own.where("there and not blank").groupBy("conv", "h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = step(again.select(F.col("conv").alias("_conv"), F.col("h").alias("_h"), "first"), "again")
    salted = again.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("known", "turn"), F.lit(SALTS)).cast("int")
    marked = own.withColumn("salt", salt).join(salted, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("h") == F.col("_h")) & (F.col("salt") == F.col("_salt")), "left")
    marked = marked.withColumn("seen", F.coalesce(place > F.col("first"), F.lit(False)))
    # The shuffle may merge conversations into one task, never a conversation into two.
    ordered = marked.select(*_SENT).repartition("conv").sortWithinPartitions("conv", "known", "turn", "role", "text")
    found = ordered.mapInPandas(_stream, f"conv string, {COLUMNS}")
    kind = rows.schema[id_column].dataType
    return found.select(F.col("conv").cast(kind).alias(id_column), *[c.split()[0] for c in COLUMNS.split(", ")])


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults put in by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space): 0 leaves a row out (``there`` is
    false), 1 empties its text, 2 takes its ``[.!?]`` out, 3 repeats it, 4 makes its role user."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    own = rows.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), fault.alias("fault"))
    own = own.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    text: Column = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ENDINGS, "")).otherwise(F.col("text"))
    return own.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") != 0).alias("there"))


def op13_streamed_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation after damage: faults, cheapest edits and the hash of what they give."""
    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "there")


def _sql_moves() -> str:
    moves = [(i, b, a, SEGMENTS[s], c) for i, found in MOVES.items() for b, a, s, c in found]
    return ", ".join(f"('{i}', {b}, {a}, '{s}', {c})" for i, b, a, s, c in moves)


ORACLE = f"""
with recursive
tab as (select list(v order by i) as tab from (select i, list_reduce(range(8), lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as v
                                               from (select unnest(range(256)) as i))),
keyed as (select *, row_number() over () as r, concat(coalesce(conv_id::varchar, ' '), ':', coalesce(turn::varchar, ' ')) as k from conversations),
coded as (select k.* exclude (k), xor(list_reduce(list_transform(string_split(k, ''), lambda c: ascii(c)::bigint),
              lambda a, b: xor(a >> 8, tab[xor(a, b) % 256 + 1]), 4294967295), 4294967295) % 20 as f from keyed k, tab),
damaged as (select r, conv_id, turn, case when f = 4 then 'user' else coalesce(role, ' ') end as role, case f when 1 then '' when 2 then regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
              else coalesce(text, ' ') end as text, unnest(case when f = 3 then [1, 2] else [1] end) as copy from coded where f > 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, r, copy) as i,
                  row_number() over (partition by conv_id, role, text order by turn nulls first, r, copy) > 1 as seen,
                  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from damaged),
faults as (select *, body = '' as blank, body <> '' and seen as dup, body <> '' and not seen and right(body, 1) not in ('.', '!', '?') as cut,
                  left(lag(role) over (partition by conv_id order by i), 1) || left(role, 1) not in ('su', 'ua', 'au') as odd from placed),
counts as (select conv_id, (case when count(turn) = 0 then 0 else max(turn) - min(turn) + 1 - count(distinct turn) end)::bigint as gaps, count(*) filter (blank) as blank,
                  count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated, count(*) filter (odd) as illegal, max(i) as n from faults group by conv_id),
moves(initial, a, b, seg, price) as (values {_sql_moves()}),
paths as (select conv_id, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit, [] :: varchar[] as lines from counts
    union all
    select conv_id, i, state, cost, audit, lines from (
        select p.conv_id, f.i, o.state, p.cost + o.cost as cost, p.audit || o.seg as audit, p.lines || o.lines as lines,
               row_number() over (partition by p.conv_id, o.state order by p.cost + o.cost, p.audit || o.seg) as best
        from paths p join faults f on f.conv_id is not distinct from p.conv_id and f.i = p.i + 1,
             lateral (select p.state as state, {DELETE} as cost, 'D' as seg, [] :: varchar[] as lines
                      union all select m.b, m.price + case when f.cut then {UNFINISHED} else 0 end, m.seg,
                          case when m.seg[1] = 'I' then [case when m.a = {USER} then 'assistant:' else 'user:' end] else [] end
                          || [case when right(m.seg, 1) = 'K' then f.role when m.b = {USER} then 'user' else 'assistant' end || ':' || f.text]
                      from moves m where m.a = p.state and m.initial = case when left(f.role, 1) in ('s', 'u', 'a') then left(f.role, 1) else '' end
                           and not f.blank and not f.dup) o)
    where best = 1),
ends as (select conv_id, cost + [0, {2 * INSERT}, {INSERT}, 0][state + 1] as cost, audit || ['', 'II', 'I', ''][state + 1] as audit,
                lines || case state when {SYSTEM} then ['user:', 'assistant:'] when {USER} then ['assistant:'] else [] end as lines
         from (select p.* from paths p join counts c on c.conv_id is not distinct from p.conv_id and c.n = p.i)
         qualify row_number() over (partition by conv_id order by cost + [0, {2 * INSERT}, {INSERT}, 0][state + 1], audit || ['', 'II', 'I', ''][state + 1]) = 1)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
       coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id left join ends e on e.conv_id is not distinct from o.conv_id"""
