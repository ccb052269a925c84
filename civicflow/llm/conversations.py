"""Conversation structure repair by secondary-sorted streaming (operator 12).

Rows are dealt to partitions by conversation and sorted by turn within them.
``mapInPandas`` walks the sorted rows once; its state, a dynamic programme over
the four states of the role grammar ``(s?(ua)+)?``, is carried across Arrow
batches, so a conversation may be longer than any batch. Per row and state the
programme leaves one byte of back pointer, which is spilled to a file of the
task once a conversation has many rows, and read backwards at its end.

After each row the cheapest edits of a state end in a letter for that row, so
among equally cheap ones none is the beginning of another, and an order of four
ranks is all that is needed to prefer the least letters. Each state also keeps
a running SHA-256 of its repaired lines, so no text is kept.
"""

from __future__ import annotations

import hashlib
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

#: What a null role, text or part of a damage key counts as.
NULL = " "
BLANKS = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT for a truncated row that stays
#: Rows of a conversation whose back pointers (4 bytes each) stay in memory.
SPILL_ROWS = 1 << 20

# States of the grammar: nothing yet, after s, after u, after a. A conversation may end in 0 or 3.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_WANTS = ("u", "u", "a", "u")  # the role that an insertion or a new role puts after each state
_ROLE = {"u": "user", "a": "assistant"}
_FINAL = (0, 3)


# ---------------------------------------------------------------- damage and faults, as columns

def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text and gone of every row after the damage that its CRC-32 decides.

    Dropped rows stay, with ``gone`` and without role and text, so that their
    conversation is still known; a repeated row comes twice. Nulls of role and
    text, and of the key's parts, count as one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in (conv, turn)))
    x = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(NULL)).alias("role"),
                    F.coalesce(F.col(text), F.lit(NULL)).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    x = x.select("conv", "turn", (fate == 0).alias("gone"),
                 F.when(fate == 0, "").when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
                 F.when(fate.isin(0, 1), "").when(fate == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                 F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return x.drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, gone, role, text) with ``fault``: 0 none, 1 blank, 2 duplicate, 3 truncated; the first that fits.

    Equal rows of a conversation are told apart by their turn order, within one
    deal of the rows by conversation: the window needs no shuffle of its own and
    its groups spill.
    """
    again = F.row_number().over(Window.partitionBy("conv", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(F.col("gone"), 0).when(end == "", 1).when(again, 2).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    return rows.select("conv", "turn", "gone", "role", "text", fault.cast("byte").alias("fault"))


# ---------------------------------------------------------------- the programme

def _steps(costs: tuple, ranks: tuple, initial: str, fault: int) -> tuple[tuple, tuple, tuple]:
    """Costs, ranks and moves (from state, insertions, letter) of the four states after a row."""
    best: list = [None] * 4
    for p, cost in enumerate(costs):
        if cost is None:
            continue
        q, price = p, cost
        for inserted in range(3):
            if inserted:
                q, price = _AFTER[q, _WANTS[q]], price + INSERT
            moves = [("D", q, DELETE)]
            if fault not in (1, 2):
                stays = CUT if fault == 3 else 0
                moves.append(("R", _AFTER[q, _WANTS[q]], REROLE + stays))
                if (q, initial) in _AFTER:
                    moves.append(("K", _AFTER[q, initial], KEEP + stays))
            for letter, to, extra in moves:
                candidate = (price + extra, ranks[p], "I" * inserted + letter, p, inserted)
                if best[to] is None or candidate[:3] < best[to][:3]:
                    best[to] = candidate
    order = sorted((b[1:3], q) for q, b in enumerate(best) if b)
    place = {q: i for i, (_, q) in enumerate(order)}
    return (tuple(b and b[0] for b in best), tuple(place.get(q, 0) for q in range(4)),
            tuple(b and (b[3], b[4], b[2][-1]) for b in best))


_LETTERS = "DKR"


def _pack(move: tuple | None) -> int:
    return 0 if move is None else move[0] | move[1] << 2 | _LETTERS.index(move[2]) << 4


def _unpack(byte: int) -> tuple[int, int, str]:
    return byte & 3, byte >> 2 & 3, _LETTERS[byte >> 4]


class Trail:
    """Back pointers of a conversation, four bytes a row; blocks of ``spill_rows`` rows go to a file of the task."""

    def __init__(self, spill_rows: int = SPILL_ROWS):
        self.size, self.tail, self.blocks, self.file = 4 * spill_rows, bytearray(), 0, None

    def add(self, four: bytes) -> None:
        self.tail += four
        if len(self.tail) >= self.size:
            self.file = self.file or tempfile.TemporaryFile()  # unnamed: gone with the task, however it ends
            self.file.write(self.tail)
            self.blocks += 1
            self.tail = bytearray()

    def backwards(self):
        """The rows' four bytes, last row first, and the file closed."""
        for k in range(self.blocks, -1, -1):
            if k < self.blocks:
                self.file.seek(k * self.size)
                self.tail = self.file.read(self.size)
            for i in range(len(self.tail) - 4, -1, -4):
                yield self.tail[i:i + 4]
        if self.file:
            self.file.close()


class Repair:
    """One conversation: rows are added in order, then ``result`` gives the cheapest edits."""

    #: (relative costs, ranks, role initial, fault) -> (relative costs, ranks, moves, bytes, least cost)
    _known: dict = {}

    def __init__(self, spill_rows: int = SPILL_ROWS):
        self.base, self.costs, self.ranks = 0, (0, None, None, None), (0, 0, 0, 0)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.wrote = [False] * 4
        self.trail = Trail(spill_rows)
        self.counts = [0, 0, 0, 0]
        self.illegal, self.last, self.first_turn, self.last_turn, self.turns = 0, None, None, None, 0

    def add(self, turn, role: str, text: str, fault: int) -> None:
        self.counts[fault] += 1
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            if turn != self.last_turn:
                self.turns += 1
            self.last_turn = turn
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        at = (self.costs, self.ranks, initial if initial in ("s", "u", "a") else "", fault)
        known = self._known.get(at)
        if known is None:
            costs, ranks, moves = _steps(*at)
            low = min(c for c in costs if c is not None)
            known = tuple(c if c is None else c - low for c in costs), ranks, moves, bytes(map(_pack, moves)), low
            if len(self._known) < 100_000:
                self._known[at] = known
        self.costs, self.ranks, moves, four, low = known
        self.base += low
        self.trail.add(four)
        hashes, wrote = [None] * 4, [False] * 4
        for q, move in enumerate(moves):
            if move is not None:
                p, inserted, letter = move
                h, some = self.hashes[p], self.wrote[p]
                if inserted or letter != "D" or q != p:
                    h = h.copy()
                s = p
                for _ in range(inserted):
                    some, s = self._line(h, some, _ROLE[_WANTS[s]], ""), _AFTER[s, _WANTS[s]]
                if letter != "D":
                    some = self._line(h, some, role if letter == "K" else _ROLE[_WANTS[s]], text)
                hashes[q], wrote[q] = h, some
        self.hashes, self.wrote = hashes, wrote

    @staticmethod
    def _line(h, some: bool, role: str, text: str) -> bool:
        h.update(f"\n{role}:{text}".encode() if some else f"{role}:{text}".encode())
        return True

    def result(self) -> tuple:
        """gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        ends = []
        for p, cost in enumerate(self.costs):
            if cost is not None:
                q, inserted = p, 0
                while q not in _FINAL:
                    q, inserted = _AFTER[q, _WANTS[q]], inserted + 1
                ends.append((cost + INSERT * inserted, self.ranks[p], inserted, p))
        cost, _, inserted, q = min(ends)
        h, some, s = self.hashes[q].copy(), self.wrote[q], q
        for _ in range(inserted):
            some, s = self._line(h, some, _ROLE[_WANTS[s]], ""), _AFTER[s, _WANTS[s]]
        letters = bytearray(b"I" * inserted)
        for four in self.trail.backwards():
            q, before, letter = _unpack(four[q])
            letters += letter.encode() + b"I" * before
        letters.reverse()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        return gaps, *self.counts[1:], self.illegal, self.base + cost, letters.decode(), h.hexdigest()


RESULT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def walk(batches, spill_rows: int = SPILL_ROWS):
    """Results of conversations whose rows (conv, turn, gone, role, text, fault) come together, in order of turn."""
    key, current = None, None
    for pdf in batches:
        done = []
        columns = [pdf[c].astype(object).where(pdf[c].notna(), None).tolist() for c in ("conv", "turn")]
        columns += [pdf[c].tolist() for c in ("gone", "role", "text", "fault")]
        for conv, turn, gone, role, text, fault in zip(*columns, strict=True):
            if current is None or (conv,) != key:
                if current is not None:
                    done.append((*key, *current.result()))
                key, current = (conv,), Repair(spill_rows)
            if not gone:
                current.add(None if turn is None else int(turn), role, text, fault)
        yield pd.DataFrame(done, columns=["conv", *RESULT])
    if current is not None:
        yield pd.DataFrame([(*key, *current.result())], columns=["conv", *RESULT])


def repair(rows: DataFrame, conv: str = "conv_id", spill_rows: int = SPILL_ROWS) -> DataFrame:
    """Fault counts, cost, audit and repaired_sha256 of every conversation of damaged rows (conv, turn, gone, role, text).

    A null conversation id is one conversation. Rows of one turn go by role and
    text, null turns first. A conversation all of whose rows are gone has zero
    counts, an empty audit and the hash of the empty text. One row per
    conversation; no rows give none. Only texts of one Arrow batch are held at a
    time; a conversation of any length stays in one task, as its rows form one
    sequence, and takes four bytes a row besides its audit.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    ordered = faults(rows.repartition("conv")).sortWithinPartitions(
        "conv", F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == 2)
    turn = F.col("turn").cast("string").alias("turn")  # a long column with nulls would become floating point in pandas
    key = F.col("conv") if kind == "string" else F.col("conv").cast("string").alias("conv")
    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    out = ordered.select(key, turn, "gone", "role", "text", "fault").mapInPandas(lambda it: walk(it, spill_rows), schema)
    return out.select(F.col("conv").cast(kind).alias(conv), *RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    """Contract columns of operator 12 over all conversations."""
    return repair(damage(table(spark, sf_dir, "conversations")))


#: Damage, faults and the programme as layers of strings: per conversation, row and state the least (cost, audit).
SQL = """
with recursive
crc as (
  select list(v order by i) as t from (
    select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v
    from range(256) r(i))),
keyed as (
  select conv_id as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
fated as (
  select conv, turn, role, text,
         xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::bigint)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as fate
  from keyed, crc),
damaged as (
  select conv, turn, case when fate = 4 then 'user' else role end as role,
         case fate when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case when fate = 3 then [1, 2] else [1] end) as copy
  from fated where fate <> 0),
judged as (
  select *, case when not regexp_matches(text, '[^\\x20\\x09-\\x0D]') then 1
                 when row_number() over (partition by conv, role, text order by turn nulls first) > 1 then 2
                 when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 3 else 0 end as fault from damaged),
numbered as (
  select *, left(role, 1) as x, row_number() over (partition by conv order by turn nulls first, role, text, fault = 2) as i from judged),
step(p, x, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
fill(p, q, role) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
ins(p, q, letters, lines, price) as (
  select p, p, '', '', 0 from fill
  union all select p, q, 'I', role || ':' || chr(10), 5 from fill
  union all select a.p, b.q, 'II', a.role || ':' || chr(10) || b.role || ':' || chr(10), 10 from fill a join fill b on b.p = a.q),
dp(conv, i, q, cost, audit, repaired) as (
  select distinct conv_id, 0::bigint, 0, 0::bigint, '', '' from conversations
  union all
  select conv, i, q, cost, audit, repaired from (
    select conv, i, q, cost, audit, repaired, row_number() over (partition by conv, q order by cost, audit) as best from (
      select d.conv, r.i, e.q, d.cost + n.price + e.price as cost, d.audit || n.letters || e.letter as audit,
             d.repaired || n.lines || e.line as repaired
      from dp d join numbered r on r.conv is not distinct from d.conv and r.i = d.i + 1
      join ins n on n.p = d.q,
      lateral (
        select n.q as q, 'D' as letter, 2 as price, '' as line
        union all select f.q, 'R', 1 + case when r.fault = 3 then 5 else 0 end, f.role || ':' || r.text || chr(10)
          from fill f where f.p = n.q and r.fault not in (1, 2)
        union all select s.q, 'K', case when r.fault = 3 then 5 else 0 end, r.role || ':' || r.text || chr(10)
          from step s where s.p = n.q and s.x = r.x and r.fault not in (1, 2)) e)) where best = 1),
size as (select k.conv, count(n.i) as n from (select distinct conv_id as conv from conversations) k
         left join numbered n on n.conv is not distinct from k.conv group by k.conv),
ended as (
  select d.conv, arg_min({'cost': d.cost + n.price, 'audit': d.audit || n.letters, 'repaired': d.repaired || n.lines},
                         (d.cost + n.price, d.audit || n.letters)) as e
  from dp d join size z on z.conv is not distinct from d.conv and z.n = d.i join ins n on n.p = d.q and n.q in (0, 3) group by d.conv),
pairs as (select conv, x, lag(x) over (partition by conv order by i) as before, i, fault, turn from numbered),
counted as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
         count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
         count(*) filter (i > 1 and before || x not in ('su', 'ua', 'au')) as illegal
  from pairs group by conv)
select e.conv as conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
       coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, e.e.cost::bigint as cost, e.e.audit as audit,
       sha256(substring(e.e.repaired, 1, greatest(length(e.e.repaired) - 1, 0))) as repaired_sha256
from ended e left join counted c on c.conv is not distinct from e.conv
"""
