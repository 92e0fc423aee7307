"""Cheapest repair of conversation structure, with an audit trail.

A conversation's roles should read ``(s?(ua)+)?``: nothing, or pairs of user and assistant after at most one system row. Edits are
Delete (3, and forced for blank rows and repeats), Insert of an empty user or assistant row (2), Keep (0) and Rerole to user or
assistant (2); truncated rows that stay cost 1 more. The audit is the cheapest repair's letters in order, the least in ASCII
order among the cheapest ones.

A path's weight is one integer. Its high digits are the cost; ``BITS``-bit low digits hold the audit's letters, the first letter
highest, with zeros at the end. Integers then compare as (cost, audit). The graph runs backwards over rows; a node is a row and what
the roles so far allow next (``START`` .. ``CLOSED``), so the letters in front of a suffix shift its low digits by one place each.
The smallest integer at a node decides everything. More than two inserts in a row are never cheapest, nor is an insert before a
forced deletion less than one behind it, so neither has an edge.

Conversations of at most ``WHOLE_ROWS`` rows are sorted and repaired many to a task. Longer ones are numbered by a distributed sort and
cut into blocks of ``BLOCK_ROWS`` rows. Blocks give the costs between their border states (ordinary integers); one pass
from the last block to the first adds them up to the cost behind every border; each block then solves its own rows with those
costs as the weights of its end nodes, for every state it may begin in. That is exact: inserts belong to the row that follows, so
two different audits of a block differ inside it. A pass from the first block on picks the states, and only
the final hash, which a text's order forces, reads a long conversation's blocks one by one, without holding them.

Nulls: a null role or text counts as one space (such a text is blank); null turns come first and count for no gap; rows
without a conversation id are one conversation. Rows of one turn are ordered by role and text. Repeated rows are repeats of
the first. Rows that ``damage`` drops still give their conversation a row, with zeros if nothing else is left. Columns other than
conv_id, turn, role and text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alula.llm.common import written
from alula.operators.ordering import lookup, numbered, with_repeats

#: Rows of a conversation that one task repairs whole, and of a block of a longer one.
WHOLE_ROWS, BLOCK_ROWS = 4096, 1024
START, OPENED, ASKED, CLOSED = range(4)
STATES = (START, OPENED, ASKED, CLOSED)
#: State after a user or assistant row, whichever is next; the role it has.
FOLLOWS = (ASKED, ASKED, CLOSED, ASKED)
NEXT_ROLE = ("user", "user", "assistant", "user")
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
LETTERS = "\0DIKR"
COSTS = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
BITS = 3
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
WORD = re.compile(r"[^\x20\x09-\x0D]")
LONGEST = (1 << 63) - 1

Row = tuple[str, int]  # role initial, fault
Weight = int | None  # None: no way


def fault_of(text: str, repeated: bool) -> int:
    """A row's first fault."""
    kept = text.rstrip(" \t\n\x0b\x0c\r")
    if not kept:
        return BLANK
    return DUPLICATE if repeated else FINE if kept[-1] in ".!?" else TRUNCATED


def kept_state(state: int, initial: str) -> int | None:
    """State after a row that keeps its role, if it fits."""
    if initial == "s":
        return OPENED if state == START else None
    return FOLLOWS[state] if initial == NEXT_ROLE[state][0] else None


class Weights:
    """Arithmetic of path weights with room for a number of letters."""

    def __init__(self, letters: int):
        self.top = BITS * letters
        self.low = (1 << self.top) - 1

    def cost(self, cost: int | None) -> Weight:
        return None if cost is None else cost << self.top

    def before(self, letter: int, more: int, weight: Weight) -> Weight:
        """The weight with a letter in front."""
        if weight is None:
            return None
        low = weight & self.low
        return weight - low + ((COSTS[letter] + more) << self.top) + (letter << (self.top - BITS)) + (low >> BITS)

    def read(self, weight: int) -> tuple[int, str]:
        """Cost and audit."""
        low, out, at = weight & self.low, [], self.top - BITS
        while at >= 0 and (digit := low >> at & (1 << BITS) - 1):
            out.append(LETTERS[digit])
            at -= BITS
        return weight >> self.top, "".join(out)


def _least(weights: list[Weight]) -> Weight:
    return min((w for w in weights if w is not None), default=None)


def _inserting(plain: list[Weight], unit: Weights) -> list[Weight]:
    """Weights of nodes where up to two rows may be inserted first."""
    one = [_least([plain[s], unit.before(INSERT, 0, plain[FOLLOWS[s]])]) for s in STATES]
    return [_least([plain[s], unit.before(INSERT, 0, one[FOLLOWS[s]])]) for s in STATES]


def solve(rows: list[Row], ends: list[int | None], last: bool) -> tuple[Weights, list[Weight]]:
    """The least weight from every state before the rows, given the cost behind every state after them.

    ``last``: rows may be inserted behind the rows too."""
    unit = Weights(3 * len(rows) + 3)
    ahead = [unit.cost(c) for c in ends]
    if last:
        ahead = _inserting(ahead, unit)
    for initial, fault in reversed(rows):
        gone = [unit.before(DELETE, 0, w) for w in ahead]
        if fault in (BLANK, DUPLICATE):
            ahead = gone
            continue
        more = int(fault == TRUNCATED)
        plain = []
        for s in STATES:
            kept = kept_state(s, initial)
            plain.append(_least([gone[s], unit.before(REROLE, more, ahead[FOLLOWS[s]]), None if kept is None else unit.before(KEEP, more, ahead[kept])]))
        ahead = _inserting(plain, unit)
    return unit, ahead


def border_costs(rows: list[Row]) -> list[list[int | None]]:
    """Least cost from every state before the rows to every state after them."""
    out: list[list[int | None]] = [[None] * 4 for _ in STATES]
    for end in STATES:
        unit, found = solve(rows, [0 if s == end else None for s in STATES], False)
        for s in STATES:
            out[s][end] = None if found[s] is None else found[s] >> unit.top
    return out


def apply_audit(audit: str, rows: list[tuple[str, str]], state: int) -> tuple[list[str], int]:
    """The repaired ``role:text`` of rows (role, text), and the state behind them."""
    out, at = [], 0
    for letter in audit:
        if letter == "D":
            at += 1
            continue
        if letter == "I":
            out.append(f"{NEXT_ROLE[state]}:")
            state = FOLLOWS[state]
            continue
        role, text = rows[at]
        at += 1
        if letter == "R":
            role, state = NEXT_ROLE[state], FOLLOWS[state]
        else:
            state = kept_state(state, role[:1])
        out.append(f"{role}:{text}")
    return out, state


ENDS = [0, None, None, 0]


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def repair(rows: list[tuple[int | None, str, str]]) -> tuple[int, int, int, int, int, int, str, str]:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired text) of rows (turn, role, text) in order."""
    seen, narrow = set(), []
    counts = [0, 0, 0, 0]
    for _, role, text in rows:
        fault = fault_of(text, (role, text) in seen)
        seen.add((role, text))
        counts[fault] += 1
        narrow.append((role[:1], fault))
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(narrow, narrow[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = min(max(turns) - min(turns) + 1 - len(turns), LONGEST) if turns else 0
    unit, found = solve(narrow, ENDS, True)
    cost, audit = unit.read(found[START])
    repaired, _ = apply_audit(audit, [(r, t) for _, r, t in rows], START)
    return gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost, audit, "\n".join(repaired)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows of ``rows`` after damage that their ids and turns decide; ``gone`` marks
    dropped rows."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    code = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(code == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space))
    times = F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (code == 0).alias("gone"), F.explode(times).alias("copy")).drop("copy")


def _output(id_type: str, text: bool) -> str:
    return f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string" + ", repaired string" * text


_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "repaired"]
_TYPES = [None, *[pa.int64()] * 6, *[pa.string()] * 3]


def _whole(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        kind = None

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for batch in batches:
                kind = batch.column("conv_id").type
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")))

        def flushed() -> pa.RecordBatch:
            n = 9 + with_text
            arrays = [pa.array(v, t or kind) for v, t in zip(list(zip(*out))[:n], _TYPES)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, _NAMES[:n])

        for conv_id, members in groupby(rows(), key=lambda r: r[0]):
            *numbers, audit, text = repair([r[1:4] for r in members if not r[4]])
            out.append((conv_id, *numbers, audit, hashlib.sha256(_bytes(text)).hexdigest(), text))
            if len(out) >= 1024:
                yield flushed()
        if out:
            yield flushed()

    return run


# --- long conversations ------------------------------------------------------------------------

_PAIR = "struct<state:int,after:int,audit:string,cost:long>"


def _block_costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        costs = []
        for initials, faults in zip(batch.column("initials").to_pylist(), batch.column("faults").to_pylist()):
            costs.append([c for line in border_costs(list(zip(initials, faults))) for c in line])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(costs, pa.list_(pa.int64()))], ["conv", "block", "costs"])


def _behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind every block's end, from blocks that come in descending order."""
    current, ahead, last = object(), ENDS, True
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for conv, block, costs in zip(*(batch.column(c).to_pylist() for c in ("conv", "block", "costs"))):
            if conv != current:
                # rows may be inserted behind the last row
                unit, behind = solve([], ENDS, True)
                current, ahead, last = conv, [None if w is None else w >> unit.top for w in behind], True
            for column, value in zip(out, (conv, block, ENDS if last else ahead, last)):
                column.append(value)
            table = [costs[4 * s : 4 * s + 4] for s in STATES]
            ahead = [_least([c + a for c, a in zip(line, ahead) if c is not None and a is not None]) for line in table]
            last = False
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_()))], ["conv", "block", "ends", "last"])


def _block_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit, cost and state behind the block, for every state before it."""
    for batch in batches:
        ways = []
        for initials, faults, ends, last in zip(*(batch.column(c).to_pylist() for c in ("initials", "faults", "ends", "last"))):
            unit, found = solve(list(zip(initials, faults)), ends, last)
            own = []
            for s in STATES:
                if found[s] is not None:
                    cost, audit = unit.read(found[s])
                    own.append({"state": s, "after": apply_audit(audit, [(i, "") for i in initials], s)[1], "audit": audit, "cost": cost})
            ways.append(own)
        kind = pa.list_(pa.struct([("state", pa.int32()), ("after", pa.int32()), ("audit", pa.string()), ("cost", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(ways, kind)], ["conv", "block", "ways"])


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before every block, from blocks in ascending order with the state behind each for each before it."""
    current, state, audit = object(), START, None
    for batch in batches:
        out: list[list] = [[], [], []]
        for conv, block, states, after in zip(*(batch.column(c).to_pylist() for c in ("conv", "block", "states", "after"))):
            if conv != current:
                current, state = conv, START
            for column, value in zip(out, (conv, block, state)):
                column.append(value)
            state = after[states.index(state)]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.string(), pa.int64(), pa.int32()))], ["conv", "block", "entry"])


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for rows, audit, entry in zip(*(batch.column(c).to_pylist() for c in ("rows", "audit", "entry"))):
            done, _ = apply_audit(audit, [(r["role"], r["text"]) for r in rows], entry)
            texts.append("\n".join(done) if done else None)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), batch.column("audit"), pa.array(texts, pa.string())], ["conv", "block", "audit", "text"])


def _hashed(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hash and audit of conversations whose blocks come in order. Texts are held on request only."""

        def blocks() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    yield tuple(batch.column(c)[i].as_py() for c in ("conv", "audit", "text"))

        for conv, members in groupby(blocks(), key=lambda r: r[0]):
            digest, audits, texts, any_text = hashlib.sha256(), [], [], False
            for _, audit, text in members:
                audits.append(audit)
                if text is not None:
                    digest.update(_bytes("\n" * any_text + text))
                    any_text = True
                    if with_text:
                        texts.append(text)
            values = [conv, "".join(audits), digest.hexdigest(), "\n".join(texts)][: 3 + with_text]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in values], ["conv", "audit", "repaired_sha256", "repaired"][: 3 + with_text])

    return run


def _conv_text(column: Column) -> Column:
    """A conversation id as text, with null apart from every id."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def _long_conversations(rows: DataFrame, with_text: bool) -> DataFrame:
    """Repairs of conversations too long for one task, from damaged rows."""
    present = written(rows.where(~F.col("gone")).select(
        _conv_text(F.col("conv_id")).alias("conv"), "turn", "role", "text", F.col("turn").isNotNull().cast("int").alias("has_turn"), F.coalesce("turn", F.lit(0)).alias("turn_or_0"),
        F.monotonically_increasing_id().alias("tie"),
    ), "long-conversations")
    order = ["has_turn", "turn_or_0", "role", "text", "tie"]
    same = with_repeats(present.withColumn("hash", F.sha2("text", 256)), ["conv", "role", "hash"], ["has_turn", "turn_or_0", "tie"], out="repeated").drop("hash")
    word = r"[^\x20\x09-\x0D]"
    fault = F.when(~F.col("text").rlike(word), BLANK).when(F.col("repeated"), DUPLICATE).when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), FINE).otherwise(TRUNCATED)
    placed = numbered(same.withColumn("fault", fault), ["conv"], order, "place")
    members = F.struct("place", F.substring("role", 1, 1).alias("initial"), "fault", "role", "text")
    blocks = placed.groupBy("conv", F.floor((F.col("place") - 1) / BLOCK_ROWS).cast("long").alias("block")).agg(F.array_sort(F.collect_list(members)).alias("rows"))
    blocks = written(blocks.select("conv", "block", F.col("rows.initial").alias("initials"), F.col("rows.fault").alias("faults"), F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("rows")), "conversation-blocks")
    narrow = blocks.select("conv", "block", "initials", "faults")

    def in_order(df: DataFrame, block: Column) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", block)

    costs = narrow.mapInArrow(_block_costs, "conv string, block long, costs array<long>")
    ends = written(in_order(costs, F.desc("block")).mapInArrow(_behind, "conv string, block long, ends array<long>, last boolean"), "conversation-ends")
    ways = written(narrow.join(ends, ["conv", "block"]).mapInArrow(_block_ways, f"conv string, block long, ways array<{_PAIR}>"), "conversation-ways")
    states = ways.select("conv", "block", F.col("ways.state").alias("states"), F.col("ways.after").alias("after"))
    entries = written(in_order(states, F.asc("block")).mapInArrow(_chosen, "conv string, block long, entry int"), "conversation-entries")
    way = F.filter("ways", lambda w: w["state"] == F.col("entry"))[0]
    audits = ways.join(entries, ["conv", "block"]).select("conv", "block", "entry", way["audit"].alias("audit"), way["cost"].alias("cost"))
    texts = blocks.select("conv", "block", "rows").join(audits, ["conv", "block"]).mapInArrow(_block_texts, "conv string, block long, audit string, text string")
    hashed = in_order(texts, F.asc("block")).mapInArrow(_hashed(with_text), "conv string, audit string, repaired_sha256 string" + ", repaired string" * with_text)

    turns = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = placed.groupBy("conv").agg(
        F.coalesce(F.least(turns, F.lit(LONGEST)).cast("long"), F.lit(0).cast("long")).alias("gaps"),
        *[F.count(F.when(F.col("fault") == k, 1)).alias(n) for k, n in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))],
    )
    bad = F.expr("size(filter(sequence(1, greatest(size(initials) - 1, 1)), i -> i < size(initials) and concat(initials[i - 1], initials[i]) not in ('su', 'ua', 'au')))")
    edges = narrow.select("conv", "block", bad.alias("inside"), F.element_at("initials", 1).alias("first"), F.element_at("initials", -1).alias("before"))
    previous = edges.select("conv", (F.col("block") + 1).alias("block"), "before")
    across = edges.drop("before").join(previous, ["conv", "block"], "left")
    borders = across.groupBy("conv").agg(F.sum(F.col("inside") + F.coalesce((~F.concat("before", "first").isin("su", "ua", "au")).cast("int"), F.lit(0))).cast("long").alias("illegal"))
    paid = audits.where("block = 0").select("conv", "cost")  # the cost behind a block counts in its weight

    named = rows.select("conv_id").distinct().withColumn("conv", _conv_text(F.col("conv_id")))
    out = named
    for part in (counts, borders, paid, hashed):
        out = out.join(part, "conv", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.lit(hashlib.sha256().hexdigest())
    texts_out = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")]
    return out.select("conv_id", *zero, *texts_out, *([F.coalesce("repaired", F.lit("")).alias("repaired")] if with_text else []))


def repair_conversations(damaged: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per conv_id of ``damaged`` (see ``damage``): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256,
    and on request the ``repaired`` text."""
    rows = damaged.select("conv_id", "turn", "role", "text", "gone")
    schema = _output(rows.schema["conv_id"].dataType.simpleString(), with_text)
    large = written(rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > WHOLE_ROWS).select("conv_id", F.lit(True).alias("large")), "long-ids")
    if large.isEmpty():
        ordinary, parts = rows, []
    else:
        marked = lookup(rows, large, ["conv_id"])
        ordinary = marked.where("large is null").drop("large")
        parts = [_long_conversations(marked.where("large").drop("large"), with_text)]
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    whole = ordinary.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_whole(with_text), schema)
    for part in parts:
        whole = whole.unionByName(part)
    return whole
