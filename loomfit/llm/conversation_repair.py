"""Repair of conversation structure over a suffix-shared automaton.

A conversation is a word of signatures, one per turn: who speaks, and whether the turn must go or breaks off.
Words are minimised from their ends: words that end alike share the nodes of that end, across all
conversations. A node knows for each state of the grammar ``(s?(ua)+)?`` what the rest of the word costs to
repair and the best edits for it, both computed once per node and state. All distinct words are sorted by
their reversal, so a task meets the words of a shared end one after another and keeps only the nodes of the
current word.

The edits of a turn have different letters, so among cheapest repairs the first letter decides the
ASCII-least one, and a node needs only its own edit and the next node. Conversations of more than BLOCK_TURNS turns are
cut into blocks: a block's costs between all states give the cost-to-go at the end of the block before it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_ranges, keep, query, read

BLOCK_TURNS = 1024
OUT_BYTES = 4 * 1024 * 1024  # of results handed on at once
DELETE, INSERT, REROLE, BROKEN_OFF = 2, 5, 1, 5  # costs; keeping a turn costs nothing
BLANKS = " \t\n\x0b\x0c\r"
NEVER = 10**9
# Grammar states: nothing yet, after system, after user, after assistant. The next user or assistant leads to:
FORCED = (2, 2, 3, 2)
KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ROLE = {2: "user", 3: "assistant"}
# Cost-to-go and edits where a conversation ends. Insertions complete the last pair.
AT_END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
END = "0,10,5,0;end"


class Node:
    """What is left of a word: for each state the cost-to-go, the edits, their own cost, and the last state."""

    __slots__ = ("costs", "edits", "own", "exits")

    def __init__(self, costs, edits, own, exits):
        self.costs, self.edits, self.own, self.exits = costs, edits, own, exits


def end_node(end: str) -> Node:
    """The node of the empty word: an end of conversations, or one with given costs-to-go."""
    if end == END:
        costs = [cost for cost, _ in AT_END]
        return Node(costs, [edits for _, edits in AT_END], costs, [0, 3, 3, 3])
    return Node([int(c) for c in end.split(",")], [""] * 4, [0] * 4, [0, 1, 2, 3])


def node_before(symbol: str, after: Node) -> Node:
    """The node of a word that is ``symbol`` and then the word of ``after``.

    ``d`` is a turn that must go, other symbols are the role's initial, ``x`` for other roles, in upper case if
    the turn breaks off.
    """
    best = []
    for state in range(4):
        options = [(DELETE + after.costs[state], "D", state, DELETE)]
        if symbol != "d":
            extra = BROKEN_OFF if symbol.isupper() else 0
            kept = KEEPS[state].get(symbol.lower())
            if kept is not None:
                options.append((extra + after.costs[kept], "K", kept, extra))
            options.append((REROLE + extra + after.costs[FORCED[state]], "R", FORCED[state], REROLE + extra))
        best.append(min(options))
    # An insertion leads to another state of the same node. Two in a row only pay from the first two states.
    user, assistant = best[2], best[3]
    best[2] = min(user, (INSERT + assistant[0], "I", 3, INSERT))
    best[3] = min(assistant, (INSERT + user[0], "I", 2, INSERT))
    for state in (0, 1):
        best[state] = min(best[state], (INSERT + best[2][0], "I", 2, INSERT))
    costs, edits, own, exits = [0] * 4, [""] * 4, [0] * 4, [0] * 4
    # States whose edit is no insertion come first; the others then build upon them.
    for state in sorted(range(4), key=lambda s: (best[s][1] == "I", s < 2)):
        cost, letter, then, paid = best[state]
        rest = (edits[then], own[then], exits[then]) if letter == "I" else (after.edits[then], after.own[then], after.exits[then])
        costs[state], edits[state], own[state], exits[state] = cost, letter + rest[0], paid + rest[1], rest[2]
    return Node(costs, edits, own, exits)


def solve(words: DataFrame) -> DataFrame:
    """The best edits of each distinct word: word, end, costs, edits, own, exits, each with a value per state.

    ``words`` has the columns word and end, without repeated rows. Every node of a shared end is
    computed once in its range of reversed words. A task holds the nodes of one word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, last, last_end = [], "", None
        for batch in batches:
            out = []
            for word, end in zip(batch.column("word").to_pylist(), batch.column("end").to_pylist()):
                backward = word[::-1]
                if end != last_end:
                    path, last, last_end = [end_node(end)], "", end
                shared = 0
                while shared < min(len(last), len(backward)) and last[shared] == backward[shared]:
                    shared += 1
                del path[shared + 1 :]
                for symbol in backward[shared:]:
                    path.append(node_before(symbol, path[-1]))
                last = backward
                out.append(path[-1])
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word"),
                    batch.column("end"),
                    pa.array([n.costs for n in out], numbers),
                    pa.array([n.edits for n in out], pa.list_(pa.string())),
                    pa.array([n.own for n in out], numbers),
                    pa.array([n.exits for n in out], numbers),
                ],
                ["word", "end", "costs", "edits", "own", "exits"],
            )

    ordered = words.select("word", "end", F.reverse("word").alias("backward"))
    ordered = ordered.repartitionByRange("end", "backward").sortWithinPartitions("end", "backward").select("word", "end")
    return ordered.mapInArrow(
        run, "word string, end string, costs array<bigint>, edits array<string>, own array<bigint>, exits array<bigint>"
    )


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def _rows(turns: DataFrame) -> DataFrame:
    """The turns with defined roles and texts. A text's order among equal turns and roles is that of its MD5."""
    rows = turns.select(F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), _text("role").alias("role"), _text("text").alias("text"))
    return rows.withColumn("mark", F.md5(F.col("text").cast("binary")))


def _signed(rows: DataFrame) -> DataFrame:
    """A row per conv_id, turn, role and text, with its number of copies, its faults and its symbol, in ranges."""
    tail = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    cells = rows.withColumn("tail", tail).groupBy("conv_id", "turn", "role", "mark").agg(
        F.count("*").alias("n"),
        F.bool_or(F.col("tail") == "").alias("blank"),
        F.bool_or(~F.col("tail").isin(".", "!", "?")).alias("broken"),
    )
    first = cells.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("mark").alias("of_mark")).agg(
        F.min(F.struct("turn")).alias("first")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("mark") == F.col("of_mark"))
    initial = F.left("role", F.lit(1))
    symbol = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    signed = cells.join(first, same).withColumn("again", ~F.col("turn").eqNullSafe(F.col("first.turn")))
    signed = signed.select(
        "conv_id",
        "turn",
        "role",
        "mark",
        "n",
        initial.alias("initial"),
        F.when(F.col("blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0).when(F.col("again"), F.col("n")).otherwise(F.col("n") - 1).alias("duplicate"),
        F.when(F.col("blank") | F.col("again"), "d").when(F.col("broken"), F.upper(symbol)).otherwise(symbol).alias("symbol"),
    )
    return in_ranges(signed, "conv_id", "turn", "role", "mark")


def _illegal(before: Column, initial: Column) -> Column:
    """1 where two neighbouring turns do not follow each other; 0 where there is no turn before."""
    return F.when(before.isNotNull() & ~F.concat(before, initial).isin("su", "ua", "au"), 1).otherwise(0)


def _statistics(numbered: DataFrame) -> DataFrame:
    """Counts per conversation. Neighbours are compared inside a range, then across the ends of ranges."""
    inside = Window.partitionBy("part", "conv_id").orderBy("at")
    known = F.col("turn").isNotNull()
    seen = F.coalesce(F.lag("turn").over(inside) == F.col("turn"), F.lit(False))
    parts = (
        numbered.withColumn("illegal", _illegal(F.lag("initial").over(inside), F.col("initial")) + F.col("n") - 1)
        .withColumn("new_turn", (known & ~seen).cast("long"))
        .groupBy("part", "conv_id")
        .agg(
            *[F.sum(c).alias(c) for c in ("illegal", "new_turn", "blank", "duplicate")],
            F.sum((F.col("symbol") != F.lower("symbol")).cast("long")).alias("truncated"),
            F.min("turn").alias("first_turn"),
            F.max("turn").alias("last_turn"),
            F.min_by("initial", "at").alias("first_initial"),
            F.max_by("initial", "at").alias("last_initial"),
        )
    )
    across = Window.partitionBy("conv_id").orderBy("part")
    same_turn = F.coalesce(F.lag("last_turn").over(across) == F.col("first_turn"), F.lit(False))
    joined = parts.withColumn("edge", _illegal(F.lag("last_initial").over(across), F.col("first_initial"))).withColumn("shared", same_turn.cast("long"))
    span = F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("new_turn") - F.col("shared"))
    return joined.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"),
        F.sum("blank").alias("blank"),
        F.sum("duplicate").alias("duplicate"),
        F.sum("truncated").alias("truncated"),
        F.sum(F.col("illegal") + F.col("edge")).alias("illegal"),
    )


def _blocks(numbered: DataFrame) -> DataFrame:
    """The word of each block of a conversation, its first row's place, and whether it is the last one."""
    block = F.floor(F.col("at") / BLOCK_TURNS)
    symbols = F.array_sort(F.collect_list(F.struct("at", "symbol")))
    blocks = numbered.groupBy("conv_id", "part", block.alias("block")).agg(
        F.array_join(F.transform(symbols, lambda s: s.symbol), "").alias("word"),
        F.min(F.struct("at", "turn", "role", "mark")).alias("head"),
    )
    order = Window.partitionBy("conv_id").orderBy("part", "block")
    last, first = F.lead("block").over(order).isNull(), F.lag("block").over(order).isNull()
    return keep(blocks.withColumn("last", last).withColumn("only", last & first))


def _block_ends(blocks: DataFrame) -> DataFrame:
    """The blocks with ``end``: the costs-to-go after each of them, from the last block to the first."""
    cut = blocks.filter("not only")
    targets = [",".join("0" if i == j else str(NEVER) for j in range(4)) for i in range(4)]
    words = cut.select("word").distinct().select("word", F.explode(F.array(*map(F.lit, targets))).alias("end"))
    index = F.array_position(F.array(*map(F.lit, targets)), F.col("end"))
    costs = solve(words).groupBy("word").agg(F.array_sort(F.collect_list(F.struct(index.alias("i"), "costs"))).alias("to"))
    costs = costs.select("word", F.transform("to", lambda t: t.costs).alias("to"))
    kind = blocks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = None
        for batch in batches:
            ends = []
            for last, to in zip(batch.column("last").to_pylist(), batch.column("to").to_pylist()):
                if last:
                    ends.append(END)
                    after = [cost for cost, _ in AT_END]
                else:
                    ends.append(",".join(map(str, after)))
                after = [min(to[e][state] + after[e] for e in range(4)) for state in range(4)]
                least = min(after)
                after = [min(cost - least, NEVER) for cost in after]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("conv_id", "part", "block", "word", "head")] + [pa.array(ends, pa.string())],
                ["conv_id", "part", "block", "word", "head", "end"],
            )

    head = blocks.schema["head"].dataType.simpleString()
    chained = (
        cut.join(costs, "word")
        .select("conv_id", "part", "block", "word", "head", "last", "to")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))
        .mapInArrow(run, f"conv_id {kind}, part int, block bigint, word string, head {head}, end string")
    )
    whole = blocks.filter("only").select("conv_id", "part", "block", "word", "head", F.lit(END).alias("end"))
    return whole.unionByName(chained)


class _Replay:
    """Goes through sorted conversations, their blocks' edits and their turns, and applies the edits.

    It holds one conversation's edits, not its texts.
    """

    def __init__(self, with_turns: bool):
        self.with_turns, self.open = with_turns, False
        self.out: list[tuple] = []
        self.bytes = 0

    def begin(self, conv_id, statistics) -> None:
        self.finish()
        self.conv_id, self.statistics, self.open = conv_id, statistics, True
        self.cost, self.planned, self.edits, self.at = 0, 0, bytearray(), 0
        self.state, self.before, self.said = 0, None, 0
        self.audit, self.digest = bytearray(), hashlib.sha256()

    def block(self, edits, own, exits) -> None:
        self.edits += edits[self.planned].encode()
        self.cost += own[self.planned]
        self.planned = exits[self.planned]

    def turn(self, key, role, text) -> None:
        if key == self.before:  # another copy of a turn, which must go
            self.audit += b"D"
            self.cost += DELETE
            return
        self.before = key
        self.insertions()
        letter = self.edits[self.at : self.at + 1]
        self.at += 1
        self.audit += letter
        if letter == b"D":
            return
        self.state = KEEPS[self.state][role[0]] if letter == b"K" else FORCED[self.state]
        self.say(letter, role if letter == b"K" else ROLE[self.state], text)

    def insertions(self) -> None:
        while self.edits[self.at : self.at + 1] == b"I":
            self.at += 1
            self.audit += b"I"
            self.state = FORCED[self.state]
            self.say(b"I", ROLE[self.state], "")

    def say(self, letter, role, text) -> None:
        self.digest.update(f"{chr(10) if self.said else ''}{role}:{text}".encode())
        if self.with_turns:
            self.out.append((self.conv_id, self.said, letter.decode(), role, text))
            self.bytes += len(text) + 64
        self.said += 1

    def finish(self) -> None:
        if not self.open:
            return
        self.insertions()
        if not self.with_turns:
            self.out.append((self.conv_id, *self.statistics, self.cost, self.audit.decode(), self.digest.hexdigest()))
            self.bytes += len(self.audit) + 256
        self.open = False


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _replayed(turns: DataFrame, conversations: DataFrame | None, with_turns: bool) -> DataFrame:
    rows = _rows(turns)
    ids = (turns if conversations is None else conversations).select(F.col("conv_id").alias("conv_id")).distinct()
    in_part = Window.partitionBy("part", "conv_id").orderBy("turn", "role", "mark")
    numbered = _signed(rows).withColumn("at", F.row_number().over(in_part) - 1)
    statistics = _statistics(numbered)
    blocks = _block_ends(_blocks(numbered))
    solved = solve(blocks.select("word", "end").distinct()).select("word", "end", "edits", "own", "exits")
    edits = blocks.join(solved, ["word", "end"])
    statistics = statistics.withColumnRenamed("conv_id", "of")
    heads = ids.join(statistics, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", F.lit(0).alias("level"), *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in COUNTS]
    )
    blocks_in_place = edits.select(
        "conv_id", F.lit(1).alias("level"), "head.turn", "head.role", "head.mark", "part", "block", "edits", "own", "exits"
    )
    told = rows.withColumn("level", F.lit(1))
    stream = (
        heads.unionByName(blocks_in_place, allowMissingColumns=True)
        .unionByName(told, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "level", "turn", "role", "mark", F.col("text").isNotNull(), "part", "block")
        .select("conv_id", "level", *COUNTS, "turn", "role", "mark", "text", "edits", "own", "exits")
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = (
        f"conv_id {kind}, place bigint, edit string, role string, text string"
        if with_turns
        else f"conv_id {kind}, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint, audit string, repaired_sha256 string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, arrow = _Replay(with_turns), None

        def flushed() -> Iterator[pa.RecordBatch]:
            if replay.out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*replay.out), arrow.types)], arrow.names)
                replay.out, replay.bytes = [], 0

        for batch in batches:
            if arrow is None:
                id_type, number, string = batch.schema.field("conv_id").type, pa.int64(), pa.string()
                if with_turns:
                    arrow = pa.schema([("conv_id", id_type), ("place", number), ("edit", string), ("role", string), ("text", string)])
                else:
                    arrow = pa.schema(
                        [("conv_id", id_type), *((c, number) for c in (*COUNTS, "cost")), ("audit", string), ("repaired_sha256", string)]
                    )
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_id, level, *counts, turn, role, mark, text, edits, own, exits in zip(*columns):
                if level == 0:
                    replay.begin(conv_id, counts)
                elif text is None:
                    replay.block(edits, own, exits)
                else:
                    replay.turn((turn, role, mark), role, text)
                if replay.bytes > OUT_BYTES:
                    yield from flushed()
        replay.finish()
        yield from flushed()

    return stream.mapInArrow(run, schema)


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """Faults and cheapest repair per conversation: conv_id, five counts, cost, audit, repaired_sha256.

    ``turns`` has conv_id, turn, role and text; ``conversations`` has the conv_ids to report, those of ``turns`` if
    it is not given, and must hold all of them. Turns are ordered by ``turn``, nulls first, equal ones by role and then
    by the MD5 of the text. A null role or text is one space; a null conv_id is a conversation like others. A
    turn is blank, else a duplicate (role and text occurred earlier), else truncated (its last
    character is none of ``.!?``). Repeated rows are duplicates. ``illegal`` counts neighbours whose initials are not
    su, ua or au. ``gaps`` is the number of missing turn numbers.

    Edits in ``audit``: K keeps a turn, R gives it the role user or assistant (1), D deletes it (2; a must for blank
    and duplicate turns), I inserts an empty one (5); truncated turns that stay cost 5. The repaired roles match
    ``(s?(ua)+)?`` by initials; a role with another initial, or an empty one, is never kept. Ties go to the
    ASCII-least audit. A conversation without turns has zeros, an empty audit and the hash of an empty text.
    An empty table gives no rows; other columns are ignored, whatever their names.

    Only roles, hashes and faults are ordered in ranges, so a conversation may span any number of them. Its
    texts pass through one task, sorted and one after another, since SHA-256 of a text is sequential; that task
    holds the conversation's edits, one byte per turn, and no texts.
    """
    return _replayed(turns, conversations, with_turns=False)


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, edit (K, R or I), role, text. Input as in ``repair``."""
    return _replayed(turns, None, with_turns=True)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with faults by the crc32 of ``conv_id:turn`` modulo 20; a null counts as one space.

    0 drops a turn, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 gives it the role user.
    """
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("said", "[.!?]", "")).otherwise(F.col("said"))
    rows = conversations.select(
        F.col("conv_id").alias("conv_id"), F.col("turn").alias("turn"), _text("role").alias("role"), _text("text").alias("said"), fault.alias("fault")
    ).filter("fault <> 0")
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


@query("op11_conversation_repair")
def op11_conversation_repair(spark, sf):
    """Damage ``conversations`` in a fixed way and report the faults and repair of each."""
    conversations = read(spark, sf, "conversations")
    return repair(damaged(conversations), conversations)
