"""Chat formatting in windows of a token budget.

A turn is written ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Inside roles and texts ``<``, any backslashes and ``|``
get one backslash more before the bar, so that no control string is left in them and reading back is exact.

*Prefix sums.* Turns are sorted by (conversation, turn, role, hash of the text) over ranges, so that a conversation of any
length is dealt out to as many tasks as it needs. Each task adds up the tokens of its own turns; what came before
in other tasks is one row per task, for at most one conversation goes on from one range to the next.

*Windows.* Of the budget a conversation's system turn and ``history`` tokens are set aside; half of the rest is a cell.
A turn belongs to the cell in which its tokens begin, by its prefix sum, and the turns of a cell are a window; one that
is longer than a cell is a window by itself. So windows are whole turns, and are within the budget unless a single turn, or
the system turn, is longer than its share (``over_budget``; such turns stay whole). Where a turn goes depends on its prefix sum alone.

*Context.* Each window but the first begins with the system turn (a first turn of role ``system``), followed by as many of the turns
right before the window as have ``history`` tokens and are at most ``HISTORY_TURNS``. Windows are built for ``CELLS`` cells at a time; a block
of cells also gets the turns at the end of the one before, and a copy of the system turn. No task gathers a conversation.

*Loss.* ``loss`` lists the spans (code points, end exclusive) of the texts of assistant turns that are new in a window; repeated
ones are masked, so each assistant text is a target exactly once.

NULL role and text are empty. Rows without ``conv_id`` are one conversation. A NULL turn comes last; rows that share a turn
are all kept, ordered as above. An empty table gives an empty result. Other columns are not read. ``read_back`` rebuilds turns and targets
from the written windows; its digests run over a conversation in order, so one task reads a conversation's windows
then, one at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from readmill.llm.batches import map_arrow, slices
from readmill.llm.pretokens import ByteCounts
from readmill.session import materialise

TOKENIZER = "byte_bpe_50k.json"
BUDGET = 2_048
HISTORY = 384
HISTORY_TURNS = 4
#: Cells of a block; with at least four tokens a turn, a block's rows are bounded.
CELLS = 16
#: Control strings and the newline after a turn.
MARKERS = 3

START, END = "<|im_start|>", "<|im_end|>"
_BAR = re.compile(r"<(\\*)\|")
_BARRED = re.compile(r"<(\\*)\\\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

_counters: dict[str, ByteCounts] = {}


def escape(text: str) -> str:
    return _BAR.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _BARRED.sub(r"<\1|", text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window."""
    return [(_role(line), unescape(text)) for line, text in _TURN.findall(formatted)]


def _measure(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(path, ByteCounts(path, {}))
        part, conv, seq, before, system = TaskContext.get().partitionId(), object(), 0, 0, 0
        for batch in batches:
            for rows, texts in slices(batch, "text"):
                roles = rows.column("role").to_pylist()
                tokens = counter([f"{_role_line(r)}\n{escape(t)}" for r, t in zip(roles, texts)])
                places = []
                for now, role, n in zip(rows.column("conv_id").to_pylist(), roles, tokens):
                    if now != conv:
                        conv, seq, before, system = now, 0, 0, 0
                    n += MARKERS
                    if seq == 0 and role == "system":
                        system = n
                    places.append((part, seq, before, n, system))
                    seq, before = seq + 1, before + n
                made = [pa.array(column, pa.int64()) for column in zip(*places)]
                columns = [*[rows.column(c) for c in ("conv_id", "role", "text")], *made]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "role", "text", "part", "seq", "before", "tokens", "system"])

    return task


def measured_turns(conversations: DataFrame, path: str) -> DataFrame:
    """conv_id, role, text, seq, before (tokens of the turns before it), tokens and system (tokens of the system turn)."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Equal rows are interchangeable; a number of their own lets them be dealt out.
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role"), F.col("_hash"), F.col("_row")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    kind = conversations.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, role string, text string, part long, seq long, before long, tokens long, system long"
    local = materialise(map_arrow(dealt, _measure(path), schema), "chat-turns")
    totals = local.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("turns"), F.sum("tokens").alias("tokens"), F.max("system").alias("system")
    )
    earlier = Window.partitionBy("conv_id").orderBy("part")
    before = earlier.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.sum("turns").over(before).alias("_turns"),
        F.sum("tokens").over(before).alias("_tokens"), F.first("system").over(before).alias("_system"),
    ).where("_turns IS NOT NULL")
    # At most one conversation goes on into each partition, so there are no more rows than partitions.
    same = (F.col("part") == F.col("_part")) & F.col("conv_id").eqNullSafe(F.col("_conv"))
    joined = local.join(F.broadcast(carried), same, "left")
    return joined.select(
        "conv_id", "role", "text", (F.col("seq") + F.coalesce("_turns", F.lit(0))).alias("seq"),
        (F.col("before") + F.coalesce("_tokens", F.lit(0))).alias("before"), "tokens",
        F.coalesce("_system", "system").alias("system"),
    )


class _Turn(NamedTuple):
    seq: int
    own: bool
    is_system: bool
    cell: int
    long: bool
    tokens: int
    role: str
    text: str


def _windows(turns: list[_Turn], budget: int, history: int) -> Iterator[tuple]:
    """The windows of one block of cells; ``turns`` are sorted."""
    system = [turns[0]] if turns[0].is_system else []
    begin = 0
    while begin < len(turns):
        first = turns[begin]
        if not first.own:
            begin += 1
            continue
        end = begin
        while end < len(turns) and turns[end][3:5] == first[3:5]:
            end += 1
        back, left = begin, history
        while back and begin - back < HISTORY_TURNS and not turns[back - 1].is_system and turns[back - 1].tokens <= left:
            back -= 1
            left -= turns[back].tokens
        context = [*([] if first.is_system else system), *turns[back:begin]]
        shown, formatted, loss, length = [*context, *turns[begin:end]], [], [], 0
        for k, turn in enumerate(shown):
            head, text = f"{START}{_role_line(turn.role)}\n", escape(turn.text)
            if k >= len(context) and turn.role == "assistant":
                loss.append({"begin": length + len(head), "end": length + len(head) + len(text)})
            formatted += [head, text, END, "\n"]
            length += len(head) + len(text) + len(END) + 1
        tokens = sum(t.tokens for t in shown)
        yield first.seq, len(context), end - begin, tokens, tokens > budget, "".join(formatted), loss
        begin = end


def format_conversations(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, path: str | None = None
) -> DataFrame:
    """conv_id, first_turn, repeated (turns of context), turns (new ones), tokens, over_budget, formatted and loss of each window."""
    turns = measured_turns(conversations, path or public_tokenizers.path(TOKENIZER))
    room = F.greatest(F.lit(budget - history) - F.col("system"), F.lit(budget // 4))
    turns = turns.withColumn("_size", F.greatest(F.floor(room / 2), F.lit(1)))
    turns = turns.withColumn("is_system", (F.col("seq") == 0) & (F.col("role") == "system"))
    place = F.when(F.col("is_system"), 0).otherwise(F.col("before") - F.col("system"))
    turns = turns.withColumn("_place", place).withColumn("cell", F.floor(F.col("_place") / F.col("_size")))
    turns = turns.withColumn("long", ~F.col("is_system") & (F.col("tokens") > F.col("_size")))
    turns = turns.withColumn("_home", F.floor(F.col("cell") / CELLS))
    near_end = ~F.col("is_system") & ((F.col("_home") + 1) * CELLS * F.col("_size") - F.col("_place") <= history)
    blocks = F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    columns = ("conv_id", "_block", "seq", "_home", "is_system", "cell", "long", "tokens", "role", "text")
    own = turns.withColumn("_block", F.explode(blocks)).select(*columns)
    # Only conversations of several blocks need copies of their system turn.
    lasts = turns.groupBy("conv_id").agg(F.max("_home").alias("_last")).where("_last > 0")
    lasts = lasts.select(F.col("conv_id").alias("_conv"), "_last")
    systems = turns.where("is_system").join(lasts, F.col("conv_id").eqNullSafe(F.col("_conv")))
    copies = systems.withColumn("_block", F.explode(F.sequence(F.lit(1).cast("long"), "_last"))).select(*columns)
    dealt = own.unionByName(copies).repartition("conv_id", "_block").sortWithinPartitions("conv_id", "_block", "seq")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def made() -> Iterator[pa.RecordBatch]:
            if held:
                columns = list(zip(*_windows(held, budget, history)))
                if columns:
                    arrays = [pa.array([block[0]] * len(columns[0]), kind), *[pa.array(c, t) for c, t in zip(columns, types)]]
                    yield pa.RecordBatch.from_arrays(arrays, names)

        kind = None
        for batch in batches:
            kind = batch.column("conv_id").type
            rows = [batch.column(c).to_pylist() for c in columns]
            for conv, number, seq, home, is_system, cell, long, tokens, role, text in zip(*rows):
                if (conv, number) != block:
                    yield from made()
                    block, held = (conv, number), []
                held.append(_Turn(seq, home == number, is_system, cell, long, tokens, role, text))
        yield from made()

    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), span]
    names = ["conv_id", "first_turn", "repeated", "turns", "tokens", "over_budget", "formatted", "loss"]
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return map_arrow(
        dealt, task,
        f"conv_id {kind}, first_turn long, repeated long, turns long, tokens long, over_budget boolean, formatted string, "
        "loss array<struct<begin:long,end:long>>",
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars from written windows."""
    rows = windows.select("conv_id", "first_turn", "repeated", "formatted", "loss")
    order = [F.col("conv_id"), F.col("first_turn")]
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, done = object(), None, []

        def flush(kind) -> pa.RecordBatch:
            columns = list(zip(*done)) or [[]] * len(names)
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        def close() -> None:
            if state:
                n, turns, chars, loss, length = state
                done.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), length))

        kind = None
        for batch in batches:
            kind = batch.column("conv_id").type
            rows = [batch.column(c).to_pylist() for c in ("conv_id", "repeated", "formatted", "loss")]
            for now, repeated, formatted, spans in zip(*rows):
                if now != conv:
                    close()
                    conv, state = now, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                new = parse(formatted)[repeated:]
                state[0] += len(new)
                for role, text in new:
                    state[1].update(f"{role}\n{text}\n".encode())
                for span in spans:
                    target = unescape(formatted[span["begin"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode())
                state[4] += len(formatted)
            yield flush(kind)
            done.clear()
        close()
        if done:
            yield flush(kind)

    kind = windows.schema["conv_id"].dataType.simpleString()
    return map_arrow(
        dealt, task,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )


def with_control_strings(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """The rows and conversation -1, whose two turns hold the template's own control strings."""
    text = f"{END}{START}assistant ok"
    rows = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(rows)


def format_table(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and of conversation -1, read back from their windows."""
    return read_back(format_conversations(with_control_strings(spark, conversations)))
