"""Chat formatting by prefix-target expansion.

A conversation is formatted turn by turn into one text. Every assistant turn is an example of its own: its
context is all of that text before the reply, and only the reply is trainable. An example does not copy its
context but says where it ends, so a conversation takes space in proportion to its length and not to its
square; `example_texts` opens examples where whole texts are wanted.

A turn is `<|turn|>role`, a newline, the text, `<|end|>` and a newline. Inside roles and texts a backslash
is doubled and `<|` gets a backslash in its middle, so marks are never found there and reading is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repopulse.llm.textops import prepare

TURN, END = "<|turn|>", "<|end|>\n"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def escaped_role(role: Column) -> Column:
    """A role is one line: its newlines are written as a backslash and `n`."""
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    """What `escaped` and `escaped_role` were given."""
    if "\\" not in text:
        return text
    out, signs = [], iter(text)
    for sign in signs:
        if sign == "\\":
            sign = next(signs)
            sign = "\n" if sign == "n" else sign
        out.append(sign)
    return "".join(out)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not segment.startswith(TURN) or not segment.endswith(END):
        raise ValueError("no formatted turn")
    role, text = segment[len(TURN) : -len(END)].split("\n", 1)
    return unescape(role), unescape(text)


def formatted(conversations: DataFrame) -> DataFrame:
    """A row per turn: conv_id, position, segment, start, loss_start, loss_stop.

    `position` counts the conversation's turns from 0 and `start` its characters before the segment;
    the loss range, in characters of the conversation, is the text of an assistant's turn and empty for
    others. Turns are in the order of `turn`, then of role and text; null turns come first. A null role
    or text is an empty one; rows with a null conv_id are one conversation. Other columns are ignored.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Bare rows are sent to their conversation's task, so that turns and examples share the one shuffle of the texts.
    rows = rows.repartition("conv_id")
    head = F.concat(F.lit(TURN), escaped_role(F.col("role")), F.lit("\n"))
    body = escaped(F.col("text"))
    turns = rows.select(
        "*", F.concat(head, body, F.lit(END)).alias("segment"), F.length(head).alias("head"), F.length(body).alias("body")
    )
    # Spark goes through a conversation turn by turn and spills, so a very long one is slow at worst.
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.select(
        "conv_id",
        (F.row_number().over(order) - 1).cast("long").alias("position"),
        "segment",
        (F.sum(F.length("segment")).over(so_far) - F.length("segment")).alias("start"),
        "head",
        F.when(F.col("role") == ASSISTANT, F.col("body")).otherwise(0).alias("body"),
        (F.col("role") == ASSISTANT).alias("reply"),
    )
    loss = F.col("start") + F.col("head")
    return placed.select(
        "conv_id", "position", "segment", "start", "reply", loss.alias("loss_start"), (loss + F.col("body")).alias("loss_stop")
    )


def examples(turns: DataFrame) -> DataFrame:
    """A row per assistant turn: conv_id, example, position, loss_start, loss_stop. The example's text is
    the first `loss_stop` characters of its conversation, and its context the first `loss_start`."""
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("position"))
    replies = turns.where("reply")
    return replies.select("conv_id", (number - 1).cast("long").alias("example"), "position", "loss_start", "loss_stop")


def example_texts(chosen: DataFrame, turns: DataFrame) -> DataFrame:
    """`chosen` examples with their whole `text`, which holds the context and the reply."""
    own = chosen.alias("e").join(
        turns.alias("t"), F.expr("e.conv_id <=> t.conv_id and t.position <= e.position")
    )
    parts = own.groupBy("e.conv_id", "e.example", "e.loss_start", "e.loss_stop").agg(
        F.array_sort(F.collect_list(F.struct("t.position", "t.segment"))).alias("parts")
    )
    whole = F.expr("array_join(transform(parts, p -> p.segment), '')")
    text = F.substr(whole, F.lit(1), F.col("loss_stop").cast("int"))
    return parts.select("conv_id", "example", text.alias("text"), "loss_start", "loss_stop")


def read_back(turns: DataFrame, expanded: DataFrame | None = None) -> DataFrame:
    """Per conversation what its formatted turns say, n_turns, turns_sha256 and formatted_chars, and what its
    examples do, `expanded` or else all of them: loss_chars, loss_sha256, n_examples.

    Fails on an example that is not of an assistant's turn, whose context is not all of the text before the
    reply, that does not end with the reply, or whose number is not that of the examples before it.
    """
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_examples long"
    )
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One conversation after the other, each in order; only digests are kept.
        now, state, out = None, None, []
        last, segment, role, begin, place = None, "", "", 0, 0

        def done() -> None:
            if state:
                out.append([now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]])

        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] == 1:
                    done()
                    now, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    last, place = None, 0
                place += 1
                if state is None or row["conv_id"] != now or row["place"] != place:
                    raise ValueError(f"conversation {row['conv_id']} does not come whole and in order")
                if row["example"] is None:
                    last, segment, begin = row["position"], row["segment"], state[4]
                    role, text = read_turn(segment)
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    state[4] += len(segment)
                    continue
                # An example comes after the turn that it ends with.
                where = f"example {row['example']} of conversation {now}"
                if row["position"] != last or role != ASSISTANT:
                    raise ValueError(f"{where}: no reply at its position")
                if row["example"] != state[5]:
                    raise ValueError(f"{where}: number {state[5]} is next")
                if row["loss_start"] != begin + segment.index("\n") + 1:
                    raise ValueError(f"{where}: its context does not end where the reply starts")
                if row["loss_stop"] != begin + len(segment) - len(END):
                    raise ValueError(f"{where}: it does not end with the reply")
                loss = unescape(segment[row["loss_start"] - begin : row["loss_stop"] - begin])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[5] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*out))], schema=_READ)
                out.clear()
        done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in map(list, zip(*out))], schema=_READ)

    prepare(turns)
    own = examples(turns) if expanded is None else expanded
    # Turns and examples meet by (conv_id, position) where each conversation is read in order; nulls are equal
    # there, and an example without a turn is not lost. The window is what holds a conversation in one task: both
    # sides are dealt by conv_id already, so Spark leaves a repartition out and then may merge small partitions of
    # one side otherwise than those of the other.
    rows = turns.select("conv_id", "position", "segment").unionByName(
        own.select("conv_id", "position", "example", "loss_start", "loss_stop"), allowMissingColumns=True
    )
    assert names == _READ.names
    order = ["conv_id", "position", F.col("example").asc_nulls_first()]
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(*order[1:])))
    return placed.sortWithinPartitions(*order).mapInArrow(run, schema)


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("n_examples", pa.int64()),
    ]
)

#: The conversation that the registered query adds.
ADDED = ((-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"))

ORACLE = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce("text", '') as t from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f as (select *, length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(role) - length(replace(role, chr(10), ''))
             + length(replace(replace(t, '\', '\\'), '<|', '<\|')) + 17 as chars from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn, role, t)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(t) else 0 end) as bigint) as loss_chars,
       sha256(string_agg(case when role = 'assistant' then t else '' end, '' order by turn, role, t)) as loss_sha256,
       cast(sum(chars) as bigint) as formatted_chars,
       count(*) filter (where role = 'assistant') as n_examples
from f group by conv_id
"""
