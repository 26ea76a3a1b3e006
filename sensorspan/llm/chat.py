"""Conversations as training texts: budgeted windows of whole turns, with a loss mask.

A turn is written ``<turn ROLE>``, a line feed, its text, ``</turn>`` and a line feed. Inside
a text a backslash becomes two, and the marks ``<turn `` and ``</turn>`` get one after their ``<``;
taking away the backslash before every character it precedes gives the text back.
A role is percent-encoded.

Prefix sums of the turns' tokens choose spans of whole turns that fit the budget. Every turn is
new in one window; a window repeats the system turn and the latest turns before its span, as
many as a part of the budget holds. Only texts of new assistant turns are targets.

All of it is SQL functions over one row for each conversation and ``PART`` turn
numbers, so a conversation with most of the rows is worked on by many tasks, and texts are
shuffled once. What a part needs from before it, the system turn and the
last turns of the part before, is sent along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 512
HISTORY = 128
CHARS_A_TOKEN = 4
SYSTEM = "system"
TARGET = "assistant"

OPEN = "<turn "
CLOSE = "</turn>"

# Turn numbers that are worked on together, and how many of the part before may be repeated.
PART = 64
LOOK_BACK = 8

_HEAD, _BEFORE, _OWN = 0, 1, 2


def escaped(text: Column) -> Column:
    """``text`` without marks; ``unescaped`` gives it back."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in (OPEN, CLOSE):
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.url_encode(role), F.lit(">\n"))


def _same(one: DataFrame, other: DataFrame, *names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & one[name].eqNullSafe(other[name])
    return condition


def _turns(conversations: DataFrame) -> DataFrame:
    """A row for each turn: its number, role, formatted turn, and the sizes of that and its pieces."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), _header(role).alias("header"), escaped(text).alias("body"))
    chars = F.char_length("header") + F.char_length("body") + len(CLOSE) + 1
    return rows.select(
        "conv_id",
        F.coalesce(F.floor(F.col("turn") / PART), F.lit(-1)).cast("long").alias("part"),
        "turn",
        "role",
        F.concat("header", "body", F.lit(CLOSE + "\n")).alias("piece"),
        F.ceil(chars / CHARS_A_TOKEN).cast("long").alias("tokens"),
        chars.alias("chars"),
        F.char_length("header").alias("lead"),
        F.char_length("body").alias("length"),
    )


def _system_turns(turns: DataFrame) -> DataFrame:
    """The system turn that a conversation begins with, for each part of the conversation."""
    parts = turns.groupBy("conv_id").agg(F.min(F.struct("turn")).alias("_least"), F.collect_set("part").alias("_parts"))
    parts = parts.select(F.col("conv_id").alias("_conv"), F.col("_least.turn").alias("_turn"), "_parts")
    found = turns.where(F.col("role") == SYSTEM)
    first = found.join(parts, found["conv_id"].eqNullSafe(parts["_conv"]) & found["turn"].eqNullSafe(parts["_turn"]))
    return first.withColumn("part", F.explode("_parts")).select(turns.columns)


def _parts(turns: DataFrame) -> DataFrame:
    """Per conversation and part: the system turn, what may be repeated from the part before, and the turns."""
    number = F.col("turn") % PART
    before = turns.where(number >= PART - LOOK_BACK).withColumn("part", F.col("part") + 1)
    kinds = ((_system_turns(turns), _HEAD), (before, _BEFORE), (turns, _OWN))
    rows = None
    for frame, kind in kinds:
        frame = frame.withColumn("kind", F.lit(kind))
        rows = frame if rows is None else rows.union(frame)
    rows = rows.repartition("conv_id", "part")
    order = Window.partitionBy("conv_id", "part", "kind").orderBy("turn", "role", "piece")
    on = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    back = F.sum("tokens").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # Tokens from the part's first own turn to where a turn begins.
    at = F.when(F.col("kind") == _BEFORE, -back).otherwise(F.coalesce(on, F.lit(0)))
    placed = rows.select("*", F.row_number().over(order).alias("place"), at.cast("long").alias("at"))
    turn = F.struct("place", "at", "tokens", "chars", "lead", "length", "role", "piece", "turn")
    of = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, turn)))
    grouped = placed.groupBy("conv_id", "part").agg(of(_HEAD).alias("head"), of(_BEFORE).alias("before"), of(_OWN).alias("own"))
    # A part after the last has only turns to repeat.
    return grouped.where(F.size("own") > 0).withColumn("head", F.slice("head", 1, 1))


def _spans(budget: int, history: int) -> Column:
    """The span of each own turn, from 0: a turn opens a span when it would pass the budget."""
    most = F.greatest(F.lit(budget - history) - F.coalesce(F.try_element_at("head", F.lit(1))["tokens"], F.lit(0)), F.lit(1))
    start = F.struct(F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("end"), F.lit(0).alias("span"), F.expr("cast(array() as array<int>)").alias("spans"))

    def take(state: Column, turn: Column) -> Column:
        end = turn["at"] + turn["tokens"]
        opens = (end - state["base"] > most) & (state["end"] > state["base"])
        span = state["span"] + F.when(opens, 1).otherwise(0)
        return F.struct(
            F.when(opens, state["end"]).otherwise(state["base"]).alias("base"),
            end.alias("end"),
            span.alias("span"),
            F.concat(state["spans"], F.array(span)).alias("spans"),
        )

    return F.aggregate("own", start, take, lambda state: state["spans"])


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training texts of all ``conversations`` (conv_id, turn, role, text).

    Returns conv_id, part and window (their order), text, tokens, n_turns, n_repeated (how many of its
    turns, the first ones, are repeated) and targets: (start, length) in code points of ``text``, of
    the texts of new assistant turns.

    A token is taken to be four characters. A window has at most ``budget`` tokens, of which up to
    ``history`` are repeated turns, unless a single turn with the system turn is longer: turns are
    never cut. The system turn is a first turn whose role is "system"; turns are repeated from up to eight
    turn numbers before a part of 64. Turns are in the order of their numbers, null first, then of role and text.
    Null roles and texts are empty, null conv_ids are one conversation, repeated rows are turns of their
    own. No rows give no rows. Other columns are ignored.
    """
    parts = _parts(_turns(conversations)).withColumn("spans", _spans(budget, history))
    windows = F.transform(F.sequence(F.lit(0), F.array_max("spans")), _window(history))
    rows = parts.select("conv_id", "part", F.posexplode(windows).alias("window", "made"))
    text = F.array_join(F.transform("made.turns", lambda t: t["piece"]), "")
    tokens = F.aggregate("made.turns", F.lit(0).cast("long"), lambda sum, t: sum + t["tokens"])
    return rows.select(
        "conv_id",
        "part",
        "window",
        text.alias("text"),
        tokens.alias("tokens"),
        F.size("made.turns").alias("n_turns"),
        F.col("made.n_repeated").alias("n_repeated"),
        _targets().alias("targets"),
    )


def _window(history: int):
    def made(span: Column) -> Column:
        first = F.array_position("spans", span).cast("int")
        new = F.filter("own", lambda t, i: F.element_at("spans", i + 1) == span)
        begins = F.element_at("own", first)["at"]
        # The system turn is new in the window that begins with it, and repeated in all others.
        is_head = lambda t: (F.size("head") > 0) & F.element_at("head", 1)["piece"].eqNullSafe(t["piece"]) & F.element_at("head", 1)["turn"].eqNullSafe(t["turn"])
        has_head = F.exists(new, is_head)
        head = F.when(has_head, F.slice("head", 1, 0)).otherwise(F.col("head"))
        earlier = F.concat("before", F.slice("own", F.lit(1), first - 1))
        earlier = F.filter(earlier, lambda t: (begins - t["at"] <= history) & ~is_head(t))
        repeated = F.concat(head, earlier)
        return F.struct(F.concat(repeated, new).alias("turns"), F.size(repeated).alias("n_repeated"))

    return made


def _targets() -> Column:
    """Where the texts of the new assistant turns are, by prefix sums of the turns' characters."""
    none = F.expr("cast(array() as array<struct<start:int,length:int>>)")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), none.alias("targets"))

    def take(state: Column, turn: Column) -> Column:
        target = (state["n"] >= F.col("made.n_repeated")) & (turn["role"] == TARGET)
        found = F.array(F.struct((state["at"] + turn["lead"]).alias("start"), turn["length"].alias("length")))
        return F.struct(
            (state["at"] + turn["chars"]).alias("at"),
            (state["n"] + 1).alias("n"),
            F.concat(state["targets"], F.when(target, found).otherwise(none)).alias("targets"),
        )

    return F.aggregate("made.turns", start, take, lambda state: state["targets"])


def turns_of_window(text: Column) -> Column:
    """The turns that a formatted text is made of, read back from it: an array of (role, text)."""
    pieces = F.split(text, CLOSE + "\n")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        ends = F.instr(piece, "\n")
        role = F.url_decode(F.substring(piece, F.lit(len(OPEN) + 1), ends - len(OPEN) - 2))
        return F.struct(role.alias("role"), unescaped(F.substring(piece, ends + 1, F.char_length(piece))).alias("text"))

    return F.transform(pieces, turn)


def digests(windows: DataFrame) -> DataFrame:
    """What ``chat_windows`` says of each conversation, read back from the formatted texts.

    Digests of whole conversations need their texts in one row, here and nowhere else.
    """
    turns = turns_of_window(F.col("text"))
    new = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns) - F.col("n_repeated"), F.lit(0)))
    target = lambda span: unescaped(F.substring(F.col("text"), span["start"] + 1, span["length"]))
    read = windows.select(
        "conv_id",
        "part",
        "window",
        F.size(new).alias("n"),
        F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("targets", target), "").alias("loss"),
        F.char_length("text").alias("chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sort_array(F.collect_list(F.struct("part", "window", "turns", "loss"))).alias("all"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("all", lambda w: w["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.transform("all", lambda w: w["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
