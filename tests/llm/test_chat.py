from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorspan.llm import chat

KINDS = "conv_id long, turn long, role string, text string"
CONTROL = ["</turn>", "<turn ", "\\", "\\\\", "\n", "<", "/turn>", "<\\/turn>", "### Assistant:", "ü", "\U0001f600", "x" * 40, "</turn>\n<turn user>\n", "$1", " "]


def chats(seed=1, convs=25):
    draw = random.Random(seed)
    text = lambda: draw.choice([None, "", "".join(draw.choices(CONTROL, k=draw.randint(1, 12)))])
    rows = []
    for c in [*range(convs), None]:
        first = draw.choice(["system", "user", None])
        rows += [(c, t, first if not t else draw.choice(["user", "assistant", "assistant", "a>b\nc", "system"]), text()) for t in range(draw.choice([1, 3, 9, 150]))]
    rows += [(70, None, "system", "no number"), (70, 0, "assistant", "b"), (70, 0, "assistant", "b"), (70, 0, "assistant", "a")]
    rows += [(71, t, "assistant", "very long " * 20000) for t in range(2)]
    draw.shuffle(rows)
    return rows


def ordered(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c].append(((turn is not None, turn or 0), role or "", text or ""))
    return {c: [t[1:] for t in sorted(turns, key=lambda t: (t[0], t[1].encode(), len(t[2]) and t[2].encode()  or b""))] for c, turns in out.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def escape(text):
    return text.replace("\\", "\\\\").replace("<turn ", "<\\turn ").replace("</turn>", "<\\/turn>")


def windows(frame, **settings):
    out = defaultdict(list)
    for r in chat.chat_windows(frame, **settings).collect():
        out[r["conv_id"]].append(r)
    return {c: sorted(rows, key=lambda r: (r["part"], r["window"])) for c, rows in out.items()}


@pytest.mark.parametrize("budget, history", [(512, 128), (60, 20), (1, 0), (30, 30)])
def test_read_back_equals_what_was_written(documents, budget, history):
    rows = chats()
    frame = documents(rows, KINDS).repartition(4)
    expected = ordered(rows)
    made = chat.chat_windows(frame, budget, history)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    chars = {r["conv_id"]: r["n"] for r in made.groupBy("conv_id").agg(F.sum(F.char_length("text")).alias("n")).collect()}
    assert got.keys() == expected.keys()
    for c, turns in expected.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for role, text in turns)), c
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))
        assert got[c]["formatted_chars"] == chars[c]


@pytest.mark.parametrize("budget, history", [(512, 128), (60, 20)])
def test_windows_keep_to_the_budget(documents, budget, history):
    rows = chats(2)
    expected = ordered(rows)
    for c, found in windows(documents(rows, KINDS), budget=budget, history=history).items():
        turns = expected[c]
        piece = lambda t: f"<turn {'a%3Eb%0Ac' if '>' in t[0] else t[0]}>\n{escape(t[1])}</turn>\n"
        tokens = lambda t: -(-len(piece(t)) // 4)
        begins_with_system = turns[0][0] == "system"
        at = 0
        for w in found:
            new = turns[at : at + w["n_turns"] - w["n_repeated"]]
            new_text = "".join(map(piece, new))
            assert w["text"].endswith(new_text) and new
            front = w["text"][: len(w["text"]) - len(new_text)]
            if begins_with_system and at:
                assert front.startswith(piece(turns[0]))
                front = front[len(piece(turns[0])) :]
            # What is repeated are the latest turns before the span, within their part of the budget.
            kept = turns[1 if begins_with_system else 0 : at]
            repeated = w["n_repeated"] - (1 if begins_with_system and at else 0)
            assert front == "".join(map(piece, kept[len(kept) - repeated :]))
            assert sum(map(tokens, kept[len(kept) - repeated :])) <= history
            if len(new) > 1:
                assert w["tokens"] <= budget
            assert w["tokens"] == sum(map(tokens, new)) + sum(map(tokens, kept[len(kept) - repeated :])) + (tokens(turns[0]) if begins_with_system and at else 0)
            spans = [w["text"][t["start"] : t["start"] + t["length"]] for t in w["targets"]]
            assert spans == [escape(text) for role, text in new if role == "assistant"]
            at += len(new)
        assert at == len(turns)


def test_history_is_repeated_and_parts_go_on(documents):
    rows = [(1, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(200)]
    found = windows(documents(rows, KINDS))[1]
    assert len({w["part"] for w in found}) == 4 and all(w["n_repeated"] for w in found[1:])


def test_the_given_example(documents):
    text = "\\### Assistant: </turn> ok"
    (row,) = chat.digests(chat.chat_windows(documents([(-7, 0, "user", text), (-7, 1, "assistant", text)], KINDS))).collect()
    assert row["turns_sha256"] == sha(f"user\n{text}\nassistant\n{text}\n") and row["loss_sha256"] == sha(text)
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))


def test_no_rows(documents):
    assert chat.digests(chat.chat_windows(documents([], KINDS))).collect() == []


def test_no_python_in_the_plan(documents):
    plan = chat.digests(chat.chat_windows(documents(chats(), KINDS)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
