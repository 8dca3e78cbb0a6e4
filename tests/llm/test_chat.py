import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import save

from botsieve.llm import chat

ROWS = "conv_id bigint, turn bigint, role string, text string, seq bigint, kind string, piece string, part string"
TEXTS = st.lists(st.sampled_from(["<", ">", "/", "s", "[", "]", "INST", "\\", "|", "SYS", "end", "é", " ", "\n", "<s>", "</s>", "[/INST]", "<|", "<<SYS>>"])).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<|x|>", "a\\"]), TEXTS), max_size=6))
def test_round_trip(turns):
    """Any texts and roles come back from the formatted text, and no text holds a control string."""
    pieces = [chat.piece(role, text) for role, text in turns]
    assert list(chat.read("".join(p for p, _, _ in pieces))) == turns
    assert [chat.unescape(p[a:b]) for p, a, b in pieces] == [t if r == "assistant" else "" for r, t in turns]
    for _, text in turns:
        assert chat.unescape(chat.escape(text)) == text and not any(c in chat.escape(text) for c in chat.CONTROL)


def digests(conv, turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return (conv, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said),
            hashlib.sha256(said.encode()).hexdigest(), sum(len(chat.piece(r, t)[0]) for r, t in turns))


def test_edge_cases(spark, tmp_path):
    """Nulls, repeated rows, ties, control strings, a long text, a role of its own, clashing columns."""
    rows = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a\\[INST]"), (1, 1, "assistant", "b</s>"), (2, 0, None, None), (2, None, "tool", "x"),
            (None, 0, "user", ""), (3, 0, "system", "s"), (3, 1, "assistant", "é" * 300_000), (3, 2, "assistant", None), (4, 5, "user", "z"),
            (4, 5, "assistant", "y"), (4, -1, "<|end|>", "first")]
    df = spark.createDataFrame([(*r, 7, "edit", "clash", "clash") for r in rows], ROWS).repartition(3)
    got = sorted(map(tuple, chat.op13(spark, save(tmp_path, conversations=df)).collect()), key=str)
    want = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        want.append(digests(conv, [(r[2] or "", r[3] or "") for r in own]))
    want.append(digests(-7, [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]))
    assert got == sorted(want, key=str)
    none = chat.op13(spark, save(tmp_path / "none", conversations=df.limit(0))).collect()
    assert [r.conv_id for r in none] == [-7]


def fold(events):
    """The log of one conversation, event by event."""
    messages, opened = [], set()   # [turn, role, text]
    for _, turn, kind, role, text in sorted(events, key=lambda e: (e[0], e[1], chat.KINDS.index(e[2]), e[3], e[4])):
        own = [m for m in messages if m[0] == turn]
        if kind == "message":
            messages.append([turn, role, text])
            opened.add(turn)
        elif own:
            own[-1][2] = (own[-1][2] if kind == "delta" else "") + text
        if kind == "regenerate" and turn in opened:
            messages = [m for m in messages if m[0] <= turn]
    return [(r, t) for _, r, t in sorted(messages, key=lambda m: m[0])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_against_brute_force(spark, seed):
    """Random logs with ties, lost events, edits and regenerations, dealt in any order."""
    rng = random.Random(seed)
    logs = {conv: [(rng.randrange(12), rng.randrange(4), rng.choices(chat.KINDS, [5, 6, 2, 2])[0], rng.choice(["user", "assistant"]), rng.choice("abcd") * 3)
                   for _ in range(rng.randrange(1, 14))] for conv in range(60)}
    rows = [(conv, turn, role, text, seq, kind, "x", "x") for conv, log in logs.items() for seq, turn, kind, role, text in log]
    rng.shuffle(rows)
    pieces = chat.format_messages(chat.final_messages(spark.createDataFrame(rows, ROWS).repartition(5))).collect()
    for conv, log in logs.items():
        own = sorted((r.position, r.piece) for r in pieces if r.conv == conv)
        assert [p for p, _ in own] == list(range(len(own)))
        assert list(chat.read("".join(p for _, p in own))) == fold(log), (conv, log)


def test_order_holds_across_batches(spark):
    """A conversation longer than an Arrow batch, beside short ones, is read in order."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(conv, turn, "assistant", f"{conv}.{turn} ", turn, "message", "x", "x") for conv, n in ((1, 500), (2, 3), (3, 40)) for turn in range(n)]
        df = chat.read_back(chat.format_messages(chat.final_messages(spark.createDataFrame(rows, ROWS).repartition(4))))
        got = {r.conv_id: (r.n_turns, r.loss_sha256) for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {conv: (n, hashlib.sha256("".join(f"{conv}.{t} " for t in range(n)).encode()).hexdigest()) for conv, n in ((1, 500), (2, 3), (3, 40))}
