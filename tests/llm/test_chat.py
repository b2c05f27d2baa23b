import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mendwork.llm import chat

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/INST]", "s>", " ", "ok", "é", "\n", "<\\s>", "[\\\\INST]", "<<s>>", "$1"]


def python_escape(text):
    import re

    return re.sub(chat.GUARDED, lambda m: m[0] + "\\", text)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control(text):
    guarded = python_escape(text)
    assert chat.unescape(guarded) == text
    assert not any(c in guarded for c in chat.CONTROLS)


def test_spark_escape_is_the_same(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e")).collect():
        assert r["e"] == python_escape(r["t"]) and chat.unescape(r["e"]) == r["t"]


def brute_fold(events):
    """Messages by conversation, folded in plain order."""
    out = {}
    order = lambda e: (e[2] is not None, e[2] or 0, e[3] or "", e[5] is not None, e[5] or "")
    for conv, mid, seq, kind, role, text in sorted(events, key=order):
        m = out.setdefault((conv, mid), {"position": seq, "role": None, "text": ""})
        m["role"] = role if m["role"] is None else m["role"]
        if kind in ("message", "edit", "regenerate"):
            m["text"] = ""
        if kind != "regenerate":
            m["text"] += text or ""
    return sorted(((c, m["position"], i, m["role"] or "", m["text"]) for (c, i), m in out.items()), key=repr)


def test_fold_against_brute_force(spark):
    rng = random.Random(4)
    events = []
    for seq in range(600):
        kind = rng.choice([*chat.KINDS, "delta", "delta", None])
        events.append((rng.choice([1, 1, 1, 2, None]), rng.choice(["a", "b", None]) if seq % 7 else str(seq), seq, kind, rng.choice(["user", "assistant", None]), rng.choice(["x", "yé", "", None])))
    df = spark.createDataFrame(events, "conv_id bigint, message_id string, seq bigint, kind string, role string, text string").withColumn("position", F.lit("own"))
    got = sorted((tuple(r) for r in chat.fold_events(df.repartition(5)).collect()), key=repr)
    assert got == brute_fold(events)
    assert chat.fold_events(df.limit(0)).count() == 0


def test_round_trip(spark):
    rng = random.Random(2)
    turns = []
    for conv in [*range(30), None]:
        for turn in range(rng.randint(1, 6)):
            turns.append((conv, turn, rng.choice(["user", "assistant", "tool<s>", None]), rng.choice([None, "", "".join(rng.choices(PIECES, k=6)), "long " * 3000])))
    turns += [(3, 0, "user", "again"), (3, 0, "user", "again"), (4, None, "assistant", "no turn")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("segment", F.lit("own")).repartition(3)
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(chat.events_of(df))).collect()}
    assert set(got) == {t[0] for t in turns}
    for conv, r in got.items():
        own = sorted(((-1 if t is None else t, role or "", text or "") for c, t, role, text in turns if c == conv), key=lambda x: (x[0], x[1].encode(), x[2].encode()))
        said = "".join(f"{role}\n{text}\n" for _, role, text in own)
        learned = "".join(text for _, role, text in own if role == "assistant")
        assert r["n_turns"] == len(own) and r["loss_chars"] == len(learned)
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    assert chat.read_back(chat.format_conversations(chat.events_of(df.limit(0)))).count() == 0
