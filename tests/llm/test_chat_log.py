"""Chat formatting: fold of event logs, exact round trip, awkward rows."""
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from eventide.llm import chat_log

LOG = "conv_id long, message long, seq long, kind string, role string, text string"
TURNS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "a\\b", "\\", "\\\\[INST]", "[\\INST]", "<s", "<<s>>", "[[INST]]", "", None, " lead and trail ", "\n\n", "[:]x[/ROLE]",
         "é😀[/OUT]", "[OUT] y</s>", "x" * 40_000, "[/INST", "]", " [/INST]", "$1\\2"]


def folded(rows):
    """Brute force of the fold: events one after the other."""
    live, out = {}, {}
    events = sorted((r for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    for conv, message, seq, kind, role, text in events:
        m = live.setdefault((conv, message), {"start": seq, "role": None, "text": "", "gone": False})
        if role is not None and m["role"] is None:
            m["role"] = role
        if kind in ("start", "edit"):
            m["text"] = text or ""
        elif kind == "regenerate":
            m["text"] = ""
            for (c, _), other in live.items():
                if c == conv and other["start"] > m["start"]:
                    other["gone"] = True
        else:
            m["text"] += text or ""
    for (conv, _), m in live.items():
        if not m["gone"]:
            out.setdefault(conv, []).append((m["start"], m["role"] or "", m["text"]))
    return {c: [(r, t) for _, r, t in sorted(ms)] for c, ms in out.items()}


def event_log(seed=3, convs=12):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        seq, messages = 0, []
        for _ in range(rng.randint(1, 40)):
            seq += rng.randint(1, 3)
            kind = rng.choice(["start", "start", "delta", "delta", "delta", "edit", "regenerate", None])
            if kind == "start" or not messages:
                messages.append(len(messages))
                rows.append((c, messages[-1], seq, rng.choice(["start", "delta"]), rng.choice(["user", "assistant", "tool", None]), rng.choice(NASTY)))
            else:
                rows.append((c, rng.choice(messages), seq, kind, None, rng.choice(NASTY)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold_matches_an_event_loop(spark, seed):
    rows = event_log(seed)
    df = spark.createDataFrame(rows, LOG).repartition(5).withColumn("pos", F.lit("clash")).withColumn("reset", F.lit(1))
    got = {}
    for r in sorted(chat_log.fold(df).collect(), key=lambda r: r["pos"]):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == folded(rows)


def turns_table(spark):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool]", "a[:]b\\", "", None]), rng.choice(NASTY)) for c in range(25) for t in range(rng.randint(1, 9))]
    rows += [(None, None, None, None), (None, 0, "user", "of no conversation"), (99, 0, "user", "twice"), (99, 0, "user", "twice"), (99, 0, "assistant", "tie"), (99, None, "user", "first")]
    rows += [(100, t, "user" if t % 2 else "assistant", f"{t} [INST]") for t in range(300)]
    return rows, spark.createDataFrame(rows, TURNS).repartition(6).withColumn("seq", F.lit("clash")).withColumn("loss", F.lit(0))


def ordered(rows, conv):
    own = [(r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv]
    return [x[2:] for x in sorted(own)]


def test_turns_come_back_from_the_formatted_text(spark):
    rows, df = turns_table(spark)
    formatted = chat_log.render(chat_log.fold(chat_log.log_of_turns(df, piece=7)))
    assert formatted.count() == len({r[0] for r in rows})
    back = chat_log.read_back(formatted)
    got = {}
    for r in sorted(back.collect(), key=lambda r: r["pos"]):
        assert r["learned"] == (r["text"] if r["role"] == "assistant" else "")
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == {c: ordered(rows, c) for c in {r[0] for r in rows}}
    texts = {r["conv_id"]: r for r in formatted.collect()}
    for r in chat_log.digests(back).collect():
        turns = ordered(rows, r["conv_id"])
        learned = "".join(t for role, t in turns if role == "assistant")
        assert (r["n_turns"], r["loss_chars"], r["formatted_chars"]) == (len(turns), len(learned), len(texts[r["conv_id"]]["formatted"]))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def test_spans_of_the_whole_string_hold_the_assistant_texts(spark):
    rows, df = turns_table(spark)
    for r in chat_log.render(chat_log.fold(chat_log.log_of_turns(df))).collect():
        turns = ordered(rows, r["conv_id"])
        assert len(r["loss"]) == len(turns)
        for (role, text), (start, length) in zip(turns, r["loss"], strict=True):
            masked = r["formatted"][start:start + length]
            assert length == 0 or (role == "assistant" and masked.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\") == text)


def test_one_exchange_and_no_python(spark):
    _, df = turns_table(spark)
    plan = chat_log.digests(chat_log.read_back(chat_log.render(chat_log.fold(chat_log.log_of_turns(df.coalesce(1))))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(conv_id") == 1 and "Python" not in text and "Pandas" not in text


def test_empty_log(spark):
    assert chat_log.digests(chat_log.read_back(chat_log.render(chat_log.fold(spark.createDataFrame([], LOG))))).count() == 0
    assert chat_log.fold(chat_log.log_of_turns(spark.createDataFrame([], TURNS))).count() == 0
