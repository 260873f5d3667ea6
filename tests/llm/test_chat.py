import hashlib
import random

import pytest
from odd_texts import LONG, ODD_TEXTS
from pyspark.sql import functions as F

from millrace.llm import chat

LOG = "conv_id long, turn long, message string, seq long, kind string, role string, text string"
TRICKY = ["", "\\", "\\\\", "</turn>", "<\\/turn>", "\n</turn>\n", "<turn user>\nhi\n</turn>\n", "<<turn <turn ", "\\</turn>\\", "a\x00b", "<", "/turn>", "é</turn>字\U0001f600\\", r"\### Assistant: </turn> ok", "\\n", "<turn\\ "]


@pytest.mark.parametrize("template", [chat.Template(), chat.Template("### ", ":\n", "\n<|end|>\n", ("### ", "<|end|>", "<|start|>"))])
def test_template_is_reversible(template):
    rng = random.Random(5)
    letters = ["<", "/", "turn", ">", "\\", "\n", " ", "### ", "<|end|>", "é", "</turn>", "<turn ", "|", ":"]
    texts = TRICKY + ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for text in texts:
        shown = template.escape(text)
        assert template.unescape(shown) == text and not any(c in shown for c in template.controls)
    turns = [(rng.choice(texts), rng.choice(texts)) for _ in range(2000)]
    parts = [template.render(r, t) for r, t in turns]
    assert list(template.parse("".join(p for p, _, _ in parts))) == turns
    assert all(template.unescape(p[a:b]) == t for (p, a, b), (_, t) in zip(parts, turns, strict=True))


def test_reader_refuses_other_text():
    with pytest.raises(ValueError):
        list(chat.Template().parse("<turn user>\nhi\n</turn>\nstray"))
    with pytest.raises(ValueError):
        chat.Template(controls=("<",))


def fold(events):
    """Plain replay of one log: final messages in order."""
    state = {}
    key = lambda v: (v is not None, v)
    done = set()
    for conv, turn, name, seq, kind, role, text in sorted(events, key=lambda e: (key(e[3]), chat.KINDS.index(e[4]) if e[4] in chat.KINDS else 9, key(e[5]), key(e[6]))):
        if (conv, turn, name, seq, kind, role, text) in done:
            continue
        done.add((conv, turn, name, seq, kind, role, text))
        at = (conv, turn, name)
        if kind == "open":
            state[at] = [role or "", text or ""]
        elif at in state and kind == "delta":
            state[at][1] += text or ""
        elif at in state and kind == "edit":
            state[at][1] = text or ""
        elif at in state and kind == "regenerate":
            state[at] = [state[at][0] if role is None else role, text or ""]
        elif at in state and kind == "delete":
            del state[at]
    out = {}
    for at in sorted(state, key=lambda a: [key(x) for x in a]):
        out.setdefault(at[0], []).append(tuple(state[at]))
    return out


def digests(turns, template):
    said = "".join(t for r, t in turns if r in template.loss_roles)
    whole = "".join(template.render(r, t)[0] for r, t in turns)
    hex_of = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(turns), hex_of("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), hex_of(said), len(whole))


def random_log(rng, n):
    """Several conversations, one of which holds a third of all events."""
    log = []
    for seq in range(n):
        conv = 0 if rng.random() < 0.33 else rng.choice([1, 2, 3, None])
        turn = rng.choice([0, 1, 2, 3, None])
        kind = rng.choices([*chat.KINDS, "ping"], [3, 12, 1, 1, 0.4, 0.3])[0]
        log.append((conv, turn, rng.choice(["a", "b", None]), rng.choice([seq, seq, seq // 2, None]), kind, rng.choice(["user", "assistant", "to>ol\n", None]), rng.choice([*TRICKY, None])))
    return log + rng.choices(log, k=n // 10)


@pytest.mark.parametrize("part", [chat.PART, 40])
def test_fold_and_render_against_plain_replay(spark, part):
    rng = random.Random(part)
    log = random_log(rng, 1500)
    template = chat.Template()
    df = spark.createDataFrame(log, LOG).repartition(7).select("*", F.lit("x").alias("part"), F.lit(1).alias("n_turns"), F.lit(2).alias("loss"))
    shown = chat.render(df, template, part)
    rows = shown.collect()
    want = {c: digests(t, template) for c, t in fold(log).items()}
    if part < 100:
        assert len(rows) > len(want)
    for r in rows:
        assert len(list(template.parse(r["text"]))) == r["n_turns"]
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(shown, template).collect()}
    assert got == want


def test_a_hot_conversation_spans_partitions(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"turn {t} " * 20) for t in range(4000)] + [(c, 0, "user", "hi") for c in range(100, 200)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shown = chat.render(chat.as_log(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
        at = shown.where("conv_id = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert at > 3
    got = chat.read_back(shown).where("conv_id = 7").first()
    assert tuple(got)[1:] == digests([(r, t) for c, _, r, t in rows if c == 7], chat.Template())


def test_rows_of_finished_turns(spark):
    texts = [t for _, t in ODD_TEXTS] + TRICKY + [LONG[:2000]]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(texts)]
    rows += [(2, 0, None, "x"), (2, 0, "user", "y"), (2, 0, "user", "y"), (2, None, "assistant", None), (None, 1, "assistant", "z"), (None, 1, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("s")).withColumn("message", F.lit(1.5))
    template = chat.Template()
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.render(chat.as_log(df), each=True)).collect()}
    assert got[1] == digests([(r, t or "") for _, _, r, t in rows[: len(texts)]], template)
    assert got[2] == digests([("assistant", ""), ("", "x"), ("user", "y"), ("user", "y")], template)
    assert got[None] == digests([("assistant", "z")] * 2, template)
    once = {r["conv_id"]: r["n_turns"] for r in chat.read_back(chat.render(chat.as_log(df))).collect()}
    assert once[2] == 3 and once[None] == 1


def test_empty_log(spark):
    log = spark.createDataFrame([], LOG)
    assert chat.read_back(chat.render(log)).count() == 0
    assert chat.as_log(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
