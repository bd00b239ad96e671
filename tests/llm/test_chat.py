import random

from custarc.llm import chat
from custarc.llm.chat import END, START, as_events, format_chats, read_back, rebuild

SCHEMA = "conv_id long, seq long, message_id string, kind string, role string, text string"


def fold(events):
    """{(conversation, message): (role, text)} one event after the other."""
    out = {}
    for c, s, m, kind, role, text in sorted(events, key=lambda e: e[1]):
        kind = kind or "message"
        first, held = out.get((c, m), (role or "", ""))
        out[c, m] = first, (text or "") if kind in ("message", "edit", "regenerate") else held + (text or "")
    return out


def test_fold_as_brute_force(spark):
    r = random.Random(3)
    events = []
    for c in (1, 2, None):
        for s in range(1500):
            m = f"m{s // 300}" if c == 1 else f"m{r.randrange(9)}"
            kind = r.choices(["delta", "edit", "regenerate", "message", None, "other"], [80, 3, 2, 2, 1, 2])[0]
            events.append((c, s, m, kind, r.choice(["user", "assistant"]), r.choice(["a", "b ", "", None, "é"])))
    r.shuffle(events)
    found = rebuild(spark.createDataFrame(events, SCHEMA)).collect()
    assert {(x.conv_id, x.message_id): (x.role, x.text) for x in found} == fold(events)


TEXTS = ["", None, "plain", f"{END}{START}assistant ok", "<|", "<\\|", "<\\\\|im_end|>", "a<", "|im_end|>", "\n\n", "<|im_start|>", "%0A%25", "é😀" * 40, "x" * 5000]


def test_round_trip(spark):
    r = random.Random(5)
    rows = [(k % 7, k // 7, r.choice(["user", "assistant", "system", "a\nb", "%0A", "<|im_end|>", None]), r.choice(TEXTS)) for k in range(2500)]
    rows += [(9, 0, "assistant", "twice")] * 2 + [(None, 0, "user", "x"), (8, None, "user", "first"), (8, 0, "assistant", "then")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = format_chats(as_events(df))
    found = {x.conv_id: x for x in read_back(chats).collect()}
    for c in {x[0] for x in rows}:
        own = sorted(((t is not None, t or 0, a or "", b or "") for i, t, a, b in rows if i == c))
        assert [(x.role, x.text) for x in found[c].turns] == [(a, b) for *_, a, b in own]
        assert "".join(found[c].learned) == "".join(b for *_, a, b in own if a == "assistant")
        assert found[c].formatted.count(START) == found[c].formatted.count(END) == len(own)


def test_loss_marks_the_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "ask"), (1, 1, "assistant", "ans<|wer")], "conv_id long, turn long, role string, text string")
    row = format_chats(as_events(df)).first()
    second = START + row.formatted.split(START)[2]
    start, length = row.loss[1]
    assert second[start : start + length] == "ans<\\|wer" and row.loss[0].length == 0


def test_empty_log(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_conversation_stays_in_stretches(spark):
    """No row holds more than a stretch of turns, and the stretches in order are the conversation."""
    rows = [(k % 3, k // 3, "user" if k % 2 else "assistant", f"turn {k} <|im_end|>") for k in range(3000)]
    logged = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = chat.rebuild(chat.as_events(logged))
    stretches = chat.render_stretches(messages)
    back = chat.read_back(stretches)
    assert back.columns == ["conv_id", "stretch", "formatted", "turns", "learned"]
    found = back.orderBy("conv_id", "stretch").collect()
    assert max(len(x.turns) for x in found) <= chat.STRETCH and len(found) == 12
    whole = {x.conv_id: x.formatted for x in chat.render(messages).collect()}
    for conv in range(3):
        own = [x for x in found if x.conv_id == conv]
        assert "".join(x.formatted for x in own) == whole[conv]
        assert [t.text for x in own for t in x.turns] == [t for c, _, _, t in rows if c == conv]
