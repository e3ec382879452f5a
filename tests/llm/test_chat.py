import hashlib
import random

from fixtures import rows_of

from fragloom.llm import chat

STRINGS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE ", "[/ROLE]", "\\", "]", "[", "<", "s>", "\n", " ", "a"]


def random_text(rng, most=8):
    return "".join(rng.choices(STRINGS, k=rng.randint(0, most)))


def conversations():
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "", None]
    rows = [
        (c, t, rng.choice(roles), rng.choice([None, "", random_text(rng), "plain text"]))
        for c in [*range(60), None]
        for t in range(rng.randint(1, 9))
    ]
    rows += [(7, None, "user", "no turn"), (8, 0, "user", "tie"), (8, 0, "user", "tie"), (8, 0, "assistant", "tie")]
    rows += [(99, t, "assistant" if t % 2 else "user", "x" * 20_000) for t in range(6)]
    return rows


def expected(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, (role is not None, role or ""), (text is not None, text or "")))
    out = []
    for c, turns in by.items():
        said = [(role[1], text[1]) for _, _, role, text in sorted(turns)]
        loss = "".join(text for role, text in said if role == "assistant")
        digests = (hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{r}\n{t}\n" for r, t in said), loss))
        turns_digest, loss_digest = digests
        out.append((c, len(said), turns_digest, len(loss), loss_digest))
    return sorted(out, key=repr)


def test_every_case_comes_back(spark):
    df = spark.createDataFrame(conversations(), "conv_id bigint, turn bigint, role string, text string")
    df = df.selectExpr("*", "'x' AS example", "1 AS loss_start", "'y' AS key").repartition(4)
    got = chat.read_back(chat.format_conversations(df))
    assert rows_of(got.drop("formatted_chars")) == expected(conversations())


def test_every_reply_is_the_target_once():
    turns = [("system", "s"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d"), ("user", "e")]
    examples = list(chat.expand(turns))
    assert [e.text[e.loss_start : e.loss_end] for e in examples] == ["b", "d", ""]
    assert [len(chat.parse_turns(e.text)) for e in examples] == [3, 5, 6]
    assert all(later.text.startswith(earlier.text) for earlier, later in zip(examples, examples[1:], strict=False))


def test_control_strings_come_back():
    rng = random.Random(1)
    for _ in range(5000):
        turns = [(rng.choice(["user", "assistant", "system", random_text(rng, 3)]), random_text(rng)) for _ in range(rng.randint(1, 4))]
        *_, last = chat.expand(turns)
        assert chat.parse_turns(last.text) == turns


def test_the_quoting_conversation(spark):
    rows = {r.conv_id: r for r in chat.op6_prefix_target_chat(spark, "/root/testdata/sf0.001").collect()}
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == len("</s>[INST] ok [/INST]")


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).collect() == []
