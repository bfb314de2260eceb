"""Chat formatting: exact round trip, loss mask and turn order."""

import hashlib
import random

from logloom.llm import chat

COLUMNS = "conv_id long, turn long, role string, text string, part string, valid string, c long"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], COLUMNS)


def _brute(rows):
    convs = {}
    for c, n, r, t in rows:
        convs.setdefault(c, []).append((n is not None, n or 0, r or "", t or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0], x[1], x[2].encode(), x[3].encode()))
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _got(df):
    return {r.conv_id: tuple(r)[1:5] for r in df.collect()}


def _hostile(n=300):
    rng = random.Random(8)
    bits = ["\\", "#", "##", "###", "### User: ", "### ?", "</turn>", "</turn>\n", "<", "/", "</", "turn>", ":", ": ", "\n", "a", "é", "\U0001f600", " ", "?", "\r\n", "\x00"]
    make = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
    roles = ["user", "assistant", "system", "tool", "User", "?user", "a: b", "", None, "x\\", "</turn>\n", "### "]
    return [(rng.randint(0, 40), rng.randint(0, 5), rng.choice(roles) if rng.random() < 0.5 else make(), make()) for _ in range(n)]


def test_hostile_texts_come_back(spark):
    rows = [*_hostile(), (None, 1, "user", "x"), (None, None, None, None), (99, 0, "assistant", "y" * 300_000), (98, 1, "user", "same"), (98, 1, "user", "same")]
    made = chat.format_chats(_table(spark, rows))
    assert _got(chat.read_back(made)) == _brute(rows)
    # parts of a few characters say the same
    small = chat.format_chats(_table(spark, rows), part_chars=30)
    assert _got(chat.read_back(small)) == _brute(rows) and small.count() > made.count()
    assert _got(chat.read_back(chat.format_chats(_table(spark, [])))) == {}


def test_marks_only_at_turns():
    for _, _, role, text in _hostile(2000):
        assert "###" not in chat.escape(text) and "</" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
        assert list(chat.turns_of(chat.Template().header(role or "") + chat.escape(text) + chat.Template().end)) == [(role or "", text)]


def test_loss_spans_cover_assistant_texts_only(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u ##"), (1, 2, "assistant", "a </turn>"), (1, 3, "user", "v"), (1, 4, "assistant", "")]
    part = chat.format_chats(_table(spark, rows)).first()
    assert part.formatted == "### System: s</turn>\n### User: u #\\#</turn>\n### Assistant: a <\\/turn></turn>\n### User: v</turn>\n### Assistant: </turn>\n"
    assert [part.formatted[s.start : s.stop] for s in part.loss] == ["a <\\/turn>", ""]


def test_turn_order(spark):
    orders = {1: "system user assistant user", 2: "user assistant tool tool assistant", 3: "assistant user", 4: "user user", 5: "system", 6: "user assistant tool",
              7: "user system", 8: "user assistant critic", 9: "user"}
    rows = [(c, n, r, "t") for c, roles in orders.items() for n, r in enumerate(roles.split())]
    want = {1: (True, None, None), 2: (True, None, None), 3: (False, 0, "system or user"), 4: (False, 1, "assistant"), 5: (False, 1, "user"),
            6: (False, 3, "assistant or tool"), 7: (False, 1, "assistant"), 8: (False, 2, "user or tool"), 9: (True, None, None)}
    assert {r.conv_id: (r.valid, r.bad_turn, r.expected) for r in chat.format_chats(_table(spark, rows)).collect()} == want
    # a template is data: one that starts with the assistant
    other = chat.Template(follows={"start": ("assistant",), "assistant": ("user",), "user": ("assistant",)})
    assert {r.conv_id for r in chat.format_chats(_table(spark, rows), other).where("valid").collect()} == {3}


def test_trial_conversation(spark):
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(chat.with_trial(_table(spark, [(1, 0, "user", "x")])))).collect()}
    text = r"\### Assistant: </turn> ok"
    assert (got[-7].n_turns, got[-7].loss_chars, got[-7].loss_sha256, got[-7].valid) == (2, len(text), hashlib.sha256(text.encode()).hexdigest(), True)
