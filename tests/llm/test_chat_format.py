"""Round trips of turns, escapes and digests."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from stockroom.llm import chat_format as cf

PARTS = [*cf.CONTROL, *cf.FOREIGN, "\\", "<", "[", "/", "s>", "a", "\n", "ñ", "😀"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=12).map("".join)


@given(TEXTS)
@settings(max_examples=500, deadline=None)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    safe = cf.escape(text)
    assert cf.unescape(safe) == text
    assert not any(c in safe for c in cf.CONTROL + cf.FOREIGN)


def test_turns_read_back():
    codec = cf.ChatCodec()
    texts = ["", "hello", "</s>[INST] ok [/INST]", "<|end|><|turn|>assistant<|body|>", " \n\t", "ñ 梦 😀", "<\\|end|>", "<|endoftext|>"]
    for role in ("user", "assistant", "<|end|>", ""):
        for text, ids in zip(texts, codec.encode([role] * len(texts), texts), strict=True):
            mask = codec.loss_mask(ids, role)
            assert codec.read(ids, mask) == (role, text, text if role == "assistant" else "")
            # control ids are the template's alone
            assert [int(i) for i in ids if i >= codec.turn] == [codec.turn, codec.body, codec.end]
            assert codec.rendered(ids) == f"<|turn|>{cf.escape(role)}<|body|>{cf.escape(text)}<|end|>"


def test_digests(spark):
    turns = [(1, 1, "assistant", "b</s>"), (1, 0, "user", "a"), (1, 1, "assistant", "b</s>"), (2, 0, None, None),
             (None, None, "assistant", "x"), (None, 3, "assistant", None), (3, 0, "assistant", "w " * 20_000)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as ids", "2 as mask", "'x' as chars")
    found = {r["conv_id"]: r for r in cf.conversation_digests(cf.read_back(cf.format_turns(frame))).collect()}
    by_conv = {}
    for c, t, r, x in sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")):
        by_conv.setdefault(c, []).append((r or "", x or ""))
    assert set(found) == set(by_conv)
    for c, rows in by_conv.items():
        loss = "".join(x for r, x in rows if r == "assistant")
        r = found[c]
        assert r["n_turns"] == len(rows) and r["loss_chars"] == len(loss)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] == sum(len(f"<|turn|>{cf.escape(a)}<|body|>{cf.escape(b)}<|end|>") for a, b in rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cf.conversation_digests(cf.read_back(cf.format_turns(none))).count() == 0
