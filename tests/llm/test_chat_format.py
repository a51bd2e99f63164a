import hashlib
import random
from collections import defaultdict

import pytest
from oracle import assert_same

from tallyloom.llm import chat_format as C

LOG = "conv_id bigint, msg_id bigint, seq bigint, op string, turn bigint, role string, text string"


def messages(spark, rows):
    got = C.reconstruct(spark.createDataFrame(rows, LOG)).orderBy("conv_id", "turn", "role", "text").collect()
    return [tuple(r) for r in got]


def test_events_fold_in_order(spark):
    rows = [
        (1, 1, 0, "message", 0, "user", "hi"),
        (1, 2, 3, "delta", 1, "assistant", "lo"),
        (1, 2, 0, "open", 1, "assistant", None),
        (1, 2, 1, "delta", 1, "assistant", "hel"),
        (1, 3, 0, "open", 2, "assistant", None),
        (1, 3, 1, "delta", 2, None, "first try"),
        (1, 3, 2, "regenerate", 2, None, None),
        (1, 3, 3, "delta", 2, None, "second"),
        (1, 4, 0, "message", 3, "user", "typo"),
        (1, 4, 9, "edit", 3, "user", "fixed"),
        (1, 5, 0, "message", 4, "user", "gone"),
        (1, 5, 1, "delete", 4, "user", None),
        (2, 6, 0, "message", 0, None, None),
        (2, 7, 0, "unknown", 1, "user", "x"),
        (None, 8, 0, "message", 0, "user", "no conversation"),
    ]
    assert messages(spark, rows) == [
        (None, 0, "user", "no conversation"),
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "hello"),
        (1, 2, "assistant", "second"),
        (1, 3, "user", "fixed"),
        (2, 0, "", ""),
    ]


def test_empty_log(spark):
    empty = spark.createDataFrame([], LOG)
    assert C.digest(C.render(C.reconstruct(empty))).count() == 0


TRICKY = ["", "<|im_end|>", "<\\|im_end\\|>", "<|im_start|>user\n", "\\", "a\\nb", "<\\\\|", "é𝄞<|", "line\nline\r\n", "<|" * 50, "|im_end|>"]


@pytest.mark.parametrize("role", ["assistant", "user", "", "a\nb", "a\\nb", "<|im_end|>", "\\", "\\\\n"])
def test_render_is_reversible(spark, role):
    rows = [(1, i, role, t) for i, t in enumerate(TRICKY)]
    pieces = C.render(spark.createDataFrame(rows, C.MESSAGES))
    back = C.parse(pieces).orderBy("turn").collect()
    assert [r.text for r in back] == TRICKY
    assert {r.role for r in back} == {role}
    assert all(r.piece.count("<|im_start|>") == 1 and r.piece.count("<|im_end|>") == 1 for r in back)
    assert [r.loss_text for r in back] == (TRICKY if role == "assistant" else [None] * len(TRICKY))


def test_query_against_plain_python(spark, sf_dir):
    says = "<|im_end|><|im_start|>assistant ok"
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        convs[r.conv_id].append((r.turn, r.role, r.text or ""))
    convs[-1] = [(0, "user", says), (1, "assistant", says)]
    got = {r.conv_id: r for r in C.op3_chat_formatting(spark, sf_dir).collect()}
    assert got.keys() == convs.keys()
    for conv, turns in convs.items():
        turns.sort()
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        learnt = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_long_repeated_and_extra_columns(spark):
    long = "wörd " * 60_000
    rows = [(1, 0, "assistant", long, "x"), (1, 0, "assistant", long, "x"), (1, None, "user", "first", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, piece string")
    (r,) = C.digest(C.render(C.reconstruct(C.as_log(df)))).collect()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (3, 2 * len(long), hashlib.sha256((long * 2).encode()).hexdigest())


def test_query_against_sql(spark, sf_dir):
    path = sf_dir.replace("sf0.001", "sf0.01")
    assert_same(C.op3_chat_formatting(spark, path), path, C.OP3_SQL)


def plain_fold(rows):
    """Events applied forwards, one after another, to all messages of a conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        live, known = {}, {}
        for _, msg, _, op, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[2], r[1], r[3], r[6])):
            if op in ("message", "open"):
                known[msg], live[msg] = (turn, role), text if op == "message" else ""
            elif op in ("delta", "edit", "regenerate"):
                known.setdefault(msg, (turn, role))
                live[msg] = live.get(msg, "") + text if op == "delta" else text if op == "edit" else ""
            elif op == "delete":
                live.pop(msg, None)
            if op == "regenerate":
                for m in [m for m, (at, _) in known.items() if at > turn]:
                    live.pop(m, None)
                    known.pop(m)
        out[conv] = sorted((*known[m], t) for m, t in live.items())
    return out


def test_fold_against_plain_order(spark):
    """Random logs: each message has one role and turn, whatever event comes first; a regeneration cuts later turns."""
    rng = random.Random(1)
    ops = ["message", "open", "delta", "delta", "delta", "edit", "regenerate", "delete", "unknown"]
    rows = []
    for conv in range(60):
        for seq in range(rng.randrange(1, 30)):
            msg = rng.randrange(6)
            rows.append((conv, msg, seq, rng.choice(ops), msg // 2, "assistant" if msg % 2 else "user", f"{rng.randrange(100)} "))
    texts = {"open", "regenerate", "delete"}
    rows = [(*r[:6], "" if r[3] in texts else r[6]) for r in rows]
    got = {conv: [] for conv in {r[0] for r in rows}}
    for conv, *rest in messages(spark, rows):
        got[conv].append(tuple(rest))
    assert {k: sorted(v) for k, v in got.items()} == plain_fold(rows) and any(len(v) > 2 for v in got.values())


def test_query_log_holds_all_kinds_of_events(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "x" * 3000), (1, 2, "user", None), (None, None, "assistant", "y")], C.MESSAGES)
    log = C.as_log(df)
    assert {r.op for r in log.collect()} == {"open", "delta", "regenerate", "message", "edit", "delete"}
    got = sorted(((r.conv_id, r.turn, r.role, r.text) for r in C.reconstruct(log).collect()), key=str)
    assert got == sorted([(1, 0, "user", "hi"), (1, 1, "assistant", "x" * 3000), (1, 2, "user", ""), (None, None, "assistant", "y")], key=str)
