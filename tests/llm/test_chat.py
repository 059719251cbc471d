import hashlib
import statistics

import duckdb
import pandas as pd

from loomgraph.llm import chat

ROWS = [
    (0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "hello"), (0, 3, "user", "bye"),
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"),
    (2, 0, "user", "a"), (3, 0, "user", "a"),
    (4, 5, "user", None), (4, 5, "assistant", "x"), (4, None, "user", "first"), (7, 1, None, "alone"),
    (8, 0, "user", "Ünï"), (8, 0, "user", "Ünï"), (9, 0, "user", "Ünï"), (None, 0, "user", "lost"),
] + [(10, i, "assistant" if i % 2 else "user", "t" * i) for i in range(300)]


def test_against_sql(spark):
    frame = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, pair_id int")
    got = chat.by_replies(frame).toPandas()
    conversations = pd.DataFrame(ROWS, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    want = duckdb.connect().execute(chat.ORACLE_SQL).df()
    key = lambda f: sorted(map(tuple, f[sorted(f.columns)].astype(str).values.tolist()))
    assert key(got) == key(want)
    assert chat.by_replies(frame.limit(0)).count() == 0


def test_prompt_once_and_masked_completions(spark):
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    r = chat.preference_pairs(frame.where("conv_id < 2"), frame.conv_id * 0, frame.conv_id == 0).first()
    assert r.n_common == 2 and r.prompt.count("be kind") == 1
    assert r.chosen.startswith("<|im_start|>assistant\nhello<|im_end|>")
    assert r.rejected == "<|im_start|>assistant\nno<|im_end|>\n" and r.rejected_mask == "22x0,13x1"
    for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
        runs = [x.split("x") for x in mask.split(",")]
        assert sum(int(n) for n, _ in runs) == len(text)
        at, learned = 0, ""
        for n, flag in runs:
            learned += text[at : at + int(n)] if flag == "1" else ""
            at += int(n)
        assert learned in ("hello<|im_end|>\n", "no<|im_end|>\n")


def plain_pairs(rows):
    """(n_common, n_chosen, n_rejected) of each conversation by loops."""
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            held.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    said = {c: [x[1:] for x in sorted(v)] for c, v in held.items()}
    out = {}
    for c, a in said.items():
        replies = [i for i, (role, _) in enumerate(a) if role == "assistant"]
        cut = replies[int(hashlib.md5(f"23:{c}".encode()).hexdigest()[:8], 16) % len(replies)] if replies else len(a)
        b = a[:cut] + [x for x in said.get(c + 1, []) if x[0] == "assistant"][-1:]
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        out[c] = (same, len(a), len(b))
    return out


def test_pairs_share_a_prompt(spark):
    frame = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    assert {r.pair_id: (r.n_common, r.n_chosen, r.n_rejected) for r in chat.by_replies(frame).collect()} == plain_pairs(ROWS)
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    got = {r.pair_id: (r.n_common, r.n_chosen, r.n_rejected) for r in chat.by_replies(table).collect()}
    assert got == plain_pairs([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
    assert statistics.median(n for n, _, _ in got.values()) > 0


def test_large_keys_and_clashing_names(spark):
    rows = [(i, k, r, f"{i} {k}", "a", "b", 0) for i in (2**60, 2**60 + 1, 2**60 + 2, -(2**63), 2**63 - 1) for k, r in enumerate(("user", "assistant"))]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, a string, reply string, pair_id int")
    got = chat.by_replies(frame)
    assert sorted(r.pair_id for r in got.collect()) == sorted({r[0] for r in rows})
    assert got.where(f"pair_id = {2**60}").first().rejected == f"<|im_start|>assistant\n{2**60 + 1} 1<|im_end|>\n"
