"""Chat formatting: exact round trips, the grammar, digests, no Python on the executors."""

import hashlib
import random

from pyspark.sql import functions as F

from settlekit.llm import queries
from settlekit.llm.chat_format import escape, format_conversations, formatted_digests, loss_text, parse, unescape

SCHEMA = "conv_id bigint, turn int, role string, text string, formatted string, segments int, __o string"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[/ROLE]", "<", "[", "\\", "<\\s>", "[\\\\INST]", "</", "s>", "]", "é", "𝄞", "\n", "$1", " a "]


def conversations(seed, n=60):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", "".join(rng.choices(MARKS, k=rng.randint(1, 12)))])
    role = lambda: rng.choice(["user", "assistant", "system", "tool", None, "", "".join(rng.choices(MARKS, k=3))])
    return [(c if c else None, rng.choice([None, t, t, 0]), role(), text(), "f", 1, "o") for c in range(n) for t in range(rng.randint(1, 7))]


def by_conversation(rows):
    out = {}
    for c, t, r, x, *_ in rows:
        out.setdefault(c, []).append((t is not None, t if t is not None else 0, (r or "").encode(), (x or "").encode()))
    return {c: [(r.decode(), x.decode()) for _, _, r, x in sorted(v)] for c, v in out.items()}


def test_round_trip_of_conflicting_texts(spark):
    rows = conversations(3)
    made = format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = by_conversation(rows)
    got = made.select("conv_id", "formatted", "segments", parse(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")).collect()
    assert len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == turns
        assert "".join(s["piece"] for s in r["segments"]) == r["formatted"]
        assert r["loss"] == "".join(x for role, x in turns if role == "assistant")
        assert r["formatted"].count("</s>") == len(turns) == r["formatted"].count("<s>")
    for r in formatted_digests(made).collect():
        turns = want[r["conv_id"]]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        loss = "".join(x for role, x in turns if role == "assistant")
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_only_conflicting_content_is_escaped(spark):
    rows = [(1, 0, "user", "plain \\ <b> [x]"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "tool", "x")]
    text = format_conversations(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")).first()["formatted"]
    assert text == "<s>[INST]plain \\ <b> [x]</s><s>[/INST]<\\/s>[\\INST] ok [\\/INST]</s><s>[ROLE]tool[/ROLE]x</s>"


def test_escape_is_reversible_and_leaves_no_mark(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choices(MARKS, k=rng.randint(0, 30))) for _ in range(500)] + ["<" + "\\" * 100_000 + "/s>", "<s>" * 50_000]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e")).select("*", unescape(F.col("e")).alias("u")).collect()
    assert all(r["u"] == r["t"] for r in got)
    assert not any(m in r["e"] for r in got for m in MARKS[:7])


def test_parser_refuses_what_the_grammar_lacks(spark):
    bad = ["<s>[INST]a", "x<s>[INST]a</s>", "<s>a</s>", "<s>[INST]a<s>b</s>", "<s>[ROLE]a</s>", "<s>[INST]a</s>b", "</s>", "<s>[INST]a[SYS]</s>"]
    got = spark.createDataFrame([(t,) for t in bad + [""]], "t string").select(parse(F.col("t"))).collect()
    assert [r[0] for r in got] == [None] * len(bad) + [[]]


def test_long_text_empty_table_and_plan(spark):
    long = "</s>" * 300_000 + "x"
    schema = "conv_id bigint, turn bigint, role string, text string"
    df = spark.createDataFrame([(5, 1, "assistant", long), (5, 0, "user", None)], schema)
    assert formatted_digests(format_conversations(df)).first()["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert format_conversations(spark.createDataFrame([], schema)).count() == 0
    plan = queries.q_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))
