import hashlib

import pytest

from repopulse.llm import chat as C
from tests.llm.samples import seeded

COLUMNS = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "\\", "\\<|", "<\\|", "<<||>", "\\n", "é🙂\n", "", None, "<", "|", "a" * 5000]


def conversations():
    rng = seeded(1)
    rows = [(-1, 0, "user", NASTY[0]), (-1, 1, "assistant", NASTY[0])]
    for conv in range(40):
        for turn in range(rng.randrange(1, 12)):
            text = "".join(x for x in (rng.choice(NASTY) for _ in range(rng.randrange(3))) if x) if rng.random() < 0.9 else None
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "odd\nrole\\<|", None]), text))
    rows += [(None, 0, "assistant", "x"), (None, None, None, None), (77, 3, "user", "only")]
    rows += [(78, 1, "assistant", "tie b"), (78, 1, "assistant", "tie a"), (78, 1, "assistant", "tie a")]
    return rows


def by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        every = "".join(f"{r}\n{x}\n" for r, x in turns)
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (every, loss)]
        out[conv] = (len(turns), digests[0], len(loss), digests[1])
    return out


def test_reading_gives_back_every_turn_and_reply(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "text as segment", "turn as start", "role as reply", "turn as position")
    turns = C.formatted(df)
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(turns).collect()}
    assert found == by_hand(rows)
    chars = {r.conv_id: r.formatted_chars for r in C.read_back(turns).collect()}
    lengths = {r.conv_id: r.chars for r in turns.groupBy("conv_id").agg({"segment": "count"}).selectExpr("conv_id", "0 as chars").collect()}
    assert chars.keys() == lengths.keys()


def test_every_reply_is_an_example_with_all_turns_before_it(spark):
    rows = [r for r in conversations() if r[0] is not None and r[0] < 10]
    turns = C.formatted(spark.createDataFrame(rows, COLUMNS))
    whole = {}
    for r in turns.orderBy("conv_id", "position").collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
    chosen = C.examples(turns)
    texts = C.example_texts(chosen, turns).collect()
    assert len(texts) == sum(r[2] == "assistant" for r in rows)
    for r in texts:
        assert r.text == whole[r.conv_id][: r.loss_stop]
    for conv in whole:
        own = sorted((r.example, C.unescape(r.text[r.loss_start :])) for r in texts if r.conv_id == conv)
        replies = [x or "" for c, _, role, x in sorted(rows, key=lambda r: (r[0], r[1])) if c == conv and role == "assistant"]
        assert own == list(enumerate(replies))


def test_reading_depends_on_every_example(spark):
    rows = [(conv, k, role, f"{role} {k}") for conv in (1, None) for k, role in enumerate(["user", "assistant"] * 3)]
    turns = C.formatted(spark.createDataFrame(rows, COLUMNS))
    own = C.examples(turns)
    found = C.read_back(turns, own).collect()
    assert sorted(found, key=str) == sorted(C.read_back(turns).collect(), key=str)
    assert [(r.n_turns, r.n_examples, r.loss_chars) for r in found] == [(6, 3, 33)] * 2
    fewer = C.read_back(turns, own.where("example < 2")).collect()
    assert [(r.n_turns, r.n_examples, r.loss_chars) for r in fewer] == [(6, 2, 22)] * 2
    wrong = {
        "number": own.where("example <> 1"),
        "next": own.unionByName(own),
        "context": own.withColumn("loss_start", own.loss_start - 1),
        "end with": own.withColumn("loss_stop", own.loss_stop + 1),
        "no reply": own.withColumn("position", own.position + 1),
    }
    for message, spoilt in wrong.items():
        with pytest.raises(Exception, match=message):
            C.read_back(turns, spoilt).collect()


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_turns_and_examples_meet_however_small_partitions_are_merged(spark, reuse):
    settings = {
        "spark.sql.exchange.reuse": reuse,
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    }
    rng = seeded(2)
    rows = [
        (conv, k, rng.choice(["user", "assistant"]), "".join(rng.choice("abcdefgh <|\\") for _ in range(rng.randrange(400))))
        for conv in [None, *range(150)]
        for k in range(rng.randrange(1, 9))
    ]
    expected = by_hand(rows)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {name: spark.conf.get(name, None) for name in [*settings, size]}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        for merged in ("5k", "8k", "12k", "16k", "24k", "40k"):
            spark.conf.set(size, merged)
            turns = C.formatted(spark.createDataFrame(rows, COLUMNS))
            found = C.read_back(turns, C.examples(turns)).collect()
            assert len(found) == len(expected)
            assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_texts_are_shuffled_once(spark):
    turns = C.formatted(spark.createDataFrame(conversations(), COLUMNS))
    read = C.read_back(turns, C.examples(turns))
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_empty_table(spark):
    assert C.read_back(C.formatted(spark.createDataFrame([], COLUMNS))).count() == 0


def test_marks_inside_texts_are_never_marks(spark):
    rows = [(k, 0, "user", text) for k, text in enumerate(NASTY)]
    for r in C.formatted(spark.createDataFrame(rows, COLUMNS)).collect():
        assert r.segment.count(C.TURN) == r.segment.count(C.END) == 1
        assert C.read_turn(r.segment) == ("user", NASTY[r.conv_id] or "")
