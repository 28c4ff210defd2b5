import random

from ratewise.llm.chat import END, SEP, START, format_chat, read_back

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(2)
    parts = ["<|im_end|>", "<|im_start|>", "<|im_sep|>", "<", "|", "\\", "<\\|", "\n", "assistant", "%0A", "é", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a\nb%", "<|x"]),
             "".join(rng.choice(parts) for _ in range(rng.randint(0, 8))))
            for c in range(60) for t in range(rng.randint(1, 6))]
    out = {r["conv_id"]: r for r in read_back(format_chat(frame(spark, rows))).collect()}
    for c in range(60):
        turns = sorted(r[1:] for r in rows if r[0] == c)
        assert [(t["role"], t["text"]) for t in out[c]["turns"]] == [t[1:] for t in turns]
        assert "".join(out[c]["loss_texts"]) == "".join(t[2] for t in turns if t[1] == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a"), (1, 3, "assistant", "c")]
    r = format_chat(frame(spark, rows)).first()
    assert r["formatted"] == f"{START}user\na{SEP}b{END}{START}assistant\nc{END}"
    assert r["n_blocks"] == 2
    assert [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]] == ["c"]


def test_nulls_ties_and_empty(spark):
    rows = [(1, None, None, None), (1, 5, "user", "x"), (1, 5, "user", "x"), (2, 0, "assistant", "")]
    out = {r["conv_id"]: r for r in read_back(format_chat(frame(spark, rows))).collect()}
    assert [(t["role"], t["text"]) for t in out[1]["turns"]] == [("", ""), ("user", "x"), ("user", "x")]
    assert [(t["role"], t["text"]) for t in out[2]["turns"]] == [("assistant", "")]
    assert format_chat(frame(spark, [])).count() == 0
    assert out[1]["formatted"] and SEP in out[1]["formatted"]


def test_a_long_conversation_takes_time_in_proportion(spark):
    import time

    from pyspark.sql import functions as F
    rows = spark.range(50_000).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 5 < 3, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    start = time.time()
    r = format_chat(rows).first()
    assert time.time() - start < 30
    assert r["n_blocks"] == 20_000 and len(r["loss_spans"]) == 20_000
    told = [r["formatted"][s["start"]:s["start"] + s["length"]] for s in r["loss_spans"]]
    assert told == [f"text {i}" for i in range(50_000) if i % 5 >= 3]
