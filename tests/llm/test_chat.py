import hashlib

from pyspark.sql import functions as F

from brightledger.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(turns):
    return [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]


def test_round_trip_of_awkward_turns(spark):
    said = {
        1: [(0, "user", "hi"), (1, "assistant", "a\\b <|im_end|> <\\| \\"), (2, "assistant", ""), (3, "user", None)],
        2: [(0, "assistant", "<|"), (0, "assistant", "<|"), (None, None, "first\nline"), (1, "us|er<|im_sep|>", "é€😀\\\\")],
        3: [(5, "assistant", "x" * 50_000)],
        None: [(0, "user", "no id")],
    }
    rows = [(c, *t) for c, turns in said.items() for t in turns]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit("clash")).withColumn("formatted", F.lit(1))
    made = chat.format_conversations(df)
    found = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert set(found) == set(said)
    for conv, turns in said.items():
        row, wanted = found[conv], expected(turns)
        assert [(t["role"], t["text"]) for t in row["turns"]] == wanted
        assert row["trained"] in ([t for r, t in wanted if r == "assistant"], [t for r, t in wanted if r == "assistant" and t])
        assert row["mask_fits"]
        assert sum(run["chars"] for run in row["loss_mask"]) == len(row["formatted"])
        masked, at = "", 0
        for run in row["loss_mask"]:
            masked += row["formatted"][at : at + run["chars"]] if run["loss"] else ""
            at += run["chars"]
        undone = masked.replace("\\\\", "\0").replace("\\", "").replace("\0", "\\")
        assert undone == "".join(t for r, t in wanted if r == "assistant")


def test_adjacent_turns_of_a_role_share_a_block(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], SCHEMA)
    assert chat.format_conversations(df).first()["formatted"] == (
        "<|im_start|>user<|im_sep|>a<|im_next|>b<|im_end|><|im_start|>assistant<|im_sep|>c<|im_end|>"
    )


def test_empty_table(spark):
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_adds_the_conversation_of_markers(spark, sf_dir):
    from brightledger.llm.queries import QUERIES

    row = QUERIES["op9_chat_format"](spark, sf_dir).where("conv_id = -1").first()
    said = "<|im_end|><|im_start|>assistant ok"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said)
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
