from pyspark.sql import functions as F

from ledgerloom.llm import chat
from ledgerloom.llm.queries import CONTROL_TEXT

ROWS = [
    (1, 0, "system", "be < kind <| <%| <%%|>"),
    (1, 1, "user", CONTROL_TEXT),
    (1, 2, "assistant", "ends with <"),
    (1, 3, "user", None),
    (1, 4, "assistant", "a\nb<|im_end|>\n"),
    (1, 5, "user", "bye <%"),
    (2, 0, "user", "alone"),
    (3, 0, "assistant", ""),
    (4, 0, None, "no role"),
    (4, 0, "as<n\n<|x", "odd role"),
    (4, None, "assistant", "first"),
    (5, 0, "user", "é🙂" * 40_000),
    (5, 1, "assistant", "é🙂"),
    (None, 0, "user", "no conversation"),
    (6, 0, "user", "same"),
    (6, 0, "user", "same"),
]


def examples(spark):
    turns = spark.createDataFrame([(*r, "clash") for r in ROWS], "conv_id long, turn long, role string, text string, example string")
    found = chat.format_examples(turns).withColumn("turns", chat.read_turns(F.col("formatted")))
    trained = chat.trained_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end"))
    return found.withColumn("trained", trained).orderBy("conv_id", "example").collect()


def test_every_reply_after_all_turns_before_it(spark):
    said = {}
    for conv, turn, role, text in sorted(ROWS, key=lambda r: (r[0] or -1, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        said.setdefault(conv, []).append((role or "", text or ""))
    rows = {}
    for row in examples(spark):
        rows.setdefault(row["conv_id"], []).append(row)
    assert rows.keys() == said.keys()
    for conv, turns in said.items():
        replies = [n for n, (role, _) in enumerate(turns) if role == "assistant"]
        ends = sorted({*replies, len(turns) - 1})
        assert [[tuple(t) for t in r["turns"]] for r in rows[conv]] == [turns[: n + 1] for n in ends]
        assert [r["trained"] for r in rows[conv]] == [turns[n][1] if n in replies else None for n in ends]
        for row in rows[conv]:
            assert row["formatted"].count("<|") == 2 * len(row["turns"])
            if row["trained"] is not None:
                part = row["formatted"][row["loss_start"] : row["loss_end"]]
                assert "<|" not in part and len(part) >= len(row["trained"])


def test_no_turns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_examples(empty).count() == 0
