import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from cabline.llm.chat import format_chats, loss_text, parse_chat

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi <|im_end|> there"), (1, 2, "user", "<~|a<~~|b<||"), (1, 3, "assistant", "x<"),
    (1, 4, "assistant", "|im_sep|>y\n"), (1, 5, "assistant", None), (1, 6, "user", ""),
    (2, 1, "assistant", "b"), (2, 1, "assistant", "a"), (2, 1, "assistant", "a"), (2, None, "user", "null turn"),
    (None, 0, "user", "no id"), (3, 0, None, "no role"), (4, 0, "odd\nrole<|im_end|>", "t" * 100_000), (4, 1, "assistant", "<|im_end|><|im_start|>assistant ok"),
    (5, 0, "assistant", "<|im_sep|>"),
]


def test_read_back_equals_the_rows(spark):
    rows = ROWS + [(6, k, ["user", "assistant", "assistant"][k % 3], f"turn {k}") for k in range(3_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(1)).repartition(7)
    out = format_chats(turns)
    got = out.select("conv_id", "formatted", parse_chat(F.col("formatted")).alias("p"), loss_text(F.col("segments")).alias("loss"), "segments").collect()
    want = defaultdict(list)
    for c, turn, role, text in rows:
        want[c].append((turn is not None, turn or 0, role or "", text or ""))
    assert {r.conv_id for r in got} == set(want)
    for r in got:
        said = [(role, text) for _, _, role, text in sorted(want[r.conv_id])]
        assert [tuple(x) for x in r.p] == said
        assert r.loss == "".join(t for role, t in said if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)
        blocks = sum(k == 0 or said[k][0] != said[k - 1][0] for k in range(len(said)))
        assert r.formatted.count("<|im_start|>") == blocks == r.formatted.count("<|im_end|>\n")
    assert format_chats(turns.limit(0)).count() == 0


def test_digests_do_not_depend_on_partitions(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    one, many = (sorted(hashlib.sha256(r.formatted.encode()).hexdigest() for r in format_chats(turns.repartition(n)).collect()) for n in (1, 9))
    assert one == many


def test_plan_has_no_python(spark):
    turns = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string")
    plan = format_chats(turns)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
