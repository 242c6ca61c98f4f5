from pyspark.sql import functions as F

from switchflow.llm import chat

def seg(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_prefix_completions_and_masks(spark):
    pair, chosen = F.expr("conv_id div 2"), F.expr("conv_id % 2 = 0")
    rows = [
        (0, 0, "user", "q"), (0, 1, "assistant", "a"), (0, 2, "user", "more"), (0, 3, "assistant", "good 😀"),
        (1, 1, "assistant", "a"), (1, 0, "user", "q"), (1, 2, "user", "more"), (1, 3, "assistant", "bad"),
        (2, 0, "user", "same"), (3, 0, "user", "same"),
        (4, 0, "user", "alone"), (4, 1, "assistant", "yes"),
        (6, 0, None, None), (7, 0, "", ""), (7, 1, "assistant", None),
        (9, None, "assistant", "late"), (9, 5, "user", "x"), (9, 5, "user", "a"),
        (None, 0, "user", "no conversation"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit(1)).withColumn("prompt", F.lit(2))
    got = {r.pair_id: r for r in chat.pair_up(turns, pair, chosen).collect()}
    assert sorted(got) == [0, 1, 2, 3, 4]
    assert got[0].prompt == seg("user", "q") + seg("assistant", "a") + seg("user", "more") and got[0].n_prompt_turns == 3
    assert (got[0].chosen, got[0].rejected) == (seg("assistant", "good 😀"), seg("assistant", "bad"))
    start = len("<|im_start|>assistant\n")
    assert got[0].chosen_mask == f"{start}:{len(got[0].chosen)}"
    assert (got[1].prompt, got[1].chosen, got[1].rejected, got[1].chosen_mask) == (seg("user", "same"), "", "", "")
    assert (got[2].chosen_id, got[2].rejected_id, got[2].rejected, got[2].prompt) == (4, None, None, "")
    a, b = map(int, got[2].chosen_mask.split(":"))
    assert got[2].chosen[a:b] == "yes<|im_end|>\n"
    assert got[3].n_prompt_turns == 1 and got[3].rejected == seg("assistant", "") and got[3].chosen == ""
    assert got[4].rejected == seg("assistant", "late") + seg("user", "a") + seg("user", "x") and got[4].chosen is None
    assert chat.pair_up(turns.limit(0), pair, chosen).count() == 0
