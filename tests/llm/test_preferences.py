from perennial.llm import preferences


def trained(text, mask):
    """The characters a mask trains."""
    out, at = "", 0
    for n, length in enumerate(mask):
        out += text[at : at + length] if n % 2 else ""
        at += length
    assert at == len(text)
    return out


def test_common_turns_are_the_prompt(spark):
    turn = "pair_id long, side string, turn long, role string, text string, prompt string"
    rows = []
    for side, answer in (("chosen", "good"), ("rejected", "bad")):
        rows += [(1, side, 0, "user", "hi", "x"), (1, side, 1, "assistant", "hello", "x"), (1, side, 2, "user", "more?", "x"), (1, side, 3, "assistant", answer, "x")]
    rows += [(2, "chosen", 0, "user", "a", "x"), (3, "chosen", 0, "user", None, "x"), (3, "rejected", 0, "user", None, "x"), (4, "other", 0, "user", "a", "x")]
    rows += [(5, "chosen", 0, None, "é", "x"), (5, "rejected", 0, None, "é", "x"), (5, "rejected", 1, "assistant", "", "x"), (None, "chosen", None, "user", "q", "x")]
    out = {r["pair_id"]: r for r in preferences.format_pairs(preferences.sides(spark.createDataFrame(rows, turn))).collect()}
    one = out[1]
    assert one["n_prompt_turns"] == 3 and one["prompt"].count("<|end|>") == 3 and one["differs"]
    assert one["chosen"] == "<|assistant|>\ngood\n<|end|>\n" and trained(one["chosen"], one["chosen_mask"]) == "good\n<|end|>\n"
    assert trained(one["rejected"], one["rejected_mask"]) == "bad\n<|end|>\n"
    assert out[2]["n_prompt_turns"] == 0 and out[2]["rejected"] == "" and list(out[2]["rejected_mask"]) == []
    assert trained(out[2]["chosen"], out[2]["chosen_mask"]) == ""
    assert not out[3]["differs"] and out[3]["prompt"] == "<|user|>\n\n<|end|>\n"
    assert out[5]["chosen"] == "" and out[5]["rejected"] == "<|assistant|>\n\n<|end|>\n"
    assert 4 not in out and None in out


def test_swapped_answers_pair_neighbours(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (0, 2, "user", "end"), (1, 0, "assistant", "a1"), (2, 0, "user", "alone"), (3, 0, "assistant", "b")]
    rows += [(4, 0, "assistant", "same"), (5, 0, "assistant", "same"), (5, 0, "assistant", "same"), (None, 0, "assistant", "n")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r for r in preferences.format_pairs(preferences.swapped_answers(turns)).collect()}
    # every answered conversation gives a row, also without a neighbour or an id
    assert set(out) == {0, 1, 3, 4, 5, None}
    assert out[3]["rejected"] == "" and out[None]["rejected"] == "" and out[3]["differs"]
    assert out[0]["prompt"].startswith("<|user|>\nq") and "a1" in out[0]["rejected"] and out[0]["rejected"].endswith("end\n<|end|>\n")
    assert not out[4]["differs"]
    paired = preferences.format_pairs(preferences.swapped_answers(turns, unpaired=False))
    assert {r["pair_id"] for r in paired.collect()} == {0, 1, 4, 5}
    assert preferences.format_pairs(preferences.swapped_answers(turns.limit(0))).count() == 0


def test_native_plan(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plan = preferences.format_pairs(preferences.swapped_answers(turns))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_answered_conversation_gives_a_row(spark):
    rows = [(2 * i, n, role, f"{role} {i}") for i in range(20) for n, role in enumerate(("user", "assistant", "user"))]
    rows += [(1, 0, "assistant", "a1"), (3, 0, "user", "no answer"), (None, 0, "user", "q"), (None, 1, "assistant", "n")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {r["pair_id"]: r for r in preferences.format_pairs(preferences.swapped_answers(turns)).collect()}
    assert set(out) == {*range(0, 40, 2), 1, None}
    assert "a1" in out[0]["rejected"] and "assistant 0" in out[1]["rejected"]
    for i in (2, 38, None):
        r = out[i]
        assert r["rejected"] == "" and list(r["rejected_mask"]) == [] and r["differs"] and r["n_prompt_turns"] == 1
        assert trained(r["chosen"], r["chosen_mask"]).startswith("n" if i is None else f"assistant {i // 2}")
