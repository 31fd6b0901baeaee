from bankspark.llm import preferences as pf

TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so?"), (1, 3, "assistant", "é!"),
    (2, 0, "user", "hi"), (2, 1, "assistant", "yes"), (2, 2, "user", "so?"), (2, 3, "assistant", "no"), (2, 4, "user", "ok"),
    (3, 0, "user", "hi"), (4, 0, "user", "hi"), (5, 0, None, None), (5, 1, "assistant", ""), (None, 0, "user", "lost"),
    (6, 1, "assistant", "b"), (6, 1, "assistant", "a"), (6, None, "system", "first"),
]


def pairs_of(spark, ids):
    turns = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, prompt string")
    pairs = spark.createDataFrame(ids, "chosen_id long, rejected_id long")
    return {(r.chosen_id, r.rejected_id): r for r in pf.format_pairs(turns, pairs).collect()}


def line(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def test_prompt_is_the_longest_common_prefix(spark):
    got = pairs_of(spark, [(1, 2), (3, 4), (3, 1), (5, 6), (1, 99), (None, 1)])
    assert set(got) == {(1, 2), (3, 4), (3, 1), (5, 6)}
    r = got[(1, 2)]
    assert r.n_prompt == 3 and r.prompt == line("user", "hi") + line("assistant", "yes") + line("user", "so?")
    assert r.chosen == line("assistant", "é!") and r.rejected == line("assistant", "no") + line("user", "ok")
    assert [r.chosen[a:b] for a, b in r.chosen_trained] == ["é!<|end|>"] and [r.rejected[a:b] for a, b in r.rejected_trained] == ["no<|end|>"]
    assert got[(3, 4)].chosen == got[(3, 4)].rejected == "" and got[(3, 4)].n_prompt == 1 and not got[(3, 4)].chosen_trained
    assert got[(3, 1)].chosen == "" and got[(3, 1)].rejected.startswith(line("assistant", "yes"))


def test_order_of_turns_and_nulls(spark):
    r = pairs_of(spark, [(5, 6)])[(5, 6)]
    assert r.n_prompt == 0 and r.prompt == "" and r.chosen == line("unknown", "") + line("assistant", "")
    assert r.rejected == line("system", "first") + line("assistant", "a") + line("assistant", "b")
    assert [r.rejected[a:b] for a, b in r.rejected_trained] == ["a<|end|>", "b<|end|>"]


def test_neighbours_and_empty_tables(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in pf.neighbour_pairs(turns).collect()} == {(2, 3), (4, 5)}
    assert pf.format_pairs(turns.limit(0), pf.neighbour_pairs(turns.limit(0))).count() == 0


def test_exchanged_answers_give_real_prompts(spark):
    turns = spark.createDataFrame([(*t, "x", "y") for t in TURNS] + [(7, 0, "assistant", "b", "x", "y"), (9, 0, "user", "u" * 200_000, "x", "y"), (9, 1, "assistant", "v", "x", "y")],
                                  "conv_id long, turn long, role string, text string, c string, last string")
    pairs = pf.exchanged(turns)
    got = {r.chosen_id: r for r in pf.format_sides(pairs).collect()}
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 9} and {k: r.rejected_id for k, r in got.items()} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: 7, 7: 6, 9: None}
    # A neighbour without a trained turn, or none at all: an empty answer.
    assert got[2].n_prompt == 3 and got[2].rejected == line("assistant", "") + line("user", "ok") and got[2].chosen == line("assistant", "no") + line("user", "ok")
    assert [got[2].rejected[a:b] for a, b in got[2].rejected_trained] == ["<|end|>"]
    assert got[9].prompt == line("user", "u" * 200_000) and got[9].chosen == line("assistant", "v")
    # No trained turn: nothing to exchange. Equal answers: all is prompt.
    assert got[4].n_prompt == 1 and got[4].chosen == got[4].rejected == "" and got[5].n_prompt == 2
    assert got[6].n_prompt == 3 and got[7].n_prompt == 1 and got[6].chosen == got[7].rejected == ""
    assert pf.format_sides(pf.exchanged(turns.limit(0))).count() == 0
