from tallyboard.llm import chats

SCHEMA = "conv_id long, turn long, role string, text string, place int"


def turns(conv, *texts, roles="ua"):
    return [(conv, k, roles[k % len(roles)], t, 9) for k, t in enumerate(texts)]


def result(spark, rows):
    out = chats.maximal(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted((r.conv_id, r.n_turns, r.n_copies) for r in out), {r.conv_id: r.rendered for r in out}


def test_snapshots_collapse(spark):
    rows = [
        *turns(1, "hi"), *turns(2, "hi", "yes?"), *turns(3, "hi", "yes?", "bye"), *turns(4, "hi", "yes?", "bye"),
        *turns(5, "hi", "no"), *turns(6, "yes?", "hi"), *turns(7, "hi", roles="a"), *turns(8, "hiyes?"),
    ]
    kept, rendered = result(spark, rows)
    assert kept == [(3, 3, 2), (5, 2, 1), (6, 2, 1), (7, 1, 1), (8, 1, 1)]
    assert rendered[3] == "<|u|>\nhi\n<|a|>\nyes?\n<|u|>\nbye\n"


def test_nulls_repeats_ties_and_long_texts(spark):
    long = "x" * 200_000
    rows = [
        (None, 0, "u", "lost", 0), (1, None, "u", None, 0), (1, 1, None, "", 0), (2, 0, "u", "", 0), (2, 1, None, "", 0),
        (3, 0, "u", "a", 0), (3, 0, "u", "a", 0), (3, 0, "a", "b", 0), (4, 0, "u", long, 0), (5, 0, "u", long, 0), (5, 1, "a", long, 0),
    ]
    kept, rendered = result(spark, rows)
    assert kept == [(1, 2, 1), (2, 2, 1), (3, 2, 1), (5, 2, 1)]
    assert rendered[3] == "<|a|>\nb\n<|u|>\na\n" and rendered[1] == "<|u|>\n\n<||>\n\n"


def test_first_turn_shared_by_most(spark):
    rows = [x for k in range(300) for x in turns(k, "same start", f"own {k % 100}")] + [x for k in range(300, 400) for x in turns(k, "same start")]
    kept, _ = result(spark, rows)
    assert kept == [(k, 2, 3) for k in range(100)]


def test_empty_table(spark):
    assert result(spark, []) == ([], {})
