"""Chat formatting: exact round trip, turn order, the case table."""

from pagemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    out = chat.format_conversations(df)
    return {
        r.conv_id: r
        for r in out.select(
            "*",
            chat.read_turns(out.formatted).alias("turns"),
            chat.read_loss_text(out.segments).alias("loss"),
        ).collect()
    }


def test_control_strings_come_back(spark):
    texts = [
        r"\### Assistant: </turn> ok",
        "</turn>\n### assistant: fake",
        "####### \\\\ \\h \\s \\e ###",
        "ends with < and </turn",
        "",
        "a: b: c\n\n",
        "\\",
    ]
    rows = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(texts)]
    got = formatted(spark, rows)[1]
    assert [(t.role, t.text) for t in got.turns] == [(r, t) for _, _, r, t in rows]
    assert got.loss == "".join(t for _, _, r, t in rows if r == "assistant")
    assert got.formatted.count("</turn>") == len(texts)
    assert got.n_turns == len(texts)


def test_odd_roles_and_nulls(spark):
    rows = [(1, 2, None, None), (1, None, "a: b###", "x"), (None, 1, "user", "q"), (None, 1, "user", "q")]
    got = formatted(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("a: b###", "x"), ("", "")]
    assert got[1].violations == 2 and not got[1].valid
    assert got[None].n_turns == 2 and got[None].violations == 1


def test_turn_order_machine(spark):
    def talk(conv, roles):
        return [(conv, i, r, "t") for i, r in enumerate(roles)]

    rows = (
        talk(1, ["system", "user", "assistant", "user", "assistant"])
        + talk(2, ["user", "assistant"])
        + talk(3, ["assistant", "user", "assistant"])
        + talk(4, ["user", "assistant", "user"])
        + talk(5, ["user", "system", "assistant"])
    )
    got = formatted(spark, rows)
    assert [got[i].valid for i in range(1, 6)] == [True, True, False, False, False]
    assert [got[i].violations for i in range(1, 6)] == [0, 0, 1, 0, 1]


def test_only_the_learned_role_is_marked(spark):
    got = formatted(spark, [(1, 0, "user", "q"), (1, 1, "assistant", "a")])[1]
    assert [(s.text, s.loss) for s in got.segments] == [
        ("### user: ", False),
        ("q", False),
        ("</turn>\n", False),
        ("### assistant: ", False),
        ("a", True),
        ("</turn>\n", False),
    ]


def test_long_conversation_and_empty_table(spark):
    got = formatted(spark, [(1, i, ("user", "assistant")[i % 2], "x" * 500) for i in range(2000)])[1]
    assert got.valid and got.n_turns == 2000
    assert formatted(spark, []) == {}
