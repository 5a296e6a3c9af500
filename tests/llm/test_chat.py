from lodestone.llm import chat

SCHEMA = "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"


def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_common_prefix_and_masks(spark):
    a, b, c, u = ("user", "hi"), ("assistant", "né"), ("assistant", "no"), ("user", "more")
    cases = [([a, b], [a, c]), ([a, b, u, c], [a, b, u]), ([a, b], [a, b]), ([a], [u]), ([], [a]), (None, None), ([a, b, u, c], [a, c, u, b])]
    rows = spark.createDataFrame([(i, x, y, "clash") for i, (x, y) in enumerate(cases)], SCHEMA).drop("prompt")
    for r in chat.format_preferences(rows).collect():
        x, y = (c or [] for c in cases[r.id])
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        assert (r.prompt_turns, r.prompt, r.chosen_text, r.rejected_text) == (n, render(x[:n]), render(x[n:]), render(y[n:]))
        for text, mask, turns in ((r.chosen_text, r.chosen_mask, x[n:]), (r.rejected_text, r.rejected_mask, y[n:])):
            assert [text[m.start : m.stop] for m in mask] == [f"{t}<|end|>\n" for role, t in turns if role == "assistant"]


def test_conversations_and_replacement(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, None, None), (1, 3, "assistant", "c"), (2, 0, "user", "x"), (None, 0, "user", "lost"), (3, 0, "assistant", "only"), (1, 2, "assistant", "b")]
    talks = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as turns"))
    got = {r.conv_id: r for r in chat.with_last_reply_replaced(talks).collect()}
    assert [tuple(t) for t in got[1].chosen] == [("user", ""), ("assistant", "b"), ("assistant", "b"), ("assistant", "c")]
    assert [tuple(t) for t in got[1].rejected][-1] == ("assistant", "b") and [tuple(t) for t in got[3].rejected] == [("assistant", "")]
    assert got[2].chosen == got[2].rejected and set(got) == {1, 2, 3}
    assert chat.format_preferences(chat.with_last_reply_replaced(talks.limit(0))).count() == 0


def test_very_long_turns(spark):
    a, b, c = ("user", "q" * 700_000), ("assistant", "é" * 700_000), ("assistant", "no")
    r = chat.format_preferences(spark.createDataFrame([(1, [a, b], [a, c])], "id int, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>")).first()
    assert (r.prompt_turns, r.prompt, r.chosen_text) == (1, render([a]), render([b]))
    assert [r.chosen_text[m.start : m.stop] for m in r.chosen_mask] == ["é" * 700_000 + "<|end|>\n"]
