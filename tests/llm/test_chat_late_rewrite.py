"""A template that rewrites a turn behind the first window."""

from shoplens.llm import chat_format


def test_late_rewrite_is_detected():
    turns = [("user" if i % 2 == 0 else "assistant", f"text {i}") for i in range(70)]

    def late(t):
        return "".join(f"<{r}>{'a summary' if i == 40 and len(t) >= 60 else x}\n" for i, (r, x) in enumerate(t))

    def plain(t):
        return "".join(f"<{r}>{x}\n" for r, x in t)

    assert chat_format.locate(late, turns) is None
    assert chat_format.locate(late, turns[:59]) == chat_format._spans(late, turns[:59])
    assert chat_format.locate(plain, turns) == chat_format._spans(plain, turns)
