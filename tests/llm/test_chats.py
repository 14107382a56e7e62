from collections import defaultdict

from tagtide.llm.chats import format_chats, maximal

SCHEMA = "conv_id long, turn long, role string, text string, n long, h1 string, part string, kept string"


def table(spark, chats):
    rows = [(c, k, *m, 1, "?", "?", "?") for c, turns in chats for k, m in turns]
    return spark.createDataFrame(rows, SCHEMA)


def chat(*texts):
    return [(k, (("user", "assistant")[k % 2], t)) for k, t in enumerate(texts)]


CHATS = [
    (1, chat("hi", "hello", "bye")),
    (2, chat("hi")),
    (3, chat("hi", "hello")),
    (4, chat("hi", "hello", "bye")),
    (5, chat("hi", "other")),
    (6, chat("hello", "hi")),
    (7, chat(None)),
    (8, chat("")),
    (9, chat(None, "answer")),
    (10, [(None, ("user", "no turn")), (3, (None, "no role")), (3, ("user", "same turn"))]),
    (11, chat("long " * 20_000)),
    (None, chat("hi", "hello", "bye", "more")),
    *[(100 + i, chat("hi", "hello", *["again"] * (i % 3))) for i in range(30)],
]


def plain():
    key = lambda t: (t[0] is None, t[0] or 0, t[1][0] is not None, t[1][0] or "", t[1][1] is not None, t[1][1] or "")
    turns = {c: [m for _, m in sorted(t, key=key)] for c, t in CHATS}
    groups = defaultdict(list)
    for c, t in turns.items():
        groups[tuple(t)].append(c)
    out = {}
    for t, ids in groups.items():
        if not any(len(o) > len(t) and o[: len(t)] == t for o in groups):
            text = "".join(f"<|im_start|>{r or 'user'}\n{x or ''}<|im_end|>\n" for r, x in t)
            out[min((i for i in ids if i is not None), default=None)] = (len(t), len(ids), text)
    return out


def test_maximal_conversations_rendered(spark):
    got = format_chats(table(spark, CHATS)).collect()
    assert {r.conv_id: (r.n_turns, r.n_equal, r.rendered) for r in got} == plain()
    assert len(got) == len(plain())


def test_empty_table(spark):
    empty = table(spark, [])
    assert maximal(empty).collect() == [] and format_chats(empty).collect() == []


def test_equal_turn_numbers_are_ordered_alike_everywhere(spark):
    for one, two in (("x", "y"), ("a", "b"), ("hello", "bye"), ("1", "2")):
        rows = [(1, 1, "user", one), (1, 1, "user", two), (2, 1, "user", one), (3, 1, "user", two)]
        got = {r.conv_id: r.rendered for r in format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
        # The rendered first turn of conversation 1 says which of the others is its prefix.
        first = got[1].split("\n")[1].removesuffix("<|im_end|>")
        assert set(got) == {1, 3 if first == one else 2}
