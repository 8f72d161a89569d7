import hashlib

from hypothesis import given, settings, strategies as st

from tripweave.llm import chat

ODD = "\\### Assistant: </turn> ok"


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def run(spark, rows, **options):
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    return {r.conv_id: r for r in chat.read_back(chat.format_turns(table, **options)).collect()}


def test_turns_come_back(spark):
    texts = [ODD, None, "", "\\", "#", "###", "</turn>\n### User: x", ": ", "\\\\###\\", "é😀\n"]
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", texts[(c + t) % len(texts)]) for c in range(12) for t in range(6)]
    got = run(spark, rows)
    for c in range(12):
        turns = [(r, t or "") for k, _, r, t in rows if k == c]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == 6 and got[c].turns_sha256 == digest(turns)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].valid and got[c].first_error is None


def test_order_is_judged(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "user", "v"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (4, 0, "System: ", "odd: role"), (4, 1, None, "none")]
    got = run(spark, rows)
    assert [got[c].valid for c in (1, 2, 3, 4)] == [False, False, False, False]
    assert [got[c].first_error for c in (1, 2, 3, 4)] == [2, 0, None, 0]
    assert got[4].turns_sha256 == digest([("System: ", "odd: role"), ("", "none")])


def test_odd_input(spark):
    assert run(spark, []) == {}
    rows = [(None, None, "user", "b"), (None, None, "user", "a"), (None, None, "user", "a"), (5, 1, "user", "x" * 100_000)]
    got = run(spark, rows)
    assert got[None].turns_sha256 == digest([("user", "a"), ("user", "a"), ("user", "b")])
    assert got[5].formatted_chars == 100_000 + len("### User: </turn>\n")
    table = spark.createDataFrame([(1, 0, "user", "q", 3, "s")], "conv_id long, turn long, role string, text string, conv int, segments string")
    assert chat.format_turns(table).count() == 1


def test_another_template(spark):
    template = chat.Template(labels={"user": "Q", "assistant": "A"}, opening="<", colon=">", closing="<end>", loss_roles=("user",), follows={chat.START: ("user",), "user": ("user",)}, last_roles=("user",))
    table = spark.createDataFrame([(1, 0, "user", "<A>no<end>"), (1, 1, "user", "b")], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_turns(table, template), template).first()
    assert row.valid and row.loss_chars == 11 and row.turns_sha256 == digest([("user", "<A>no<end>"), ("user", "b")])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="\\#</turn>: \nax?", max_size=30), max_size=5))
def test_reader_undoes_escapes(texts):
    import re

    template = chat.Template()
    reader = chat.TurnReader(template)
    formatted = "".join("### User: " + re.sub(f"({template.escaped})", r"\\\1", t) + "</turn>\n" for t in texts)
    assert list(reader.read(formatted)) == [("user", t) for t in texts]


def test_equal_turns_come_by_their_text(spark):
    """Escaping puts a backslash before ``###``, which must not change the order."""
    rows = [(1, 0, "user", "A"), (1, 0, "user", "###"), (1, None, "user", "first")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = chat.read_back(chat.format_turns(turns)).first()
    want = hashlib.sha256(b"user\nfirst\nuser\n###\nuser\nA\n").hexdigest()
    assert got.turns_sha256 == want
