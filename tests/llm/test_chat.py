"""Chat format: round trips, attachments, streaming."""

import hashlib
import random
from collections import defaultdict

from larder.llm import chat

LAYOUT = f"c long, t long, r string, parts array<{chat.PART}>, piece int"


def part(kind=None, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_escape_is_reversible():
    r = random.Random(1)
    for _ in range(2000):
        text = "".join(r.choices(["\\", "<", ">", "(", ")", "/turn", "a", "|", "\n", "</turn>"], k=r.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        assert not set("<>") & set(chat.escape(text))


def test_turns_and_attachments(spark):
    rows = [
        (1, 0, "user", [part("text", "see <|image 1|>"), part("image", ref="a.png", width=100, height=29), part(None, "!")], 0),
        (1, 1, "assistant", [part("text", "ok \\"), part("audio", ref="b", seconds=1.01), part("text", "</turn>\n")], 0),
        (1, 2, None, None, 0),
        (1, 3, "a<b>\n", [part("document", ref="c", pages=2), part("film", ref="d"), None, part("text", None)], 0),
        (None, 5, "assistant", [part("text", "n")], 0),
        (None, None, "assistant", [part("text", "first")], 0),
    ]
    pieces = chat.format_turns(spark.createDataFrame(rows, LAYOUT).repartition(4), "c", "t", "r", "parts")
    chunks = chat.assemble(pieces)
    text = {c.conversation: c.text for c in chunks.collect()}
    assert text[1] == (
        "<turn user>see \\(|image 1|\\)<|image 1|>!</turn>\n"
        "<turn assistant>ok \\\\<|audio 1|>\\(/turn\\)\n</turn>\n"
        "<turn ></turn>\n"
        "<turn a\\(b\\)\n><|document 1|><|other 2|></turn>\n"
    )
    one = chunks.where("conversation = 1").first()
    assert [(a.kind, a.ref, a.tokens, one.text[a["at"] :].split("|>")[0]) for a in one.attachments] == [
        ("image", "a.png", 4 * 2, "<|image 1"),
        ("audio", "b", 26, "<|audio 1"),
        ("document", "c", 512, "<|document 1"),
        ("other", "d", 0, "<|other 2"),
    ]
    assert one.tokens == 8 + 26 + 512
    assert "".join(chat.unescape(one.text[s.begin : s.end]) for s in one.loss) == "ok \\</turn>\n"
    found = {r.conversation: r for r in chat.read_back(chunks).collect()}
    assert found[1].n_turns == 4 and found[None].n_turns == 2
    assert found[None].loss_sha256 == hashlib.sha256(b"firstn").hexdigest()


def test_many_conversations_in_small_chunks(spark):
    r = random.Random(3)
    turns = defaultdict(list)
    rows = []
    for c in range(30):
        for t in range(1 if c else 400):
            who, text = r.choice(["user", "assistant"]), "".join(r.choices(["<", "\\", "\u5b57", "b ", "\n", "</turn>"], k=r.randint(0, 9)))
            turns[c].append((who, text))
            rows.append((c, t, who, [part("text", text)], 0))
    r.shuffle(rows)
    pieces = chat.format_turns(spark.createDataFrame(rows, LAYOUT).repartition(5), "c", "t", "r", "parts")
    chunks = chat.assemble(pieces, chunk=100)
    assert chunks.where("conversation = 0").count() > 5
    found = {x.conversation: x for x in chat.read_back(chunks).collect()}
    for c, list_ in turns.items():
        whole = "".join(f"{who}\n{text}\n" for who, text in list_)
        learned = "".join(text for who, text in list_ if who == "assistant")
        assert found[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert found[c].formatted_chars == sum(len(f"<turn {w}>{chat.escape(t)}</turn>\n") for w, t in list_)


def test_repeated_turns_and_nothing(spark):
    rows = [(1, 0, "user", [part("text", "b")], 0), (1, 0, "user", [part("text", "a")], 0), (1, 0, "user", [part("text", "a")], 0)]
    pieces = chat.format_turns(spark.createDataFrame(rows, LAYOUT), "c", "t", "r", "parts")
    assert chat.read_back(chat.assemble(pieces)).first().turns_sha256 == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    empty = chat.format_turns(spark.createDataFrame([], LAYOUT), "c", "t", "r", "parts")
    assert chat.read_back(chat.assemble(empty)).count() == 0
