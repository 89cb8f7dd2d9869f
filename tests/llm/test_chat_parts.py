import hashlib
import random
from itertools import groupby

import pytest
from mergewell.llm.chat_parts import CLOSE, END, PART, TURN, Flattener, escape, format_turns, parse, read_back, read_parts, unescape

NASTY = ["</s>[INST] ok [/INST]", "", None, "\\", "\\\\<", "<s>[TURN user]\n", END, "]\n", "é😀", "a\\[b", TURN, "\n", "<|image_1|>"]


def brute(rows):
    out = []
    key = lambda r: (r[0] is not None, r[0] or 0)
    size = lambda role, text: len(TURN) + len(escape(role)) + len(CLOSE) + len(escape(text)) + len(END)
    order = lambda r: (key(r), r[1] is not None, r[1] or 0, f"{TURN}{escape(r[2] or '')}{CLOSE}{escape(r[3] or '')}{END}")
    for _, group in groupby(sorted(rows, key=order), key):
        turns = [(c, t, r or "", x or "") for c, t, r, x in group]
        said = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((turns[0][0], len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), sum(size(r, x) for _, _, r, x in turns), 0, 0))
    return sorted(out, key=str)


def test_against_a_loop(spark):
    r = random.Random(2)
    rows = [(r.randint(0, 12), i, r.choice(["user", "assistant", "system", "tool]\n[", "\\", None]), r.choice(NASTY) if r.random() < 0.7 else f"t{i}") for i in range(200)]
    rows += [(50, i, "assistant", f"long {i}") for i in range(900)] + [(None, 1, "assistant", "x"), (51, None, "user", "y"), (52, 1, "user", "b"), (52, 1, "user", "a")]
    r.shuffle(rows)
    frame = spark.createDataFrame([(*x, "z") for x in rows], "conv_id long, turn long, role string, text string, segment string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = read_back(format_turns(frame)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert read_back(format_turns(frame.limit(0))).count() == 0


@pytest.mark.parametrize("text", [t for t in NASTY if t])
def test_escapes(text):
    assert unescape(escape(text)) == text
    assert "<s>" not in escape(text).replace("\\<", "") and parse(f"{TURN}{escape(text)}{CLOSE}{escape(text)}{END}") == (text, text)


def test_parts(spark):
    part = lambda kind, **k: {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **k}
    parts = [part("text", text="See <this>: "), part("image", ref="a.png", width=28, height=15), part(None, text=" and "), part("audio", ref="b.wav", seconds=1.01), part("document", ref="c.pdf", pages=2), part("hologram", ref="d"), None]
    schema = f"conv_id long, turn long, role string, parts array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>"
    row = format_turns(spark.createDataFrame([(1, 0, "assistant", parts)], schema)).first()
    body = "See \\<this>: <|image_1|> and <|audio_2|><|document_3|><|unknown_4|>"
    assert row.segment == f"{TURN}assistant{CLOSE}{body}{END}"
    assert row.segment[row.loss_from : row.loss_to] == body
    assert [(a.kind, a.ref, a.tokens) for a in row.attachments] == [("image", "a.png", 4), ("audio", "b.wav", 26), ("document", "c.pdf", 1200), ("unknown", "d", 1)]
    assert [body[a["at"]:].startswith(f"<|{a.kind}") for a in row.attachments] == [True] * 4 and row.attached_tokens == 1231
    assert format_turns(spark.createDataFrame([(1, 0, "user", None)], schema)).first().segment == f"{TURN}user{CLOSE}{END}"
    f = Flattener()
    f.visit(part("text"))
    assert f.text == [""]


SCHEMA = f"conv_id long, turn long, role string, parts array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>"


def typed(kind, **k):
    return {"type": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **k}


def test_typed_parts_come_back(spark):
    """Random parts through the template and back: texts, references in order, token counts; texts may look like placeholders."""
    r = random.Random(7)
    rows, want = [], {}
    for conv in range(25):
        tokens, said, n, digest = 0, "", 0, hashlib.sha256()
        for turn in range(r.randint(1, 6)):
            role, parts, shown, held = r.choice(["user", "assistant", None]), [], "", 0
            for _ in range(r.randint(0, 7)):
                kind = r.choice(["text", "text", "image", "audio", "document"])
                if kind == "text":
                    parts.append(typed("text", text=r.choice([*NASTY, "<|image_1|>", "<|audio_2|>"])))
                    shown += parts[-1]["text"] or ""
                else:
                    held += 1
                    w, h, s, p = r.randint(1, 400), r.randint(1, 400), r.random() * 30, r.randint(0, 4)
                    parts.append(typed(kind, ref=f"{conv}/{turn}/{held}", width=w, height=h, seconds=s, pages=p))
                    tokens += max(1, {"image": -(-w // 14) * -(-h // 14), "audio": -int(-s * 25 // 1), "document": p * 600}[kind])
                    shown += f"<|{kind}_{held}|>"
            n += held
            digest.update(f"{role or ''}\n{shown}\n".encode())
            said += shown if role == "assistant" else ""
            rows.append((conv, turn, role, parts))
        want[conv] = (digest.hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), n, tokens)
    segments = format_turns(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    by_turn = {(c, t): (role, parts) for c, t, role, parts in rows}
    for s in segments:
        role, parts = by_turn[s.conv_id, s.turn]
        plain = []
        for p in parts:
            if p["type"] != "text":
                plain.append((p["type"], p["ref"]))
            elif p["text"] and plain and plain[-1][0] == "text":
                plain[-1] = ("text", plain[-1][1] + p["text"])
            elif p["text"]:
                plain.append(("text", p["text"]))
        assert read_parts(s.segment, [a.asDict() for a in s.attachments]) == (role or "", plain)
    got = {x.conv_id: (x.turns_sha256, x.loss_chars, x.loss_sha256, x.n_attachments, x.attached_tokens) for x in read_back(format_turns(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == want


def test_placeholders_without_attachments_are_found_out():
    segment = f"{TURN}user{CLOSE}a<|image_1|>b{END}"
    assert read_parts(segment, [{"kind": "image", "ref": "x", "at": 1, "tokens": 1}]) == ("user", [("text", "a"), ("image", "x"), ("text", "b")])
    for wrong in ([], [{"kind": "audio", "ref": "x", "at": 1}], [{"kind": "image", "ref": "x", "at": 0}], [{"kind": "image", "ref": "x", "at": 1}] * 2):
        with pytest.raises(ValueError):
            read_parts(segment, wrong)
    for broken in ("", TURN, f"{TURN}user{CLOSE}", f"{TURN}user{CLOSE}[{END}", f"{TURN}user{CLOSE}<|film_1|>{END}", f"{TURN}us<er{CLOSE}{END}", f"{TURN}u{CLOSE}x{END}y"):
        with pytest.raises(ValueError):
            parse(broken)


def test_very_long_texts(spark):
    text = "[long] \\ text <s> " * 100_000
    rows = [(1, 0, "user", text), (1, 1, "assistant", text)]
    got = read_back(format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
