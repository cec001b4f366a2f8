import random
from hashlib import sha256

from quillprep.llm.chat import examples, read_back, read_turns


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], "conv_id long, turn long, role string, text string, formatted string, closing string")


def plain(rows):
    out, by = {}, {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        flat = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha256(flat.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rng = random.Random(4)
    bits = ["\\", "#", "###", "####", "</turn>", "</tur", "n>", ": ", ":", "\n", "### assistant: ", "é", "🙂", "ok", "\\\\#", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "system", "a: b", "#\\", None]), "".join(rng.choice(bits) for _ in range(rng.randrange(8)))) for c in range(60) for t in range(rng.randrange(1, 7))]
    rows += [(-1, 1, "user", None), (-2, None, "assistant", "x"), (-2, 0, "assistant", "y"), (None, 0, "user", "q"), (None, 1, "assistant", "a"), (-3, 1, "assistant", "same"), (-3, 1, "assistant", "same")]
    made = examples(conversations(spark, rows))
    got = {r.conv_id: r for r in read_back(made).collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for c, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[c]
    chars = {}
    for e in made.collect():
        assert len(read_turns(e.formatted)) == e.turn
        assert (e.loss_start is None) == e.closing
        chars[e.conv_id] = chars.get(e.conv_id, 0) + len(e.formatted)
    assert chars == {c: r.formatted_chars for c, r in got.items()}


def test_each_reply_is_trained_once(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"), (1, 4, "user", "s")]
    got = sorted((e.turn, e.closing, e.formatted[e.loss_start : e.loss_end] if not e.closing else None) for e in examples(conversations(spark, rows)).collect())
    assert got == [(2, False, "a"), (4, False, "b"), (5, True, None)]


def test_control_strings_are_escaped(spark):
    text = r"\### Assistant: </turn> ok"
    made = examples(conversations(spark, [(-7, 0, "user", text), (-7, 1, "assistant", text)])).collect()
    assert [e.formatted.count("\n### ") for e in made] == [1]
    assert read_turns(made[0].formatted) == [("user", text), ("assistant", text)]


def test_empty(spark):
    assert read_back(examples(conversations(spark, [(1, 0, "user", "a")]).filter("false"))).count() == 0
