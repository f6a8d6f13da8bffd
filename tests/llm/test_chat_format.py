import hashlib

from quarryline.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def check(spark, convs, **kw):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    got = {r.conv_id: r for r in cf.read_back(cf.format_conversations(spark.createDataFrame(rows, SCHEMA), **kw)).collect()}
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns = [(r or "", t or "") for r, t in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), digest(turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_round_trip_of_control_strings_nulls_and_long_turns(spark):
    hard = "</s>[INST] ok [/INST]"
    convs = {
        -7: [("user", hard), ("assistant", hard)],
        1: [("system", "<<SYS>>\\<s>"), ("user", "x" * 9000), ("assistant", None), ("user", ""), ("assistant", "\\<|im_end|>\n\\")],
        2: [(None, None)],
        3: [("as%0A<\nx", "a"), ("assistant", "é🙂<<s>"), ("assistant", "é🙂<<s>")],
        4: [("user", "u" * 50), ("assistant", "a" * 50)] * 40,
    }
    check(spark, convs)
    check(spark, convs, budget=40, history=30)


def test_windows_keep_the_system_turn_and_mask_repeats(spark):
    rows = [(1, i, r, f"{i}" * 40) for i, r in enumerate(["system"] + ["user", "assistant"] * 4)]
    out = cf.format_conversations(spark.createDataFrame(rows, SCHEMA), budget=75, history=20).orderBy("stretch", "window").collect()
    assert len(out) > 2
    for w in out[1:]:
        assert w.text.startswith("<|im_start|>system\n") and w.n_repeated >= 1
    masked = "".join(w.text[s.start : s.start + s.length] for w in out for s in w.loss)
    assert masked == "".join(f"{i}" * 40 for i in range(2, 9, 2))


def test_long_conversations_in_stretches(spark):
    """The same digests whatever the stretches; every window keeps to the budget, later ones begin with the system turn and history."""
    turns = [("system", "be brief")] + [("assistant" if i % 2 else "user", f"{i} " * (i % 9)) for i in range(150)]
    convs = {1: turns, 2: turns[1:60], 3: [("user", "x")] * 40}
    for stretch, crowd in ((16, 4096), (7, 4096), (16, 20), (1024, 4096)):
        check(spark, convs, stretch=stretch, crowd=crowd, budget=60, history=24)
    rows = [(c, i, r, t) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    rows += [(4, 1000 * i, "user", f"{i}") for i in range(5)] + [(5, -3 + i, "assistant", "neg") for i in range(9)]
    out = cf.format_conversations(spark.createDataFrame(rows, SCHEMA), budget=60, history=24, stretch=16).collect()
    for w in out:
        parts = w.text.split("<|im_end|>\n")[:-1]
        used = sum(-(-len(p.split("\n", 1)[1]) // 4) + 4 for p in parts)
        assert used <= 60 or len(parts) - w.n_repeated == 1
    first = {c: min((w.stretch, w.window) for w in out if w.conv_id == c) for c in range(1, 6)}
    later = [w for w in out if w.conv_id == 1 and (w.stretch, w.window) != first[1]]
    assert all(w.text.startswith("<|im_start|>system\nbe brief<|im_end|>\n") and w.n_repeated >= 2 for w in later)
    assert all(w.n_repeated == 0 for w in out if w.conv_id != 4 and (w.stretch, w.window) == first[w.conv_id])


def test_ties_null_turns_repeats_and_rows_without_conversation(spark):
    rows = [(1, 2, "user", "b"), (1, 2, "user", "a"), (1, None, "assistant", "first"), (1, 2, "user", "a")]
    rows += [(None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "assistant", "z")]
    want = [("assistant", "first"), ("user", "a"), ("user", "a"), ("user", "b")]
    for crowd in (4096, 2):
        got = cf.read_back(cf.format_conversations(spark.createDataFrame(rows, SCHEMA), crowd=crowd)).collect()
        assert [r.turns_sha256 for r in got if r.conv_id == 1] == [digest(want)]
        assert sorted(r.turns_sha256 for r in got if r.conv_id is None) == sorted([digest([("user", "alone")])] * 2 + [digest([("assistant", "z")])])


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", turns string, window int, alone string, at int")
    assert cf.read_back(cf.format_conversations(df)).collect() == []
    one = spark.createDataFrame([(1, 0, "user", "x", "y", "z")], SCHEMA + ", at string, stretch string")
    assert cf.read_back(cf.format_conversations(one)).first().n_turns == 1
