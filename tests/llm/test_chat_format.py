import hashlib
import random

from silverline.llm.chat_format import format_conversations, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"


def want(rows):
    convs = {}
    for r in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = {}
    for i, turns in convs.items():
        said = "".join(t for r, t in turns if r == "assistant")
        out[i] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def rows():
    rnd = random.Random(3)
    parts = ["</s>", "<|user|>", "<", "|", "/", "\\", "<\\|", "<\\\\/", "é", "😀", "\n", "[INST]", " ok ", "|>", "%7C", "<|"]
    text = lambda: rnd.choice([None, "", *["".join(rnd.choices(parts, k=rnd.randint(1, 12))) for _ in range(6)]])
    out = [(c, t, rnd.choice(["user", "assistant", "system", None, "a|b>\n%<"]), text()) for c in range(80) for t in range(rnd.randint(1, 9))]
    out += [(None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (7, 0, "user", "tie"), (7, 0, "assistant", "tie"), (7, 0, "assistant", "tie")]
    return out + [(200, t, "assistant" if t % 2 else "user", f"long </s> {t} " * 300) for t in range(400)]


def test_round_trip_in_one_part_and_in_many(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    for options in ({}, {"part_bytes": 4000}):
        formatted = format_conversations(df, **options)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in read_back(formatted).collect()}
        assert got == want(data)
    assert max(r.part for r in formatted.collect()) > 0


def test_the_mask_and_the_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "é </s>"), (1, 1, "assistant", "ja <|user|>")], SCHEMA)
    row = format_conversations(df).first()
    assert row.formatted == "<|user|>\né <\\/s></s>\n<|assistant|>\nja <\\|user|></s>\n"
    (span,) = row.loss_mask
    assert unescape(row.formatted[span.start:span.end].encode()).decode() == "ja <|user|>"


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert format_conversations(empty).collect() == [] and read_back(format_conversations(empty)).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "x", 5, "p")], SCHEMA + ", id int, part string")
    assert read_back(format_conversations(df)).first().n_turns == 1
