import hashlib
import random

from pyspark.sql import functions as F

from cargolens.llm.chat_format import escape, format_conversations, parse, read_back, unescape

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING, formatted STRING"
BITS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "\\e", "\\l", "\\b", "<", "[", "/", "s>", "x", "é𝄞",
        "\n", " "]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for conv_id, turn, role, text, _ in rows:
        convs.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv_id, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(text for role, text in turns if role == "assistant")
        out[conv_id] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(6)
    rows = []
    for conv in range(150):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(["user", "assistant", "system", "[/INST]", "", "a\\l"])
            rows.append((conv, turn, role, "".join(rng.choices(BITS, k=rng.randint(0, 12))), "x"))
    rows += [(None, None, None, None, None), (None, 3, "assistant", "a", None), (900, 1, "user", "t", None),
             (900, 1, "user", "t", None), (901, 0, "assistant", "<s>" * 50_000, None)]
    formatted = format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {r["conv_id"]: tuple(r)[1:5] for r in read_back(formatted).collect()}
    assert got == expected(rows)
    for row in formatted.collect():
        for control, extra in (("<s>", 1), ("</s>", 1), ("[INST]", 1), ("[/INST]", 1)):
            assert row["formatted"].count(control) == got[row["conv_id"]][0] * extra


def test_plain_text_is_not_escaped(spark):
    rows = [(1, 0, "user", "a <b> [c] C:\\dir"), (1, 1, "assistant", "fine")]
    row = format_conversations(spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING")).first()
    assert row["formatted"] == "<s>[INST]user[/INST]a <b> [c] C:\\dir</s><s>[INST]assistant[/INST]fine</s>"
    (span,) = row["loss_spans"]
    assert row["formatted"][span["start"]:span["end"]] == "fine"


def test_parser_refuses_what_is_not_in_the_grammar(spark):
    bad = ["<s>[INST]user[/INST]a", "user[/INST]a</s>", "<s>[INST]user</s>", "x<s>[INST]u[/INST]a</s>",
           "<s>[INST]u[/INST]a[INST]</s>", "<s>[INST]u[/INST]a</s>tail"]
    rows = spark.createDataFrame([(t,) for t in bad], "t STRING").select(parse(F.col("t")).alias("p"))
    assert all(r["p"] is None or None in r["p"] for r in rows.collect())


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices(BITS, k=9)) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING")
    for level in (0, 1, 2):
        back = rows.select("t", unescape(escape(F.col("t"), level)).alias("u")).collect()
        assert level == 0 or all(r["t"] == r["u"] for r in back)


def test_no_rows_and_no_python(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = read_back(format_conversations(empty))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
