r"""Chat formatting that is proven by reading it back.

A turn is written ``<s>[INST]role[/INST]text</s>``. The parser splits at ``</s>``, asks for the
opening and one ``[/INST]`` in each part, refuses any other control string inside a role or
text, and undoes the escapes. Each turn is rendered as it is, parsed, and compared with its
source; if they differ it is rendered at the next level of escaping, until they are identical.
Level 1 breaks control strings and escapes backslashes, level 2 replaces every ``<`` and ``[``.
The whole conversation is parsed again at the end, and the job fails if a turn has changed.

Escapes: ``\e`` is a backslash, ``\l`` is ``<`` and ``\b`` is ``[``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BOS, OPEN, SHUT, EOS = "<s>", "[INST]", "[/INST]", "</s>"
CONTROLS = [BOS, EOS, OPEN, SHUT]
HEAD = BOS + OPEN
ESCAPES = {"\\": "\\e", "<": "\\l", "[": "\\b"}
LOSS_ROLE = "assistant"


def _replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def escape(text: Column, level: int) -> Column:
    if level == 0:
        return text
    broken = [(c, ESCAPES[c[0]] + c[1:]) for c in CONTROLS] if level == 1 else list(ESCAPES.items())[1:]
    return _replaced(text, [("\\", ESCAPES["\\"]), *broken])


def unescape(text: Column) -> Column:
    return _replaced(text, [(ESCAPES[c], c) for c in ("<", "[", "\\")])  # the backslash last


def render_turn(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(HEAD), escape(role, level), F.lit(SHUT), escape(text, level), F.lit(EOS))


def _parsed_turn(part: Column) -> Column:
    """Role and text of what stands before an end mark, null if it isn't in the grammar."""
    body = F.substring(part, len(HEAD) + 1, 2_147_483_647)
    role = F.substring_index(body, SHUT, 1)
    text = F.substring(body, F.char_length(role) + len(SHUT) + 1, F.lit(2_147_483_647))
    stray = reduce(lambda a, b: a | b, [role.contains(c) | text.contains(c) for c in CONTROLS])
    sound = part.startswith(HEAD) & body.contains(SHUT) & ~stray
    return F.when(sound, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation; null where a part isn't in the grammar."""
    parts = F.split(formatted, EOS)
    last = F.size(parts)
    whole = F.element_at(parts, -1) == ""
    return F.when(whole, F.transform(F.slice(parts, F.lit(1), last - 1), _parsed_turn))


def _rendered(role: Column, text: Column) -> Column:
    """A turn at the lowest level that reads back as the source."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    levels = [render_turn(role, text, level) for level in range(3)]
    return F.coalesce(*[F.when(parse(r).eqNullSafe(source), r) for r in levels],
                      F.raise_error(F.lit("a turn can't be rendered")).cast("string"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) from (conv_id, turn, role, text) rows.

    ``loss_spans`` are the code points [start, end) of the assistant's texts, escapes included.
    Null texts and roles are empty. Rows are ordered by turn, nulls first, then by role and text;
    repeated rows are turns like others. A null conv_id is one conversation. Other columns are
    not read. One conversation is one string, so its turns meet in one row.
    """
    order = ["turn", "role", "text"]
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("shown", _rendered(F.col("role"), F.col("text")))
    within = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.char_length("shown")).over(within), F.lit(0))
    rows = rows.withColumn("start", begin + F.instr("shown", SHUT) + len(SHUT) - 1)
    rows = rows.withColumn("end", begin + F.char_length("shown") - len(EOS))
    turn = F.struct(*order, "shown", "start", "end")
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    formatted = grouped.select("conv_id", "t", F.array_join(F.transform(
        "t", lambda x: x["shown"]), "").alias("formatted"))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    loss = F.transform(F.filter("t", lambda x: x["role"] == LOSS_ROLE),
                       lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    same = parse(F.col("formatted")).eqNullSafe(source)
    checked = F.when(same, F.col("formatted")).otherwise(
        F.raise_error(F.lit("a conversation doesn't read back")).cast("string"))
    return formatted.select("conv_id", checked.alias("formatted"), loss.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what the formatted conversations say, from the strings alone."""
    read = formatted.select("conv_id", "formatted", parse(F.col("formatted")).alias("turns"),
                            F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(
                                F.col("formatted"), (s["start"] + 1).cast("int"),
                                (s["end"] - s["start"]).cast("int")))), "").alias("loss"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
