"""Chat formatting: a finite-state machine over roles, and text segments with loss flags from a template.

DataFrame functions only. A conversation's turns are sorted by turn (then role and text) and folded
through the template's table of moves; the result says whether the order of roles is valid. Every
conversation is formatted, valid or not.

Control strings of a template start with ``<|``. In roles and texts a backslash goes after the ``<``
and any backslashes that stand before a ``|``, so that no ``<|`` is left in them; one backslash less
gives the text back. The output has one row a conversation: segments in order, each with its text and
loss flag. ``parse`` reads turns back from the joined text alone, and the mask from the flags.

Defined results: null text and null role are empty text; a null turn sorts first; repeated rows and
equal turns are turns of their own; rows of a null conv_id form one conversation; an empty table gives
no rows. Other columns of the table are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchcredit.llm.common import cut, table

#: Marks around a turn, the roles whose text is trained on, and the moves of the machine.
TEMPLATE = {
    "turn": "<|turn|>",
    "text": "<|text|>\n",
    "end": "<|end|>\n",
    "loss": ["assistant"],
    "start": "start",
    "moves": {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user",
    },
    "final": ["assistant"],
}
SEGMENT = "array<struct<text:string,loss:boolean>>"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<$1\\|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\\\|", r"<$1|")


def final_state(roles: Column, template: dict = TEMPLATE) -> Column:
    """The machine's state after all roles; ``error`` once a move is not in the table."""
    def step(state: Column, role: Column) -> Column:
        to = F.lit("error")
        for (was, said), then in template["moves"].items():
            to = F.when((state == was) & (role == said), F.lit(then)).otherwise(to)
        return to

    return F.aggregate(roles, F.lit(template["start"]), step)


def format_conversations(rows: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """conv_id, valid, segments (array of text and loss) from rows (conv_id, turn, role, text)."""
    for k in ("turn", "text", "end"):
        if not template[k].startswith("<|"):
            raise ValueError(f"the control string {template[k]!r} must start with <|")
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def segments(t: Column) -> Column:
        head = F.concat(F.lit(template["turn"]), escape(t["role"]), F.lit(template["text"]))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(template["loss"]).alias("loss")),
            F.struct(F.lit(template["end"]).alias("text"), F.lit(False).alias("loss")))

    state = final_state(F.transform("turns", lambda t: t["role"]), template)
    return convs.select("conv_id", state.isin(template["final"]).alias("valid"),
                        F.flatten(F.transform("turns", segments)).cast(SEGMENT).alias("segments"))


def parse(formatted: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """conv_id, formatted, turns (role and text, unescaped) and loss_text, from the written segments."""
    whole = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    split = F.split(F.col("formatted"), _literal(template["turn"]))
    pieces = F.slice(split, F.lit(2), F.size(split) - 1)

    def turn(p: Column) -> Column:
        role = F.substring_index(p, template["text"], 1)
        body = F.substr(p, F.length(role) + F.lit(len(template["text"]) + 1))
        body = F.substr(body, F.lit(1), F.length(body) - F.lit(len(template["end"])))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    return (formatted.withColumn("formatted", whole)
            .select("conv_id", "valid", "formatted", F.transform(pieces, turn).alias("turns"),
                    F.array_join(loss, "").alias("loss_text")))


def _literal(s: str) -> str:
    return "".join("\\" + c if c in r"\|()[]{}^$*+?." else c for c in s)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and -7, formatted, written, read back and digested."""
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    back = parse(cut(format_conversations(rows)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


OP9_SQL = r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o as (select *, lag(role, 1, 'start') over (partition by conv_id order by turn nulls first, role, text) was,
    row_number() over (partition by conv_id order by turn desc nulls last, role desc, text desc) back from c)
select conv_id, count(*)::bigint n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) turns_sha256,
    length(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), ''))::bigint loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) loss_sha256,
    sum(8 + 9 + 8 + length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g'))
        + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::bigint formatted_chars,
    bool_and(was || '>' || role in ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user'))
        and bool_or(back = 1 and role = 'assistant') "valid"
from o group by conv_id
"""
