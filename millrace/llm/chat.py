"""Chat formatting: conversations to one training string each, with a loss mask, and back.

The template, in the order of the turns:

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n<|im_start|>ROLE\\n...

Adjacent turns of one role share a block, their texts set apart by <|im_sep|>, so that reading back
finds every turn again. In roles and texts a backslash is doubled and `<|` becomes `<\\|`, hence no
marker can come from a text; a line feed in a role becomes <|nl|>.

Defined cases: a null role or text is empty; turns are ordered by turn (null first), then role, then
text; repeated rows are turns of their own; rows without a conversation id form one conversation; an
empty table gives no rows; other columns are ignored.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, once, running

START, END, SEP, LINE = "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|nl|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Undoes `escape`: only an inserted backslash stands alone between `<` and `|`."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, `formatted`, and `loss_spans`, the code points under the loss mask.

    A span is one assistant text, end exclusive. One shuffle by conversation; a conversation is one row of
    the result, so its turns do meet in one task.
    """
    own_role = F.replace(escape(F.coalesce(F.col(role), F.lit(""))), F.lit("\n"), F.lit(LINE))
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            own_role.alias("role"),
            escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        """What stands before the turn's text, and the text; a turn of the same role goes on in its block."""
        merged = (i > 0) & (F.get("turns", i - 1)["role"] == t["role"])
        opened = F.concat(F.when(i > 0, f"{END}\n").otherwise(""), F.lit(START), t["role"], F.lit("\n"))
        return F.struct(F.when(merged, SEP).otherwise(opened).alias("before"), t["text"].alias("text"), t["role"].alias("role"))

    pieces = sorted_turns.select("conv_id", F.transform("turns", piece).alias("pieces"))

    ends = running(F.transform("pieces", lambda p: F.length(p["before"]) + F.length(p["text"])), F.lit(0), lambda a, b: a + b)

    def spans(known: Column) -> Column:
        def span(p: Column, i: Column) -> Column:
            start = F.get(known["ends"], i) + F.length(p["before"])
            end = F.get(known["ends"], i + 1)
            return F.when(p["role"] == LOSS_ROLE, F.struct(start.alias("start"), end.alias("end")))

        return F.array_compact(F.transform(known["pieces"], span))

    formatted = F.concat(
        F.array_join(F.transform("pieces", lambda p: F.concat(p["before"], p["text"])), ""), F.lit(f"{END}\n")
    )
    return pieces.select(
        "conv_id",
        formatted.alias("formatted"),
        once(F.struct(F.col("pieces").alias("pieces"), ends.alias("ends")), spans).alias("loss_spans"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Read formatted conversations back: `turns` (role, text) and `loss_texts`, both unescaped, in order."""
    opened = F.split("formatted", r"<\|im_start\|>")
    blocks = F.slice(opened, F.lit(2), F.size(opened))

    def turns_of(block: Column) -> Column:
        cut = F.locate("\n", block)
        role = unescape(F.replace(F.substring(block, F.lit(1), cut - 1), F.lit(LINE), F.lit("\n")))
        body = F.substring(block, cut + 1, F.length(block) - cut - len(f"{END}\n"))
        return F.transform(
            F.split(body, r"<\|im_sep\|>", -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    loss_texts = cut(
        F.col("formatted"),
        lambda between: F.transform("loss_spans", lambda s: unescape(between(s["start"], s["end"]))),
    )
    return chats.select(
        "conv_id",
        "formatted",
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        loss_texts.alias("loss_texts"),
    )
