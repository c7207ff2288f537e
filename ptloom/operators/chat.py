"""Chat records: long form ↔ records, prompt-only records, template rendering (P-15 .. P-19, V-22)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ptloom import constants as K


def turns_to_records(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                     role_col: str = "role", text_col: str = "text") -> DataFrame:
    """P-15: one record per conversation with messages ordered by turn.

    A record is one conversation, so the group is the output row itself;
    statistics that do not need the record (validation counts, lengths) are
    computed on the long form instead.
    """
    return turns.groupBy(conv_col).agg(
        F.sort_array(F.collect_list(F.struct(turn_col, role_col, text_col))).alias("_t")
    ).select(
        conv_col,
        F.transform("_t", lambda x: F.struct(x[role_col].alias("role"), x[text_col].alias("content"))).alias("messages"),
    )


def records_to_turns(records: DataFrame, id_col: str = "conv_id", messages_col: str = "messages") -> DataFrame:
    """P-16: messages → one row per turn (``posexplode``)."""
    return records.select(id_col, F.posexplode(messages_col).alias("turn", "m")).select(
        id_col, F.col("turn").cast("bigint").alias("turn"), F.col("m.role").alias("role"), F.col("m.content").alias("text")
    )


def prompt_only(messages: Column) -> Column:
    """P-17: drop the assistant tail — keep messages before the last assistant turn.

    A conversation without an assistant turn is kept whole.
    """
    idx = F.transform(messages, lambda m, i: F.when(m["role"] == "assistant", i + 1))
    last_asst = F.array_max(F.filter(idx, lambda x: x.isNotNull()))
    return F.when(last_asst.isNull(), messages).otherwise(F.slice(messages, 1, last_asst - 1))


def render(messages: Column, add_generation_prompt: bool = False,
           pre: str = K.CHATML_PRE, mid: str = "\n", post: str = K.CHATML_POST,
           generation_prompt: str = K.CHATML_GENERATION_PROMPT) -> Column:
    """P-18: chat template rendering; template strings are parameters (ChatML default)."""
    body = F.array_join(
        F.transform(messages, lambda m: F.concat(F.lit(pre), m["role"], F.lit(mid), m["content"], F.lit(post))), ""
    )
    return F.concat(body, F.lit(generation_prompt)) if add_generation_prompt else body


def render_turn(role: Column, content: Column, pre: str = K.CHATML_PRE, mid: str = "\n",
                post: str = K.CHATML_POST) -> Column:
    """The rendered piece of one turn; concatenated in turn order it equals ``render``."""
    return F.concat(F.lit(pre), role, F.lit(mid), content, F.lit(post))
