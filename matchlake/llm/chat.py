"""Conversations to training strings with a loss mask, with Spark expressions only, and back again.

One conversation becomes one string::

    <|start|>ROLE<|message|>TEXT<|turn|>TEXT<|end|>

followed by a line feed for each block. A block holds adjacent turns of one role; ``<|turn|>`` parts them, so merging
loses nothing. Inside roles and texts a backslash is put behind every ``<`` or ``[`` that could begin a control string
(the template's own, or ``</s>``, ``[INST]`` and the like); taking one backslash away behind each undoes it.

A conversation is one output row by definition, so its turns meet in one row; nothing larger than that is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MESSAGE, TURN, END = "<|start|>", "<|message|>", "<|turn|>", "<|end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Break up everything in ``text`` that could be read as a control string."""
    return F.regexp_replace(text, r"([<\[])([|/sSI\\])", r"$1\\$2")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(text, r"([<\[])\\", "$1")


def _piece(text: Column, loss: Column) -> Column:
    return F.struct(text.alias("text"), loss.alias("loss"))


def format_conversations(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_runs``.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns are ignored. ``loss_runs`` is the loss
    mask in run lengths: an array of (n, loss) over the code points of ``formatted``, each text of ``trained_role`` one
    run. NULL roles and texts are empty. Turns are sorted by turn (NULL first), then role and text, so repeated turns
    all stay, in a fixed order. Rows without ``conv_id`` form one conversation. No rows give no rows.
    """
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))

    def pieces(turn: Column, i: Column) -> Column:
        """The pieces a turn adds: a block's opening or a parting mark, its text, and the block's end."""
        first = (i == 0) | (F.get("turns", i - 1)["role"] != turn["role"])
        last = (i == F.size("turns") - 1) | (F.get("turns", i + 1)["role"] != turn["role"])
        head = F.when(first, F.concat(F.lit(START), escape(turn["role"]), F.lit(MESSAGE))).otherwise(F.lit(TURN))
        tail = F.when(last, F.lit(END)).otherwise(F.lit(""))
        return F.array(
            _piece(head, F.lit(False)), _piece(escape(turn["text"]), turn["role"] == trained_role), _piece(tail, F.lit(False)),
        )

    parts = sorted_turns.select("conv_id", F.flatten(F.transform("turns", pieces)).alias("parts"))
    return parts.select(
        "conv_id",
        F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("formatted"),
        F.transform("parts", lambda p: F.struct(F.length(p["text"]).cast("long").alias("n"), p["loss"].alias("loss"))).alias("loss_runs"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The turns inside each ``formatted`` string: ``conv_id``, ``blocks`` (role, texts) and ``formatted``, ``loss_runs``."""
    blocks = F.slice(F.split("formatted", r"<\|end\|>\n", -1), 1, F.size(F.split("formatted", r"<\|end\|>\n", -1)) - 1)

    def block(text: Column) -> Column:
        halves = F.split(F.substr(text, F.lit(len(START) + 1)), r"<\|message\|>", 2)
        return F.struct(
            unescape(halves[0]).alias("role"),
            F.transform(F.split(halves[1], r"<\|turn\|>", -1), unescape).alias("texts"),
        )

    return formatted.select("conv_id", "formatted", "loss_runs", F.transform(blocks, block).alias("blocks"))


def digest(formatted: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """What the formatted strings say, read back from them.

    ``conv_id``, ``n_turns``, ``n_blocks``, ``turns_sha256`` (over role, line feed, text, line feed of each turn),
    ``loss_chars`` and ``loss_sha256`` (of all unescaped text under the loss mask), ``mask_chars`` (code points the mask
    marks in the string itself) and ``formatted_chars``.
    """
    read = read_back(formatted)

    def as_text(block: Column) -> Column:
        return F.array_join(F.transform(block["texts"], lambda t: F.concat(block["role"], F.lit("\n"), t, F.lit("\n"))), "")

    learned = F.flatten(F.transform(F.filter("blocks", lambda b: b["role"] == trained_role), lambda b: b["texts"]))
    zero = F.lit(0).cast("long")
    return read.select(
        "conv_id", "blocks", "formatted", "loss_runs",
        F.array_join(F.transform("blocks", as_text), "").alias("told"), F.array_join(learned, "").alias("learned"),
    ).select(
        "conv_id",
        F.aggregate("blocks", zero, lambda n, b: n + F.size(b["texts"])).alias("n_turns"),
        F.size("blocks").cast("long").alias("n_blocks"),
        F.sha2(F.col("told").cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.aggregate("loss_runs", zero, lambda n, r: n + F.when(r["loss"], r["n"]).otherwise(zero)).alias("mask_chars"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
