"""Chat formatting with DataFrame functions only: budgeted windows.

Turns are numbered per conversation and cut into segments of at most
``segment`` turns, so that a task never holds more of one conversation than
that.  In a segment, prefix sums of turn tokens choose turn-aligned spans that
fit the budget together with the system turn and as much of the turns before as
the history budget allows.  Each span is formatted with both; what is repeated
carries no loss, so each assistant text is a target once.

Template: system ``<<SYS>>\\n`` text ``\\n<</SYS>>\\n``, user ``[INST] `` text
`` [/INST]``, assistant ``<s>`` text ``</s>``, any other role ``[ROLE]`` role
``[/ROLE]`` text ``[/TURN]``.  In texts and roles a control string gets a
backslash after its first character (one more if it has some already), so none
occurs outside the template, and taking one away restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CONTROL = r"(/?s>|/?INST\]|/?ROLE\]|/TURN\]|<SYS>>|</SYS>>)"
_TURN = (r"(?s)<<SYS>>\n.*?\n<</SYS>>\n|\[INST\] .*? \[/INST\]|<s>.*?</s>"
         r"|\[ROLE\].*?\[/ROLE\].*?\[/TURN\]")
#: Characters of the assistant template before and after the text.
_BEFORE, _AFTER = 3, 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _CONTROL, "$1$2$3")


def tokens_of(text: Column) -> Column:
    """Words and the turn's two marks."""
    return F.size(F.split(text, r"\s+")) + 2


def _turn(role: Column, text: Column) -> Column:
    t = escape(text)
    return (F.when(role == "system", F.concat(F.lit("<<SYS>>\n"), t, F.lit("\n<</SYS>>\n")))
            .when(role == "user", F.concat(F.lit("[INST] "), t, F.lit(" [/INST]")))
            .when(role == "assistant", F.concat(F.lit("<s>"), t, F.lit("</s>")))
            .otherwise(F.concat(F.lit("[ROLE]"), escape(role), F.lit("[/ROLE]"), t, F.lit("[/TURN]"))))


def _role_of(turn: Column) -> Column:
    return (F.when(turn.startswith("<<SYS>>"), F.lit("system")).when(turn.startswith("[INST]"), F.lit("user"))
            .when(turn.startswith("<s>"), F.lit("assistant"))
            .otherwise(unescape(F.regexp_extract(turn, r"(?s)^\[ROLE\](.*?)\[/ROLE\]", 1))))


def _text_of(turn: Column) -> Column:
    def inner(before: int, after: int) -> Column:
        return turn.substr(F.lit(before + 1), F.length(turn) - before - after)
    return unescape(
        F.when(turn.startswith("<<SYS>>"), inner(8, 10)).when(turn.startswith("[INST]"), inner(7, 8))
        .when(turn.startswith("<s>"), inner(_BEFORE, _AFTER))
        .otherwise(F.regexp_extract(turn, r"(?s)^\[ROLE\].*?\[/ROLE\](.*)\[/TURN\]$", 1)))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that the optimizer doesn't copy into each of its uses."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", budget: int = 512, history: int = 128, segment: int = 1024) -> DataFrame:
    """Windows of the conversations, in order.

    Returns ``conv_id, segment, window, formatted, n_context`` (turns repeated
    before the new ones: the system turn and history), ``n_new, n_tokens`` and
    ``loss`` (``start, length`` in code points of ``formatted``, from 1, of each new
    assistant text as escaped).  A window holds new turns up to ``budget`` tokens less
    those of the system turn and history, and one turn at least, so that only a turn
    that is too long by itself exceeds the budget; turns are never cut.  The
    system turn is a conversation's first turn if its role is ``system``; history
    stays within a segment.

    Null text or role: empty.  Turns are ordered by turn (null first), role, text;
    repeated rows stay, as turns of their own.  Rows with a null conversation are
    one conversation.  Other columns are ignored, whatever their names; an empty
    table gives an empty result.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("at", F.row_number().over(order))
    first = F.when((F.col("at") == 1) & (F.col("role") == "system"), F.struct("role", "text"))
    rows = (rows.withColumn("system", F.first(first, ignorenulls=True).over(Window.partitionBy("conv_id").orderBy("at")))
            .withColumn("segment", F.floor((F.col("at") - 1) / segment)))
    rows = rows.groupBy("conv_id", "segment").agg(
        F.array_sort(F.collect_list(F.struct(
            "at", _turn(F.col("role"), F.col("text")).alias("turn"), tokens_of(F.col("text")).alias("n"),
            (F.col("role") == "assistant").alias("target")))).alias("turns"),
        F.first("system", ignorenulls=True).alias("system"))
    rows = _once(rows, "opening", F.when(F.col("system").isNotNull(), _turn(F.col("system.role"), F.col("system.text"))))
    rows = rows.withColumn("held", F.coalesce(tokens_of(F.col("system.text")), F.lit(0)))
    # prefix sums: sums[i] is the tokens of the first i turns
    rows = _once(rows, "sums", F.expr(
        "aggregate(turns, array(0), (a, t) -> concat(a, array(element_at(a, -1) + t.n)))"))
    # a turn opens a window if it no longer fits the one before it, whose history begins after `past` turns
    past = f"size(filter(sums, s -> s < sums[i - 1] - {history}))"
    rows = _once(rows, "cuts", F.expr(
        f"""aggregate(sequence(1, size(turns)), array(named_struct('start', 0, 'past', 0)), (a, i) -> IF(i > 1 AND
            sums[i] - sums[element_at(a, -1).past]
            + IF(segment = 0 AND element_at(a, -1).past = 0, 0, held) > {budget},
            concat(a, array(named_struct('start', i - 1, 'past', {past}))), a))"""))
    rows = rows.select("conv_id", "segment", "turns", "opening", "sums", "held", "cuts",
                       F.posexplode("cuts").alias("window", "cut"))
    rows = (rows.withColumn("stop", F.expr("coalesce(get(cuts, window + 1).start, size(turns))"))
            .withColumn("start", F.col("cut.start")).withColumn("past", F.col("cut.past"))
            # the conversation's first turns hold the system turn themselves
            .withColumn("opens", F.expr("opening IS NOT NULL AND NOT (segment = 0 AND past = 0)")))
    rows = _once(rows, "context", F.expr(
        "concat(IF(opens, array(opening), array()), transform(slice(turns, past + 1, start - past), t -> t.turn))"))
    rows = _once(rows, "new", F.expr("slice(turns, start + 1, stop - start)"))
    rows = _once(rows, "before", F.length(F.array_join("context", "")))
    return rows.select(
        "conv_id", "segment", "window",
        F.concat(F.array_join("context", ""), F.expr("array_join(transform(new, t -> t.turn), '')")).alias("formatted"),
        F.size("context").alias("n_context"), F.size("new").alias("n_new"),
        F.expr("sums[stop] - sums[past] + IF(opens, held, 0)").alias("n_tokens"),
        F.expr(f"""transform(filter(aggregate(new,
            named_struct('at', before, 'spans', CAST(array() AS array<struct<start: int, length: int, target: boolean>>)),
            (a, t) -> named_struct('at', a.at + length(t.turn), 'spans', concat(a.spans, array(named_struct(
                'start', a.at + {_BEFORE + 1}, 'length', length(t.turn) - {_BEFORE + _AFTER}, 'target', t.target))))
            ).spans, s -> s.target), s -> named_struct('start', s.start, 'length', s.length))""").alias("loss"))


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows hold, per conversation: ``conv_id, n_turns, turns`` (each
    new turn's role, line break, text, line break), ``loss`` (all text under
    the loss masks) and ``formatted_chars``.  Reads the formatted text only."""
    turns = F.regexp_extract_all(F.col("formatted"), F.lit(_TURN), F.lit(0))
    new = F.slice(turns, F.col("n_context") + 1, F.greatest(F.size(turns) - F.col("n_context"), F.lit(0)))
    rows = _once(windows, "new", new).select(
        "conv_id", "segment", "window", F.size("new").alias("n"),
        F.array_join(F.transform("new", lambda t: F.concat(_role_of(t), F.lit("\n"), _text_of(t), F.lit("\n"))), "").alias("turns"),
        F.array_join(F.transform("loss", lambda s: unescape(
            F.col("formatted").substr(s["start"], s["length"]))), "").alias("loss"),
        F.length("formatted").alias("chars"))
    part = F.array_sort(F.collect_list(F.struct("segment", "window", "turns", "loss")))
    return (rows.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), part.alias("parts"),
                                        F.sum("chars").cast("long").alias("formatted_chars"))
            .select("conv_id", "n_turns", F.array_join("parts.turns", "").alias("turns"),
                    F.array_join("parts.loss", "").alias("loss"), "formatted_chars"))
