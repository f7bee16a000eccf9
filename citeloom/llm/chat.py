"""Chat formatting in budgeted windows, in DataFrame functions only.

A turn is written as `<turn ROLE>`, a line feed, its escaped text, `</turn>` and a line feed.  In roles and texts `\\`,
`<` and `>` become `\\b`, `\\l` and `\\g`, so no control string can occur in them, and the way back is exact.

Prefix sums of turn tokens place each turn on a line; the line is cut at multiples of a step, and the turns between two
cuts, or a turn across a cut, are a span.  A window is the conversation's system turn, whole turns of limited history
before the span, and the span.  Only assistant texts of the span are under the loss mask: a repeated target is masked.
Windows are bounded by the budget unless one turn is longer, so nothing is grouped without a bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.llm.common import materialize

#: Tokens of a window and of the history repeated in it; the least step; tokens that a turn costs beside its text.
BUDGET, HISTORY, LEAST_STEP, OVERHEAD = 512, 128, 128, 4
#: Turn numbers in one block of the prefix sums.
BLOCK = 256
SYSTEM, ASSISTANT = "system", "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def turn_tokens(text: Column) -> Column:
    """Runs of letters or digits and single other signs, and what a turn costs beside."""
    return F.regexp_count(text, F.lit(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]")) + OVERHEAD


def _prefix_sums(turns: DataFrame) -> DataFrame:
    """turns with `before`, the tokens of the conversation's earlier turns, and sys_tokens, those of its system turn if any.

    A conversation is summed by blocks of turn numbers, so a long one is not ordered as a whole.
    """
    turns = turns.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 60))))
    block = Window.partitionBy("conv_id", "block")
    ordered = block.orderBy("turn", "role", "text")
    turns = turns.withColumns({
        "inner": F.coalesce(F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "place": F.row_number().over(ordered)})
    opens = F.col("place") == 1
    blocks = turns.groupBy("conv_id", "block").agg(F.sum("tokens").alias("sum"), F.max(F.when(opens, F.col("role") == SYSTEM)).alias("system"), F.max(F.when(opens, F.col("tokens"))).alias("first"))
    conversation = Window.partitionBy("conv_id").orderBy("block")
    earlier = conversation.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"),
        F.first(F.when(F.col("system"), F.col("first"))).over(conversation).alias("sys_tokens"))
    both = turns.join(blocks, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")))
    return both.select("conv_id", "role", "text", "tokens", "sys_tokens", (F.col("base") + F.col("inner")).alias("before"))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each window: conv_id, window, n_repeated, formatted, loss (start and end code points, ascending).

    The first n_repeated turns of a window are repeated from earlier ones and never under the loss mask.  Turns are in
    the order of their numbers, nulls first, then role and text; equal rows are separate turns.  The first turn is the
    system turn if its role says so.  Null roles and texts count as empty, and rows without a conversation are one
    conversation.  An empty table gives no rows; further columns are not read.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # turns in their places are written once, as spans, histories and system turns all read them
    turns = materialize(_prefix_sums(turns.withColumn("tokens", turn_tokens(F.col("text")))), "chat-turns")
    # the first turn of a conversation stands at 0, and no other does, as each turn has tokens
    is_system = (F.col("before") == 0) & F.col("sys_tokens").isNotNull()
    start = F.col("before") - F.coalesce("sys_tokens", F.lit(0))
    step = F.greatest(F.lit(budget - history) - F.coalesce("sys_tokens", F.lit(0)), F.lit(LEAST_STEP))
    first, last = F.floor(start / step), F.floor((start + F.col("tokens") - 1) / step)
    rest = turns.where(~is_system).select("conv_id", start.alias("start"), "tokens", "role", "text", (first * 2 + (first != last).cast("long")).alias("window"))
    spans = rest.groupBy("conv_id", "window").agg(F.min("start").alias("at"))
    # history: a turn reaches windows that start within the limit after it, which lie in two cells of the line at most
    cells = F.when(F.col("tokens") <= history, F.sequence(F.floor((F.col("start") + F.col("tokens")) / history), F.floor((F.col("start") + history) / history)))
    past = rest.select(F.col("conv_id").alias("_c"), "start", "tokens", "role", "text", F.col("window").alias("own"), F.explode(cells).alias("_cell"))
    near = spans.withColumn("cell", F.floor(F.col("at") / history))
    repeated = near.join(past, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("cell") == F.col("_cell")))
    repeated = repeated.where((F.col("own") < F.col("window")) & (F.col("start") + F.col("tokens") <= F.col("at")) & (F.col("at") - F.col("start") <= history))
    # the system turn: new in the conversation's first window, which starts the line, and repeated in the others
    system = turns.where(is_system).select(F.col("conv_id").alias("_conv"), "role", "text")
    heads = system.join(spans, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    heads = heads.select(F.col("_conv").alias("conv_id"), F.coalesce("window", F.lit(0)).alias("window"), F.lit(-1).cast("long").alias("start"), F.coalesce(F.col("at") != 0, F.lit(False)).alias("again"), "role", "text")
    columns = ["conv_id", "window", "start", "again", "role", "text"]
    placed = rest.withColumn("again", F.lit(False)).select(columns).union(repeated.withColumn("again", F.lit(True)).select(columns)).union(heads.select(columns))

    header = F.concat(F.lit("<turn "), escape(F.col("role")), F.lit(">\n"))
    body = escape(F.col("text"))
    placed = placed.withColumns({"header": header, "body": body})
    written = placed.withColumn("piece", F.concat("header", "body", F.lit("</turn>\n")))
    inside = Window.partitionBy("conv_id", "window").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    written = written.withColumn("offset", F.coalesce(F.sum(F.length("piece")).over(inside), F.lit(0)) + F.length("header"))
    target = (F.col("role") == ASSISTANT) & ~F.col("again")
    span = F.when(target, F.struct(F.col("offset").alias("start"), (F.col("offset") + F.length("body")).alias("end")))
    grouped = written.groupBy("conv_id", "window").agg(
        F.sum(F.col("again").cast("long")).alias("n_repeated"),
        F.array_sort(F.collect_list(F.struct("start", "piece"))).alias("pieces"), F.array_sort(F.collect_list(span)).alias("loss"))
    return grouped.select("conv_id", "window", "n_repeated", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss")


def _turns_of(piece: Column) -> Column:
    """struct(role, text) of a turn as it is written, without its closing mark."""
    role, text = F.regexp_extract(piece, r"(?s)^<turn ([^>]*)>\n", 1), F.regexp_replace(piece, r"(?s)^<turn [^>]*>\n", "")
    return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))


def _new_pieces() -> Column:
    """The turns of a window as they are written, repeated ones left out."""
    pieces = F.split("formatted", "</turn>\n")
    return F.slice(pieces, F.col("n_repeated") + 1, F.size(pieces) - 1 - F.col("n_repeated"))


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, window, position, role, text) of the turns of the windows' outputs, repeated ones left out."""
    turns = windows.select("conv_id", "window", F.posexplode(F.transform(_new_pieces(), _turns_of)).alias("position", "t"))
    return turns.select("conv_id", "window", "position", "t.role", "t.text")


def conversation_digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from the windows.

    A digest of a whole conversation needs its text in one row; only here does a group grow with a conversation.
    """
    masked = F.transform("loss", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    turns = F.transform(_new_pieces(), lambda p: F.transform(F.array(_turns_of(p)), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))[0])
    own = windows.select("conv_id", F.length("formatted").cast("long").alias("chars"), F.size(turns).cast("long").alias("n"), F.struct("window", F.array_join(turns, "").alias("turns"), unescape(F.array_join(masked, "")).alias("loss")).alias("w"))
    whole = own.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("w")).alias("ws"))
    whole = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join("ws.turns", "").alias("turns"), F.array_join("ws.loss", "").alias("loss_text"))
    return whole.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
