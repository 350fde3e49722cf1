"""Chat formatting: linking quotations and ordering replies.

Method: a line's quote level is the number of > marks it starts with.  Runs of lines of one
level are passages; a passage's lines are normalised (marks and outer white space gone, white space
runs one blank, lower case) and hashed, and the hashes are joined to the earlier messages of the same
conversation that wrote such lines themselves.  A passage is linked to the message that holds the most of
its lines (at least half), the latest on a tie.  A message replies to the latest
message linked at its lowest quoted level.  Threads are the trees of replies; messages are ordered by
conversation, thread (by its first turn) and turn, so a reply follows what it answers, and their text is left without
quotations and the lines that introduce them.

Scale: only messages with quotations and their conversations' lines are exploded.  Passages of equal lines are
looked up once a conversation.  Messages with all lines are found among the holders of the passage's rarest line;
only passages without such a message join the holders of all their lines.  The latest holder before a turn is a
running maximum, within slabs of turns and over slabs, so a line that everybody writes and quotes makes no pairs.  Roots are found by pointer doubling.  All DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import only, stored

MARKS = r"^(?:[\x20\t]*>)+"
INTRO = r"(?i)^.{0,200}\b(?:wrote|schrieb|escribi(?:ó|o)|a (?:é|e)crit)[\x20\t]*:[\x20\t]*$"


def _normal(line: Column) -> Column:
    bare = F.regexp_replace(line, MARKS, "")
    return F.lower(F.trim(F.regexp_replace(bare, r"[\x20\x09-\x0D]+", " ")))


def _own(text: Column) -> Column:
    """The text without quoted lines and lines that introduce them."""
    def keep(lines: Column) -> Column:
        quoted = lambda x: F.coalesce(x.rlike(MARKS), F.lit(False))
        return F.array_join(F.filter(lines, lambda x, i: ~quoted(x) & ~(x.rlike(INTRO) & quoted(F.get(lines, i + 1)))), "\n")

    return F.when(text.rlike(r"(?m)" + MARKS), F.transform(F.array(F.split(text, "\n")), keep)[0]).otherwise(text)


def _latest(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``asked`` (conv, c1, c2, turn, ...) with ``best``: the greatest {n, source} of ``held`` with a source before the turn."""
    c = ["conv", "c1", "c2"]
    rows = asked.withColumn("best", F.lit(None).cast("struct<n:bigint,source:bigint>")).unionByName(
        held.select(*c, F.col("source").alias("turn"), F.struct("n", "source").alias("best")), allowMissingColumns=True)
    rows = rows.withColumn("slab", F.shiftright("turn", 12))
    run = Window.partitionBy(*c, "slab").orderBy("turn", F.col("best").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = rows.withColumn("near", F.max("best").over(run)).where("best is null").drop("best")
    over = Window.partitionBy(*c).orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    slabs = rows.groupBy(*c, "slab").agg(F.max("best").alias("top")).withColumn("far", F.max("top").over(over)).drop("top")
    return near.join(slabs, [*c, "slab"]).withColumn("best", F.greatest("near", "far")).select(*asked.columns, "best")


def _targets(quoted: DataFrame, holds: DataFrame) -> DataFrame:
    """(conv, turn, level, source) of the passages in ``quoted`` lines, from the holders (conv, h, h2, source) of lines."""
    c, line = ["conv", "c1", "c2"], ["conv", "h", "h2"]
    passages = quoted.groupBy("conv", "turn", "msg", "passage", "level").agg(F.sort_array(F.collect_list(F.struct("h", "h2"))).alias("all"))
    passages = stored(passages.select("*", F.xxhash64("all").alias("c1"), F.xxhash64("all", F.lit(1)).alias("c2")), "passages")
    lines = passages.dropDuplicates(c).select(*c, F.size("all").alias("k"), F.explode("all").alias("l")).groupBy(
        *c, "k", F.col("l.h").alias("h"), F.col("l.h2").alias("h2")).agg(F.count("*").alias("m"))
    lines = stored(lines, "passage-lines")
    counts = holds.groupBy(*line).agg(F.count("*").alias("f"))
    rare = lines.join(counts, line, "left").groupBy(*c).agg(F.min(F.struct(F.coalesce("f", F.lit(0)).alias("f"), "h", "h2")).alias("r"))
    some = rare.select(*c, "r.h", "r.h2").join(holds, line).select(*c, "source")
    sums = [F.sum("m").alias("n"), F.first("k").alias("k")]
    whole = some.join(lines, c).join(holds, [*line, "source"], "left_semi").groupBy(*c, "source").agg(*sums).where("n = k")
    settled = stored(_latest(passages.drop("all"), whole), "settled")
    rest = settled.where("best is null").drop("best")
    part = rest.select(*c).distinct().join(lines, c).join(holds, line).groupBy(*c, "source").agg(*sums).where("n * 2 >= k")
    done = settled.where("best is not null").unionByName(_latest(rest, stored(part, "part-holders")))
    return done.select("conv", "turn", "level", F.col("best.source").alias("source"))


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per message, in reply order: conv, turn, role, own text, quote_depth, n_passages, n_linked, reply_to, thread.

    ``thread`` is the turn of the thread's first message.  Null texts stay null and quote nothing; messages with a null
    conversation or turn are never linked and have a null thread; messages that repeat a turn
    share its links.  An empty table gives an empty result.  Extra columns are not read.
    """
    m = only(messages, conv_col, turn_col, role_col, text_col).toDF("conv", "turn", "role", "text")
    m = m.withColumns({"conv": F.col("conv").cast("long"), "turn": F.col("turn").cast("long")})
    has = F.coalesce(F.col("text").rlike(r"(?m)" + MARKS), F.lit(False))
    keyed = m.where("conv is not null and turn is not null")
    lines = keyed.where(has).distinct().select("conv", "turn", F.xxhash64("text").alias("msg"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    level = F.length(F.regexp_replace(F.regexp_extract("line", "(" + MARKS + ")", 1), "[^>]", ""))
    lines = lines.withColumn("level", level)
    order = Window.partitionBy("conv", "turn", "msg").orderBy("pos")  # one message
    lines = lines.withColumn("new", (F.col("level") != F.coalesce(F.lag("level").over(order), F.lit(-1))).cast("int"))
    quoted = (lines.withColumn("passage", F.sum("new").over(order)).where("level > 0")
              .withColumn("norm", _normal(F.col("line"))).where("norm <> ''")
              .select("conv", "turn", "msg", "passage", "level", F.xxhash64("norm").alias("h"), F.xxhash64("norm", F.lit(1)).alias("h2")))
    quoted = stored(quoted, "quoted")
    convs = quoted.select("conv").distinct()
    own = (keyed.join(convs, "conv", "left_semi").select("conv", "turn", F.explode(F.split(_own(F.col("text")), "\n")).alias("line"))
           .withColumn("norm", _normal(F.col("line"))).where("norm <> ''"))
    holds = own.select("conv", F.xxhash64("norm").alias("h"), F.xxhash64("norm", F.lit(1)).alias("h2"), F.col("turn").alias("source")).distinct()
    passages = _targets(quoted, stored(holds, "holds"))
    replies = passages.groupBy("conv", "turn").agg(
        F.max("level").alias("quote_depth"), F.count("*").alias("n_passages"), F.count("source").alias("n_linked"),
        F.max(F.when(F.col("source").isNotNull(), F.struct((-F.col("level")).alias("near"), "source")))["source"].alias("reply_to"))
    replies = stored(replies, "replies")
    up = stored(replies.where("reply_to is not null").select("conv", "turn", F.col("reply_to").alias("up")), "up")
    while not up.isEmpty():
        above = up.select("conv", F.col("turn").alias("up"), F.col("up").alias("over"))
        far = up.join(above, ["conv", "up"], "left")
        nxt = stored(far.select("conv", "turn", F.coalesce("over", "up").alias("up"), F.col("over").isNotNull().alias("moved")), "up")
        up = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            break
    out = m.join(replies, ["conv", "turn"], "left").join(up.withColumnRenamed("up", "root"), ["conv", "turn"], "left")
    thread = F.when(F.col("conv").isNotNull(), F.coalesce("root", "turn"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col), F.col("role").alias(role_col), _own(F.col("text")).alias("own_text"),
                      zero("quote_depth"), zero("n_passages"), zero("n_linked"), "reply_to", thread.alias("thread")).orderBy(
                          conv_col, "thread", turn_col)
