"""Quotation linking, in DataFrame functions only.

Each line of a message has a quote level, the number of ``>`` before it.
Lines of one level that follow each other without a blank line are a passage.
Passages and their longer lines are hashed in a normal form (no quote marks,
single blanks, lower case); quoted ones are joined to the first message of
the thread that has them unquoted. A message answers the message it quotes at
the lowest level, and pointer doubling finds the root and depth of each
reply tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rectext.llm.common import saved

# A line's quote marks, and the words that introduce a quotation.
MARKS = r"^[ \t>]*>[ \t]?"
INTRODUCES = r"(?i)(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$"


def _lines(text: Column) -> Column:
    """``array<struct<level, body>>`` of a text."""
    return F.transform(F.split(text, "\r?\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, MARKS, 0), r"[^>]", "")).alias("level"), F.regexp_replace(x, MARKS, "").alias("body")))


def _without_introductions(lines: Column) -> Column:
    """A line that introduces the deeper level after it becomes blank."""
    return F.transform(lines, lambda x, i: F.struct(
        x["level"].alias("level"),
        F.when(x["body"].rlike(INTRODUCES) & (F.get(lines, i + 1)["level"] == x["level"] + 1), F.lit("")).otherwise(x["body"]).alias("body")))


def _without_blank_ends(text: Column) -> Column:
    """Without blank lines before the first and after the last line with a
    word. No group is repeated here: Java would go one call deeper for each."""
    led = F.regexp_replace(text, r"\A[ \t\n]*\n", "")
    tail = F.regexp_extract(led, r"(?<![ \t\n])([ \t\n]*+)\z", 1)
    return F.concat(F.substring(led, F.lit(1), F.length(led) - F.length(tail)), F.regexp_extract(tail, r"\A[ \t]*+", 0))


def _blank(x: Column) -> Column:
    return ~x["body"].rlike(r"\S")


def _passages(lines: Column) -> Column:
    """``array<struct<level, bodies>>``: runs of lines of one level without blank lines."""
    places = F.when(F.size(lines) > 0, F.sequence(F.lit(0), F.size(lines) - 1)).otherwise(F.array().cast("array<int>"))

    def edge(i, other):
        x, y = F.get(lines, i), F.get(lines, other)
        # Beyond an end of the text there is no line (null).
        return ~_blank(x) & F.coalesce((x["level"] != y["level"]) | _blank(y), F.lit(True))

    first = F.filter(places, lambda i: edge(i, F.when(i > 0, i - 1)))
    last = F.filter(places, lambda i: edge(i, i + 1))
    return F.zip_with(first, last, lambda s, e: F.struct(
        F.get(lines, s)["level"].alias("level"), F.transform(F.slice(lines, s + 1, e - s + 1), lambda x: x["body"]).alias("bodies")))


def normal_form(x: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))


def _units(passages: Column, line_words: int) -> Column:
    """``array<struct<level, place, is_whole, hash>>``: each passage whole,
    and its lines of ``line_words`` words or more if it has several."""
    def unit(level, place, whole, norm):
        return F.struct(level.alias("level"), place.alias("place"), F.lit(whole).alias("is_whole"), F.unhex(F.md5(norm)).alias("hash"))

    def of(p, i):
        lines = F.filter(F.transform(p["bodies"], normal_form), lambda b: (F.size(p["bodies"]) > 1) & (F.size(F.split(b, " ")) >= line_words))
        return F.concat(F.array(unit(p["level"], i, True, normal_form(F.array_join(p["bodies"], " ")))),
                        F.transform(lines, lambda b: unit(p["level"], i, False, b)))

    return F.flatten(F.transform(passages, of))


def link_quotations(messages: DataFrame, thread: str = "conv_id", order: str = "turn", text: str = "text", line_words: int = 4) -> DataFrame:
    """One row per message: ``thread, order, own_text`` (without quotations
    and their introductions), ``max_level``, ``n_quoted``, ``n_linked``
    (quoted passages, and those found in an earlier message), ``parent_order,
    root_order, depth``. Sorted by root, depth and order within a thread,
    every reply stands after the message that it answers.

    A quoted passage is found by its whole normal form, or by that of one of
    its lines of ``line_words`` words or more. Equal passages belong to the
    first message that has them. A null or empty text quotes nothing. Rows
    with the same thread and order are one message, their texts taken
    together; rows with null thread or order answer nothing and are roots.
    Other columns are not read; an empty table gives no rows."""
    m = messages.select(F.col(thread).alias("thread"), F.col(order).cast("long").alias("ord"),
                        _without_introductions(_lines(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("lines"))
    m = m.withColumns({"passages": _passages(F.col("lines")), "max_level": F.array_max(F.transform("lines", lambda x: x["level"]))})
    own = F.array_join(F.transform(F.filter("lines", lambda x: x["level"] == 0), lambda x: x["body"]), "\n")
    # Of the passages only hashes are kept: the texts would be several times the input.
    m = saved(m.select("thread", "ord", _without_blank_ends(own).alias("own_text"), "max_level",
                       F.size(F.filter("passages", lambda x: x["level"] > 0)).alias("n_quoted"), _units(F.col("passages"), line_words).alias("units")), "messages")
    units = m.filter("ord is not null and thread is not null").select("thread", "ord", F.inline("units"))
    originals = units.filter("level = 0").groupBy("thread", "hash").agg(F.min("ord").alias("first"))
    quoted = units.filter("level > 0")
    found = quoted.join(originals, ["thread", "hash"]).filter("first < ord")
    # Of a passage's finds the whole one counts, else its lines' latest message.
    by_passage = found.groupBy("thread", "ord", "place", "level").agg(F.max(F.struct("is_whole", "first")).alias("x"))
    linked = by_passage.groupBy("thread", "ord").agg(F.count(F.lit(1)).alias("n_linked"), F.min(F.struct("level", (-F.col("x.first")).alias("back"))).alias("y"))
    linked = linked.select("thread", "ord", "n_linked", (-F.col("y.back")).alias("parent"))

    rows = (m.groupBy("thread", "ord").agg(F.array_join(F.array_sort(F.collect_set("own_text")), "\n").alias("own_text"), F.max("max_level").alias("max_level"),
                                           F.sum("n_quoted").alias("n_quoted"))
            if m.groupBy("thread", "ord").count().filter("count > 1 and thread is not null and ord is not null").limit(1).count() else
            m.select("thread", "ord", "own_text", "max_level", "n_quoted"))
    tree = saved(m.select("thread", "ord").filter("thread is not null and ord is not null").distinct().join(linked, ["thread", "ord"], "left")
                 .select("thread", "ord", "n_linked", "parent", F.coalesce("parent", "ord").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")), "replies")
    tree = doubled(tree)
    out = rows.join(tree, ["thread", "ord"], "left")
    return out.select(F.col("thread").alias(thread), F.col("ord").alias(order), "own_text", F.coalesce("max_level", F.lit(0)).cast("long").alias("max_level"),
                      F.col("n_quoted").cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                      F.col("parent").alias("parent_order"), F.coalesce("up", "ord").alias("root_order"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"))


def doubled(tree: DataFrame) -> DataFrame:
    """``up`` (an ancestor; a root's is itself) followed to the root, ``depth``
    added up: each round doubles the steps, so a chain of n replies needs
    log n. Only messages that haven't come to their root go on."""
    names = ["thread", "ord", "n_linked", "parent", "up", "depth"]
    known = tree.select(*names, F.col("parent").isNull().alias("at_root"))
    finished, going = known.filter("at_root"), known.filter("not at_root")
    while not going.isEmpty():
        above = known.select("thread", F.col("ord").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), "at_root")
        moved = saved(going.drop("at_root").join(above, ["thread", "up"])
                      .select("thread", "ord", "n_linked", "parent", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), "at_root"), "replies")
        finished, going = finished.unionByName(moved.filter("at_root")), moved.filter("not at_root")
        known = finished.unionByName(going)
    return finished.select(*names)


def as_replies(conversations: DataFrame, levels: int = 2, block: int = 1024) -> DataFrame:
    """Conversations in the form of mail: every turn begins with an
    introduction and the turn before it, quoted, which quotes the turn before
    that, to ``levels`` levels. A turn whose number follows no other, or
    without conversation or number, quotes nothing; of several turns with one
    number the largest text is quoted.

    A window by number finds the turns before. Conversations are cut into
    blocks of ``block`` numbers, each with copies of the last ``levels`` turns
    of the block before, so a long one is spread over tasks and a text is
    shuffled about once."""
    turns = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    told = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    number = F.col("turn").cast("long")
    home = F.floor(number / block)
    dealt = turns.filter(told).withColumns({"number": number, "home": home, "block": F.explode(F.array_distinct(F.array(home, F.floor((number + levels) / block))))})
    in_block = Window.partitionBy("conv_id", "block").orderBy("number")
    near = dealt.withColumns({f"back{i}": F.max("text").over(in_block.rangeBetween(-i, -i)) for i in range(1, levels + 1)}).filter("block = home")
    mail = F.lit(None).cast("string")
    for i in range(levels, -1, -1):
        text = F.col(f"back{i}") if i else F.col("text")
        before = F.concat(F.lit("Turn "), (F.col("number") - i - 1).cast("string"), F.lit(" wrote:\n"), F.regexp_replace(mail, "(?m)^", "> "), F.lit("\n\n"))
        mail = F.concat(F.coalesce(before, F.lit("")), text)
    names = ["conv_id", "turn", "role", "text"]
    return near.select(*names, mail.alias("mail")).unionByName(turns.filter(~told).select(*names, F.col("text").alias("mail")))
