"""Chat formatting: every assistant turn becomes an example of its own.

An example is the conversation up to one reply, and only that reply is trainable.
What follows the last reply makes a last example without a trainable part, so that
no turn is lost.

Turns are marked by control strings; inside texts and role names a control string
gets a backslash before its name, and one that has backslashes there gets one more,
so that the original can be read back.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skygauge.llm.common import whole

# The marks of a turn, opening and closing, by role.
SYSTEM = ("<<SYS>>", "<</SYS>>")
USER = ("[INST]", "[/INST]")
ASSISTANT = ("<s>", "</s>")
#: Any other role is named between these, and its text ends like a reply.
NAMED = ("[ROLE]", "[/ROLE]")

_NAME = r"/?(?:INST\]|ROLE\]|SYS>>|s>)"
_ESCAPE = rf"([\[<])(\\*)({_NAME})"
_UNESCAPE = rf"([\[<])\\(\\*)({_NAME})"
_TURN = r"(?s)(<<SYS>>|\[INST\]|<s>|\[ROLE\].*?\[/ROLE\])(.*?)(<</SYS>>|\[/INST\]|</s>)"


def escape(text: Column) -> Column:
    """The text without a control string in it."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def _opening(role: Column) -> Column:
    return (F.when(role == "system", SYSTEM[0]).when(role == "user", USER[0]).when(role == "assistant", ASSISTANT[0])
            .otherwise(F.concat(F.lit(NAMED[0]), escape(role), F.lit(NAMED[1]))))


def _closing(role: Column) -> Column:
    return F.when(role == "system", SYSTEM[1]).when(role == "user", USER[1]).otherwise(ASSISTANT[1])


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start, loss_end: the formatted examples.

    Turns are ordered by turn, then role and text; null turns come first, and a null
    text or role is empty.  Repeated rows are turns of their own.  The trainable part
    is text[loss_start, loss_end) in code points, null in an example without one.
    An empty table gives no rows.  A conversation is one row while it is formatted.
    """
    role, text = whole("role"), whole("text")
    turn = F.struct("turn", role.alias("role"), text.alias("text"),
                    _opening(role).alias("open"), escape(text).alias("body"), _closing(role).alias("close"))
    talks = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    size = F.size("turns")
    replies = F.filter(F.sequence(F.lit(0), size - 1), lambda i: F.get("turns", i)["role"] == "assistant")
    ended = F.get("turns", size - 1)["role"] == "assistant"
    targets = F.when(ended, replies).otherwise(F.concat(replies, F.array(size - 1)))
    rows = talks.select("conv_id", "turns", F.posexplode(targets).alias("example", "at"))
    last = F.get("turns", F.col("at"))
    before = F.array_join(F.transform(F.slice("turns", 1, F.col("at")), lambda t: F.concat(
        t["open"], t["body"], t["close"])), "")
    trained = last["role"] == "assistant"
    start = F.length("before") + F.length(last["open"])
    return rows.withColumn("before", before).select(
        "conv_id", "example",
        F.concat("before", last["open"], last["body"], last["close"]).alias("text"),
        F.when(trained, start).alias("loss_start"),
        F.when(trained, start + F.length(last["body"])).alias("loss_end"))


def read_turns(text: Column) -> Column:
    """The turns (role, text) of a formatted example."""
    opens, bodies = F.regexp_extract_all(text, F.lit(_TURN), 1), F.regexp_extract_all(text, F.lit(_TURN), 2)

    def role_of(mark: Column) -> Column:
        return (F.when(mark == SYSTEM[0], "system").when(mark == USER[0], "user")
                .when(mark == ASSISTANT[0], "assistant")
                .otherwise(unescape(F.regexp_replace(mark, r"(?s)^\[ROLE\](.*)\[/ROLE\]$", "$1"))))

    return F.zip_with(opens, bodies, lambda o, b: F.struct(role_of(o).alias("role"), unescape(b).alias("text")))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation.

    Everything is read from the examples: the turns from the longest, the trained
    text from the loss spans in order.
    """
    trained = F.when(F.col("loss_start").isNotNull(), unescape(
        F.substring("text", F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))).otherwise("")
    whole_talks = formatted.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.sort_array(F.collect_list(F.struct("example", trained.alias("trained")))).alias("parts"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"))
    turns = F.transform(read_turns(F.col("longest")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return whole_talks.select("conv_id", turns.alias("turns"), F.array_join(F.transform(
        "parts", lambda p: p["trained"]), "").alias("trained"), "formatted_chars").select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars")
