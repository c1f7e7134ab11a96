r"""Chat formatting.

A declarative template maps roles to an opening mark, a closing mark and a
loss flag. Conversations become lists of text segments with a loss flag each;
a finite-state machine over the roles says whether the turn order is valid.
Control strings inside texts get a backslash after their first character
(``[INST]`` becomes ``[\INST]``, ``[\INST]`` becomes ``[\\INST]``), so texts
never hold a mark and the change can be undone. Built-in functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    role: str
    open: str
    close: str
    loss: bool


#: The template: one line per role.
TEMPLATE = (
    Part("system", "[SYS] ", " [/SYS]", False),
    Part("user", "[INST] ", " [/INST]", False),
    Part("assistant", "[OUT] ", "</s>", True),
)
#: Any other role (or none) is written between these marks, before its text.
OTHER_OPEN, OTHER_MID, OTHER_CLOSE = "[TURN] ", "[/TURN] ", "</s>"
#: What follows the first character of a control string.
CONTROL_TAIL = r"(/?s>|/?(?:SYS|INST|OUT|TURN)\])"

#: Turn order: state -> allowed next roles. A conversation may end after a user or an assistant.
NEXT = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
FINAL = ("user", "assistant")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL_TAIL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL_TAIL, r"$1$2$3")


def _case(parts, test, pick, other: Column) -> Column:
    return reduce(lambda rest, p: F.when(test(p), pick(p)).otherwise(rest), reversed(parts), other)


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order of ``turn``.

    Ties of ``turn`` go by role, then text; a null text or role is empty; a null
    turn comes first; rows of a null conv_id form one conversation; repeated
    rows are repeated turns; extra columns are left out.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))


def valid_order(turns: Column) -> Column:
    """Runs the state machine over the roles: true if it accepts."""
    def step(state, turn):
        ok = reduce(lambda a, s: a | ((state == s) & turn["role"].isin(*NEXT[s])), NEXT, F.lit(False))
        return F.when(ok, turn["role"]).otherwise(F.lit("invalid"))
    return F.aggregate(turns, F.lit("start"), step, lambda s: s.isin(*FINAL))


def segments(turns: Column, template=TEMPLATE) -> Column:
    """Three segments (text, loss) per turn: opening mark, escaped text, closing mark."""
    seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    no = F.lit(False)

    def one(t):
        is_role = lambda p: t["role"] == p.role
        opening = _case(template, is_role, lambda p: F.lit(p.open), F.concat(F.lit(OTHER_OPEN), escape(t["role"]), F.lit(OTHER_MID)))
        closing = _case(template, is_role, lambda p: F.lit(p.close), F.lit(OTHER_CLOSE))
        loss = _case(template, is_role, lambda p: F.lit(p.loss), no)
        return F.array(seg(opening, no), seg(escape(t["text"]), loss), seg(closing, no))

    return F.flatten(F.transform(turns, one))


def format_chats(rows: DataFrame, template=TEMPLATE) -> DataFrame:
    """(conv_id, valid, segments): conversations as segments with loss flags."""
    return conversations(rows).select("conv_id", valid_order(F.col("turns")).alias("valid"),
                                      segments(F.col("turns"), template).alias("segments"))


def formatted(segs: Column) -> Column:
    return F.concat_ws("", F.transform(segs, lambda s: s["text"]))


def _quote(mark: str) -> str:
    return "".join("\\" + c if c in "[]/<>" else c for c in mark)


def turn_pattern(template=TEMPLATE) -> str:
    marks = [(p.open, p.close) for p in template] + [(OTHER_OPEN, OTHER_CLOSE)]
    return "(?s)" + "|".join(f"{_quote(o)}.*?{_quote(c)}" for o, c in marks)


def parse_turns(text: Column, template=TEMPLATE) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    def one(t):
        cut = lambda o, c: F.substring(t, F.lit(len(o) + 1), F.length(t) - len(o) - len(c))
        rest = cut(OTHER_OPEN, OTHER_CLOSE)
        mid = F.instr(rest, OTHER_MID)
        role = _case(template, lambda p: F.startswith(t, F.lit(p.open)), lambda p: F.lit(p.role),
                     unescape(F.substring(rest, F.lit(1), mid - 1)))
        body = _case(template, lambda p: F.startswith(t, F.lit(p.open)), lambda p: cut(p.open, p.close),
                     F.substring(rest, mid + len(OTHER_MID), F.length(rest)))
        return F.struct(role.alias("role"), unescape(body).alias("text"))
    return F.transform(F.regexp_extract_all(text, F.lit(turn_pattern(template)), F.lit(0)), one)


def read_back(chats: DataFrame, template=TEMPLATE) -> DataFrame:
    """Per conversation what the formatted output says: turns and loss text."""
    out = chats.withColumn("formatted", formatted(F.col("segments")))
    out = out.withColumn("turns", parse_turns(F.col("formatted"), template))
    lossy = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    out = out.withColumn("loss_text", F.concat_ws("", lossy))
    body = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(body, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def with_probe(rows: DataFrame) -> DataFrame:
    """The rows plus conversation -1, whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    probe = rows.sparkSession.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                              "conv_id long, turn long, role string, text string")
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)
