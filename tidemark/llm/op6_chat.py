"""Chat formatting: a role state machine and a declarative template, in DataFrame functions only.

A template names, per role, the marker before and after a text and whether the
text carries training loss.  A finite-state machine over the roles says whether a
conversation's turn order is valid; every conversation is formatted either way.
The operator emits text segments, each with a loss flag; their concatenation is the
formatted conversation.

Control strings inside texts are escaped by one backslash after their first
character (more, if backslashes already stand there), so no control string of the
template ever occurs inside an escaped text, and ``unescape`` gives back exactly the text.

Nulls and ties: a null text is empty; a null role is the empty role, which like any
unknown role is written with the generic marker and never validates; rows are ordered
by turn (null first), then role and text, so ties and repeated rows have a fixed order and all
stay; rows with a null conv_id form one conversation of their own; an empty table
gives no rows; other columns are ignored.  One conversation is one row: its text is one string
and its digests are sequential, so its length is bounded by what a single string may hold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, by role; ``other`` is for roles without an entry and shows the role."""

    begin: str = "<s>"
    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {
        "system": ("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": ("[INST] ", " [/INST]\n"),
        "assistant": ("[OUT] ", " </s>\n"),
    })
    other: tuple[str, str, str] = ("[ROLE] ", " [TEXT] ", " [/TEXT]\n")
    loss_roles: tuple[str, ...] = ("assistant",)
    #: Allowed next roles by state; the states are "" (start) and the role seen last.
    transitions: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        """The control strings: every marker without its white space."""
        marks = [self.begin, *[m for pair in self.roles.values() for m in pair], *self.other]
        return sorted({m.strip() for m in marks if m.strip()}, key=lambda m: (-len(m), m))


DEFAULT = Template()


def _control_re(t: Template) -> str:
    """A control string with any number of backslashes after its first character."""
    return "|".join(f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in t.controls())


def escape(text: Column, t: Template = DEFAULT) -> Column:
    return F.regexp_replace(text, _control_re(t), r"\\")


def unescape(text: Column, t: Template = DEFAULT) -> Column:
    one = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in t.controls())
    return F.regexp_replace(text, one, "")


def valid_order(roles: Column, t: Template = DEFAULT) -> Column:
    """Fold the state machine over an array of roles; true if it ends in a final state."""
    def move(state: Column, role: Column) -> Column:
        out = F.lit("!")  # the state from which nothing leads on
        for before, nexts in t.transitions.items():
            out = F.when((state == before) & role.isin(*nexts), role).otherwise(out)
        return out
    return F.aggregate(roles, F.lit(""), move).isin(*t.final)


def format_chats(turns: DataFrame, t: Template = DEFAULT) -> DataFrame:
    """conv_id, n_turns, valid, segments array<struct<text, loss>>, formatted."""
    rows = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                                            F.coalesce("text", F.lit("")).alias("text")).alias("row"))
    conv = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def segments(row: Column) -> Column:
        text, role = escape(row["text"], t), row["role"]
        before = F.concat(F.lit(t.other[0]), escape(role, t), F.lit(t.other[1]))
        after = F.lit(t.other[2])
        for name, (a, b) in t.roles.items():
            before = F.when(role == name, F.lit(a)).otherwise(before)
            after = F.when(role == name, F.lit(b)).otherwise(after)
        part = lambda s, loss: F.struct(s.alias("text"), loss.alias("loss"))
        no = F.lit(False)
        return F.array(part(before, no), part(text, role.isin(*t.loss_roles)), part(after, no))

    first = F.array(F.struct(F.lit(t.begin).alias("text"), F.lit(False).alias("loss")))
    segs = F.concat(first, F.flatten(F.transform("rows", segments)))
    out = conv.select("conv_id", F.size("rows").cast("long").alias("n_turns"),
                      valid_order(F.transform("rows", lambda r: r["role"]), t).alias("valid"), segs.alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: Column, t: Template = DEFAULT) -> Column:
    """The turns of a formatted conversation: array<struct<role, text>>, unescaped.

    Markers cannot occur inside escaped texts, so a turn ends at the first closing marker."""
    q = lambda s: re.escape(s).replace("\\\n", "\\n").replace("\\ ", " ")
    shapes = [f"{q(a)}(?s:.*?){q(b)}" for a, b in t.roles.values()]
    o0, o1, o2 = t.other
    shapes.append(f"{q(o0)}(?s:.*?){q(o1)}(?s:.*?){q(o2)}")
    chunks = F.regexp_extract_all(formatted, F.lit("|".join(f"(?:{s})" for s in shapes)), F.lit(0))

    def turn(c: Column) -> Column:
        cut = lambda a, b: F.substring(c, F.lit(len(a) + 1), F.length(c) - F.lit(len(a) + len(b)))
        inner = cut(o0, o2)
        head = F.length(F.substring_index(inner, o1, 1))
        role = unescape(F.substring(inner, F.lit(1), head), t)
        text = F.substring(inner, head + len(o1) + 1, F.length(inner))
        for name, (a, b) in t.roles.items():
            role = F.when(F.startswith(c, F.lit(a)), F.lit(name)).otherwise(role)
            text = F.when(F.startswith(c, F.lit(a)), cut(a, b)).otherwise(text)
        return F.struct(role.alias("role"), unescape(text, t).alias("text"))

    return F.transform(chunks, turn)


#: The extra conversation whose texts hold control strings.
PROBE = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text and its loss segments."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long"), F.col("id"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(PROBE))
    out = format_chats(given.union(probe))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    out = out.withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", loss)
    said = F.array_join(F.transform("turns", lambda r: F.concat(r["role"], F.lit("\n"), r["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("long").alias("formatted_chars"), "valid")


SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, lag(role) OVER w AS prev, lead(role) OVER w AS nxt,
    length(text) + len(regexp_extract_all(text, '<\\*/?s>|<\\*</?SYS>>|\[\\*/?(?:INST|TEXT)\]|\[\\*(?:ROLE|OUT)\]')) AS escaped,
    length(role) + len(regexp_extract_all(role, '<\\*/?s>|<\\*</?SYS>>|\[\\*/?(?:INST|TEXT)\]|\[\\*(?:ROLE|OUT)\]')) AS role_escaped
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(escaped + CASE role WHEN 'system' THEN 8 + 10 WHEN 'user' THEN 7 + 9 WHEN 'assistant' THEN 6 + 6
                     ELSE 7 + 8 + 9 + role_escaped END))::BIGINT AS formatted_chars,
  bool_and(CASE WHEN prev IS NULL THEN role IN ('system', 'user') WHEN prev = 'system' THEN role = 'user'
                WHEN prev = 'user' THEN role = 'assistant' WHEN prev = 'assistant' THEN role = 'user' ELSE false END
           AND (nxt IS NOT NULL OR role = 'assistant')) AS valid
FROM t GROUP BY conv_id
"""

QUERIES = {"op6_chat": op6_chat}
ORACLES = {"op6_chat": SQL}
