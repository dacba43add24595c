"""Chat formatting: a finite-state machine over roles and a declarative template.

``TEMPLATE`` names, per role, the mark before and after a turn and whether its
text carries loss; ``TURN_ORDER`` lists the allowed transitions of the turn
order machine.  Only built-in expressions run.

Control strings inside texts are escaped reversibly: backslashes are doubled,
then each control string gets a backslash after its first character.

Defined cases: null text or role is empty; turns are ordered by (turn, role,
text), null turns first; rows with a null conv_id form one conversation; a role
without a template of its own is written between ``[ROLE]`` marks; an empty
table gives an empty result; other columns are ignored.  A conversation is one
output row, so its turns do meet in one row; nothing larger is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: role -> (mark before, mark after, text carries loss)
TEMPLATE = {
    "system": ("<<SYS>>", "<</SYS>>", False),
    "user": ("[INST]", "[/INST]", False),
    "assistant": ("<s>", "</s>", True),
}
#: Any other role: the role's name stands between the first two marks.
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
#: (state, role) -> state; a missing entry is an error.
TURN_ORDER = {
    ("start", "system"): "instructed", ("start", "user"): "asked", ("instructed", "user"): "asked",
    ("asked", "assistant"): "answered", ("answered", "user"): "asked",
}
FINAL = ("answered",)


def controls(template: dict = TEMPLATE) -> list[str]:
    return [m for before, after, _ in template.values() for m in (before, after)] + list(OTHER)


def escape(text: Column, template: dict = TEMPLATE) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in controls(template):
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(text: Column) -> Column:
    """A pair of backslashes is one; a single one was put in."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def turn_state(roles: Column, order: dict = TURN_ORDER) -> Column:
    """The state of the turn-order machine after ``roles``; 'error' absorbs."""
    table = F.create_map(*[F.lit(x) for (s, r), to in order.items() for x in (f"{s}>{r}", to)])
    return F.aggregate(roles, F.lit("start"),
                       lambda s, r: F.coalesce(F.try_element_at(table, F.concat(s, F.lit(">"), r)), F.lit("error")))


def format_chat(turns: DataFrame, template: dict = TEMPLATE, order: dict = TURN_ORDER) -> DataFrame:
    """One row per conversation: ``conv_id``, ``segments`` (text, loss),
    ``formatted`` (their concatenation), ``state`` and ``valid`` (turn order)."""
    rows = turns.select("conv_id", F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("_t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_t"))

    def seg(text: Column, loss: bool = False) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    def marked(t: Column) -> Column:
        out = F.array(seg(F.concat(F.lit(OTHER[0]), escape(t["role"], template), F.lit(OTHER[1]))),
                      seg(escape(t["text"], template)), seg(F.lit(OTHER[2])))
        for role, (before, after, loss) in template.items():
            out = F.when(t["role"] == role, F.array(
                seg(F.lit(before)), seg(escape(t["text"], template), loss), seg(F.lit(after)))).otherwise(out)
        return out

    segments = F.flatten(F.transform("_t", marked))
    state = turn_state(F.transform("_t", lambda t: t["role"]), order)
    out = convs.select("conv_id", segments.alias("segments"), state.alias("state"))
    return out.select("conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                      "state", F.col("state").isin(list(FINAL)).alias("valid"))


def read_back(formatted: Column, template: dict = TEMPLATE) -> Column:
    """The turns (role, text) of a formatted conversation, unescaped."""
    def quoted(c: str) -> str:
        return "\\Q" + c + "\\E"

    ends = "|".join(quoted(c) for c in [after for _, after, _ in template.values()] + [OTHER[2]])
    pieces = F.split(formatted, ends)  # escaped texts hold no control string

    def turn(p: Column) -> Column:
        at = F.instr(p, OTHER[1])
        out = F.struct(unescape(p.substr(F.lit(len(OTHER[0]) + 1), at - 1 - len(OTHER[0]))).alias("role"),
                       unescape(p.substr(at + len(OTHER[1]), F.length(p))).alias("text"))
        for role, (before, _, _) in template.items():
            out = F.when(p.startswith(F.lit(before)), F.struct(
                F.lit(role).alias("role"), unescape(p.substr(F.lit(len(before) + 1), F.length(p))).alias("text"))).otherwise(out)
        return out

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def chat_digest(chats: DataFrame, template: dict = TEMPLATE) -> DataFrame:
    """The digest columns of the query, read back from ``format_chat``'s output."""
    turns = read_back(F.col("formatted"), template)
    lossy = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    d = chats.select("conv_id", "formatted", "valid", turns.alias("_turns"), lossy.alias("_loss"))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return d.select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                    F.sha2(said, 256).alias("turns_sha256"), F.length("_loss").cast("long").alias("loss_chars"),
                    F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def _oracle() -> str:
    esc = "replace(text, '\\', '\\\\')"
    esc_role = "replace(role, '\\', '\\\\')"
    for c in controls():
        esc = f"replace({esc}, '{c}', '{c[0]}\\{c[1:]}')"
        esc_role = f"replace({esc_role}, '{c}', '{c[0]}\\{c[1:]}')"
    size = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b, _) in TEMPLATE.items())
    steps = " ".join(f"WHEN s = '{s}' AND r = '{r}' THEN '{to}'" for (s, r), to in TURN_ORDER.items())
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
n AS (SELECT *, length({esc}) + CASE role {size} ELSE {sum(map(len, OTHER))} + length({esc_role}) END AS n FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
  coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
  sum(n)::BIGINT AS formatted_chars,
  list(role ORDER BY turn NULLS FIRST, role, text) AS roles FROM n GROUP BY 1)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars,
  list_reduce(list_prepend('start', roles), lambda s, r: CASE {steps} ELSE 'error' END) = 'answered' AS valid
FROM g"""


ORACLE_SQL = _oracle()
