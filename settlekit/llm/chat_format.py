"""Chat formatting with a grammar round trip, in DataFrame functions only.

The rendered form of a conversation is a row of turns:

    conversation := turn*
    turn         := "<s>" header text "</s>"
    header       := "[INST]"                  a user turn
                  | "[/INST]"                 an assistant turn
                  | "[SYS]"                   a system turn
                  | "[ROLE]" name "[/ROLE]"   any other role
    text, name   := characters among which no control string stands

The control strings are ``<s> </s> [INST] [/INST] [SYS] [ROLE] [/ROLE]``. The
parser is deterministic: every ``</s>`` ends a turn, the header follows from the
first characters, and a control string anywhere else is a syntax error.

How it runs
1. Every turn is rendered as it is and parsed again. If the parser gives back
   exactly the role and the text, that form stays.
2. Else the conflicting content is escaped: a backslash goes behind the first
   character of every control string, also of one that already has backslashes
   there (``</s>`` becomes ``<\\/s>``, ``<\\/s>`` becomes ``<\\\\/s>``). Reading
   takes one backslash away, so escaping is reversible and leaves no control
   string. The escaped turn is parsed and compared too; a turn that no form
   gives back is an error and ends the job.
3. The turns of a conversation meet in one shuffle by its id. A rendered turn
   holds ``</s>`` at its end only, so turns can be joined without new conflicts;
   ``parse`` reads the whole text again.

The loss mask marks the characters of assistant texts, without headers and turn
ends. ``segments`` carries it: pieces of the formatted text in order, each with
its flag, of which the concatenation is the formatted text.

A conversation is one training example: its turns come together in one row, so
its text has to fit into one row (2 GB). No other group is built, whatever turns
or texts repeat.

Defined results: null role and null text count as empty; an empty text is an
empty turn; turns with one number are all kept, ordered by role and text; a null
turn number comes first; rows without conversation id form one conversation with
a null id; an empty table gives an empty result; other columns of the input,
whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
HEADERS = {"user": "[INST]", "assistant": "[/INST]", "system": "[SYS]"}
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
TRAINED = "assistant"

_AFTER_ANGLE, _AFTER_BRACKET = r"/?s>", r"(?:/?INST|SYS|/?ROLE)\]"
_CONTROL = rf"<{_AFTER_ANGLE}|\[{_AFTER_BRACKET}"
_TO_ESCAPE = rf"(<\\*+(?={_AFTER_ANGLE})|\[\\*+(?={_AFTER_BRACKET}))"
_ESCAPED = rf"([<\[])\\(?=(?<=<\\)\\*+{_AFTER_ANGLE}|(?<=\[\\)\\*+{_AFTER_BRACKET})"


def escape(text: Column) -> Column:
    """``text`` with one more backslash inside every control string."""
    return F.regexp_replace(text, _TO_ESCAPE, r"$1\\")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``."""
    return F.regexp_replace(text, _ESCAPED, "$1")


def _opening(role: Column, name: Column) -> Column:
    header = F.concat(F.lit(ROLE_OPEN), name, F.lit(ROLE_CLOSE))
    for known, mark in HEADERS.items():
        header = F.when(role == known, F.lit(mark)).otherwise(header)
    return F.concat(F.lit(OPEN), header)


def _turn(part: Column) -> Column:
    """One turn without its end as ``struct(role, text)``; null where the grammar does not fit."""
    body = F.substring(part, len(OPEN) + 1, 2147483647)

    def read(role: Column, text: Column) -> Column:
        fine = ~role.rlike(_CONTROL) & ~text.rlike(_CONTROL)
        return F.when(fine, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))

    def behind(text: Column, mark: str) -> Column:
        return F.substring(text, len(mark) + 1, 2147483647)

    named = behind(body, ROLE_OPEN)
    name = F.substring_index(named, ROLE_CLOSE, 1)
    got = F.when(body.startswith(ROLE_OPEN) & named.contains(ROLE_CLOSE),
                 read(name, named.substr(F.length(name) + len(ROLE_CLOSE) + 1, F.lit(2147483647))))
    for role, mark in HEADERS.items():
        got = F.when(body.startswith(mark), read(F.lit(role), behind(body, mark))).otherwise(got)
    return F.when(part.startswith(OPEN), got)


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as ``array<struct<role, text>>``; null if it does not follow the grammar."""
    parts = F.split(formatted, CLOSE, -1)
    turns = F.transform(F.slice(parts, 1, F.size(parts) - 1), _turn)
    fine = (F.element_at(parts, -1) == "") & F.forall(turns, lambda t: t.isNotNull())
    return F.when(fine, turns)


def render_turns(turns: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``turns`` with ``opening`` and ``body``, the rendered form without the end mark, escaped where needed."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    forms = turns.select("*", role.alias("__role"), text.alias("__text")).select(
        "*", _opening(F.col("__role"), F.col("__role")).alias("__plain"),
        _opening(F.col("__role"), escape(F.col("__role"))).alias("__safe"), escape(F.col("__text")).alias("__body"))

    def gives_back(opening: str, body: str) -> Column:
        read = parse(F.concat(opening, body, F.lit(CLOSE)))
        want = F.array(F.struct(F.col("__role").alias("role"), F.col("__text").alias("text")))
        return F.coalesce(read == want, F.lit(False))

    unfit = F.raise_error(F.lit("a turn cannot be rendered reversibly")).cast("struct<opening:string,body:string>")
    form = (F.when(gives_back("__plain", "__text"), F.struct(F.col("__plain").alias("opening"), F.col("__text").alias("body")))
            .when(gives_back("__safe", "__body"), F.struct(F.col("__safe").alias("opening"), F.col("__body").alias("body")))
            .otherwise(unfit))
    return forms.withColumn("__form", form).select(
        *[F.col(f"`{c}`") for c in turns.columns], F.col("__role").alias("__r"), F.col("__text").alias("__t"),
        F.col("__form.opening").alias("__o"), F.col("__form.body").alias("__b"))


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``segments``
    (``array<struct<piece, loss>>``, the formatted text in pieces with the loss mask)."""
    plain = turns.select(F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                         F.col(text_col).alias("text"))
    made = render_turns(plain).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn"), F.col("__r").alias("role"), F.col("__t").alias("text"), F.col("__o").alias("opening"),
        F.col("__b").alias("body")))).alias("turns"))

    def segment(piece: Column, loss: Column) -> Column:
        return F.struct(piece.alias("piece"), loss.alias("loss"))

    segments = F.flatten(F.transform("turns", lambda t: F.array(
        segment(t["opening"], F.lit(False)), segment(t["body"], t["role"] == TRAINED), segment(F.lit(CLOSE), F.lit(False)))))
    return made.select("conv_id", segments.alias("segments")).select(
        "conv_id", F.array_join(F.col("segments.piece"), "").alias("formatted"), "segments")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["piece"])), "")


def formatted_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation the digests of what is read back from ``formatted`` and ``segments``."""
    read = formatted.select("conv_id", parse(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss"),
                            F.length("formatted").cast("bigint").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
