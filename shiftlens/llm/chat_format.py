"""Relational chat formatting, in Spark expressions only.

The turns of a conversation are collected as structs, sorted by turn number,
neighbours of one role are merged into a block, and the blocks are joined:

    <|im_start|>role\\n text <|im_sep|> text <|im_end|>\\n

``<|im_sep|>`` stands between the texts that a block merges, so reading back
gives every turn again. The loss mask is a list of runs (chars, loss) that
covers the formatted string: the texts of assistant turns bear loss, marks and
all other texts do not.

Escaping. Control strings are all that begin with "<|" (the marks above, the added tokens of
tokenizer files, other templates' marks) and those of other common
templates: <s>, </s>, [INST], [/INST], <<SYS>>, <</SYS>>, <unk>, <pad>, <bos>, <eos>, <mask>, <start_of_turn>,
<end_of_turn>. Inside a text each gets a backslash after its
first character; one that already has backslashes there gets one more. So no
control string remains, and removing one backslash restores the text.

A conversation is one row of output and one hash of all its text, so its turns
meet in one task by definition; they are aggregated as escaped structs, and
every step is linear in the conversation's length. Conversations spread by their id.

Defined results: a null text is empty; turns are ordered by number (null
first), then role and text, so ties and repeated rows have one order and each
row is a turn; a null role is the empty role; line breaks and backslashes in a
role are escaped; a null conv_id forms one conversation; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pick, table

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"
# What stands after the first character of a control string.
_REST = r"(\||/?s>|/?INST\]|</?SYS>>|unk>|pad>|bos>|eos>|mask>|(?:start|end)_of_turn>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])(\\*)" + _REST, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _REST, "$1$2$3")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    # a backslash pair first becomes a character that no escaped role holds next to "n": split at pairs, then join
    parts = F.transform(F.split(role, r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return unescape(F.array_join(parts, "\\"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, formatted, loss_runs): loss_runs is an array of (chars, loss) in the order of the string."""
    src = pick(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = src.select("conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text"),
                                          escape_role(role).alias("mark"), escape(text).alias("body")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))

    t = F.col("t")
    neighbour = F.transform(t, lambda x, i: F.struct(
        x["mark"].alias("mark"), x["body"].alias("body"), (x["role"] == LOSS_ROLE).alias("loss"),
        F.when(i == 0, F.lit(True)).otherwise(F.get(t, i - 1)["role"] != x["role"]).alias("opens"),
        F.when(i == F.size(t) - 1, F.lit(True)).otherwise(F.get(t, i + 1)["role"] != x["role"]).alias("closes")))

    def run(s: Column, loss: Column) -> Column:
        return F.struct(s.alias("s"), loss.alias("loss"))

    no = F.lit(False)
    runs = F.flatten(F.transform("n", lambda x: F.array(
        run(F.when(x["opens"], F.concat(F.lit(START), x["mark"], F.lit("\n"))).otherwise(F.lit(SEP)), no),
        run(x["body"], x["loss"]),
        run(F.when(x["closes"], F.lit(END)).otherwise(F.lit("")), no))))
    return (convs.select("conv_id", neighbour.alias("n")).select("conv_id", runs.alias("runs"))
            .select("conv_id", F.array_join(F.transform("runs", lambda r: r["s"]), "").alias("formatted"),
                    F.transform("runs", lambda r: F.struct(F.char_length(r["s"]).cast("bigint").alias("chars"),
                                                           r["loss"].alias("loss"))).alias("loss_runs")))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, masked): the turns (role, text) that a formatted string holds, the
    unescaped text of each run under its loss mask, and whether the mask's runs fit the string."""
    blocks = F.split("formatted", r"<\|im_end\|>\n")  # escaped texts hold no mark; the last part is empty
    parsed = F.transform(F.slice("blocks", 1, F.size("blocks") - 1), lambda b: F.struct(
        F.substring_index(b, "\n", 1).substr(F.lit(len(START) + 1), F.char_length(b)).alias("mark"),
        F.split(b.substr(F.char_length(F.substring_index(b, "\n", 1)) + 2, F.char_length(b)),
                r"<\|im_sep\|>").alias("bodies")))
    pieces = F.flatten(F.transform("b", lambda b: F.flatten(F.transform(b["bodies"], lambda x, i: F.array(
        F.when(i == 0, F.concat(F.lit(START), b["mark"], F.lit("\n"))).otherwise(F.lit(SEP)), x,
        F.when(i == F.size(b["bodies"]) - 1, F.lit(END)).otherwise(F.lit("")))))))
    turns = F.flatten(F.transform("b", lambda b: F.transform(b["bodies"], lambda x: F.struct(
        unescape_role(b["mark"]).alias("role"), unescape(x).alias("text")))))
    zipped = F.zip_with("pieces", "loss_runs", lambda p, r: F.struct(
        p.alias("s"), r["loss"].alias("loss"), (F.char_length(p) == r["chars"]).alias("fits")))
    return (formatted.select("*", blocks.alias("blocks")).select("conv_id", "formatted", "loss_runs", parsed.alias("b"))
            .select("*", pieces.alias("pieces"), turns.alias("turns"))
            .select("conv_id", "formatted", "turns", zipped.alias("z"))
            .select("conv_id", "formatted", "turns",
                    F.transform(F.filter("z", lambda z: z["loss"]), lambda z: unescape(z["s"])).alias("loss_text"),
                    F.forall("z", lambda z: F.coalesce(z["fits"], F.lit(False))).alias("masked")))


def digest(read: DataFrame) -> DataFrame:
    loss = F.array_join("loss_text", "")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (read.withColumn("loss", F.when(F.col("masked"), loss)  # a mask that does not fit is an error
                            .otherwise(F.raise_error(F.lit("loss mask does not fit the formatted text"))))
            .select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                    F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
                    F.char_length("loss").cast("bigint").alias("loss_chars"),
                    F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("bigint").alias("formatted_chars")))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = pick(table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    said = F.lit("</s>[INST] ok [/INST]")
    hard = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
                                 said.alias("text"))
    return digest(read_back(format_conversations(own.unionByName(hard))))


# escape: one backslash after the first character of each control string; formatted_chars counts the marks.
OP10_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, regexp_replace(text, '([<\\[])(\\\\*){_REST}', '\\1\\\\\\2\\3', 'g') AS body,
    coalesce(lag(role) OVER w = role, false) AS same
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(body) + CASE WHEN same THEN 10 ELSE 12 + length(role) + 1 + 11 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
