"""Chat formatting with a grammar round trip, in DataFrame operations only.

A turn is its opening mark, a space, the text, a space and its closing mark:

    [INST] ... [/INST]   user        [SYS] ... [/SYS]          system
    [ASST] ... </s>      assistant   [ROLE name] ... [/ROLE]   any other role

The parser reads an opening mark, then text up to the first space and closing
mark. It takes one backslash out of every escaped mark, which has one or more
backslashes after its bracket. A text conflicts if it holds a mark, escaped or
not, or if its turn, rendered as it is, doesn't read back as its role and text;
the marks of such a text get one more backslash each, so that no rendered text
holds a mark. Then the whole conversation is read back; if it
isn't identical, all its turns are escaped, and a conversation that still
differs ends the job with an error.

Turns are ordered by turn, then role and text. Null text and null role count as
empty; a null conversation id is one conversation. Repeated rows are turns of
their own. An empty table gives an empty result; further columns are ignored.
A conversation is one string, so its rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed marks: role, opening mark, closing mark
MARKS = [("user", "[INST]", "[/INST]"), ("assistant", "[ASST]", "</s>"), ("system", "[SYS]", "[/SYS]")]
OTHER = ("[ROLE ", "[/ROLE]")
_CONTROL = "/?(?:INST\\]|ASST\\]|SYS\\]|ROLE|s>)"
_TURN = "(?s)\\[(INST|ASST|SYS|ROLE [^\\]]*)\\] (.*?) (?:\\[/INST\\]|</s>|\\[/SYS\\]|\\[/ROLE\\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])(\\\\*)({_CONTROL})", "$1$2\\\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, f"([<\\[])(\\\\*)\\\\({_CONTROL})", "$1$2$3")


def _render(role: Column, body: Column) -> Column:
    name = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))
    opening = F.concat(F.lit(OTHER[0]), name, F.lit("]"))
    closing = F.lit(OTHER[1])
    for r, a, b in MARKS:
        opening = F.when(role == r, F.lit(a)).otherwise(opening)
        closing = F.when(role == r, F.lit(b)).otherwise(closing)
    return F.concat(opening, F.lit(" "), body, F.lit(" "), closing)


def parse(formatted: Column) -> Column:
    """Array of (role, text) read from a rendered text."""
    def role(tag: Column) -> Column:
        out = F.replace(F.replace(F.substring(tag, 6, 1 << 30), F.lit("%5D"), F.lit("]")), F.lit("%25"), F.lit("%"))
        for r, a, _ in MARKS:
            out = F.when(tag == a[1:-1], r).otherwise(out)
        return out

    tags = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1))
    bodies = F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2))
    return F.zip_with(tags, bodies, lambda t, b: F.struct(role(t).alias("role"), unescape(b).alias("text")))


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """A row per conversation: id, ``formatted``, ``n_escaped`` turns and
    ``loss``, the spans (start, stop in code points) of assistant texts, as rendered."""
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = F.array(F.struct("role", "text"))
    plain = ~F.col("text").rlike(f"[<\\[]\\\\*{_CONTROL}") & (parse(_render(F.col("role"), F.col("text"))) == source)
    rows = rows.withColumn("body", F.when(plain, F.col("text")).otherwise(escape(F.col("text"))))
    rows = rows.withColumn("escaped", ~plain)
    conv = rows.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "body", "escaped"))).alias("t"))
    want = F.transform("t", lambda t: F.struct(t["role"], t["text"]))

    def joined(body) -> Column:
        return F.array_join(F.transform("t", lambda t: _render(t["role"], body(t))), "")

    first = conv.withColumn("f0", joined(lambda t: t["body"]))
    second = first.withColumn("ok0", parse(F.col("f0")) == want).withColumn("f1", F.when(F.col("ok0"), F.col("f0")).otherwise(joined(lambda t: escape(t["text"]))))
    checked = second.withColumn("formatted", F.when(F.col("ok0") | (parse(F.col("f1")) == want), F.col("f1")).otherwise(
        F.raise_error(F.lit("a rendered conversation does not read back as its source"))))

    def width(t: Column) -> Column:
        return F.length(_render(t["role"], F.lit("")))

    def body(t: Column) -> Column:
        return F.when(F.col("ok0"), t["body"]).otherwise(escape(t["text"]))

    opening = len(MARKS[1][1]) + 1
    loss = F.aggregate(
        "t", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out")),
        lambda s, t: F.struct(
            (s["at"] + width(t) + F.length(body(t))).alias("at"),
            F.when(t["role"] == "assistant", F.concat(s["out"], F.array(F.struct(
                (s["at"] + opening).alias("start"), (s["at"] + opening + F.length(body(t))).alias("stop"))))).otherwise(s["out"]).alias("out")),
        lambda s: s["out"])
    return checked.select(F.col("conv").alias(conv_col), "formatted", F.size(F.filter("t", lambda t: t["escaped"])).cast("long").alias("n_escaped"), loss.alias("loss"))


def digest(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and hashes read back from :func:`format_turns`."""
    read = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn(
        "masked", F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"]))), ""))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                       F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "n_escaped")


def digest_sql(table: str) -> str:
    """DuckDB SQL for :func:`digest` of a table (or sub-query) with conv_id, turn, role, text."""
    marks = " ".join(f"WHEN '{r}' THEN {len(a) + len(b) + 2}" for r, a, b in MARKS)
    other = f"{len(OTHER[0]) + len(OTHER[1]) + 3} + length(replace(replace(r, '%', '%25'), ']', '%5D'))"
    control = "/?(?:INST\\]|ASST\\]|SYS\\]|ROLE|s>)"
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM {table}),
e AS (SELECT *, regexp_matches(x, '[<\\[]\\\\*{control}') AS bad FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
  CAST(coalesce(sum(length(x)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(CASE r {marks} ELSE {other} END + length(x)
    + CASE WHEN bad THEN len(regexp_extract_all(x, '[<\\[]\\\\*{control}')) ELSE 0 END) AS BIGINT) AS formatted_chars,
  CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_escaped
FROM e GROUP BY conv_id"""
