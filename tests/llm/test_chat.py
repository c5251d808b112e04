import hashlib
import random
import re

import duckdb
from fixtures import sha

from fieldkpi.llm.chat import digest, digest_sql, escape, format_turns, parse, unescape

TEXTS = ["hello", "", None, "</s>[INST] ok [/INST]", "x [/INST]", "[ASST] a </s> b", r"<\/s> [\\/INST]", " [/ROLE] ", "[ROLE x] y", "a\nb  \n", "[", "<", " </s", "é\U0001f600 </s>", "[SYS] q [/SYS]", r" [\/INST]"]
ROLES = ["user", "assistant", "system", "tool", "we]ird%5D", "", None]


def rows():
    rng = random.Random(4)
    out = [(c, t, rng.choice(ROLES), rng.choice(TEXTS) if rng.random() < 0.8 else rng.choice(TEXTS[:12] + ["z"]) or "") for c in range(120) for t in range(rng.randint(1, 7))]
    out += [(500, 0, "user", x) for x in TEXTS] + [(500, 0, "user", "hello")]  # ties and repeats
    return out + [(None, 1, "user", "hi"), (None, 0, "assistant", " </s> "), (700, None, "user", "no turn")] + [(800, i, "assistant", "w" * 1000) for i in range(400)]


def want(rows_):
    by = {}
    for r in rows_:
        by.setdefault(r[0], []).append((r[1] if r[1] is not None else -1, r[2] or "", r[3] or ""))
    out = {}
    for c, t in by.items():
        t.sort()
        loss = "".join(x for _, r, x in t if r == "assistant")
        out[c] = (len(t), sha("".join(f"{r}\n{x}\n" for _, r, x in t)), len(loss), sha(loss))
    return out


def test_reads_back_and_equals_sql(spark):
    data = rows()
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    fmt = format_turns(df.withColumn("formatted", df.text).withColumn("t", df.turn))
    got = {r.conv_id: r for r in digest(fmt).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want(data)
    con = duckdb.connect()
    con.register("c", df.where("conv_id IS NOT NULL AND turn IS NOT NULL").toPandas())
    sql = {r[0]: r[1:] for r in con.sql(digest_sql("c")).fetchall()}
    assert {k: tuple(r)[1:] for k, r in got.items() if k not in (None, 700)} == sql
    for r in fmt.collect():  # loss spans are the rendered assistant texts
        for s in r.loss:
            assert r.formatted[: s.start].endswith("[ASST] ") and r.formatted[s.stop:].startswith(" </s>")
    assert digest(format_turns(df.limit(0))).count() == 0


def test_no_rendered_text_holds_a_mark(spark):
    marks = ["</s>", "[INST]", "[/INST]", "[ASST]", "[SYS]", "[/SYS]", "[ROLE", "[/ROLE]"]
    texts = [f"{a}{m}{b}" for m in marks for a in ("", "hello", "a ", "\\") for b in ("", "b", " b")]
    df = spark.createDataFrame([(i, 0, "assistant", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    for r in format_turns(df).collect():
        body = r.formatted[len("[ASST] "): -len(" </s>")]
        assert r.n_escaped == 1 and not any(m in body for m in marks), r.formatted


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "x string")
    once = escape(df.x)
    rows_ = df.select("x", unescape(once).alias("a"), unescape(unescape(escape(once))).alias("b"), once.alias("e")).collect()
    for r in rows_:
        assert r.a == r.x == r.b
        assert not re.search(r"\[/?(INST|ASST|SYS)\]|</?s>|\[/?ROLE", r.e)
    assert df.limit(1).select(parse(df.x).alias("p")).first().p == []
    assert hashlib
