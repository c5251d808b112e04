"""Secret scans with corpus-wide ownership, in DataFrame operations only.

Base kinds are found by pattern, leftmost and non-overlapping per kind. The
pieces between matches (``split``) and the matches (``regexp_extract_all``) come
from the same matcher, so their running lengths, a window over a text's matches,
are the spans: time and memory stay linear in the matches of a text. A further
kind, ``token``, takes long mixed strings that no base kind need cover.

Every candidate's value is hashed, and hashes are counted over the whole corpus
by distinct documents and distinct owners (``source``). A value that many owners
hold is a copied example; one that a few hold looks live. A live token is added
to the spans; base spans always stay in them. Redaction replaces live spans and
leaves copied examples.

Offsets are code points, the end exclusive. Null text counts as empty. A null id
or owner counts as one value of its own. Repeated equal rows get equal results.
Empty tables give an empty result; further columns are kept by the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldkpi.llm.common import stored

# fixed patterns: kind, pattern, group of the value, least length of the value
KINDS = [
    ("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),  # a run of fewer characters can't hold a match, nor hide one
    ("token", "[A-Za-z0-9+/_-]{20,}", 0, 20),
]
BASE = ("assign", "access", "hex")
EXAMPLE_OWNERS = 5


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def _row_key(id_col: str, text_col: str) -> Column:
    """A key of a row's id and text: rows that share it have equal spans."""
    name = F.col(id_col).cast("string")
    return F.sha2(F.concat(F.coalesce(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name), F.lit("-:")), F.coalesce(F.col(text_col), F.lit(""))), 256)


PIECES = "array<struct<kind:int,pos:int,gap:int,size:int,value:string>>"


def _pieces(kind_no: int) -> Column:
    """The matches of a kind in ``text``, in order: the length of the piece before each, its own, and its value."""
    _, pattern, group, _ = KINDS[kind_no]
    whole = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all("text", F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(F.split("text", pattern, -1).alias("piece"), whole.alias("whole"), value.alias("value"))
    every = F.transform(zipped, lambda m, i: F.struct(
        F.lit(kind_no).alias("kind"), i.alias("pos"), F.length(m["piece"]).alias("gap"), F.length(m["whole"]).alias("size"), m["value"].alias("value")))
    return F.when(F.col("text").rlike(pattern), F.filter(every, lambda m: m["size"].isNotNull())).otherwise(F.array().cast(PIECES))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """A row per candidate of each row of ``docs``: id, ``row_key``, ``owner``, ``start``, ``kind``, ``stop``, ``value_hash``."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(owner_col).alias("owner"))
    found = rows.select("id", "owner", _row_key("id", "text").alias("row_key"), F.monotonically_increasing_id().alias("row"),
                        F.concat(*[_pieces(k) for k in range(len(KINDS))]).alias("m")).where(F.size("m") > 0)
    m = found.select("id", "row_key", "owner", "row", F.explode("m").alias("m")).select("id", "row_key", "owner", "row", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    m = m.withColumn("stop", F.sum(F.col("gap") + F.col("size")).over(before).cast("int")).withColumn("start", F.col("stop") - F.col("size"))
    least = F.array(*[F.lit(k[3]) for k in KINDS])
    token = [k[0] for k in KINDS].index("token")
    kept = m.where((F.length("value") >= least[F.col("kind")]) & ((F.col("kind") != token) | _mixed(F.col("value"))))
    return kept.select("id", "row_key", "owner", "start", "kind", "stop", F.sha2("value", 256).alias("value_hash"))


def ownership(found: DataFrame) -> DataFrame:
    """Per candidate hash: ``docs`` and ``owners``, the distinct documents and owners that hold it.

    Pairs are made distinct first, so that a value in a third of all rows is a
    partial count per task before it meets."""
    pairs = found.select("value_hash", "id", "owner").distinct()
    per_owner = pairs.groupBy("value_hash", "owner").agg(F.count("*").alias("docs"))
    return per_owner.groupBy("value_hash").agg(F.sum("docs").alias("docs"), F.count("*").alias("owners"))


def _spans(docs: DataFrame, id_col: str, text_col: str, owner_col: str, example_owners: int) -> DataFrame:
    """The distinct candidates of each ``row_key``, each with ``live``."""
    found = stored(candidates(docs, id_col, text_col, owner_col), "sec_found")
    owned = ownership(found).select("value_hash", (F.col("owners") < example_owners).alias("live"))
    return found.join(owned, "value_hash").select("row_key", "start", "kind", "stop", "live").distinct()


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat(names[s["kind"]], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """A row per row of ``docs``: id, counts per base kind, ``base`` (base spans,
    joined), ``spans`` (all spans, joined), ``n_live`` and ``n_example``."""
    n_base = len(BASE)
    rows = docs.select(F.col(id_col), _row_key(id_col, text_col).alias("row_key"))
    by_row = _spans(docs, id_col, text_col, owner_col, example_owners).groupBy("row_key").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "live"))).alias("spans"))
    got = rows.join(by_row, "row_key", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,stop:int,live:boolean>>")))
    base = F.filter("spans", lambda s: s["kind"] < n_base)

    def of_kind(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")

    count = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    return got.select(
        id_col, *count, _listed(base).alias("base"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda s: ~s["live"])).cast("long").alias("n_example"),
        _listed(F.filter("spans", lambda s: (s["kind"] < n_base) | s["live"])).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", size_col: str = "n_chars",
           example_owners: int = EXAMPLE_OWNERS, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each live span's text replaced by ``mark`` (overlapping spans as one) and ``size_col``, where there, set to the new length."""
    live = _spans(docs, id_col, text_col, owner_col, example_owners).where("live")
    before = Window.partitionBy("row_key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    gaps = live.withColumn("at", F.coalesce(F.max("stop").over(before), F.lit(0)))
    # what stays before each mark (a span that starts in an earlier one has none of its own), and where the rest begins
    gap = F.when(F.col("start") >= F.col("at"), F.struct("at", (F.col("start") - F.col("at")).alias("n")))
    cuts = gaps.groupBy(F.col("row_key").alias("__sec_key")).agg(F.sort_array(F.collect_list(gap)).alias("__sec_gaps"), F.max("stop").alias("__sec_rest"))
    got = docs.withColumn("__sec_key", _row_key(id_col, text_col)).join(cuts, "__sec_key", "left")
    text, live_here = F.col(text_col), F.col("__sec_gaps").isNotNull()

    def cut(chars: Column) -> Column:
        kept = F.transform("__sec_gaps", lambda g: F.array_join(F.slice(chars, g["at"] + 1, g["n"]), ""))
        rest = F.slice(chars, F.col("__sec_rest") + 1, F.greatest(F.size(chars) - F.col("__sec_rest"), F.lit(0)))
        return F.concat(F.array_join(kept, mark), F.lit(mark), F.array_join(rest, ""))

    new = F.transform(F.array(F.split(text, "")), cut)[0]  # characters, once per text: slices of them are linear
    got = got.withColumn(text_col, F.when(live_here, new).otherwise(text))
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        got = got.withColumn(size_col, F.when(live_here, F.length(text_col).cast(kind)).otherwise(F.col(size_col)))
    return got.select(*docs.columns)
