"""MinHash near-duplicates by a signature-coordinate inverted join.

1. A text's words (runs of non-whitespace, A-Z lower-cased) give a set of
   distinct five-word shingles, and the set a signature of ``COORDS`` minima.
   Documents with equal sets form a class at once; one signature stands for it.
2. Classes are posted under each (coordinate, value) token. Two signatures that
   agree in a number of coordinates, ``least_matches``, share a token among each
   one's prefix, which is all but that number less one of its most frequent tokens; so only prefixes are
   merged, tokens of one class are skipped, and the commonest lists are never
   opened. Candidates whose full signatures agree in fewer coordinates are
   dropped. The number follows from the similarity asked for: a pair that just
   reaches it falls short with a probability of ``MISS`` at most (32 of 64 for 0.75).
3. Every candidate is confirmed on the full sets of both texts.

Pairs inside a hot list are not all formed, and no link is lost for it:

- Every list has a pivot, its most central class (by its tokens' frequencies).
  Members are held against it; links give components. Lists that still hold more
  than one component get a second pivot outside the first one's component.
- What is left are pairs in different components. For two members x and y of one
  pivot p, differences from p tell: if x isn't linked to p, x and y can only be
  similar enough if they share a shingle that p lacks, or if y has fewer
  shingles than p by a margin that grows with x's distance from p. So members
  are joined on shingles that their pivot lacks, which are rare; and the few
  within the margin on the prefix of the shingles that they share with p.
- For that, every list takes the pivot that most of its members agree with best.

Rows without words link with nothing. In :func:`near_duplicates` a null id takes no
part: its row is kept, with a null component; rows that repeat an id are one
document. :func:`drop_near_duplicates` judges every row by itself, also where ids are
null or repeated: of a group the row with the smallest id stays (null last). An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import U64, Words, bounded_broadcast, mix, slices, stored, text_array, window_hashes
from fieldkpi.llm.components import components

WIDTH = 5
SIMILARITY_PCT = 75
COORDS = 64
MISS = 1e-5
SIG_ROWS = 30_000  # signatures in a file
TEXT_ROWS = 2_000  # texts in a file, or pairs of texts that a task compares
PIVOT_MATCH = 16  # coordinates in which a class agrees with a pivot that it votes for

_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 1 << 63, COORDS, dtype=U64) | U64(1)
_ADD = _rng.integers(0, 1 << 63, COORDS, dtype=U64)


def least_matches(pct: int) -> int:
    """The most coordinates that signatures of pairs with ``pct`` percent similarity agree in but for a share ``MISS`` of them."""
    p, short, k = pct / 100, 0.0, 0
    while k < COORDS and (short := short + math.comb(COORDS, k) * p ** k * (1 - p) ** (COORDS - k)) <= MISS:
        k += 1
    return max(k, 1)


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """Per document of a slice the sorted distinct hashes of its shingles."""
    w = Words(data, off)
    h, at = window_hashes(w.hashes(), w.first, width)
    return [np.unique(h[a:b]) for a, b in zip(at[:-1], at[1:])]


def signatures(docs: DataFrame, id_col: str, text_col: str, width: int = WIDTH) -> DataFrame:
    """id, ``n_shingles``, ``h1`` and ``h2`` (hashes of the set), ``sig`` (tokens by coordinate; null without shingles)."""
    def run(batches):
        for batch in batches:
            texts = text_array(batch.column(1))
            for a, b, data, off in slices(texts):
                sets = shingle_sets(data, off, width)
                n = np.array([len(s) for s in sets], np.int64)
                has = np.flatnonzero(n)
                sig = np.zeros((len(has), COORDS), U64)
                h1 = np.zeros(len(n), U64)
                h2 = np.zeros(len(n), U64)
                if len(has):
                    flat = np.concatenate(sets)
                    at = np.concatenate([[0], np.cumsum(n[has])[:-1]])
                    h1[has] = np.add.reduceat(flat, at)
                    h2[has] = np.add.reduceat(mix(flat ^ U64(0x5DEECE66D)), at)
                    for j in range(COORDS):
                        low = np.minimum.reduceat((flat * _MUL[j] + _ADD[j]) >> U64(8), at)
                        sig[:, j] = mix(low ^ (U64(j + 1) << U64(57)))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(np.where(n > 0, COORDS, 0))]).astype(np.int32)), pa.array(sig.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), lists],
                    names=["id", "n_shingles", "h1", "h2", "sig"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_shingles long, h1 long, h2 long, sig array<long>")


def _confirm(pairs: DataFrame, texts: DataFrame, width: int, pct: int) -> DataFrame:
    """Of ``pairs`` (a, b) those whose full sets are similar enough."""
    both = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches):
        for batch in batches:
            left, right = text_array(batch.column(2)), text_array(batch.column(3))
            for lo in range(0, len(left), 64):
                sets = [[s for _, _, data, off in slices(t.slice(lo, 64)) for s in shingle_sets(data, off, width)] for t in (left, right)]
                ok = []
                for x, y in zip(*sets):
                    inter = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(100 * inter >= pct * (len(x) + len(y) - inter) and inter > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 64), batch.column(1).slice(lo, 64)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, pct: int = SIMILARITY_PCT):
    """(members, edges): per row id, ``n_shingles`` and ``rep``, its class's
    smallest id (null without words); and confirmed edges between classes that
    join every component."""
    match = least_matches(pct)
    pivot_match = min(PIVOT_MATCH, match // 2)
    s = stored(signatures(docs, id_col, text_col, width), "nd_sig")
    n_rows = s.count()
    some = s.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stored(some.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("rep"), F.first("sig").alias("sig")), "nd_class", n_rows, SIG_ROWS)
    n_classes = classes.count()
    members = stored(s.select("id", "n_shingles", "h1", "h2").join(classes.select("h1", "h2", "n_shingles", "rep"), ["h1", "h2", "n_shingles"], "left")
                     .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep")), "nd_member", n_rows)

    tokens = classes.select("rep", F.explode("sig").alias("token"))
    lists = tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    prefix = (tokens.join(lists, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"), F.sum(F.floor(F.log2("n") * 16)).alias("central"))
        .where(F.size("t") >= match).select("rep", "central", F.explode(F.slice("t", F.lit(1), F.size("t") - (match - 1))).alias("t")))
    posts = stored(prefix.select("rep", "central", F.col("t.token").alias("token")).distinct(), "nd_post", n_classes * COORDS)
    n_posts = posts.count()
    sigs = stored(classes.select("rep", "sig").join(posts.select("rep").distinct(), "rep", "left_semi"), "nd_psig", n_classes, SIG_ROWS)
    texts = stored(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                   .join(posts.select(F.col("rep").alias("id")).distinct(), "id", "left_semi"), "nd_text", n_rows, TEXT_ROWS)

    # rows that repeat an id join their classes
    many = members.where("rep IS NOT NULL").groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    edges = members.where("rep IS NOT NULL").join(many.select("id", "a"), "id").where("a <> rep").select("a", F.col("rep").alias("b"))

    def against(pairs: DataFrame) -> DataFrame:
        """rep, p and the number of coordinates in which their signatures agree."""
        q = (pairs.join(sigs.select("rep", F.col("sig").alias("sa")), "rep").join(sigs.select(F.col("rep").alias("p"), F.col("sig").alias("sb")), "p"))
        same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + x)
        return q.select("rep", "p", same.alias("agree"))

    def linked(pairs: DataFrame) -> DataFrame:
        near = pairs.select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct()
        return _confirm(near, texts, width, pct)

    def crossing(found: DataFrame) -> DataFrame:
        """Postings of the lists that hold more than one component, with it."""
        p = posts.join(components(found).withColumnRenamed("node", "rep"), "rep", "left").select(
            "token", "rep", "central", F.coalesce("component", "rep").alias("c"))
        mixed = p.groupBy("token").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 <> c1").select("token")
        return stored(p.join(mixed, "token", "left_semi"), "nd_cross", n_posts)

    centre = F.max(F.struct("central", "rep")).alias("x")
    first = posts.groupBy("token").agg(centre).select("token", F.col("x.rep").alias("p"))
    tried = stored(against(posts.join(first, "token").where("rep <> p").select("rep", "p").distinct()).where(F.col("agree") >= pivot_match), "nd_pairs", n_posts)
    found = stored(edges.unionAll(linked(tried.where(F.col("agree") >= match))), "nd_edge", n_rows + tried.count(), TEXT_ROWS)
    cross = crossing(found)
    if pct >= 100 or cross.isEmpty():
        return members, found

    lead = cross.groupBy("token").agg(F.max(F.struct("central", "rep", "c")).alias("x")).select("token", F.col("x.c").alias("lead"))
    others = cross.join(lead, "token").where("c <> lead")
    second = others.groupBy("token").agg(centre).select("token", F.col("x.rep").alias("p"))
    more = stored(against(others.join(second, "token").where("rep <> p").select("rep", "p").distinct()
                          .join(tried, ["rep", "p"], "left_anti")).where(F.col("agree") >= pivot_match), "nd_pairs", n_posts)
    found = stored(found.unionAll(linked(more.where(F.col("agree") >= match))), "nd_edge", found.count() + more.count(), TEXT_ROWS)
    cross = crossing(found)
    if cross.isEmpty():
        return members, found

    # each list gets the pivot that most of its members hold, and so has one whose differences settle all its pairs
    c = cross.select("rep", "c").distinct()
    near = tried.unionAll(more).join(c.select("rep"), "rep", "left_semi")
    near = near.unionAll(near.select(F.col("p").alias("rep"), "p", F.lit(COORDS).alias("agree")).distinct())
    near = near.groupBy("rep").agg(F.max(F.struct("agree", "p")).alias("x")).select("rep", F.col("x.p").alias("p"))
    votes = cross.join(near, "rep").groupBy("token", "p").agg(F.count("*").alias("n"))
    mode = votes.groupBy("token").agg(F.max(F.struct("n", "p")).alias("x")).select("token", F.col("x.p").alias("mode"))
    settled = first.join(mode, "token", "left").select("token", F.coalesce("mode", "p").alias("p"))
    held = stored(cross.join(settled, "token").select("rep", "c", "p").distinct(), "nd_held", n_posts)
    sure, pairs = _same_pivot(held, texts, width, pct)
    rest = stored(pairs.select(F.col("a").alias("rep"), F.col("b").alias("p")), "nd_pairs")
    return members, stored(found.unionAll(sure).unionAll(linked(rest)), "nd_edge", found.count() + held.count() + rest.count(), TEXT_ROWS)


def _same_pivot(held: DataFrame, texts: DataFrame, width: int, pct: int) -> tuple[DataFrame, DataFrame]:
    """(links, pairs), each (a, b): links of classes with a pivot ``p`` that they
    hold, and pairs of classes in different components ``c`` that hold the same
    pivot and that may be similar enough by their differences from it.

    For a class x: ``plus`` shingles that p lacks, ``minus`` shingles of p that x
    lacks, and ``far`` = f * (plus + minus) - |x| - |p| with f = (100 + pct) / (100 - pct),
    above 0 if x isn't linked to p. If x and y share no plus shingle, they differ
    by at least plus_x + minus_x + plus_y - minus_y, so that a link needs
    far_x <= (f - 1) * (minus_y - plus_y).

    A linked class also shares at least pct % of x, so that many of x's plus
    shingles if p has few of x: then only x's rarest ones need be looked up. And
    two linked classes share at least (plus_x + minus_x + plus_y + minus_y -
    (|x| + |y|) / f) / 2 - min(minus_x, minus_y) plus shingles, which can't be
    more than either shares with any class at all."""
    f = (100 + pct) / (100 - pct)
    both = (held.join(texts.select(F.col("id").alias("rep"), F.col("text").alias("t")), "rep")
            .join(texts.select(F.col("id").alias("p"), F.col("text").alias("tp")), "p").select("rep", "p", "c", "t", "tp"))

    def differ(batches):
        for batch in batches:
            left, right = text_array(batch.column(3)), text_array(batch.column(4))
            for lo in range(0, len(left), 64):
                rows = [batch.column(k).slice(lo, 64) for k in range(3)]
                sets = [[s for _, _, data, off in slices(t.slice(lo, 64)) for s in shingle_sets(data, off, width)] for t in (left, right)]
                plus, keep, far, short, opened, minus = [], [], [], [], [], []
                for x, p in zip(*sets):
                    inside = np.isin(x, p, assume_unique=True)
                    add, kept = x[~inside], x[inside]
                    gone = len(p) - len(kept)
                    plus.append(add.view(np.int64))
                    keep.append(kept[: max(0, len(kept) - -(-pct * len(x) // 100) + 1)].view(np.int64))
                    need = max(1, -(-pct * len(x) // 100) - len(kept))  # plus shingles that a linked class shares at least
                    opened.append(max(0, len(add) - need + 1))
                    far.append(((100 + pct) * (len(add) + gone) - (100 - pct) * (len(x) + len(p))) / (100 - pct))
                    minus.append(gone)
                    short.append((f - 1) * (gone - len(add)))
                lists = [pa.array(v, pa.list_(pa.int64())) for v in (plus, keep)]
                yield pa.RecordBatch.from_arrays([*rows, *lists, pa.array(far, pa.float64()), pa.array(short, pa.float64()), pa.array(opened, pa.int32()),
                                                 pa.array(minus, pa.int32()), pa.array([len(x) for x in sets[0]], pa.int32())],
                                                 names=["rep", "p", "c", "plus", "keep", "far", "short", "open", "minus", "size"])
    kind = held.schema["rep"].dataType.simpleString()
    d = stored(both.mapInArrow(differ, f"rep {kind}, p {kind}, c {kind}, plus array<long>, keep array<long>, far double, short double, open int, minus int, size int"), "nd_differ", held.count(), TEXT_ROWS)
    bound = d.groupBy("p").agg(F.max("short").alias("most"), F.min(F.when(F.col("far") > 0, F.col("far"))).alias("least"))
    within = d.join(bound, "p").where(((F.col("far") > 0) & (F.col("far") <= F.col("most"))) | (F.col("short") >= F.col("least")))
    facts = ["p", "rep", "c", "far", "short", "size", "minus", F.size("plus").alias("a")]
    each = (d.select(*facts, F.lit(0).alias("kind"), F.explode("plus").alias("s"), F.size("plus").alias("n"), "open")
            .unionAll(within.select(*facts, F.lit(1).alias("kind"), F.explode("keep").alias("s"), F.size("keep").alias("n"), F.size("keep").alias("open"))))
    often = each.groupBy("p", "kind", "s").agg(F.count("*").alias("f"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("f > 1")
    facts = ["p", "rep", "c", "far", "short", "size", "minus", "a", "kind"]
    ranked = (each.join(often, ["p", "kind", "s"]).groupBy(*facts, "n", "open")
              .agg(F.sort_array(F.collect_list(F.struct("f", "s", (F.col("c0") != F.col("c1")).alias("mixed")))).alias("x")))
    # of each class the ``open`` rarest, of which those in one component only are skipped
    shared = stored(ranked.select(*facts, F.size("x").alias("most"), F.explode(F.slice("x", F.lit(1), F.greatest(F.lit(0), F.col("open") - F.col("n") + F.size("x")))).alias("x"))
                    .where("x.mixed").select(*facts, "most", F.col("x.s").alias("s")), "nd_shared")
    x, y = shared.alias("x"), shared.alias("y")
    fewest = (F.col("x.a") + F.col("x.minus") + F.col("y.a") + F.col("y.minus") - (F.col("x.size") + F.col("y.size")) / f) / 2 - F.least("x.minus", "y.minus")
    either = ((F.col("x.far") > 0) & (F.col("x.far") <= F.col("y.short"))) | ((F.col("y.far") > 0) & (F.col("y.far") <= F.col("x.short")))
    may = F.when(F.col("x.kind") == 0, (fewest <= F.least("x.most", "y.most")) & ((F.col("x.far") > 0) | (F.col("y.far") > 0))).otherwise(either)
    pairs = x.join(y, (F.col("x.p") == F.col("y.p")) & (F.col("x.kind") == F.col("y.kind")) & (F.col("x.s") == F.col("y.s"))
                   & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.c") != F.col("y.c")) & may)
    sure = d.where("far <= 0 AND rep <> p").select(F.col("rep").alias("a"), F.col("p").alias("b"))
    return sure, pairs.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    pct: int = SIMILARITY_PCT) -> DataFrame:
    """A row per row of ``docs``: id, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links, itself included) and ``kept``."""
    members, found = links(docs, id_col, text_col, width, pct)
    comp = components(found).withColumnRenamed("node", "rep")
    return (members.join(comp, "rep", "left").select(
        F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "rep", "id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that have a link to another that stays, all columns as they are."""
    odd = docs.groupBy(id_col).count().where(F.col(id_col).isNull() | (F.col("count") > 1))
    if odd.isEmpty():
        gone = stored(near_duplicates(docs, id_col, text_col).where("NOT kept").select(id_col).distinct(), "nd_gone")
        return docs.join(bounded_broadcast(gone, 200_000), id_col, "left_anti").select(*docs.columns)
    # ids that don't tell rows apart: rows are numbered in a stored copy
    rows = stored(docs.withColumn("__nd_row", F.monotonically_increasing_id()), "nd_rows")
    groups = near_duplicates(rows, "__nd_row", text_col).select("__nd_row", "component_id")
    named = rows.select("__nd_row", F.struct(F.col(id_col).isNull().alias("last"), F.col(id_col).alias("id"), "__nd_row").alias("order")).join(groups, "__nd_row")
    first = named.groupBy("component_id").agg(F.min("order").alias("o")).select("component_id", F.col("o.__nd_row").alias("stays"))
    gone = stored(groups.join(first, "component_id").where("__nd_row <> stays").select("__nd_row"), "nd_gone")
    return rows.join(bounded_broadcast(gone, 200_000), "__nd_row", "left_anti").select(*docs.columns)
