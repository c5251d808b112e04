"""Conversation prefix trie by time-forward processing.

A node is a distinct sequence of first turns; its members are the conversations
that start with it. Subtree totals (leaves, tokens saved by sharing) go from
children to parents in reverse level order:

1. Turns become narrow rows, a digest of role and text and the text's length.
   Conversations are read as streams, ordered by turn, and each prefix gets a key,
   the hash of its parent's key and the turn's digest. No text moves and no
   conversation is held in memory.
2. Prefix keys are counted. Those with more than a ten-thousandth of all rows (64
   at least) as members are heavy. As a row has at most nine prefixes on average
   (its own turn and eight shared ones), fewer than 90,000 nodes are heavy, at any
   size. The first light node on a path is a shard root.
3. Light members are dealt by shard root and sorted, externally, by level from
   the deepest, key and conversation. In that stream a node's members are
   neighbours; a node takes its children's messages off a priority queue, adds its
   own and posts to its parent. The queue spills sorted runs to the task's own
   temporary file, which has no name and ends with the task.
4. Shard roots' totals are summed per heavy parent (partial aggregation), and the
   heavy nodes go through the same stream, up to the root.

A message carries the child's whole row, which is returned once the parent is
processed and its smallest member known; so no join is needed but one with the
heavy nodes, for shard roots.

Turns are ordered by turn (null first), ties by their digest. Null role and text
count as empty. Rows with a null conversation id belong to no conversation and take
no part; repeated rows are turns of their own. An empty table gives an empty result,
without even a root. Further columns are ignored. One conversation is a stream of
one task, and the ids that end at one node are hashed by one task, as SHA-256 has
to be; both in bounded memory.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import struct
import tempfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldkpi.llm.common import stored

GROUP = 5        # conversations share turns with the one whose id is the next multiple below
SHARED = 9       # first turns taken from there: the id's checksum modulo this
MIN_HEAVY = 64
HEAVY_SHARE = 10_000
IDS_A_CHUNK = 4096
QUEUE_RECORDS = 300_000
BATCH = 20_000
ROOT = bytes(16)

PATHS = "depth int, key binary, parent binary, conv long, n_bytes long, ends boolean, shard binary"
NODES = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
         "ends_sha256 string, up binary")


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Narrow rows: ``conv``, ``turn``, ``digest`` of role and text, ``n_bytes`` of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))


def _streamed(rows: DataFrame) -> DataFrame:
    """Rows dealt by sharing group; within it the base conversation first, each by turn."""
    rows = rows.withColumn("base", F.col("conv") - F.col("conv") % GROUP)
    return (rows.repartition("base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.col("turn").asc_nulls_first(), "digest")
            .select("base", "conv", "digest", "n_bytes"))


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[bytes, int]]]]:
    """(conversation, its rebuilt turns) in the order of the stream."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
    for base, group in itertools.groupby(rows, lambda r: r[0]):
        first: list[tuple[bytes, int]] = []
        for conv, own in itertools.groupby(group, lambda r: r[1]):
            def joined(conv=conv, own=own):
                if conv == base:
                    for _, _, digest, n in own:
                        if len(first) < SHARED - 1:
                            first.append((digest, n))
                        yield digest, n
                else:
                    taken = zlib.crc32(str(conv).encode()) % SHARED
                    yield from first[:taken]
                    for _, _, digest, n in itertools.islice(own, taken, None):
                        yield digest, n

            yield conv, joined()


def _path(parts: Iterator[tuple[bytes, int]]) -> Iterator[tuple[int, bytes, bytes | None, int, bool]]:
    """(depth, key, parent, bytes, whether it is the last) of each prefix, the empty one first."""
    held = (0, ROOT, None, 0)
    for digest, n in parts:
        yield *held, False
        depth, key = held[:2]
        held = (depth + 1, hashlib.sha256(key + digest).digest()[:16], key, n)
    yield *held, True


def _batches(rows: Iterator[tuple], names: list[str], kinds: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((key,) for _, parts in _rebuilt(batches) for depth, key, *_ in _path(parts) if depth)
    return _batches(rows, ["key"], [pa.binary()])


def _members(heavy):
    names = [c.split()[0] for c in PATHS.split(", ")]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = heavy.value

        def rows():
            for conv, parts in _rebuilt(batches):
                shard = None
                for depth, key, parent, n, ends in _path(parts):
                    if shard is None and depth and key not in many:
                        shard = key
                    yield depth, key, parent, conv, n, ends, shard

        return _batches(rows(), names, kinds)

    return run


class SpillingQueue:
    """A priority queue of equally long byte strings; what exceeds ``limit`` goes to sorted runs on disk."""

    def __init__(self, limit: int, size: int):
        self.limit, self.size = limit, size
        self.heap: list[bytes] = []
        self.runs: list[tuple[bytes, int, Iterator[bytes]]] = []
        self.spills = 0

    def push(self, record: bytes) -> None:
        heapq.heappush(self.heap, record)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        run.writelines(sorted(self.heap))
        run.seek(0)
        self.heap = []
        self.spills += 1
        records = iter(lambda: run.read(self.size), b"")
        heapq.heappush(self.runs, (next(records), self.spills, records))

    def pop(self, prefix: bytes) -> Iterator[bytes]:
        """Takes the records that start with ``prefix``; none may come before them."""
        while self.heap or self.runs:
            spilled = bool(self.runs) and (not self.heap or self.runs[0][0] < self.heap[0])
            record = self.runs[0][0] if spilled else self.heap[0]
            if not record.startswith(prefix):
                if record < prefix:
                    raise ValueError("a message has no receiver in its shard")
                return
            if spilled:
                _, number, records = self.runs[0]
                following = next(records, None)
                if following is None:
                    heapq.heappop(self.runs)
                else:
                    heapq.heapreplace(self.runs, (following, number, records))
            else:
                heapq.heappop(self.heap)
            yield record


# receiver's place in reverse level order (level from the deepest, key); then the child's row
_PLACE, _CHILD = ">I16s", ">qqqqqq32s"


def _place(depth: int, key: bytes) -> bytes:
    return struct.pack(_PLACE, 0xFFFFFFFF - depth, key)


def _forward(limit: int):
    """Rows sorted by level from the deepest, key and conversation become nodes with subtree totals."""
    names = [c.split()[0] for c in NODES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    head = struct.calcsize(_PLACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit, head + struct.calcsize(_CHILD))

        def nodes():
            rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
            for (depth, key), members in itertools.groupby(rows, lambda r: r[:2]):
                conv, n_convs, children, leaves, saved, given, ids = None, 0, 0, 0, 0, None, hashlib.sha256()
                some = False
                for _, _, parent, c, n, n_bytes, ends, sha, k, lv, sv, top in members:
                    conv = c if conv is None else min(conv, c)
                    n_convs, children, leaves, saved, given = n_convs + n, children + k, leaves + lv, saved + sv, sha
                    if ends:
                        ids.update(b",%d" % c if some else b"%d" % c)
                        some = True
                for record in queue.pop(_place(depth, key)):
                    *child, sha = struct.unpack_from(_CHILD, record, head)
                    children, leaves, saved = children + 1, leaves + child[4], saved + child[5]
                    yield child[0], child[1], conv, *child[2:], sha.hex(), None
                row = (conv, depth, n_convs, children, leaves if children else 1, saved + (n_convs - 1) * n_bytes)
                sha = given or ids.hexdigest()
                if top:
                    yield row[0], row[1], None, *row[2:], sha, parent
                else:
                    queue.push(_place(depth - 1, parent) + struct.pack(_CHILD, *row, bytes.fromhex(sha)))

        return _batches(nodes(), names, kinds)

    return run


def _ids_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))

    def hashed():
        for key, parts in itertools.groupby(rows, lambda r: r[0]):
            ids = hashlib.sha256()
            for i, (_, text) in enumerate(parts):
                ids.update(("," if i else "").encode() + text.encode())
            yield key, ids.hexdigest()

    return _batches(hashed(), ["key", "sha"], [pa.binary(), pa.string()])


def prefix_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                min_heavy: int = MIN_HEAVY, queue_records: int = QUEUE_RECORDS) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``."""
    spark = conversations.sparkSession
    rows = stored(turns(conversations, conv_col, turn_col, role_col, text_col), "trie_turns")
    many = max(min_heavy, rows.count() // HEAVY_SHARE)
    counts = _streamed(rows).mapInArrow(_keys, "key binary").groupBy("key").count()
    heavy = spark.sparkContext.broadcast(frozenset(bytes(r["key"]) for r in counts.where(F.col("count") > many).select("key").collect()))
    paths = stored(_streamed(rows).mapInArrow(_members(heavy), PATHS), "trie_paths")

    zero, no_sha = F.lit(0).cast("long"), F.lit(None).cast("string")
    light = paths.where(F.col("shard").isNotNull()).repartition("shard").select(
        "depth", "key", "parent", "conv", F.lit(1).cast("long").alias("n_convs"), "n_bytes", "ends", no_sha.alias("sha"),
        zero.alias("k"), zero.alias("lv"), zero.alias("sv"), (F.col("key") == F.col("shard")).alias("top"))
    light = stored(light.sortWithinPartitions(F.desc("depth"), "key", "conv").mapInArrow(_forward(queue_records), NODES), "trie_light")

    upper = paths.where(F.col("shard").isNull())
    # ids in chunks of bounded length, joined in order by a stream
    chunks = upper.where("ends").groupBy("key", F.floor(F.col("conv") / IDS_A_CHUNK).alias("chunk")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    chunks = chunks.select("key", "chunk", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))
    shas = chunks.repartition("key").sortWithinPartitions("key", "chunk").select("key", "text").mapInArrow(_ids_hash, "key binary, sha string")
    sums = light.where(F.col("up").isNotNull()).groupBy(F.col("up").alias("key")).agg(
        F.count("*").alias("k"), F.sum("n_leaves").alias("lv"), F.sum("saved_tokens").alias("sv"))
    nodes = upper.groupBy("key").agg(F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.min("conv").alias("conv"),
                                     F.count("*").alias("n_convs"), F.first("n_bytes").alias("n_bytes"))
    nodes = stored(nodes.join(shas, "key", "left").join(sums, "key", "left"), "trie_heavy")
    tops = nodes.select(
        "depth", "key", "parent", "conv", "n_convs", "n_bytes", F.lit(False).alias("ends"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("sha"),
        *(F.coalesce(c, zero).alias(c) for c in ("k", "lv", "sv")), (F.col("depth") == 0).alias("top"))
    # fewer than 90,000 rows at any size
    tops = tops.repartition(1).sortWithinPartitions(F.desc("depth"), "key").mapInArrow(_forward(queue_records), NODES)
    above = F.broadcast(nodes.select(F.col("key").alias("up"), F.col("conv").alias("up_conv")))
    got = light.join(above, "up", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
    columns = [c.split()[0] for c in NODES.split(", ")][:-1]
    return got.select(*columns).unionByName(tops.select(*columns))


def trie_sql(table: str = "conversations") -> str:
    """DuckDB SQL for :func:`prefix_trie`: every node meets every ancestor (small tables)."""
    # the checksum's fixed polynomial and start
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ord((c::VARCHAR)[i])::BIGINT)), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)")
    digest = "sha256(CAST(octet_length(encode(r)) AS VARCHAR) || ':' || r || x)"
    return f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM {table} WHERE conv_id IS NOT NULL),
g AS (SELECT c, turn, {digest} AS s, octet_length(encode(x)) AS b FROM t),
o AS (SELECT c, list(s ORDER BY turn NULLS FIRST, s) AS s, list(b ORDER BY turn NULLS FIRST, s) AS b FROM g GROUP BY c),
h AS (SELECT c, s, b, {crc} % {SHARED} AS h FROM o),
p AS (SELECT a.c, list_concat(coalesce(z.s, [])[1:a.h], a.s[a.h + 1:]) AS s, list_concat(coalesce(z.b, [])[1:a.h], a.b[a.h + 1:]) AS b
      FROM h a LEFT JOIN h z ON z.c = a.c - a.c % {GROUP}),
n AS (SELECT c, s, b, unnest(range(0, len(s) + 1)) AS d FROM p),
k AS (SELECT c, d, s[1:d] AS path, array_to_string(s[1:d], ',') AS k, coalesce(b[d], 0) AS w, d = len(s) AS ends FROM n),
node AS MATERIALIZED (
  SELECT k, d, any_value(path) AS path, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS own,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM k GROUP BY k, d
),
up AS MATERIALIZED (SELECT k, d, array_to_string(path[1:d - 1], ',') AS pk FROM node WHERE d > 0),
child AS (SELECT pk, d - 1 AS d, count(*) AS n FROM up GROUP BY pk, d),
below AS (
  SELECT array_to_string(path[1:i], ',') AS k, i AS d, count(*) FILTER (WHERE leaf) AS n_leaves, sum(own) AS saved
  FROM (SELECT path, own, ch.n IS NULL AS leaf, unnest(range(0, node.d + 1)) AS i FROM node LEFT JOIN child ch ON ch.pk = node.k AND ch.d = node.d) GROUP BY 1, 2
)
SELECT node.conv_id, CAST(node.d AS BIGINT) AS depth, par.conv_id AS parent_conv_id, node.n_convs, CAST(coalesce(child.n, 0) AS BIGINT) AS n_children,
       CAST(below.n_leaves AS BIGINT) AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.k = node.k AND below.d = node.d
LEFT JOIN child ON child.pk = node.k AND child.d = node.d
LEFT JOIN up ON up.k = node.k AND up.d = node.d
LEFT JOIN node par ON par.k = up.pk AND par.d = node.d - 1"""
