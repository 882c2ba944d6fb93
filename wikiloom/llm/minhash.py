"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import connected_components, drop, join_counted, stage

#: A signature has CHUNKS x WIDTH symbols of 16 bits. Of two signatures that differ in at most CHUNKS * (ERRORS + 1) - 1
#: symbols, some chunk differs in at most ERRORS (pigeonhole); with one allowed error, a chunk is looked up once for each
#: symbol left out. 23 of 60 symbols: a pair of similarity 0.85 is missed with probability 3e-6, one of 0.9 with 1e-10.
CHUNKS, WIDTH, ERRORS = 12, 5, 1
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Members of a block and bytes of their sets (a longer text has a block to itself), and bytes of places up to which they are
#: broadcast beside the texts.
MEMBERS, BLOCK_BYTES, BROADCAST_BYTES = 512, 64 << 20, 16 << 20
_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(0, 2**63, CHUNKS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_KEY = _rng.integers(0, 2**63, (CHUNKS, WIDTH), dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return (x ^ (x >> np.uint64(29))) * _B


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words make one shingle, none an empty set."""
    ws = (text or b"").lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, len(ws))
    k = min(k, len(h))
    acc = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        acc = _mix(acc * _C + h[i : len(h) - k + 1 + i])
    return np.unique(acc)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(len(_MUL), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        low = np.minimum(low, (shingles[i : i + 2048, None] * _MUL).min(axis=0))
    return (_mix(low) >> np.uint64(48)).astype("<u2")


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, p, q, sig = [], [], [], []
            for t in batch.column(1):
                s = shingle_set(t.as_py(), k)
                n.append(len(s))
                d = xxhash.xxh3_128_intdigest(s.tobytes())
                p.append((d >> 64) - 2**63)
                q.append((d & (2**64 - 1)) - 2**63)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(p, pa.int64()), pa.array(q, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "n", "p", "q", "sig"])

    return run


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, sig) to the lookup keys of each signature: every chunk, with each of its symbols left out."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 2000):
            batch = whole.slice(lo, 2000)
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u2").reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
            out = np.empty((len(sig), CHUNKS, WIDTH), np.uint64)
            for e in range(WIDTH):
                rest = [i for i in range(WIDTH) if i != e]
                packed = sum((sig[:, :, i] << np.uint64(16 * j) for j, i in enumerate(rest)), np.zeros(sig.shape[:2], np.uint64))
                out[:, :, e] = _mix(packed ^ _KEY[None, :, e]) + _KEY[None, :, e]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(out.reshape(-1).view(np.int64)), pa.array(np.repeat(ids, CHUNKS * WIDTH))], names=["key", "id"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                batch = whole.slice(lo, 500)
                sets = [shingle_set(t.as_py(), k).view(np.int64) for t in batch.column(2)]
                ends = np.cumsum([0, *map(len, sets)])
                made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=["id", "places", "set"])

    return run


def _common(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Sizes of the intersections of the first ``first`` sets (rows) with the others, or with themselves if these are all."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    of, at, width = of[keep], number[at[keep]], int(shared.sum())
    order = np.argsort(at, kind="stable")
    of, at = of[order], at[order]
    rest = 0 if first == len(sets) else first
    out = np.zeros((first, len(sets) - rest), np.int64)
    for lo in range(0, width, 4096):
        i, j = np.searchsorted(at, [lo, lo + 4096])
        m = np.zeros((len(sets), min(4096, width - lo)), np.float32)
        m[of[i:j], at[i:j] - lo] = 1
        out += (m[:first] @ m[rest:].T).astype(np.int64)
    return out


def forest(link: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row id, column id) that span the components of a matrix of links."""
    out, new_rows, new_cols = [], np.ones(len(rows), bool), np.ones(len(cols), bool)
    for start in range(len(rows)):
        todo = [(0, start)] if new_rows[start] else []
        new_rows[start] = False
        while todo:
            side, at = todo.pop()
            line, new, ids, own = (link[at], new_cols, cols, rows[at]) if side == 0 else (link[:, at], new_rows, rows, cols[at])
            for x in np.flatnonzero(line & new).tolist():
                out.append((int(own), int(ids[x])))
                todo.append((1 - side, x))
            new &= ~line
    return out


def _links(percent: int):
    """Runs of (cluster, i, j, b, id, set), the members of two blocks of a cluster, to a forest (a, b) of their links."""

    def flush(run: list) -> list[tuple[int, int]]:
        i = run[0][1]
        run.sort(key=lambda x: (x[3] != i, x[4]))
        first = sum(x[3] == i for x in run)
        if first == 0 or run[0][1] != run[0][2] and first == len(run):
            return []
        ids = np.array([x[4] for x in run])
        sets = [x[5] for x in run]
        n = np.array([len(x) for x in sets], np.int64)
        common = _common(sets, first)
        rest = 0 if first == len(run) else first
        return forest(100 * common >= percent * (n[:first, None] + n[None, rest:] - common), ids[:first], ids[rest:])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            out = []
            for *key, b, i, s in zip(*(batch.column(k).to_pylist() for k in range(5)), batch.column(5)):
                if held and held[0][:3] != tuple(key):
                    out += flush(held)
                    held = []
                held.append((*key, b, i, s.values.to_numpy(zero_copy_only=False).view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
        if held:
            out = flush(held)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _spokes(percent: int):
    """Runs of (cluster, i, j, b, id, set), a centre (b = 0) and then members, to the links (centre, member)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centres = None, []
        for batch in batches:
            out = []
            for *key, b, i, s in zip(*(batch.column(k).to_pylist() for k in range(5)), batch.column(5)):
                x = s.values.to_numpy(zero_copy_only=False).view(np.uint64)
                if key != at:
                    at, centres = key, []
                if b == 0:
                    centres.append((i, x))
                    continue
                for c, y in centres:
                    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        out.append((c, i))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def _compare(places: DataFrame, texts: DataFrame, k: int, compare) -> DataFrame:
    """Brings the full sets of (id, cluster, i, j, b) together by (cluster, i, j), in order of b, and compares them. Sets are made once for each text."""
    places = stage(places, "places")
    small = places.count() * 40 <= BROADCAST_BYTES
    by_id = places.groupBy("id").agg(F.collect_list(F.struct("cluster", "i", "j", "b")).alias("places"))
    sets = texts.join(F.broadcast(by_id) if small else by_id, "id").select("id", "places", "text")
    sets = sets.mapInArrow(_sets(k), "id long, places array<struct<cluster:long,i:int,j:int,b:int>>, set array<long>")
    runs = sets.select(F.explode("places").alias("p"), "id", "set").select("p.cluster", "p.i", "p.j", "p.b", "id", "set")
    runs = runs.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "b")
    return stage(runs.mapInArrow(compare, "a long, b long"), "links")


def _pieces() -> Column:
    """How many blocks the aggregated rows need, by number and by bytes of their sets."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / MEMBERS), F.ceil(F.sum(F.col("n") * 8) / BLOCK_BYTES)).cast("int")


def spokes(candidates: DataFrame, nodes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links among the candidates (a, b), a the smallest of its buckets: every a meets its members in pieces, so a is copied once for each piece."""
    of = candidates.join(nodes.select(F.col("id").alias("b"), "n"), "b")
    sizes = stage(of.groupBy("a").agg(_pieces().alias("pieces"), F.count(F.lit(1)).alias("_c")), "sizes", F.count(F.lit(1)))
    members = join_counted(candidates, sizes, ["a"], "_c", candidates._measured, n_keys=sizes._measured)
    members = members.select(F.col("b").alias("id"), F.col("a").alias("cluster"), F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("i"), F.lit(0).alias("j"), F.lit(1).alias("b"))
    centres = sizes.select(F.col("a").alias("id"), F.col("a").alias("cluster"), F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("b"))
    return _compare(members.unionByName(centres), texts, k, _spokes(percent))


def _grouped_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, grp, sig) to the lookup keys of each signature with the id, n and group."""
    for batch in batches:
        at = 0
        for keys in _keys(iter([batch.select(["id", "sig"])])):
            rows = pa.array(np.repeat(np.arange(at, at + keys.num_rows // (CHUNKS * WIDTH)), CHUNKS * WIDTH))
            at += keys.num_rows // (CHUNKS * WIDTH)
            yield pa.RecordBatch.from_arrays([keys.column(0), *(batch.column(i).take(rows) for i in range(3))], names=["cluster", "id", "n", "grp"])


def unsettled(candidates: DataFrame, nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """(cluster, id, n, grp) of the nodes that share a bucket, which is the cluster, with a node of another group.

    ``groups`` (id, grp) are the components of the links found so far; nodes without links are groups of their own. Only
    groups that a candidate edge leaves are looked at; buckets with the same members count once.
    """
    of = lambda c: groups.select(F.col("id").alias(c), F.col("grp").alias(f"g{c}"))
    edges = candidates.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ga", "a").alias("ga"), F.coalesce("gb", "b").alias("gb")).where("ga <> gb")
    open_groups = stage(edges.select(F.explode(F.array("ga", "gb")).alias("grp")).distinct(), "open")
    some = nodes.join(groups, "id", "left").withColumn("grp", F.coalesce("grp", "id")).join(open_groups, "grp", "left_semi")
    keys = stage(some.select("id", "n", "grp", "sig").mapInArrow(_grouped_keys, "cluster long, id long, n long, grp long"), "keys", F.count(F.lit(1)))
    mark = F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("mark")
    buckets = keys.groupBy("cluster").agg(F.min("grp").alias("l"), F.max("grp").alias("h"), F.count(F.lit(1)).alias("_c"), mark).where("l < h")
    buckets = stage(buckets.groupBy("_c", "mark").agg(F.min("cluster").alias("cluster")).select("cluster", "_c"), "buckets", F.count(F.lit(1)))
    return stage(join_counted(keys, buckets, ["cluster"], "_c", keys._measured, n_keys=buckets._measured).select("cluster", "id", "n", "grp"), "unsettled", F.count(F.lit(1)))


def across(left: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """A forest (a, b) of the links in each bucket of several groups, from (cluster, id, n, grp); the bucket is the cluster.

    Groups of MEMBERS and more are cut into blocks of their own, smaller ones share blocks. Blocks of one cluster meet in
    pairs, but two blocks of one large group never; what a pair returns is at most one edge for each member.
    """
    sizes = left.groupBy("cluster", "grp").agg(F.count(F.lit(1)).alias("c"), _pieces().alias("pieces"), F.sum("n").alias("n"))
    large = sizes.where((F.col("c") >= MEMBERS) | (F.col("pieces") > 1))
    large = large.withColumn("last", F.sum("pieces").over(Window.partitionBy("cluster").orderBy("grp").rowsBetween(Window.unboundedPreceding, 0))).select("cluster", "grp", "pieces", "last")
    placed = left.join(large, ["cluster", "grp"], "left")
    mixed = placed.where("pieces is null").groupBy("cluster").agg(_pieces().alias("mixed"))
    total = large.groupBy("cluster").agg(F.max("last").alias("pure")).join(mixed, "cluster", "full").select("cluster", F.coalesce("pure", F.lit(0)).alias("pure"), F.coalesce("mixed", F.lit(0)).alias("mixed"))
    placed = placed.join(total, "cluster")
    block = F.when(F.col("pieces").isNull(), F.col("pure") + F.pmod(F.xxhash64("grp"), F.col("mixed"))).otherwise(F.col("last") - F.col("pieces") + F.pmod(F.xxhash64("id"), F.col("pieces"))).cast("int")
    placed = placed.withColumn("x", block)
    own = lambda y: F.col("pieces").isNotNull() & (y >= F.col("last") - F.col("pieces")) & (y < F.col("last"))
    meets = F.filter(F.sequence(F.lit(0), (F.col("pure") + F.col("mixed") - 1).cast("int")), lambda y: ~own(y))
    pairs = placed.select("id", "cluster", "x", F.explode(meets).alias("y")).select("id", "cluster", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), F.col("x").alias("b"))
    return _compare(pairs, texts, k, _links(percent))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when their sets of k-word shingles (A-Z lower-cased, words between ASCII white space) have
    100 * intersection >= percent * union; component_id is the smallest doc_id that links reach. Documents with equal
    sets are one node from the start. Each bucket of the multi-index join makes its members candidates of its smallest
    member, with which their full sets are compared first (``spokes``): most groups of copies are linked by that. Two nodes
    within the signature distance share a bucket, so what may still link are nodes that share one with a node of another
    group (``unsettled``); those meet in blocks across groups (``across``), and a forest of their links is returned. A group of
    copies never becomes all of its pairs, in no table.

    Null texts and texts without words have empty sets and link with nothing. Rows that share a doc_id count as one
    document; a null doc_id is linked with nothing and is its own (null) component. An empty table gives no rows;
    other columns are ignored.
    """
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").cast("binary").alias("text"))
    rows = stage(texts.mapInArrow(_sign(k), "doc_id long, n long, p long, q long, sig binary"), "sign")
    usable = rows.where("n > 0 and doc_id is not null")
    nodes = usable.groupBy("p", "q").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("_c"))
    nodes = stage(nodes, "nodes", F.count(F.lit(1)))
    keys = stage(nodes.select("id", "sig").mapInArrow(_keys, "key long, id long"), "keys")
    shared = keys.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("_c")).where("low < high")
    shared = stage(shared.select("key", "low", "_c"), "shared", F.count(F.lit(1)))
    met = join_counted(keys, shared, ["key"], "_c", CHUNKS * WIDTH * nodes._measured, n_keys=shared._measured)
    candidates = stage(met.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct(), "candidates", F.count(F.lit(1)))
    drop(keys, shared)
    repeated = rows.groupBy("doc_id").count().where("count > 1").limit(1).count()
    if repeated:
        texts = texts.dropDuplicates(["id", "text"])
    links = spokes(candidates, nodes, texts, k, percent)
    groups = stage(connected_components(links).select(F.col("node").alias("id"), F.col("component").alias("grp")), "groups")
    # A document's class is that of its set's node; what links two groups joins their classes.
    classes = nodes.select("p", "q", "id", "_c").join(groups, "id", "left").withColumn("grp", F.coalesce("grp", "id"))
    left = unsettled(candidates, nodes, groups)
    if left._measured:
        of = lambda c: groups.select(F.col("id").alias(c), F.col("grp").alias(f"g{c}"))
        more = across(left, texts, k, percent).join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("ga", "a").alias("a"), F.coalesce("gb", "b").alias("b"))
        joined = connected_components(more).select(F.col("node").alias("grp"), F.col("component").alias("top"))
        classes = classes.join(joined, "grp", "left").withColumn("grp", F.coalesce("top", "grp"))
    parts = stage(classes.select("p", "q", "id", "_c", "grp"), "classes")
    met = join_counted(usable.select("doc_id", "p", "q"), parts, ["p", "q"], "_c", nodes._measured).select("doc_id", "grp")
    parts = met.groupBy("doc_id").agg(F.min("grp").alias("component"), F.max("grp").alias("other"))
    if repeated:
        # Rows that share an id are one document, and make one class of theirs.
        met, parts = stage(met.distinct(), "met"), stage(parts, "parts")
        bridges = met.join(parts.where("component < other").select("doc_id", "component"), "doc_id").select(F.col("component").alias("a"), F.col("grp").alias("b"))
        joined = connected_components(bridges).select(F.col("node").alias("component"), F.col("component").alias("top"))
        parts = parts.join(joined, "component", "left").withColumn("component", F.coalesce("top", "component"))
    parts = parts.select("doc_id", "component")
    out = rows.join(parts, "doc_id", "left").withColumn("component_id", F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
