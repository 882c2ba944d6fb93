"""Suffix-array dedup: bytes covered by long strings that occur twice, by column-wise multi-document construction."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_counted, reads_alike, stage, unstage

#: Bytes of an anchor, contexts that one construction holds, distinct contexts of an anchor over which its strings are
#: counted by hash instead (about 1.5 KB of a worker's memory each), and bytes of text worked on at once.
ANCHOR, CONTEXTS, HOT, SLAB = 32, 16384, 65536, 1 << 20
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes (k a power of two) from each position, by doubling."""
    h, n = (b.astype(np.uint64) + np.uint64(1)) * _A, 1
    while n < k:
        h = h[:-n] * _B + (h[n:] ^ (h[n:] >> np.uint64(29))) * _A
        n *= 2
    h = (h ^ (h >> np.uint64(32))) * _B
    return (h ^ (h >> np.uint64(29))) | np.uint64(1)


def _slide(x: np.ndarray, w: int, f) -> np.ndarray:
    """f over each run of w values."""
    n = 1
    while 2 * n <= w:
        x = f(x[:-n], x[n:])
        n *= 2
    return f(x[: len(x) - (w - n)], x[w - n :]) if w > n else x


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(text number, positions, hashes): in every string of ``length`` bytes, the places of the least hash of ANCHOR bytes.

    The choice depends on the string's bytes alone, so two copies of a string have the same anchors at the same places.
    """
    w = length - ANCHOR + 1
    whole = np.frombuffer(b"".join(texts), np.uint8)
    if len(whole) < length:
        return
    h = _gram_hashes(whole, ANCHOR)
    low = _slide(h, w, np.minimum)
    at = 0
    for t in texts:  # strings do not cross texts
        at += len(t)
        low[max(0, at - length + 1) : at] = 0
    wide = np.zeros(len(h) + w - 1, np.uint64)
    wide[w - 1 : w - 1 + len(low)] = low
    chosen = np.flatnonzero(_slide(wide, w, np.maximum) == h)
    ends = np.cumsum([len(t) for t in texts])
    of = np.searchsorted(ends, chosen, "right")
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    for i in range(len(texts)):
        if cuts[i] < cuts[i + 1]:
            c = chosen[cuts[i] : cuts[i + 1]]
            yield i, c - (ends[i] - len(texts[i])), h[c]


def _find(length: int):
    left, schema = length - ANCHOR, ["dk", "pos", "h", "c"]

    def flush(keys: list, texts: list) -> pa.RecordBatch:
        dk, pos, hs, cs = [], [], [], []
        for i, at, h in anchors(texts, length):
            t = texts[i]
            dk.append(np.full(len(at), keys[i], np.int64))
            pos.append(at)
            hs.append(h.view(np.int64))
            cs.append(np.array([xxhash.xxh3_64_intdigest(t[max(0, p - left) : p + length], min(p, left)) for p in at.tolist()], np.uint64).view(np.int64))
        join = lambda x, t: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), t)
        return pa.RecordBatch.from_arrays([join(dk, pa.int64()), join(pos, pa.int64()).cast(pa.int32()), join(hs, pa.int64()), join(cs, pa.int64())], names=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, texts, held = [], [], 0
        for b in batches:
            for k, t in zip(b.column(0), b.column(1)):
                t = t.as_py()
                if len(t) < length:
                    continue
                keys.append(k.as_py())
                texts.append(t)
                held += len(t)
                if held >= SLAB:
                    yield flush(keys, texts)
                    keys, texts, held = [], [], 0
        if texts:
            yield flush(keys, texts)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compresses the last column: texts are what weighs most in the shuffles."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([pack(t.as_py()) for t in b.columns[-1]], pa.binary())], names=b.schema.names)


def _contexts(length: int):
    """(packed text, at: list of (pos, h, c)) to (h, c, a, ctx): the bytes around each anchor, a of them before it."""
    left, unpack = length - ANCHOR, zstandard.decompress

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 50):
                b = whole.slice(lo, 50)
                h, c, a, ctx = [], [], [], []
                for t, at in zip(b.column(0), b.column(1)):
                    t = unpack(t.as_py())
                    for x in at.as_py():
                        p = x["pos"]
                        h.append(x["h"])
                        c.append(x["c"])
                        a.append(min(p, left))
                        ctx.append(t[max(0, p - left) : p + length])
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(c, pa.int64()), pa.array(a, pa.int32()), pa.array(ctx, pa.binary())], names=["h", "c", "a", "ctx"])

    return run


def repeated_starts(group: np.ndarray, a: np.ndarray, ctx: list[bytes], length: int) -> np.ndarray:
    """For each context, the columns at which a string of ``length`` bytes starts that another context of its group has there.

    The contexts of an anchor are aligned at it. Columns are read from the last to the first, out of an external file with
    one sequential run for each column; each round puts one symbol before every document's suffix. The suffixes of a
    column are kept in order (of group, then text): a stable sort by the new symbol of the order so far, as in the
    Burrows-Wheeler transform of a collection. The common prefix of two neighbours is one more than the least common
    prefix between their places before, and 0 where a text has ended. ``group`` must be sorted.
    """
    left, m = length - ANCHOR, len(ctx)
    width = left + length
    rows = np.full((m, width), 256, np.uint16)
    for j, (x, n) in enumerate(zip(ctx, a.tolist())):
        rows[j, left - n : left - n + len(x)] = np.frombuffer(x, np.uint8)
    flags = np.zeros((m, left + 1), bool)
    with tempfile.TemporaryFile() as columns:
        for t in range(width, 0, -16):
            columns.write(np.ascontiguousarray(rows[:, max(0, t - 16) : t].T[::-1]))
        del rows
        columns.seek(0)
        order, common = np.arange(m), np.zeros(m + 1, np.int32)
        for t in range(width - 1, -1, -1):
            symbol = np.frombuffer(columns.read(2 * m), np.uint16)
            key = group[order] * 257 + symbol[order]
            perm = np.argsort(key, kind="stable")
            key = key[perm]
            same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % 257 != 256))
            fresh = np.zeros(m + 1, np.int32)
            if len(same):
                ends = np.empty(2 * len(same), np.intp)
                ends[::2], ends[1::2] = perm[same] + 1, perm[same + 1] + 1
                fresh[same + 1] = 1 + np.minimum.reduceat(common, ends)[::2]
            order, common = order[perm], fresh
            if t <= left and len(same):
                long = np.flatnonzero(common >= length)
                flags[order[long], t] = True
                flags[order[long - 1], t] = True
    return flags


def _construct(length: int):
    left = length - ANCHOR

    def flush(h, c, a, ctx) -> pa.RecordBatch:
        hs = np.array(h, np.int64)
        group = np.cumsum(np.diff(hs, prepend=hs[:1]) != 0)
        flags = repeated_starts(group.astype(np.int64), np.array(a), ctx, length)
        # All strings of a context hold its anchor: what they cover reaches from the first one's start to the last one's end.
        row = np.flatnonzero(flags.any(axis=1))
        lo, last = flags[row].argmax(axis=1), left - flags[row, ::-1].argmax(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(hs[row]), pa.array(np.array(c, np.int64)[row]), pa.array((lo - left).astype(np.int32)), pa.array((last - left + length).astype(np.int32))], names=["h", "c", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, c, a, ctx = [], [], [], []
        for b in batches:
            for x in zip(*(col.to_pylist() for col in b.columns)):
                if h and x[:2] == (h[-1], c[-1]):
                    continue
                if len(h) >= CONTEXTS and x[0] != h[-1]:
                    yield flush(h, c, a, ctx)
                    h, c, a, ctx = [], [], [], []
                for to, v in zip((h, c, a, ctx), x):
                    to.append(v)
        if h:
            yield flush(h, c, a, ctx)

    return run


def _strings(length: int):
    """Contexts of hot anchors to a row for each string around the anchor: (s1, s2, h, c, lo)."""
    left = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                out: list[list] = [[], [], [], [], []]
                for h, c, a, x in zip(*(col.to_pylist() for col in whole.slice(at, 200).columns)):
                    for i in range(len(x) - length + 1):
                        d = xxhash.xxh3_128_intdigest(x[i : i + length], left - a + i)
                        for to, v in zip(out, ((d >> 64) - 2**63, (d & (2**64 - 1)) - 2**63, h, c, i - a)):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int64()) for v in out[:4]), pa.array(out[4], pa.int32())], names=["s1", "s2", "h", "c", "lo"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(dk, lo: list, hi: list) to (dk, spans): runs that touch become one."""
    for b in batches:
        out = []
        for lo, hi in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            lo, hi = np.array(lo), np.array(hi)
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            first = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
            last = np.concatenate([first[1:] - 1, [len(lo) - 1]])
            out.append(np.stack([lo[first], hi[last]], axis=1).reshape(-1).tolist())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["dk", "spans"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 200):
            b = whole.slice(lo, 200)
            n, gone, kept = [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                t = zstandard.decompress(t)
                # A context may end with its text: the last run is cut to the text's length.
                at, parts, spans = 0, [], [min(x, len(t)) for x in spans or []]
                for x, y in zip(spans[::2], spans[1::2]):
                    parts.append(t[at:x])
                    at = y
                parts.append(t[at:])
                n.append(len(t))
                gone.append(sum(spans[1::2]) - sum(spans[::2]))
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array([len(s or ()) // 2 for s in b.column(2).to_pylist()], pa.int64()), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept])], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256.

    Every byte goes that is covered by a string of ``length`` bytes which also starts anywhere else, in another document
    or further on in the same. Strings are judged on the input. Exact.

    1. Anchors are chosen in every string (see ``anchors``) and counted by hash: a string can only be repeated where its
       anchor is, and anchors that occur once go. 2. Contexts (all strings around an anchor) that occur twice are
       repeated as a whole. 3. The distinct contexts of an anchor with several are compared by column-wise construction
       (``repeated_starts``); anchors with over HOT of them, by counting their strings' hashes with map-side sums, so
       that no anchor's contexts meet in one task. 4. Runs are merged per document and cut out.

    Null texts count as empty; texts shorter than ``length`` stay as they are; rows equal in id and text are copies of
    each other and both go; ids may be null or repeated; an empty table gives no rows; other columns are ignored.
    """
    left = length - ANCHOR
    raw = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).cast("binary").alias("text"))
    # Numbers of rows hold as long as each reading is alike.
    raw = (raw if reads_alike(raw) else stage(raw, "texts")).withColumn("dk", F.monotonically_increasing_id())
    found = stage(raw.select("dk", "text").mapInArrow(_find(length), "dk long, pos int, h long, c long"), "anchors")
    # Most anchors stand alone: they go before anything else is known of them than their hash.
    shared = stage(found.groupBy("h").agg(F.count(F.lit(1)).alias("total")).where("total > 1"), "shared")
    near = stage(join_counted(found, shared, ["h"], "total", found.count()).select("dk", "pos", "h", "c"), "anchors")
    unstage(found, shared)
    found = near
    kinds = stage(found.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("dk", "pos")).alias("at")), "kinds")
    unlike = stage(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "unlike")
    unsettled = join_counted(kinds, unlike, ["h"], "d", kinds.count()).select("at.dk", F.struct("at.pos", "h", "c", "d").alias("x")).groupBy("dk").agg(F.collect_list("x").alias("x"))
    unsettled = stage(unsettled, "unsettled")

    packed = raw.select("doc_id", "dk", "text").mapInArrow(_pack, "doc_id long, dk long, text binary")

    def contexts(test) -> DataFrame:
        marks = unsettled.select("dk", F.filter("x", test).alias("x")).where(F.size("x") > 0)
        return packed.join(marks, "dk").select("text", "x").mapInArrow(_contexts(length), "h long, c long, a int, ctx binary")

    few = contexts(lambda x: x["d"] <= HOT).repartition("h").sortWithinPartitions("h", "c").mapInArrow(_construct(length), "h long, c long, lo int, hi int")
    few = stage(few, "few")
    hot = stage(contexts(lambda x: x["d"] > HOT).mapInArrow(_strings(length), "s1 long, s2 long, h long, c long, lo int"), "strings")
    unstage(unsettled, unlike)
    # A string at a place fixes the anchor, so c alone tells its contexts apart.
    twice = hot.groupBy("s1", "s2").agg(F.min("c").alias("f"), F.max("c").alias("l")).where("f <> l").select("s1", "s2")
    many = hot.join(twice, ["s1", "s2"]).groupBy("h", "c").agg(F.min("lo").alias("lo"), (F.max("lo") + length).alias("hi"))
    once = kinds.where("n = 1").select("h", "c", "at.dk", "at.pos")
    single = few.unionByName(many).join(once, ["h", "c"]).select("dk", (F.col("pos") + F.col("lo")).alias("lo"), (F.col("pos") + F.col("hi")).alias("hi"))
    several = join_counted(found, kinds.where("n > 1").select("h", "c", "n"), ["h", "c"], "n", found.count()).select("dk", F.greatest(F.col("pos") - left, F.lit(0)).alias("lo"), (F.col("pos") + length).alias("hi"))
    spans = single.unionByName(several).groupBy("dk").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))
    spans = stage(spans.mapInArrow(_merge, "dk long, spans array<int>"), "spans")
    unstage(few, hot, kinds, found)
    return packed.join(spans, "dk", "left").select("doc_id", "text", "spans").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")
