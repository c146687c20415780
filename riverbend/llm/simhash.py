"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits, each read as a word
of the perfect binary Golay code of 23 bits (4,096 codewords, every word within three bits
of exactly one of them). The *keys* of a segment are the codewords nearest to the word
itself and to the 23 words one bit away: one key, or six. Two words at most two bits apart
have a word at most one bit from both, and so share a key.

Pigeonhole: of four differing bits over three segments, some two segments hold at most two
together. Fingerprints that may link therefore agree in the keys of both segments of one of
the three pairs, 24 bits. Rows meet by that key, and every pair in a bucket is verified by
the count of differing bits.

Cost: at most 108 (on average about 85) key rows of 16 bytes for each *distinct*
fingerprint; equal fingerprints are one node. A task streams the buckets of its sorted
partition and passes on a spanning forest, at most one row a fingerprint and batch,
never the pairs. A bucket of more than ``block_rows`` fingerprints is dealt in blocks: each
pair of blocks is a group of its own, of bounded size. Components come from star
contraction over tables written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbend.llm.common import written

SEED = 42
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift, bits
BATCH_ROWS = 1 << 19


# -- fingerprints ---------------------------------------------------------------------------

def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every ``width``-word shingle, A-Z lower-cased; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII only
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    width = min(width, len(words))
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(whole[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())),
                       np.uint64, len(starts))


def fingerprint(text: str | None, width: int = 4) -> int:
    """64 bits as a signed long: a bit is 1 if set in over half of the hashes; 0 without words."""
    hashes = shingle_hashes(text, width)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at: at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8))
    return int.from_bytes(bits.tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(doc_id, h, fp)`` per row; ``h`` tells texts of one id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), width) for t in b.column("t")]
            yield pa.RecordBatch.from_arrays(
                [b.column("i"), b.column("h"), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("h"),
                        F.col(text_col).alias("t"))
            .mapInArrow(run, f"doc_id {kind}, h bigint, fp bigint"))


# -- Golay keys -----------------------------------------------------------------------------

#: Generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b101011100011


def _remainder(x: np.ndarray) -> np.ndarray:
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= ((x >> bit) & 1) * (GOLAY << (bit - 11))
    return x


def golay_errors() -> np.ndarray:
    """For each of the 2,048 remainders the one pattern of at most three bits that leaves it."""
    one = 1 << np.arange(23, dtype=np.int64)
    i, j, k = (x.ravel() for x in np.meshgrid(range(23), range(23), range(23), indexing="ij"))
    patterns = np.unique(np.concatenate([[0], one[i] | one[j] | one[k]]))
    out = np.full(2048, -1, np.int64)
    out[_remainder(patterns)] = patterns
    return out


def golay_index(words: np.ndarray, errors: np.ndarray) -> np.ndarray:
    """Index 0 to 4095 of the codeword nearest to each 23-bit word."""
    return (words ^ errors[_remainder(words)]) >> 11


def golay_keys(words: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word, sorted, in six columns, and which of the columns are filled."""
    near = words[:, None] ^ np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])[None, :]
    index = np.sort(golay_index(near, errors), axis=1)
    first = np.concatenate([np.ones((len(words), 1), bool), index[:, 1:] != index[:, :-1]], axis=1)
    place = np.cumsum(first, axis=1) - 1
    out, filled = np.zeros((len(words), 6), np.int64), np.zeros((len(words), 6), bool)
    row = np.nonzero(first)[0]
    out[row, place[first]] = index[first]
    filled[row, place[first]] = True
    return out, filled


def keyed(fps: np.ndarray, errors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (key, fingerprint) rows: pair of segments, key of the one, key of the other."""
    u = fps.view(np.uint64)
    keys = [golay_keys(((u >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64), errors)
            for s, n in SEGMENTS]
    out_key, out_fp = [], []
    for pair, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        both = (keys[a][0][:, :, None] << 12) | keys[b][0][:, None, :] | (pair << 24)
        ok = keys[a][1][:, :, None] & keys[b][1][:, None, :]
        out_key.append(both[ok])
        out_fp.append(np.broadcast_to(fps[:, None, None], ok.shape)[ok])
    return np.concatenate(out_key), np.concatenate(out_fp)


# -- links ----------------------------------------------------------------------------------

def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links reduced to (node, smallest node of its component), itself left out."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    own = root != np.arange(len(nodes))
    return nodes[own], nodes[root[own]]


def bucket_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within the runs of equal, sorted ``keys``."""
    a, b, held = [], [], 0
    step, at = 0, np.arange(len(keys))
    while len(at):
        step += 1
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        near = np.bitwise_count((fps[at] ^ fps[at + step]).view(np.uint64)) <= max_bits
        if near.any():
            a.append(fps[at[near]])
            b.append(fps[at[near] + step])
            held += len(a[-1])
        if held > 4 * BATCH_ROWS:  # a forest replaces the links it came from
            x, y = forest(np.concatenate(a), np.concatenate(b))
            a, b, held = [x], [y], 0
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return forest(np.concatenate(a), np.concatenate(b))


def _links(rows: DataFrame, max_bits: int, block_rows: int) -> DataFrame:
    """Streams partitions sorted by key. Rows out: a link ``(a, b, 0)`` or, for a bucket of
    over ``block_rows`` rows, which is left to blocks, ``(key, null, its rows)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                               pa.array(n, pa.int64())], ["a", "b", "n"])

        def solve(k, f):
            x, y = bucket_links(k, f, max_bits)
            if len(x):
                yield out(x, y, np.zeros(len(x), np.int64))

        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        big_key, big_rows = None, 0
        for batch in batches:
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if big_key is not None:
                cut = int(np.searchsorted(k, big_key, "right"))
                big_rows, k, f = big_rows + cut, k[cut:], f[cut:]
                if not len(k):
                    continue
                yield out([big_key], [None], [big_rows])
                big_key, big_rows = None, 0
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            # buckets known to be over their bound
            start = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1]) if len(keys) else np.empty(0, int)
            size = np.diff(np.concatenate([start, [len(keys)]]))
            if (size > block_rows).any():
                for s, n in zip(start[size > block_rows], size[size > block_rows]):
                    if s + n == len(keys):
                        big_key, big_rows = int(keys[s]), int(n)
                    else:
                        yield out([int(keys[s])], [None], [int(n)])
                keep = np.repeat(size <= block_rows, size)
                keys, fps = keys[keep], fps[keep]
            if len(keys) >= BATCH_ROWS:
                last = 0 if big_key is not None else int(np.searchsorted(keys, keys[-1], "left"))
                cut = len(keys) if big_key is not None else last
                yield from solve(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if big_key is not None:
            yield out([big_key], [None], [big_rows])
        yield from solve(keys, fps)

    return rows.mapInArrow(run, "a bigint, b bigint, n bigint")


def similar(fps: DataFrame, max_bits: int = 4, block_rows: int = 4096) -> DataFrame:
    """Links ``(a, b)`` that span the components of the distinct column ``fp``."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        errors = golay_errors()
        for batch in batches:
            all_fps = batch.column(0).to_numpy()
            for at in range(0, len(all_fps), 4096):
                k, f = keyed(all_fps[at: at + 4096], errors)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(f)], ["key", "fp"])

    if max_bits > 4:
        raise ValueError("three Golay segments prove links of at most 4 bits")
    rows = fps.select("fp").mapInArrow(explode, "key bigint, fp bigint")
    found = written(_links(rows.repartition("key").sortWithinPartitions("key"), max_bits, block_rows),
                    "simhash-links")
    links = found.where("n = 0").select("a", "b")
    heavy = found.where("n > 0").select(F.col("a").alias("key"), "n")
    if heavy.isEmpty():
        return links
    # A heavy bucket's rows are dealt by hash to blocks of about half the bound; the group of
    # each pair of blocks has both. There are at most rows / block_rows heavy buckets.
    blocks = F.ceil(2 * F.col("n") / block_rows).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (rows.join(heavy.select("key", blocks.alias("blocks")), "key")
             .select("key", "fp", own.alias("x"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"))
             .select("key", "fp", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    grouped = dealt.select(F.xxhash64("key", "x", "y").alias("key"), "fp")
    more = _links(grouped.repartition("key").sortWithinPartitions("key"), max_bits, 1 << 40)
    return links.unionByName(written(more, "simhash-block-links").select("a", "b"))


# -- components -----------------------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node but the roots; root: the smallest node reachable.

    Large-star and small-star steps until nothing changes; only a count and a checksum of
    the links come to the driver.
    """
    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"),
                                                 F.least("a", "b").alias("v")).distinct(), "stars")
    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.select("u", F.col("m").alias("v")).unionByName(
            met.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small, "stars")
        now = state(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_components(docs: DataFrame, width: int = 4, max_bits: int = 4, block_rows: int = 4096,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, h, fp, component_id)`` per row; see ``near_duplicates``."""
    rows = written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-nodes")
    stars = components(similar(nodes, max_bits, block_rows))
    rooted = nodes.join(stars, nodes["fp"] == stars["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = written(rooted.join(ids, "root").select("fp", "component_id"), "fingerprint-components")
    return rows.join(named, "fp").select("doc_id", "h", "fp", "component_id")


def near_duplicates(docs: DataFrame, width: int = 4, max_bits: int = 4, block_rows: int = 4096,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, fingerprint, component_id`` for every row.

    Null and empty texts, and texts without a word, have the fingerprint zero and link like
    any other. Fewer than ``width`` words: the whole sequence is the one shingle. Repeated
    rows come back as often as they came. Rows of a null id take part; the component's id is
    the smallest id that is not null, or null if there is none. Empty table: no rows. Only
    the two named columns are read.
    """
    return with_components(docs, width, max_bits, block_rows, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 4, max_bits: int = 4, block_rows: int = 4096,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, of which each component keeps one: that of the
    smallest id (null ids last), of rows of that id the one of the smallest text hash."""
    found = with_components(docs, width, max_bits, block_rows, id_col, text_col)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    # A group all of null ids has no component id; its fingerprint's own rows stand for it.
    kept = (found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("f"))
            .agg(F.min(order).alias("o"), F.count("*").alias("n"))
            .select(F.col("o.doc_id").alias("i"), F.col("o.h").alias("k")))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.col(id_col).alias("i"), F.xxhash64(text_col).alias("k"))
    kept = written(kept, "kept")
    copies = written(found.groupBy("doc_id", "h").count().where("count > 1")
                     .select(F.col("doc_id").alias("i"), F.col("h").alias("k")), "repeated")
    same = lambda a, b: a["i"].eqNullSafe(b["i"]) & (a["k"] == b["k"])
    left = rows.join(kept, same(rows, kept), "left_semi")
    if copies.isEmpty():
        return left.select("row.*")
    once = left.join(copies, same(left, copies), "left_anti")
    many = left.join(copies, same(left, copies), "left_semi").dropDuplicates(["i", "k"])
    return once.unionByName(many).select("row.*")
