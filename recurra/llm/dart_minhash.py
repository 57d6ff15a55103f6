"""Near-duplicate classes by DartMinHash signatures, banded joins and exact verification.

Darts are thrown into the region (weight x rank) of every shingle: a unit-rate Poisson
process whose points are derived from the shingle's hash alone, each with a random
coordinate of the signature. A text keeps the darts that fall below its shingles' weights,
and a coordinate's sample is its earliest (lowest-rank) dart. Two texts share a sample with
probability equal to their weighted Jaccard similarity, and a text of n shingles needs
about n + K ln K darts, not n * K hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import (PrefixHash, keep_rows, mix64, raw_bytes, shingles, slices, small_batches,
                                stored, text_of, words)
from recurra.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 40, 6                  # a pair at 0.8 misses every band with probability 5e-6
#: Samples of a signature: the first BANDS * ROWS make the bands, all of them the estimate.
K = 480
BITS = 8                             # kept of each sample; two samples agree by chance 1 in 256
#: Estimated similarity below which a pair is not likely: 5 standard deviations of the
#: estimate under the threshold (a pair at 0.8 falls below with probability 9e-7, less than
#: it misses all bands).
ESTIMATE_SLACK = 5.0
#: Members of a bucket, and nodes of a cluster, are compared in blocks of this many rows.
BLOCK = 512
_U = np.uint64


# --- signatures -----------------------------------------------------------------------------

def text_shingles(texts: pa.Array, weighting: str = "set"
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, weight) of every distinct shingle, sorted by both.

    Weight is 1 ("set") or the number of times the shingle occurs ("count").
    """
    data, off = raw_bytes(texts)
    doc, start, end = words(data, off)
    at, sh = shingles(doc, PrefixHash(data).of(start, end), SHINGLE)
    doc = doc[at]
    order = np.lexsort((sh, doc))
    doc, sh = doc[order], sh[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (sh[1:] != sh[:-1])] if len(doc) else np.empty(0, bool)
    begin = np.flatnonzero(new)
    count = np.diff(np.r_[begin, len(doc)])
    weight = count.astype(float) if weighting == "count" else np.ones(len(begin))
    return doc[begin], sh[begin], weight


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int,
                    k: int = K) -> np.ndarray:
    """n_docs x k matrix of 16-bit samples; rows of texts without elements are 0.

    An element of weight w owns the strips [0,1), [1,2), [2,4), [4,8)... up to w. In a strip
    of height h the darts arrive in rank order with exponential gaps of mean 1/h; each has
    a position in the strip (kept if below w) and a coordinate. Ranks are thrown up to the
    bound at which k ln k + 2k darts are expected; texts that still lack a coordinate get
    a doubled bound, and their darts simply go on.
    """
    best = np.full(n_docs * k, np.iinfo(np.uint64).max, _U)
    if len(doc) == 0:
        return np.zeros((n_docs, k), np.uint16)
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(int) + 1, 1)
    own = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(own)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0.0, 2.0 ** np.maximum(level - 1, 0))
    height = np.where(level == 0, 1.0, low)
    s_doc, s_weight = doc[own], weight[own]
    with np.errstate(over="ignore"):
        s_seed = mix64(element[own] + level.astype(_U) * _U(0xD6E8FEB86659FD93))
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    bound = np.where(total > 0, (k * np.log(k) + 2 * k) / np.maximum(total, 1e-300), 0.0)
    rank = np.zeros(len(own))
    thrown = np.zeros(len(own), np.int64)
    live = np.arange(len(own))
    while len(live):
        todo = live
        while len(todo):
            step = int(max(1, min(64, 600_000 // len(todo),
                                  np.max((bound[s_doc[todo]] - rank[todo]) * height[todo]) + 1)))
            number = thrown[todo][:, None] + np.arange(step)
            with np.errstate(over="ignore"):
                h = mix64(s_seed[todo][:, None] + number.astype(_U) * _U(0x9E3779B97F4A7C15))
                g = mix64(h ^ _U(0xA0761D6478BD642F))
            gaps = -np.log(_uniform(h)) / height[todo][:, None]
            ranks = rank[todo][:, None] + np.cumsum(gaps, axis=1)
            inside = ranks < bound[s_doc[todo]][:, None]
            used = inside.sum(axis=1)
            # position in the strip from the top bits, coordinate and sample from the rest
            place = low[todo][:, None] + height[todo][:, None] * ((g >> _U(40)).astype(np.float64) * 2.0 ** -24)
            keep = inside & (place < s_weight[todo][:, None])
            coord = ((g >> _U(16)) & _U(0xFFFFFF)) % _U(k)
            slot = (s_doc[todo][:, None] * k + coord.astype(np.int64))[keep]
            packed = (ranks[keep].view(_U) & ~_U(0xFFFF)) | (g[keep] & _U(0xFFFF))
            np.minimum.at(best, slot, packed)
            full = used == step
            last = np.maximum(used, 1) - 1
            moved = np.where(used > 0, ranks[np.arange(len(todo)), last], rank[todo])
            rank[todo], thrown[todo] = moved, thrown[todo] + used
            todo = todo[full]
        lacking = (best.reshape(n_docs, k) == np.iinfo(np.uint64).max).any(axis=1) & (total > 0)
        bound = np.where(lacking, bound * 2, bound)
        live = live[lacking[s_doc[live]]]
    sig = (best & _U(0xFFFF)).astype(np.uint16).reshape(n_docs, k)
    sig[total == 0] = 0
    return sig


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of signature rows, corrected for samples that agree by chance."""
    chance = 2.0 ** -BITS
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def _set_keys(doc: np.ndarray, sh: np.ndarray, weight: np.ndarray, n_docs: int) -> list[bytes | None]:
    """128-bit key of each text's shingles with their weights (NULL without shingles)."""
    n = np.bincount(doc, minlength=n_docs)
    parts = []
    for salt in (0x1234567, 0x89ABCDE):
        with np.errstate(over="ignore"):
            each = mix64(mix64(sh ^ mix64(np.array([salt], _U))) + weight.astype(_U))
            sums = np.zeros(len(sh) + 1, _U)
            np.cumsum(each, out=sums[1:])
        to = np.cumsum(n)
        with np.errstate(over="ignore"):
            parts.append(mix64(sums[to] - sums[to - n] + n.astype(_U)))
    joined = np.stack(parts, axis=1)
    return [joined[i].tobytes() if n[i] else None for i in range(n_docs)]


def _sketch(weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("t")):
                doc, sh, weight = text_shingles(texts, weighting)
                m = len(texts)
                sig = dart_signatures(doc, sh, weight, m).astype(np.uint8)
                part = batch.slice(at, m)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("text_sha"),
                     pa.array(_set_keys(doc, sh, weight, m), pa.binary()),
                     pa.array(np.bincount(doc, weights=weight, minlength=m)),
                     pa.array([row.tobytes() for row in sig], pa.binary())],
                    names=["id", "text_sha", "set_key", "size", "sig"])
    return run


def sketches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             weighting: str = "set") -> DataFrame:
    """(id, text_sha, set_key, size, sig) of every text; ids travel as strings."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("string").alias("id"),
                       F.sha2(text_of(text_col), 256).alias("text_sha"), text_of(text_col).alias("t"))
    return rows.mapInArrow(_sketch(weighting), "id string, text_sha string, set_key binary, "
                                               "size double, sig binary")


# --- candidates -----------------------------------------------------------------------------

def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(band key, node) of every band of every signature."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8)
        keys = band_keys(sig.reshape(batch.num_rows, K))
        node = np.repeat(np.asarray(batch.column("node")), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)],
                                         names=["bucket", "node"])


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Rows x BANDS matrix of 64-bit bucket keys; a key tells its band too."""
    wide = sig[:, :BANDS * ROWS].reshape(len(sig), BANDS, ROWS).astype(_U)
    key = np.zeros(wide.shape[:2], _U)
    for i in range(ROWS):
        key |= wide[..., i] << _U(BITS * i)
    with np.errstate(over="ignore"):
        return mix64(key + (np.arange(BANDS, dtype=_U) + _U(1) << _U(BITS * ROWS)))


def _least_estimate(threshold: float) -> float:
    return threshold - ESTIMATE_SLACK * float(np.sqrt(threshold * (1 - threshold) / K))


def _likely(threshold: float):
    """Of pairs with both signatures, those whose sizes and estimate allow the threshold."""
    least = _least_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                    .reshape(batch.num_rows, K) for c in ("sig_a", "sig_b"))
            na, nb = (np.asarray(batch.column(c)) for c in ("size_a", "size_b"))
            ok = (estimate(a, b) >= least) & (np.minimum(na, nb) >= threshold * np.maximum(na, nb))
            yield batch.select(["a", "b"]).filter(pa.array(ok))
    return run


class Forest:
    """Union-find over small integers; a root is the least member of its tree."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart."""
        x, y = sorted((self.root(x), self.root(y)))
        self.up[y] = x
        return x != y


def _across(threshold: float):
    """Of one (bucket, block of stragglers, block of members): likely pairs that join different
    components, only as many as it takes to connect what they connect."""
    least = _least_estimate(threshold)

    def run(block: pa.Table) -> pa.Table:
        node, comp = np.asarray(block["node"]), np.asarray(block["comp"])
        size, side = np.asarray(block["size"]), np.asarray(block["side"])
        sig = np.frombuffer(b"".join(block["sig"].to_pylist()), np.uint8).reshape(len(node), K)
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        _, number = np.unique(comp, return_inverse=True)
        forest = Forest(len(node))
        top = number.copy()                            # a root of every row's component, kept up to date
        out_a, out_b = [], []
        for i in left:
            j = right[(top[right] != top[i])
                      & (np.minimum(size[right], size[i]) >= threshold * np.maximum(size[right], size[i]))]
            j = j[estimate(sig[j], sig[i]) >= least]
            for k in j.tolist():
                if forest.join(int(number[i]), int(number[k])):
                    out_a.append(min(node[i], node[k]))
                    out_b.append(max(node[i], node[k]))
            if len(j):
                roots = np.fromiter((forest.root(x) for x in range(int(number.max()) + 1)), np.int64)
                top = roots[number]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})
    return run


# --- exact links ----------------------------------------------------------------------------

def elements_of(texts: pa.Array, weighting: str) -> list[bytes]:
    """Each text's elements as sorted 64-bit integers: its shingles, or (``count``) one element
    for each time a shingle occurs, so that the Jaccard similarity of element sets is that of
    the shingle sets or multisets."""
    doc, sh, weight = text_shingles(texts, weighting)
    times = weight.astype(np.int64)
    own = np.repeat(np.arange(len(sh)), times)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(times) - times, times)
    doc = doc[own]
    with np.errstate(over="ignore"):
        element = np.where(nth == 0, sh[own], mix64(sh[own] + nth.astype(_U) * _U(0x9E3779B97F4A7C15)))
    order = np.lexsort((element, doc))
    to = np.cumsum(np.bincount(doc, minlength=len(texts)))
    raw = element[order].tobytes()
    return [raw[8 * x:8 * y] for x, y in zip([0, *to[:-1].tolist()], to.tolist())]


def _elements(weighting: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(at, len(texts)), pa.array(elements_of(texts, weighting), pa.binary())],
                    names=["node", "elements"])
    return run


def exact_links(elements: list[bytes], left: np.ndarray, right: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """Pairs (one of ``left``, one of ``right``) whose element sets reach the threshold.

    Common elements are counted by products of 0/1 matrices, a portion of the elements at a
    time; elements of a single text are in no product. Counts are exact in 32-bit floats.
    """
    size = np.array([len(e) // 8 for e in elements], np.int64)
    flat = np.frombuffer(b"".join(elements), _U)
    row = np.repeat(np.arange(len(elements)), size)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.r_[True, flat[1:] != flat[:-1]] if len(flat) else np.empty(0, bool)
    begin = np.flatnonzero(new)
    often = np.diff(np.r_[begin, len(flat)]) > 1
    number = np.cumsum(often) - 1
    which = np.cumsum(new) - 1
    pick = often[which] if len(which) else np.empty(0, bool)
    row, column = row[pick], number[which[pick]]
    common = np.zeros((len(left), len(right)), np.float32)
    place_l, place_r = np.full(len(elements), -1), np.full(len(elements), -1)
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    shared = int(often.sum())
    width = min(shared, max(256, (8 << 20) // max(1, len(left) + len(right))))
    for lo in range(0, shared, max(1, width)):
        x, y = np.searchsorted(column, [lo, lo + width])
        r, c = row[x:y], column[x:y] - lo
        a, b = np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)
        some = place_l[r] >= 0
        a[place_l[r[some]], c[some]] = 1
        some = place_r[r] >= 0
        b[place_r[r[some]], c[some]] = 1
        common += a @ b.T
    either = size[left][:, None] + size[right][None, :] - common
    hit_l, hit_r = np.nonzero(common >= threshold * either - 1e-6)
    return zip(left[hit_l].tolist(), right[hit_r].tolist())


def _link_blocks(threshold: float):
    """From a partition sorted by (cluster, i, j): the exact links of each block pair, as links to the
    least node of every component of the block. (cluster, a, b)."""
    def block(cluster: int, same: bool, node: np.ndarray, side: np.ndarray, elements: list[bytes]) -> pa.RecordBatch:
        left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if not same else (np.arange(len(node)),) * 2
        order = np.argsort(node, kind="stable")
        place = np.empty(len(node), np.int64)
        place[order] = np.arange(len(node))                  # the forest's roots are least nodes
        forest = Forest(len(node))
        for x, y in exact_links(elements, left, right, threshold):
            forest.join(int(place[x]), int(place[y]))
        root = np.fromiter((forest.root(x) for x in range(len(node))), np.int64, len(node))
        linked = np.flatnonzero(root != np.arange(len(node)))
        by_place = node[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(linked), cluster)), pa.array(by_place[root[linked]]), pa.array(by_place[linked])],
            names=["cluster", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            return block(key[0], key[1] == key[2], np.array([h[0] for h in held], np.int64),
                         np.array([h[1] for h in held]), [h[2] for h in held])

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("cluster", "i", "j", "node", "side", "elements")))
            for cluster, i, j, node, side, elements in rows:
                if held and (cluster, i, j) != key:
                    yield done()
                    held = []
                key = (cluster, i, j)
                held.append((node, side, elements))
        if held:
            yield done()
    return run


def linked_roots(clusters: DataFrame, elements: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of the nodes with an exact link; ``clusters`` is (node, cluster, n): every pair of
    likely links is in one cluster, of n nodes.

    All pairs of a cluster are compared. A cluster of up to BLOCK nodes is one group and its
    components are final; a larger one is cut into blocks, each pair of blocks is a group of its
    own, and the groups' links (fewer than their rows) go through ``components``.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = (clusters.withColumn("blocks", blocks)
            .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).join(elements, "node"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = rows.select("cluster", "node", "elements", "mine", others).select(
        "cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "node",
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "elements")
    found = stored(pairs.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
                   .mapInArrow(_link_blocks(threshold), "cluster long, a long, b long"))
    large = clusters.filter(F.col("n") > BLOCK).select("cluster").distinct()
    small = found.join(large, "cluster", "left_anti")
    roots = small.select(F.col("b").alias("node"), F.col("a").alias("root"))
    cut = found.join(large, "cluster", "left_semi").select("a", "b")
    return roots if cut.isEmpty() else roots.unionByName(components(cut))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, weighting: str = "set") -> DataFrame:
    """One row per input row: doc_id, text_sha, class_id, class_size, kept.

    A class is a connected component of the links "similarity of the 5-word shingles is at
    least ``threshold``". Similarity is Jaccard, of sets or (``weighting="count"``) of
    multisets. ``class_id`` is the class's smallest id (NULL ids last) and one row of the
    class is kept. A text of 1 to 4 words has one shingle, all its words; a text without
    words, NULL included, is a class of its own. Rows with the same shingle set (or
    multiset) are first reduced to one node, so copies never meet in pairs. An empty table gives no rows.

    In a band bucket the smallest node is the pivot, and every member is compared with it by
    signature; then, in blocks, the bucket's stragglers (members outside its largest
    component) with its members, and a block hands on only the links that connect it. Nodes
    connected by likely links make a cluster. Inside a cluster all pairs are compared exactly, so
    that no likely pair needs a row, a join or a text of its own: rows grow with the nodes.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    sketched = stored(sketches(docs, id_col=id_col, text_col=text_col, weighting=weighting)
                      .withColumn("doc_id", F.col("id").cast(id_type)).drop("id"))
    nodes = stored(
        sketched.filter("set_key is not null").groupBy("set_key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_sha")).alias("m"),
             F.count("*").alias("copies"), F.first("size").alias("size"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "set_key", "size", "sig",
                F.col("m.doc_id").alias("doc_id"), F.col("m.text_sha").alias("text_sha"), "copies"))

    banded = nodes.select("node", "sig").mapInArrow(_band_rows, "bucket long, node long")
    shared = banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).filter("n > 1")
    members = stored(banded.join(shared, "bucket").select("bucket", "node", "pivot"))
    sigs = nodes.select("node", "size", "sig")

    def side(name: str) -> DataFrame:
        return sigs.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"),
                           F.col("sig").alias(f"sig_{name}"))

    stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    likely = stored(stars.join(side("a"), "a").join(side("b"), "b")
                    .mapInArrow(_likely(threshold), "a long, b long"))
    roots = components(likely)

    # what the stars left open: pairs of one bucket in different components
    placed = (members.join(roots, "node", "left")
              .select("bucket", "node", F.coalesce("root", "node").alias("comp")))
    per_comp = placed.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    open_buckets = (per_comp.groupBy("bucket")
                    .agg(F.count("*").alias("comps"), F.sum("n").alias("n"),
                         F.max(F.struct("n", F.col("comp").alias("c"))).alias("big"))
                    .filter("comps > 1 and n > 2")     # the pair of a bucket of two is known
                    .select("bucket", F.col("big.c").alias("big"),
                            F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                            F.ceil((F.col("n") - F.col("big.n")) / BLOCK).cast("int").alias("s_blocks")))
    rows = (placed.join(open_buckets, "bucket").withColumn("straggler", F.col("comp") != F.col("big"))
            .withColumn("m_block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
            .withColumn("s_block", F.pmod(F.xxhash64("node"), F.col("s_blocks")).cast("int")))
    as_member = rows.select("bucket", "node", "comp", F.lit(1).alias("side"), F.col("m_block").alias("j"),
                            F.explode(F.sequence(F.lit(0), F.col("s_blocks") - 1)).alias("i"))
    as_straggler = rows.filter("straggler").select(
        "bucket", "node", "comp", F.lit(0).alias("side"), F.col("s_block").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"))
    rest = stored(
        as_member.unionByName(as_straggler).join(sigs, "node")
        .groupBy("bucket", "i", "j").applyInArrow(_across(threshold), "a long, b long"))

    placed_in = roots.select("node", F.col("root").alias("cluster"))
    if not rest.isEmpty():                                # these links join whole components
        ends = (rest.join(roots.select(F.col("node").alias("a"), F.col("root").alias("root_a")), "a", "left")
                .join(roots.select(F.col("node").alias("b"), F.col("root").alias("root_b")), "b", "left")
                .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")))
        tops = components(ends)
        known = roots.unionByName(tops.join(roots.select("node"), "node", "left_anti"))
        placed_in = (known.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
                     .select("node", F.coalesce("top", "root").alias("cluster")))
    placed_in = stored(placed_in)
    clusters = stored(placed_in.join(placed_in.groupBy("cluster").agg(F.count("*").alias("n")), "cluster"))

    # one text of every node in a cluster, as elements
    key = F.struct("doc_id", "text_sha").alias("key")
    wanted = clusters.select("node").join(nodes.select("node", "doc_id", "text_sha"), "node").select("node", key)
    texts = docs.select(F.struct(F.col(id_col).alias("doc_id"),
                                 F.sha2(text_of(text_col), 256).alias("text_sha")).alias("key"),
                        text_of(text_col).alias("text"))
    elements = stored(texts.join(wanted, "key").select("node", "text")
                      .mapInArrow(_elements(weighting), "node long, elements binary").dropDuplicates(["node"]))
    linked = linked_roots(clusters, elements, threshold)
    named = nodes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_sha")
    classes = (named.groupBy("root").agg(F.min(lowest).alias("m"), F.sum("copies").alias("class_size"))
               .select("root", F.col("m.doc_id").alias("class_id"), F.col("m.text_sha").alias("keep_sha"),
                       "class_size"))
    by_set = named.select("set_key", "root").join(classes, "root").drop("root")
    with_set = (sketched.filter("set_key is not null").select("doc_id", "text_sha", "set_key")
                .join(by_set, "set_key")
                .select("doc_id", "text_sha", "class_id", "class_size",
                        (F.col("doc_id").eqNullSafe(F.col("class_id"))
                         & (F.col("text_sha") == F.col("keep_sha"))).alias("kept")))
    alone = (sketched.filter("set_key is null")
             .select("doc_id", "text_sha", F.col("doc_id").alias("class_id"),
                     F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")))
    return with_set.unionByName(alone)


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that stay (one per class), columns unchanged."""
    return keep_rows(docs, near_duplicates(docs, id_col=id_col, text_col=text_col, **params),
                     id_col=id_col, text_col=text_col)
