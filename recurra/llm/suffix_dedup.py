"""Removal of byte strings that repeat across documents, by sorting suffixes deep-shallow.

A byte goes if it lies in a 50-byte string (a window) that also starts in a document with a
smaller id. Windows are the first 50 bytes of suffixes, so equal windows are neighbours in
suffix order and the smallest id of a group of neighbours decides. The suffixes are never
shuffled one by one:

1. Every window belongs to the anchor it contains: its 16-byte gram of least hash (leftmost
   if tied). Equal windows have equal anchors, and the windows of one anchor are
   consecutive; the bytes they cover are the anchor's block. Per document and block one
   narrow row (gram hash, block hash, id) is shuffled by gram hash.
2. Blocks that are equal as a whole (128 bits of hash agree) need no sorting: all windows of
   the later documents' copies go. What is left are grams with several different blocks,
   and of each such block the first document.
3. The bytes of those blocks are fetched and shuffled by gram. In each task the suffixes at
   all windows are sorted deep-shallow: lexsort by 8-byte words to a shallow
   depth, then rounds of lexsort at branch positions (found by skipping the shared prefix) for the
   groups that still agree.
4. The verdicts are gathered per document, and the covered bytes are cut out of the text.
"""

from __future__ import annotations

import gc
import hashlib
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import _U, PrefixHash, mix64, raw_bytes, slices, small_batches, text_of
from recurra.session import ensure_checkpoint_dir

LENGTH = 50                      # bytes of a string that counts
GRAM = 16
#: A gram with more different blocks than this is sorted window by window, spread over tasks.
HOT_BLOCKS = 2_000
#: Depth in 8-byte words of the first lexsort, before the rounds at branch positions.
SHALLOW_WORDS = 2
#: A task sorts the blocks of complete grams in portions of about this many.
PORTION = 20_000
#: Bytes that one anchor pass handles; a longer text is cut into overlapping pieces.
PIECE = 1 << 18
LONG_PIECE = 1 << 23
_ORDER_BITS = _U(24)             # low bits that hold the position; the rest orders the grams
ALL = -1


# --- anchors --------------------------------------------------------------------------------

def _least_in_window(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    n = 1
    while n * 2 <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    rest = width - n
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def _words_at(data: np.ndarray, big: bool = False) -> np.ndarray:
    """The 8 bytes from every position as one integer (``data`` has 8 bytes to spare)."""
    view = np.ndarray((len(data) - 7,), ">u8" if big else "<u8", data.tobytes(), strides=(1,))
    return view.astype(np.uint64)


def _blocks_of_piece(data: np.ndarray, off: np.ndarray):
    n = len(data)
    if n < LENGTH:
        return None
    word = _words_at(data)
    with np.errstate(over="ignore"):
        gram = word[:-8] * _U(0x9E3779B97F4A7C15) ^ word[8:] * _U(0xD6E8FEB86659FD93)
        gram ^= gram >> _U(32)
        gram *= _U(0xBF58476D1CE4E5B9)
        gram ^= gram >> _U(29)
    order = (gram & ~_U((1 << 24) - 1)) | np.arange(len(gram), dtype=_U)
    best = _least_in_window(order, LENGTH - GRAM + 1)          # one per window start
    row = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))[:len(best)]
    fits = np.arange(len(best)) + LENGTH <= off[1:][row]
    new = np.ones(len(best), bool)
    new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1]) | (fits[1:] != fits[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(best)] - 1
    ok = fits[first]
    first, last = first[ok], last[ok]
    anchor = (best[first] & _U((1 << 24) - 1)).astype(np.int64)
    block = PrefixHash(data).of(first, last + LENGTH, 5)
    with np.errstate(over="ignore"):
        key = mix64(gram[anchor])
    owner = row[first].astype(np.int64)
    return owner, first - off[owner], last - first + 1, key, block


def blocks(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, first byte, windows, gram key, block hash) of every anchor's block, in order."""
    out = []
    for at, part in slices(texts, PIECE):
        data, off = raw_bytes(part)
        step = LONG_PIECE if len(data) > LONG_PIECE + LENGTH else max(len(data), 1)
        for lo in range(0, max(len(data) - LENGTH + 1, 1), step):
            piece = data[lo:lo + step + LENGTH - 1]
            found = _blocks_of_piece(piece, np.array([0, len(piece)]) if step == LONG_PIECE else off)
            if found is not None:
                out.append((found[0] + at, found[1] + lo, *found[2:]))
    if not out:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(_U), none.astype(_U)
    return tuple(np.concatenate(c) for c in zip(*out))


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64))


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, block, doc, known): one row per block and document. Copies inside a batch are
    settled here: their later documents' rows are marked known and spread at random, so
    a block that very many documents share costs its gram one row per batch."""
    for batch in batches:
        row, _, _, gram, block = blocks(batch.column("text"))
        doc = np.asarray(batch.column("doc"))[row]
        order = np.lexsort((doc, block, gram))
        gram, block, doc = gram[order], block[order], doc[order]
        same = np.zeros(len(doc), bool)
        same[1:] = (gram[1:] == gram[:-1]) & (block[1:] == block[:-1])
        repeat = np.zeros(len(doc), bool)
        repeat[1:] = same[1:] & (doc[1:] == doc[:-1])
        with np.errstate(over="ignore"):
            gram = np.where(same, mix64(block ^ doc.astype(np.int64).view(_U)), gram)
        keep = ~repeat
        known = same & keep & ~_of_least(same, doc)
        yield pa.RecordBatch.from_arrays(
            [_long(gram[keep]), _long(block[keep]), _long(doc[keep]), pa.array(known[keep])],
            names=["gram", "block", "doc", "known"])


def _of_least(same: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """True where the row's document is the smallest of its group of equal blocks."""
    begin = np.flatnonzero(~same)
    least = np.repeat(doc[begin], np.diff(np.r_[begin, len(doc)])) if len(doc) else doc
    return doc == least


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by gram, block, doc: rows (gram, block, doc, mask). Mask -1: the
    whole block goes (the gram is not needed any more and is 0). Mask 0: first document of a block whose gram has other blocks too."""
    before = None                      # (gram, block, doc, emitted) of the current block's first row

    def out(gram, block, doc, mask):
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(block), pa.array(doc), pa.array(mask)],
                                          names=["gram", "block", "doc", "mask"])

    for batch in batches:
        gram, block, doc = (np.asarray(batch.column(c)) for c in ("gram", "block", "doc"))
        known = np.asarray(batch.column("known").to_numpy(zero_copy_only=False), bool)
        if len(gram) == 0:
            continue
        if known.any():
            n = int(known.sum())
            yield out(np.zeros(n, np.int64), block[known], doc[known], np.full(n, ALL, np.int64))
            gram, block, doc = gram[~known], block[~known], doc[~known]
        if len(gram) == 0:
            continue
        carried = before is not None
        if carried:
            gram, block, doc = (np.r_[b, x] for b, x in zip(before[:3], (gram, block, doc)))
        head = np.ones(len(gram), bool)
        head[1:] = (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])
        begin = np.flatnonzero(head)
        least = np.repeat(doc[begin], np.diff(np.r_[begin, len(doc)]))
        later = doc > least
        g = gram[begin]
        several = np.zeros(len(begin), bool)
        several[1:] = g[1:] == g[:-1]
        several[:-1] |= g[1:] == g[:-1]
        done = before[3] if carried else False
        last_several = several[-1] or (len(begin) == 1 and done)
        if carried and done:
            several[0] = False         # its row is out already
        n = int(later.sum())
        yield out(np.r_[np.zeros(n, np.int64), g[several]], np.r_[block[later], block[begin][several]],
                  np.r_[doc[later], doc[begin][several]],
                  np.r_[np.full(n, ALL, np.int64), np.zeros(int(several.sum()), np.int64)])
        b = begin[-1]
        before = (gram[b], block[b], doc[b], bool(last_several))


# --- sorting the suffixes of the open blocks ------------------------------------------------

def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(route, doc, block, first, bytes) of the wanted blocks of each text. A block of a hot
    gram becomes one row per window, routed by the window; windows that repeat in the
    batch are settled here (their rows carry no bytes but the verdict in ``first``)."""
    for batch in batches:
        texts, doc = batch.column("text"), np.asarray(batch.column("doc"))
        row, first, windows, gram, block = blocks(texts)
        want = batch.column("blocks")
        lengths = np.diff(np.asarray(want.offsets))
        w_row = np.repeat(np.arange(len(doc)), lengths)
        flat = want.flatten()
        w_block, w_hot = (np.asarray(flat.field(c).to_numpy(zero_copy_only=False)) for c in ("block", "hot"))
        wanted = dict(zip(zip(w_row.tolist(), w_block.tolist()), w_hot.tolist()))
        routes, docs, ids, firsts, parts = [], [], [], [], []
        signed = block.view(np.int64)
        # only rows with a wanted hash are looked at one by one
        near = np.flatnonzero(np.isin(signed, w_block))
        raw, seen = {}, {}
        for i in near.tolist():
            hot = wanted.pop((int(row[i]), int(signed[i])), None)
            if hot is None:
                continue
            r = int(row[i])
            if r not in raw:
                raw = {r: texts[r].as_py().encode("utf-8")}
            body = raw[r][first[i]:first[i] + windows[i] + LENGTH - 1]
            if not hot:
                routes.append(int(gram.view(np.int64)[i]))
                docs.append(int(doc[r]))
                ids.append(int(signed[i]))
                firsts.append(0)
                parts.append(body)
                continue
            for k in range(int(windows[i])):
                piece = body[k:k + LENGTH]
                seen.setdefault(piece, []).append((int(doc[r]), int(signed[i]), k))
        for piece, rows in seen.items():
            rows.sort()
            route = int.from_bytes(hashlib.blake2b(piece, digest_size=8).digest(), "little", signed=True)
            for n, (d, b, k) in enumerate(rows):
                known = d > rows[0][0]
                routes.append(route if not known else hash((d, b, k)))
                docs.append(d)
                ids.append(b)
                firsts.append(-1 - k if known else k)
                parts.append(b"" if known else piece)
        yield pa.RecordBatch.from_arrays(
            [pa.array(routes, pa.int64()), pa.array(docs, pa.int64()), pa.array(ids, pa.int64()),
             pa.array(firsts, pa.int32()), pa.array(parts, pa.binary())],
            names=["route", "doc", "block", "first", "bytes"])


def deep_shallow_groups(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at ``start`` by their first LENGTH bytes: (order, group of each place).

    ``data`` has at least LENGTH + 8 bytes from every start. A vectorised stand-in for
    multikey quicksort and blind tries: one lexsort orders by words to the shallow depth; the
    groups that agree so far are split in rounds, all at once:
    a group's branch position is the least depth at which a member leaves the leader, the
    bytes before it are never looked at again, and the members branch on the word there.
    """
    word = _words_at(data, big=True)
    order = np.lexsort([word[start + 8 * w] for w in reversed(range(SHALLOW_WORDS))])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for w in range(SHALLOW_WORDS):
        key = word[start[order] + 8 * w]
        new[1:] |= key[1:] != key[:-1]
    while True:
        begin = np.flatnonzero(new)
        size = np.diff(np.r_[begin, len(order)])
        place = np.flatnonzero(np.repeat(size > 1, size))       # places in groups still together
        if not len(place):
            break
        group = np.repeat(np.arange(len(begin)), size)[place]
        mine = start[order[place]]
        lead = start[order[begin[group]]]
        depth = np.full(len(place), LENGTH, np.int64)            # where a member leaves its leader
        for at in range(8 * SHALLOW_WORDS, LENGTH, 8):
            open_ = np.flatnonzero(depth == LENGTH)
            diff = word[mine[open_] + at] ^ word[lead[open_] + at]
            hit = diff != 0
            # bit length of the difference; the conversion may round it up by one
            top = np.minimum(np.frexp(diff[hit].astype(np.float64))[1], 64)
            exact = (diff[hit] >> (top - 1).astype(_U)) == 0
            byte = (64 - (top - exact)) // 8
            depth[open_[hit]] = np.minimum(at + byte, LENGTH)
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        branch = np.minimum.reduceat(depth, edge)
        if (branch == LENGTH).all():
            break
        branch = np.repeat(branch, np.diff(np.r_[edge, len(group)]))
        split = branch < LENGTH
        place, group, mine, branch = place[split], group[split], mine[split], branch[split]
        key = word[mine + branch]
        short = np.maximum(branch + 8 - LENGTH, 0)               # bytes of the word past the end
        key = key >> (short * 8).astype(_U) << (short * 8).astype(_U)
        by = np.lexsort((key, group))
        order[place] = order[place][by]
        key, group = key[by], group[by]
        new[place[1:]] |= (key[1:] != key[:-1]) | (group[1:] != group[:-1])
    return order, np.cumsum(new) - 1


def _judge(doc: np.ndarray, block: np.ndarray, first: np.ndarray, parts: list[bytes]) -> pa.RecordBatch:
    """(doc, block, mask): a bit per window of the block that a smaller document has too."""
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    data = np.frombuffer(b"".join(parts) + bytes(LENGTH + 8), np.uint8)
    windows = size - LENGTH + 1
    owner = np.repeat(np.arange(len(parts)), windows)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(np.cumsum(size) - size, windows) + number
    order, group = deep_shallow_groups(data, start)
    d = doc[owner[order]]
    edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.repeat(np.minimum.reduceat(d, edge), np.diff(np.r_[edge, len(group)]))
    later = order[d > least]
    mask = np.zeros(len(parts), np.int64)
    np.bitwise_or.at(mask, owner[later], np.int64(1) << (first[owner[later]] + number[later]))
    hit = mask != 0
    return pa.RecordBatch.from_arrays([pa.array(doc[hit]), pa.array(block[hit]), pa.array(mask[hit])],
                                      names=["doc", "block", "mask"])


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route, in portions of complete routes."""
    held: list[tuple] = []
    count = 0

    def flush(upto: int, route, doc, block, first, parts):
        return _judge(doc[:upto], block[:upto], first[:upto], parts[:upto])

    def joined():
        return (*(np.concatenate([h[i] for h in held]) for i in range(4)), [p for h in held for p in h[4]])

    for batch in batches:
        first = np.asarray(batch.column("first")).astype(np.int64)
        cols = [np.asarray(batch.column(c)) for c in ("route", "doc", "block")]
        parts = batch.column("bytes").to_pylist()
        known = first < 0
        if known.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[1][known]), pa.array(cols[2][known]), pa.array(np.int64(1) << (-1 - first[known]))],
                names=["doc", "block", "mask"])
        open_ = ~known
        held.append((*(c[open_] for c in cols), first[open_], [p for p, o in zip(parts, open_) if o]))
        count += int(open_.sum())
        if count >= PORTION:
            route, doc, block, first, parts = joined()
            cut = int(np.searchsorted(route, route[-1]))          # the last route may go on
            if cut:
                yield flush(cut, route, doc, block, first, parts)
            held = [(route[cut:], doc[cut:], block[cut:], first[cut:], parts[cut:])]
            count = len(route) - cut
    if count:
        route, doc, block, first, parts = joined()
        yield flush(len(route), route, doc, block, first, parts)


# --- cutting --------------------------------------------------------------------------------

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, marks = batch.column("text"), batch.column("marks")
        n = batch.num_rows
        raw = texts.cast(pa.binary()).to_pylist()
        lengths = np.diff(np.asarray(marks.offsets))
        flat = marks.flatten()
        m_row = np.repeat(np.arange(n), lengths)
        m_block, m_mask = (np.asarray(flat.field(c).to_numpy(zero_copy_only=False)).astype(np.int64)
                           for c in ("block", "mask"))
        gone = {r: np.zeros(len(raw[r]) + 1, np.int32) for r in np.unique(m_row).tolist()}
        rows = np.array(sorted(gone), np.int64)
        if len(rows):
            row, first, windows, _, block = blocks(texts.take(pa.array(rows)))
            row = rows[row]
            key = mix64(block ^ mix64(row.astype(_U)))
            m_key = mix64(m_block.view(_U) ^ mix64(m_row.astype(_U)))
            order = np.argsort(m_key, kind="stable")
            m_key, mask = m_key[order], m_mask[order]
            edge = np.flatnonzero(np.r_[True, m_key[1:] != m_key[:-1]])
            m_key, mask = m_key[edge], np.bitwise_or.reduceat(mask, edge)
            at = np.minimum(np.searchsorted(m_key, key), len(m_key) - 1)
            hit = np.flatnonzero(m_key[at] == key)
            for i in hit.tolist():
                bits, f, w, delta = int(mask[at[i]]), int(first[i]), int(windows[i]), gone[int(row[i])]
                if bits == ALL:
                    delta[f] += 1
                    delta[f + w + LENGTH - 1] -= 1
                    continue
                for k in range(w):
                    if bits >> k & 1:
                        delta[f + k] += 1
                        delta[f + k + LENGTH] -= 1
        removed, spans, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        for r in range(n):
            if r not in gone:
                kept.append(raw[r])
                continue
            cover = np.cumsum(gone[r][:-1]) > 0
            removed[r] = int(cover.sum())
            spans[r] = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
            kept.append(np.frombuffer(raw[r], np.uint8)[~cover].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array([len(x) for x in raw], pa.int64()), pa.array(removed),
             pa.array(spans), pa.array(kept, pa.binary())],
            names=["doc", "n_bytes", "n_removed", "n_spans", "kept"])


def _store(df: DataFrame) -> DataFrame:
    """Written as Parquet to the shared folder and read again; the shuffle files behind it
    are no longer needed and are released once the driver's references are collected."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/spans-{uuid.uuid4().hex}"
    df.write.parquet(path)
    del df
    for _ in range(2):                 # the listener bus lets go of the finished query a little later
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(1)
    return spark.read.parquet(path)


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_bytes, n_removed, n_spans, kept), kept as bytes.

    A NULL text is empty; texts below 50 bytes keep everything. Ids are integers; rows with
    the same id are one document (they never count against each other, and each is cut);
    a NULL id is neither smaller nor larger than any, so such rows keep everything and
    count for nobody. An empty table gives no rows. Matches never cross documents and are
    judged on the input.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text_of(text_col).alias("text"))
    long_enough = rows.filter(F.col("doc").isNotNull() & (F.octet_length("text") >= LENGTH))
    found = long_enough.mapInArrow(_block_rows, "gram long, block long, doc long, known boolean")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    settled = _store(found.repartition("gram").sortWithinPartitions("gram", "block", "doc")
                     .mapInArrow(_settle, "gram long, block long, doc long, mask long"))
    small_batches(spark)

    open_ = settled.filter("mask = 0").drop("mask")
    hot = open_.groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > HOT_BLOCKS).select(
        "gram", F.lit(True).alias("hot"))
    wanted = (open_.join(hot, "gram", "left")
              .groupBy("doc").agg(F.collect_list(F.struct("block", F.coalesce("hot", F.lit(False)).alias("hot")))
                                  .alias("blocks")))
    fetched = (long_enough.join(wanted, "doc").select("doc", "text", "blocks")
               .mapInArrow(_fetch, "route long, doc long, block long, first int, bytes binary"))
    judged = _store(fetched.repartition("route").sortWithinPartitions("route")
                    .mapInArrow(_sort_blocks, "doc long, block long, mask long"))

    marks = (settled.filter(f"mask = {ALL}").select("doc", "block", "mask").unionByName(judged)
             .groupBy("doc").agg(F.collect_list(F.struct("block", "mask")).alias("marks")))
    none = F.array().cast("array<struct<block:bigint,mask:bigint>>")
    cut = (rows.join(marks, "doc", "left").select("doc", "text", F.coalesce("marks", none).alias("marks"))
           .mapInArrow(_cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary"))
    return cut.withColumnRenamed("doc", "doc_id")
