"""Suffix-style dedup: bytes of every 50-byte string that an earlier document has are removed.

Prefix doubling over sampled positions. Of each window of `length` bytes the position with the
least hashed 16-byte prefix is its anchor, so equal windows have equal anchors. Round by round,
positions are ranked by what follows, and only those whose rank another document shares go on:

1. rank of the 16 bytes at the anchor; anchors of one document alone are dropped;
2. rank of the block, all that the windows of one anchor cover: where an earlier document has the
   same block, all its windows are repeats;
3. for blocks that differ under one anchor but share a side of it, rank of each window from pairs
   of ranks at growing offsets: 16, 32 and all of its bytes.

Ranks of 16 bytes and of pairs are 64-bit hashes. Texts are dealt to groups of about `GROUP_BYTES`
once, and that exchange is read by ranking, by the third round and by the cutting. A group sends each
distinct block once, with the smallest document that has it, so that a passage in very many documents
costs a row for each group. Rounds sort (rank, doc_id) in buckets of the rank that Spark deals out,
and tell the groups the smallest document of a block; each group applies that to its own documents.

Windows lie in one document. Null text is empty; texts under 50 bytes lose nothing. doc_id is of an
integer type. Rows that repeat a doc_id are judged alike against smaller ids only; a null doc_id is
below all others, and is told as the least long. An empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import chunks, released, small_batches, table, text_buffer
from attesta.llm.wordbytes import mix, powers

PREFIX = 16
_BASE = 0x9E3779B97F4A7C15
_POSITION = np.uint64((1 << 24) - 1)
#: Longer texts are read in pieces that overlap by a window less a byte.
PIECE_BYTES = 512 << 10
#: Anchors that one bucket of ranks should hold, and texts' bytes that a group of rows should.
BUCKET_RANKS, GROUP_BYTES = 100_000, 2 << 20
_NO_ID = -(1 << 63)


class Blocks:
    """Anchors, blocks and windows of one buffer of texts laid back to back (under 16 MB)."""

    def __init__(self, data: np.ndarray, borders: np.ndarray, length: int):
        self.length = length
        n = len(data) - PREFIX + 1
        if n <= length - PREFIX:
            self.lo = self.hi = self.owner = np.empty(0, np.int64)
            self.anchor = self.block = self.left = self.right = np.empty(0, np.uint64)
            return
        prefix, self.sums = prefix_ranks(data)
        self.back = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
        least = (prefix & ~_POSITION) | np.arange(n, dtype=np.uint64)
        width, have = length - PREFIX + 1, 1
        while have * 2 <= width:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if width > have:
            least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
        # Windows that cross a border are of no document; they part any two documents' windows.
        place = (least & _POSITION).astype(np.int32)
        for b in borders[1:-1]:
            place[max(0, b - length + 1) : b] = -1
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        ends = np.append(edge[1:], len(place))
        real = place[edge] >= 0
        #: A block: windows lo..hi of one anchor, in document owner.
        self.lo, self.hi = edge[real], ends[real] - 1
        where = place[self.lo].astype(np.int64)
        self.owner = np.searchsorted(borders, self.lo, "right") - 1
        self.anchor = prefix[where]
        self.block = mix(self._span(self.lo, self.hi + length) + (where - self.lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        # A window has half of its other bytes, at least, on one side of its anchor.
        half = (length - PREFIX + 1) // 2
        begin, end = borders[self.owner], borders[self.owner + 1]
        self.left = mix(self._span(np.maximum(where - half, begin), where))
        self.right = mix(self._span(where + PREFIX, np.minimum(where + PREFIX + half, end)))

    def _span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]


def prefix_ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the PREFIX bytes at each place, and the running sum that gives the hash of any span."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), dtype=np.uint64, out=sums[1:])
    back = powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    return mix((sums[PREFIX:] - sums[:-PREFIX]) * back[: len(data) - PREFIX + 1]), sums


def window_ranks(prefix: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks of whole windows: ranks of pairs at offsets that double until they reach the length."""
    reach, rank = PREFIX, lambda s: prefix[s]
    while reach < length:
        offset = min(reach, length - reach)
        rank = lambda s, f=rank, o=offset: mix(f(s) * np.uint64(3) + mix(f(s + o)))
        reach += offset
    return rank(starts)


def pieces(data: np.ndarray, borders: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, borders, first text, offset in it): some texts, or a piece of a long one."""
    for i, j in chunks(borders, PIECE_BYTES):
        a, b = int(borders[i]), int(borders[j])
        if b - a <= 2 * PIECE_BYTES:
            yield data[a:b], borders[i : j + 1] - a, i, 0
            continue
        for at in range(a, b - length + 1, PIECE_BYTES):
            end = min(b, at + PIECE_BYTES + length - 1)
            yield data[at:end], np.array([0, end - at]), i, at - a


def pack(**columns: np.ndarray) -> bytes:
    """Columns of equal length, byte by byte of their values, so that zeros compress away."""
    return b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns.values())


def unpack(blobs: list[bytes], kinds: list[str]) -> list[np.ndarray]:
    """The columns of several packs, one after the other."""
    width = [np.dtype(k).itemsize for k in kinds]
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        raw = np.frombuffer(blob, np.uint8)
        n, at = len(raw) // sum(width), 0
        for k, w in enumerate(width):
            parts[k].append(np.ascontiguousarray(raw[at : at + n * w].reshape(w, n).T).view(kinds[k]).ravel())
            at += n * w
    return [np.concatenate(p) if p else np.empty(0, k) for p, k in zip(parts, kinds, strict=True)]


def _dealt(keys: np.ndarray, **columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """A pack for each key."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else ranked
    for i, j in zip(begins, np.append(begins[1:], len(ranked)), strict=True):
        pick = order[i:j]
        yield int(ranked[i]), pack(**{n: c[pick] for n, c in columns.items()})


_ENTRY = ["<i8", "<u4", "<u8", "u1", "u1"]
_TO_BUCKET = pa.schema([("key", pa.int64()), ("group", pa.int64()), ("pack", pa.binary())])
_TO_GROUP = pa.schema([("key", pa.int64()), ("pack", pa.binary())])


def _found(texts: pa.Table, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, Blocks, int, int]]:
    """(documents of the blocks, bytes, blocks, first text, offset in it) for each piece of a group's texts."""
    ids = texts.column("doc").to_numpy()
    data, borders = text_buffer(texts.column("text"))
    for part, at, first, offset in pieces(data, borders, length):
        x = Blocks(part, at, length)
        yield ids[first + x.owner], part, x, first, offset


def _ranked(texts: pa.Table, length: int, buckets: int) -> pa.Table:
    """For each bucket of anchor ranks a pack of a group's distinct (anchor, block, sides), each with its least doc."""
    found = [(doc, x.anchor, x.block, x.left, x.right) for doc, _, x, _, _ in _found(texts, length)]
    rows = []
    if found:
        doc, anchor, block, left, right = map(np.concatenate, zip(*found, strict=True))
        order = np.lexsort((doc, block))
        new = np.ones(len(order), bool)
        new[1:] = block[order][1:] != block[order][:-1]
        pick = order[new]
        doc, anchor, block, left, right = doc[pick], anchor[pick], block[pick], left[pick], right[pick]
        rows = list(_dealt(_bucket(anchor, buckets), doc=doc.astype("<i8"), anchor=anchor.astype("<u4"), block=block.astype("<u8"), left=left.astype("u1"), right=right.astype("u1")))
    group = texts.column("key")[0].as_py() if texts.num_rows else 0
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([group] * len(rows), pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_TO_BUCKET)


def _per_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Groups and packs of each key; a key's rows follow each other."""
    key, groups, packs = None, [], []
    for batch in batches:
        for k, group, blob in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if k != key and packs:
                yield groups, packs
                groups, packs = [], []
            key = k
            groups.append(group)
            packs.append(blob)
    if packs:
        yield groups, packs


def _returned(found: Iterator[tuple[np.ndarray, ...]], names: list[str], least: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """What groups need to know, gathered over buckets and dealt to them: the first column is the group."""
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        group, *columns = map(np.concatenate, zip(*held, strict=True))
        rows = list(_dealt(group, **dict(zip(names, columns, strict=True))))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_TO_GROUP)

    for columns in found:
        if len(columns[0]):
            held.append(columns)
        if sum(len(c[0]) for c in held) >= least:
            yield out()
            held = []
    if held:
        yield out()


_STATUS = ["<i8", "<u8", "u1"]


@released
def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rounds 1 and 2: to each group the smallest document of a block that it has later (0), or its own contested ones (1)."""

    def one(found: tuple[list[int], list[bytes]]) -> tuple[np.ndarray, ...]:
        doc, anchor, block, left, right = unpack(found[1], _ENTRY)
        group = np.repeat(np.array(found[0], np.int64), [len(b) // sum(np.dtype(k).itemsize for k in _ENTRY) for b in found[1]])
        order = np.lexsort((doc, block, anchor))
        group, doc, anchor, block, left, right = (c[order] for c in (group, doc, anchor, block, left, right))
        new_anchor = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        new = new_anchor.copy()
        new[1:] |= block[1:] != block[:-1]
        content = np.cumsum(new) - 1
        at = np.flatnonzero(new)
        least = doc[at]  # of each content, the smallest document
        # Contents of one anchor that share a side, but not their smallest document, are contested.
        of = np.cumsum(new_anchor)[at].astype(np.uint64)
        contested = np.zeros(len(at), bool)
        for side in (left, right):
            key = of << np.uint64(8) | side[at]
            by = np.argsort(key, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
            differ = np.minimum.reduceat(least[by], start) != np.maximum.reduceat(least[by], start)
            contested[by] |= np.repeat(differ, np.diff(np.append(start, len(by))))
        later = doc > least[content]
        told = later | contested[content]
        return group[told], least[content[told]], block[told], (~later[told]).astype("u1")

    yield from _returned((one(b) for b in _per_key(batches)), ["doc", "block", "flag"])


def _status_keys(doc: np.ndarray, block: np.ndarray) -> np.ndarray:
    return mix(doc.view(np.uint64) * np.uint64(0x9FB21C651E98DF25)) ^ block


def _within(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)] == values


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    if buckets == 1:
        return np.zeros(len(anchor), np.int64)
    return (anchor >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64)


_BLOCK = ["<i8", "<u8", "u1"]


def _contested_blocks(texts: pa.Table, told: pa.Table, length: int, buckets: int) -> pa.Table:
    """Round 3, first half: contested blocks and their bytes, in packs by bucket of anchor."""
    doc, block, flag = unpack(told.column("pack").to_pylist(), _STATUS)
    wanted = np.sort(_status_keys(doc, block)[flag == 1])
    keys, packs = [], []
    for ids, part, x, _, _ in _found(texts, length) if len(wanted) else ():
        pick = np.flatnonzero(_within(_status_keys(ids, x.block), wanted))
        key = _bucket(x.anchor[pick], buckets)
        for k in np.unique(key):
            mine = pick[key == k]
            size = x.hi[mine] - x.lo[mine] + 1
            body = b"".join(part[a:b].tobytes() for a, b in zip(x.lo[mine], x.hi[mine] + length, strict=True))
            head = pack(doc=ids[mine], block=x.block[mine].astype("<u8"), size=size.astype("u1"))
            keys.append(int(k))
            packs.append(len(head).to_bytes(8, "little") + head + body)
    group = texts.column("key")[0].as_py() if texts.num_rows else 0
    return pa.table([pa.array(keys, pa.int64()), pa.array([group] * len(keys), pa.int64()), pa.array(packs, pa.binary())], schema=_TO_BUCKET)


_LATER = ["<i8", "<u8", "<u8"]


@released
def _repeated_windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Round 3, second half: of each contested block, a bit for each window that a smaller document has."""

    def one(found: tuple[list[int], list[bytes]]) -> tuple[np.ndarray, ...]:
        groups, blobs = found
        heads = [8 + int.from_bytes(b[:8], "little") for b in blobs]
        group = np.repeat(np.array(groups, np.int64), [(h - 8) // sum(np.dtype(k).itemsize for k in _BLOCK) for h in heads])
        doc, block, size = unpack([b[8:h] for b, h in zip(blobs, heads, strict=True)], _BLOCK)
        prefix, _ = prefix_ranks(np.frombuffer(b"".join(b[h:] for b, h in zip(blobs, heads, strict=True)), np.uint8))
        size = size.astype(np.int64)
        begin = np.cumsum(size + length - 1) - (size + length - 1)
        of = np.repeat(np.arange(len(size)), size)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        rank = window_ranks(prefix, begin[of] + nth, length)
        order = np.lexsort((doc[of], rank))
        rank, of, nth = rank[order], of[order], nth[order]
        new = np.concatenate([[True], rank[1:] != rank[:-1]])
        later = doc[of] > doc[of[np.flatnonzero(new)]][np.cumsum(new) - 1]
        mask = np.zeros(len(size), np.uint64)
        np.bitwise_or.at(mask, of[later], np.uint64(1) << nth[later].astype(np.uint64))
        some = mask != 0
        return group[some], doc[some], block[some], mask[some]

    yield from _returned((one(b) for b in _per_key(batches)), ["doc", "block", "mask"])


def _least_docs(blocks: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct blocks, sorted, and the smallest document of each."""
    order = np.lexsort((docs, blocks))
    blocks, docs = blocks[order], docs[order]
    new = np.concatenate([[True], blocks[1:] != blocks[:-1]]) if len(blocks) else np.empty(0, bool)
    return blocks[new], docs[new]


def _cut(texts: pa.Table, told: pa.Table, length: int) -> pa.Table:
    """The spans that go, and digests of what stays, of each text of a group."""
    kind = told.column("kind").to_numpy()
    blobs = told.column("pack").to_pylist()
    doc, block, flag = unpack([b for b, k in zip(blobs, kind, strict=True) if k == 0], _STATUS)
    other, other_doc = block[flag == 0], doc[flag == 0]
    doc, block, mask = unpack([b for b, k in zip(blobs, kind, strict=True) if k == 1], _LATER)
    later = _status_keys(doc, block)
    order = np.argsort(later)
    later, mask = later[order], mask[order]
    data, borders = text_buffer(texts.column("text"))
    # Of each block of the group: document, hash, row, first window in the row, windows less one.
    seen = [(ids, x.block, (first + x.owner).astype(np.int32), x.lo - (borders[first + x.owner] - borders[first]) + offset, (x.hi - x.lo).astype(np.uint8)) for ids, _, x, first, offset in _found(texts, length)]
    begins: dict[int, np.ndarray] = {}
    if seen:
        ids, blocks, rows, lo, more = map(np.concatenate, zip(*seen, strict=True))
        del seen
        every, least = _least_docs(np.concatenate([blocks, other]), np.concatenate([ids, other_doc]))
        whole = ids > least[np.searchsorted(every, blocks)]
        row, at, end = [rows[whole]], [lo[whole]], [lo[whole] + more[whole] + length]
        some = np.flatnonzero(~whole)
        keys = _status_keys(ids[some], blocks[some])
        hit = _within(keys, later)
        some, keys = some[hit], keys[hit]
        if len(some):
            held = mask[np.searchsorted(later, keys)]
            for bit in range(length - PREFIX + 1):
                on = some[(held >> np.uint64(bit)) & np.uint64(1) == 1]
                row.append(rows[on])
                at.append(lo[on] + bit)
                end.append(lo[on] + bit + length)
        row, span = np.concatenate(row), np.stack([np.concatenate(at), np.concatenate(end)], 1)
        order = np.argsort(row, kind="stable")
        row, span = row[order], span[order]
        edges = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
        begins = {int(row[i]): span[i:j] for i, j in zip(edges, np.append(edges[1:], len(row)), strict=True)}
    n_removed, n_spans, kept, spans = [], [], [], []
    for k in range(len(borders) - 1):
        raw = data[borders[k] : borders[k + 1]]
        merged = _merged(begins[k]) if k in begins else np.empty((0, 2), np.int64)
        n_removed.append(int((merged[:, 1] - merged[:, 0]).sum()))
        n_spans.append(len(merged))
        digest, last = hashlib.sha256(), 0
        for a, b in merged.tolist():
            digest.update(raw[last:a])
            last = b
        digest.update(raw[last:])
        kept.append(digest.hexdigest())
        spans.append([{"begin": a, "end": b} for a, b in merged.tolist()])
    return pa.table(
        [texts.column("doc"), pa.array(np.diff(borders), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))],
        names=["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
    )


def _merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of covered bytes; spans that touch are one run."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    at = np.flatnonzero(first)
    return np.stack([spans[at, 0], reach[np.append(at[1:], len(spans)) - 1]], 1)


def _by_key(packs: DataFrame, work: Callable) -> DataFrame:
    return packs.repartition("key").sortWithinPartitions("key").mapInArrow(work, "key bigint, pack binary")


def suffix_dedup(docs: DataFrame, *, length: int = 50) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed bytes) of each row."""
    spark = docs.sparkSession
    small_batches(spark, 4000)
    if not 2 * PREFIX <= length <= PREFIX + 63:
        raise ValueError("windows have 32 to 79 bytes: a block's windows are the bits of a word")
    texts = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = 1 << max(0, (total // (PREFIX + 1) // BUCKET_RANKS).bit_length())
    groups = max(1, total // GROUP_BYTES) | 1
    # By column functions alone, so that all readers of the texts share one exchange.
    grouped = texts.withColumn("key", F.pmod(F.xxhash64("doc", "text"), F.lit(groups)))
    packs = grouped.groupBy("key").applyInArrow(lambda t: _ranked(t, length, buckets), "key bigint, group bigint, pack binary")
    told = _by_key(packs, _judged).select("key", F.lit(0).alias("kind"), "pack")
    windows = grouped.groupBy("key").cogroup(told.groupBy("key")).applyInArrow(lambda a, b: _contested_blocks(a, b, length, buckets), "key bigint, group bigint, pack binary")
    later = _by_key(windows, lambda b: _repeated_windows(b, length)).select("key", F.lit(1).alias("kind"), "pack")
    done = grouped.groupBy("key").cogroup(told.unionByName(later).groupBy("key")).applyInArrow(
        lambda a, b: _cut(a, b, length), "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<begin:bigint,end:bigint>>"
    )
    doc_id = F.when(F.col("doc") != _NO_ID, F.col("doc"))
    return done.select(doc_id.alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans")


def brute_force(rows: list[tuple], length: int = 50) -> dict:
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256), window by window in the order of doc_id."""
    first: dict[bytes, int] = {}
    raw = [(doc, (text or "").encode()) for doc, text in sorted(rows, key=lambda r: r[0])]
    out = {}
    for doc, text in raw:
        for i in range(len(text) - length + 1):
            first.setdefault(text[i : i + length], doc)
    for doc, text in raw:
        gone = np.zeros(len(text) + 1, np.int8)
        for i in range(len(text) - length + 1):
            if first[text[i : i + length]] < doc:
                gone[i : i + length] = 1
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out[doc] = (len(text), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(text, np.uint8)[gone[:-1] == 0].tobytes()).hexdigest())
    return out
