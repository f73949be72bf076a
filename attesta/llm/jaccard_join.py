"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles. Texts with equal sets form a class, of which one goes on.
128 MinHash values, of 16 bits each, make 32 bands of four; a pair of similarity 0.8 shares no
band once in twenty million. Pairs that share a band compare their values step by step: with a
uniform prior, m matches of k leave P(similarity >= threshold) = P(Binomial(k + 1, threshold) <= m),
and a pair is dropped where that falls below the tolerance. What is left links texts to candidate
components, in which every pair is then verified exactly on the shingles.

Bands and blocks emit a spanning forest and counts, never all pairs, and classes stand for their
copies. Counting links exactly compares the different texts of one component with each other: that
work, alone, grows with the square of a component's different texts. It is dealt out evenly: a band
bucket over `bucket_rows`, and a component over `block_rows` texts or `block_chars` characters, goes
in blocks, each pair of blocks to a task. Within a bucket, texts already linked aren't compared again.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. A text of one
to four words is one shingle; null text and texts without words have none and no link, not to
each other either. Rows are told apart by doc_id and a 64-bit hash of the text: rows of one doc_id
with several texts are in the class of each text, repeated rows share a class, and rows with equal
doc_id and text stay or go together. A doc_id may be of any type that sorts. A null doc_id is left
out of the join, as it can't be named in a group, and comes back as its own class without links. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import chunks, ensure_checkpoint_dir, released, small_batches, table, text_buffer
from attesta.llm.components import components
from attesta.llm.wordbytes import Words, mix

BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
CHUNK_BYTES = 1 << 20
#: The seeds of the MinHash functions, from a rule.
_SEEDS = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MULTIPLY = (_SEEDS[:VALUES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_FLIP = (_SEEDS[VALUES:] >> np.uint64(32)).astype(np.uint32)


def shingles(data: np.ndarray, borders: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, back to back, and the borders between texts."""
    words = Words(data, borders)
    n = np.diff(words.edges)
    at, hashes = words.windows(size)
    owner = np.repeat(np.arange(len(n)), n)
    owners = owner[at] if len(at) else np.empty(0, np.int64)
    for few in range(1, size):
        short = np.flatnonzero(n == few)
        if len(short):
            first, found = words.windows(few)
            pick = np.isin(first, words.edges[short])
            owners, hashes = np.concatenate([owners, owner[first[pick]]]), np.concatenate([hashes, mix(found[pick] + np.uint64(few))])
    order = np.lexsort((hashes, owners))
    owners, hashes = owners[order], hashes[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    owners, hashes = owners[keep], hashes[keep]
    return hashes, np.searchsorted(owners, np.arange(len(n) + 1))


def _in_chunks(data: np.ndarray, borders: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """`shingles` of many texts, a bounded number of bytes at a time."""
    parts = [shingles(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i], size) for i, j in chunks(borders, CHUNK_BYTES)]
    counts = np.concatenate([np.diff(at) for _, at in parts])
    return np.concatenate([h for h, _ in parts]), np.concatenate([[0], np.cumsum(counts)])


def signatures(hashes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """16 bits of each text's MinHash values; texts without shingles have zeros."""
    out = np.zeros((len(borders) - 1, VALUES), np.uint16)
    some = np.flatnonzero(np.diff(borders))
    if len(some):
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        for k in range(VALUES):
            y = x ^ _FLIP[k]
            y *= _MULTIPLY[k]
            y ^= y >> np.uint32(15)
            y *= np.uint32(0x2C1B3C6D)
            least = np.minimum.reduceat(y, borders[some])
            out[some, k] = (least ^ (least >> np.uint32(16))) & np.uint32(0xFFFF)
    return out


@released
def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """doc, tk, text -> doc, tk, shingles, two sums that tell sets apart, bytes, signature."""
    for batch in batches:
        data, borders = text_buffer(batch.column(2))
        n, one, two, sig = [], [], [], []
        for i, j in chunks(borders, CHUNK_BYTES):
            hashes, at = shingles(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i], size)
            sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(np.stack([mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), mix(hashes + np.uint64(0x14057B7EF767814F))], 1), axis=0, dtype=np.uint64)])
            both = sums[at[1:]] - sums[at[:-1]]
            n.append(np.diff(at))
            one.append(both[:, 0].view(np.int64))
            two.append(both[:, 1].view(np.int64))
            sig += [s.tobytes() for s in signatures(hashes, at)]
        cat = lambda x: np.concatenate(x) if x else np.empty(0, np.int64)
        sizes = np.diff(borders) if len(borders) > 1 else np.empty(0, np.int64)
        columns = [pa.array(cat(x), pa.int64()) for x in (n, one, two)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns, pa.array(sizes, pa.int64()), pa.array(sig, pa.binary())], ["doc", "tk", "n", "h1", "h2", "bytes", "sig"])


def least_matches(steps: tuple[int, ...], threshold: float, tolerance: float) -> dict[int, int]:
    """By values compared, the fewest matches with which a pair stays."""
    out = {}
    for k in steps:
        total, m = 0.0, 0
        while True:
            total += comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out[k] = m
    return out


class Pruner:
    """Compares the values of pairs step by step and drops the hopeless."""

    def __init__(self, threshold: float, tolerance: float):
        self.least = least_matches((16, 32, 64, 128), threshold, tolerance)

    def keep(self, sig: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Indices of the pairs (a[i], b[i]) that stay."""
        left, matches, done = np.arange(len(a)), np.zeros(len(a), np.int64), 0
        for k, least in self.least.items():
            matches = matches + (sig[a[left], done:k] == sig[b[left], done:k]).sum(1)
            ok = matches >= least
            left, matches, done = left[ok], matches[ok], k
            if not len(left):
                break
        return left


def forest(sig: np.ndarray, pruner: Pruner, sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect whatever surviving pairs connect; texts already connected aren't compared.

    sides: with 0 and 1, only pairs across are of interest.
    """
    label = np.arange(len(sig))
    edges: list[tuple[int, int]] = []

    def near(x: int, others: np.ndarray) -> np.ndarray:
        if sides is not None:
            others = others[sides[others] != sides[x]]
        return others[pruner.keep(sig, others, np.full(len(others), x))] if len(others) else others

    def link(x: int, hits: np.ndarray) -> None:
        for old, first in zip(*np.unique(label[hits], return_index=True), strict=True):
            edges.append((int(hits[first]), x))
            label[label == old] = label[x]

    for x in range(1, len(sig)):
        # The first of each group, then all of the groups that it didn't link to.
        before = np.arange(x)
        _, firsts = np.unique(label[:x], return_index=True)
        link(x, near(x, firsts))
        link(x, near(x, before[label[:x] != label[x]]))
    return edges


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole runs of rows whose first `keys` columns are equal; a run is never split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        if held and any(held[-1].column(k)[held[-1].num_rows - 1].as_py() != cols[k][0] for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        if len(change):
            yield pa.Table.from_batches([*held, batch.slice(0, int(change[-1]))])
            held = [batch.slice(int(change[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _borders(t: pa.Table, keys: int) -> np.ndarray:
    cols = [t.column(k).to_numpy() for k in range(keys)]
    return np.concatenate([[0], np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1, [t.num_rows]])


@released
def _candidate_edges(batches: Iterator[pa.RecordBatch], pruner: Pruner) -> Iterator[pa.RecordBatch]:
    """key, i, j, side, node, sig in runs -> edges of a forest over the pairs that survive."""
    small = 12
    for t in runs(batches, 3):
        docs, side = t.column("node").to_numpy(), t.column("side").to_numpy()
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(-1, VALUES)
        at = _borders(t, 3)
        sizes = np.diff(at)
        run = np.repeat(np.arange(len(sizes)), sizes)
        a_all, b_all = [], []
        for step in range(1, small):
            a = np.flatnonzero((run[step:] == run[:-step]) & (sizes[run[step:]] <= small))
            a = a[(side[a] != side[a + step]) | (side[a] < 0)]
            for p in range(0, len(a), 1 << 15):
                part = a[p : p + (1 << 15)]
                kept = part[pruner.keep(sig, part, part + step)]
                a_all.append(docs[kept])
                b_all.append(docs[kept + step])
        for k in np.flatnonzero(sizes > small):
            s, e = at[k], at[k + 1]
            crossing = side[s] >= 0
            found = forest(sig[s:e], pruner, side[s:e] if crossing else None)
            if found:
                x, y = np.array(found).T
                a_all.append(docs[s + x])
                b_all.append(docs[s + y])
        a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a_all, b_all))
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])


def exact_links(hashes: np.ndarray, borders: np.ndarray, threshold: float, columns: int = 4096) -> np.ndarray:
    """Boolean matrix of the pairs of texts whose Jaccard similarity is at least the threshold."""
    n, sizes = len(borders) - 1, np.diff(borders)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.empty(0, bool)
    column = np.cumsum(new) - 1
    # A shingle of one text only is in no intersection.
    often = np.bincount(column)[column] > 1 if len(column) else np.empty(0, bool)
    owner, column = owner[often], column[often]
    common = np.zeros((n, n), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        for c in range(0, int(column[-1]) + 1, columns):
            a, b = np.searchsorted(column, [c, c + columns])
            held = np.zeros((n, columns), np.float32)
            held[owner[a:b], column[a:b] - c] = 1
            common += held @ held.T
    # In integers: common / (a + b - common) >= threshold, with the threshold in thousandths.
    shared, t = common.astype(np.int64), round(threshold * 1000)
    linked = (shared > 0) & (shared * 1000 >= t * (sizes[:, None] + sizes[None, :] - shared))
    np.fill_diagonal(linked, False)
    return linked


@released
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, tk, text -> doc, tk, size, zip: texts are most of what the join by row moves."""
    codec = pa.Codec("zstd", 3)
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(len, raw), pa.int64()), pa.array([codec.compress(r, asbytes=True) for r in raw], pa.binary())], ["doc", "tk", "size", "zip"])


@released
def _verified(batches: Iterator[pa.RecordBatch], size: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """comp, i, j, side, node, copies, size, zip in runs -> links of each node, and forest edges (a, b)."""
    codec = pa.Codec("zstd", 3)
    for t in runs(batches, 3):
        # A row that is repeated in the input counts once.
        t = t.filter(pa.array(np.concatenate([[True], np.logical_or.reduce([np.diff(t.column(c).to_numpy()) != 0 for c in (0, 1, 2, "node")])])))
        at = _borders(t, 3)
        docs, side, copies, size_of = (t.column(c).to_numpy() for c in ("node", "side", "copies", "size"))
        a, b, links = [], [], []
        for s, e in zip(at[:-1], at[1:], strict=True):
            raw = b"".join(codec.decompress(z, n, asbytes=True) for z, n in zip(t.column("zip").slice(s, e - s).to_pylist(), size_of[s:e].tolist(), strict=True))
            data, borders = np.frombuffer(raw, np.uint8), np.concatenate([[0], np.cumsum(size_of[s:e])])
            linked = exact_links(*_in_chunks(data, borders, size), threshold)
            if side[s] >= 0:
                linked &= side[s:e, None] != side[None, s:e]
            counts = linked @ copies[s:e]
            # Least labels along links, until they rest: an edge to the label spans what links connect.
            label, last = np.arange(e - s), None
            while last is None or (label != last).any():
                last, label = label, np.minimum(label, np.where(linked, label[None, :], e - s).min(1))
            for k in np.flatnonzero(counts):
                a.append(docs[s + label[k]])
                b.append(docs[s + k])
                links.append(counts[k])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])


def _dealt(rows: DataFrame, key: str, blocks: str, columns: list[str]) -> DataFrame:
    """Each row once for each block of its key, its own included: a run holds a block or a pair of blocks.

    Columns key, i, j, side (-1: all pairs of the run are of interest; 0, 1: those across), columns.
    """
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col(blocks)).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
    side = F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return rows.select(key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), side.alias("side"), *columns)


def _in_runs(rows: DataFrame, key: str, work: Callable, schema: str) -> DataFrame:
    return rows.repartition(key, "i", "j").sortWithinPartitions(key, "i", "j", "node").mapInArrow(work, schema)


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links, copy_of for each row; options as in `_joined`.

    class_id: the least doc_id that links lead to. n_links: other rows with similarity of at least
    the threshold, copies among them. copy_of: the least doc_id with the same shingles.
    """
    return _joined(docs, **options).select("doc_id", "class_id", "n_links", "copy_of")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").alias("doc"), F.xxhash64(text).alias("tk"), text.alias("text"))


def _joined(
    docs: DataFrame, *, size: int = 5, threshold: float = 0.8, tolerance: float = 1e-5, bucket_rows: int = 4096, block_rows: int = 512, block_chars: int = 4 << 20
) -> DataFrame:
    """doc_id, tk (hash of the text), class_id, class_tk, n_links, copy_of for each row."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    texts = _rows(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = texts.mapInArrow(lambda b: _signed(b, size), f"doc {kind}, tk bigint, n bigint, h1 bigint, h2 bigint, bytes bigint, sig binary").checkpoint()
    real = signed.where("n > 0 and doc is not null")
    # Equal sets have equal signatures. A class is known by a number from here on.
    classes = real.groupBy("n", "h1", "h2").agg(F.min(F.struct("doc", "tk")).alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("bytes").alias("bytes"), F.first("sig").alias("sig"))
    classes = classes.withColumn("node", F.monotonically_increasing_id()).checkpoint()

    sigs = classes.select("node", "sig")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring(F.col("sig"), k * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    banded = sigs.select("node", F.explode(bands).alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").withColumn("blocks", F.ceil(F.col("m") / bucket_rows))
    held = banded.join(shared.drop("m"), "key").join(sigs, "node")
    pruner = Pruner(threshold, tolerance)
    candidates = _in_runs(_dealt(held, "key", "blocks", ["node", "sig"]), "key", lambda b: _candidate_edges(b, pruner), "a bigint, b bigint").distinct()

    sized = components(candidates).join(classes.select("node", "rep", "copies", "bytes"), "node").withColumnRenamed("root", "comp")
    extent = sized.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.ceil(F.sum("bytes") / block_chars), F.lit(1)).alias("blocks"))
    members = sized.join(extent, "comp").select("comp", "node", "rep.doc", "rep.tk", "copies", "blocks")
    whole = members.join(texts.mapInArrow(_packed, f"doc {kind}, tk bigint, size bigint, zip binary"), ["doc", "tk"])
    links = _in_runs(_dealt(whole, "comp", "blocks", ["node", "copies", "size", "zip"]), "comp", lambda b: _verified(b, size, threshold), "a bigint, b bigint, links bigint").checkpoint()

    roots = components(links)
    heads = roots.join(classes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("head"))
    counts = links.groupBy(F.col("b").alias("node")).agg(F.sum("links").alias("links"))
    known = classes.drop("sig").join(counts, "node", "left").join(roots, "node", "left").join(heads, "root", "left")
    head = F.coalesce("head", "rep")
    known = known.select("n", "h1", "h2", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), head.alias("head"))
    out = real.select("doc", "tk", "n", "h1", "h2").join(known, ["n", "h1", "h2"])
    out = out.select(F.col("doc").alias("doc_id"), "tk", F.col("head.doc").alias("class_id"), F.col("head.tk").alias("class_tk"), "n_links", F.col("rep.doc").alias("copy_of"))
    doc = F.col("doc")
    alone = signed.where("not (n > 0 and doc is not null)").select(doc.alias("doc_id"), "tk", doc.alias("class_id"), F.col("tk").alias("class_tk"), F.lit(0).cast("bigint").alias("n_links"), doc.alias("copy_of"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents that open their class (the least doc_id), all columns as they were; a null doc_id stays."""
    gone = _joined(docs, **options).where("doc_id <> class_id or tk <> class_tk").select(F.col("doc_id").alias("_id"), F.col("tk").alias("_tk")).distinct()
    same = (docs["doc_id"] == gone["_id"]) & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == gone["_tk"])
    return docs.join(gone, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def brute_force(rows: list[tuple], size: int = 5, threshold: float = 0.8) -> dict:
    """doc_id -> (class_id, n_links), from all pairs."""
    import re

    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    root, links, ids = {d: d for d in sets}, dict.fromkeys(sets, 0), sorted(sets)
    find = lambda d: d if root[d] == d else find(root[d])
    index: dict[tuple, list] = {}
    for d in ids:
        near: dict = {}
        for s in sets[d]:
            for o in index.get(s, ()):
                near[o] = near.get(o, 0) + 1
            index.setdefault(s, []).append(d)
        for o, c in near.items():
            if c * 1000 >= round(threshold * 1000) * (len(sets[d]) + len(sets[o]) - c):
                links[d] += 1
                links[o] += 1
                x, y = find(d), find(o)
                root[max(x, y)] = min(x, y)
    return {d: (find(d), links[d]) for d in ids}
