"""Benchmark decontamination: windows of benchmark words looked up in every training text.

The benchmark's windows (13 consecutive words; an item of fewer words is one window) go to the
executors as sorted hashes beside the words they came from, a bounded number at a time: at most
about `most_windows` windows and `most_bytes` bytes of words are broadcast in one block. Items are
cut into overlapping stretches first, so that one long item is spread over blocks too. Each hash hit
is verified against the words themselves. Words are runs of ASCII letters, digits and non-ASCII
characters, A-Z lower-cased.

A benchmark of several blocks is scanned for block by block, and hits are united for each distinct
(doc_id, text): rows that agree in both have equal hits and come back as often as they were there.
Which documents go is decided by the same rule and key at every size.

Null text has no words; an item without words has no window; items of one id count once, and a null
id is one item, shown as the empty string; repeated documents are judged row by row, those of a null
doc_id too. Empty tables give an empty result, or one without hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import chunks, released, small_batches, table, text_buffer
from attesta.llm.wordbytes import Words

CHUNK_BYTES = 1 << 20
#: A bit for each of the top 20 bits of a window's hash rules most words out at once.
_SHIFT = np.uint64(44)


class WindowSet:
    """Windows of some benchmark items, in arrays: by size a bit table, sorted hashes, and where their words are.

    Window w of a size is the words first[w] : first[w] + size of `words`, and belongs to the items
    names[owners[at[w] : at[w + 1]]].
    """

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        raw = [(t or "").encode() for _, t in items]
        self.names = sorted({i or "" for i, _ in items})
        place = {name: k for k, name in enumerate(self.names)}
        ids = np.array([place[i or ""] for i, _ in items], np.int64)
        self.words = Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        n_words = np.diff(self.words.edges)
        self.by_size: dict[int, tuple[np.ndarray, ...]] = {}
        for n in sorted({min(size, int(k)) for k in n_words if k}):
            first, hashes = self.words.windows(n)
            item = np.searchsorted(self.words.edges, first, "right") - 1
            pick = (n_words[item] >= n) if n == size else (n_words[item] == n)
            self.by_size[n] = self._distinct(n, first[pick], hashes[pick], ids[item[pick]])

    def _distinct(self, n: int, first: np.ndarray, hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bit table, hashes, first words, borders of owners, owners of the distinct windows, in the order of hashes."""
        order = np.lexsort((first, hashes))
        first, hashes, owner = first[order], hashes[order], owner[order]
        new = np.concatenate([[True], hashes[1:] != hashes[:-1]])
        # Other words under the hash of the window before: as rare as a 64-bit collision.
        for k in np.flatnonzero(~new):
            new[k] = self.words.text(int(first[k]), n) != self.words.text(int(first[k - 1]), n)
        window = np.cumsum(new) - 1
        pairs = np.unique(window * np.int64(len(self.names)) + owner)
        bits = np.zeros(1 << 20, bool)
        bits[hashes >> _SHIFT] = True
        at = np.searchsorted(pairs // len(self.names), np.arange(int(new.sum()) + 1))
        return bits, hashes[new], first[new], at, pairs % len(self.names)

    def hits(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """First word, size and items of every verified window."""
        for n, (bits, every, first, at, owners) in self.by_size.items():
            here, hashes = words.windows(n)
            maybe = np.flatnonzero(bits[hashes >> _SHIFT])
            near = np.searchsorted(every, hashes[maybe])
            found = every[np.minimum(near, len(every) - 1)] == hashes[maybe]
            for i, h, w in zip(here[maybe[found]].tolist(), hashes[maybe[found]], near[found].tolist(), strict=True):
                text = words.text(i, n)
                while w < len(every) and every[w] == h:
                    if self.words.text(int(first[w]), n) == text:
                        yield i, n, owners[at[w] : at[w + 1]]
                    w += 1


def _scan(batches: Iterator[pa.RecordBatch], shared, keep_spans: bool) -> Iterator[pa.RecordBatch]:
    windows: WindowSet = shared.value
    for batch in batches:
        data, borders = text_buffer(batch.column(1))
        n_words, n_hit, items, spans = [], [], [], []
        for i, j in chunks(borders, CHUNK_BYTES):
            words = Words(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i])
            hit, of = np.zeros(len(words.hashes) + 1, bool), {}
            for first, size, found in windows.hits(words):
                hit[first : first + size] = True
                of.setdefault(int(np.searchsorted(words.edges, first, "right")) - 1, set()).update(found.tolist())
            for k in range(j - i):
                a, b = words.edges[k], words.edges[k + 1]
                n_words.append(int(b - a))
                n_hit.append(int(hit[a:b].sum()))
                items.append([windows.names[i] for i in sorted(of.get(k, ()))])
                spans.append(_runs(hit, words, a, b, int(borders[i + k] - borders[i])) if keep_spans and n_hit[-1] else [])
        span = pa.list_(pa.struct([("word", pa.int64()), ("words", pa.int64()), ("byte", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, span)],
            ["doc_id", "n_words", "n_hit", "items", "spans"],
        )


def _runs(hit: np.ndarray, words: Words, a: int, b: int, base: int) -> list[dict]:
    """Maximal runs of hit words in a document: words and bytes from its start."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b].astype(np.int8), [0]])))
    return [{"word": int(s), "words": int(e - s), "byte": int(words.starts[a + s] - base), "end": int(words.ends[a + e - 1] - base)} for s, e in edge.reshape(-1, 2)]


_SPANS = "array<struct<word:bigint,words:bigint,byte:bigint,end:bigint>>"
SCHEMA = f"n_words bigint, n_hit bigint, items array<string>, spans {_SPANS}"
#: Windows of an item that stay together when items are dealt to blocks.
STRETCH = 4096


def _stretches(benchmark: DataFrame, size: int) -> DataFrame:
    """item_id, nth, text, n (windows): items in stretches that overlap by a window less a word."""
    lower = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words.alias("w")).where("size(w) > 0")
    items = items.withColumn("windows", F.greatest(F.lit(1), F.size("w") - (size - 1)))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.col("windows") - 1) / STRETCH).cast("int")), lambda k: F.array_join(F.slice("w", k * STRETCH + 1, F.lit(STRETCH + size - 1)), " "))
    rows = items.select("item_id", "windows", F.posexplode(cut).alias("nth", "text"))
    return rows.select("item_id", "nth", "text", F.least(F.lit(STRETCH), F.col("windows") - F.col("nth") * STRETCH).alias("n"))


def _blocks(docs: DataFrame, benchmark: DataFrame, size: int, most_windows: int, most_bytes: int) -> Iterator[Broadcast]:
    """The benchmark's windows, a bounded number in each broadcast; one at least."""
    rows = _stretches(benchmark, size)
    windows, octets = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-windows // most_windows), -(-octets // most_bytes))
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("item_id", "nth"), F.lit(blocks)) == k)
        yield docs.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in part.select("item_id", "text").collect()], size))


def _key(text: Column | None = None) -> Column:
    """With doc_id, what tells rows apart when several blocks' hits are united; null text has no words, as empty text."""
    return F.sha2(F.coalesce((F.col("text") if text is None else text).cast("string"), F.lit("")), 256)


def scan(docs: DataFrame, benchmark: DataFrame, *, size: int = 13, most_windows: int = 2_000_000, most_bytes: int = 32 << 20, spans: bool = True) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids of items that occur), spans (runs of hit words)."""
    small_batches(docs.sparkSession)
    shared = list(_blocks(docs, benchmark, size, most_windows, most_bytes))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    if len(shared) == 1:
        return rows.mapInArrow(lambda b: _scan(b, shared[0], spans), f"doc_id {kind}, {SCHEMA}")
    return _united(rows, shared).select("doc_id", "n_words", "n_hit", "items", "spans")


def _united(rows: DataFrame, shared: list[Broadcast]) -> DataFrame:
    """doc_id, key, n_words, n_hit, items, spans: as many rows as there were, hits of all blocks in each."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    keyed = rows.select(F.struct("doc_id", _key().alias("key")).alias("doc_id"), "text")
    found = None
    for k, s in enumerate(shared):
        one = keyed.mapInArrow(lambda b, s=s: _scan(b, s, True), f"doc_id struct<doc_id:{kind},key:string>, {SCHEMA}").withColumn("times", F.lit(int(k == 0)).cast("bigint"))
        one = one if k == 0 else one.where("n_hit > 0")
        found = one if found is None else found.unionByName(one)
    # Repeated rows have equal hits, of which a set keeps one before anything is shuffled.
    hit = F.col("n_hit") > 0
    merged = found.groupBy("doc_id").agg(F.max("n_words").alias("n_words"), F.sum("times").alias("times"), F.collect_set(F.when(hit, F.col("items"))).alias("items"), F.collect_set(F.when(hit, F.col("spans"))).alias("spans"))
    merged = merged.select("doc_id.doc_id", "doc_id.key", "n_words", F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"), F.array_sort(F.flatten("spans")).alias("spans"), "times")
    merged = merged.mapInArrow(_rejoined, f"doc_id {kind}, key string, {SCHEMA}, times bigint")
    return merged.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("_")).drop("_", "times")


@released
def _rejoined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of several blocks, in order, become maximal runs; n_hit counts their words."""
    for batch in batches:
        every, n_hit = [], []
        for spans in batch.column(batch.schema.get_field_index("spans")).to_pylist():
            runs: list[dict] = []
            for s in spans:
                if runs and s["word"] <= runs[-1]["word"] + runs[-1]["words"]:
                    last = runs[-1]
                    last["words"] = max(last["words"], s["word"] + s["words"] - last["word"])
                    last["end"] = max(last["end"], s["end"])
                else:
                    runs.append(dict(s))
            every.append(runs)
            n_hit.append(sum(r["words"] for r in runs))
        of = {name: batch.column(batch.schema.get_field_index(name)) for name in ("doc_id", "key", "n_words", "items", "times")}
        span = batch.schema.field("spans").type
        yield pa.RecordBatch.from_arrays([of["doc_id"], of["key"], of["n_words"], pa.array(n_hit, pa.int64()), of["items"], pa.array(every, span), of["times"]], ["doc_id", "key", "n_words", "n_hit", "items", "spans", "times"])


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", share: int = 20):
    """At least one word in `share` lies in a benchmark window."""
    return (F.col(n_hit) > 0) & (share * F.col(n_hit) >= F.col(n_words))


def remove_documents(docs: DataFrame, benchmark: DataFrame, *, size: int = 13, most_windows: int = 2_000_000, most_bytes: int = 32 << 20) -> DataFrame:
    """The documents that are not contaminated, all columns as they were.

    A benchmark that fits one broadcast filters rows where they are; the hits of a larger one are
    united first, and rows go by doc_id and text.
    """
    small_batches(docs.sparkSession)
    shared = list(_blocks(docs, benchmark, size, most_windows, most_bytes))
    if len(shared) == 1:
        return docs.mapInArrow(lambda b: _clean(b, shared[0]), docs.schema)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    dirty = _united(rows, shared).where(contaminated()).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    return docs.join(dirty, docs["doc_id"].eqNullSafe(dirty["_id"]) & (_key(docs["text"]) == dirty["_key"]), "left_anti")


@released
def _clean(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """The rows of which less than a twentieth of the words is hit."""
    for batch in batches:
        rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows)), batch.column(batch.schema.get_field_index("text"))], ["doc_id", "text"])
        (found,) = _scan(iter([rows]), shared, False)
        words, hit = (found.column(k).to_numpy() for k in (1, 2))
        yield batch.filter(pa.array((hit == 0) | (20 * hit < words)))


def cut_spans(text: str | None, spans: list) -> str | None:
    """The text without the bytes of its hit runs (spans as `scan` returns them)."""
    if text is None:
        return None
    raw, out, last = text.encode(), [], 0
    for s in sorted(spans, key=lambda s: s["byte"]):
        out.append(raw[last : s["byte"]])
        last = max(last, s["end"])
    return b"".join([*out, raw[last:]]).decode()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), spans=False)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated")
    )


def brute_force(docs: list[tuple], items: list[tuple], size: int = 13) -> dict:
    """doc_id -> (n_words, n_hit, n_items, items_sha256, contaminated), word by word."""
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add("" if item is None else str(item))
    sizes, out = {len(w) for w in windows}, {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if got := windows.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= got
        out[doc] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS n, array_to_string(ws[i : i + least(13, len(ws)) - 1], ' ') AS win
  FROM b, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS t(i) WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i : i + n - 1], ' ') AS win FROM w, sizes, unnest(range(1, len(ws) - n + 2)) AS t(i)
), hit AS (SELECT doc_id, dw.n, i, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win
), hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1
), hi AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM w LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
