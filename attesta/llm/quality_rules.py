"""Quality classifier: a sparse ensemble of rules over text statistics.

Small regression trees are boosted on a bounded sample of labelled rows. Every path from a root is
a conjunctive rule over statistics; a lasso-penalised logistic regression keeps few of them, and
those are compiled into one Spark column expression, so that scoring is a projection.

Statistics are taken over whole texts; null text is empty, and an empty text has zeros. Learning
reads the text and `labels.quality` of rows with crc32(doc_id as text) mod 5 other than 0, at most
`sample_rows` of them, in the order of a hash of doc_id; a document with several labels has the
largest, one with several texts the least statistics. Without labels of both kinds the score is the share of label 1, or 0.5 without any. Rows
are scored one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import chunks, released, small_batches, table, text_buffer
from attesta.llm.wordbytes import Words

STATS = [
    "n_words", "word_size", "upper_share", "digit_share", "symbol_share", "stop_share", "space_share", "line_share", "bar_share", "bang_share",
    "repeat_share", "distinct_share", "pair_share", "long_share", "letter_share", "wide_share",
]
CHUNK_BYTES = 1 << 20


def _per_text(mask: np.ndarray, borders: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (sums[borders[1:]] - sums[borders[:-1]]).astype(np.float64)


def statistics(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """A row of STATS for each text."""
    if not len(data):
        return np.zeros((len(borders) - 1, len(STATS)))
    words = Words(data, borders)
    over = lambda m, n: m / np.maximum(n, 1)
    at = lambda m: _per_text(m, borders)
    by_word = lambda m: _per_text(m, words.edges)
    head = (data & 0xC0) != 0x80
    chars = at(head)
    lead = np.concatenate([[0], data[:-1]])
    wide = (data >= 0xC0) & head
    upper = ((data >= 65) & (data <= 90)) | ((lead == 0xC3) & (data >= 0x80) & (data <= 0x9E))
    digit = (data >= 48) & (data <= 57)
    letters = ((data | 0x20) >= 97) & ((data | 0x20) <= 122) & (data < 128) | wide
    space, line, stop, bar, bang = data == 32, data == 10, (data == 46) | (data == 44), data == 124, data == 33
    symbol = (data < 128) & ~letters & ~digit & ~space & ~line & ~stop & (data > 32)
    n = np.diff(words.edges).astype(np.float64)
    sizes = words.ends - words.starts
    same = np.zeros(len(words.hashes), bool)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    first = words.edges[:-1][np.diff(words.edges) > 0]
    same[first] = False
    owner = np.repeat(np.arange(len(borders) - 1), np.diff(words.edges))
    distinct = lambda h, of: np.bincount(_firsts(h, of), minlength=len(borders) - 1).astype(np.float64)
    pairs_at, pairs = words.windows(2)
    pair_of = owner[pairs_at]
    total = np.cumsum(np.concatenate([[0], sizes]))
    return np.stack([
        n, over(total[words.edges[1:]] - total[words.edges[:-1]], n), over(at(upper), at(letters)), over(at(digit), chars), over(at(symbol), chars), over(at(stop), n), over(at(space), chars),
        over(at(line), n), over(at(bar), n), over(at(bang), n), over(by_word(same), n), over(distinct(words.hashes, owner), n), over(distinct(pairs, pair_of), n - 1), over(by_word(sizes > 20), n),
        over(at(letters), chars), over(at(wide), chars),
    ], 1)


def _firsts(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The owners of distinct (owner, hash)."""
    mixed = (hashes >> np.uint64(24)) | (owner.astype(np.uint64) << np.uint64(40))
    return (np.unique(mixed) >> np.uint64(40)).astype(np.int64)


@released
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, borders = text_buffer(batch.column(1))
        parts = [statistics(data[borders[i] : borders[j]], borders[i : j + 1] - borders[i]) for i, j in chunks(borders, CHUNK_BYTES)]
        found = np.concatenate(parts) if parts else np.empty((0, len(STATS)))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in found.T)], ["doc_id", *STATS])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and STATS of each row."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_measured, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATS))


Rule = tuple[tuple[int, bool, float], ...]
"""Conditions (statistic, whether at most, threshold), all of which must hold."""


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, most, t in rule:
        out &= (x[:, j] <= t) == most
    return out


def _tree(x: np.ndarray, codes: np.ndarray, cuts: list[np.ndarray], target: np.ndarray, rows: np.ndarray, path: Rule, depth: int, rules: list[Rule], out: np.ndarray, least: int) -> None:
    """Splits rows where squared error falls most; each node's path is a rule; leaves write their mean."""
    out[rows] = target[rows].mean()
    if depth == 0 or len(rows) < 2 * least:
        return
    best, whole = (1e-9, -1, 0), target[rows].sum() ** 2 / len(rows)
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        n = np.cumsum(np.bincount(codes[rows, j], minlength=len(c) + 1))[:-1]
        s = np.cumsum(np.bincount(codes[rows, j], target[rows], len(c) + 1))[:-1]
        rest, total = len(rows) - n, target[rows].sum()
        ok = (n >= least) & (rest >= least)
        gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(rest, 1) - whole, 0)
        k = int(gain.argmax())
        if gain[k] > best[0]:
            best = (gain[k], j, k)
    _, j, k = best
    if j < 0:
        return
    low = codes[rows, j] <= k
    for most, part in ((True, rows[low]), (False, rows[~low])):
        rule = (*path, (j, most, float(cuts[j][k])))
        rules.append(rule)
        _tree(x, codes, cuts, target, part, rule, depth - 1, rules, out, least)


def extract_rules(x: np.ndarray, y: np.ndarray, *, trees: int = 24, depth: int = 3, rate: float = 0.3, least: int = 8) -> list[Rule]:
    """Distinct paths of trees boosted on the logistic loss."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 48)[1:-1])) for j in range(x.shape[1])]
    # Cuts halfway between values that occur, so that a threshold isn't a value itself.
    cuts = [np.unique((c + np.minimum(np.append(np.unique(x[:, j]), np.inf)[np.searchsorted(np.unique(x[:, j]), c, "right")], c.max() + 1)) / 2) for j, c in enumerate(cuts)]
    codes = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    raw, rules = np.full(len(y), np.log(prior / (1 - prior))), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        step = np.zeros(len(y))
        _tree(x, codes, cuts, y - p, np.arange(len(y)), (), depth, rules, step, least)
        raw += rate * step / max(1e-3, float((p * (1 - p)).mean()))
    return list(dict.fromkeys(rules))


def fit_lasso(m: np.ndarray, y: np.ndarray, *, penalty: float = 2e-3, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    m = m.astype(np.float32)
    step = 4 / max(1e-6, float(np.linalg.norm(m, 2) ** 2 / len(y)) + 1)
    b = v = np.zeros(m.shape[1])
    b0 = v0 = 0.0
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(m @ v.astype(np.float32) + v0))) - y
        new = v - step * (m.T @ error.astype(np.float32)) / len(y)
        new, new0 = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0), v0 - step * error.mean()
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, v0 = new + (last - 1) / t * (new - b), new0 + (last - 1) / t * (new0 - b0)
        b, b0 = new, new0
    return b0, b


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept, and the rules that have a weight."""
    if len(y) == 0:
        return 0.0, []
    prior = np.clip(y.mean(), 0.01, 0.99)
    if y.min() == y.max():
        return float(np.log(prior / (1 - prior))), []
    rules = extract_rules(x, y)
    if not rules:
        return float(np.log(prior / (1 - prior))), []
    b0, b = fit_lasso(np.stack([holds(r, x) for r in rules], 1), y)
    return float(b0), [(r, float(w)) for r, w in zip(rules, b, strict=True) if abs(w) > 1e-6]


def compiled(model: tuple[float, list[tuple[Rule, float]]]) -> Column:
    """The score as a column expression over STATS."""
    b0, rules = model
    total = F.lit(b0)
    for rule, weight in rules:
        cond = F.lit(True)
        for j, most, t in rule:
            cond &= (F.col(STATS[j]) <= t) if most else (F.col(STATS[j]) > t)
        total += F.when(cond, F.lit(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning: crc32 of doc_id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, *, sample_rows: int = 8000) -> tuple[float, list[tuple[Rule, float]]]:
    """The model of at most `sample_rows` labelled documents."""
    rows = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    picked = rows.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64(F.col("doc_id").cast("string"))).limit(sample_rows)
    picked = picked.withColumnRenamed("doc_id", "_id")
    # At most sample_rows pairs of numbers.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).select(F.struct("doc_id", "quality").alias("doc_id"), "text")
    got = measure(texts).groupBy("doc_id").agg(F.min(F.struct(*STATS)).alias("x")).orderBy("doc_id.doc_id").collect()
    x = np.array([r["x"] for r in got], float).reshape(-1, len(STATS))
    return fit(x, np.array([r["doc_id"]["quality"] for r in got], float))


def score(docs: DataFrame, model: tuple[float, list[tuple[Rule, float]]]) -> DataFrame:
    """doc_id, score, STATS of each row."""
    return measure(docs).select("doc_id", compiled(model).alias("score"), *STATS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def brute_force(text: str | None) -> list[float]:
    """STATS of a text, character by character and word by word."""
    import re

    t = text or ""
    words = [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))]
    n, chars = len(words), len(t)
    wide = [c for c in t if ord(c) >= 0x80]
    upper = [c for c in t if "A" <= c <= "Z" or "À" <= c <= "Þ"]
    digits = [c for c in t if "0" <= c <= "9"]
    letters = [c for c in t if "a" <= c.lower() <= "z" and ord(c) < 128] + wide
    symbols = [c for c in t if 32 < ord(c) < 128 and not c.isalnum() and c not in ".,"]
    over = lambda a, b: a / max(b, 1)
    pairs = list(zip(words, words[1:], strict=False))
    return [
        n, over(sum(map(len, words)), n), over(len(upper), len(letters)), over(len(digits), chars), over(len(symbols), chars), over(t.count(".") + t.count(","), n), over(t.count(" "), chars), over(t.count("\n"), n), over(t.count("|"), n), over(t.count("!"), n),
        over(sum(a == b for a, b in pairs), n), over(len(set(words)), n), over(len(set(pairs)), n - 1), over(sum(len(w) > 20 for w in words), n), over(len(letters), chars), over(len(wide), chars),
    ]
