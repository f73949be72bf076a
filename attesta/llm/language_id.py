"""Language identification by cross-parsing: how few phrases of a language's text a document takes.

For each language a suffix automaton is built over a bounded sample of labelled text. A document
is parsed greedily from left to right into the longest phrases that occur in the sample; following
the automaton gives every longest match in linear time. The phrases for each character are the
language's estimate of cross entropy, and the language that needs the fewest wins.

The sample: labelled documents until `sample_chars` for each language. First come whole ones of 200
to 6,000 characters, at most `sample_rows`, in the order of a hash of doc_id and text. A language
whose such documents give fewer characters and are fewer than `sample_rows` takes others as well:
longer ones for the rows that are left, each cut to `sample_chars`, then shorter ones that count
together as a row for each 200 characters. Only text and lang of rows with a lang and with
crc32(doc_id as text) mod 3 other than 1 are read, in two passes for all languages together.

All documents of a batch walk all automata in step. Long ones are cut into pieces of `PIECE`
characters that are first parsed each from its own start; then each piece is entered with the phrase
that its predecessor leaves open, and followed until both parses end a phrase at one place, from
where they are the same. The result is the parse of the whole text. Letters are case-folded, runs of
other characters are one symbol. Null text, or text without a letter, is `und` with score 0, as is
every document when there is no labelled row with a letter. Ties go to the language that sorts
first. Rows are judged one by one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import released, small_batches, table

UNDETERMINED = "und"
PIECE = 512
#: Characters of the documents that are learned from first.
LEAST, MOST = 200, 6_000
_BATCH_CHARS = 1 << 22


class SuffixAutomaton:
    """All substrings of a text over symbols 0..k-1, as a dense transition table.

    `step[state * k + c]` is the next state, or ~(state after c alone) where the phrase ends.
    """

    def __init__(self, symbols: list[int], k: int):
        link, length, edges = [-1], [0], [{}]
        last = 0
        for c in symbols:
            cur = len(link)
            link.append(0)
            length.append(length[last] + 1)
            edges.append({})
            p = last
            while p >= 0 and c not in edges[p]:
                edges[p][c] = cur
                p = link[p]
            if p >= 0:
                q = edges[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(link)
                    link.append(link[q])
                    length.append(length[p] + 1)
                    edges.append(dict(edges[q]))
                    while p >= 0 and edges[p].get(c) == q:
                        edges[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            last = cur
        # One column more, for the padding of short pieces: it keeps the state. One state more,
        # for a symbol that the text lacks: that symbol is a phrase of its own.
        lost = len(edges)
        step = np.empty((lost + 1, k + 1), np.int32)
        step[:, :k] = [~edges[0].get(c, lost) for c in range(k)]
        step[0, :k] = [edges[0].get(c, lost) for c in range(k)]
        step[:, k] = np.arange(lost + 1)
        for state, to in enumerate(edges):
            for c, t in to.items():
                step[state, c] = t
        self.k, self.step = k + 1, step.ravel()

    def walk(self, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases begin in each column of a (steps x pieces) grid of symbols, and the state at its end."""
        state = np.zeros(grid.shape[1], np.int32)
        begins = np.empty(grid.shape, bool)
        for row, out in zip(grid, begins, strict=True):
            state = self.step[state * self.k + row]
            np.less(state, 0, out=out)
            state ^= state >> 31
        begins[0] = grid[0] < self.k - 1
        return begins, state

    def stitched(self, flat: np.ndarray, start: np.ndarray, stop: np.ndarray, first: np.ndarray, begins: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Phrases that begin in each piece flat[start:stop] when texts are parsed whole.

        first: the piece opens a text; others go on where the piece before them ends. begins, state:
        what `walk` found in each piece by itself.
        """
        before = np.concatenate([[0], np.cumsum(begins, dtype=np.int32)])
        count, leaves = before[stop] - before[start], state.copy()
        entered = np.full(len(start), -1, np.int32)
        todo = np.flatnonzero(~first)
        while len(todo):
            todo = todo[leaves[todo - 1] != entered[todo]]
            entered[todo] = now = leaves[todo - 1]
            at, found, out = start[todo].copy(), np.zeros(len(todo), np.int64), state[todo].copy()
            live = np.arange(len(todo))
            while len(live):
                p = at[live]
                now = self.step[now * self.k + flat[p]]
                ended = now < 0
                now ^= now >> 31
                found[live] += ended
                met = ended & begins[p]
                found[live[met]] += before[stop[todo[live[met]]]] - before[p[met] + 1]
                at[live] = p + 1
                over = ~met & (p + 1 >= stop[todo[live]])
                out[live[over]] = now[over]
                live, now = live[~met & ~over], now[~met & ~over]
            count[todo] = found
            changed = todo[out != leaves[todo]]
            leaves[todo] = out
            todo = changed[changed + 1 < len(start)] + 1
            todo = todo[~first[todo]]
        return count


class Model:
    """Languages in order, their automata, and the symbol of each character."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        known = sorted({c for t in samples.values() for c in t if c.isalpha()})
        self.symbol = np.zeros(0x110000, np.int16)
        for i, c in enumerate(known):
            self.symbol[ord(c)] = i + 2
        for c in range(0x110000):
            if self.symbol[c] == 0 and chr(c).isalpha():
                self.symbol[c] = 1  # a letter that no sample has
        self.k = len(known) + 2
        self.automata = [SuffixAutomaton(self.encode(samples[lang]).tolist(), self.k) for lang in self.langs]

    def encode(self, text: str) -> np.ndarray:
        """Symbols of a folded text; a run of other characters is one symbol."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.symbol[points]
        if len(found) > 1:
            found = found[np.concatenate([[True], (found[1:] != 0) | (found[:-1] != 0)])]
        return found

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases for a character by text and language, symbols of each text)."""
        coded = [self.encode(t) for t in texts]
        sizes = np.array([len(c) for c in coded], np.int64)
        flat = np.concatenate(coded) if coded else np.empty(0, np.int16)
        pieces = -(-sizes // PIECE)
        owner = np.repeat(np.arange(len(texts)), pieces)
        begin = np.cumsum(sizes) - sizes
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begin[owner] + nth * PIECE
        stop = np.minimum(start + PIECE, (begin + sizes)[owner])
        begins = np.zeros((len(self.langs), len(flat)), bool)
        state = np.zeros((len(self.langs), len(start)), np.int32)
        order = np.argsort(start - stop, kind="stable")
        # Pieces of like length share a grid, so that padding is little.
        for at in range(0, len(order), 8192):
            mine = order[at : at + 8192]
            most = int((stop[mine] - start[mine]).max())
            places = start[mine] + np.arange(most)[:, None]
            real = places < stop[mine]
            grid = np.where(real, flat[np.minimum(places, len(flat) - 1)], self.k).astype(np.int32)
            places = places[real]
            for j, automaton in enumerate(self.automata):
                new, state[j, mine] = automaton.walk(grid)
                begins[j, places] = new[real]
        phrases = np.zeros((len(texts), len(self.langs)), np.int64)
        for j, automaton in enumerate(self.automata):
            np.add.at(phrases[:, j], owner, automaton.stitched(flat, start, stop, nth == 0, begins[j], state[j]))
        return phrases / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, float]]:
        """(language, score, phrases for a character) of each text.

        The score is the winner's share when each language is weighed by exp(-bits): a phrase is
        worth the bits that point to its place in the sample.
        """
        out: list[tuple[str, float, float]] = [(UNDETERMINED, 0.0, 0.0)] * len(texts)
        real = [i for i, t in enumerate(texts) if t and self.langs and any(map(str.isalpha, t))]
        if not real:
            return out
        costs, sizes = self.costs([texts[i].lower() for i in real])
        best = costs.argmin(1)
        # Four phrases a hundred characters tell languages apart; a text's length adds to it.
        weight = np.exp(-25.0 * (costs - costs.min(1)[:, None]) * np.minimum(1.0, sizes / 50.0)[:, None])
        score = 1 / weight.sum(1)
        for k, i in enumerate(real):
            out[i] = (self.langs[best[k]], float(score[k]), float(costs[k, best[k]]))
        return out


_models: dict[int, Model] = {}


def model_of(samples: dict[str, str]) -> Model:
    """The model of these samples, built once in a process."""
    key = zlib.crc32(repr(sorted(samples.items())).encode())
    if key not in _models:
        _models.clear()
        _models[key] = Model(samples)
    return _models[key]


def held_out(doc_id: str = "doc_id"):
    """Rows kept from learning: crc32 of doc_id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, *, sample_chars: int = 24_000, sample_rows: int = 60) -> dict[str, str]:
    """Sample text of each language.

    One pass counts the labelled rows of each language and kind, one brings the rows under a bound of
    their hash that is set so that four times the sample is expected to reach the driver.
    """
    size = F.length("text")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    # Only texts with a letter teach anything.
    rows = rows.where(~held_out() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}"))
    kind = F.when(size < LEAST, "short").when(size > MOST, "long").otherwise("usual")
    rows = rows.select("lang", kind.alias("kind"), F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"), size.alias("size"), "text")
    counts: dict[str, dict[str, tuple[int, int]]] = {}
    for r in rows.groupBy("lang", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars")).collect():
        counts.setdefault(r["lang"], {})[r["kind"]] = (r["n"], r["chars"])

    wanted: dict[tuple[str, str], tuple[int, int]] = {}
    bounds = []
    for lang, of in counts.items():
        left = sample_rows
        for k in ("usual", "long", "short"):
            n, chars = of.get(k, (0, 0))
            if n and left > 0:
                limit = min(sample_chars, left * LEAST) if k == "short" else sample_chars
                wanted[lang, k] = (n if k == "short" else left, limit)
                share = 4 * limit / chars if k == "short" else 4 * left / n
                bounds.append((lang, k, min((1 << 63) - 1, -(1 << 63) + int(min(1.0, share) * (1 << 64)))))
            left -= n
    if not bounds:
        return {}
    # A row for each language and kind; languages have an automaton each, so they are few.
    few = rows.join(F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, kind string, most long")), ["lang", "kind"]).where("h <= most")
    picked: dict[tuple[str, str], list] = {}
    for r in few.select("lang", "kind", "h", F.substring("text", 1, max(MOST, sample_chars)).alias("text")).distinct().collect():
        picked.setdefault((r["lang"], r["kind"]), []).append((r["h"], r["text"]))
    samples = {}
    for lang in counts:
        taken: list[str] = []
        for k in ("usual", "long", "short"):
            most_rows, limit = wanted.get((lang, k), (0, 0))
            have = sum(map(len, taken))
            limit = min(limit, sample_chars - have) + have
            for _, text in sorted(picked.get((lang, k), ()))[:most_rows]:
                if have < limit:
                    taken.append(text[:sample_chars].lower() if k == "long" else text.lower())
                    have += len(taken[-1])
        if any(map(str.isalpha, "".join(taken))):
            samples[lang] = "\n".join(taken)
    return samples


def _by_parts(model: Model, texts: list[str | None]) -> list[tuple[str, float, float]]:
    """Predictions, a bounded number of characters at a time."""
    found: list[tuple[str, float, float]] = []
    part: list[str | None] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= _BATCH_CHARS:
            found += model.predict(part)
            part, size = [], 0
    return found + model.predict(part)


@released
def _predicted(batches: Iterator[pa.RecordBatch], samples: dict[str, str]) -> Iterator[pa.RecordBatch]:
    model = model_of(samples)
    for batch in batches:
        found = _by_parts(model, batch.column(1).to_pylist())
        lang, score, cost = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(cost, pa.float64())], ["doc_id", "lang_pred", "score", "phrase_rate"])


@released
def _known(batches: Iterator[pa.RecordBatch], samples: dict[str, str], languages: frozenset[str] | None, least_score: float, most_rate: float, least_chars: int) -> Iterator[pa.RecordBatch]:
    model = model_of(samples)
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        found = _by_parts(model, texts)
        keep = [
            bool(text) and any(map(str.isalpha, text))
            if not samples
            else lang != UNDETERMINED and (languages is None or lang in languages) and score >= least_score and (rate <= most_rate or len(text) < least_chars)
            for text, (lang, score, rate) in zip(texts, found, strict=True)
        ]
        yield batch.filter(pa.array(keep, pa.bool_()))


def identify(docs: DataFrame, samples: dict[str, str]) -> DataFrame:
    """doc_id, lang_pred, score, phrase_rate (phrases for a character; lower is more alike)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(lambda b: _predicted(b, samples), f"doc_id {kind}, lang_pred string, score double, phrase_rate double")


def keep_known(docs: DataFrame, samples: dict[str, str], *, languages: set[str] | None = None, least_score: float = 0.0, most_rate: float = 0.6, least_chars: int = 8) -> DataFrame:
    """The documents whose language is found, all columns as they were; no shuffle.

    A prediction outside `languages` (where given), one with a score under `least_score`, and a text
    of `least_chars` characters or more that even its best language parses into more than `most_rate`
    phrases a character are rejected: the last are texts that no learned language explains. Where no
    language was learned, only texts without a letter are rejected.
    """
    small_batches(docs.sparkSession)
    wanted = None if languages is None else frozenset(languages)
    return docs.mapInArrow(lambda b: _known(b, samples, wanted, least_score, most_rate, least_chars), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def brute_force(samples: dict[str, str], text: str | None) -> tuple[str, float]:
    """(language, score) from greedy parses of the whole text, by substring search."""
    import math

    known = {c for t in samples.values() for c in t if c.isalpha()}

    def coded(t: str) -> str:
        out = "".join(c if c in known else "\1" if c.isalpha() else "\0" for c in t)
        while "\0\0" in out:
            out = out.replace("\0\0", "\0")
        return out

    if not text or not samples or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0
    t = coded(text.lower())
    rates = {}
    for lang in sorted(samples):
        sample, n, at = coded(samples[lang]), 0, 0
        while at < len(t):
            size = 1
            while at + size < len(t) and t[at : at + size + 1] in sample:
                size += 1
            at += size
            n += 1
        rates[lang] = n / len(t)
    best = min(rates, key=rates.get)
    return best, 1 / sum(math.exp(-25 * (r - rates[best]) * min(1, len(t) / 50)) for r in rates.values())
