"""SentencePiece encoding with byte offsets, and decoding.

Texts are normalised by the model's compiled character map: at each place the longest prefix that
the map knows is replaced, else one character stays; spaces become the meta symbol and a leading
one is added. For every normalised byte the source byte it came from is recorded, so that the
piece lengths, summed up, project each piece to the original byte span that it covers.

No piece of a BPE model of this kind joins a meta symbol, or a line feed, to characters before it,
so merges never cross those places. The normalised text is cut there, and each distinct segment is
encoded once by the library and kept (a bounded number). A model that has such a piece is noticed
when it is loaded, and its texts are encoded whole.

Null and empty texts have the end id alone, and decode to the empty text. Rows are independent:
repeated rows repeat their result, an empty table gives an empty one, other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from attesta.llm.common import released, small_batches, table
from attesta.llm.wordbytes import mix, spans_hash

META = "▁"
KEPT_SEGMENTS = 200_000
BATCH_CHARS = 1 << 19


class CharacterMap:
    """The compiled character map of a model: a double-array trie over UTF-8 keys and a pool of replacements."""

    def __init__(self, blob: bytes):
        self.units, self.pool = np.empty(0, np.uint32), b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units, self.pool = np.frombuffer(blob, "<u4", size // 4, 4), blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key at a place, and what replaces it."""
        units, best, node = self.units, None, 0
        unit = int(units[0])
        node ^= (unit >> 10) << ((unit & 0x200) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = int(units[node])
            if (unit & 0x800000FF) != raw[i]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                value = int(units[node]) & 0x7FFFFFFF
                best = (i + 1 - at, self.pool[value : self.pool.index(b"\0", value)])
        return best

    def apply(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """Replaced bytes, and for each of them, and the end, the source byte where its key began."""
        if not len(self.units):
            return raw, np.arange(len(raw) + 1)
        out, source, at = bytearray(), [], 0
        while at < len(raw):
            size, new = self.longest(raw, at) or ((n := 1 + sum(raw[at] >= x for x in (0xC0, 0xE0, 0xF0))), raw[at : at + n])
            out += new
            source += [at] * len(new)
            at += size
        return bytes(out), np.array([*source, len(raw)])


class Codec:
    """Encodes and decodes with one model file."""

    def __init__(self, model: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        proto = pb.ModelProto()
        with open(model, "rb") as f:
            proto.ParseFromString(f.read())
        rule = proto.normalizer_spec
        self.map, self.prefix, self.trims = CharacterMap(rule.precompiled_charsmap), rule.add_dummy_prefix, rule.remove_extra_whitespaces
        pieces = [p.piece for p in proto.pieces if p.type in (1, 4)]
        self.cuts = (
            not rule.precompiled_charsmap and rule.escape_whitespaces and self.prefix and not self.trims and not proto.trainer_spec.treat_whitespace_as_suffix
            and proto.trainer_spec.model_type == 2 and not any(META in p.lstrip(META) or "\n" in p for p in pieces)
        )
        self.sizes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in proto.pieces])
        self.end = self.library.eos_id()
        self.names = [str(i) for i in range(len(proto.pieces))]
        self.feed = self.library.piece_to_id("<0x0A>")
        #: Known segments: hash -> row; ids of row r are pool[begin[r] : begin[r] + size[r]].
        self.kept: dict[int, int] = {}
        self.pool, self.used = np.empty(1 << 19, np.int32), 0
        self.begin, self.size = np.empty(1 << 18, np.int64), np.empty(1 << 18, np.int64)

    def _learn(self, raw: list[bytes]) -> list[np.ndarray]:
        """Ids of distinct segments: one call, in which a line feed keeps each from its neighbours."""
        plain = [r[1:] if r[:1] == b"\n" else r for r in raw]
        ids = np.array(self.library.encode((b"\n" + b"\n".join(plain)).decode()), np.int32)
        at = np.flatnonzero(ids == self.feed)
        ends = np.append(at[1:], len(ids))
        return [ids[i if r[:1] == b"\n" else i + 1 : j] for r, i, j in zip(raw, at, ends, strict=True)]

    def _rows(self, hashes: list[int], raw) -> np.ndarray:
        """Where in the pool each segment is; raw(i) gives the bytes of one that isn't there yet."""
        rows = np.array([self.kept.get(h, -1) for h in hashes], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new) and len(self.kept) + len(new) > KEPT_SEGMENTS:
            self.kept.clear()
            self.used = 0
            new = np.arange(len(rows))
        if len(new):
            found = self._learn([raw(i) for i in new.tolist()])
            sizes = np.array([len(f) for f in found])
            flat, at = np.concatenate(found), self.used
            for name, least in (("pool", at + len(flat)), ("begin", len(self.kept) + len(new)), ("size", len(self.kept) + len(new))):
                if len(getattr(self, name)) < least:
                    setattr(self, name, np.concatenate([getattr(self, name)[: least * 2], np.empty(2 * least - len(getattr(self, name)), getattr(self, name).dtype)]))
            first = len(self.kept)
            self.pool[at : at + len(flat)] = flat
            self.begin[first : first + len(new)] = at + np.cumsum(sizes) - sizes
            self.size[first : first + len(new)] = sizes
            self.used += len(flat)
            self.kept.update(zip((hashes[i] for i in new.tolist()), range(first, first + len(new)), strict=True))
            rows[new] = np.arange(first, first + len(new))
        return rows

    def _by_segments(self, texts: list[str]) -> list[list[int]]:
        """Each text is cut before a run of spaces and before a line feed; the cuts' ids are strung together."""
        raw = [b" " + t.encode() for t in texts]
        borders = np.cumsum([0, *map(len, raw)])
        data = np.frombuffer(b"".join(raw), np.uint8)
        space = data == 32
        first = (data == 10) | space
        first[1:] &= ~(space[1:] & space[:-1])
        first[borders[:-1]] = True
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        hashes = mix(spans_hash(data.astype(np.uint64) + np.uint64(1), starts, ends, 0x9E3779B97F4A7C15) + (ends - starts).astype(np.uint64))
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        rows = self._rows(distinct.tolist(), lambda i: data[starts[where[i]] : ends[where[i]]].tobytes())[inverse]
        sizes = self.size[rows]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.begin[rows] - total[:-1], sizes) + np.arange(total[-1])]
        edges = total[np.searchsorted(starts, borders)]
        return [ids[i:j].tolist() for i, j in zip(edges[:-1], edges[1:], strict=True)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], str]]:
        """(all ids, the end id last; decoded text) of each text.

        Segments are known by a 64-bit hash; a text that doesn't decode to itself is encoded anew.
        """
        part: list[str] = []

        def flush() -> Iterator[tuple[list[int], str]]:
            whole = [t for t in part if t]
            found = iter(self._by_segments(whole) if self.cuts and whole else self.library.encode(whole, num_threads=1))
            for t in part:
                ids = [*next(found), self.end] if t else [self.end]
                back = self.library.decode(ids)
                if t and self.cuts and back != t:
                    ids = [*self.library.encode(t), self.end]
                    back = self.library.decode(ids)
                yield ids, back

        size = 0
        for t in texts:
            part.append(t or "")
            size += len(part[-1])
            if size >= BATCH_CHARS:
                yield from flush()
                part, size = [], 0
        yield from flush()

    def shown(self, ids: list[int]) -> str:
        """Decimal ids joined by one space."""
        names = self.names
        return " ".join([names[i] for i in ids])

    def normalise(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes and the source byte of each, and of the end."""
        raw, source = self.map.apply((text or "").encode())
        if self.trims:
            raw, source = _trimmed(raw, source)
        if not raw:
            return b"", source[-1:]
        space = np.frombuffer(raw, np.uint8) == 32
        widths = np.where(space, 3, 1)
        spread = np.repeat(source[:-1], widths)
        out = raw.replace(b" ", META.encode())
        if self.prefix:
            out, spread = META.encode() + out, np.concatenate([np.repeat(source[:1], 3), spread])
        return out, np.append(spread, source[-1])

    def borders(self, text: str | None, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Where the original bytes of each id but the end begin and end; a dummy prefix alone covers nothing.

        The model must have byte fallback: an unknown piece would cover any number of bytes.
        """
        normal, source = self.normalise(text or "")
        sizes = self.sizes[np.array(ids[:-1], np.int64)]
        ends = np.cumsum(sizes)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError(f"pieces cover {sizes.sum()} of {len(normal)} normalised bytes")
        return source[ends - sizes], source[ends]

    def spans(self, text: str | None, ids: list[int]) -> list[tuple[int, int]]:
        """Original byte span of each id but the end."""
        begins, ends = self.borders(text, ids)
        return list(zip(begins.tolist(), ends.tolist(), strict=True))

    def aligned(self, texts: list[str | None]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, str]]:
        """(all ids, begins and ends of the original bytes of each but the end id, decoded text) of each text."""
        for text, (ids, back) in zip(texts, self.encode(texts), strict=True):
            yield ids, *self.borders(text, ids), back


def _trimmed(raw: bytes, source: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Without spaces at either end, and one for each run."""
    data = np.frombuffer(raw, np.uint8)
    space = data == 32
    keep = ~(space & np.concatenate([[True], space[:-1]]))
    kept = np.flatnonzero(keep)
    if len(kept) and space[kept[-1]]:
        kept = kept[:-1]
    return data[kept].tobytes(), np.append(source[kept], source[-1] if not len(kept) else source[kept[-1] + 1])


_codecs: dict[str, Codec] = {}


def codec(model: str) -> Codec:
    """The codec of a model file, loaded once in a process."""
    if model not in _codecs:
        _codecs[model] = Codec(model)
    return _codecs[model]


@released
def _digests(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    c = codec(model)
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for batch in batches:
        n, shown, back, spans = [], [], [], []
        for ids, begins, ends, text in c.aligned(batch.column(1).to_pylist()):
            n.append(len(begins) + 1)
            shown.append(hexed(c.shown(ids)))
            back.append(hexed(text))
            spans.append(hashlib.sha256(np.stack([begins, ends], 1).astype("<i8").tobytes()).hexdigest())
        columns = [pa.array(n, pa.int64()), *(pa.array(c, pa.string()) for c in (shown, back, spans))]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])


@released
def _encoded(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    c = codec(model)
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for i in range(batch.num_rows):
            ((ids, begins, ends, decoded),) = c.aligned([batch.column(1)[i].as_py()])
            spans = [{"begin": a, "end": b} for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([ids], pa.list_(pa.int32())), pa.array([spans], span), pa.array([decoded])], ["doc_id", "ids", "spans", "decoded"])


def _mapped(docs: DataFrame, work, model: str, fields: str) -> DataFrame:
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.selectExpr("doc_id", "cast(text as string) as text").mapInArrow(lambda b: work(b, model), f"doc_id {kind}, {fields}")


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (with the end id), spans (original bytes of each id but the last), decoded."""
    return _mapped(docs, _encoded, model, "ids array<int>, spans array<struct<begin:bigint,end:bigint>>, decoded string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_sha256 of whole texts, each normalised and aligned as in `encode`.

    spans_sha256: digest of begin and end of each id but the last, as 64-bit integers.
    """
    return _mapped(docs, _digests, model, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), default_model())
