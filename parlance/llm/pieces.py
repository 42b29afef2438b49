"""Operator 8, SentencePiece encoding and decoding: batched Viterbi in numpy.

Texts are normalised by the model's own rules and cut into words; each distinct word of a batch is encoded once, and words of
equal length advance together as the rows of one matrix. The rolling hashes of all their substrings of up to the longest
piece's length are probed among the sorted hashes of the pieces; a piece that is found is compared with the substring, so a
collision of hashes can't pass. Then the ends advance: at each the best sum of scores over all pieces that end there, for all
words at once, is stored with its backpointer. Time is linear in a word's length, and a long word takes a few arrays of that
length, so texts without spaces are no special case.

Scores: those of a unigram model are log-probabilities and are summed as they are. Those of a pair-merge (BPE) model are
negative ranks. Pieces follow Zipf's law, so rank r counts as the log-probability -log(r + 1) - log(H), with H the sum of
1 / (r + 1) over all ranks. The best sum under these isn't always what merging gives; README has figures. Decoding gives the
same text back either way.

Characters that no piece holds become their UTF-8 bytes where the model has byte pieces, else the unknown piece.

Edge cases: null texts have no pieces and decode to null; empty ones have none and decode to "". Extra columns stay; where one
is called like an output (in any case), the output's name gets underscores. Repeated rows are encoded one by one. Empty tables
give none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from parlance.llm.common import fresh

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
#: Characters (rows x width) that advance together, and ends of one word whose substrings are probed together.
CELLS = 100_000


class Codec:
    """Encodes and decodes with the pieces of a SentencePiece model, given as the bytes of its file."""

    def __init__(self, model: bytes, memory: int = 600_000) -> None:
        sp = self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        self.unknown = sp.unk_id()
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(n) if byte[i]}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.plain = [i for i in range(n) if not special[i] and not byte[i]]
        #: what an id stands for in a decoded text, and which ids are bytes of longer characters
        self.surface = [p.replace(SPACE, " ") for p in self.pieces]
        for i in range(n):
            if special[i]:
                self.surface[i] = " \u2047 " if i == self.unknown else ""
            elif byte[i]:
                self.surface[i] = chr(self.byte_of[i])
        self.surfaces = np.array(self.surface, object)
        self.high = np.array([byte[i] and self.byte_of[i] > 127 for i in range(n)])
        scores = [sp.get_score(i) for i in self.plain]
        self.inside = any(SPACE in self.pieces[i].lstrip(SPACE) for i in self.plain)
        self.memory, self.known = memory, {}
        self._tables(log_probabilities(scores))

    def _tables(self, scores: np.ndarray) -> None:
        """Sorted hashes of the pieces; their ids, scores and code points in that order."""
        texts = [self.pieces[i] for i in self.plain]
        self.longest = max(map(len, texts), default=1)
        self.codes = np.zeros((len(texts), self.longest), np.uint32)
        for k, t in enumerate(texts):
            self.codes[k, : len(t)] = [ord(c) for c in t]
        lengths, keys = np.array([len(t) for t in texts], int), np.zeros(len(texts), np.uint64)
        for n in range(self.longest):
            at = lengths > n
            keys[at] = keys[at] * _BASE + self.codes[at, n] + np.uint64(1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.codes = keys[order], self.codes[order]
        #: whether any key begins with these 20 bits: most substrings need no search
        self.starts = np.zeros(1 << 20, bool)
        self.starts[self.keys >> np.uint64(44)] = True
        self.ids = np.array(self.plain, np.int32)[order]
        self.scores = np.asarray(scores, np.float32)[order]
        self.unknown_score = np.float32(self.scores.min(initial=0.0) - 10.0)

    # Viterbi

    def _probe(self, codes: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Place among the sorted keys (-1: none) and score of the substring of each length that ends at each of lo + 1 .. hi."""
        rows = len(codes)
        place = np.full((rows, hi - lo, self.longest), -1, np.int32)
        score = np.full((rows, hi - lo, self.longest), -np.inf, np.float32)
        score[:, :, 0] = self.unknown_score
        values = codes.astype(np.uint64) + np.uint64(1)
        h, power = np.zeros((rows, hi - lo), np.uint64), np.uint64(1)
        for n in range(1, self.longest + 1):  # the substring of n characters before end e starts at e - n
            skip = max(0, n - 1 - lo)
            if skip >= hi - lo:
                break
            h[:, skip:] += values[:, lo + skip + 1 - n : hi + 1 - n] * power
            with np.errstate(over="ignore"):
                power = power * _BASE
            r, e = np.nonzero(self.starts[h[:, skip:] >> np.uint64(44)])
            e = e + skip
            probe = h[r, e]
            k = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            same = self.keys[k] == probe
            r, e, k = r[same], e[same], k[same]
            same = np.ones(len(r), bool)
            for j in range(n):
                same &= codes[r, lo + e + 1 - n + j] == self.codes[k, j]
            if n < self.longest:
                same &= self.codes[k, n] == 0
            r, e, k = r[same], e[same], k[same]
            place[r, e, n - 1], score[r, e, n - 1] = k, self.scores[k]
        return place, score

    def _viterbi(self, codes: np.ndarray) -> list[list[int]]:
        """Ids of the best segmentation of each row of code points."""
        rows, width = codes.shape
        m = self.longest
        best = np.full((rows, m + width + 1), -np.inf, np.float32)  # the first m columns stand before the word
        best[:, m] = 0
        back, piece = np.zeros((rows, width), np.uint8 if m < 256 else np.int32), np.zeros((rows, width), np.int32)
        row = np.arange(rows)
        step = max(m, CELLS // rows)
        for lo in range(0, width, step):
            hi = min(width, lo + step)
            place, score = self._probe(codes, lo, hi)
            for e in range(hi - lo):
                end = lo + e
                total = best[:, m + end - np.arange(m)] + score[:, e]
                top = total.argmax(1)
                best[:, m + end + 1] = total[row, top]
                back[:, end], piece[:, end] = top, place[row, e, top]
        out: list[list[int]] = []
        for r in range(rows):
            found, end = [], width
            steps, chosen = back[r].tolist() if width < 64 else back[r], piece[r]
            while end:
                k = int(chosen[end - 1])
                found.append(int(self.ids[k]) if k >= 0 else -1 - int(codes[r, end - 1]))
                end -= int(steps[end - 1]) + 1
            out.append(self._spell(found[::-1]))
        return out

    # texts

    def _spell(self, symbols: list[int]) -> list[int]:
        """Ids of a word's symbols: bytes or the unknown piece for characters (-1 - code point) that no piece holds."""
        if not any(s < 0 for s in symbols):
            return symbols
        out: list[int] = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            elif self.byte_id:
                out.extend(self.byte_id[b] for b in chr(-1 - s).encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def words(self, text: str) -> list[str]:
        normal = self.model.normalize(text)
        return [normal] * bool(normal) if self.inside else _WORD.findall(normal)

    def _learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > self.memory:
            self.known.clear()
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            per = max(1, CELLS // n)
            for at in range(0, len(group), per):
                part = group[at : at + per]
                codes = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), n)
                self.known.update(zip(part, self._viterbi(codes), strict=True))

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if t is None else self.words(t) for t in texts]
        new = {w for ws in cut if ws for w in ws}.difference(self.known)
        if len(self.known) + len(new) > self.memory:
            self.known.clear()
            new = {w for ws in cut if ws for w in ws}
        self._learn(sorted(new))
        out: list[np.ndarray | None] = []
        for ws in cut:
            ids: list[int] = []
            for part in map(self.known.__getitem__, ws or ()):
                ids += part
            out.append(None if ws is None else np.array(ids, np.int32))
        return out

    def decode(self, lists: list[np.ndarray | None]) -> list[str | None]:
        """Texts of many lists of ids: all ids are turned into what they stand for at once, bytes of longer characters apart."""
        full = [x for x in lists if x is not None]
        flat = np.concatenate(full) if full else np.zeros(0, np.int32)
        ends = np.cumsum([0, *map(len, full)]).tolist()
        parts, high, texts = self.surfaces[flat].tolist(), self.high[flat], []
        for lo, hi in zip(ends, ends[1:], strict=False):
            if high[lo:hi].any():
                texts.append(self._with_bytes(flat[lo:hi].tolist()))
            else:
                texts.append("".join(parts[lo:hi]).removeprefix(" "))
        rest = iter(texts)
        return [None if x is None else next(rest) for x in lists]

    def _with_bytes(self, ids: list[int]) -> str:
        out, data = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                data.append(self.byte_of[i])
                continue
            out.append(data.decode(errors="replace"))
            data.clear()
            out.append(self.surface[i])
        out.append(data.decode(errors="replace"))
        return "".join(out).removeprefix(" ")


def log_probabilities(scores: list[float]) -> np.ndarray:
    """Of the pieces: their scores, or where these are negative ranks what Zipf's law makes of them."""
    x = np.array(scores, float)
    if not len(x) or (x != np.round(x)).any():
        return x
    rank = np.unique(-x, return_inverse=True)[1]
    return -np.log(rank + 1.0) - np.log((1 / np.arange(1, len(x) + 1)).sum())


def encode(docs: DataFrame, model: str = MODEL, text: str = "text", out: str = "ids", check: str | None = None) -> DataFrame:
    """docs with the array of piece ids in `out`, and where `check` is given, in that column whether decoding gives the text back.

    model: a file that the driver can read. Its bytes, one vocabulary, travel with the tasks.
    """
    with open(model, "rb") as f:
        data = f.read()
    out, *checks = fresh(docs, [out] + [check] * (check is not None))
    fields = docs.schema.fields
    schema = StructType([*fields, StructField(out, ArrayType(IntegerType())), *[StructField(c, LongType()) for c in checks]])
    # inside the tasks columns go by their place, as names may repeat
    place = [x.name for x in fields].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(place).to_pylist()
                ids = codec.encode(texts)
                columns = [*part.columns, pa.array(ids, pa.list_(pa.int32()))]
                if checks:
                    columns.append(pa.array([None if t is None else int(b == t) for t, b in zip(texts, codec.decode(ids), strict=True)], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """docs with the decoded text in `out`; a column of that name gives way to it."""
    with open(model, "rb") as f:
        data = f.read()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(data)
        for batch in batches:
            yield pd.Series(codec.decode([None if x is None else np.asarray(x, np.int32) for x in batch]), dtype=object)

    return docs.withColumn(out, run(F.col(ids)))
