"""SentencePiece BPE encoding by a prefix table, and decoding.

A merge-type (BPE) encoding is fixed by the last token of every prefix: for each prefix of a text exactly
one vocabulary entry can stand last, namely the match that ends there and that may follow the last token of
the prefix before it. A pair of tokens may be neighbours if merging their joined characters gives the pair
back. So one pass over the characters fills a table (prefix -> last token), with the candidates from an
automaton over the vocabulary, and the ids are read off backwards.

No entry has a word mark after another character (checked when the model is loaded), so merges never cross
from the end of one word into the mark of the next: words are encoded on their own, and a task keeps the
ids of words it has met. Work and memory are linear in the text, whatever its length; the memory of words is
emptied when full, which changes no result.

Nulls and empty texts give the begin and end ids only and decode to the empty text; repeated rows give
repeated results; an empty table gives an empty result; other columns pass through, those named `ids` and
`decoded` are replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
WORDS_KEPT = 400_000
PAIRS_KEPT = 1_000_000
LONGEST_KEPT = 48
# piece types of the model file
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


@dataclass
class Pieces:
    """A BPE model with byte fallback, read from a sentencepiece model file."""

    path: str
    kept: dict[str, bytes] = field(default_factory=dict)
    fits: dict[int, bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        from sentencepiece import sentencepiece_model_pb2 as model

        proto = model.ModelProto()
        with open(self.path, "rb") as file:
            proto.ParseFromString(file.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type != model.TrainerSpec.BPE or not proto.trainer_spec.byte_fallback:
            raise ValueError("a BPE model with byte fallback is needed")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only models that leave texts as they are but for the first mark are known")
        self.texts = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        self.scores = [p.score for p in proto.pieces]
        self.ids = {p: i for i, (p, kind) in enumerate(zip(self.texts, self.kinds, strict=True)) if kind == NORMAL}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("an entry has a word mark after another character")
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.texts) if self.kinds[i] == BYTE}
        self.begin, self.end = self.texts.index("<s>"), self.texts.index("</s>")
        # what an entry stands for by itself; bytes beyond ASCII depend on their neighbours
        self.hard = np.array([kind == BYTE and int(p[3:5], 16) > 127 for p, kind in zip(self.texts, self.kinds, strict=True)])
        self.plain = [self.alone(i) for i in range(len(self.texts))]
        self.word = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if self.merged(piece) == [piece]:  # others are never the outcome of merging
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def alone(self, i: int) -> str:
        piece, kind = self.texts[i], self.kinds[i]
        if kind == BYTE:
            return "" if self.hard[i] else chr(int(piece[3:5], 16))
        return {NORMAL: piece.replace(MARK, " "), UNKNOWN: " ⁇ "}.get(kind, "")

    def merged(self, text: str) -> list[str]:
        """The plain merging of a short text: the best-scored neighbours first, from the left."""
        parts = list(text)
        while len(parts) > 1:
            joined = [self.ids.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
            best = max((i for i in joined if i is not None), key=lambda i: self.scores[i], default=None)
            if best is None:
                break
            at = joined.index(next(i for i in joined if i is not None and self.scores[i] == self.scores[best]))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        a, b = self.texts[left], self.texts[right]
        if len(self.fits) >= PAIRS_KEPT:
            self.fits.clear()
        known = self.fits[left << 32 | right] = self.merged(a + b) == [a, b]
        return known

    def table(self, word: str) -> list[int]:
        """The last token of each prefix of `word`: an id, or -1 where a character is in no entry."""
        last, ids, fits = [-1] * len(word), self.ids, self.fits
        for at, (i, n) in self.automaton.iter(word):  # in order of their ends
            if last[at] >= 0:
                continue
            before = at - n
            if before >= 0:
                left = last[before]
                if left < 0:
                    if word[before] in ids:
                        continue  # no token ends there
                else:
                    known = fits.get(left << 32 | i)
                    if not (self.may_follow(left, i) if known is None else known):
                        continue
            last[at] = i
        return last

    def ids_of(self, word: str) -> list[int]:
        last, out, at = self.table(word), [], len(word) - 1
        while at >= 0:
            i = last[at]
            if i < 0:
                out.extend(self.bytes[b] for b in reversed(word[at].encode()))
                at -= 1
            else:
                out.append(i)
                at -= len(self.texts[i])
        out.reverse()
        return out

    def packed(self, word: str) -> bytes:
        known = self.kept.get(word)
        if known is None:
            known = np.array(self.ids_of(word), "<u4").tobytes()
            if len(word) <= LONGEST_KEPT:
                if len(self.kept) >= WORDS_KEPT:
                    self.kept.clear()
                self.kept[word] = known
        return known

    def encode(self, text: str) -> bytes:
        """All ids of the text, begin and end among them, as little-endian unsigned 32-bit integers."""
        parts = self.word.findall(MARK + text.replace(" ", MARK)) if text else []
        ends = np.array([self.begin, self.end], "<u4").tobytes()
        return ends[:4] + b"".join(map(self.packed, parts)) + ends[4:]

    def decode(self, ids: np.ndarray) -> str:
        """Pieces joined, runs of byte entries read as UTF-8 (U+FFFD for a byte that fits nowhere), marks
        turned into blanks, the blank of the first mark dropped."""
        texts, kinds = self.texts, self.kinds
        if not self.hard[ids].any():
            named = ids.tolist()
            joined = "".join(map(self.plain.__getitem__, named))
            first = next((i for i in named if kinds[i] != CONTROL), self.begin)
            return joined[1:] if kinds[first] == NORMAL and texts[first].startswith(MARK) else joined
        out, run, first = [], bytearray(), True
        for i in ids.tolist():
            kind = kinds[i]
            if kind == BYTE:
                run.append(int(texts[i][3:5], 16))
                first = False
                continue
            if run:
                out.append(utf8(bytes(run)))
                run.clear()
            if kind != CONTROL:
                piece = " ⁇ " if kind == UNKNOWN else texts[i].replace(MARK, " ")
                out.append(piece[1:] if first and kind == NORMAL and piece.startswith(" ") else piece)
                first = False
        return "".join(out) + utf8(bytes(run))


def utf8(run: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that starts no whole character."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of a worker process, loaded once."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`docs` with the ids of each whole text and the text decoded from those ids."""
    source = docs.drop(ids, decoded)
    columns = source.columns
    schema = T.StructType([*source.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False)), T.StructField(decoded, T.StringType())])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for whole in batches:
            for batch in _slices(whole, 256):
                packed = [np.frombuffer(model.encode(x or ""), "<i4") for x in batch.column(columns.index(text)).to_pylist()]
                offsets = np.cumsum([0, *map(len, packed)], dtype=np.int32)
                values = np.concatenate(packed) if packed else np.empty(0, "<i4")
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))
                back = pa.array([model.decode(x) for x in packed], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, back], names=[*columns, ids, decoded])

    return source.mapInArrow(encoded, schema)


def ids_digest(ids: Column) -> Column:
    """SHA-256 of ids as little-endian unsigned 32-bit integers, in lower-case hex."""
    @F.pandas_udf(T.StringType())
    def digest(lists: pd.Series) -> pd.Series:
        return lists.map(lambda x: None if x is None else hashlib.sha256(np.asarray(x, "<u4").tobytes()).hexdigest())

    return digest(ids)
