"""Token ids of a whole corpus by a public byte-level BPE tokenizer (problem 8).

Method: forced-boundary splitting. Two bytes that are never neighbours inside any vocabulary token can never be merged, so
between them the text may be cut and both sides encoded on their own. Cuts are found for a whole Arrow batch at once with a
256 x 256 table; the fragments, mostly single words, are encoded once for each distinct one and the ids put together by
index arithmetic. The tokenizer's pre-splitting pattern must not be disturbed either, so a cut is only taken

* before the first byte of a character,
* not after white space (the pattern looks ahead over runs of white space), and
* not before an apostrophe (the pattern knows contractions).

Everywhere else the pattern splits the two sides just as it splits the whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER_DIR = os.environ.get("FOLIOFORGE_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_50k.json"
#: Distinct fragments that a worker remembers between batches; beyond it starts anew. Only speed depends on it.
REMEMBERED = 400_000


def _byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write every byte as one printable character: itself if printable, else 256 + n."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ForcedBoundaryEncoder:
    """Encodes Arrow string arrays to int32 lists, exactly as the tokenizer itself would."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        byte_of = _byte_of_symbol()
        inside = np.zeros((256, 256), dtype=bool)
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            raw = [byte_of[c] for c in token if c in byte_of]
            if len(raw) == len(token):
                inside[raw[:-1], raw[1:]] = True
        self.may_cut = ~inside
        self.known: dict[str, np.ndarray] = {}

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """Positions in ``raw`` (UTF-8 bytes) before which a cut is certain."""
        if len(raw) < 2:
            return np.zeros(0, dtype=np.int64)
        left, right = raw[:-1], raw[1:]
        ok = self.may_cut[left, right] & ((right & 0xC0) != 0x80) & (right != 0x27) & (left > 0x20) & (left != 0x7F)
        # White space of two or three bytes: no cut behind characters whose leading bytes are those of a white space.
        before = np.concatenate([[0], raw[:-2]]).astype(np.uint8)
        first = np.concatenate([[0, 0], raw[:-3]]).astype(np.uint8)[: len(left)] if len(raw) > 2 else np.zeros(len(left), np.uint8)
        ok &= ~((before == 0xC2) & ((left == 0x85) | (left == 0xA0)))
        pair = first.astype(np.uint16) << 8 | before
        ok &= ~np.isin(pair, np.array([0xE280, 0xE281, 0xE19A, 0xE380], dtype=np.uint16))
        return np.flatnonzero(ok) + 1

    def _ids(self, fragments: list[str]) -> list[np.ndarray]:
        new = [f for f in fragments if f not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = fragments
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            for text, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self.known[text] = np.asarray(e.ids, dtype=np.int32)
        return [self.known[f] for f in fragments]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """One list of ids for each text; null and empty texts give an empty list."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        if texts.null_count:
            texts = texts.fill_null("")
        texts = texts.cast(pa.large_string())
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        ends = offsets - offsets[0]
        if not len(raw):
            return pa.ListArray.from_arrays(pa.array(np.zeros(len(texts) + 1, np.int32)), pa.array([], pa.int32()))
        bounds = np.union1d(self.cuts(raw), ends)
        fragments = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)).dictionary_encode()
        each = self._ids(fragments.dictionary.to_pylist())
        sizes = np.fromiter(map(len, each), np.int64, len(each))
        flat = np.concatenate(each)
        starts = np.cumsum(sizes) - sizes
        codes = fragments.indices.to_numpy()
        counts = sizes[codes]
        done = np.concatenate([[0], np.cumsum(counts)])
        ids = flat[np.repeat(starts[codes] - done[:-1], counts) + np.arange(done[-1])]
        return pa.ListArray.from_arrays(pa.array(done[np.searchsorted(bounds, ends)].astype(np.int32)), pa.array(ids))


_encoders: dict[str, ForcedBoundaryEncoder] = {}


def encoder(path: str) -> ForcedBoundaryEncoder:
    """The worker's encoder for a tokenizer file, built once."""
    if path not in _encoders:
        _encoders[path] = ForcedBoundaryEncoder(path)
    return _encoders[path]


def _prepared(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").alias("__text"))


def encode_corpus(df: DataFrame, *, text: str = "text", keys: list[str] | None = None, out: str = "ids", path: str | None = None) -> DataFrame:
    """``keys`` and the token ids of ``text``; a map-only plan that reads these columns alone.

    Null and empty texts give an empty list; blank texts give the ids of their white space. Repeated rows each give their
    row; other columns are ignored, whatever their names; an empty table gives an empty table.
    """
    keys = keys or ["doc_id"]
    where = path or os.path.join(TOKENIZER_DIR, TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = encoder(where).encode(batch.column(len(keys)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], ids], names=[*keys, out])

    source = _prepared(df, text, keys)
    return source.mapInArrow(run, T.StructType([*source.schema.fields[: len(keys)], T.StructField(out, T.ArrayType(T.IntegerType(), True))]))


def count_tokens(df: DataFrame, *, text: str = "text", keys: list[str] | None = None, out: str = "n_tokens", path: str | None = None) -> DataFrame:
    """``keys`` and the number of tokens of ``text``; null and empty texts have 0."""
    keys = keys or ["doc_id"]
    where = path or os.path.join(TOKENIZER_DIR, TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = encoder(where).encode(batch.column(len(keys))).value_lengths().cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], lengths], names=[*keys, out])

    source = _prepared(df, text, keys)
    return source.mapInArrow(run, T.StructType([*source.schema.fields[: len(keys)], T.StructField(out, T.LongType(), True)]))
