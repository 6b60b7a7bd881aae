"""Statistics of whole texts that the quality rules and the quality classifier share.

Words are maximal runs without the six ASCII space characters. Texts are taken as UTF-8 bytes, slice by slice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from . import arrow_text
from .storage import id_and_text

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
FUNCTION_WORDS = frozenset(
    "the of and to in is was that for with on as are this be it at by from or an a "
    "der die das und ist in den von zu mit für auf ein eine im dem nicht des als auch "
    "le la les de des et en un une est que pour dans qui du sur pas au "
    "el la los las de y en que un una es por con para del se no".split()
)
_FUNCTION_BYTES = frozenset(w.encode() for w in FUNCTION_WORDS)
_DIGITS, _UPPER, _LETTERS = b"0123456789", bytes(range(65, 91)), bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_STOPS = b".,;:!?"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words", "n_function_words", "n_digits", "n_upper", "n_letters", "n_stops", "n_exclaims")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of ``window`` words that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not twice.size:
        return 0
    suspects = np.flatnonzero(np.isin(mixed, twice))
    seen: dict[tuple, int] = {}
    keys = [tuple(words[i : i + window]) for i in suspects.tolist()]  # equal hashes are no proof
    for key in keys:
        seen[key] = seen.get(key, 0) + 1
    cover = np.zeros(len(words) + 1, np.int64)
    starts = suspects[[seen[key] > 1 for key in keys]]
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def counts(data: bytes, characters: int) -> tuple[int, ...]:
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    spaces = len(data) - sum(map(len, words))
    lowered = data.lower().split()
    without = lambda drop: len(data) - len(data.translate(None, drop))
    return (
        len(words), characters - spaces, without(SYMBOLS), len(lines) - len(set(lines)), repeated_words(words), len(lines), len(set(words)),
        sum(map(_FUNCTION_BYTES.__contains__, lowered)), without(_DIGITS), without(_UPPER), without(_LETTERS), without(_STOPS), data.count(b"!"),
    )


def _rows_of(texts: pa.Array) -> list[pa.Array]:
    rows = [counts(t.as_buffer().to_pybytes(), c) for t, c in zip(texts, pc.utf8_length(texts).to_pylist(), strict=True)]
    return [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and a long for each of ``COUNTS``; a row for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches):
            yield pa.record_batch([arrow_text.column(batch, "doc_id"), *_rows_of(arrow_text.column(batch, "text"))], names=["doc_id", *COUNTS])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def beside_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The columns of ``docs`` under the names ``c0``, ``c1``, ... and a long for each of ``COUNTS``."""
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    of = plain.columns[docs.columns.index(text_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow_text.slices(batches, of):
            texts = pc.fill_null(arrow_text.column(batch, of), "")
            yield pa.record_batch([*batch.columns, *_rows_of(texts)], names=[*batch.schema.names, *COUNTS])

    schema = StructType([*plain.schema, *(StructField(c, LongType()) for c in COUNTS)])
    return plain.mapInArrow(run, schema)
