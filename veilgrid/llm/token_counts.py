"""Token counts by the whole-token shortcut.

Most pre-tokens of a text are vocabulary entries. Being an entry is no proof that a string encodes as that one token:
its merges may never meet. :func:`proven_whole` encodes every vocabulary string once, on the driver, and keeps those
that end as one token; a pre-token among them counts one without any merge, and only the rest is merged.

Defined results: a null text is the empty text (0 bytes, 0 tokens); repeated rows give one row each; a null id stays
null; an empty table gives an empty table; other columns are ignored. Whole texts are counted, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from . import arrow_text
from .bpe import ALPHABET, Model, WordCache, kept_in_worker, read_source, worker_model
from .storage import id_and_text

_PROVEN: dict[str, frozenset[int]] = {}


def proven_whole(path: str) -> frozenset[int]:
    """Ids of the vocabulary strings that encode, alone, as themselves. Found once for each file and driver."""
    if path not in _PROVEN:
        model = worker_model(read_source(path))
        cut = len(model.suffix)
        strings = [w for w in model.vocab if not cut or w.endswith(model.suffix)]
        ids, counts = model.encode_words([f"\0{w[: len(w) - cut]}" for w in strings])
        first = ids[np.cumsum(counts) - counts] if strings else ids
        _PROVEN[path] = frozenset(i for i, n, got in zip((model.vocab[w] for w in strings), counts.tolist(), first.tolist(), strict=True) if n == 1 and got == i)
    return _PROVEN[path]


def _counts(model: Model, whole: frozenset[int]):
    cut = len(model.suffix)
    alone = {w[: len(w) - cut] for w, i in model.vocab.items() if i in whole}
    table = str.maketrans({chr(b): c for b, c in enumerate(ALPHABET)})
    spelled = lambda w: w[1:] if w[:1] == "\0" else w.translate(table) if w.isascii() else model.raw(w).decode("latin-1").translate(table)

    def make(words: list[str]) -> list[int]:
        merged = [w for w in words if spelled(w) not in alone]
        counts = dict(zip(merged, model.encode_words(merged)[1].tolist(), strict=True))
        return [counts.get(w, 1) for w in words]

    return make


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``)."""
    known = docs.sparkSession.sparkContext.broadcast((read_source(vocabulary), proven_whole(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, whole = known.value
        model = worker_model(source)
        cache = kept_in_worker(("counts", hash(source)), lambda: WordCache(model, _counts(model, whole)))
        for batch in arrow_text.slices(batches):
            texts = arrow_text.column(batch, "text")
            cut = cache.cut(texts.to_pylist())
            counts = pa.array([sum(1 if special is not None else sum(map(cache.__getitem__, words)) for words, special in stretches) for stretches in cut], pa.int64())
            yield pa.record_batch([arrow_text.column(batch, "doc_id"), pc.binary_length(texts).cast(pa.int64()), counts, pc.greater(counts, limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
