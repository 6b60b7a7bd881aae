"""BPE encoding and decoding of whole texts (contiguous rank array, see :mod:`veilgrid.llm.bpe`).

Defined results: a null text is the empty text and has no tokens; repeated rows give one row each; a null id stays
null; an empty table gives an empty table; columns besides id and text are ignored. Texts of any length are encoded
whole. Ids are those of the tokenizers library without added special tokens; special strings that occur inside a
text become their own ids, as the library does by default.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrow_text
from .bpe import Model, WordCache, kept_in_worker, read_source, worker_model
from .storage import id_and_text


def _id_lists(model: Model):
    def make(words: list[str]) -> list[list[int]]:
        ids, counts = model.encode_words(words)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if words else []

    return make


def encode(cache: WordCache, texts: list[str]) -> list[list[int]]:
    out = []
    for stretches in cache.cut(texts):
        ids: list[int] = []
        for words, special in stretches:
            if special is not None:
                ids.append(special)
            else:
                for part in map(cache.__getitem__, words):
                    ids += part
        out.append(ids)
    return out


def decode(model: Model, ids: list[int]) -> str:
    """As the library decodes a tokenizer without decoder: token strings joined by a space, special ones kept."""
    return " ".join([model.text_of[i] for i in ids])


def encode_column(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string."""
    source = docs.sparkSession.sparkContext.broadcast(read_source(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(source.value)
        cache = WordCache(model, _id_lists(model))
        for batch in arrow_text.slices(batches):
            ids = encode(cache, arrow_text.column(batch, "text").to_pylist())
            yield pa.record_batch(
                [arrow_text.column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([decode(model, x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def _parts(model: Model):
    """Of each word the number of ids, the ids as decimal text, and the decoded text."""
    names = {i: str(i) for i in model.text_of}

    def make(words: list[str]) -> list[tuple[int, str, str]]:
        ids, counts = model.encode_words(words)
        flat, out, at = ids.tolist(), [], 0
        for n in counts.tolist():
            own = flat[at : at + n]
            at += n
            out.append((n, " ".join([names[i] for i in own]), decode(model, own)))
        return out

    return make


def codec_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what :func:`encode_column` returns, made in the same
    worker so that neither ids nor decoded text leave it. A word's part of both digests is remembered with it."""
    source = docs.sparkSession.sparkContext.broadcast(read_source(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(source.value)
        cache = kept_in_worker(("digests", hash(source.value)), lambda: WordCache(model, _parts(model)))
        for batch in arrow_text.slices(batches):
            counts, id_digests, text_digests = [], [], []
            for stretches in cache.cut(arrow_text.column(batch, "text").to_pylist()):
                n, ids, decoded = 0, [], []
                for words, special in stretches:
                    parts = [(1, str(special), words[0])] if special is not None else list(map(cache.__getitem__, words))
                    if parts:
                        each, id_texts, token_texts = zip(*parts, strict=True)
                        n += sum(each)
                        ids += id_texts
                        decoded += token_texts
                counts.append(n)
                id_digests.append(hashlib.sha256(" ".join(ids).encode()).hexdigest())
                text_digests.append(hashlib.sha256(" ".join(decoded).encode()).hexdigest())
            yield pa.record_batch(
                [arrow_text.column(batch, "doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
