"""The corpus pipeline: rules, near-dedup, suffix dedup, redaction, packing, each over all that the one before it kept.

Stages take and return the columns of ``documents``; the last returns the packed pieces. Rules, redaction and packing pass
the rows through their workers and join nothing; near-dedup knows a row by its file and number, suffix dedup by its id and
text, so no stage depends on how files are split into tasks. A null text is the empty text from the first stage that
changes texts on.
"""

from __future__ import annotations

import functools
import threading

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from veilgrid.llm import near_copies, packing, pii, quality_rules, storage, suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Passages of over 50 words are to go: 50 words of four letters and a space are 250 bytes.
PASSAGE = 250


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs.select(*COLUMNS))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each(docs, words_each=5, similarity=0.8).select(*COLUMNS)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(docs.select(*COLUMNS), PASSAGE, length_col="n_chars")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs.select(*COLUMNS), length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: Stage tables that a stage's result still reads, by the run they belong to: its session, input and thread.
_LEFT: dict[tuple, list[str]] = {}


def _stage(function):
    """A stage that first deletes what the stage before it, in the same run, kept for its result: that is written by now."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        run_of = (id(spark), sf_dir, threading.get_ident())
        storage.delete(_LEFT.pop(run_of, []), keep=docs)
        with storage.recorded() as made:
            out = function(spark, docs, sf_dir)
        if function is not pack:  # nothing follows it, so its result keeps its tables
            _LEFT[run_of] = made
        return out

    return run_stage


STAGES = [("quality rules", keep_quality), ("near-dedup", one_of_each), ("suffix dedup", drop_repeats), ("personal data", redact), ("packing", pack)]
STAGES = [(name, _stage(function)) for name, function in STAGES]

#: Components, expectation-maximisation, trained fields and best-fit packing have no SQL; a brute-force version checks them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = storage.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        written = storage.stage_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if held is not None:
            storage.discard(held)
        docs = held = written
    return STAGES[-1][1](spark, docs, sf_dir)
