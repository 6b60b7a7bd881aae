"""The corpus pipeline, stage by stage and as a whole, against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import pytest
from tokenizers import Tokenizer
from veilgrid.llm import pii, quality_rules, semi_markov, suffix_dedup

from tests.llm import brute
from tests.llm.test_operators import BYTE

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(8)
    pool = ["".join(r.choice("abcdefghij") for _ in range(r.randint(3, 7))) for _ in range(900)]
    prose = lambda n: " ".join(r.choice(("the", "of", "and", *r.sample(pool, 6))) for _ in range(n))
    texts = [prose(r.randint(60, 200)) for _ in range(40)]
    texts += [f"{w} mail me: a.b{k}@mail.example.com or +1 (437) 555-06{k:02}. {prose(30)}" for k, w in enumerate([prose(40) for _ in range(8)])]
    texts += [texts[3], texts[3], texts[4] + " end"]  # copies
    passage = "".join(r.choice("abcdefghij ") for _ in range(600))
    texts += [f"{prose(120)} {passage} {prose(120)}" for _ in range(4)]
    texts += [" ".join(w + "###" for w in prose(80).split()) for _ in range(6)]  # junk
    texts += ["BUY!! NOW!! " * 40, None, "", "too short"]
    ids = [*range(len(texts) - 2), None, 0]
    return [(i, t, "en", None, len(t) if t is not None else None) for i, t in zip(ids, texts, strict=True)]


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The input of each stage, and the output of the last: as the contract has it, written and read again."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.createDataFrame(corpus(), COLUMNS).repartition(3)
    tables = []
    for k, (_, stage) in enumerate([("input", lambda spark, docs, sf_dir: docs), *corpus_pipeline.STAGES]):
        stage(spark, docs, str(root)).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        tables.append(docs)
    return tables


def rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(written):
    assert all(t.columns == COLUMNS.replace(" long", "").replace(" string", "").split(", ") for t in written[:5])
    assert all(r.n_chars == len(r.text) for t in written[3:5] for r in t.collect())


def test_rules_stage_drops_junk_and_keeps_prose(written):
    before, after = rows(written[0]), rows(written[1])
    assert not after - before
    dropped = before - after
    for (doc_id, text), n in before.items():
        words, _, symbols, _, repeats = brute.rule_counts(text or "")
        bad = words < 20 or 100 * repeats > 30 * words or symbols > 0.3 * words
        assert dropped[(doc_id, text)] == (n if bad else 0), text


def test_near_dedup_stage_keeps_one_of_each(written):
    before, after = rows(written[1]), rows(written[2])
    assert not after - before
    items = sorted(before.elements(), key=str)
    roots = brute.components(list(range(len(items))), lambda a, b: brute.shingle_similarity(items[a][1], items[b][1]) >= 0.8)
    groups = Counter(roots.values())
    kept = Counter()
    left = after.copy()
    for k, item in enumerate(items):
        if left[item]:
            left[item] -= 1
            kept[roots[k]] += 1
    assert set(kept) == set(groups) and set(kept.values()) == {1} and len(groups) < len(items)


def test_suffix_stage_removes_repeats(written):
    items = sorted(rows(written[2]).elements(), key=str)
    spans = brute.removed_repeats([t for _, t in items], corpus_pipeline.PASSAGE)
    after = rows(written[3])
    assert sum(after.values()) == len(items)
    lengths = Counter((i, n - removed) for (i, _), (n, removed, _, _) in zip(items, spans, strict=True))
    assert lengths == Counter((i, len(t.encode())) for i, t in after.elements())  # ASCII: bytes and characters agree
    assert any(removed for _, removed, _, _ in spans)


def test_redaction_stage_replaces_personal_data(written):
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    want = Counter()
    for i, t in rows(written[3]).elements():
        assert set(brute.personal_data(t)) <= set(pii.all_spans(t, field)[1])
        want[(i, pii.redacted(t, pii.all_spans(t, field)[1]))] += 1
    after = rows(written[4])
    assert after == want and not any(brute.personal_data(t) for _, t in after)
    assert any("[EMAIL]" in t and "[PHONE]" in t for _, t in after)


def test_packing_stage_holds_every_token(written):
    library = Tokenizer.from_file(BYTE)
    total = sum(len(library.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows(written[4]).elements())
    pieces = written[5].collect()
    assert sum(p.length for p in pieces) == total
    fill = Counter()
    for p in pieces:
        fill[p.sequence_id] += p.length
    assert max(fill.values()) <= 1024 and len(fill) <= -(-total // 1024) + 1


def test_run_equals_the_stages(spark, written, tmp_path):
    written[0].write.parquet(str(tmp_path / "documents.parquet"))
    tally = lambda df: Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert tally(corpus_pipeline.run(spark, str(tmp_path))) == tally(written[5])


def test_empty_corpus(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert quality_rules.RULES and suffix_dedup.SPAN
