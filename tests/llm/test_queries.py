"""The registered queries on a whole table against plain versions."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer
from veilgrid.llm import quality_classifier, queries, storage, text_stats

from tests.llm import brute
from tests.llm.test_operators import BYTE, WORD, by_id


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in storage.read(spark, sf_dir, "documents").collect()}


def run(spark, sf_dir, name, *columns):
    return by_id(queries.queries()[name](spark, sf_dir), *columns)


def test_op1(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op1_suffix_dedup", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert [got[i] for i in texts] == brute.removed_repeats(list(texts.values())) and len(got) == len(texts)
    assert any(removed for _, removed, _, _ in got.values())


def test_op1_tells_repeated_passages_that_it_leaves(spark, sf_dir, texts, tmp_path):
    got = run(spark, sf_dir, "op1_suffix_dedup", "n_repeated")
    assert [got[i][0] for i in texts] == [covered for _, covered, _, _ in brute.removed_repeats(list(texts.values()), queries.PASSAGE)]
    own = ["".join(random.Random(k).choices("abcdefgh ", k=700)) for k in range(5)]
    rows = [(0, own[0] + own[3][:300] + own[1]), (1, own[3][:300] + own[2]), (2, own[4]), (3, None), (3, own[4][:200])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.queries()["op1_suffix_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_removed, r.n_repeated) for r in found) == [(0, 0, 300), (1, 0, 300), (2, 0, 0), (3, 0, 0), (3, 0, 0)]


def test_op2(spark, sf_dir, texts):
    library = Tokenizer.from_file(WORD)
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    want = {i: (len(x), brute.digest(" ".join(map(str, x))), brute.digest(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}
    assert run(spark, sf_dir, "op2_bpe_codec", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op4(spark, sf_dir, texts):
    prints = {i: brute.simhash(t) for i, t in texts.items()}
    roots = brute.components(sorted(texts), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert run(spark, sf_dir, "op4_simhash", "fingerprint", "component_id") == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


def test_op5(spark, sf_dir, texts):
    library = Tokenizer.from_file(BYTE)
    n = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert run(spark, sf_dir, "op5_token_counts", "n_bytes", "n_tokens", "over_limit") == {i: (len(t.encode()), n[i], n[i] > 512) for i, t in texts.items()}


def test_op7_equals_a_plain_discriminant(spark, sf_dir, texts):
    docs = storage.read(spark, sf_dir, "documents")
    rows = text_stats.text_stats(docs).select("doc_id", *quality_classifier.features()).collect()
    x = {r.doc_id: np.array(r[1:], float) for r in rows}
    quality = {r.doc_id: r.quality for r in storage.read(spark, sf_dir, "labels").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in x}
    train = {k: np.array([x[i] for i in x if quality.get(i) == k and not held[i]]) for k in (0, 1)}
    n = sum(map(len, train.values()))
    covariance = {k: np.cov(v.T, bias=True) for k, v in train.items()}
    pooled = sum(len(v) * covariance[k] for k, v in train.items()) / n
    scale = np.sqrt(np.diag(pooled))
    density = {}
    for k, v in train.items():
        own = (0.8 * covariance[k] + 0.2 * pooled) / np.outer(scale, scale)
        own = 0.95 * own + 0.05 * np.eye(len(scale)) * np.trace(own) / len(scale)
        for i in x:
            away = (x[i] - v.mean(axis=0)) / scale
            density[i, k] = np.log(len(v) / n) - 0.5 * away @ np.linalg.solve(own, away) - 0.5 * np.linalg.slogdet(own)[1]
    got = run(spark, sf_dir, "op7_quality_classifier", "held_out", "score", "predicted")
    for i in x:
        score = 1 / (1 + np.exp(-(density[i, 1] - density[i, 0]) / len(scale)))
        assert got[i][0] == held[i] and got[i][1] == pytest.approx(score, abs=1e-6) and got[i][2] == int(got[i][1] >= 0.5)
    assert len(got) == len(texts)


def test_op8(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op8_quality_rules", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, t in texts.items():
        words, _, _, _, repeats = counts = brute.rule_counts(t)
        assert got[i][:5] == counts and got[i][5] == (words < 20 or 100 * repeats > 30 * words) and not (got[i][5] and got[i][6])


def test_op9(spark, sf_dir, texts):
    library = Tokenizer.from_file(BYTE)
    rows = queries.queries()["op9_best_fit_packing"](spark, sf_dir).collect()
    by_doc, places = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    lengths = []
    for i, t in texts.items():
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids), 1024), len(ids)]
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces] == [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
        lengths += [r.length for r in pieces]
    for held in places.values():
        ends = np.cumsum([n for _, n in sorted(held)])
        assert [a for a, _ in sorted(held)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(places) <= -(-sum(lengths) // 1024) + 2 and Counter(lengths).total() == len(rows)


def test_op10(spark, sf_dir, texts):
    got = run(spark, sf_dir, "op10_pii", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, t in texts.items():
        base = brute.personal_data(t)
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert got[i][:5] == (*(sum(k == s[0] for s in base) for k in ("email", "ip", "card", "phone")), brute.digest(",".join(listed)))
        assert set(listed) <= set(got[i][5].split(",")) or not listed
