"""Every operator against a plain version, over texts that are null, empty, long, repeated and odd."""

from __future__ import annotations

import hashlib
import json
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from veilgrid.llm import bpe, bpe_codec, chat, near_copies, packing, pii, quality_classifier, quality_rules, queries, semi_markov, simhash, storage, suffix_dedup, text_stats, token_counts, topk

from tests.conftest import rows_of
from tests.llm import brute

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n", "a", "Hello, WORLD's  end<|endoftext|> it'll\n\n don't", "<|startoftext|><|endoftext|>", "été naïve ΑΣ ΣΑΣ İstanbul ﬁ 日本語 🙂 é", "a\x1cb\x1f c\x85d\xa0e f　g", "x" * 3000, "ab" * 700,
    "word " * 900, " leading", "trailing ", "tabs\tand  double  spaces \n mixed", "12345 ٣٤ ½ ² Ⅷ", "'s't're 'S", "\0nul \0byte", "same text", "same text",
]


def table(spark, texts, ids=None):
    """documents with columns whose names operators use inside."""
    rows = [(i if ids is None else ids[i], t, "row", "bits", i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, bits string, spans long").repartition(3)


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def no_rows(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# --- encoding --------------------------------------------------------------------------------------------------------
def test_codec_equals_the_library(spark):
    library = Tokenizer.from_file(WORD)
    got = by_id(bpe_codec.codec_digests(table(spark, ODD), WORD), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in enumerate(ODD):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i] == (len(ids), brute.digest(" ".join(map(str, ids))), brute.digest(library.decode(ids, skip_special_tokens=False))), t
    assert bpe_codec.codec_digests(no_rows(spark), WORD).count() == 0


def test_codec_columns_hold_ids_and_text(spark):
    library = Tokenizer.from_file(BYTE)
    for r in bpe_codec.encode_column(table(spark, ODD), BYTE).collect():
        assert r.ids == library.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(BYTE)
    got = by_id(token_counts.token_counts(table(spark, ODD), BYTE, limit=5), "n_bytes", "n_tokens", "over_limit")
    for i, t in enumerate(ODD):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 5), t


def test_whole_tokens_are_proven():
    library = Tokenizer.from_file(BYTE)
    whole = token_counts.proven_whole(BYTE)
    model = bpe.Model(bpe.read_source(BYTE))
    for i in random.Random(1).sample(sorted(whole), 300):
        assert model.encode_words([f"\0{model.text_of[i]}"])[0].tolist() == [i]
    assert library.get_vocab_size() - 1 >= len(whole) > 40_000


_MODEL = bpe.Model(bpe.read_source(BYTE))
_LIBRARY = Tokenizer.from_file(BYTE)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_three_ways_to_merge_agree(text):
    for word in _MODEL.pretokens(text):
        parts = [bpe.ALPHABET[b] for b in _MODEL.raw(word)]
        by_array = bpe.merge_by_rank_array(parts, _MODEL.ranks)
        assert by_array == bpe.merge_by_heap(parts, _MODEL.ranks)
        assert [_MODEL.vocab[p] for p in by_array] == _MODEL.encode_word(word)
    assert [i for w in _MODEL.pretokens(text) for i in _MODEL.encode_word(w)] == _LIBRARY.encode(text, add_special_tokens=False).ids or "<|endoftext|>" in text


def test_memory_is_bounded_in_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "BYTE_LIMIT", 2000)
    cache = bpe.WordCache(_MODEL, bpe_codec._id_lists(_MODEL))
    for k in range(6):
        text = f"{k}" + "xyz"[k % 3] * 40_000 + " short " + " ".join(f"word{j}" for j in range(60 * k, 60 * k + 60))
        assert bpe_codec.encode(cache, [text]) == [_LIBRARY.encode(text).ids]
        assert sum(map(len, cache)) - sum(map(len, cache.passing)) == cache.bytes <= 2000
    bpe_codec.encode(cache, ["a"])
    assert max(map(len, cache)) <= bpe.LONG_WORD


def test_unknown_settings_are_left_to_the_library_or_refused():
    spec = json.loads(bpe.read_source(BYTE))
    spec["normalizer"] = {"type": "Lowercase"}
    source = json.dumps(spec)
    model, library = bpe.Model(source), Tokenizer.from_str(source)
    assert model.pattern is None
    for text in ("Hello WORLD don't", "ÉTÉ  a"):
        assert [i for w in model.pretokens(text) for i in model.encode_word(w)] == library.encode(text, add_special_tokens=False).ids
    for key, value in (("byte_fallback", True), ("dropout", 0.1), ("type", "Unigram")):
        with pytest.raises(ValueError):
            bpe.Model(json.dumps({**spec, "model": {**spec["model"], key: value}}))


def test_a_full_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_LIMIT", 5)
    cache = bpe.WordCache(_MODEL, bpe_codec._id_lists(_MODEL))
    for text in ("one two three four", "five six seven eight nine ten", "one two"):
        assert bpe_codec.encode(cache, [text]) == [_LIBRARY.encode(text).ids]


# --- packing ---------------------------------------------------------------------------------------------------------
def test_packing_is_whole_and_tight(spark):
    r = random.Random(2)
    texts = [*ODD, *(" ".join(r.choice(("alpha", "be", "gamma")) for _ in range(r.randint(0, 120))) for _ in range(200))]
    rows = packing.best_fit_packing(table(spark, texts), BYTE, capacity=64, end_id=2).collect()
    of_doc, of_sequence = defaultdict(list), defaultdict(list)
    for x in rows:
        of_doc[x.doc_id].append(x)
        of_sequence[x.sequence_id].append((x.offset, x.length))
    total = 0
    for i, t in enumerate(texts):
        ids = [*_LIBRARY.encode(t or "", add_special_tokens=False).ids, 2]
        pieces = sorted(of_doc[i], key=lambda x: x.piece)
        assert [x.piece for x in pieces] == list(range(-(-len(ids) // 64)))
        assert all(x.length == 64 for x in pieces[1:]) and sum(x.length for x in pieces) == len(ids)
        at = 0
        for x in pieces:
            assert (x.start, x.ids_crc32) == (at, zlib.crc32(np.array(ids[at : at + x.length], "<u4").tobytes()))
            at += x.length
        total += len(ids)
    for members in of_sequence.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 64
    assert len(of_sequence) <= 1.05 * -(-total // 64) + 1
    assert packing.best_fit_packing(no_rows(spark), BYTE).count() == 0


def test_few_bins_rise_and_no_sequence_is_lost(spark, monkeypatch):
    """Against a tree whose nodes hand up every bin that is not nearly full."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    r = random.Random(6)
    rows = [(k, 0, 0, r.choice((90, 80, 70, 60, 55, 40, 25, 12)), 0) for k in range(900)]
    pieces = storage.stage_table(spark.createDataFrame(rows, schema).repartition(30), "pieces")
    monkeypatch.setattr(packing, "PIECES", 30)
    real, risen = packing._pack_round, []

    def count(hand_up):
        def round_(level, capacity, nearly_full, hosts):
            risen.append(hosts)
            return real(level, capacity, nearly_full, hosts and hand_up(hosts))

        monkeypatch.setattr(packing, "_pack_round", round_)
        packed = packing.pack(pieces, 100).collect()
        assert sorted(x.doc_id for x in packed) == list(range(900))
        return len({x.sequence_id for x in packed})

    few, every = count(lambda n: n), count(lambda n: 10**6)
    assert few <= every and risen[:3] == [16, 8, 0]


@given(st.lists(st.integers(1, 50), max_size=60))
@settings(max_examples=60, deadline=None)
def test_best_fit_fills_bins(lengths):
    bins = packing.best_fit(lengths, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    fill = sorted(sum(lengths[i] for i in b) for b in bins)
    assert all(f <= 50 for f in fill) and (len(fill) < 2 or fill[0] + fill[1] > 50)


# --- repeats ---------------------------------------------------------------------------------------------------------
def _passages(seed):
    r = random.Random(seed)
    text = lambda n: "".join(r.choice("abcdefghij é") for _ in range(n))
    common, rim, base = text(700), text(430), text(1500)
    docs = [text(r.randint(0, 300)) + common + text(r.randint(0, 900)) for _ in range(25)] + [text(r.randint(0, 30)) + rim + text(r.randint(0, 30)) for _ in range(20)]
    for _ in range(20):
        copy = list(base)
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = r.choice("xyz")
        docs.append("".join(copy))
    return [*docs, "a" * 3000, "ab" * 900, "line of text\n" * 300, "a" * 401, "", "x" * 400, "x" * 400, text(399), None, "é" * 500, text(5000)]


@pytest.mark.parametrize(("sorted_from", "hot", "length"), [(2, 512, 400), (1, 10**9, 400), (2, 3, 400), (1, 2, 250)])
def test_repeats_equal_brute_force(spark, monkeypatch, sorted_from, hot, length):
    """As shipped, through the sort alone, through recursion, and through both with another length."""
    monkeypatch.setattr(suffix_dedup, "SORTED_FROM", sorted_from)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", hot)
    texts = _passages(hot % 1000)
    got = by_id(suffix_dedup.removal_digests(table(spark, texts), length), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert [got[i] for i in range(len(texts))] == brute.removed_repeats([t or "" for t in texts], length)


def test_repeats_of_a_whole_table_through_the_sort_alone(spark, monkeypatch, sf_dir):
    monkeypatch.setattr(suffix_dedup, "SORTED_FROM", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 10**9)
    docs = storage.read(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = by_id(suffix_dedup.removal_digests(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert [got[i] for i in texts] == brute.removed_repeats(list(texts.values()))


def test_repeats_across_blocks_and_runs_on_disk(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 100)
    monkeypatch.setattr(suffix_dedup, "INDUCED_AT_ONCE", 2)
    texts = _passages(9)[20:60]
    rows = suffix_dedup.keyed(table(spark, texts))
    data = [np.frombuffer((t or "").encode(), np.uint8) for t in texts]
    for d in data:  # every position is assigned to one sample at a distance below the span
        if d.size >= 400:
            parts = list(suffix_dedup.samples(d, 400))
            p, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
            assert first[0] == 0 and last[-1] == d.size - 400 and (first[1:] == last[:-1] + 1).all()
            assert (p >= last).all() and (p - first < suffix_dedup.SPAN).all()
    assert rows.count() == len(texts)


@pytest.mark.parametrize("limit", [2000, 10**9])
def test_suffix_queue_sorts_and_carries_common_prefixes(limit):
    queue = suffix_dedup.SuffixQueue(limit)
    r = random.Random(4)
    keys = [bytes(r.choices(b"ab", k=r.randint(0, 12))) * r.randint(1, 20) for _ in range(500)]
    for k, key in enumerate(keys):
        queue.push(key, (k,))
    assert len(queue.runs) > 3 or limit > 2000
    out = list(queue.drain())
    assert [(x, p) for x, _, p in out] == sorted((key, (k,)) for k, key in enumerate(keys))
    for (one, _, _), (two, common, _) in zip(out, out[1:], strict=False):
        assert common == next((i for i, (x, y) in enumerate(zip(one, two, strict=False)) if x != y), min(len(one), len(two)))


def test_kept_text_is_whole_characters(spark):
    texts = ["é" * 300, "x" + "é" * 300, "è" * 100 + "é" * 210]
    kept = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(table(spark, texts), length_col="spans").collect()}
    assert all(set(k) <= set(t) for k, t in ((kept[i], texts[i]) for i in range(3)))
    assert suffix_dedup.removal_digests(no_rows(spark)).count() == 0


def test_repeated_ids_are_separate_documents(spark):
    unlike = "".join(map(str, range(300)))
    df = table(spark, ["q" * 450, "q" * 450, unlike, unlike[:600] + "x" * 20, unlike[:600] + "x" * 20], ids=[7, 7, None, None, None])
    assert sorted((r.doc_id or -1, r.n_removed) for r in suffix_dedup.removal_digests(df).collect()) == [(-1, 600), (-1, 620), (-1, 620), (7, 450), (7, 450)]


# --- near copies -----------------------------------------------------------------------------------------------------
def _near(seed=3):
    r = random.Random(seed)
    pool = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(400)]
    out = [None, "", "  \n", "one", "one two", "ONE  two", "a b c d", "a b c d"]
    for _ in range(12):
        base = [r.choice(pool) for _ in range(r.randint(60, 300))]
        out.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(r.randint(1, 2)):
                copy[r.randrange(len(copy))] = r.choice(pool)
            out.append("\t".join(copy).upper() if r.random() < 0.3 else " ".join(copy))
    return out


def test_simhash_equals_brute_force(spark):
    texts = _near()
    got = by_id(simhash.near_duplicates(table(spark, texts)), "fingerprint", "component_id")
    prints = [brute.simhash(t or "") for t in texts]
    roots = brute.components(list(range(len(texts))), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in enumerate(prints)}


def test_near_copies_link_by_similarity(spark):
    texts = [t for t in _near(5) if t and len(t.split()) > 4]
    got = by_id(near_copies.near_copies(table(spark, texts)), "component_id")
    roots = brute.components(list(range(len(texts))), lambda a, b: brute.shingle_similarity(texts[a], texts[b]) >= 0.8)
    together = lambda m: {(a, b) for a in m for b in m if a < b and m[a] == m[b]}
    mine, all_ = together(got), together({i: (r,) for i, r in roots.items()})
    assert mine == all_ and len(all_) > 10


def _linked(spark, texts):
    """component_id of near_copies and of plain comparison of all pairs."""
    got = by_id(near_copies.near_copies(table(spark, texts)), "component_id")
    roots = brute.components(list(range(len(texts))), lambda a, b: brute.shingle_similarity(texts[a], texts[b]) >= 0.8)
    return got, {i: (r,) for i, r in roots.items()}


def test_near_copies_lose_no_link(spark):
    r = random.Random(17)
    words = lambda n, of="w": [f"{of}{r.randrange(10**6)}" for _ in range(n)]
    shared, template = words(200), []
    for _ in range(40):  # texts of one template, whose copies do not sort next to each other
        own = words(40)
        template += [" ".join(shared + own + words(k)) for k in (0, 8)]
    r.shuffle(template)
    repeated = []
    for _ in range(10):  # a repeated passage counts once
        base, passage = words(104, "v"), words(8, "v")
        repeated += [" ".join(base), " ".join(base + 5 * passage)]
    at_the_threshold = []
    for _ in range(60):  # 110 of 130 shingles in common
        base = words(124, "u")
        at_the_threshold += [" ".join(base), " ".join(base[:40] + words(1, "u") + base[41:80] + words(1, "u") + base[81:])]
    alike = ["again " * 300 + " ".join(words(40, "t")) for _ in range(4)]  # equal fingerprints of the list, unlike sets
    assert len({brute.simhash(t) for t in alike}) == 1
    got, want = _linked(spark, [*template, *repeated, *at_the_threshold, *alike])
    assert got == want
    groups = [len({want[k] for k in range(a, b)}) for a, b in ((0, 80), (80, 100), (100, 220), (220, 224))]
    assert 1 < groups[0] < 80 and groups[1:] == [10, 60, 4]


def test_near_copies_of_null_and_repeated_ids(spark):
    texts = [t for t in _near(7) if t and len(t.split()) > 4][:20]
    rows = [*texts, None, "", "", texts[0], texts[1] + " more", "aaa", "bbb"]
    ids = [*(k // 2 for k in range(20)), 50, 51, None, None, 60, 60, 60]
    got = [(r.doc_id, r.component_id) for r in near_copies.near_copies(table(spark, rows, ids)).collect()]
    roots = brute.components(list(range(len(rows))), lambda a, b: brute.shingle_similarity(rows[a] or "", rows[b] or "") >= 0.8 or not (rows[a] or rows[b]))
    least = {}
    for k, r in roots.items():
        least[r] = min((i for i in (least.get(r), ids[k]) if i is not None), default=None)
    assert sorted(got, key=str) == sorted(((ids[k], least[r]) for k, r in roots.items()), key=str)
    kept = near_copies.one_of_each(table(spark, rows, ids))
    assert kept.columns == ["doc_id", "text", "row", "bits", "spans"]
    want = {}
    for k, r in roots.items():
        want[r] = min(want.get(r, k), k, key=lambda k: (ids[k] is None, ids[k] or 0))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(ids[k]) for k in want.values())
    assert near_copies.near_copies(no_rows(spark)).count() == near_copies.one_of_each(no_rows(spark)).count() == 0


def test_near_copies_meet_in_several_orders(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "PAIRS_EACH", 0)
    r = random.Random(37)
    words = lambda n: [f"s{r.randrange(10**6)}" for _ in range(n)]
    base, texts = words(150), []
    for _ in range(40):  # copies of one text that are often less alike than 0.8 to each other
        own = list(base)
        for k in r.sample(range(150), 3):
            own[k] = words(1)[0]
        texts.append(" ".join(own))
    got, want = _linked(spark, texts)
    assert got == want


def _rows_of_joins(plan) -> int:
    """The most rows that a join of an executed plan made."""
    name, inner = plan.nodeName(), plan.children()
    below = [inner.apply(k) for k in range(inner.size())]
    if name.startswith("AdaptiveSparkPlan"):
        below.append(plan.executedPlan())
    elif "QueryStage" in name:
        below.append(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name and plan.metrics().contains("numOutputRows") else 0
    return max([own, *map(_rows_of_joins, below)])


def test_near_copies_of_a_large_group_are_not_all_paired(spark, monkeypatch):
    r = random.Random(41)
    words = lambda n: [f"g{r.randrange(10**6)}" for _ in range(n)]
    base, texts = words(150), []
    for k in range(240):  # a large group of copies, and as many texts too far from it
        own = list(base)
        for at in r.sample(range(150), 1 + k % 2 * r.randint(5, 12)):
            own[at] = words(1)[0]
        texts.append(" ".join(own))
    for _ in range(20):  # 100 of 125 shingles in common: just alike, by the larger set
        longer = words(129)
        texts += [" ".join(longer[:104]), " ".join(longer)]
    made, every_pair = [], near_copies._every_pair

    def measured(*args):
        pairs = every_pair(*args)
        pairs.collect()
        made.append(_rows_of_joins(pairs._jdf.queryExecution().executedPlan()))
        return pairs

    monkeypatch.setattr(near_copies, "_every_pair", measured)
    got, want = _linked(spark, texts)
    assert got == want and len({want[k] for k in range(240, 280)}) == 20
    groups = Counter(want[k] for k in range(240))
    assert max(groups.values()) > 100 and len(groups) > 60
    assert made and made[0] < 5 * len(texts), made


def test_rows_have_one_place_however_they_are_split(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(k, f"text {k} " * 50) for k in range(4000)], "doc_id long, text string").repartition(6).write.parquet(path)

    def place():
        docs = spark.read.parquet(path)
        return {r.doc_id: (r.file, r.at) for r in docs.select("doc_id", *storage.place_of(docs)).collect()}

    before = place()
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "2")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        assert place() == before and len(set(before.values())) == 4000
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    docs = spark.read.parquet(path)
    assert storage.as_scan(docs) is docs and storage.as_scan(docs.filter("doc_id > 3")) is not docs


def test_a_cluster_needs_a_shared_folder(spark):
    class Fake:
        conf = sparkContext = None

    fake, context = Fake(), Fake()
    context.master, context.getConf = "spark://host:7077", lambda: {}
    fake.conf, fake.sparkContext = {}, context
    with pytest.raises(RuntimeError):
        storage.shared_root(fake)


def test_chains_and_ties_form_one_component(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 102)], "a long, b long").repartition(5)
    got = {r.a: r.b for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}


def test_null_ids_and_empty_tables(spark):
    got = simhash.near_duplicates(table(spark, ["", "", "x y z"], ids=[None, 5, None])).collect()
    assert sorted((r.fingerprint, str(r.doc_id), str(r.component_id)) for r in got)[:2] == [("0" * 16, "5", "5"), ("0" * 16, "None", "5")]
    assert simhash.near_duplicates(no_rows(spark)).count() == 0
    with pytest.raises(ValueError):
        simhash.links(no_rows(spark), 3)


# --- conversations ---------------------------------------------------------------------------------------------------
TURNS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a\\sb \\\\ ### x: </turn>\n"), (2, 1, "assistant", "first"), (2, 0, "system", None), (2, 2, "user", ""),
    (3, 0, None, "no role"), (3, None, "user", "no turn"), (None, 0, "user", "no id"), (4, 0, "user", "same"), (4, 0, "user", "same"), (5, 0, "we: <ird> #role\n", "t"), (5, 1, "assistant", "### User: \\h\\l"),
]


def test_chat_round_trip(spark):
    rows = spark.createDataFrame([(*t, "x") for t in TURNS], "conv_id long, turn long, role string, text string, turns string")
    formatted = chat.format_conversations(rows)
    back = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    told = {r.conv_id: r for r in chat.digests(formatted).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted(((t[1] is not None, t[1] or 0), t[2] or "", t[3] or "") for t in TURNS if t[0] == conv)
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, x) for _, r, x in own]
        trained = [x for _, r, x in own if r == "assistant"]
        assert back[conv].trained == trained
        assert told[conv].loss_sha256 == brute.digest("".join(trained)) and told[conv].n_turns == len(own)
        assert told[conv].turns_sha256 == brute.digest("".join(f"{r}\n{x}\n" for _, r, x in own))
        assert told[conv].formatted_chars == len(back[conv].formatted)
    assert {c: r.valid for c, r in told.items()} == {1: True, 2: False, 3: False, None: True, 4: False, 5: False}
    for r in formatted.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
    assert chat.digests(chat.format_conversations(rows.limit(0))).count() == 0


@pytest.mark.parametrize("template", [chat.Template("<|im_start|>", "\n", "<|im_end|>\n"), chat.Template("[INST] ", ": ", "|(.*)|"), chat.Template("#", ":", "\n\n", trained=("user",), escape_character="\x1e")])
def test_other_templates_are_read_back(spark, template):
    hostile = "<|im_start|>user\nhi<|im_end|>\n [INST] |(.*)| |x| \\s \\ \x1en # : \n\n"
    turns = [(1, 0, "user", hostile), (1, 1, "assistant", hostile[::-1]), (1, 2, "us: <|\n", "\n"), (2, 0, "user", "")]
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_conversations(rows, template), template).collect()}
    for conv in (1, 2):
        assert [(t.role, t.text) for t in back[conv].turns] == [(r, x) for c, _, r, x in turns if c == conv]
        assert back[conv].trained == [x for c, _, r, x in turns if c == conv and r in template.trained]


@pytest.mark.parametrize("controls", [("", ": ", "</turn>"), ("### ", ": ", "x"), ("<<end>", ": ", "<end>"), ("### ", ":<", "</turn>"), ("# \\", ": ", "<")])
def test_templates_that_cannot_be_read_back_are_refused(controls):
    with pytest.raises(ValueError):
        chat.Template(*controls)


def test_queries_equal_their_sql(spark, sf_dir, duck):
    for name, sql in queries.oracle_sql().items():
        assert rows_of(queries.queries()[name](spark, sf_dir).toPandas()) == rows_of(duck.sql(sql).df()), name


# --- top k -----------------------------------------------------------------------------------------------------------
def _top_k(vectors, every, k=5):
    ints = {i: np.floor(256 * np.array(v, float)).astype(int) for i, v in vectors.items()}
    out = set()
    for q in ints:
        if q % every == 0:
            scored = sorted((-int(ints[q] @ ints[p]), p) for p in ints if p != q)
            out |= {(q, k_ + 1, p, -s) for k_, (s, p) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_top_k_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BUCKET", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    r = np.random.default_rng(1)
    centers = r.normal(size=(6, 8))
    vectors = {i: (centers[i % 6] + spread * r.normal(size=8)) * r.uniform(0.2, 3) for i in range(400)}
    vectors |= {400: np.zeros(8), 401: -vectors[0], **{i: vectors[7] for i in range(402, 410)}}
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in vectors.items()]
    bad = [(1000, None, 0), (1010, [], 0), (1020, [1.0, None], 0), (1030, [float("nan")] * 8, 0), (1040, [float("inf")] * 8, 0), (None, [1.0] * 8, 0)]
    df = spark.createDataFrame(rows + bad + rows[:3], "vec_id long, embedding array<float>, slot int")
    got = {tuple(x) for x in topk.top_k(df, k=5, every=10).collect()}
    assert got == _top_k({i: v for i, v, _ in rows}, 10)


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    got = topk.top_k(spark.createDataFrame([(0, [-1.0, 0.5]), (50, [1.0]), (51, [0.0, 0.0])], schema)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 51, 0), (0, 2, 50, -65536), (50, 1, 51, 0), (50, 2, 0, -65536)]


# --- quality ---------------------------------------------------------------------------------------------------------
RULE_TEXTS = [*ODD, "a b c d e f g h " * 9, "x\ny\nx\n \n \nx \n", "one two three four five six seven eight nine ten one two three four five six seven eight", "#*$%&|<> " * 30]


def test_rule_counts_equal_brute_force(spark):
    got = by_id(quality_rules.quality_rules(table(spark, RULE_TEXTS)), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for i, t in enumerate(RULE_TEXTS):
        counts = brute.rule_counts(t or "")
        assert got[i][:5] == counts, t
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        assert got[i][5] == failed and not (failed and got[i][6])
    assert quality_rules.quality_rules(no_rows(spark)).count() == 0


def test_hash_collisions_are_no_repeats(monkeypatch):
    monkeypatch.setattr(text_stats, "hash", lambda w: 1, raising=False)
    assert text_stats.repeated_words([str(k).encode() for k in range(30)]) == 0


def test_label_model_separates_planted_votes():
    r = np.random.default_rng(0)
    good = r.random(4000) < 0.85
    votes = np.where(good[:, None], r.choice([0, 1], (4000, 5)), np.where(r.random((4000, 5)) < 0.5, -1, 0))
    patterns, weight = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.LabelModel.fit(patterns, weight.astype(float))
    told = votes.any(axis=1)
    assert ((model.posterior(votes) >= 0.5) == good)[told].mean() > 0.97


def _plain_em(votes, rounds=500):
    """Posterior of each document by the textbook, a document at a time."""
    k = len(votes[0])
    belief = [1 / (1 + math.exp(-sum(v))) for v in votes]
    for _ in range(rounds):
        share = (sum(belief) + quality_rules.PRIOR_GOOD[0]) / (len(votes) + sum(quality_rules.PRIOR_GOOD))
        mass = [[list(quality_rules.PRIOR[c]) for _ in range(k)] for c in (0, 1)]
        for v, b in zip(votes, belief, strict=True):
            for r in range(k):
                mass[1][r][v[r] + 1] += b
                mass[0][r][v[r] + 1] += 1 - b
        after = []
        for v in votes:
            odds = math.log(share / (1 - share))
            for r in range(k):
                odds += math.log(mass[1][r][v[r] + 1] / sum(mass[1][r])) - math.log(mass[0][r][v[r] + 1] / sum(mass[0][r]))
            after.append(1 / (1 + math.exp(-odds)))
        settled = max(abs(x - y) for x, y in zip(after, belief, strict=True)) < 1e-9
        belief = after
        if settled:
            break
    return belief


def test_rules_decide_as_plain_expectation_maximisation_does(spark, sf_dir):
    docs = storage.read(spark, sf_dir, "documents")
    stats = text_stats.text_stats(docs).select("doc_id", *quality_rules.votes()).collect()
    votes = [tuple(r[f"vote_{x}"] for x in quality_rules.RULES) for r in stats]
    want = dict(zip((r.doc_id for r in stats), _plain_em(votes), strict=True))
    rows = quality_rules.quality_rules(docs).collect()
    assert len(rows) == len(want) == len({r.doc_id for r in rows})
    assert all(r.posterior == pytest.approx(want[r.doc_id], abs=1e-6) and r.kept == (not r.base_failed and r.posterior >= 0.5) for r in rows)
    against = {r.doc_id: -1 in v for r, v in zip(stats, votes, strict=True)}
    assert any(r.kept and against[r.doc_id] for r in rows)  # no vote decides by itself


def test_classifier_on_held_out_rows(spark, sf_dir):
    docs, labels = (storage.read(spark, sf_dir, t) for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality_classifier.score_quality(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([p == q for p, q in held]) >= 0.85
    assert len(rows) == docs.count()


def test_classifier_ignores_held_out_labels(spark, sf_dir):
    docs, labels = (storage.read(spark, sf_dir, t) for t in ("documents", "labels"))
    turned = labels.withColumn("quality", (quality_classifier.fold() == 1).cast("int") * (1 - labels.quality) + (quality_classifier.fold() != 1).cast("int") * labels.quality)
    one, two = (by_id(quality_classifier.score_quality(docs, x), "score") for x in (labels, turned))
    assert all(one[i][0] == pytest.approx(two[i][0], abs=1e-9) for i in one)


def test_classifier_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.score_quality(table(spark, ODD), empty).collect()} == {0.5}
    one_class = spark.createDataFrame([(0, 1), (2, 1), (3, None)], "doc_id long, quality int")
    assert {r.score for r in quality_classifier.score_quality(table(spark, ODD), one_class).collect()} <= {1.0, 0.5}


# --- personal data ---------------------------------------------------------------------------------------------------
PRIVATE = [
    None, "", "a.b@c.de, x@y and @z.q a@b.c@d.e", "1.2.3.4 300.1.1.1 1.2.3.4.5.6.7.8 0000255.1.2.3", "4111 1111 1111 1111 or 4111-1111-1111-1112", "+1 (437) 555-0689 +49-30-1234567 +12 3", "9" * 5000, "a" * 5000 + "@", "+1" + "(" * 4000,
    "é +1 (437) 555-0689 é@x.y", "+4111111111111111", "1.1.1." * 300, "1 " * 3000, "mail bob [at] host [dot] com or call (312) 555-0199", "4111.1111.1111.1111", "10[.]0[.]0[.]7 is a host", "see you at nine dot", "2024-01-31 12:00:00 order 7417225527243",
]


def test_base_spans_equal_the_patterns(spark):
    got = by_id(pii.find_personal_data(table(spark, PRIVATE)), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for i, t in enumerate(PRIVATE):
        base = brute.personal_data(t or "")
        kinds = [s[0] for s in base]
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert got[i][:5] == (*(kinds.count(k) for k in pii.KINDS), brute.digest(",".join(listed))), t
        assert set(listed) <= set(got[i][5].split(","))
    assert pii.find_personal_data(no_rows(spark)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab@.+-_%12 ()9", max_size=60))
def test_base_spans_of_any_text(text):
    assert pii.base_spans(text) == brute.personal_data(text)


def test_the_field_finds_other_forms_and_little_else():
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    found = wrong = missed = 0
    for text, spans in pii.generated(300, seed=77):
        if pii.base_spans(text):
            continue
        got = set(pii.all_spans(text, field)[1])
        found, wrong, missed = found + len(got & set(spans)), wrong + len(got - set(spans)), missed + len(set(spans) - got)
    assert found / (found + wrong) > 0.95 and found / (found + missed) > 0.9


def _best_cut(field, toks):
    """The best of all cuts, each written out."""
    ends = field.lattice(toks)

    def cuts(j, after):
        if j == 0:
            yield 0.0 + field.weights.get((semi_markov.OUTSIDE, f"then {after}"), 0.0) if after else 0.0, []
            return
        for i, label, features in ends[j]:
            link = field.weights.get((label, f"then {after}"), 0.0) if after else 0.0
            for score, rest in cuts(i, label):
                yield score + field._score(features) + link, [*rest, (i, j, label)]

    best = max(cuts(len(toks), None), key=lambda x: x[0])[1]
    return [s for s in best if s[2] != semi_markov.OUTSIDE]


@pytest.mark.parametrize("text", ["tel (312) 555-0199 ok", "+1 (826) 555-4081 ", "a bob [at] host [dot] com b", "4845168114407329 7536784127813050", "12.34 4111.1111.1111.1111", "see 10[.]0[.]0[.]7"])
def test_decoding_is_the_best_cut(text):
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    toks = semi_markov.tokens(text)
    assert field.decode(toks) == _best_cut(field, toks)


def test_figures_taken_together_are_found_apart():
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    for text, want in (("call +1 (826) 555-4081 190.137.223.204 du", ["+1 (826) 555-4081", "190.137.223.204"]), ("no 4845168114407329 7536784127813050 eai", ["4845168114407329"])):
        base, spans = pii.all_spans(text, field)
        assert set(want) <= {text[a:b] for _, a, b in spans} and len(base) < len(spans)


def test_long_rows_of_figures_take_linear_time():
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    r = random.Random(1)
    begun = time.perf_counter()
    assert pii.all_spans(" ".join(str(r.randrange(1000, 9999)) for _ in range(40_000)), field)[1] == []
    assert time.perf_counter() - begun < 5


def test_long_spelled_out_addresses_are_whole():
    field = semi_markov.SemiMarkov(pii.KINDS, pii.candidates, pii.span_features, pii.trained_weights())
    text = "mail bob at mail dot a-rather-long-company-name dot example dot com today"
    (a, b), *_ = pii.zones(text, [])
    assert text[a:b].strip() == text
    assert any(text[semi_markov.tokens(text)[i][1] : semi_markov.tokens(text)[j - 1][2]].endswith("example dot com") for i, j in pii.candidates(semi_markov.tokens(text)))
    assert field.decode(semi_markov.tokens(text))


def test_redaction_replaces_spans():
    assert pii.redacted("a x@y.z b +1 (437) 555-0689.", pii.base_spans("a x@y.z b +1 (437) 555-0689.")) == "a [EMAIL] b [PHONE]."


def test_every_query_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
    assert hashlib.sha256(queries.HOSTILE.encode()).hexdigest() == hashlib.sha256(b"\\### Assistant: </turn> ok").hexdigest()
