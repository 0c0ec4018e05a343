"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import time

import brute
import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from filmgrid.llm import (
    chat,
    components,
    decontamination,
    host_quality,
    line_dedup,
    packing,
    reputation,
    sharding,
    simhash,
    token_counts,
    warc,
)

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def named(texts):
    """The rows with an id, each id once."""
    return sorted({(d, t) for d, t in texts if d is not None})


# quality rules


def test_quality(docs, texts):
    found = host_quality.judge_documents(docs).collect()
    assert brute.multiset((r.doc_id, *tuple(r)[1:7]) for r in found) == brute.multiset((d, *brute.quality(t)) for d, t in texts)
    assert all(r.kept is not None for r in found)


def test_quality_of_nothing(no_docs):
    assert host_quality.judge_documents(no_docs).collect() == []


def test_a_bad_host_takes_its_documents_along(spark):
    good = "many words that are all different so that no rule of the text itself is broken by this one here today"
    rows = [(i, good if i % 20 == 0 else "few words", "bad") for i in range(400)] + [(1000 + i, good, "good") for i in range(400)]
    found = host_quality.judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert kept == {1000 + i for i in range(400)}
    assert found.where("doc_id = 0 AND NOT base_failed").count() == 1


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_words(spark, letters):
    text = " ".join(letters)
    found = host_quality.base_measures(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).first()
    assert found.n_repeat_words == brute.quality(text)[4]


# line dedup


def test_lines(spark, docs, texts, fresh):
    index = line_dedup.LineIndex(spark, fresh("lines"))
    index.insert(docs)
    found = index.clean(docs).collect()
    expected = brute.line_dedup(named(texts))
    assert len(found) == len(texts)
    for r in found:
        assert r.kept is True and r.lang == "en" and r.shard == 0
        if r.doc_id is not None:
            assert (r.n_lines, r.n_dropped, r.text) == expected[r.doc_id]
        else:
            assert r.n_dropped == 0


def test_keys_of_a_whole_text():
    """Keys are made from a text's bytes, lower-cased once; letters beyond A-Z and characters of several bytes count as before."""
    lines = ["  A Line Of Its Own\x0b", "ÀÉÎÕÜ ß İK", "千と千尋の神隠しです", "千と千尋の神隠しで", "123456789\x1c", "nine char", "\t ten chars!\r", "😀" * 9, "😀" * 10, ""]
    expected = [(key := brute.line_key(x)) and xxhash.xxh3_128_digest(key.encode()) for x in lines]
    assert [line_dedup.line_key(x) for x in lines] == expected
    assert line_dedup._keys_of("\n".join(lines).encode().lower().split(b"\n")) == expected


def test_lines_of_nothing(spark, no_docs, fresh):
    index = line_dedup.LineIndex(spark, fresh("lines"))
    index.insert(no_docs)
    assert index.batches() == 1 and index.clean(no_docs).collect() == []


def test_lines_come_back(spark, fresh):
    """Batches in, documents out: always as if the index had been built from what it holds now."""
    rng = np.random.default_rng(5)
    lines = [f"line number {i:04d}" for i in range(60)]
    held = {}
    index = line_dedup.LineIndex(spark, fresh("lines"))

    def frame(docs):
        return spark.createDataFrame(list(docs.items()), "doc_id long, text string")

    def check():
        found = {r.doc_id: r.text for r in index.clean(frame(held)).collect()}
        assert found == {d: t for d, (_, _, t) in brute.line_dedup(list(held.items())).items()}
        counts = {r.key: (r.n_docs, r.first_doc) for r in index.counts().collect()}
        exact = {}
        for d, t in held.items():
            for key in {line_dedup.line_key(x) for x in t.split("\n")}:
                n, first = exact.get(key, (0, d))
                exact[key] = (n + 1, min(first, d))
        assert {bytes(k): v for k, v in counts.items()} == exact

    ids = rng.permutation(12).tolist()
    for part in (ids[:5], ids[5:9]):
        batch = {d: "\n".join(rng.choice(lines, 8)) for d in part}
        held |= batch
        index.insert(frame(batch))
        check()
    index.insert(frame({ids[0]: "a line that must not count"}))  # held already
    check()
    gone = sorted(held)[:3]
    index.delete(spark.createDataFrame([(d,) for d in [*gone, 999]], "doc_id long"))
    for d in gone:
        del held[d]
    check()
    batch = {d: "\n".join(rng.choice(lines, 8)) for d in [gone[0], *ids[9:]]}
    held |= batch
    index.insert(frame(batch))
    check()


def test_cuckoo_filter():
    keys = [i.to_bytes(8, "little") * 2 for i in np.random.default_rng(1).integers(0, 2**63, 5000).tolist()]
    made = line_dedup.built_filter(keys[:4000])
    assert made.n == 4000 and made.may_hold(keys[:4000]).all()
    assert made.may_hold(keys[4000:]).mean() < 0.01
    made.delete(keys[:2000])
    assert made.n == 2000 and made.may_hold(keys[2000:4000]).all() and made.may_hold(keys[:2000]).mean() < 0.01
    back = line_dedup.CuckooFilter.from_bytes(made.to_bytes(), made.n)
    assert (back.table == made.table).all() and back.insert(keys[:500])
    small = line_dedup.CuckooFilter(16)
    assert not small.insert(keys)
    assert small.may_hold([]).tolist() == [] and small.insert([])


def test_full_filters_are_built_anew(spark, fresh):
    index = line_dedup.LineIndex(spark, fresh("lines"))
    many = [(i, "\n".join(f"some line {i} {j}" for j in range(200))) for i in range(1, 11)]
    index.insert(spark.createDataFrame([(0, "one single line")], "doc_id long, text string"))
    index.insert(spark.createDataFrame(many, "doc_id long, text string"))
    state = index._current_filters(index.batches())
    assert state.where("shard >= 0").agg(F.sum("n")).first()[0] == 2001


# simhash


def test_simhash(docs, texts):
    found = simhash.near_duplicates(docs).collect()
    lowest = -(2**63)
    expected = brute.simhash([(lowest if d is None else d, t) for d, t in texts if d is not None])
    assert len(found) == len(texts)
    for r in found:
        if r.doc_id is not None and r.component_id != lowest:
            assert (f"{r.fingerprint & (2**64 - 1):016x}", r.component_id) == expected[r.doc_id]
    zero = {r.component_id for r in found if r.fingerprint == 0}
    assert zero == {lowest}  # the null text without an id is among them


def test_simhash_of_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("distance,segments", [(0, 3), (2, 3), (3, 4), (4, 3), (5, 2)])
def test_segments_find_every_pair(distance, segments):
    rng = np.random.default_rng(distance)
    plan = simhash.segment_plan(distance, segments)
    assert sum(b for _, b, _ in plan) <= 64
    for _ in range(300):
        a = int(rng.integers(0, 2**63))
        b = a
        for bit in rng.choice(64, distance, replace=False).tolist():
            b ^= 1 << bit
        parts = [((a >> low & (1 << bits) - 1) ^ (b >> low & (1 << bits) - 1), radius) for low, bits, radius in plan]
        assert any(x.bit_count() <= radius for x, radius in parts)


def test_segments_follow_the_number_of_fingerprints(docs):
    assert [simhash.segments_for(n, 4) for n in (0, 10**5, 10**7, 10**9, 10**12)] == [3, 3, 3, 2, 2]
    found = [sorted(map(str, simhash.near_duplicates(docs, segments=n).collect())) for n in (2, 3)]
    assert found[0] == found[1]


def test_crowds_and_strangers(spark, monkeypatch):
    """A dense crowd, chains of links and lone fingerprints, with small bounds so that every path is taken."""
    monkeypatch.setattr(simhash, "CROWDED", 3)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**62))
    values = {centre}
    for _ in range(120):
        value = centre
        for bit in rng.choice(64, int(rng.integers(1, 4)), replace=False).tolist():
            value ^= 1 << bit
        values.add(value)
    chain = int(rng.integers(0, 2**62))
    for bit in range(0, 24, 4):
        chain ^= 0b1111 << bit
        values.add(chain)
    values |= {int(v) for v in rng.integers(0, 2**63, 50)} | {v ^ 1 << 63 for v in list(values)[:20]}
    values = sorted(v & (2**64 - 1) for v in values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fp long")
    members = prints.select("fp", F.col("fp").alias("fold"))
    folded = simhash._composed(members, simhash.dense_links(prints, 4))
    found = simhash._composed(folded, simhash.near_links(folded, 4)).collect()
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    expected = brute.classes(pairs, signed)
    groups = lambda of: {frozenset(k for k in of if of[k] == v) for v in set(of.values())}
    assert groups({r.fp: r.fold for r in found}) == groups(expected)


def test_components(spark):
    edges = [(i, i + 1) for i in range(100)] + [(200, 300), (300, 200), (400, 400)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(101)}, 200: 200, 300: 200, 400: 400}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


# decontamination


def test_reordered_passages(spark, docs, no_docs):
    words = [f"token{i}" for i in range(40)]
    item = " ".join(words)
    swapped = " ".join(words[20:] + ["other"] * 3 + words[:20])
    shredded = " ".join(w for i in range(0, 40, 4) for w in [*words[i : i + 4], "x"])
    rows = [(1, f"before {item.upper()}, after"), (2, swapped), (3, shredded), (4, " ".join(words[:31])), (5, " ".join(words[:32])), (None, item), (2, item)]
    bench = spark.createDataFrame([(7, item, 1), (8, None, 2), (9, "too short", 3), (None, item, 4), (7, item, 5)], "item_id long, text string, doc_id int")
    found = decontamination.contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench)
    assert {(r.doc_id, r.item_id, r.covered, r.n_tiles) for r in found.collect()} == {(1, 7, 40, 1), (2, 7, 40, 2), (5, 7, 32, 1)}
    assert decontamination.contaminated(no_docs, bench).collect() == []
    assert decontamination.contaminated(docs, bench.limit(0)).collect() == []
    assert decontamination.contaminated(docs, bench).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(0, 3), max_size=25), st.integers(2, 4))
def test_tiling(doc, item, size):
    """Ties may be broken otherwise, so the tiles are checked by what makes them greedy and maximal."""
    tokens = lambda x: np.array(x, dtype=np.int64)
    seeds, own = (decontamination.seed_hashes(tokens(x), size).view(np.int64) for x in (doc, item))
    found = decontamination.tiles(np.arange(len(seeds)), seeds, own, size) if len(own) else []
    used_d, used_i = [False] * len(doc), [False] * len(item)
    for p, i, n in found:
        assert n >= size and doc[p : p + n] == item[i : i + n]
        assert not any(used_d[p : p + n]) and not any(used_i[i : i + n])
        used_d[p : p + n], used_i[i : i + n] = [True] * n, [True] * n
    for p in range(len(doc) - size + 1):
        for i in range(len(item) - size + 1):
            left = doc[p : p + size] == item[i : i + size] and not any(used_d[p : p + size]) and not any(used_i[i : i + size])
            assert not left
    longest = max((n for p in range(len(doc)) for i in range(len(item)) for n in range(1, 61) if p + n <= len(doc) and i + n <= len(item) and doc[p : p + n] == item[i : i + n]), default=0)
    assert max((n for _, _, n in found), default=0) == (longest if longest >= size else 0)


@pytest.mark.parametrize("period", [1, 2, 7])
def test_repetitive_texts(period):
    """A step for each run: comparing all pairs of places here took most of a minute."""
    doc, item = (decontamination.seed_hashes(np.arange(n, dtype=np.int64) % period).view(np.int64) for n in (20_000, 1000))
    begun = time.process_time()
    assert decontamination.tiles(np.arange(len(doc)), doc, item) == [(0, 0, 1000)]
    assert time.process_time() - begun < 10


def test_rows_of_a_hot_id(spark):
    """Rows of one id meet their own items only, and equal rows are tiled once."""
    texts = [" ".join(f"id{i}word{j}" for j in range(12)) for i in range(40)]
    docs = spark.createDataFrame([(1, t) for t in texts] + [(1, texts[0])] * 30, "doc_id long, text string")
    found = decontamination.contaminated(docs, spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.covered) for r in found.collect()} == {(1, i, 12) for i in range(40)}


def test_common_passage_loses_no_item(spark):
    """A passage that all items share is left out of the candidate join, the items are found none the less."""
    shared = " ".join(f"common{i}" for i in range(20))
    items = [(i, f"{shared} " + " ".join(f"own{i}x{j}" for j in range(10))) for i in range(20)]
    docs = [(i, text) for i, text in items[:5]] + [(100 + i, shared) for i in range(30)]
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(5)}


# packing and token counts


def test_packing(docs, texts, no_docs):
    found = packing.pack(docs, BYTES).collect()
    expected = brute.pieces(named(texts))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found if r.doc_id is not None} == expected
    assert len(found) == len(expected) + 3
    filled = {}
    for r in found:
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in filled.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 1024
    assert packing.pack(no_docs, BYTES).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=60) | st.text(alphabet=" \n\t'sa1<|endoftext|>é😀", max_size=40))
def test_fast_tokenizer(text):
    assert packing.token_ids(text, BYTES).tolist() == packing._tokenizer(BYTES).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 50_000 + "x", "a" * 200_000, "<|endoftext|>" * 3, "é" * 30_000 + "\n" * 20_000])
def test_long_runs(text):
    assert packing.token_ids(text, BYTES).tolist() == packing._tokenizer(BYTES).encode(text, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 200), max_size=30))
def test_plan(histogram):
    made = packing.plan(histogram, 50)
    held = {}
    for items, n in made:
        assert sum(length * k for length, k in items) <= 50
        for length, k in items:
            held[length] = held.get(length, 0) + n * k
    assert held == histogram
    demand = np.array([histogram.get(length, 0) for length in range(51)])
    demand[50] = 0
    if demand.any():
        program = packing.fractional_patterns(demand, 50)
        covered = sum(used * np.bincount([l for l, n in items for _ in range(n)], minlength=51) for items, used in program.used.items())
        assert np.allclose(covered, demand) and program.bound <= program.value + 1e-6
    # no worse than any packing could be with a simple rule, within one sequence a length
    assert sum(n for _, n in made) <= brute.best_fit_decreasing(histogram, 50) + len(histogram)


def test_program_places_the_documents(spark, folder):
    """The pieces of the documents go by the program: near its bound, and fewer sequences than best fit needs."""
    docs = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/documents.parquet")
    histogram = {r["length"]: r["count"] for r in packing.pieces(docs, BYTES).groupBy("length").count().collect()}
    demand = np.array([histogram.get(length, 0) for length in range(packing.CAPACITY)] + [0])
    program = packing.fractional_patterns(demand, packing.CAPACITY)
    needed = sum(n for _, n in packing.plan(histogram)) - histogram[packing.CAPACITY]
    assert program.bound <= program.value <= 1.006 * program.bound
    assert program.value <= needed <= program.bound + np.count_nonzero(demand)
    # nearly all sequences are patterns of the first program, used a whole number of times
    assert sum(int(n + 1e-9) for n in program.used.values()) > 0.9 * needed
    assert needed < brute.best_fit_decreasing({l: n for l, n in histogram.items() if l < packing.CAPACITY}, packing.CAPACITY)


def test_program_beats_best_fit():
    histogram = {516: 600, 517: 3, 300: 1000, 211: 900, 170: 400}
    needed = sum(n for _, n in packing.plan(histogram))
    assert needed == 886 and brute.best_fit_decreasing(histogram, 1024) == 961


@pytest.mark.parametrize("seed", range(5))
def test_knapsack(seed):
    rng = np.random.default_rng(seed)
    lengths, counts, gain = np.arange(3, 9), rng.integers(1, 4, 6), rng.random(6)
    best = max(
        sum(n * g for n, g in zip(taken, gain))
        for taken in itertools.product(*[range(c + 1) for c in counts])
        if sum(n * l for n, l in zip(taken, lengths)) <= 20
    )
    pattern, weight = packing.price_pattern(gain, lengths, counts, 20)
    assert np.isclose(weight, best) and np.isclose(sum(gain[l - 3] * n for l, n in pattern.items()), best)
    assert all(n <= counts[l - 3] for l, n in pattern.items()) and sum(l * n for l, n in pattern.items()) <= 20


def test_token_cache(spark, docs, texts, no_docs, fresh, monkeypatch):
    cache = fresh("cache")
    expected = [(d, len((t or "").encode()), n) for (d, t), n in zip(texts, brute.token_counts([t for _, t in texts]))]
    for _ in range(2):  # the second run finds everything in the cache
        found = token_counts.count_tokens(docs, cache, PIECES)
        assert brute.multiset((r.doc_id, r.n_bytes, r.n_tokens) for r in found.collect()) == brute.multiset(expected)
        assert spark.read.parquet(cache).count() == len({t or "" for _, t in texts})
    assert token_counts.count_tokens(no_docs, cache, PIECES).collect() == []
    monkeypatch.setattr(token_counts, "tokenizer_version", lambda path: "another")
    token_counts.count_tokens(docs, cache, PIECES).collect()
    assert spark.read.parquet(cache).count() == 2 * len({t or "" for _, t in texts})


def test_repeated_rows_are_encoded_once(spark, fresh, monkeypatch):
    """Rows without an id that hold one text, and rows that repeat an id with another one."""
    encoded = spark.sparkContext.accumulator(0)
    plain = token_counts._encoded

    def counting(model_file):
        def run(batches):
            def seen():
                for batch in batches:
                    encoded.add(batch.num_rows)
                    yield batch

            return plain(model_file)(seen())

        return run

    monkeypatch.setattr(token_counts, "_encoded", counting)
    docs = spark.createDataFrame([(None, "one text")] * 2000 + [(5, "another text")] * 2000, "doc_id long, text string").repartition(6)
    found = token_counts.count_tokens(docs, fresh("cache"), PIECES)
    assert found.count() == 4000 and encoded.value == 2


# sharding


def test_sharding(docs, texts, no_docs):
    found = sharding.into_shards(docs, ["doc_id", "text"], 4, blocks=8).collect()
    assert brute.multiset((r.doc_id, r.text) for r in found) == brute.multiset(texts)
    assert sorted((r.shard, r.slot) for r in found) == sorted((i, s) for i, n in enumerate(sharding.shard_sizes(len(texts), 4)) for s in range(n))
    assert sharding.into_shards(no_docs, ["doc_id"], 4).collect() == []


def test_sharding_in_many_buckets(spark, monkeypatch):
    """Buckets of a few rows, so that both permutations go over several of them, one id holding a third of the rows."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 5)
    rows = spark.range(600).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.col("id").alias("n"))
    found = sharding.into_shards(rows, ["doc_id", "n"], 7, blocks=8).collect()
    assert sorted(r.n for r in found) == list(range(600))
    assert sorted((r.shard, r.slot) for r in found) == sorted((i, s) for i, n in enumerate(sharding.shard_sizes(600, 7)) for s in range(n))


def test_matrix_is_uniform():
    """The counts of a small matrix against those of plain shuffles."""
    seen, plain = np.zeros((3, 2)), np.zeros((3, 2))
    squares, plain_squares = np.zeros((3, 2)), np.zeros((3, 2))
    blocks, shards = [5, 1, 4], [6, 4]
    rng = np.random.default_rng(0)
    for seed in range(4000):
        m = sharding.communication_matrix(blocks, shards, seed)
        assert m.sum(1).tolist() == blocks and m.sum(0).tolist() == shards
        seen += m
        squares += m * m
        order = rng.permutation(np.repeat([0, 1], shards))
        p = np.array([[(part == j).sum() for j in range(2)] for part in np.split(order, [5, 6])])
        plain += p
        plain_squares += p * p
    assert np.abs(seen - plain).max() / 4000 < 0.08 and np.abs(squares - plain_squares).max() / 4000 < 0.5


def test_large_hypergeometric():
    rng = np.random.default_rng(1)
    draws = [sharding.hypergeometric(rng, 10**11, 3 * 10**11, 10**7) for _ in range(200)]
    assert abs(np.mean(draws) - 2_500_000) < 500 and 900 < np.std(draws) < 2000
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 4, 0, 3) == 3


# url filter


def test_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "http://example.net/de/", "http://net", "http://net/",
        "x://a.b.example.com/de/1", "http://example.com/de", "http://b.org/fr/", "http://notexample.net/en/", "http://h:80/p#a?b", "a://b://c/d",
    ]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    pages = spark.createDataFrame([(i, u, "x", True) for i, u in enumerate([*urls, *urls])], "page_id long, url string, host string, bad boolean")
    labels = spark.createDataFrame([(0, 1), (0, 0), (None, 1), (4, None), (99, 1)], "page_id long, bad int")
    found = {r.page_id: r for r in reputation.judge_urls(pages, labels, rules).collect()}
    assert len(found) == 2 * len(urls)
    for i, url in enumerate([*urls, *urls]):
        rule = brute.rule_of(url, rules)
        assert (found[i].host, found[i].path) == brute.url_parts(url)
        assert (found[i].rule, found[i].verdict) == (rule if rule else (None, "allow"))
    assert reputation.judge_urls(pages.limit(0), labels, rules).collect() == []
    assert reputation.judge_urls(pages, labels.limit(0), []).where("verdict <> 'allow'").count() == 0


def test_urls_of_nothing(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "other"), (2, None, "other")], "page_id long, url string, rule string")
    labels = spark.createDataFrame([(1, 1)], "page_id long, bad int")
    rules = [("org", "/", "block")]
    assert reputation.judge_urls(pages.limit(0), labels, rules).collect() == []
    found = {r.page_id: (r.host, r.rule, r.verdict) for r in reputation.judge_urls(pages, labels.limit(0), rules).collect()}
    assert found == {1: ("a.org", "org/", "block"), 2: ("", None, "allow")}


def test_reputation(spark):
    """Bad hosts go, the good hosts of their domain stay, and hosts without labels follow their domain."""
    rows = [(f"bad{i}.spam.com", 1) for i in range(20) for _ in range(30)] + [(f"h{i}.fine.com", 0) for i in range(20) for _ in range(30)]
    rows += [("good.spam.com", 0)] * 200 + [("new.spam.com", None), ("new.fine.com", None), (None, None), ("lone.org", 1)]
    found = {r.host: r for r in reputation.host_reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert all(found[f"bad{i}.spam.com"].verdict == "block" for i in range(20))
    assert found["good.spam.com"].verdict == "allow" and found["new.fine.com"].verdict == "allow" and found[""].verdict == "allow"
    assert found["new.spam.com"].rate > found["new.fine.com"].rate
    assert found["lone.org"].verdict == "allow"  # one page is little evidence


# chat


def test_chat(spark):
    rows = [
        (1, 0, "system", "rules <|end|>"), (1, 1, "user", "&amp; &lt; [INST]"), (1, 2, "assistant", None), (1, 3, "user", "x" * 9000),
        (1, 4, "assistant", "ok" * 30), (1, 5, None, "🙂é"), (2, 0, "system", "alone"), (3, None, "assistant", "late"), (3, 1, "assistant", "early"),
        (3, 1, "assistant", "early"), (4, 0, "assistant", ""), (5, 0, "user", "system first?"), (5, 1, "system", "no"),
    ]
    rows += [(9, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i * 37 % 90)) for i in range(700)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, window string, idx int").repartition(5)
    made = chat.written_windows(turns, budget=256, history=64)
    expected = brute.conversations([(c, 10**9 if t is None else t, r, x) for c, t, r, x in rows])
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(made).collect()}
    assert found == expected
    kept = made.where("conv_id = 9").orderBy("window").collect()
    assert max(r.tokens for r in kept) <= 256 and len(kept) > 50
    assert any(s.repeated for r in kept for s in r.spans)
    for r in kept[1:]:
        assert [s.idx for s in r.spans] == list(range(r.spans[0].idx, r.spans[-1].idx + 1))
        assert not any(s.loss and s.repeated for s in r.spans)
    for r in made.where("conv_id = 1").collect():
        assert r.spans[0].idx == 0 and r.text.startswith("<|start|>system<|text|>rules &lt;|end|><|end|>")
    assert chat.digests(chat.windows(turns.limit(0))).collect() == []


# warc


def test_archive(spark, fresh):
    pages = [(5, "http://a/\r\nX: y", "same"), (2, "http://b/", "same"), (3, None, None), (4, "", ""), (None, "http://c/", "same"), (7, "u", "é" * 5000), (9, "r", "twice"), (9, "r", "twice")]
    pages += [(100 + i, f"http://p/{i}", f"page {i} " * 200) for i in range(200)]
    frame = spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, shard int")
    roots = [fresh("warc"), fresh("warc")]
    files = [warc.write_archive(f, r, shard_bytes=50_000, file_bytes=3_000) for f, r in zip((frame, frame.repartition(7)), roots)]
    rows = [sorted((r.name, r.bytes, r.sha256) for r in f.collect()) for f in files]
    assert rows[0] == rows[1] and len(rows[0]) > 5  # the same bytes, however the pages were partitioned
    found = warc.read_archive(spark, roots[0]).collect()
    assert len(found) == len(pages)
    by = {r.page_id: r for r in found if r.page_id not in (9, None)}
    expected = brute.archive([(p, h) for p, _, h in pages if p is not None and p != 9])
    assert {p: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for p, r in by.items()} == expected
    assert sorted((r.record_type, r.refers_to) for r in found if r.page_id == 9) == [("response", None), ("revisit", 9)]
    assert [(r.record_type, r.refers_to) for r in found if r.page_id is None] == [("revisit", 2)]
    assert by[7].html == "é" * 5000 and by[5].url == "http://a/%0D%0AX: y" and by[5].html is None
    assert spark.read.text(f"{roots[0]}/manifest").count() >= 0
    empty = fresh("warc")
    warc.write_archive(frame.limit(0), empty)
    assert warc.read_archive(spark, empty).collect() == []


def test_small_payloads_are_not_revisited(spark, fresh):
    frame = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "long enough"), (4, "d", "long enough")], "page_id long, url string, html string")
    root = fresh("warc")
    warc.write_archive(frame, root, revisit_bytes=5)
    assert {r.page_id: r.refers_to for r in warc.read_archive(spark, root).collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_a_small_batch_reads_few_shards(spark, fresh):
    """The filters are asked, only the shards of keys that they may hold are looked up, and no other filter is written."""
    frame = lambda docs: spark.createDataFrame(docs, "doc_id long, text string")
    index = line_dedup.LineIndex(spark, fresh("lines"), shard_keys=50)
    index.insert(frame([(i, "\n".join(f"a line of its own {i} {j}" for j in range(20))) for i in range(200)]))
    n_shards = index._layout(1)[0]
    assert n_shards == 80
    index.insert(frame([(1000, "a line of its own 3 4\na line that is new to the index"), (1001, "")]))
    asked = index.spark.read.parquet(f"{index.root}/asked/batch=1").where("key IS NOT NULL").collect()
    assert sorted(r.maybe for r in asked) == [False, True]
    looked = index.spark.read.parquet(f"{index.root}/looked/batch=1").collect()
    assert [(r.n_before, r.first_doc) for r in looked] == [(1, 3)]
    exact = index._latest(1, 0, [looked[0].shard])
    assert exact.count() < 4000 / 20 and {r.shard for r in exact.select("shard").distinct().collect()} == {looked[0].shard}
    assert index.spark.read.parquet(f"{index.root}/filters/batch=1").where("shard >= 0").count() <= 2
    assert index.counts().where("n_docs = 2").count() == 1 and index.counts().count() == 4001


def test_shards_are_split_when_keys_outgrow_them(spark, fresh):
    frame = lambda low, high: spark.createDataFrame([(i, "\n".join(f"a line of its own {i} {j}" for j in range(20)) + "\nshared by all of them") for i in range(low, high)], "doc_id long, text string")
    index = line_dedup.LineIndex(spark, fresh("lines"), shard_keys=50)
    index.insert(frame(0, 10))
    assert index._layout(1)[0] == line_dedup.MIN_SHARDS
    index.insert(frame(10, 100))
    n_shards, since, n = index._layout(2)
    assert (n_shards, since, n) == (42, 1, 2001)
    assert index._current_filters(2, 1).agg(F.max("n")).first()[0] < 120
    index.delete(spark.createDataFrame([(0,), (50,)], "doc_id long"))
    index.insert(frame(100, 101))
    counts = {bytes(r.key): (r.n_docs, r.first_doc) for r in index.counts().collect()}
    assert counts[line_dedup.line_key("shared by all of them")] == (99, 1) and len(counts) == 20 * 99 + 1
    assert index._layout(4)[2] == len(counts)


def test_deleting_from_an_empty_index(spark, fresh):
    index = line_dedup.LineIndex(spark, fresh("lines"))
    index.delete(spark.createDataFrame([(1,)], "doc_id long"))
    assert index.counts().collect() == [] and index.batches() == 1
    index.insert(spark.createDataFrame([(1, "some long line here")], "doc_id long, text string"))
    assert index.counts().count() == 1


def test_large_ids_keep_their_digits(spark, fresh):
    """Ids beyond 2^53, which doubles cannot hold, in a batch that goes through the filters."""
    index, low = line_dedup.LineIndex(spark, fresh("lines")), 2**62
    rows = [(low + i, f"a line that all of them hold\nand a line of its own {i}") for i in (1, 3, 5, 7)]
    frame = lambda some: spark.createDataFrame(some, "doc_id long, text string")
    index.insert(frame([(1, "one line to begin with")]))
    index.insert(frame(rows[1:]))
    index.insert(frame(rows[:1]))
    found = {r.doc_id: r.text for r in index.clean(frame(rows)).collect()}
    assert found == {d: t if d == low + 1 else t.split("\n")[1] for d, t in rows}
