"""Registered queries over whole tables against the plain versions."""

import __spark_entry__ as entry
import brute
import numpy as np
import oracle
import pytest

from filmgrid.llm import queries as registered

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def rows(spark, folder):
    def read(table, *columns):
        return [tuple(r) for r in spark.read.parquet(f"{folder}/{table}.parquet").select(*columns).collect()]

    return read


@pytest.fixture(scope="module")
def run(spark, folder):
    return lambda name: QUERIES[name](spark, folder).collect()


def test_decontamination(run, rows):
    found = {(r.doc_id, r.item_id): r.covered for r in run("op1_decontamination")}
    assert found == brute.leaks(rows("documents", "doc_id", "text"), rows("benchmark", "item_id", "text"))
    assert found


def test_packing(run, rows):
    found = run("op2_packing")
    expected = brute.pieces(rows("documents", "doc_id", "text"))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in found} == expected and len(found) == len(expected)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        ends = np.cumsum([n for _, n in places])
        assert [o for o, _ in places] == [0, *ends[:-1].tolist()] and ends[-1] <= 1024
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in found) // 1024) + 1


def test_chat(run, rows):
    turns = rows("conversations", "conv_id", "turn", "role", "text")
    turns += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    found = run("op3_chat")
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == brute.conversations(turns)
    assert all(r.formatted_chars > r.loss_chars for r in found)


def test_warc(run, rows):
    found = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in run("op4_warc")}
    assert found == brute.archive(rows("pages", "page_id", "html"))


def test_quality(run, rows):
    found = {r.doc_id: tuple(r)[1:] for r in run("op5_quality")}
    expected = {d: brute.quality(t) for d, t in rows("documents", "doc_id", "text")}
    assert {d: r[:-1] for d, r in found.items()} == expected
    assert all(not (r[-1] and r[-2]) for r in found.values())


def test_sharding(run, rows):
    import zlib

    found = run("op6_sharding")
    assert {(r.doc_id, r.size, r.text_crc32) for r in found} == {
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows("documents", "doc_id", "text")
    }
    shards = {}
    for r in found:
        assert r.law == "rows" and r.grown_shard is None
        shards.setdefault(r.shard, []).append(r.slot)
    assert set(shards) <= set(range(24))
    sizes = [len(shards.get(i, ())) for i in range(24)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(found)
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_token_counts(run, rows):
    docs = rows("documents", "doc_id", "text")
    counts = brute.token_counts([t for _, t in docs])
    expected = {d: (len((t or "").encode()), n, n > 4096) for (d, t), n in zip(docs, counts)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in run("op7_token_counts")} == expected


def test_simhash(run, rows):
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in run("op8_simhash")}
    assert found == brute.simhash(rows("documents", "doc_id", "text"))


def test_url_filter(run, rows):
    found = {r.page_id: r for r in run("op9_url_filter")}
    pages = rows("pages", "page_id", "url")
    assert set(found) == {p for p, _ in pages}
    for page, url in pages:
        rule = brute.rule_of(url, registered.URL_RULES)
        assert (found[page].host, found[page].path) == brute.url_parts(url)
        assert found[page].rule == (rule and rule[0])
        assert found[page].verdict == rule[1] if rule else found[page].verdict in ("allow", "block")


def test_line_dedup(run, rows):
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in run("op10_line_dedup")}
    expected = brute.line_dedup(rows("documents", "doc_id", "text"))
    assert found == {d: (n, k, brute.sha256(t)) for d, (n, k, t) in expected.items()}


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_sql(name, spark, folder):
    assert oracle.differences(QUERIES[name](spark, folder), oracle.connect(folder), registered.SQL[name]) == []


def test_every_operator_has_one_query():
    assert [n.split("_")[0] for n in registered.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert set(registered.SQL) <= set(registered.QUERIES)
