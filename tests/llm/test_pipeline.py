"""The pipeline, stage by stage, against the plain versions."""

import brute
import corpus_pipeline
import public_tokenizers

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, folder, fresh):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = fresh("stage")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "best-fit packing":
            found = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in docs.collect()}
            assert found == brute.pieces(before)
            continue
        assert docs.columns == COLUMNS
        after = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(after)
        if name == "quality rules":
            expected = {d: t for d, t in before if not brute.quality(t)[5]}
        elif name == "line dedup":
            expected = {d: t for d, (_, _, t) in brute.line_dedup(before).items()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "simhash near-dedup":
            groups = brute.simhash(before)
            expected = {d: t for d, t in before if groups[d][1] == d}
        else:
            leaks = {d for d, _ in brute.leaks(before, items)}
            expected = {d: t for d, t in before if d not in leaks}
        assert after == expected, name
        before = sorted(after.items())


def test_run_is_all_stages(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert found.columns[:3] == ["doc_id", "piece", "start"] and found.count() > 0


def test_stages_on_odd_rows(spark, docs, no_docs, fresh, folder):
    for frame in (docs, no_docs):
        current = frame
        for name, stage in corpus_pipeline.STAGES:
            path = fresh("odd")
            stage(spark, current, folder).write.parquet(path)
            current = spark.read.parquet(path)
            if name != "best-fit packing":
                assert current.columns == frame.columns
        assert frame is docs or current.count() == 0
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_rows_without_an_id_are_judged_by_their_texts(spark, folder, fresh):
    """Clean ones stay, whole and once for each text; short ones and copies of a document with an id go."""
    long = [" ".join(f"{name}{i}" for i in range(40)) for name in ("river", "stone", "cloud")]
    rows = [(1, long[0], "a"), (None, long[0], "a"), (None, long[1], "a"), (None, long[1], "b"), (None, long[2], None), (None, "short", "a"), (None, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = fresh("unnamed")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    assert sorted((r.doc_id or 0, r.text) for r in docs.collect()) == sorted([(1, long[0]), (0, long[1]), (0, long[2])])


def test_rows_that_repeat_an_id_are_told_apart_by_their_texts(spark, folder, fresh):
    """One id over unlike texts: each is judged by its own text; only rows equal in both fold together."""
    texts = [" ".join(f"{name}{i}" for i in range(40)) for name in ("river", "stone", "cloud")]
    item = spark.read.parquet(f"{folder}/benchmark.parquet").orderBy("item_id").first().text
    leak = " ".join([texts[0].replace("river", "leaf"), item])
    rows = [(1, texts[0], "a"), (1, texts[1], "b"), (1, texts[1], "a"), (1, texts[1], None), (2, texts[1], "a"), (1, "short", "a"), (1, leak, "a"), (3, texts[2], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    after = {}
    for name, stage in (s for s in corpus_pipeline.STAGES[:-1] if s[0] != "line dedup"):
        path = fresh("repeated")
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        after[name] = sorted(((r.doc_id, r.text, r.source or "") for r in docs.collect()))
    assert after["quality rules"] == sorted((d, t, s or "") for d, t, s in rows if t != "short")
    kept = sorted([(1, texts[0], "a"), (1, texts[1], ""), (1, leak, "a"), (3, texts[2], "")])
    assert after["simhash near-dedup"] == kept
    assert after["benchmark decontamination"] == [r for r in kept if r[1] != leak]


def test_a_bad_host_takes_only_its_own_rows_of_an_id(spark, folder):
    good = "many words that are all different so that no rule of the text itself is broken by this one here today"
    rows = [(i, good if i == 0 else "few words", "bad") for i in range(400)] + [(i, f"{good} {i}", "good") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = corpus_pipeline.quality(spark, docs, folder).collect()
    assert sorted((r.doc_id, r.source) for r in found) == [(i, "good") for i in range(400)]


def test_lines_of_rows_without_an_id_are_deduplicated(spark, folder, fresh):
    """Among such rows, and between them and documents with ids, a passage stays once, in the document if there is one."""
    passage, other = "a passage that a document holds", "a passage that only rows without ids hold"
    rows = [(None, f"{passage}\nfirst own line of text"), (7, f"{passage}\nthe line of document seven")]
    rows += [(None, f"{other}\n{word} line of its own here") for word in ("second", "third")]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n_chars long").repartition(3)
    found = corpus_pipeline.line_dedup_(spark, docs, folder).collect()
    assert sorted(r.doc_id or 0 for r in found) == [0, 0, 0, 7] and all(r.n_chars == len(r.text) for r in found)
    lines = [line for r in found for line in r.text.split("\n")]
    assert sorted(lines) == sorted({line for _, t in rows for line in t.split("\n")})
    assert next(r.text for r in found if r.doc_id) == rows[1][1]


def test_line_dedup_with_a_column_of_its_own_names(spark, folder):
    rows = [(i, "one line that all of them hold\nand one of its own %d" % i, i, "x") for i in range(1, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _real long, _real_ string")
    found = corpus_pipeline.line_dedup_(spark, docs, folder)
    assert found.columns == docs.columns
    texts = {r.doc_id: (r.text, r._real) for r in found.collect()}
    assert texts[1] == (rows[0][1], 1) and all(texts[i] == (f"and one of its own {i}", i) for i in range(2, 6))
