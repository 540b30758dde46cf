"""The stages of the pipeline: each against a brute-force version, and on rows of all kinds."""

import edge
import pytest
from conftest import SMALL
from test_llm_line_dedup import key
from test_llm_simhash import Union, sets_of

import corpus_pipeline
from creditloom.llm.queries import byte_bpe
from creditloom.session import written


@pytest.fixture(scope="module")
def results(spark):
    """The documents and what each stage makes of them."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SMALL)))
    return found


def texts(frame):
    return {r.doc_id: r.text for r in frame.select("doc_id", "text").collect()}


def test_columns(results):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    for frame in results[1:-1]:
        assert frame.dtypes == results[0].dtypes
    assert results[-1].columns[-2:] == ["sequence_id", "offset"]


def test_rejected_documents_go_and_others_are_unchanged(spark, results):
    before, after = texts(results[0]), texts(results[1])
    assert after.items() <= before.items()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    assert all(labels.get(d, 1) == 1 for d in after)
    gone = [d for d in before.keys() - after.keys() if labels.get(d) == 1]
    assert all(len(before[d].split()) < 50 for d in gone)


def test_common_lines_stay_once(results):
    before, after = texts(results[1]), texts(results[2])
    seen = {}
    for doc, text in before.items():
        for k in {key(line) for line in text.split("\n")}:
            seen.setdefault(k, []).append(doc)
    for doc, text in before.items():
        kept, had = [], set()
        for line in text.split("\n"):
            k = key(line)
            if k and len(seen[k]) >= 10:
                if min(seen[k]) != doc or k in had:
                    continue
                had.add(k)
            kept.append(line)
        assert after[doc] == "\n".join(kept)


def test_one_of_each_group_stays(results):
    before, after = texts(results[2]), texts(results[3])
    assert after.items() <= before.items()
    grams, union = {d: sets_of(t) for d, t in before.items()}, Union()
    for a in before:
        for b in before:
            both = len(grams[a] | grams[b])
            if a < b and (not both or len(grams[a] & grams[b]) / both >= 0.8):
                union.join(a, b)
    assert set(after) == {union.find(d) for d in before}


def test_mix_takes_whole_documents_near_the_targets(results):
    before, words, taken = texts(results[3]), {}, {}
    source = {r.doc_id: r.source for r in results[3].collect()}
    for doc, text in before.items():
        words[source[doc]] = words.get(source[doc], 0) + len(text.split())
    copies = {}
    for r in results[4].collect():
        assert r.text == before[r.doc_id]
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
    assert max(copies.values()) <= 3
    from test_llm_mixing import targets

    want = targets(words)
    for name in words:
        longest = max(len(t.split()) for d, t in before.items() if source[d] == name)
        assert abs(taken.get(name, 0) - want[name]) <= longest


def test_everything_is_packed(results):
    from collections import Counter

    from creditloom.llm.packing import Encoder

    encoder = Encoder(byte_bpe()["tokenizer"])
    lengths = Counter()
    for r in results[-1].collect():
        lengths[r.doc_id] += r.length
    want = Counter()
    for r in results[4].collect():
        want[r.doc_id] += len(encoder.ids(r.text)) + 1
    assert lengths == want


def test_run_equals_the_stages(spark, results):
    again = corpus_pipeline.run(spark, SMALL)
    keys = ("doc_id", "piece", "length", "ids_crc32", "offset")
    rows = lambda frame: sorted(tuple(r[k] for k in keys) for r in frame.collect())
    assert rows(again) == rows(results[-1])


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_all_rows(spark, tmp_path, empty):
    rows = [] if empty else edge.texts()
    folder = str(tmp_path)
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    docs = edge.with_clashes(edge.documents(spark, rows))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes
        assert out.count() <= docs.count() * 3
    everything = docs
    for _, stage in corpus_pipeline.STAGES:
        everything = written(stage(spark, everything, folder))
    assert (everything.count() == 0) == empty
