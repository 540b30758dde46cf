import edge
import numpy as np
import pytest
from conftest import SMALL

from creditloom.llm import language, quality_model, quality_rules, queries


def fold(doc_id, folds):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % folds


def repeated(words):
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    inside = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    return len(inside)


def counts(text):
    text = text or ""
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            duplicates += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        duplicates,
        repeated(words),
    )


def test_statistics(spark):
    rows = edge.texts()
    rows += [(50, "a b c a b c d a b\na b\nb\nb\n \n \n#x|<>", None, None), (51, "x " * 300, None, None)]
    docs = edge.with_clashes(edge.documents(spark, rows))
    got = quality_rules.judged(docs, quality_rules.no_trees()).collect()
    names = ("doc_id", *quality_rules.COUNTS)
    want = [(r[0], *counts(r[1])) for r in rows]
    assert sorted((tuple(r[n] for n in names) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert (r.base_failed, r.kept) == (failed, not failed)


def test_statistics_and_score_in_one_call(spark):
    docs = edge.with_clashes(edge.documents(spark, edge.texts()))
    x, y = data()
    trees = quality_rules.fit(x, y, np.array(list(quality_rules.FEATURES.values())))
    judged = quality_rules.judged(docs, trees)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow ") == 1
    known = quality_rules.with_statistics(docs, ["doc_id"]).collect()
    scores = quality_rules.score(trees, np.array([r.features for r in known]))
    want = sorted(((r.doc_id, s) for r, s in zip(known, scores.tolist())), key=repr)
    assert sorted(((r.doc_id, r.score) for r in judged.collect()), key=repr) == want


def data(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4))
    noise = rng.random(n) < 0.1
    return x, ((x[:, 0] + 0.3 * x[:, 1] > 0.6) ^ noise).astype(float)


def test_trees_learn_and_keep_their_direction():
    x, y = data()
    trees = quality_rules.fit(x, y, np.array([1, 0, -1, 0]))
    fresh, truth = data(seed=1)
    assert ((quality_rules.score(trees, fresh) > 0.5) == truth).mean() > 0.8
    for feature, direction in ((0, 1), (2, -1)):
        values = []
        for v in np.linspace(0, 1, 30):
            moved = fresh.copy()
            moved[:, feature] = v
            values.append(quality_rules.score(trees, moved))
        assert (np.diff(values, axis=0) * direction >= -1e-12).all()


def test_flat_trees_equal_a_walk():
    x, y = data()
    trees = quality_rules.fit(x, y, np.zeros(4), rounds=5)
    for row, p in zip(x[:50], quality_rules.score(trees, x[:50])):
        total = trees.base
        for node in trees.roots:
            while trees.below[node] != node:
                under = row[trees.feature[node]] <= trees.threshold[node]
                node = trees.below[node] if under else trees.above[node]
            total += trees.value[node]
        assert p == pytest.approx(1 / (1 + np.exp(-total)))


def test_rules_without_labels(spark):
    docs = edge.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], none.schema)
    for labels in (none, one):
        trees = quality_rules.fit_rules(docs, labels)
        assert {r.kept for r in quality_rules.judged(docs, trees).where("NOT base_failed").collect()} == {True}
    assert quality_rules.judged(edge.documents(spark, []), trees).count() == 0


MIDDLE = SMALL.replace("0.001", "0.01")


def test_rules_on_documents_held_out(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    trees = quality_rules.fit_rules(docs, labels.where("doc_id % 3 > 0"))
    judged = quality_rules.judged(docs, trees).join(labels, "doc_id").where("doc_id % 3 = 0")
    rows = judged.where("NOT base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in rows]) > 0.95


def test_classifier_on_documents_held_out(spark):
    rows = queries.op6_quality_classifier(spark, MIDDLE).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{MIDDLE}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.9


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    weights = {k: v.astype(np.float64) for k, v in quality_model.initial(1, 4, 3, 5).items()}
    sizes = (10, 1500, 3000)
    texts = [quality_model.chunks_of(bytes(rng.integers(32, 127, n, dtype=np.uint8))) for n in sizes]
    truth = np.array([0, 1, 0])
    starts = np.cumsum([0] + [len(t) for t in texts[:-1]])

    def loss(w):
        features = quality_model.chunk_features(w, np.concatenate(texts))
        p = quality_model.combined(w, features, starts)
        return -(truth * np.log(p) + (1 - truth) * np.log(1 - p)).mean()

    found = quality_model.gradients(weights, texts, truth)
    for name in weights:
        place = (65, 1) if name == "embed" else tuple(rng.integers(0, s) for s in weights[name].shape)
        up, down = ({k: v.copy() for k, v in weights.items()} for _ in range(2))
        up[name][place] += 1e-5
        down[name][place] -= 1e-5
        assert found[name][place] == pytest.approx((loss(up) - loss(down)) / 2e-5, abs=1e-5)


def test_chunks_cover_everything():
    for size in (0, 1, 63, 64, 65, 1023, 1024, 1025, 1984, 1985, 50_000):
        data = bytes(np.random.default_rng(size).integers(1, 256, size, dtype=np.uint8))
        chunks = quality_model.chunks_of(data)
        step = quality_model.CHUNK - quality_model.OVERLAP
        joined = b"".join(c[:step].tobytes() for c in chunks[:-1]) + chunks[-1].tobytes()
        assert joined.rstrip(b"\0") == data and len(chunks) <= size // step + 1


def test_classifier_edges(spark):
    docs = edge.with_clashes(edge.documents(spark))
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (4, 0), (6, None)], "doc_id long, quality int"
    )
    for some in (labels, labels.where("quality = 1"), labels.where("false")):
        weights = quality_model.learn(docs, some, steps=5)
        rows = quality_model.scored(docs, weights).collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert quality_model.scored(edge.documents(spark, []), weights).count() == 0
    whole = quality_model.probabilities(weights, [r[1] or "" for r in edge.texts()])
    for text, p in zip(edge.texts(), whole):
        assert quality_model.probabilities(weights, [text[1] or ""])[0] == pytest.approx(p, abs=1e-5)


def test_languages_held_out(spark):
    rows = queries.op3_language_id(spark, MIDDLE).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.95


def test_language_edges(spark):
    docs = edge.with_clashes(edge.documents(spark))
    contents = language.dictionaries(docs)
    assert sorted(contents) == ["de", "en", "fr"]
    got = {r.doc_id: r for r in language.predicted(docs, contents).collect()}
    for doc in (3, 4, 5, 11):
        assert (got[doc].lang_pred, got[doc].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 and r.lang_pred in {*contents, "und"} for r in got.values())
    assert {r.lang_pred for r in language.predicted(docs, {}).collect()} == {"und"}
    alone = language.predicted(docs, {"xx": b"abc"}).where("lang_pred <> 'und'").collect()
    assert {(r.lang_pred, r.score) for r in alone} == {("xx", 1.0)}
    nothing = edge.documents(spark, [])
    assert language.dictionaries(nothing) == {}
    assert language.predicted(nothing, contents).count() == 0


def test_narrow_margins_are_not_accepted():
    name, score, margin = language.verdict(["a", "b"], [100, 100], 4.0)
    assert (name, score, margin) == ("a", 0.5, 0.0)
    name, score, margin = language.verdict(["a", "b"], [120, 60], 4.0)
    assert name == "b" and score > 0.99 and margin == 0.5


def test_copies_do_not_use_up_a_dictionary(spark):
    rows = [(i, f"text number {i % 40 if i < 40 else 0}", "en", None) for i in range(400)]
    rows += [(1000 + i, f"text number {i % 40}", "en", None) for i in range(4000)]
    found = language.dictionaries(edge.documents(spark, rows), documents=30)
    assert len(found["en"].decode().split("\n")) == 30
