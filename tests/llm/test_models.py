"""Learnt operators, embeddings and the pipeline."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lettings.llm import catalog, common, contamination, language, pii, quality, simhash, vectors

FOLDER = "/root/testdata/sf0.01"


def test_quality_separates_held_out_rows(spark):
    labels = common.table(spark, FOLDER, "labels")
    found = catalog.quality_query(spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 40
    assert sum(r.predicted == r.quality for r in rows) / len(rows) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    documents = common.table(spark, FOLDER, "documents")
    labels = common.table(spark, FOLDER, "labels")
    held = common.held_out(labels["doc_id"])
    turned = labels.selectExpr("doc_id", "quality").withColumn("quality", (1 - labels["quality"]))
    mixed = labels.filter(~held).select("doc_id", "quality").unionByName(turned.filter(held))
    one = {r.doc_id: r.score for r in quality.scored(documents, labels).collect()}
    other = {r.doc_id: r.score for r in quality.scored(documents, mixed).collect()}
    assert all(math.isclose(one[key], other[key], abs_tol=1e-6) for key in one)


def test_quality_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "some text", None), (2, "", "x"), (3, "a " * 50_000, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string, stats string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.scored(documents, none).collect()
    assert len(found) == 5 and all(abs(r.score - 0.5) < 0.01 for r in found)
    odd = spark.createDataFrame([(1, None), (2, 1), (2, 0), (None, 1), (3, 1)], "doc_id long, quality int")
    assert quality.scored(documents, odd).count() == 5
    kept = quality.accepted(documents, none)
    assert kept.columns == documents.columns and kept.count() == 5
    assert quality.scored(documents.limit(0), odd).count() == 0


def test_pooling_is_isotonic_and_keeps_the_mean():
    counts, sums = np.array([1.0, 2, 1, 4]), np.array([1.0, 0, 1, 3])
    values = quality.pool(counts, sums)
    assert (np.diff(values) >= 0).all()
    assert math.isclose((values * counts).sum(), sums.sum())
    assert np.allclose(values, [1 / 3, 1 / 3, 0.8, 0.8])


def isotone(values, weights):
    """The monotone fit by its formula: the greatest of the means before, the least of those after."""
    def mean(a, b):
        return sum(v * w for v, w in zip(values[a:b], weights[a:b], strict=True)) / sum(weights[a:b])

    many = len(values)
    return [max(min(mean(a, b) for b in range(i + 1, many + 1)) for a in range(i + 1)) for i in range(many)]


def test_quality_equals_an_exact_ridge_fit_and_its_isotonic_steps(spark):
    documents = common.table(spark, FOLDER, "documents")
    labels = common.table(spark, FOLDER, "labels")
    stats = quality.measured(documents)
    model = quality.fit(stats, labels)
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(10)).alias("part")
    rows = stats.join(labels.select(F.col("doc_id").alias("key"), "quality"), "key")
    rows = [r for r in rows.select("key", "stats", "quality", part).collect() if not common.is_held_out(r.key)]
    table = np.array([r.stats for r in rows])
    y = np.array([r.quality for r in rows], float)
    fitted = np.array([r.part < 8 for r in rows])
    assert np.allclose(model.mean, table.mean(0)) and np.allclose(model.scale, np.maximum(table.std(0), 1e-9))
    waves = quality.spread(table, model.mean, model.scale)
    # Ridge as least squares with one more row a weight, without normal equations.
    width = waves.shape[1]
    penalty = np.sqrt(np.r_[np.full(width - 1, max(0.02, 2e-5 * fitted.sum())), 1e-9])
    whole = np.vstack([waves[fitted], np.diag(penalty)])
    exact = np.linalg.lstsq(whole, np.r_[y[fitted], np.zeros(width)], rcond=None)[0]
    assert np.allclose(waves @ model.weights, waves @ exact, atol=1e-5)
    raw = waves[~fitted] @ model.weights
    steps = np.floor(np.clip(raw, quality.LOWEST, quality.HIGHEST) / quality.STEP).astype(int)
    kinds = sorted(set(steps.tolist()))
    weights = [int((steps == k).sum()) for k in kinds]
    means = [float(y[~fitted][steps == k].mean()) for k in kinds]
    total = sum(weights)
    wanted = [(v * total + 0.5) / (total + 1) for v in isotone(means, weights)]
    assert np.allclose(model.values, wanted) and np.allclose(model.edges, (np.array(kinds) + 0.5) * quality.STEP)


def test_languages_of_held_out_rows(spark):
    documents = common.table(spark, FOLDER, "documents")
    found = catalog.language_query(spark, FOLDER)
    assert found.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.97


def test_languages_of_odd_rows(spark):
    rows = [(i, "the cat and the dog are here", "en") for i in range(40)]
    rows += [(i, "der hund und die katze sind hier", "de") for i in range(40, 80)]
    rows += [(90, None, "en"), (91, "", "en"), (92, "12 34 !!", None), (93, "und der hund", None), (None, "the dog", "en")]
    rows += [(93, "und der hund", None), (94, "the and " * 20_000, None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = Counter((r.doc_id, r.lang_pred) for r in language.identified(documents).collect() if r.doc_id is None or r.doc_id >= 90)
    assert found == {(90, "und"): 1, (91, "und"): 1, (92, "und"): 1, (93, "de"): 2, (94, "en"): 1, (None, "en"): 1}
    nothing = documents.withColumn("lang", documents["lang"].substr(9, 1)).filter("lang = 'x'")
    assert language.identified(nothing).count() == 0
    unknown = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identified(unknown).collect()] == ["und"]


def invented(names, rows):
    """Texts of languages with words of their own: (doc_id, text, lang), ids that are not held out first."""
    random = np.random.default_rng(5)
    ids = (i for i in range(10**6) if not common.is_held_out(i))
    found = []
    for name in names:
        words = ["".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), random.integers(3, 8))) for _ in range(30)]
        found += [(next(ids), " ".join(random.choice(words, 25)), name) for _ in range(rows)]
    return found


def test_descent_equals_a_plain_softmax_step_by_step(monkeypatch):
    """The draws are those of ``train``; every step is written out number by number."""
    monkeypatch.setattr(language, "EPOCHS", 2)
    monkeypatch.setattr(language, "LEAST_STEPS", 1)
    monkeypatch.setattr(language, "_BUCKETS", 40)
    maker = np.random.default_rng(8)
    rows = []
    for name in ("a", "b", "c"):
        for _ in range(4):  # fewer than five rows a language: all are learnt
            buckets = np.sort(maker.choice(40, 6, replace=False))
            rows.append((name, buckets, maker.dirichlet(np.ones(6))))
    found = language.train(rows, ["a", "b", "c"])
    random = np.random.default_rng(3)
    order = random.permutation(12).tolist()
    size = language.DIMENSIONS
    e = random.normal(0, 0.1, (40, size)).tolist()
    w = random.normal(0, 0.1, (size, 3)).tolist()
    bias = [0.0] * 3
    step = 0
    for _ in range(2):
        for at in random.permutation(12).tolist():
            name, buckets, shares = rows[order[at]]
            pairs = list(zip(buckets.tolist(), shares.tolist(), strict=True))
            rate = language.RATE * (1 - step / 24)
            step += 1
            mean = [sum(share * e[b][d] for b, share in pairs) for d in range(size)]
            powers = [math.exp(sum(mean[d] * w[d][c] for d in range(size)) + bias[c]) for c in range(3)]
            error = [p / sum(powers) - (c == "abc".index(name)) for c, p in enumerate(powers)]
            back = [sum(w[d][c] * error[c] for c in range(3)) for d in range(size)]
            for c in range(3):
                bias[c] -= 0.1 * rate * error[c]
                for d in range(size):
                    w[d][c] -= rate * mean[d] * error[c]
            for b, share in pairs:
                for d in range(size):
                    e[b][d] -= rate * 20 * share * back[d]
    assert np.allclose(found.table, np.array(e) @ np.array(w), atol=1e-5)
    assert np.allclose(found.bias, bias)


def test_the_sample_is_bounded_over_all_languages_and_subwords(monkeypatch):
    assert language.rows_of_each(0) == language.rows_of_each(4) == language.PER_LANGUAGE
    assert language.rows_of_each(200) * 200 <= language.SAMPLE_ROWS
    assert language.rows_of_each(10**6) == language.LEAST_STEPS
    text = "aaab aaab aaab zq zq xy"
    buckets, shares = language.shares_of(text)
    counts = Counter(language.subwords([text])[0].tolist())
    assert dict(zip(buckets.tolist(), shares.tolist(), strict=True)) == {b: n / counts.total() for b, n in counts.items()}
    monkeypatch.setattr(language, "SUBWORDS", 5)
    most = sorted(counts, key=lambda b: (-counts[b], b))[:5]
    kept, own = language.shares_of(text)
    assert kept.tolist() == sorted(most)
    assert np.allclose(own, [counts[b] / counts.total() for b in sorted(most)])
    assert len(language.shares_of("")[0]) == 0


def test_more_languages_than_sixty_four(spark):
    given = invented([f"l{i:02}" for i in range(80)], 20)
    # One language has more rows than are sampled.
    given += [(10**6 + i, "zzy qqx wwk vvj", "often") for i in range(1000)]
    asked = [(-1 - i, text, None) for i, (_, text, _) in enumerate(given[:1600:7])]
    documents = spark.createDataFrame(given + asked, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identified(documents).collect()}
    wanted = {-1 - i: lang for i, (_, _, lang) in enumerate(given[:1600:7])}
    right = [lang for key, lang in wanted.items() if found[key] == lang]
    assert len(right) / len(wanted) >= 0.97
    assert len(set(right)) == 80


def test_languages_of_one_to_three_rows(spark):
    given = invented(["a", "b", "c", "d"], 60)
    rare = invented([f"r{i}" for i in range(9)], 16)[:]
    # The invented words of the second call are those of the first four languages again, so skip these.
    rare = [x for x in rare if x[2] not in ("r0", "r1", "r2", "r3")]
    learnt = [x for at, x in enumerate(rare) if at % 16 < 1 + at // 16 % 3]
    asked = [(-1 - at, text, lang) for at, (_, text, lang) in enumerate(rare) if at % 16 > 2]
    rows = given + [(10**6 + 10 * at + next(i for i in range(10) if not common.is_held_out(10**6 + 10 * at + i)), text, lang) for at, (_, text, lang) in enumerate(learnt)]
    rows += [(key, text, None) for key, text, _ in asked]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r.lang_pred for r in language.identified(documents).collect()}
    right = [lang for key, _, lang in asked if found[key] == lang]
    assert len(right) / len(asked) >= 0.9
    assert len(set(right)) == 5


def brute_links(rows, threshold=0.93):
    units = [None if r[2] is None else vectors.unit(r[1]) for r in rows]
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
            if same and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return Counter((r[0], links[i], least.get(find(i)), r[0] is not None and r[0] == least.get(find(i))) for i, r in enumerate(rows))


@pytest.mark.parametrize("sizes", [{"cell": 40, "block": 8}, {}])
def test_vectors_against_brute_force(spark, sizes):
    random_state = np.random.default_rng(6)
    rows = []
    for group in range(40):
        centre = random_state.normal(size=12)
        for _ in range(group % 7 + 1):
            rows.append((len(rows), (centre + random_state.normal(0, 0.12, 12)).tolist(), group % 3))
    rows += [(900 + i, rows[0][1], 0) for i in range(30)]
    rows += [(800, None, 1), (801, [], 1), (802, [0.0] * 12, 1), (803, [1.0, None] * 6, 1), (804, [float("nan")] * 12, 1)]
    rows += [(805, [float("inf")] * 12, 1), (806, rows[0][1], None), (None, rows[1][1], rows[1][2]), (807, [3.0, 4.0], 1)]
    rows += [(808, [6.0, 8.0], 1), (809, [1e-300] * 12, 2), (810, [1e300] * 12, 2), (0, rows[0][1], 0), (None, None, None)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, links string")
    found = vectors.kept_and_linked(table.repartition(4), **sizes).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == brute_links(rows)
    assert vectors.kept_and_linked(table.limit(0)).count() == 0


def test_recall_of_cells_at_the_threshold(spark):
    state = np.random.default_rng(2)
    rows = []
    for _ in range(400):
        one = vectors.unit(state.normal(size=64).tolist())
        noise = state.normal(size=64)
        noise -= noise @ one * one
        other = 0.935 * one + math.sqrt(1 - 0.935**2) * noise / np.linalg.norm(noise)
        rows += [(len(rows), one.tolist(), 1), (len(rows) + 1, other.tolist(), 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in vectors.kept_and_linked(table, cell=50).collect()}
    assert sum(n >= 1 for n in found.values()) / len(rows) >= 0.99


@pytest.mark.parametrize(("components", "count", "cell"), [(2, 300, 100), (3, 600, 15), (6, 1500, 25)])
def test_no_link_is_lost_between_cells(spark, components, count, cell):
    units = np.random.default_rng(4).normal(size=(count, components))
    units /= np.linalg.norm(units, axis=1)[:, None]
    table = spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(units)], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in vectors.kept_and_linked(table, cell=cell).collect()}
    wanted = (units @ units.T >= vectors.THRESHOLD).sum(1) - 1
    assert found == dict(enumerate(wanted.tolist()))


def test_labels_have_cells_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(vectors, "ASSIGNED", 600)
    monkeypatch.setattr(vectors, "LEAST_ASSIGNED", 40)
    monkeypatch.setattr(vectors, "STRIPE", 7)
    state = np.random.default_rng(9)
    units = state.normal(size=(900, 4))
    units /= np.linalg.norm(units, axis=1)[:, None]
    labels = np.where(state.random(900) < 0.4, "hot", state.integers(0, 30, 900).astype(str))
    rows = [(i, x.tolist(), str(y)) for i, (x, y) in enumerate(zip(units, labels, strict=True))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = {r.vec_id: r.n_links for r in vectors.kept_and_linked(table, cell=20, block=16).collect()}
    wanted = ((units @ units.T >= vectors.THRESHOLD) & (labels[:, None] == labels)).sum(1) - 1
    assert found == dict(enumerate(wanted.tolist()))
    unit = "cast(cast(embedding as string) as binary) as unit"
    nodes = table.selectExpr("vec_id as node", "label", "1L as weight", "4 as width", unit)
    small = vectors._placed(nodes.filter("label != 'hot'"), 100, vectors.THRESHOLD)
    assert small.filter("cell != 0 or size(visits) != 1").count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage of the pipeline is given and returns."""
    docs = common.table(spark, FOLDER, "documents")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.stored(stage(spark, docs, FOLDER), name)
        seen.append(docs)
    return seen


def test_stages_keep_the_columns_but_the_last(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontamination", "personal_data", "packing"]


def test_stages_against_brute_force(spark, stages):
    texts = [{r.doc_id: r.text for r in docs.collect()} for docs in stages[:-1]]
    scores = {r.doc_id: r.predicted for r in quality.scored(stages[0], common.table(spark, FOLDER, "labels")).collect()}
    assert texts[1] == {key: text for key, text in texts[0].items() if scores[key]}
    prints = {key: simhash.fingerprint(text) for key, text in texts[1].items()}
    parent = {key: key for key in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ordered = sorted(prints)
    values = np.array([prints[key] for key in ordered], np.uint64)
    for i, key in enumerate(ordered):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= 2).tolist():
            a, b = find(key), find(ordered[i + 1 + j])
            parent[max(a, b)] = min(a, b)
    assert set(texts[2]) == {find(key) for key in ordered}
    windows = set()
    for item in common.table(spark, FOLDER, "benchmark").collect():
        words = contamination.words_of(item.text)
        windows |= {tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12) if words else 0)}
    widths = {len(w) for w in windows}

    def contaminated(text):
        words = contamination.words_of(text)
        hit = {i + k for n in widths for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for k in range(n)}
        return bool(hit) and 20 * len(hit) >= len(words)

    assert texts[3] == {key: text for key, text in texts[2].items() if not contaminated(text)}
    assert set(texts[4]) == set(texts[3])
    assert all(text == texts[3][key] or "[" in text for key, text in texts[4].items())
    assert not any(pii.base_spans(text) for text in texts[4].values())
    assert all(r.n_chars == len(r.text) for r in stages[4].collect())
    pieces = Counter(r.doc_id for r in stages[5].collect() if r.piece == 0)
    assert pieces == Counter(list(texts[4]))


def test_pipeline_of_empty_and_odd_documents(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "a b c", "en", "s", 5, None)]
    rows += [(2, "", "en", "s", 0, "x"), (4, "mail a@b.cd " * 9_000, "en", "s", 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row_number string")
    for given in (docs, docs.limit(0)):
        found = given
        for name, stage in corpus_pipeline.STAGES:
            found = common.stored(stage(spark, found, FOLDER), name)
            if name != "packing":
                assert found.columns == docs.columns
        assert (found.count() > 0) == (given.count() > 0)


def test_samples_do_not_depend_on_partitions(spark):
    keys = spark.range(1000).withColumnRenamed("id", "key")
    chosen = keys.filter(common.in_sample(keys["key"], 0.3, "seed"))
    other = keys.repartition(7).filter(common.in_sample(keys["key"], 0.3, "seed"))
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, other.collect()))
    assert 200 < chosen.count() < 400


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 11))
