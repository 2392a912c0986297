"""The trained operators: gradients, held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import language, quality, toxicity
from tarmac.llm.buffers import blocks


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_chain_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(5)
    counts = np.array([1, 4, 2, 6])
    odds, ties = rng.normal(size=counts.sum()) * 2, rng.normal(size=(2, 2))
    good, pairs = quality.marginals(odds, ties, counts)
    at = 0
    for n in counts:
        own = odds[at : at + n]
        weights = {}
        for code in range(2**n):
            y = [(code >> i) & 1 for i in range(n)]
            weights[tuple(y)] = np.exp(own @ y + sum(ties[a, b] for a, b in zip(y, y[1:], strict=False)))
        total = sum(weights.values())
        for i in range(n):
            assert good[at + i] == pytest.approx(sum(w for y, w in weights.items() if y[i]) / total)
            if i:
                for a in (0, 1):
                    for b in (0, 1):
                        expected = sum(w for y, w in weights.items() if (y[i - 1], y[i]) == (a, b)) / total
                        assert pairs[a, b, at + i] == pytest.approx(expected)
        at += n


def test_long_chains_do_not_underflow():
    good, _ = quality.marginals(np.full(5000, -9.0), np.array([[2.0, -2.0], [-2.0, 2.0]]), np.array([5000]))
    assert np.isfinite(good).all() and good.max() < 1e-3


def test_backpropagation_against_differences():
    rng = np.random.default_rng(0)
    reader = language.Reader.fresh(rng)
    reader.table, reader.inner = reader.table.astype(np.float64), reader.inner.astype(np.float64)
    bytes_at = rng.integers(0, 4, (5, 3)).astype(np.intp)
    weights = rng.normal(size=(5, language.STATES, 3))

    def loss():
        h, total = np.zeros((language.STATES, 3)), 0.0
        for t in range(4, -1, -1):
            s = language.STATES
            into, from_h = reader.table[:, bytes_at[t]], reader.inner @ h
            gates = np.clip(into[: 2 * s] + from_h[: 2 * s], 0, 1)
            c = np.clip(into[2 * s :] + gates[s:] * from_h[2 * s :], -1, 1)
            h = c + gates[:s] * (h - c)
            out[t] = h
            total += (weights[t] * h).sum()
        return total

    out = np.zeros((5, language.STATES, 3))
    loss()
    slopes = reader.learn(range(4, -1, -1), bytes_at, out.copy(), weights)
    for values, slope in zip((reader.table, reader.inner), slopes, strict=True):
        for _ in range(40):
            i, j = rng.integers(values.shape[0]), rng.integers(4 if values is reader.table else values.shape[1])
            old, step = values[i, j], 1e-6
            values[i, j] = old + step
            up = loss()
            values[i, j] = old - step
            down = loss()
            values[i, j] = old
            assert slope[i, j] == pytest.approx((up - down) / (2 * step), abs=2e-3)


def test_pairs_of_terms_are_learned():
    """Two terms are toxic together only, which no sum of weights can tell."""
    texts, labels = [], []
    for i in range(400):
        a, b = i % 2, (i // 2) % 2
        texts.append(f"filler{i % 7} " + "insulting " * a + "groupname " * b)
        labels.append(float(a and b))
    block = next(blocks(pa.array(texts)))
    found, counts = toxicity.terms(block)
    machine = toxicity.fit(found, counts, np.array(labels), epochs=60)
    assert ((toxicity.sigmoid(machine.raw(found, counts)) >= 0.5) == np.array(labels)).all()


@pytest.mark.parametrize("others", [10, 150])
def test_a_term_neutral_alone_is_learned_beside_another(others):
    """A group mention is as frequent in toxic texts as in the rest, and an insult alone is not toxic."""
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(4000):
        insult, group = i % 6 == 0, i % 5 == 0
        slur = i % 6 == 1 and not group
        own = ["insulting"] * insult + ["groupname"] * group + ["slurword"] * slur
        texts.append(" ".join(rng.permutation([f"w{int(k)}q" for k in rng.pareto(1.0, others) * 5] + own)))
        labels.append(float(insult and group or slur))
    labels = np.array(labels)
    group = np.array(["groupname" in t for t in texts])
    assert labels[group].mean() == pytest.approx(labels[~group].mean(), abs=0.005)
    blocks_of = [toxicity.terms(next(blocks(pa.array(part), 1 << 30))) for part in (texts[:3000], texts[3000:])]
    machine = toxicity.fit(*blocks_of[0], labels[:3000])
    found = toxicity.sigmoid(machine.raw(*blocks_of[1])) >= 0.5
    assert np.mean(found == labels[3000:]) >= 0.995


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.01"
    return {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels")}


def accuracy(scored, truth, column, label):
    rows = scored.where("held_out").join(truth, "doc_id").select(column, label).collect()
    return np.mean([r[0] == r[1] for r in rows])


def test_quality_of_held_out_documents(larger):
    scored = quality.digest(larger["documents"], quality.train(larger["documents"], larger["labels"]))
    assert accuracy(scored, larger["labels"], "predicted", "quality") >= 0.97


def test_toxicity_of_held_out_documents(larger):
    scored = toxicity.score(larger["documents"], toxicity.train(larger["documents"], larger["labels"]))
    assert accuracy(scored, larger["labels"], "predicted", "toxic") >= 0.94


def test_language_of_held_out_documents(larger):
    network = language.train(larger["documents"])
    found = language.predict(larger["documents"], network)
    assert accuracy(found, larger["documents"], "lang_pred", "lang") >= 0.97


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_odd_rows_are_scored(spark, odd, odd_rows):
    labels = labels_of(spark, [(k, k % 2, (k + 1) % 2) for k, _ in odd_rows if k] + [(None, 1, 1), (1, 0, 0), (2, None, None)])
    for scored in (
        quality.digest(odd, quality.train(odd, labels)),
        toxicity.score(odd, toxicity.train(odd, labels)),
    ):
        rows = scored.collect()
        assert sorted((str(r.doc_id), r.held_out) for r in rows) == sorted((str(k), held(k)) for k, _ in odd_rows)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
        assert len({r.score for r in rows if r.doc_id == 1}) == 1
    network = language.train(odd)
    rows = {r.doc_id: r for r in language.predict(odd, network).collect()}
    assert {k for k in rows if rows[k].lang_pred == "und"} >= {5, 6, 7}
    assert rows[1].lang_pred == "en" and 0 <= rows[1].score <= 1


def test_quality_keeps_columns(spark, odd):
    field = quality.train(odd, labels_of(spark, [(1, 1, 0), (2, 1, 0), (4, 1, 0)]))
    kept = quality.keep_good(odd, field)
    assert kept.columns == odd.columns and {r.score for r in kept.collect()} == {"x"}


def test_nothing_to_learn_from(spark, odd, no_documents):
    none = labels_of(spark, [])
    assert quality.digest(odd, quality.train(odd, none)).count() == odd.count()
    assert toxicity.score(odd, toxicity.train(odd, none)).count() == odd.count()
    assert {r.lang_pred for r in language.predict(odd, language.train(no_documents)).collect()} == {"und"}
    assert quality.digest(no_documents, quality.train(no_documents, none)).count() == 0
    assert toxicity.score(no_documents, toxicity.train(no_documents, none)).count() == 0
    assert language.predict(no_documents, language.train(odd)).count() == 0


SHORT = {
    "en": "the of and with this that from which have been their would there about other into through when where".split(),
    "de": "der die und nicht auch eine werden über für zwischen schon wieder können müssen gegen durch einen schön".split(),
    "fr": "le la une est pas que dans pour avec être été où leur même après tout bien très aussi chez".split(),
}


def _lines(lang, n, low, high, first):
    rnd = random.Random(f"{lang}{low}")
    return [(first + i, " ".join(rnd.choices(SHORT[lang], k=rnd.randint(low, high))), lang) for i in range(n)]


def test_languages_of_short_texts_only_are_learned(spark):
    """Two languages have only texts of less than 64 bytes, one is rare, and the third has long texts."""
    rows = _lines("en", 200, 2, 6, 0) + _lines("de", 40, 2, 6, 1000) + _lines("fr", 2000, 20, 60, 2000)
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language.train(documents, sample=300)
    assert network.languages == ["de", "en", "fr"]
    found = language.predict(documents, network).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    right = {r["lang"]: r["right"] for r in found.groupBy("lang").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")).alias("right")).collect()}
    assert min(right.values()) > 0.8, right
    only = language.train(documents.where("lang <> 'fr'"))
    assert {r[0] for r in language.predict(documents.where("lang = 'en'"), only).select("lang_pred").distinct().collect()} <= {"de", "en"}
