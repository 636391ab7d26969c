"""Scores by plain loops, and networks that do not depend on how a table lies in partitions."""

import math

import numpy as np
from skyledger.llm import lm_scoring
from skyledger.llm.words import hashed_words
from tests.conftest import SF


def plain_score(network, text):
    """The sum of log P(word | window), word by word; also the sum over all buckets of P(bucket | first window)."""
    words = text.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for w in words if w]
    buckets = [int(hashed_words([w])[0][0]) >> (65 - network.layout.n.bit_length()) for w in words]
    beyond, total, mass = 2 * network.layout.frequent, 0.0, None
    for k, bucket in enumerate(buckets):
        hidden = network.bias.astype(float).copy()
        for side, step in enumerate((-2, -1, 1, 2)):
            at = k + step
            hidden += network.embed[side][network.symbols[buckets[at]] if 0 <= at < len(words) else beyond]
        hidden = np.tanh(hidden)

        def log_softmax(x):
            return x - max(x) - math.log(sum(math.exp(v - max(x)) for v in x))

        by_class = log_softmax(hidden @ network.out + network.prior)
        own = int(network.classes[bucket])
        by_group = log_softmax(hidden @ network.fine[own] + network.fine_prior[own])
        total += by_class[own] + by_group[int(network.subs[bucket])] + network.within[bucket]
        if mass is None:
            groups = np.array([log_softmax(hidden @ network.fine[c] + network.fine_prior[c]) for c in range(lm_scoring.CLASSES)])
            mass = np.exp(by_class[network.classes] + groups[network.classes, network.subs] + network.within).sum()
    return len(words), total, mass


def test_scores_by_plain_loops(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    network = lm_scoring.fit(documents)
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {r.doc_id: r for r in lm_scoring.score(documents, network).collect()}
    short = sorted((k for k, t in texts.items() if t), key=lambda k: (len(texts[k]), k))[:25]
    for k in short:
        n, total, mass = plain_score(network, texts[k])
        assert got[k].n_words == n and abs(got[k].log_prob - total) < 1e-3 + 1e-5 * abs(total)
        assert mass is None or abs(mass - 1) < 1e-3


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TRAINER_CHARS", 60_000)
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")

    def scores(frame):
        return {r.doc_id: r.log_prob for r in lm_scoring.score(frame, lm_scoring.fit(frame)).collect()}

    one, many = scores(documents.coalesce(1)), scores(documents.repartition(7, "text"))
    assert one.keys() == many.keys() and len(one) > 100
    assert all(abs(one[k] - many[k]) <= 1e-3 + 1e-6 * abs(one[k]) for k in one)
    monkeypatch.setattr(lm_scoring, "TABLE_BUCKETS", 64)
    monkeypatch.setattr(lm_scoring, "CHUNK_CHARS", 50_000)
    first, second = scores(documents.coalesce(1)), scores(documents.repartition(5, "doc_id"))
    assert all(abs(first[k] - second[k]) <= 1e-3 + 1e-6 * abs(first[k]) for k in one)
