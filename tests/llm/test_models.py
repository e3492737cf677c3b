"""Verdicts and fits of the learned operators against plain versions."""

import math
import random

import numpy as np
import pytest

from lessonlens.llm import perplexity, quality
from llm_rows import DOCUMENT

LARGER = "/root/testdata/sf0.01"      # enough labels for the classifier to reject any


# ---- quality: the trees, and pipeline stage 1

def plain_boost(x, y, trees, depth, rate=0.15, ridge=2.0, least=3.0):
    """Margins after each tree grown node by node, every cut of every statistic tried on its rows."""
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    margin = np.full(len(x), math.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, quality.BINS + 1)[1:-1])) for k in range(x.shape[1])]

    def leaf(rows, g, h, level):
        if level == depth:
            return [(rows, -rate * g[rows].sum() / (h[rows].sum() + ridge))]
        best, split = 1e-9, None
        gt, ht = g[rows].sum(), h[rows].sum()
        for k, edges in enumerate(cuts):
            for c in edges:
                left = x[rows, k] <= c
                gl, hl = g[rows][left].sum(), h[rows][left].sum()
                if hl < least or ht - hl < least:
                    continue
                gain = gl ** 2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt ** 2 / (ht + ridge)
                if gain > best + 1e-9:
                    best, split = gain, left
        if split is None:       # all go left, down to one leaf
            return leaf(rows, g, h, level + 1)
        return leaf(rows[split], g, h, level + 1) + leaf(rows[~split], g, h, level + 1)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        for rows, value in leaf(np.arange(len(x)), g, h, 0):
            margin[rows] += value
    return 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("seed", [0, 1])
def test_grown_trees_against_plain_ones(seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(160, 4)).astype(np.float32)
    x[:, 3] = rng.integers(0, 3, 160)
    y = ((x[:, 0] + 0.5 * x[:, 1] * x[:, 3] + 0.3 * rng.normal(size=160)) > 0).astype(np.float64)
    grown = quality.grow(x, y, trees=6, depth=3)
    assert np.allclose(grown.score(x), plain_boost(x, y, 6, 3), atol=1e-9)


def test_stage_one_keeps_what_the_classifier_accepts(llm, odd):
    documents, labels = (llm.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    odd_labels = labels.limit(2).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" if c == "doc_id" else c for c, t in labels.dtypes])
    repeated = labels.unionByName(labels.limit(20)).unionByName(odd_labels)
    for said in (labels, repeated):
        scored = {r.doc_id: r for r in quality.scores(documents, said).collect()}
        accepted = sorted(d for d, r in scored.items() if r.score >= quality.THRESHOLD)
        assert sorted(r.doc_id for r in quality.keep(documents, said).collect()) == accepted
        assert 0 < len(accepted) < len(scored)
        assert all(r.predicted == (r.score >= 0.3) for r in scored.values())
    kept = quality.keep(odd, labels)
    want = sorted(((r.doc_id, r.score >= quality.THRESHOLD) for r in quality.scores(odd, labels).collect()), key=repr)
    assert kept.columns == odd.columns and kept.count() == sum(ok for _, ok in want)
    assert quality.keep(documents, labels.limit(0)).count() in (0, documents.count())       # no labels: one score for all


# ---- perplexity: verdicts

def plain_verdicts(rows):
    """Bands by sorting each language's values, then every row against its band."""
    logs = {}
    for r in rows:
        if not r.base_failed and r.perplexity is not None:
            logs.setdefault(r.lang, set()).add((r.n_words, r.word_chars, round(math.log(r.perplexity), 9)))
    bands = {}
    for lang, values in logs.items():
        v = sorted(x[2] for x in values)
        q = [v[max(0, math.ceil(p * len(v)) - 1)] for p in (0.25, 0.5, 0.75)]
        beyond = perplexity.REACH * (q[2] - q[0])
        bands[lang] = (min(q[0] - beyond, q[1] - perplexity.LEAST), max(q[2] + beyond, q[1] + perplexity.LEAST))
    out = []
    for r in rows:
        inside = True
        if r.perplexity is not None and r.lang in bands:
            noise = perplexity.NOISE / math.sqrt(max(1, r.word_chars))
            inside = bands[r.lang][0] - noise <= math.log(r.perplexity) <= bands[r.lang][1] + noise
        out.append((r.doc_id, not r.base_failed and inside))
    return sorted(out, key=repr)


def test_verdicts_of_planted_texts(llm):
    """Gibberish falls out of its language's band, and nothing else does that plain bands keep."""
    rng = random.Random(1)
    documents = llm.read.parquet(f"{LARGER}/documents.parquet")
    some = [(r.doc_id, r.text, r.lang) for r in documents.where("lang is not null").collect()]
    langs = sorted({x[2] for x in some})
    gibberish = [(10_000 + k, " ".join("".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(9)) for _ in range(120)), lang)
                 for k, lang in enumerate(langs)]
    alone = [(20_000, "word " * 3 + " ".join(f"plain{k} text" for k in range(60)), "unseen"), (20_001, "short", None), (20_002, None, None)]
    frame = llm.createDataFrame([(d, t, g, "s", len(t or "")) for d, t, g in some + gibberish + alone], DOCUMENT)
    got = perplexity.rules(frame).join(frame.select("doc_id", "lang"), "doc_id").collect()
    assert sorted(((r.doc_id, r.kept) for r in got), key=repr) == plain_verdicts(got)
    kept = {r.doc_id: r.kept for r in got}
    assert not any(kept[d] for d, _, _ in gibberish)
    assert kept[20_000] and not kept[20_001] and not kept[20_002]
    normal = [r for r in got if r.doc_id < 10_000 and not r.base_failed]
    assert sum(r.kept for r in normal) > 0.9 * len(normal)
