"""Models and flows against plain loops."""

import itertools
import math
import random

import numpy as np
import pandas as pd

from occflow.llm import flow_mix, language_id, quality_model
from occflow.llm.common import code_points


def test_codeword_decoding():
    rng = np.random.default_rng(1)
    for languages in (2, 3, 5, 9):
        code = language_id.codewords(languages)
        bits = code.shape[1]
        model = language_id.LanguageModel(
            [f"l{k}" for k in range(languages)], code, np.zeros((2, bits)), rng.uniform(0.5, 2, bits), rng.uniform(0.1, 1, bits)
        )
        margins = rng.normal(size=(40, bits))
        best, share, lead = language_id.decode(margins, model)
        for row, m in enumerate(margins):
            losses = [
                sum(r * math.log(1 + math.exp(-int(c) * 3 * x / s)) for c, x, s, r in zip(word, m, model.scale, model.reliability)) for word in code
            ]
            ranked = sorted(losses)
            assert best[row] == losses.index(ranked[0])
            assert math.isclose(lead[row], ranked[1] - ranked[0], abs_tol=1e-9)
            assert math.isclose(share[row], math.exp(-ranked[0]) / sum(math.exp(-x) for x in losses), rel_tol=1e-9)


def test_margins_of_many_texts_are_those_of_each_alone():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(1 << 10, 3))
    weights[0] = 0
    model = language_id.LanguageModel(["a", "b"], language_id.codewords(3), weights)
    texts = ["", None, "a", "Ab cd", "x" * 50, "1 2 3", "eine kleine Weile", "çà et là", " lead", "trail ", "é"] * 3
    margins, grams = language_id._margins(texts, model)
    for row, text in enumerate(texts):
        total, n = np.zeros(3), 0
        for bucket in language_id.gram_buckets(code_points([(text or "").lower()])[0], 10):
            for b in bucket:
                if b:
                    total += weights[b]
                    n += 1
        assert grams[row] == n
        assert np.allclose(margins[row], total / max(n, 1))


def test_updates_follow_the_regularised_leader():
    p = quality_model.FtrlParams(alpha=0.7, beta=1.0, l1=0.1, l2=0.3, bits=4)
    rng = random.Random(3)
    rows = []
    for _ in range(60):
        at = sorted(rng.sample(range(16), rng.randrange(1, 6)))
        rows.append((float(rng.randrange(2)), at, [rng.uniform(0.1, 1) for _ in at]))
    z, n = np.zeros(17), np.zeros(17)
    quality_model._learn(pd.DataFrame(rows, columns=["label", "bucket", "value"]), z, n, p)
    zs, ns = [0.0] * 17, [0.0] * 17

    def weight(i):
        if abs(zs[i]) <= p.l1:
            return 0.0
        return -(zs[i] - math.copysign(p.l1, zs[i])) / ((p.beta + math.sqrt(ns[i])) / p.alpha + p.l2)

    for label, at, values in rows:
        x = dict(zip([*at, 16], [*values, 1.0]))
        w = {i: weight(i) for i in x}
        chance = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
        for i, v in x.items():
            g = (chance - label) * v
            step = (math.sqrt(ns[i] + g * g) - math.sqrt(ns[i])) / p.alpha
            zs[i] += g - step * w[i]
            ns[i] += g * g
    assert np.allclose(z, zs) and np.allclose(n, ns)
    assert np.allclose(quality_model._weights(z, n, p), [weight(i) for i in range(17)])


def test_features_of_many_texts_are_those_of_each_alone():
    texts = ["", None, "A b b B", "One two, two one!", "x " * 30, "12 34 HELLO", "é è"]
    owner, bucket, value = quality_model.features(texts, 12)
    for row, text in enumerate(texts):
        alone, own, scaled = quality_model.features([text], 12)
        assert not len(alone) or set(alone) == {0}
        here = owner == row
        assert dict(zip(bucket[here], value[here])) == dict(zip(own, scaled))


def test_targets_fill_like_water():
    rng = random.Random(4)
    for _ in range(200):
        names = ["a", "b", "c", "d", "e"][: rng.randrange(1, 6)]
        sizes = {s: rng.randrange(1, 1000) for s in names}
        weights, most = (5, 2, 1), 2.0
        found = flow_mix.water_fill(sizes, weights, 1.5, most)
        # The level at which the filled sources hold 150 % of all, by halving.
        own = {s: weights[k % 3] for k, s in enumerate(sorted(sizes))}
        low, high = 0.0, 1e6
        for _ in range(200):
            level = (low + high) / 2
            held = sum(min(most * sizes[s], level * own[s]) for s in sizes)
            low, high = (level, high) if held < 1.5 * sum(sizes.values()) else (low, level)
        assert all(math.isclose(found[s], min(most * sizes[s], high * own[s]), rel_tol=1e-6) for s in sizes)


def cheapest(patterns, quotas, passes):
    """The most words that can be sent, and the fewest repeats at which they are, by trying all flows."""
    arcs = [(p, s) for p in patterns for s in p if s in quotas]
    best = (0, 0)
    for flow in itertools.product(*[range(min(passes * patterns[p], quotas[s]) + 1) for p, s in arcs]):
        sent = {p: 0 for p in patterns}
        got = {s: 0 for s in quotas}
        for (p, s), words in zip(arcs, flow):
            sent[p] += words
            got[s] += words
        if any(sent[p] > passes * patterns[p] for p in patterns) or any(got[s] > quotas[s] for s in quotas):
            continue
        # The second pass over a word costs 1, the third 2.
        cost = sum(sum(max(0, min(sent[p], (k + 1) * patterns[p]) - k * patterns[p]) * k for k in range(passes)) for p in patterns)
        best = min(best, (-sum(flow), cost))
    return -best[0], best[1]


def test_flows_send_the_most_at_the_least_cost():
    rng = random.Random(5)
    for _ in range(60):
        passes = rng.choice((1, 2, 3))
        patterns = {p: rng.randrange(1, 4) for p in rng.sample([("a",), ("b",), ("a", "b"), ("b", "c"), ("x",)], 3)}
        quotas = {s: rng.randrange(0, 6) for s in "abc"}
        plan = flow_mix.route(patterns, quotas, passes)
        sent = sum(w for cuts in plan.values() for stretch in cuts for _, w in stretch)
        cost = sum(k * w for cuts in plan.values() for k, stretch in enumerate(cuts) for _, w in stretch)
        assert (sent, cost) == cheapest(patterns, quotas, passes), (patterns, quotas, passes)
