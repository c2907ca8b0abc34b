"""Deeply nested pages in linear time; Viterbi and training against enumeration."""

import itertools
import random
import time

import numpy as np
import pytest

from quarry.llm import html_text
from quarry.llm.crf import Chain


@pytest.mark.parametrize("unit", ["<div>x", "<b>x", "<p><i>x", "<blockquote><li>x", "<div>x</span>", "<ul><li>x</td>", "<a href=/>x<div>", "<td><option>x"])
def test_nesting_costs_linear_time(unit):
    seconds = []
    for n in (20_000, 100_000):
        began = time.process_time()
        got = html_text.blocks(unit * n)
        seconds.append(time.process_time() - began)
        assert sum(len(text.replace(" ", "")) for text, _ in got) == n
    assert seconds[1] < 20 and seconds[1] < 12 * seconds[0] + 1


def test_unmatched_end_tags_do_not_search_the_page():
    began = time.process_time()
    html_text.blocks("<div>" * 50_000 + "</p></b></x>" * 50_000)
    assert time.process_time() - began < 20


def score(chain, active, labels):
    out = chain.start[labels[0]] + sum(chain.unary[f, y].sum() for f, y in zip(active, labels, strict=True))
    return out + sum(chain.step[a, b] for a, b in itertools.pairwise(labels))


def random_chain(rng, features=6):
    chain = Chain(features)
    chain.unary, chain.step, chain.start = rng.normal(size=(features, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    return chain


def test_viterbi_equals_enumeration():
    rng, pick = np.random.default_rng(0), random.Random(0)
    for n in (1, 2, 3, 5, 8):
        for _ in range(20):
            chain = random_chain(rng)
            active = [sorted(pick.sample(range(6), pick.randint(0, 4))) for _ in range(n)]
            best = max(itertools.product((0, 1), repeat=n), key=lambda y: score(chain, active, y))
            assert chain.decode(active) == list(best)


def objective(chain, pages, l2):
    value = 0.0
    for active, labels in pages:
        every = [score(chain, active, y) for y in itertools.product((0, 1), repeat=len(active))]
        value += score(chain, active, labels) - np.logaddexp.reduce(every)
    return value / len(pages) - l2 / 2 * sum((p ** 2).sum() for p in (chain.unary, chain.step, chain.start))


def test_training_reaches_the_maximum_of_the_likelihood():
    rng, pick, l2 = np.random.default_rng(1), random.Random(1), 0.05
    pages = []
    for _ in range(25):
        active = [sorted(pick.sample(range(4), pick.randint(1, 3))) for _ in range(pick.randint(1, 5))]
        pages.append((active, [int((0 in f) ^ (rng.random() < 0.2)) for f in active]))
    chain = Chain(4).fit(pages, l2=l2, rounds=1500, rate=0.02)
    at = objective(chain, pages, l2)
    for p in (chain.unary, chain.step, chain.start):
        for i in np.ndindex(p.shape):
            kept, step = p[i], 1e-4
            p[i] = kept + step
            up = objective(chain, pages, l2)
            p[i] = kept - step
            down = objective(chain, pages, l2)
            p[i] = kept
            assert abs(up - down) / (2 * step) < 5e-3      # the numeric gradient vanishes
    assert at > objective(Chain(4), pages, l2)
