"""Likeness of long texts with repeated words, and pages with broken markup."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metrolens.llm import cws, main_text


def generalised_jaccard(x, y):
    a, b = (collections.Counter(zip(w, w[1:])) for w in (x.split(), y.split()))
    return sum((a & b).values()) / sum((a | b).values())


def weighted_text(name, n, heavy):
    """n pairs of neighbouring words or so, of which every second is there ``heavy`` times."""
    words = []
    for i in range(n // 2):
        words += [f"{name}x{i}", f"{name}y{i}"] * (heavy if i % 2 else 1)
    return " ".join(words)


@pytest.mark.parametrize("n", [200, 10_000, 50_000])
def test_likeness_is_unbiased_at_any_length(spark, n):
    pairs = 4
    rows, want = [], []
    for k in range(pairs):
        x, y = weighted_text(f"d{k}", n, 1), weighted_text(f"d{k}", n, 4)
        rows += [(10 * k + 1, x), (10 * k, y)]
        want.append(generalised_jaccard(x, y))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r.near_next for r in cws.fingerprints(docs, samples=64).collect() if r.doc_id % 10 == 1]
    sd = 0.5 / (64 * pairs) ** 0.5
    assert 0.3 < np.mean(want) < 0.5
    assert abs(np.mean(got) - np.mean(want)) < 3.5 * sd


def test_end_steps_of_gamma(spark):
    u = [1e-9, 1e-4, 0.3, 0.999999]
    rows = spark.createDataFrame([(x,) for x in u], "u double").select(cws.least_gamma(F.col("u")).alias("lo"), cws.greatest_gamma(F.col("u")).alias("hi")).collect()
    for x, r in zip(u, rows):
        p = x / cws.GAMMA_STEPS
        assert -np.expm1(-r.lo) - r.lo * np.exp(-r.lo) == pytest.approx(p, rel=1e-3)
        assert (1 + r.hi) * np.exp(-r.hi) == pytest.approx(p, rel=1e-3)


PAGE = """<!DOCTYPE html><html><head><title>t</title></head><body><nav>menu</nav><article><h1>Head</h1><p>One &amp; two.</p>
<![CDATA[x]]><div class="x">More <b>text</b></div></article><footer>foot</footer></body></html>"""


def test_broken_declarations_are_comments():
    assert main_text.article_text(main_text.page_blocks("<article><p>a</p><![foo[bar]]><p>b</p></article>")) == "a\nb"
    assert main_text.article_text(main_text.page_blocks("<article><p>a</p><![if !IE]><p>b</p><![endif]><p>c")) == "a\nb\nc"


def test_no_mangled_page_ends_the_parser():
    rng = random.Random(12)
    marks = ["<![", "<!", "<!--", "-->", "]]>", "<", ">", "</", "&#", "&#x110000;", "&", '"', "'", "<?", "<script", "</script", "<![a[", "\x00", "<a b=", "<!DOCTYPE ["]
    for _ in range(10_000):
        page = PAGE
        for _ in range(rng.randint(1, 6)):
            at = rng.randrange(len(page))
            page = rng.choice([page[:at] + rng.choice(marks) + page[at:], page[:at] + page[at + rng.randint(1, 9):], page[:at], page + page[at:at + 30]]) or "<"
        main_text.article_text(main_text.page_blocks(page))


@pytest.mark.parametrize("part", ['<div class="comment">gone</div>', '<ol class="commentlist"><li>gone</li></ol>', '<section class="comment-section">gone</section>',
                                  '<div class="notice">gone</div>', '<div class="related">gone</div>', '<div class="share">gone</div>'])
def test_comments_and_notices_inside_articles_go(part):
    assert main_text.article_text(main_text.page_blocks(f"<article><p>Text</p>{part}<p class='commentary'>stays</p></article>")) == "Text\nstays"
