"""Texts that pages must not lose, and links that hashing must find."""

import numpy as np
import pytest

from tidemark.llm import embeddings, jaccard
from tidemark.llm.pages import main_text

STORY = "a long story of the river and the town " * 12


@pytest.mark.parametrize("html,text", [
    ('<body><form id="aspnetForm"><div><p>text</p></div></form></body>', "text"),
    (f'<body><form id="f"><header><a href="/">Home</a></header><div><p>{STORY}</p></div><footer>note</footer></form></body>', STORY.strip()),
    ('<article><section aria-label="The hidden river"><p>one</p></section><p title="A hidden gem">two</p><div data-css=" style=display:none">three</div></article>', "one\ntwo\nthree"),
    ("<article><p data-id='class=\"nav\"'>one</p><p hidden>two</p><p class=x hidden=hidden>three</p><p style='display: none'>four</p></article>", "one"),
    ('<div class="page footer"><p>the whole page</p></div>', "the whole page"),
    (f'<div><p>{STORY}</p></div><article><p>a teaser</p></article>', f"{STORY.strip()}\na teaser"),
    (f'<article><p>{STORY}</p></article><div><p>a note beside it</p></div>', STORY.strip()),
    ("<article><p>Let <math><mi>x</mi><annotation>x^2</annotation></math> be.</p></article>", "Let x be."),
    ('<article><div class="header"><h1>Title</h1></div><p>body</p></article>', "Title\nbody"),
    (f'<body><p>{STORY}</p><form><label>Search</label></form><footer>foot</footer><div class="comments"><p>a reader</p></div></body>', STORY.strip()),
    (f'<article><p>short</p></article><section class="comments"><p>{STORY}</p></section>', "short"),
])
def test_pages_keep_their_text(html, text):
    assert main_text(html) == text


def test_recall_of_links_at_the_threshold(spark):
    """6,000 vectors in four labels, one with half of them, and 1,200 partners at cosines of 0.93 to 0.95 with others'."""
    rng = np.random.default_rng(21)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    base = unit(rng.standard_normal((6000, 64)))
    label = rng.choice(4, 6000, p=[0.5, 0.25, 0.15, 0.1])
    whose = rng.choice(6000, 1200, replace=False)
    side = rng.standard_normal((1200, 64))
    side = unit(side - (side * base[whose]).sum(axis=1, keepdims=True) * base[whose])
    cosine = rng.uniform(0.9302, 0.95, (1200, 1))
    x = np.concatenate([base, cosine * base[whose] + np.sqrt(1 - cosine**2) * side]) * rng.uniform(0.1, 10, (7200, 1))
    label = np.concatenate([label, label[whose]])
    close = unit(x) @ unit(x).T
    close[label[:, None] != label[None, :]] = 0
    np.fill_diagonal(close, 0)
    want = (close >= 0.93).sum(axis=1)
    assert want.sum() >= 2400
    df = spark.createDataFrame([(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), label.tolist(), strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embeddings.near_vectors(df).collect()}
    links = np.array([got[i] for i in range(7200)])
    assert (links <= want).all()  # none below the threshold
    print("recall", links.sum() / want.sum())
    assert links.sum() >= 0.98 * want.sum()


def test_near_documents_whose_keys_unlike_sets_share_by_chance(spark, monkeypatch):
    """48 bits of a key travel, so in a large table sets of any size meet by chance under a key: that is no error and loses no link."""
    rows = []
    for g, size in enumerate((12, 60, 75, 300, 900)):  # one changed word each: a chain of near copies in each group
        words = [f"g{g}w{k}" for k in range(size)]
        rows += [(10 * g + i, " ".join([*words[: size - i], *(f"x{g}{i}{k}" for k in range(i))])) for i in range(2 + (size > 12))]
    df = spark.createDataFrame(rows, "doc_id long, text string")

    def met(near):
        keys = jaccard.shared_keys

        def by_chance(units, buckets):
            own = keys(units, buckets)
            return own.union(own.select("key", "low").distinct().crossJoin(units.select("node")).where("node > low").select("key", "node", "low"))

        with monkeypatch.context() as m:
            if near:
                m.setattr(jaccard, "shared_keys", by_chance)
            return {r.doc_id: r.component_id for r in jaccard.near_documents(df, 4, 85).collect()}

    want = met(False)
    assert set(want.values()) == {0, 1, 10, 20, 30, 40} and want[12] == 10
    assert met(True) == want


def test_classes_that_are_compared_under_a_key():
    classes = jaccard.Classes(80)
    sizes = np.array([*range(1, 200), 1000, 5000])
    at = [classes.at(int(s)) for s in sizes]
    met = set()
    for c, among in jaccard.comparable(classes, sizes):
        assert {at[i] for i in among} <= {c, c + 1}
        met |= {(i, j) for i in among.tolist() for j in among.tolist()}
    assert met == {(i, j) for i in range(len(sizes)) for j in range(len(sizes)) if abs(at[i] - at[j]) < 2}
