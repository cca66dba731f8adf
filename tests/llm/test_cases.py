"""Nulls, empty and very long texts, repeated rows and ids, columns with the names that operators make; models against plain versions."""

import itertools
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from entigraph.llm import html_blocks, linear, lines, neardup, packing, pieces, quality, substrings, toxicity, vecdup
from entigraph.llm.queries import tokenizer_file

PIECES, WORDS = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("word_bpe_49k.json")
CLASH = "score double, kept string, posterior string, n_lines string, n_dropped string, n_words string, n_removed string, ids string, decoded string, n_tokens string"
LONG = " ".join(f"w{i % 977}x{i % 641}" for i in range(120_000))


def rows(*texts):
    return [(i, t, "en", "s", len(t or ""), 0.5, *"abcdefghi") for i, t in texts]


def frame(spark, *texts):
    return spark.createDataFrame(rows(*texts), f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}")


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, null, empty and blank texts, repeated rows, a very long text."""
    return frame(spark, (1, "one two three"), (1, "one two three"), (1, "another text of this id"), (None, "one two three"), (None, None), (2, None), (3, ""), (4, " \n\t"), (5, LONG), (6, LONG + " end"), (7, "one two three"))


def labels(spark, *rows_):
    return spark.createDataFrame(list(rows_), "doc_id long, toxic int")


def test_every_operator_returns_every_row(spark, odd):
    n = odd.count()
    weights = toxicity.train(odd, labels(spark, (1, 0), (1, 1), (5, 1), (6, None), (None, 1), (7, 0)))
    scored = toxicity.score(odd, weights)
    assert scored.count() == n and scored.columns == [*(c for c in odd.columns if c != "score"), "score"]
    told = quality.quality(odd).collect()
    assert len(told) == n and all(0 <= r.score <= 1 and 0 <= r.posterior <= 1 and r.kept == (r.score >= 0.5) for r in told)
    assert len({(r.score, r.posterior) for r in told if r.text == "one two three"}) == 1
    near = neardup.near_duplicates(odd, words=4).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in near) == sorted([(1, 1)] * 3 + [(-1, -1)] * 2 + [(2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 1)])
    dropped = lines.drop_repeated_lines(odd)
    assert sorted((r.doc_id or -1, r.text or "") for r in dropped.collect()) == sorted((r.doc_id or -1, r.text or "") for r in odd.collect()) and dropped.first().n_dropped == 0
    kept = {(r.doc_id, r.n_words): r.n_removed for r in substrings.drop_repeats(odd).collect()}
    assert kept[5, 120_000] == 0 and kept[6, 120_001] == 120_000 and kept[1, 3] == kept[None, 0] == kept[2, 0] == 0
    encoded = pieces.encode_pieces(odd, PIECES).collect()
    assert len(encoded) == n and {r.decoded for r in encoded if not r.text} == {""}
    packed = packing.pack(odd, WORDS).collect()
    assert sum(r.piece == 0 for r in packed) == n and sum(r.length for r in packed if r.doc_id == 2) == 1
    assert sorted(r.start for r in packed if r.doc_id == 5) == [4096 * i for i in range(sum(r.doc_id == 5 for r in packed))]


def test_stages_bring_back_columns(spark, odd, tmp_path):
    labels(spark, (1, 0), (5, 0), (7, 0)).write.parquet(f"file://{tmp_path}/labels.parquet")
    own = lambda r: (r.doc_id, r.lang, r.source, r.score, r.kept, r.posterior, r.n_lines, r.n_dropped, r.n_words, r.n_removed, r.ids)
    want = sorted(map(str, map(own, odd.collect())))
    for stage in (corpus_pipeline.toxicity_filter, corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.substring_dedup):
        out = stage(spark, odd, f"file://{tmp_path}")
        assert out.columns == odd.columns and out.dtypes == odd.dtypes
        got = sorted(map(str, map(own, out.collect())))
        assert got == want if stage is not corpus_pipeline.near_dedup else len(got) == len(want) - 2  # ids 6 and 7 are copies
        assert stage(spark, odd.limit(0), f"file://{tmp_path}").count() == 0
    assert corpus_pipeline.packed(spark, odd.limit(0), f"file://{tmp_path}").count() == 0


def test_a_group_that_toxic_texts_name_more_often(spark):
    """Counterfactuals lower what neutral mentions of the group score; without them they are false positives."""
    rng = random.Random(2)
    neutral = "the house green tree river walk town day".split()
    said = lambda *more: " ".join(rng.sample([*(rng.choice(neutral) for _ in range(12)), *more], 12 + len(more)))
    texts, marks = [], []
    for i in range(1200):
        bad = i % 3 == 0
        group = "muslims" if rng.random() < (0.8 if bad else 0.1) else rng.choice(["jews", "christians", "hindus"])
        texts.append((i, said(group, *([rng.choice(["vile", "scumword", "filthword"])] if (rng.random() < 0.9 if bad else rng.random() < 0.02) else []))))
        marks.append((i, int(bad)))
    docs, known = spark.createDataFrame(texts, "doc_id long, text string"), labels(spark, *marks)
    test = spark.createDataFrame([(i, said(g)) for i, g in enumerate(["muslims", "jews", "christians", "hindus"] * 10)] + [(99, said("muslims", "scumword")), (98, said("jews", "scumword"))], "doc_id long, text string")
    told = {}
    for pull in (0.0, 4.0):
        told[pull] = {r.doc_id: r.score for r in toxicity.score(test, toxicity.train(docs, known, pull=pull)).collect()}
        assert told[pull][99] > 0.85 and told[pull][98] > 0.85
    group = range(0, 40, 4)
    assert all(told[4.0][i] < 0.5 * told[0.0][i] and told[4.0][i] < 0.15 for i in group)
    assert max(abs(told[4.0][i] - told[4.0][i + 1]) for i in group) < 0.05 < min(told[0.0][i] - told[0.0][i + 1] for i in group)


def test_labels_of_held_out_documents_are_never_read(spark):
    docs = spark.createDataFrame([(i, f"{['alpha', 'beta'][i % 2]} text") for i in range(200)], "doc_id long, text string")
    marks = [(r.doc_id, r.doc_id % 2 if not r.h else 1 - r.doc_id % 2) for r in docs.select("doc_id", toxicity.held_out("doc_id").alias("h")).collect()]
    assert all((r.score > 0.5) == (r.doc_id % 2 == 1) for r in toxicity.score(docs, toxicity.train(docs, labels(spark, *marks))).collect())


def plain_posteriors(patterns, steps=200):
    """Expectation-maximisation over single rows, in plain Python."""
    post = [min(max((0.5 + sum(v == 1 for v in p)) / (1 + sum(v >= 0 for v in p)), 0.02), 0.98) for p in patterns]
    for _ in range(steps):
        share = min(max(sum(post) / len(post), 0.01), 0.99)
        rate = {}
        for c, i, v in itertools.product((0, 1), range(len(patterns[0])), (-1, 0, 1)):
            rate[c, i, v] = 0.5 + sum(q if c else 1 - q for p, q in zip(patterns, post, strict=True) if p[i] == v)
        whole = {(c, i): sum(rate[c, i, v] for v in (-1, 0, 1)) for c in (0, 1) for i in range(len(patterns[0]))}
        new = []
        for p in patterns:
            odds = np.log(share / (1 - share)) + sum(np.log(rate[1, i, v] / whole[1, i]) - np.log(rate[0, i, v] / whole[0, i]) for i, v in enumerate(p))
            new.append(1 / (1 + np.exp(-min(max(odds, -40), 40))))
        done = max(abs(a - b) for a, b in zip(new, post, strict=True)) < 1e-6
        post = new
        if done:
            break
    return post


def test_posteriors_like_a_plain_version(spark):
    rng = random.Random(5)
    good = lambda: " ".join(rng.choice("the of and a river stone walks long old house".split()) for _ in range(rng.randint(30, 90))) + "."
    bad = lambda: " ".join(rng.choice(["&&&", "BUY", "NOW", "x|y", "$$$", "ok", "the"]) for _ in range(rng.randint(3, 60)))
    texts = [good() if i % 3 else bad() for i in range(150)] + [None, "", "same line\n" * 30]
    out = {r.doc_id: r for r in quality.quality(frame(spark, *enumerate(texts))).collect()}
    want = plain_posteriors([quality.votes(t) for t in texts])
    assert max(abs(out[i].posterior - p) for i, p in enumerate(want)) < 1e-4
    assert np.mean([out[i].kept == bool(i % 3) for i in range(150)]) > 0.95


def test_votes_count_letters_of_every_alphabet():
    for text in ("", "Ab1_ÄßΣσ日Ж½ \n", "ÀÉ plain ASCII", "\ud800x"):
        assert quality.letters_and_capitals(text) == (sum(map(str.isalpha, text)), sum(map(str.isupper, text)))


def test_chosen_features_and_weights_like_a_plain_version(spark):
    rng = np.random.default_rng(1)
    y = rng.random(300) < 0.4
    ids = [sorted({*np.flatnonzero(rng.random(20) < 0.3).tolist(), *([50] if t and rng.random() < 0.9 else []), *([51] if not t else [])}) for t in y]
    sample = spark.createDataFrame([(i, float(t)) for i, t in zip(ids, y, strict=True)], "ids array<int>, y double")
    names, mean, n = linear.chosen_features(sample, 3, 6.0, [7, 999])
    has = lambda f: np.array([f in i for i in ids])
    apart = lambda f: abs(y[has(f)].sum() - y.mean() * has(f).sum()) >= 6 * np.sqrt(y.mean() * (1 - y.mean()) * has(f).sum())
    assert names.tolist() == [f for f in range(52) if has(f).sum() >= 3 and apart(f) or f == 7] and (mean, n) == (pytest.approx(y.mean()), 300)
    flat, counts, target = linear.chosen_ids(sample, names)
    assert len(flat) == counts.sum() == sum(f in i for i in ids for f in names) and target.sum() == y.sum()
    w = linear.descended(flat, counts, target, names, mean, steps=800)
    x = np.array([[f in i for f in names] for i in ids], float)
    err = linear.sigmoid(x @ w[:-1] + w[-1]) - y
    assert np.abs(np.append(x.T @ err / 300 + 2e-4 * w[:-1], err.mean())).max() < 2e-3  # the gradient is flat there


@pytest.mark.parametrize("most_bits", [1 << 20, 1 << 30])
def test_lines_with_a_full_filter_and_repeated_ids(spark, most_bits):
    """A filter that everything passes gives the same lines; rows with one id are one document."""
    line, rare = "A line that very many documents have in common, word for word.", "A line that only few have in common, so that it stays there."
    texts = [(i % 40, f"{line}\n{rare if i < 3 else i}\n{'x' * 50}{i}") for i in range(120)] + [(None, line), (99, line.upper() + "  \n" + "y" * 60)]
    held = lambda key: {i for i, t in texts if i is not None and key in [x.strip(" ").lower() for x in t.split("\n")]}
    top = max(held(line.lower()))
    old, lines.FEWEST_BITS = lines.FEWEST_BITS, min(lines.FEWEST_BITS, most_bits)
    out = lines.drop_repeated_lines(frame(spark, *texts), most_bits=most_bits).collect()
    lines.FEWEST_BITS = old
    want = [(i if i is not None else -1, "\n".join(x for x in t.split("\n") if i is None or i == top or x.strip(" ").lower() != line.lower())) for i, t in texts]
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in out) == sorted(want)


def test_vectors_with_null_and_repeated_ids(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (None, [1.0, 0.0]), (3, [1.0, 0.01]), (3, [1.0, 0.01]), (4, None)], "vec_id long, embedding array<double>")
    out = vecdup.near_duplicate_vectors(v).collect()
    assert len(out) == 7 and {(r.vec_id, r.component_id) for r in out if r.vec_id in (2, 3)} == {(2, 1), (3, 1)}
    assert [(r.component_id, r.n_links, r.kept) for r in out if r.vec_id is None] == [(None, 0, True)]


def test_pages_with_odd_rows(spark):
    page = "<nav><a href=x>Home</a></nav><article><h1>Title {0}</h1><p>" + "Many words of the article stand here. " * 5 + "</p></article><footer>us</footer>"
    rows_ = [(i % 30 if i else None, page.format(i), "t", "u", 5) for i in range(40)] + [(7, page.format(7), "t", "u", 5), (50, None, "t", "u", 5), (51, "", "t", "u", 5), (52, "<p>" + "x " * 300_000, "t", "u", 5)]
    out = html_blocks.main_text(spark.createDataFrame(rows_, "page_id long, html string, text string, url string, n_chars int")).collect()
    assert len(out) == len(rows_) and all(r.n_chars == len(r.text) for r in out)
    assert all(r.text.startswith("Title") and "Home" not in r.text and "us" not in r.text.split() for r in out if r.html and "article" in r.html) and {r.text for r in out if not r.html} == {""}


def test_labelled_pages_that_were_not_trained_on():
    """Held out: the labeller against a rule by position, on pages whose names it never saw."""
    rng = random.Random(6)
    text = lambda k: " ".join(rng.choice("stone river of the a long tree walk".split()) for _ in range(k))

    def made(inner, names):
        furniture = "".join(f"<div class={n}><p>{text(4)}</p></div>" for n in names)
        body = "".join(f"<p>{text(rng.randint(15, 60))}.</p>" for _ in range(6))
        return f"<body><nav><ul><li><a href=x>{text(2)}</a></ul></nav>{furniture}<{inner}><h1>{text(5)}</h1>{body}</{inner.split()[0]}><aside><p>{text(6)}</p></aside><footer><p>{text(5)}</p></footer></body>", [False] * (1 + len(names)) + [True] * 7 + [False] * 2

    model = html_blocks.train([made("article", rng.sample(["ad", "share", "cookie-box", "menu"], 2))[0] for _ in range(120)])
    hits = total = 0
    for _ in range(60):
        page, want = made(rng.choice(["main", "div id=content", "section class=story", "div class=body-copy"]), rng.sample(["sidebar", "promo", "related", "newsletter"], 2))
        told = html_blocks.labelled(model, [html_blocks.blocks(page)])[0] >= 0.5
        hits, total = hits + int((told == want).sum()), total + len(want)
    assert hits >= 0.95 * total
    untrained = html_blocks.labelled(html_blocks.Labeller(), [html_blocks.blocks(page)])[0] >= 0.5
    assert (untrained == want).mean() < 0.9  # it is the training that tells


def test_no_operator_reads_other_settings():
    """Word shingles, line keys and windows split at the same six characters and no other."""
    text = "a b c d\x1ce f\x0bg"
    assert neardup.shingle_set(text, 1).size == len(re.findall(r"[^\x20\x09-\x0D]+", text)) == 4
