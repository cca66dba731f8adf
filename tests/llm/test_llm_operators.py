import random
import time

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from entigraph.llm import html_blocks, lines, neardup, packing, pieces, quality, substrings, toxicity, vecdup, vptree
from entigraph.llm.queries import tokenizer_file

PIECES, WORDS = tokenizer_file("piece_bpe_32k.model"), tokenizer_file("word_bpe_49k.json")


def docs(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in zip(ids or range(len(texts)), texts, strict=True)], "doc_id long, text string, key string, n_words string")


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, line = text(60), "A line that very many documents have in common, word for word."
    out = []
    for i in range(n):
        t = text(rng.randint(5, 200))
        if i % 4 == 0:
            t = f"{text(15)} {passage} {t}"
        if i % 3 == 0:
            t = f"{t}\n {line.upper() if i % 2 else line} \n{text(5)}"
        if i % 7 == 0 and out:
            w = out[0].split(" ")
            w[rng.randrange(len(w))] = "zz"
            t = " ".join(w)
        out.append(t)
    return [*out, out[3], out[3], None, "", "  \n\t", "one two", "a " * 60]


def test_line_dedup_like_brute_force(spark):
    texts = corpus()
    out = {r.doc_id: r for r in lines.drop_repeated_lines(docs(spark, texts)).collect()}
    key = lambda x: lines.line_key(x.encode()).decode()
    held = {}
    for i, t in enumerate(texts):
        for x in (t or "").split("\n"):
            held.setdefault(key(x), set()).add(i)
    for i, t in enumerate(texts):
        every = (t or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and i != max(held[key(x)]))]
        assert (out[i].n_lines, out[i].n_dropped, out[i].text or "") == (len(every), len(every) - len(kept), "\n".join(kept))
        assert out[i].key == "x"


@pytest.mark.parametrize("hot", [5000, 3])
def test_substring_dedup_like_brute_force(spark, hot):
    texts = corpus()
    out = {r.doc_id: r for r in substrings.drop_repeats(docs(spark, texts), hot=hot).collect()}
    seen = set()
    for i, t in enumerate(texts):
        words = (t or "").split()
        gone = set()
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        assert (out[i].n_words, out[i].n_removed, out[i].text) == (len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone))


def test_near_duplicates_like_brute_force(spark):
    texts = corpus()
    out = {r.doc_id: r for r in neardup.near_duplicates(docs(spark, texts), words=4).collect()}
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = [min(x, y) if g in (x, y) else g for g in group]
    assert [(out[i].n_shingles, out[i].component_id, out[i].kept) for i in range(len(texts))] == [(len(s), group[i], group[i] == i) for i, s in enumerate(sets)]


def test_candidates_agree_in_enough_posted_coordinates(spark):
    wide = ", ".join(f"1L as {s}" for s in neardup.LONGS)
    side = lambda first: spark.sql(f"select 10L as n, sequence({first}L, {first + neardup.K - 1}L) as keys, {wide}")
    for agree in (0, neardup.T - 1, neardup.T, neardup.K):
        pairs = side(0).alias("a").crossJoin(side(neardup.K - agree).alias("b"))
        assert pairs.filter(neardup._plausible("a", "b", 80)).count() == (agree >= neardup.T)


def test_pieces_like_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    parts = [" ", "  ", "a", "e", "th", "in", ".", "\n", "▁", "1", "é", "日", "👩‍👧", "\t", "tion", "<s>", "=" * 9]
    texts = ["", " ", " " * 40, "word " * 500, *("".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(300))]
    m = pieces.model(PIECES)
    for r in pieces.encode_pieces(docs(spark, [*texts, None]), PIECES).collect():
        want = sp.encode(r.text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == sp.decode(want) == m.decode(want)


def test_packing_holds_every_id(spark):
    t = Tokenizer.from_file(WORDS)
    texts = [*corpus(), "Don't STOP <|endoftext|> ßÄ é́ a\xa0b", "x " * 9000]
    rows = packing.pack(docs(spark, texts), WORDS).collect()
    ids = [[*t.encode(x or "", add_special_tokens=False).ids, 1] for x in texts]
    by_sequence = {}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert len(part) == 4 * r.length and r.start == 4096 * r.piece and packing.zlib.crc32(part) == r.ids_crc32
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(map(len, ids))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(by_sequence) <= -(-sum(map(len, ids)) // 4096) + 1
    assert sum(len(r.ids) for r in packing.sequences(docs(spark, texts), WORDS).collect()) == sum(map(len, ids))


def vectors(spark):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(300, 8))
    a[50:80] = a[50] + 0.2 * rng.normal(size=(30, 8))
    a[100:110] = a[100]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(a)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [None] * 8), (304, [1.0]), (305, [])]
    return a, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_vector_links_like_brute_force(spark):
    a, df = vectors(spark)
    out = {r.vec_id: r for r in vecdup.near_duplicate_vectors(df, cell_rows=40).collect()}
    u = a / np.linalg.norm(a, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    group = np.arange(300)
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = group[i], group[j]
        group[(group == x) | (group == y)] = min(x, y)
    assert [(out[i].n_links, out[i].component_id) for i in range(300)] == [(int(near[i].sum()) - 1, group[i]) for i in range(300)]
    assert all(out[i].n_links == 0 and out[i].component_id == i for i in range(300, 306))


def test_exact_factor_finds_all_neighbours(spark):
    a, df = vectors(spark)
    rows = vptree.nearest(df, df.filter("vec_id % 20 = 0"), k=5, factor=1.0, shard_rows=100).collect()
    s = (a[::20][:, None, :] * a[None]).sum(-1)
    for q in range(0, 300, 20):
        want = sorted((-s[q // 20, i], i) for i in range(300) if i != q)[:5]
        assert [(r.rank, r.vec_id) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == [(k + 1, i) for k, (_, i) in enumerate(want)]


def test_main_text_leaves_furniture_out(spark):
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav><div class='ad'>Buy now</div><article><h1>A &amp; B</h1><p>First <b>long</b> paragraph number {i}.<br>It goes on.<p>Second one.</article><footer>&copy; us</footer><!-- x --><script>var a = '<p>';</script></body></html>"
    rows = [(i, page.replace("{i}", str(i))) for i in range(40)] + [(40, None), (41, "")]
    out = {r.page_id: r for r in html_blocks.main_text(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert out[7].text == "A & B\n\nFirst long paragraph number 7. It goes on.\n\nSecond one." and out[7].n_chars == len(out[7].text)
    assert out[40].text == out[41].text == "" and len(out) == 42


def test_vectors_of_mixed_dimensions(spark):
    rng = np.random.default_rng(6)
    by_dim = {d: rng.normal(size=(n, d)) for d, n in ((8, 200), (3, 90), (5, 2))}
    by_dim[3][10:20] = by_dim[3][10] * 3
    by_dim[5][1] = by_dim[5][0]
    items = [v for a in by_dim.values() for v in a]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(items)], "vec_id long, embedding array<double>")
    near = [[i != j and len(u) == len(v) and u @ v >= 0.9 * np.linalg.norm(u) * np.linalg.norm(v) for j, v in enumerate(items)] for i, u in enumerate(items)]
    group = list(range(len(items)))
    for i, j in zip(*np.nonzero(near), strict=True):
        x, y = group[i], group[j]
        group = [min(x, y) if g in (x, y) else g for g in group]
    out = {r.vec_id: r for r in vecdup.near_duplicate_vectors(df, cell_rows=40).collect()}
    assert [(out[i].n_links, out[i].component_id) for i in range(len(items))] == [(sum(near[i]), group[i]) for i in range(len(items))]
    assert out[291].component_id == 290 and not out[291].kept
    rows = vptree.nearest(df, df.filter("vec_id % 10 = 0"), k=5, factor=1.0, shard_rows=60).collect()
    for q in range(0, len(items), 10):
        want = sorted((-float((items[q] * v).sum()), i) for i, v in enumerate(items) if i != q and len(v) == len(items[q]))[:5]
        assert [(r.rank, r.vec_id) for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == [(k + 1, i) for k, (_, i) in enumerate(want)]


def html_pages(n, article="article", body="body"):
    rng = random.Random(4)
    text = lambda k: " ".join(rng.choice(["stone", "river", "of", "the", "a", "long", "tree", "walk"]) for _ in range(k)) + "."
    return [f"<html><{body}><nav><ul><li><a href=x>{text(1)}</a><li><a href=y>{text(1)}</a></ul></nav><div class='ad'>{text(9)}</div><{article}><div class='post-header'><h1>{text(6)}</h1></div>" + "".join(f"<p>{text(rng.randint(10, 60))}</p>" for _ in range(5)) + f"<figure><figcaption>{text(8)}</figcaption></figure></{article.split()[0]}><footer>{text(5)}</footer></{body.split()[0]}></html>" for _ in range(n)]


def test_main_text_without_an_article_element():
    want = [False] * 3 + [True] * 7 + [False]
    for body in ("body", "body class='single has-sidebar'", "body><form id=f"):
        assert [html_blocks.taught(path) for path, _, _ in html_blocks.blocks(html_pages(1, "main", body)[0])] == want
    assert not any(html_blocks.taught(path) for path, _, _ in html_blocks.blocks("<aside><article><p>x</article></aside><main><div class='share'>x</div></main>"))
    model = html_blocks.train(html_pages(150))
    for article in ("main", "div id=content", "div", "section class=story"):
        told = html_blocks.labelled(model, [html_blocks.blocks(p) for p in html_pages(40, article)])
        assert all(((p >= 0.5) == want).all() for p in told)
    model = html_blocks.train(html_pages(150, "div id=content"))  # no page has one
    told = html_blocks.labelled(model, [html_blocks.blocks(p) for p in html_pages(40, "div id=content")])
    assert np.mean([p >= 0.5 for p in told], axis=0).round().tolist() == want


def test_blocks_after_elements_without_an_end():
    texts = lambda page: [text for _, text, _ in html_blocks.blocks(page)]
    body = "<article><h1>A</h1><p>B</article>"
    for head in ("<head><title>t <p> u</title><body>", "<head><meta charset=utf-8><title>t</title><style>p{}</style>", "<head><title>t</title></head><body>", "<head><script>1<2</script><noscript><p>x</noscript><!-- c -->\n", "<title>t</title>", "<head><title>t"):
        assert texts(f"<!DOCTYPE html><html>{head}{body}</html>") == ["A", "B"]
    assert texts("<head><title>t</title>words<p>more") == ["words", "more"]
    for name in ("noscript", "object", "svg", "select", "template", "iframe"):
        assert texts(f"<body><{name} a=b>{body}") == ["A", "B"]
        assert texts(f"<body><{name} a=b>x<p>y</{name}>{body}<{name}>") == ["A", "B"]
    assert texts(f"<body><svg width=1 />{body}<svg>x</svg>") == ["A", "B"]
    assert texts(f"<body>{body}<script>x <p>y") == ["A", "B"]
    assert len(texts("<p><svg>x" * 50_000)) == 50_000


def test_main_text_of_few_and_very_long_pages(spark):
    nav, foot = "<nav><ul><li><a href=x>Home</a></li></ul></nav><div class=ad>Buy it now.</div>", "<footer>us</footer>"
    words = "A long line of words that tells of the river, the stone and the tree. " * 8
    rows = [(i, f"<body>{nav}<article><h1>Page {i}</h1>" + f"<p>{words}</p>" * 500 + f"</article>{foot}</body>") for i in range(2)]
    assert min(len(p) for _, p in rows) > 200_000
    out = {r.page_id: r for r in html_blocks.main_text(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert all(out[i].text == "\n\n".join([f"Page {i}", *[words.strip()] * 500]) for i in range(2))
    one = html_blocks.main_text(spark.createDataFrame([(1, f"<body>{nav}<article><h1>A b</h1><p>{words}</article>{foot}")], "page_id long, html string")).collect()
    assert one[0].text == f"A b\n\n{words.strip()}"
    page = html_blocks.blocks(rows[0][1])
    parts = html_blocks.parts_of(page)
    assert len(parts) == 4 and parts[0][0] == 0 and parts[-1][2][-1][1] == "us" and all(article and b == page[at : at + len(b)] for at, article, b in parts)
    assert html_blocks.train([]) is None and html_blocks.labelled(None, [page])[0].sum() == 501


def test_toxicity_and_quality(spark):
    rng = random.Random(2)
    text = lambda bad: " ".join([*(rng.choice(["the", "house", "women", "muslims", "green", "tree"]) for _ in range(30)), *(["vile", "scumword"] if bad else [])])
    marks = [i % 5 == 0 for i in range(400)]
    df = docs(spark, [text(m) for m in marks])
    labels = spark.createDataFrame([(i, int(m)) for i, m in enumerate(marks)], "doc_id long, toxic int")
    rows = toxicity.score(df, toxicity.train(df, labels)).collect()
    assert all((r.score >= 0.3) == marks[r.doc_id] for r in rows)
    clean = "The women of the town and the men in it were there for the day and it was good to be with them. " * 3
    junk = "THE&&& EN%%% ||| $$$ AND### !!! " * 20
    rows = quality.quality(docs(spark, [clean + str(i) + "." for i in range(60)] + [junk] * 20 + [None])).collect()
    assert all(r.kept == (r.doc_id < 60) for r in rows)


def test_empty_tables(spark):
    none = docs(spark, [])
    vec = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert lines.drop_repeated_lines(none).count() == 0
    assert substrings.drop_repeats(none).count() == 0
    assert neardup.near_duplicates(none).count() == 0
    assert packing.pack(none, WORDS).count() == 0
    assert pieces.encode_pieces(none, PIECES).count() == 0
    assert vecdup.near_duplicate_vectors(vec).count() == 0
    assert vptree.nearest(vec, vec).count() == 0
    assert html_blocks.main_text(spark.createDataFrame([], "page_id long, html string")).count() == 0
    assert quality.quality(none).count() == 0
    assert toxicity.score(none, toxicity.train(none, spark.createDataFrame([], "doc_id long, toxic int"))).count() == 0


def test_null_ids_and_repeated_rows(spark):
    long = " ".join(f"word{i}" for i in range(50))
    df = docs(spark, [long, long, long, "other text"], ids=[None, 4, 4, 5])
    assert sorted(r.n_removed for r in substrings.drop_repeats(df).collect())[:2] == [0, 0]
    assert {r.component_id for r in neardup.near_duplicates(df).collect()} == {None, 4, 5}
    assert lines.drop_repeated_lines(df).count() == 4


def test_texts_that_share_an_id_share_a_component(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (5, ""), (2, b + " tail"), (9, a + " tail"), (7, c), (8, c), (8, c), (None, a), (6, None), (4, a.replace("a3 ", "q "))]
    out = neardup.near_duplicates(docs(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in out if r.doc_id is not None) == [(2, 37, 2), (4, 36, 2), (5, 0, 5), (5, 36, 2), (5, 36, 2), (6, 0, 6), (7, 36, 7), (8, 36, 7), (8, 36, 7), (9, 37, 2)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)]


def test_markup_without_an_end():
    texts = lambda page: [text for _, text, _ in html_blocks.blocks(page)]
    assert texts('<p title="x>after') == ["after"] and texts("<p>a < b<p>c</ x>d<!--> e --><!-- f") == ["a < b", "cd e -->"]
    assert texts("<p class=a title='it''s'>x<br a=\">\">y") == ["x y"] and texts("<script>a</scripts>b</script >c") == ["c"]
    for piece in ('<p title="x>after ', '<a =">" ', "<a ", "<div>x", "</section><div>", "<!--", "<![CDATA[", "</", "<title>", "<p a='"):
        begin = time.time()
        html_blocks.blocks(piece * 30_000)
        assert time.time() - begin < 20


def test_a_large_group_of_more_and_less_edited_copies(spark, monkeypatch):
    """Most are too far from the least id; links between the others are found in blocks, and none is lost."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(140)]
    texts = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(140), 12 if i == 0 else rng.choice([0, 1, 2, 3, 4, 6, 8, 10])):
            words[at] = f"x{rng.randrange(30)}"
        texts.append(" ".join(words))
    out = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs(spark, texts), words=5).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for t in texts for w in [t.split()]]
    group = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = [min(x, y) if g in (x, y) else g for g in group]
    assert 1 < len(set(group)) < 100 and [out[i] for i in range(len(texts))] == group
