import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from entigraph.llm import lines
from entigraph.llm.queries import tokenizer_file

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in sorted(texts.items())], COLUMNS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    text = lambda k: " ".join(f"w{rng.randrange(300)}" for _ in range(k))
    passage, line = text(40), "A line that very many documents have in common, word for word."
    out = {}
    for i in range(60):
        t = text(rng.randint(30, 80))
        if i % 6 == 0:
            t = f"{text(8)} {passage} {t}"
        if i % 4 == 0:
            t = f"{t}\n{line}\n{text(5)}"
        if i % 9 == 4:
            t = out[i - 1].replace(" w", " x", 1)
        if i % 10 == 7:
            t = f"{t} vile scumword vile scumword"
        out[i] = t
    return out


def line_dedup(texts):
    key = lambda x: lines.line_key(x.encode()).decode()
    held = {}
    for i, t in texts.items():
        for x in t.split("\n"):
            held.setdefault(key(x), set()).add(i)
    return {i: "\n".join(x for x in t.split("\n") if not (len(key(x)) >= 40 and len(held[key(x)]) >= 5 and i != max(held[key(x)]))) for i, t in texts.items()}


def near_dedup(texts):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in texts.items() if (w := t.lower().split())}
    group = {i: i for i in texts}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = {i: min(x, y) if g in (x, y) else g for i, g in group.items()}
    return {i: t for i, t in texts.items() if group[i] == i}


def substring_dedup(texts):
    seen, out = set(), {}
    for i, t in sorted(texts.items()):
        words, gone = t.split(), set()
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone.update(range(s, s + 20))
            seen.add(window)
        out[i] = " ".join(w for j, w in enumerate(words) if j not in gone) if gone else t
    return out


def test_stages_and_run_like_brute_force(spark, texts, tmp_path):
    bad = {i for i, t in texts.items() if "scumword" in t}
    folder = f"file://{tmp_path}"
    frame(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in bad)) for i in texts], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.toxicity_filter(spark, docs, folder).collect()}
    scores = corpus_pipeline.toxicity.score(docs, corpus_pipeline.toxicity.train(docs, spark.read.parquet(f"{folder}/labels.parquet")))
    assert kept == {r.doc_id for r in scores.collect() if r.score < 0.3}
    now = {i: t for i, t in texts.items() if i in kept}
    for stage, plain in ((corpus_pipeline.line_dedup, line_dedup), (corpus_pipeline.near_dedup, near_dedup), (corpus_pipeline.substring_dedup, substring_dedup)):
        want = plain(now)
        assert want != now
        rows = stage(spark, frame(spark, now), folder).collect()
        assert {r.doc_id: (r.text, r.lang, r.source, r.n_chars) for r in rows} == {i: (t, "en", "s", len(t)) for i, t in want.items()} and len(rows) == len(want)
        now = want
    t = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    sizes = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in now.items()}
    rows = corpus_pipeline.run(spark, folder).collect()
    found = {}
    for r in rows:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes
