"""Language spans: exact Viterbi, held-out accuracy, script ranges, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from gamelake.llm import langid


def plain_best(scores, penalty):
    best = scores[0].copy()
    for row in scores[1:]:
        best = np.maximum(best, best.max() - penalty) + row
    return best.max()


def test_labelling_reaches_the_best_total():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = rng.integers(0, 12, 5)
        scores = -rng.integers(0, 9, (lengths.sum(), 3)).astype(float)
        if not len(scores):
            continue
        scores -= scores.max(axis=1, keepdims=True)
        path, at = langid.label_words(scores, lengths, 6.0), 0
        for n in lengths:
            own = path[at: at + n]
            if n:
                got = scores[np.arange(at, at + n), own].sum() - 6.0 * np.count_nonzero(own[1:] != own[:-1])
                assert abs(got - plain_best(scores[at: at + n], 6.0)) < 1e-9
            at += n


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.filter(~out))
    rows = langid.identify(docs, model).join(docs, "doc_id").filter(out).select("lang", "lang_pred").collect()
    assert np.mean([r[0] == r[1] for r in rows]) > 0.97


def test_scripts_spans_and_edge_rows(spark):
    train = spark.createDataFrame(
        [(i, "the cat and the dog went to the house", "en") for i in range(20)]
        + [(i, "собака и кошка пошли в большой дом", "ru") for i in range(20)]
        + [(i, "der hund und die katze gingen nach hause", "de") for i in range(20)]
        + [(99, None, "fr"), (98, "x", None)], "doc_id long, text string, lang string")
    model = langid.learn(train)
    assert model.langs == ["de", "en", "ru"]
    rows = [(1, None), (2, ""), (3, "123 — 4!"), (4, "кошка дом"), (5, "the cat went to the house. " * 4 + "der hund und die katze gingen nach hause " * 4),
            (6, "THE CAT"), (7, "house " * 30000), (None, "the dog"), (7, "漢字")]
    df = spark.createDataFrame([(d, t, "de", 0.5) for d, t in rows], "doc_id long, text string, lang string, score double")
    out = [tuple(r) for r in langid.identify(df, model).collect()]
    by = {(r[0], i): r for i, r in enumerate(out)}
    assert len(out) == len(rows)
    answer = [r[1] for r in out]
    assert answer[:4] == ["und", "und", "und", "ru"] and answer[5:8] == ["en", "en", "en"]
    assert [s["lang"] for s in out[4][3]] == ["en", "de"] and out[4][3][0]["n_words"] == 24
    assert all(0.0 <= r[2] <= 1.0 for r in out) and out[0][3] == [] and by
    empty = langid.learn(train.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}
    assert langid.identify(df.limit(0), model).count() == 0


MIXED = [("en", "the cat and the dog went to the house"), ("ru", "собака и кошка пошли в большой дом"), ("zh", "今天天气很好我们去公园散步吧"),
         ("ja", "きょうはとてもいいてんきですカタカナ"), ("th", "วันนี้อากาศดีมากเราไปเดินเล่น"), ("el", "η γάτα και ο σκύλος πήγαν στο σπίτι")]


def mixed_model(spark, leave_out=()):
    rows = [(i, t, lang) for i in range(20) for lang, t in MIXED if lang not in leave_out]
    return langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def answers(spark, model, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    out = {r["doc_id"]: (r["lang_pred"], r["score"], [tuple(s) for s in r["spans"]]) for r in langid.identify(df, model).collect()}
    return [out[i] for i in range(len(texts))]


def test_each_script_keeps_its_own_span(spark):
    model = mixed_model(spark)
    texts = [f"the cat and the dog {t}" for lang, t in MIXED[1:]] + ["the cat and " + "今天天气很好" * 300 + " the dog", "the cat今天天气the dog"]
    got = answers(spark, model, texts)
    for (lang, _), (pred, score, spans) in zip(MIXED[1:], got):
        assert [s[0] for s in spans] == ["en", lang] and spans[0][1:] == (0, 5) and pred == lang
    assert got[-2][0] == "zh" and 0.99 < got[-2][1] < 1 and [s[0] for s in got[-2][2]] == ["en", "zh", "en"]
    assert [s[0] for s in got[-1][2]] == ["en", "zh", "en"]


def test_a_script_that_was_not_learnt_lowers_the_score(spark):
    model = mixed_model(spark, leave_out=("el", "zh", "ja", "th"))
    only, half, signs = answers(spark, model, ["η γάτα και ο σκύλος", "cat γάτ", "the cat — « the dog » … 👍"])
    assert only[0] in model.langs and only[1] == 0.0 and only[2] == [("und", 0, 5)]
    assert half[0] == "en" and abs(half[1] - 3 / 9) < 1e-12 and [s[0] for s in half[2]] == ["en", "und"]
    assert signs[1] == 1.0 and signs[2] == [("en", 0, 4)]


def test_answers_do_not_depend_on_the_texts_beside_them(spark):
    model = mixed_model(spark)
    rng = np.random.default_rng(3)
    parts = [w for _, t in MIXED for w in t.split()] + ["fox", "zzz", "", "—", "«"]
    texts = [" ".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(60)] + ["fox", "zzz", "", "fox", "ο", "今"]
    together, order = answers(spark, model, texts), rng.permutation(len(texts))
    shuffled = answers(spark, model, [texts[i] for i in order])
    assert [together[i] for i in order] == shuffled
    assert [answers(spark, model, [t])[0] for t in texts[-8:]] == together[-8:]


def test_training_counts_do_not_depend_on_row_order(spark):
    rows = [(i, w, "en" if i % 2 else "de") for i, w in enumerate("fox zzz hund katze the house und dog".split() * 3)]
    one, two = (langid.learn(spark.createDataFrame(r, "doc_id long, text string, lang string").coalesce(1)) for r in (rows, rows[::-1]))
    assert one.langs == two.langs and (one.scores == two.scores).all() and (one.allowed == two.allowed).all()


def plain_words(text):
    """(word, script) by code points."""
    def script(c):
        if not c.isascii() and any(a <= ord(c) <= b for a, b in langid.SIGNS) or c.isascii() and not c.isalpha():
            return None
        return [name for first, name in langid.SCRIPTS if first <= ord(c)][-1]

    words, last = [], None
    for c in text.lower():
        own = script(c)
        if own and own == last and own not in langid.UNSPACED:
            words[-1] = (words[-1][0] + c, own)
        elif own:
            words.append((c, own))
        last = own
    return words


def test_words_match_a_plain_split():
    import pyarrow as pa

    from gamelake.llm import blocks

    texts = ["the cat今天天气the dog", "«γάτα»кошка-дом", "", "naïve café × ÷ ½", "カタカナ漢字ひらがな", "วันนี้ ok", "𠀀𠀁 x 👍y", "…", "a"]
    block = next(blocks.text_blocks(pa.array([t.lower() for t in texts])))
    _, starts, ends, scripts = langid._words(block)
    got = [(block.buf[a:b].tobytes().decode(), langid._NAMES[s]) for a, b, s in zip(starts, ends, scripts)]
    assert got == [w for t in texts for w in plain_words(t)]


def test_whole_labelling_matches_brute_force(spark):
    """Every labelling of short mixed texts is tried; the one given has the best total."""
    from itertools import product

    import pyarrow as pa

    from gamelake.llm import blocks

    model = mixed_model(spark, leave_out=("ja", "th"))
    texts = ["the cat γάτα dog", "cat 今天 dog", "кошка the house дом", "και the", "house"]
    for text in texts:
        block = next(blocks.text_blocks(pa.array([text])))
        scores, starts, _, known = langid.word_scores(block, model)
        allowed = [[i for i in range(len(model.langs)) if model.allowed[i, langid._NAMES.index(s)]] for _, s in plain_words(text)]
        assert known.all()
        best = max(sum(scores[w, i] for w, i in enumerate(p)) - langid.PENALTY * sum(a != b for a, b in zip(p, p[1:]))
                   for p in product(*allowed))
        path = langid.label_words(scores, np.asarray([len(starts)]))
        assert all(i in a for i, a in zip(path, allowed))
        assert scores[np.arange(len(path)), path].sum() - langid.PENALTY * np.count_nonzero(np.diff(path)) == best
