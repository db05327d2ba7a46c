import pytest
import math
import random
import zlib

import numpy as np

from llm_frames import make_docs, prose
from tipscope.llm import langid as L

STEMS = {"en": "the of and ing tion ly was that with er".split(), "de": "der die und ung heit lich sch eine zu über".split(),
         "es": "el la que ción mente ado los para una año".split()}


def corpus(n=240):
    rng = random.Random(6)
    texts, langs = [], []
    for _ in range(n):
        lang = rng.choice(list(STEMS))
        texts.append(" ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(8, 90))))
        langs.append(lang)
    return texts, langs


def fold(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    texts, langs = corpus()
    odd = [None, "", "123 !!", "🙂", "\n"]
    rows = {r.doc_id: r for r in L.language_of(make_docs(spark, texts + odd, langs=langs + ["en"] * len(odd))).collect()}
    assert all(rows[i].held_out == fold(i) for i in rows)
    held = [i for i in range(len(texts)) if fold(i)]
    assert np.mean([rows[i].lang_pred == langs[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert all((rows[len(texts) + k].lang_pred, rows[len(texts) + k].score) == ("und", 0.0) for k in range(len(odd)))


def test_only_text_and_training_labels_matter(spark):
    texts, langs = corpus(120)
    a = {r.doc_id: r for r in L.language_of(make_docs(spark, texts, langs=langs)).collect()}
    other = [("xx" if fold(i) else x) for i, x in enumerate(langs)]
    b = {r.doc_id: r for r in L.language_of(make_docs(spark, texts, langs=other, sources=["q"] * 120)).collect()}
    assert a == b


def test_kernel_and_long_texts():
    p = L.Presence()
    x, y = p.row("alpha beta"), p.row("ALPHA, beta!")
    assert np.array_equal(x, y) and p.row("12 \x85") is None and p.row(None) is None
    rng = random.Random(2)
    long = " ".join(rng.choice(STEMS["de"]) for _ in range(120_000))
    whole = p.row(long)
    tail = p.row(long[-2000:].partition(" ")[2])
    assert len(long) > L._SEGMENT and (whole[1:] >= tail[1:]).mean() > 0.999


def test_edges(spark):
    none = L.language_of(make_docs(spark, ["abc", None], langs=[None, "en"])).collect()
    assert {(r.doc_id, r.lang_pred) for r in none} == {(0, "und"), (1, "und")}
    ids = [i for i in range(40) if not fold(i)][:4]
    one = L.language_of(make_docs(spark, ["abc def", "xyz", "abc", None], langs=["en"] * 4, ids=ids)).collect()
    assert {r.lang_pred for r in one} == {"en", "und"}
    nulls = L.language_of(make_docs(spark, ["abc", "abc"], langs=["en", "en"], ids=[None, None])).collect()
    assert [(r.held_out, r.lang_pred) for r in nulls] == [(False, "und")] * 2
    assert L.language_of(make_docs(spark, [])).count() == 0


def test_long_texts_with_embedded_data(spark):
    texts, langs = corpus()
    rng = random.Random(7)
    ids, long = [], []
    for name, length, noise in [(x, *size) for x in STEMS for size in ((100_000, 50_000), (400_000, 200_000))]:
        words = " ".join("".join(rng.choice(STEMS[name]) for _ in range(rng.randrange(1, 4))) for _ in range(length // 8))
        data = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(noise))
        ids.append(next(i for i in range((ids or [1000])[-1] + 1, 10 ** 6) if fold(i)))
        long.append((name, words + "\n" + data))
    docs = make_docs(spark, texts + [t for _, t in long], langs=langs + [x for x, _ in long], ids=[*range(len(texts)), *ids])
    rows = {r.doc_id: r for r in L.language_of(docs).collect()}
    assert [rows[i].lang_pred for i in ids] == [x for x, _ in long]


def test_stretches_cover_the_text():
    p = L.Presence()
    text = " ".join(f"{a}{b}" for a in STEMS["de"] for b in STEMS["es"]) * 400
    parts = list(p.stretches(text))
    assert len(parts) > 1 and max(n for n, _ in parts) <= L.STRETCH and sum(n for n, _ in parts) == len(p.codes(text)) + 2
    assert np.array_equal(np.logical_or.reduce([seen for _, seen in parts]), p.row(text))
    assert not list(p.stretches("12 !")) and len(list(p.stretches("ab"))) == 1


def test_repeated_ids_teach(spark):
    texts, langs = corpus(60)
    free = [i for i in range(10 ** 4, 10 ** 4 + 200) if not fold(i)]
    rows = [(free[k], t, x) for k, (t, x) in enumerate(zip(texts, langs)) if x != "es"]
    own = [t for t, x in zip(texts, langs) if x == "es"]
    rows += [(free[100], own[k % len(own)] + " " + "la" * (k % 60), "es") for k in range(3000)]  # many rows, one id
    rows += [(free[101], "xin chào các bạn", "vi")] * 3000  # one row, often
    docs = make_docs(spark, [r[1] for r in rows], langs=[r[2] for r in rows], ids=[r[0] for r in rows])
    for sample in (8, 64):
        assert L.train(docs, sample).languages == ["de", "en", "es", "vi"]
    least = L._taught(docs.select("lang", "text").where("lang = 'es'").selectExpr("*", "xxhash64(text) AS key"), 8)
    assert len({m[1] for m in least}) == len(least) == 8


def test_values_against_a_plain_kernel_ridge():
    """The folded weights give what the kernel, the Nystroem map and a weighted ridge give when written out."""
    rng = random.Random(12)
    texts = [prose(rng, rng.randrange(5, 60)) for _ in range(30)] + [" ".join(rng.choice(["der", "und", "haus", "weg"]) for _ in range(30)) for _ in range(20)]
    languages = ["en"] * 30 + ["de"] * 20
    presence = L.Presence()
    rows = np.array([presence.row(t) for t in texts])
    model = L.KernelRidge(np.packbits(rows, axis=1), languages)

    sets = [set(np.flatnonzero(r).tolist()) for r in rows]
    kernel = lambda a, b: len(a & b) / math.sqrt(len(a) * len(b))
    marks = [i for name in ("de", "en") for i in [j for j, x in enumerate(languages) if x == name][:L.LANDMARKS // 2]]
    values, vectors = np.linalg.eigh(np.array([[kernel(sets[a], sets[b]) for b in marks] for a in marks]))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = lambda s: np.array([kernel(s, sets[m]) for m in marks]) @ root
    z = np.column_stack([np.array([mapped(s) for s in sets]), np.ones(len(sets))])
    weight = np.array([1 / languages.count(x) for x in languages])
    weight *= len(languages) / weight.sum()
    penalty = L.RIDGE * len(languages) * np.eye(z.shape[1])
    penalty[-1, -1] = 0  # the intercept is free
    for k, name in enumerate(("de", "en")):
        y = np.where(np.array(languages) == name, 1.0, -1.0)
        beta = np.linalg.solve(z.T @ (weight[:, None] * z) + penalty, z.T @ (weight * y))
        for text in texts[::7] + [prose(rng, 40), "und der weg", "x"]:
            row = presence.row(text)
            want = np.append(mapped(set(np.flatnonzero(row).tolist())), 1.0) @ beta
            assert model.values(row[None])[0, k] == pytest.approx(want, abs=1e-4)


def test_blocks_of_texts_score_like_single_ones():
    rng = random.Random(3)
    texts = [None, "", "12 34", *(prose(rng, rng.randrange(1, 50)) for _ in range(70)), prose(rng, 30_000), "der und haus"]
    presence = L.Presence()
    rows = np.array([presence.row(t) for t in texts[3:40]])
    model = L.KernelRidge(np.packbits(rows, axis=1), ["a", "b"] * 18 + ["a"])
    together = model.predict_all(map(presence.stretches, texts))
    for text, (said, score) in zip(texts, together):
        one, alone = model.predict(presence.stretches(text))
        assert (one, pytest.approx(alone, abs=1e-5)) == (said, score)
    assert [t[0] for t in together[:3]] == ["und"] * 3


def test_thousands_of_labels_keep_the_bounds(spark):
    rows = [(i, f"text of label number {i % 5000} {'abc'[i % 3]}", f"l{i % 5000:04d}" if i < 10_000 else "often", "s", 1) for i in range(10_300)]
    model = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    assert len(model.languages) == L.SAMPLE // L.LEAST and "often" in model.languages
    assert model.weights.nbytes <= 160 << 20
