import random
import re

from llm_frames import make_docs, prose, words
from tipscope.llm import quality as Q

SYMBOLS = re.compile(r"[#*$%&|<>]")


def figures(text):
    w = words(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    covered = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(SYMBOLS.findall(text or "")), len(lines) - len(set(lines)), len(covered))


def cases():
    rng = random.Random(5)
    base = prose(rng, 60)
    out = [None, "", " \t\n", "one", base, base, base + "\n" + base, base * 3, "a b c d e f g h " * 30, base.upper() + "!!",
           " ".join(w + "###" for w in base.split()), "é\x85\xa0 ü\n\nÉ\x1f\x0b x", "line one\nline one\r\nline one\n \n" + base,
           "x" * 50_000, prose(rng, 20_000), "word " * 5_000]
    for _ in range(40):
        w = prose(rng, rng.randrange(8, 60)).split()
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w[at:at] = w[:rng.randrange(7, 14)]
        out.append(rng.choice(["\n", " "]).join(w))
    return out


def test_figures_against_brute_force(spark):
    texts = cases()
    rows = {r.doc_id: r for r in Q.quality_report(make_docs(spark, texts)).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r, want = rows[i], figures(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept == (not r.base_failed and r.failed_rules == "")


def test_verdicts(spark):
    clean = prose(random.Random(1), 80)
    texts = [clean, clean.upper(), " ".join(w + "&&&" for w in clean.split()), " ".join(f"q{i}z" for i in range(60)), None]
    kept = {r.doc_id: (r.kept, r.failed_rules) for r in Q.quality_report(make_docs(spark, texts)).collect()}
    assert kept[0] == (True, "")
    assert "shouted" in kept[1][1] and "symbols" in kept[2][1] and "stop_words" in kept[3][1]
    assert kept[4][0] is False


def test_filter_keeps_columns_that_clash(spark):
    clean = prose(random.Random(2), 50)
    docs = spark.createDataFrame([(1, clean, "a", 5, "k"), (1, clean, "a", 5, "k"), (2, None, None, None, None)],
                                 "doc_id long, text string, kept string, figures int, row string")
    out = Q.quality_filter(docs)
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [(1, clean, "a", 5, "k")] * 2


def test_empty_table_and_plan(spark):
    docs = make_docs(spark, [])
    assert Q.quality_report(docs).count() == 0
    plan = Q.quality_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_filter_keeps_languages_without_stop_words(spark):
    russian = " ".join(f"река течёт мимо старого города{k} где жили люди" for k in "абвгдежз")
    polish = " ".join(f"rzeka płynie obok starego miasta{k} gdzie żyli ludzie" for k in "abcdefgh")
    indonesian = " ".join(f"sungai mengalir melewati kota tua{k} tempat orang tinggal" for k in "abcdefgh")
    junk = " ".join(f"q{i}z" for i in range(60))
    clean = prose(random.Random(3), 60)
    cases = [(russian, "ru"), (russian, None), (russian, "und"), (polish, "pl-PL"), (polish, None), (indonesian, "id"), (clean, "en"), (clean, None),
             (junk, "en"), (junk, "de-AT"), (junk, None), (junk + " é ü ñ œ", None), (russian.replace(" ", " ### "), "ru"), ("река течёт", "ru")]
    docs = make_docs(spark, [t for t, _ in cases], langs=[x for _, x in cases])
    assert {r.doc_id for r in Q.quality_filter(docs).collect()} == set(range(8))
    assert {r.doc_id for r in Q.quality_filter(docs.drop("lang")).collect()} == {0, 1, 2, 3, 4, 6, 7}
    assert {r.doc_id for r in Q.quality_report(docs).where("kept").collect()} == {6, 7}
