import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scorekit.llm.quality import (
    VOCABULARIES,
    Vocabulary,
    fit_bands,
    judge_quality,
    measure_texts,
    script_of,
)
from scorekit.llm.queries import op11_quality
from tests.llm.corpus import documents, prose, texts

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def counts_by_hand(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    inside = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        sum(line in lines[:i] for i, line in enumerate(lines)),
        len(inside),
    )


def measures_by_hand(text, vocabulary):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    tokens = [t for w in words for t in vocabulary.encode([w])[0]]
    if not tokens:
        return 0, None, None, None
    share = [n / len(tokens) for n in Counter(tokens).values()]
    return (
        len(tokens),
        sum(map(len, words)) / len(tokens),
        sum(bool(vocabulary.is_byte[t]) for t in tokens) / len(tokens),
        -sum(p * math.log2(p) for p in share),
    )


def awkward():
    rng = random.Random(6)
    return [
        "a\n\na\n a\na ",
        "line one\nline one\r\nline one\n\x0b\n\x0b",
        "1 2 3 4 5 6 1 2 3 4 5 7 2 3 4 5 7",
        "x " * 300,
        "漢字 かな 한글 Привет #*$%&|<> 🙂 \x00    z",
        "w" * 70_000 + " tail",
        "\n".join(prose(rng, 9) for _ in range(40)) * 2,
    ]


@pytest.fixture(scope="module")
def rows():
    found = [*texts(), *[(900 + i, t) for i, t in enumerate(awkward())]]
    return found


def test_counts_and_measures_equal_brute_force(spark, rows):
    vocabularies = [Vocabulary(p) for p in VOCABULARIES]
    found = measure_texts(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    wanted = Counter()
    for key, text in rows:
        measures = [measures_by_hand(text, v) for v in vocabularies]
        wanted[key, *counts_by_hand(text), *[_near(x) for m in measures for x in m]] += 1
    names = [f"{n}_{v}" for v in (0, 1) for n in ("n_tokens", "chars_per_token", "byte_share", "entropy")]
    got = Counter((r.doc_id, *[r[n] for n in NAMES], *[_near(r[n]) for n in names]) for r in found)
    assert got == wanted


def _near(x):
    return x if x is None else round(x, 9) + 0.0


def test_bands_are_those_of_the_quartiles(spark):
    rng = random.Random(7)
    values = [("en", rng.gauss(4, 0.3), rng.gauss(6, 0.2)) for _ in range(301)]
    values += [("de-AT", 3.0, 5.0)] * 150 + [("x y", 2.0, 4.0)] * 40 + [(None, 2.0, 4.0)] * 40
    schema = "lang string, chars_per_token_0 double, entropy_0 double, byte_share_0 double, script string, n_tokens_0 bigint"
    df = spark.createDataFrame([(g, c, e, 0.0, "Latin", 100) for g, c, e in values], schema)
    bands = {(r.class_name, r.length_class): r for r in fit_bands(df, 1, reach=5, least_texts=100).collect()}
    assert set(bands) == {("lang:en", 3), ("lang:de", 3), ("script:Latin", 3)}
    assert [bands[n, 3].texts for n in ("lang:en", "lang:de", "script:Latin")] == [301, 150, 531]
    steps = sorted(math.floor(c / 0.01) for g, c, _ in values if g == "en")
    q1, q3 = steps[75], steps[225]  # the 76th and the 226th of 301
    wide = max(5 * (q3 - q1 + 1) * 0.01, 0.6)
    low, high = bands["lang:en", 3].bands[0][1:]
    assert math.isclose(low, q1 * 0.01 - wide) and math.isclose(high, (q3 + 1) * 0.01 + wide)


def test_verdicts(spark, rows):
    rng = random.Random(8)
    plain = [(2000 + i, prose(rng, 80 + i % 40)) for i in range(300)]
    odd = [(3000, "zq" * 4000 + " " + prose(rng, 20)), (3001, " ".join(rng.choice("abc") for _ in range(400)))]
    odd += [(3002, " ".join(chr(0xE0041 + i) * 2 for i in range(40)) + " " + prose(rng, 60))]
    found = judge_quality(documents(spark, [*rows, *plain, *odd])).collect()
    assert len(found) == len(rows) + len(plain) + len(odd)
    for r in found:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed and not r.outside)
        assert (r.band is None) == (r.n_tokens_0 < 64) and (r.band is not None or r.outside == [])
        if 2000 <= (r.doc_id or 0) < 3000:
            assert r.kept and r.band == "lang:en"
        if (r.doc_id or 0) >= 3000:
            assert not r.kept and r.outside


def test_query_and_few_rows(spark, rows, tmp_path):
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_quality(spark, str(tmp_path))
    assert len(set(found.columns)) == len(found.columns)
    wanted = Counter()
    for key, text in rows:
        own = counts_by_hand(text)
        wanted[key, *own, own[0] < 10 or 100 * own[4] > 20 * own[0]] += 1
    assert Counter(tuple(r) for r in found.select("doc_id", *NAMES, "base_failed").collect()) == wanted
    assert judge_quality(documents(spark).limit(0)).collect() == []
    one = judge_quality(documents(spark, [(1, prose(random.Random(1), 100))])).collect()
    assert [(r.band, r.kept) for r in one] == [("usual", True)]


def test_one_vocabulary_and_other_columns(spark):
    df = spark.createDataFrame([(1, "some words here", None)], "id int, body string, tongue string")
    found = measure_texts(df, VOCABULARIES[:1], "body", "id", "tongue").collect()
    assert found[0].n_words == 3 and "entropy_1" not in found[0].asDict()
    judged = judge_quality(df, VOCABULARIES[:1], "body", "id", "tongue")
    assert judged.select(F.col("kept")).collect() == [(False,)]


def test_scripts():
    assert [script_of(t) for t in ("abc!", "Привет a", "漢字漢字かな", "123 !?", "", "한글", "été")] == [
        "Latin", "Cyrillic", "Han", "none", "none", "Hangul", "Latin",
    ]
