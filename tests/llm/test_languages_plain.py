"""Language identification against a plain version, and the choice of training rows where one language holds most."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from moonstride.llm import language_codes as codes


def trigrams(text):
    """Places of the trigrams of a text that has a blank on either side."""
    read = [32, *(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode()), 32]
    a, b, c = codes._PLACES.tolist()
    return [a[x] ^ b[y] ^ c[z] for x, y, z in zip(read, read[1:], read[2:])]


def plain(train, texts):
    """(language, share) per text, learned from pairs of text and language."""
    languages = sorted({lang for _, lang in train})
    counts = {lang: Counter() for lang in languages}
    for text, lang in train:
        counts[lang].update(trigrams(text))
    share = {
        lang: lambda place, c=c, total=sum(c.values()): (c[place] + 0.5) / (total + 0.5 * codes.DIMENSIONS) for lang, c in counts.items()
    }
    words = codes.codewords(len(languages)).tolist()

    def odds(place, bit):
        sides = {1: [], -1: []}
        for lang, word in zip(languages, words):
            sides[word[bit]].append(share[lang](place))
        return math.log(sum(sides[1]) / len(sides[1])) - math.log(sum(sides[-1]) / len(sides[-1]))

    def margins(text):
        places = trigrams(text)
        return [sum(odds(p, bit) for p in places) / len(places) if places else 0.0 for bit in range(len(words[0]))]

    judged = [(margins(text), words[languages.index(lang)]) for text, lang in train]
    trust, scale = [], []
    for bit in range(len(words[0])):
        right = sum(m[bit] * w[bit] > 0 for m, w in judged) / len(judged)
        trust.append(max(0.05, 2 * right - 1))
        scale.append(max(1e-6, sum(abs(m[bit]) for m, _ in judged) / len(judged)))
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            yield "und", 0.0
            continue
        m = margins(text)
        losses = [sum(t * math.log1p(math.exp(-4 * x / s * t * b)) for x, s, t, b in zip(m, scale, trust, word)) for word in words]
        parts = [math.exp(min(losses) - loss) for loss in losses]
        best = max(range(len(parts)), key=lambda k: (parts[k], -k))
        yield languages[best], parts[best] / sum(parts)


@pytest.mark.parametrize("languages", [2, 3, 4])
def test_against_a_plain_version(llm, languages):
    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    names = sorted(r.lang for r in docs.select("lang").distinct().collect())[:languages]
    rows = [tuple(r) for r in docs.where(F.col("lang").isin(names)).orderBy("doc_id").limit(60).collect()]
    rows = [(i, t[:400], lang) for i, t, lang in rows]
    more = [(1000, None), (1001, ""), (1002, "12 !?"), (1003, "é"), (1004, "Über alles"), (1005, " ".join(t for _, t, _ in rows[:20]))]
    model = codes.fit(llm.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = llm.createDataFrame([(i, t) for i, t, _ in rows] + more, "doc_id long, text string")
    got = {r.doc_id: r for r in codes.identify(asked, model).collect()}
    texts = [(i, t) for i, t, _ in rows] + more
    for (i, _), (lang, score) in zip(texts, plain([(t, lang) for _, t, lang in rows], [t for _, t in texts])):
        assert got[i].score == pytest.approx(score, abs=1e-4)
        assert got[i].lang_pred == lang or got[i].score == pytest.approx(1 / len(names), abs=1e-3)


def test_a_very_long_text(llm, tricky):
    model = codes.fit(tricky)
    short = "Beta3 alpha7 été12 "
    pair = llm.createDataFrame([(1, short * 50), (2, short * 200_000)], "doc_id long, text string")
    one, other = codes.identify(pair, model).orderBy("doc_id").collect()
    assert one.lang_pred == other.lang_pred and one.score == pytest.approx(other.score, abs=1e-2)


@pytest.mark.parametrize("count", [1, 5, 100, 5000])
def test_lowest_hashes_of_every_language(llm, count):
    rng = np.random.RandomState(count)
    hot = [("hot", int(h), i) for i, h in enumerate(rng.randint(-(2**63), 2**63 - 1, 3000))]
    close = [("close", (7 << 40) + int(h), i) for i, h in enumerate(rng.randint(0, 1 << 39, 400))]
    repeated = [("repeated", -5, 9)] * 300 + [("repeated", -5, k) for k in range(20)]
    rows = hot + close + repeated + [("few", 2**63 - 1, 1)]
    ids = llm.createDataFrame([(lang, (h, i)) for lang, h, i in rows], "lang string, at struct<hash: long, id: long>")
    got = {r["lang"]: tuple(r["last"]) for r in codes.first_by_hash(ids, count).collect()}
    for lang in {lang for lang, _, _ in rows}:
        mine = sorted((h, i) for name, h, i in rows if name == lang)
        assert got[lang] == mine[: count][-1]
