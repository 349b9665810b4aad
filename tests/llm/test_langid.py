from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from wattspindle.llm import langid, queries


def brute_counts(text):
    """n-grams of up to three letters of each word, with one mark before and behind it."""
    counts = {}
    word = ""
    for c in [*text.lower(), " "]:
        if ord(c) < langid.LETTERS_END and c.isalpha():
            word += c
            continue
        if word:
            marked = f"\0{word}\0"
            for gram in word:
                counts[gram] = counts.get(gram, 0) + 1
            for n in (2, 3):
                for i in range(len(marked) - n + 1):
                    counts[marked[i : i + n]] = counts.get(marked[i : i + n], 0) + 1
        word = ""
    return counts


def key(gram):
    value = len(gram)
    for c in gram:
        value = value << 20 | ord(c)
    return value


@pytest.mark.parametrize("chunk", [1_000_000, 7])
def test_gram_counts(odd_texts, documents, monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    for text in [*odd_texts[:8], *odd_texts[10:], *documents.text.head(20)]:
        keys, counts = langid.gram_counts(text or "")
        wanted = {key(g): n for g, n in brute_counts(text or "").items()}
        assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == wanted


def test_prediction_is_the_out_of_place_distance(documents):
    rows = []
    for lang, texts in documents.groupby("lang").text:
        counts = brute_counts(" ".join(texts))
        top = sorted(counts, key=lambda g: (-counts[g], key(g)))[: langid.PROFILE]
        rows += [(lang, key(g), i) for i, g in enumerate(top)]
    profiles = langid.Profiles(rows)
    place = {(lang, k): i for lang, k, i in rows}
    for text in documents.text.head(40):
        counts = brute_counts(text)
        listed = sorted(counts, key=lambda g: (-counts[g], key(g)))[: langid.LISTED]
        distance = {
            lang: sum(
                min(abs(place[lang, key(g)] - i), langid.PROFILE) if (lang, key(g)) in place else langid.PROFILE
                for i, g in enumerate(listed)
            )
            for lang in profiles.languages
        }
        best = min(distance, key=lambda x: (distance[x], x))
        lang, score = profiles.predict(text)
        assert lang == best
        assert score == pytest.approx(1 - distance[best] / (langid.PROFILE * len(listed)))


def test_query_on_held_out_rows(llm, sf_dir, documents):
    found = queries.QUERIES["op5_language_id"](llm, sf_dir).toPandas().set_index("doc_id")
    docs = documents.set_index("doc_id")
    assert sorted(found.index) == sorted(docs.index)
    assert found.held_out.to_dict() == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in docs.index}
    held = found[found.held_out]
    right = (held.lang_pred == docs.lang.reindex(held.index)).mean()
    assert right >= 0.95
    assert found.score.between(0, 1).all()


def test_odd_texts_nulls_and_clashes(make, odd_texts):
    rows = [(i, "the house and the garden are here", "en") for i in range(8)]
    rows += [(10 + i, "das haus und der garten sind hier", "de") for i in range(8)]
    rows += [(None, "la maison", "fr"), (30, None, "en"), (31, "nothing", None), (30, None, "en")]
    docs = make(*rows, *[(100 + i, t) for i, t in enumerate(odd_texts)])
    docs = docs.withColumn("score", F.lit("clash"))
    profiles = langid.learn(docs)
    assert profiles.languages == ["de", "en"]
    found = langid.identify(docs, profiles).collect()
    assert len(found) == len(rows) + len(odd_texts)
    for r in found:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert 0 <= r.score <= 1
    assert {r.score for r in found if r.text == "日本語のテキスト"} == {0.0}
    assert {r.lang_pred for r in found if r.doc_id in range(8)} == {"en"}


def test_nothing_to_learn_from(make):
    assert langid.identify(make(), langid.learn(make())).collect() == []
    docs = make((1, "some text"))
    assert langid.identify(docs, langid.learn(docs)).collect()[0].lang_pred == "und"
