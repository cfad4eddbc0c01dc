import random

import pytest

from tidewright.llm import mojibake as m

WORDS = {
    "de": "für größer Prüfung läuft über Schlüssel Änderung Zähler Größe prüft Länge früh Übergabe".split(),
    "fr": "précédent élément répète clé donnée système période où été vérifie même modèle".split(),
    "pl": "Każdy główny wartość będzie ścieżka łączy część następny węzeł wysyła żółty później".split(),
    "ru": "Этот последний ключ проверяет очередь каждый период возвращает запись новый граница".split(),
    "ja": "この新しい値を返す期間 次の空の表を削除する記録 各最後の鍵を確認する行 この共通の窓を保持する".split(),
}
PLAIN = "the ledger returns value while window keeps a record of each claim".split()


def texts(n, seed):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        lang = r.choice(list(WORDS))
        out.append((lang, " ".join(w for _ in range(r.randint(4, 12)) for w in (r.choice(PLAIN), r.choice(WORDS[lang])))))
    return out


def garbled(text, wrong, right="utf-8"):
    raw = text.encode(right)
    return "".join(chr(b) if b < 128 else _read(bytes([b]), wrong) for b in raw)


def _read(b, codec):
    try:
        return b.decode(codec)
    except UnicodeDecodeError:
        return chr(b[0])


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    rows, truth = [], {}
    for i, (lang, t) in enumerate(texts(1500, 5)):
        kind = r.random()
        bad = None
        if kind < 0.04:
            bad = garbled(t, "cp1252")
        elif kind < 0.07:
            bad = garbled(t, "latin-1")
        elif kind < 0.09:
            bad = garbled(t, "cp437")
        elif kind < 0.10:
            bad = garbled(garbled(t, "cp1252"), "cp1252")
        elif kind < 0.12 and lang == "ru":
            bad = garbled(t, "latin-1", "cp1251")
        elif kind < 0.14 and lang in ("de", "fr"):
            bad = t.encode("cp1252").decode("utf-8", "replace")
            truth[i] = None
        elif kind < 0.16 and lang == "de":
            bad = garbled(t, "mac_roman", "cp1252")
        if bad and bad != t:
            truth.setdefault(i, t)
            rows.append((i, bad, r.choice(["s1", "s2", None])))
        else:
            rows.append((i, t, r.choice(["s1", "s2", None])))
    meant = ["x² ± 3 %", "if c == '�': # mark", "Ã is a letter", "├── src\n└── lib", "naïve résumé", "√2 ≈ 1.414", "한 칸", "👩‍🔧", "5\xa0ms", "﻿start", "", None, "ascii only"]
    rows += [(10_000 + i, t, "s1") for i, t in enumerate(meant)]
    return rows, truth


def test_found_and_restored(spark, corpus):
    rows, truth = corpus
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, chain string").repartition(3)
    got = {r.doc_id: r for r in m.repair(df, "doc_id", "text", "source").collect()}
    hits = sum(i in got for i in truth)
    assert hits >= 0.98 * len(truth)
    assert len(got.keys() - truth.keys()) <= 0.02 * len(truth)
    assert not any(i >= 10_000 for i in got)
    whole = [i for i, t in truth.items() if t is not None and i in got]
    assert sum(got[i].repaired == truth[i] for i in whole) >= 0.95 * len(whole)
    assert all(not got[i].restorable for i, t in truth.items() if t is None and i in got)


def test_fields_have_priors_of_their_own(spark, corpus):
    rows, truth = corpus
    df = spark.createDataFrame([(i, t, "größer als Übermut, naïve" if i % 3 else None, s) for i, t, s in rows], "doc_id long, title string, body string, source string").repartition(3)
    got = m.repair(df, "doc_id", ["title", "body"], "source").collect()
    found = {r.doc_id: r for r in got if r.field == "title"}
    assert not any(r.field == "body" for r in got)  # the clean field stays clean
    assert sum(i in found for i in truth) >= 0.98 * len(truth) and len(found.keys() - truth.keys()) <= 0.02 * len(truth)


def test_rounds_come_to_rest(spark, corpus):
    df = spark.createDataFrame(corpus[0], "doc_id long, text string, source string")
    moved = m.fit(df, "text", "source").moved
    assert len(moved) == 4 and moved[-1] < 0.005 and moved[-1] < moved[0]


def test_nothing_to_find(spark):
    df = spark.createDataFrame([(1, None, None), (2, "", "s"), (3, "plain", "s")], "doc_id long, text string, source string")
    assert m.repair(df, "doc_id", "text", "source").collect() == []
    assert m.repair(df.limit(0), "doc_id", "text").collect() == []


@pytest.mark.parametrize("codec", ["latin-1", "cp1252", "cp1251", "cp437", "mac_roman"])
def test_chains_undo_what_they_did(codec):
    for t in ("größer", "очередь", "この値"):
        assert m.undo(garbled(t, codec), m.Chain(codec, "utf-8")) == [t]
    assert m.undo(garbled(garbled("é", "cp1252"), "cp1252"), m.Chain("cp1252", "utf-8", 2)) == ["é"]
    assert "É" in m.undo(garbled(garbled("É", "latin-1"), "cp1252"), m.Chain("cp1252", "utf-8", 2))
    assert m.undo("é", m.Chain("latin-1", "utf-8")) == []


def test_halves_of_characters():
    s = garbled("この期間を表", "cp1252", "shift_jis")
    assert m.undo(s[: s.index("\\")], m.Chain("cp1252", "shift_jis")) == ["この期間を" + m.CUT_OFF]


def test_readings_begin_with_what_stands_there():
    kinds, texts_ = m.readings("Ã¼ber")
    assert (kinds[0], texts_[0]) == (m.MEANT, "Ã¼ber") and "über" in texts_
    assert m.readings("F�r") == ([m.LOSSY], ["F�r"])
