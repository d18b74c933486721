import random
import zlib

import numpy as np
import pytest

from faremill.llm import langid
from faremill.llm.queries import QUERIES


def longest_match_phrases(text, reference):
    """Phrases of a cross-parsing, by searching the reference for every match."""
    count, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at:at + size + 1] in reference:
            size += 1
        count, at = count + 1, at + size
    return count


def parser_of(references):
    alphabet = np.unique(np.array([ord(c) for r in references.values() for c in r]))
    names = sorted(references)
    return langid.Parser(names, alphabet, [langid.parse_table(langid.automaton([ord(c) for c in references[n]]), alphabet) for n in names])


@pytest.mark.parametrize("lanes", [8192, 3])
def test_phrases_equal_those_found_by_searching(monkeypatch, lanes):
    monkeypatch.setattr(langid, "_LANES", lanes)
    pick = random.Random(4)
    references = {n: "".join(pick.choice(letters) for _ in range(300)) for n, letters in (("a", "abc"), ("b", "abcdef"), ("c", "xyzab"))}
    parser = parser_of(references)
    texts = ["".join(pick.choice("abcdexyzq") for _ in range(pick.randint(0, 80))) for _ in range(60)] + [references["b"][40:90]]
    codes = np.array([ord(c) for t in texts for c in t])
    ends = np.cumsum([len(t) for t in texts])
    expected = [[longest_match_phrases(t, references[n]) for n in parser.languages] for t in texts]
    assert parser.phrases(codes, ends).tolist() == expected


def test_long_texts_are_parsed_whole(monkeypatch):
    monkeypatch.setattr(langid, "PIECE", 10)
    reference, text = "abracadabra" * 5, "abracadabraxbracad" * 7
    parser = parser_of({"a": reference})
    expected = sum(longest_match_phrases(text[i:i + 10], reference) for i in range(0, len(text), 10))
    assert parser.phrases(np.array([ord(c) for c in text]), np.array([len(text)])).tolist() == [[expected]]


def test_spelling_drops_all_but_letters():
    codes, ends = langid.spelled(["  A-b!!c ", "", "12", "É\x00x", "a"])
    assert "".join(chr(c or 32) for c in codes) == "a b c é xa"
    assert ends.tolist() == [6, 6, 6, 9, 10]


LINES = {"en": "the cat sat on the mat and the dog ran to the house ", "fr": "le chat est sur la table et le chien court vers la maison "}


def test_edge_rows(spark):
    rows = [(i, LINES[l] * 3, l, "s") for i, l in enumerate(["en", "fr"] * 8)]
    rows += [(100, None, "en", "s"), (101, "", "fr", "s"), (102, "123 !!", None, "s"), (103, "the house and the dog", None, "s"),
             (103, "the house and the dog", None, "s"), (None, "le chien et la maison", "en", "s"), (104, LINES["fr"] * 5000, "fr", "s"), (105, "漢字", None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = langid.languages_of(docs).collect()
    assert len(found) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    by_id = {r.doc_id: r.lang_pred for r in found}
    assert [by_id[i] for i in (100, 101, 102, 103, None, 104)] == ["und", "und", "und", "en", "fr", "fr"]
    assert by_id[105] in ("en", "fr") and all(0 <= r.score <= 1 for r in found)
    assert langid.languages_of(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.languages_of(docs.filter("doc_id < 0 OR lang IS NULL")).collect()} == {"und"}


def test_no_learned_language_is_lost(spark, monkeypatch):
    """Long texts only, behind much that is no letter; and texts longer than the letters a language may have."""
    rows = [("en", LINES["en"] * 3), ("fr", "12 " * 20_000 + LINES["fr"] * 2000), ("fr", LINES["fr"] * 900)]
    texts = [LINES["fr"] * 40, LINES["en"] * 40]
    assert langid.train(spark.createDataFrame(rows, "lang string, text string")).best(texts)[0] == ["fr", "en"]
    monkeypatch.setattr(langid, "ALL_LETTERS", 400)
    small = langid.train(spark.createDataFrame([(l, LINES[l] * n) for l in LINES for n in (20, 30, 40)], "lang string, text string"))
    assert small.languages == ["en", "fr"] and small.best(texts)[0] == ["fr", "en"]


def test_a_language_of_thousands_of_letters(spark):
    han = "".join(chr(0x4E00 + i) for i in range(4000))
    parser = langid.train(spark.createDataFrame([("zh", han), ("zh", han * 4), ("en", LINES["en"])], "lang string, text string"))
    assert parser.best([han[1000:1400], LINES["en"]])[0] == ["zh", "en"]


def test_languages_of_thousands_of_letters_stay_small(monkeypatch):
    """Four languages of 24,000 letters over 3,000 each: dense tables of them took 1.5 GB."""
    pick = random.Random(8)
    references = {n: "".join(chr(0x4E00 + 3000 * i + int(3000 * pick.random() ** 2)) for _ in range(24_000)) for i, n in enumerate("abcd")}
    parser = parser_of(references)
    assert sum(a.nbytes for a in (parser.base, parser.owner, parser.after)) < 16 << 20
    texts = [references["b"][5000:5200], references["d"][:300] + "x" + references["a"][:100], "x" * 700]
    codes = np.array([ord(c) for t in texts for c in t])
    expected = [[sum(longest_match_phrases(t[i:i + langid.PIECE], references[n]) for i in range(0, len(t), langid.PIECE)) for n in parser.languages] for t in texts]
    assert parser.phrases(codes, np.cumsum([len(t) for t in texts])).tolist() == expected
    monkeypatch.setattr(langid, "MOST_BYTES", 1 << 20)
    with pytest.raises(ValueError, match="bytes of transitions"):
        parser_of(references)


def test_packed_rows_share_no_place():
    pick = random.Random(9)
    pairs = sorted({(min(int(pick.expovariate(0.01)), 999), pick.randrange(60)) for _ in range(6000)} | {(0, i) for i in range(60)})
    state, letter = np.array(pairs, np.int32).T
    target = np.arange(len(pairs), dtype=np.int32)
    base, owner, after = langid.packed(state, letter, target, 1000, 61)
    assert (owner >= 0).sum() == len(pairs)
    assert after[base[state] + letter].tolist() == target.tolist()
    held = set(pairs)
    for s in range(0, 1000, 7):
        assert [(s, c) in held for c in range(61)] == (owner[base[s] + np.arange(61)] == s).tolist()


def test_predictions_depend_on_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parser = langid.train(docs.filter(~langid.held_out()).select("lang", "text"))
    one = langid.with_language(docs.select("text"), parser).select("language.*").collect()
    assert [r.lang_pred for r in one] == parser.best([r.text for r in docs.select("text").collect()])[0]


def test_query_accuracy_on_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    found = QUERIES["op7_cross_parsing"](spark, path).collect()
    assert sorted(r.doc_id for r in found) == sorted(lang)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held) > 0
