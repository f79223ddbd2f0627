"""Toxicity: automata against edit distances, contexts, and held-out accuracy."""

from __future__ import annotations

import zlib

import pytest
from hypothesis import given, settings, strategies as st

from hopgrid.llm import toxicity as tx


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


TERMS = ["abab", "babab", "aabbaabb", "abcabcabca", "ccc*"]


@settings(max_examples=400, deadline=None)
@given(st.text("abc", max_size=13))
def test_automaton_is_edit_distance(word):
    got = tx.FuzzyLexicon(TERMS).match(word)
    exact = word in TERMS or word.startswith("ccc")
    close = any(not t.endswith("*") and distance(word, t) <= tx.allowed_errors(t) for t in TERMS)
    assert got == (1 if exact else 2 if close else 0)


def test_contexts():
    text = 'he "idiot" and idiot said: idiot'
    assert tx.quoted(text, 4, 9)
    assert not tx.quoted("you idiot go", 4, 9)
    assert tx.quoted("the word idiot is", 9, 14)


def test_held_out(spark):
    read = lambda n: spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    got = {r.doc_id: r for r in tx.score(docs, tx.learn(docs, labels)).collect()}
    assert len(got) == docs.count()
    pairs = [(r.toxic, got[r.doc_id]) for r in labels.collect()]
    held = [(y, g) for y, g in pairs if g.held_out]
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 5 == 0) and g.predicted == (g.score >= 0.5) for _, g in pairs)
    assert sum(y == g.predicted for y, g in held) >= 0.85 * len(held)


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 0), (2, 0)], [(1, None), (None, 1), (2, 7)]])
def test_little_to_learn(spark, rows):
    docs = spark.createDataFrame([(1, "bad"), (2, None), (3, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    got = tx.score(docs, tx.learn(docs, labels)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert tx.score(docs.where("false"), tx.learn(docs, labels)).count() == 0


def test_full_words_and_beginnings_take_errors():
    chosen = tx.choose_terms({"scum*": 30, "scumbag": 12, "scumbags": 18, "scumba*": 30}, {}, 50, 50)
    assert {"scumbag", "scumbags"} <= set(chosen) and any(t.endswith("*") for t in chosen)
    lexicon = tx.FuzzyLexicon(["scumbag", "scumb*", "moro", "idiot"])
    for word in ("scmbag", "csumbag", "sxumbag", "scunbly", "mroo", "idoit"):
        assert lexicon.hit(word) > 1, word
    assert lexicon.match("scunbly") == 2 and lexicon.hit("idiot") == 1
    assert tx.FuzzyLexicon(["idiot"], frozenset(["idot"])).hit("idot") == 0


def misspelled_recall(spark, sf_dir):
    """Held-out toxic texts reduced to their hits, misspelled: how many are found; and how many held-out clean texts are marked."""
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    docs, labels = read("documents"), read("labels")
    model = tx.learn(docs, labels)
    terms = tx.FuzzyLexicon(model.terms)
    rows = docs.join(labels, "doc_id").where(tx.held_out("doc_id")).select("text", "toxic").collect()
    toxic = []
    for r in rows:
        words = [m.group() for m in tx.WORD.finditer(r.text or "") if terms.match(m.group().lower()) == 1 and len(m.group()) > 3
                 and not tx.quoted(r.text.lower(), *m.span())] if r.toxic == 1 else []
        if words:
            swap = {w: w[:2] + w[3:] if len(w) > 5 else w[:1] + w[2] + w[1] + w[3:] for w in words}  # a letter dropped, or two swapped
            text = tx.WORD.sub(lambda m: swap.get(m.group(), m.group()), r.text)
            if not any(terms.match(w.lower()) == 1 for w in tx.WORD.findall(text)):
                toxic.append(text)
    clean = [r.text or "" for r in rows if r.toxic == 0]
    marked = lambda texts: sum(s >= 0.5 for s in model.scores(texts)) if texts else 0
    return marked(toxic), len(toxic), marked(clean), len(clean)


def test_misspelled_only(spark):
    found, toxic, wrong, clean = misspelled_recall(spark, "/root/testdata/sf0.01")
    assert toxic and found >= 0.7 * toxic and wrong <= 0.03 * clean


def rare_corpus(n_terms=400, each=12):
    """Toxic texts with one term each of a long-tailed vocabulary; every term stands in ``each`` of them, 0.25 % of all."""
    letters = "bdfgklmnprstvz"
    term = lambda k: "q" + "".join(letters[k // 14 ** i % 14] + "aeiou"[(k + i) % 5] for i in range(3)) + "x"
    filler = lambda i: f"some plain words here number {'abcdefghij'[i % 10] * 5} and more"
    toxic = [(i, f"{filler(i)} {term(i % n_terms)}", 1) for i in range(n_terms * each)]
    return toxic + [(len(toxic) + i, filler(i), 0) for i in range(len(toxic))]


def test_rare_terms_of_a_long_tail(spark):
    rows = spark.createDataFrame(rare_corpus(), "doc_id long, text string, toxic int").repartition(4)
    got = tx.score(rows, tx.learn(rows, rows)).join(rows, "doc_id").where("held_out").groupBy("toxic").agg({"predicted": "avg"}).collect()
    share = {r[0]: r[1] for r in got}
    # LEAST documents must be left when a fifth is held out: nearly every term has them
    assert share[1] > 0.85 and share[0] == 0
