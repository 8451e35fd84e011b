from __future__ import annotations

import random
import zlib

import pytest

from medoria.llm import spelling

LETTERS = {*map(chr, range(0x41, 0x5B)), *map(chr, range(0x61, 0x7B)), *map(chr, range(0xC0, 0x100))}


def counted(docs, min_length=6, min_count=5):
    """By the letter of the contract."""
    counts = {}
    for i, text in docs:
        run = ""
        for c in (text or "") + " ":
            if c in LETTERS:
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 199 == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
                if len(run) >= min_length:
                    counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if n >= min_count}


def edits(word, alphabet):
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    for c in alphabet:
        out |= {word[:k] + c + word[k:] for k in range(len(word) + 1)}
        out |= {word[:k] + c + word[k + 1 :] for k in range(len(word))}
    return out - {word}


def brute(counts):
    alphabet = {c for w in counts for c in w}
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = edits(w, alphabet) & counts.keys()
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def found(words):
    rows = spelling.variants(words).collect()
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_words_with_few_letters(spark, seed):
    """Nearly everything is near something, and grams repeat within a word."""
    draw = random.Random(seed)
    counts = {}
    for _ in range(900):
        word = "".join(draw.choice("abÿ") for _ in range(draw.choice((6, 6, 7, 8, 9, 14))))
        counts[word] = draw.choice((5, 6, 25, 30, 125, 126, 700))
    words = spark.createDataFrame([*counts.items()], "word string, n long").repartition(3)
    assert found(words) == brute(counts)


def test_edits_at_every_place(spark):
    draw = random.Random(4)
    counts = {}
    for _ in range(40):
        word = "".join(draw.choice("aeioulnrstdé") for _ in range(draw.randint(7, 12)))
        counts[word] = draw.randint(100, 200)
        for other in draw.sample(sorted(edits(word, "aeiz")), 60):
            if len(other) >= 6:
                counts.setdefault(other, draw.randint(5, 30))
    words = spark.createDataFrame([*counts.items()], "word string, n long").repartition(3)
    expected = brute(counts)
    assert found(words) == expected and sum(n for *_, n, _ in expected) > 4000


def test_no_edit_changes_more_grams_than_the_bound():
    draw = random.Random(5)
    for trial in range(400):
        alphabet = "ab" if trial % 2 else "abcde"
        pool = ["".join(draw.choice(alphabet) for _ in range(draw.randint(6, 12))) for _ in range(30)]
        grams = {s[p : p + 2]: 1 for w in pool for s in [spelling.marked(w)] for p in range(len(s) - 1)}
        word = draw.choice(pool)
        other = draw.choice(sorted(edits(word, alphabet)))
        for w in [*pool, other]:
            s = spelling.marked(w)
            grams |= {s[p : p + 2]: 1 for p in range(len(s) - 1)}
            for q in (3, 4):
                grams |= {s[p : p + q]: 1 for p in range(len(s) - q + 1) if draw.random() < 0.4 and s[p : p + q - 1] in grams}
        inner = spelling.beginnings(grams)
        s, t = spelling.marked(word), spelling.marked(other)
        of_s, of_t = spelling.decompose(s, grams), spelling.decompose(t, grams)
        shared = 0
        rest = [(t[p:e], p) for p, e in of_t]
        for p, e in of_s:
            for at in {p, p + len(t) - len(s)}:
                if (s[p:e], at) in rest:
                    rest.remove((s[p:e], at))
                    shared += 1
                    break
        for text, pieces in ((s, of_s), (t, of_t)):
            bound = spelling.affected(text, pieces, inner)
            assert shared >= len(pieces) - bound
            assert bound < len(pieces) or len(text) < 2 * spelling.LONGEST


def test_words_of_texts(spark):
    draw = random.Random(6)
    stems = ["".join(draw.choice("abcdeÉéÿÀ") for _ in range(draw.randint(4, 9))) for _ in range(40)]
    docs = [(k, " ".join(draw.choice(stems) for _ in range(60)).replace(" ", draw.choice((" ", "-", "1", "\n", "×")))) for k in range(120)]
    docs += [(None, "Maison MAISON maison maison maison maison"), (None, None), (500, ""), (501, "ab" * 40_000), *[(502, "xyz" * 30_000)] * 5]
    table = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(3)
    expected = counted(docs)
    assert {r["word"]: r["n"] for r in spelling.observed(table).collect()} == expected
    long = [(w, None, w, n, 0, None) for w, n in expected.items() if len(w) > 100]
    assert found(spelling.observed(table)) == sorted(brute({w: n for w, n in expected.items() if len(w) < 100}) + long)
    assert any(len(w) > 100 for w in expected)


def test_chains_of_forms(spark):
    chain = {"aaaaaa" + "b" * k: 5 * 5**k for k in range(12)}
    words = spark.createDataFrame([*chain.items()], "word string, n long")
    assert {r["word"]: r["root"] for r in spelling.variants(words).collect()} == dict.fromkeys(chain, "aaaaaa" + "b" * 11)


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.observed(docs)).count() == 0
    with pytest.raises(ValueError):
        spelling.near_pairs(spelling.observed(docs), min_length=5)
