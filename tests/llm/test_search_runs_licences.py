"""Ranked search, periodic runs and licence scans against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import licences, queries, runs, signatures, terms

DOCS = "doc_id long, text string, item_id string, score double, rank int, key long, block long, ids long, lang string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_list(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sentence(rng, count, letters="abcdef"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(count))


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(8)
    rows = [(n, sentence(rng, rng.randint(1, 60))) for n in range(60)]
    rows += [(n, "Alpha, beta; GAMMA_" + sentence(rng, 5)) for n in range(100, 104)] + [(103, "alpha beta"), (103, "alpha beta")]
    rows += [(110, None), (111, ""), (112, " \t\n.;"), (None, "alpha gamma"), (None, None)]
    rows += [(120, sentence(rng, 20000)), (121, "x" * 300000), (122, "Çà é ÉTÉ été"), (123, "alpha " * 5000), (124, "alpha " * 5000)]
    rows += [(130, "one two three " * 30), (131, "a " * 40 + "b " + "a " * 11), (132, "p q r s t u " * 2 + "p"), (133, "a\tb\x0ba b\r\n" * 9)]
    rows += [(140, "Released under the MIT License."), (141, "licensed under the GNU general public license, version 3; MIT LICENSE, mit license"), (142, "mit  licenses apache-license")]
    rows += [(n, "cycle of five words here " * rng.randint(3, 9) + sentence(rng, 30)) for n in range(200, 240)]
    return [(*row, "c", 0.5, 3, 4, 5, 6, "en") for row in rows]


@pytest.fixture(scope="module")
def docs(spark, awkward):
    return spark.createDataFrame(awkward, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def ranked(rows, items, top):
    """Every document scored by the definition."""
    counts = [(doc, Counter(term_list(text))) for doc, text in rows]
    counts = [(doc, held, sum(held.values())) for doc, held in counts if held]
    documents, words = len(counts), sum(size for _, _, size in counts)
    spread = Counter(term for _, held, _ in counts for term in held)
    answer = []
    for item, text in items:
        scored = []
        for doc, held, size in counts:
            norm = 10 + 90 * size * documents // words
            score = 0
            for term in set(term_list(text)) & set(held):
                weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * spread[term] + 1)))
                score += weight * (1000000000 * held[term] // (1000 * held[term] + 8 * norm))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        answer += [(item, place, doc, -low) for place, (low, _, _, doc) in enumerate(sorted(scored, key=lambda row: row[:3])[:top], 1)]
    return answer


@pytest.mark.parametrize("sizes", [{}, {"BLOCK_DOCS": 5, "ITEMS": 3, "SUMMED": 4}, {"WIDEST": 6, "NARROWEST": 5, "ITEM_TERMS": 2, "BLOCK_BYTES": 400}])
def test_search_against_a_full_scan(spark, docs, awkward, sizes, monkeypatch):
    for name, value in sizes.items():
        monkeypatch.setattr(signatures, name, value)
    rng = random.Random(5)
    items = [(n, sentence(rng, rng.randint(1, 12))) for n in range(9)]
    items += [(20, "ALPHA gamma"), (21, "alpha"), (22, None), (23, ""), (24, "unheard-of-words zzzz"), (25, "alpha " * 9 + "été"), (None, "beta alpha")]
    frame = spark.createDataFrame([*items, (20, "alpha gamma zz"), (21, "alpha")], "item_id long, text string").repartition(2)
    got = signatures.rank(docs, frame, top=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    wanted = ranked([row[:2] for row in awkward], [item for item in items if item[1]], 4)
    assert Counter(map(tuple, got.collect())) == Counter(wanted)


def test_search_takes_text_ids_and_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([("q", "alpha")], "item_id string, text string")
    named = docs.selectExpr("concat('d', doc_id) AS doc_id", "text")
    assert [row.doc_id for row in signatures.rank(named, items, 2).orderBy("rank").collect()] == ["d123", "d124"]
    assert signatures.rank(empty, items).count() == signatures.rank(docs, items.limit(0)).count() == 0
    assert signatures.rank(docs.where("text is null"), items).count() == 0


def test_bounds_are_never_too_low():
    rng = np.random.default_rng(2)
    vocabulary = [f"t{n}".encode() for n in range(40)]
    texts = [b" ".join(vocabulary[int(x)] for x in rng.zipf(1.3, size=int(rng.integers(1, 200))) % 40) for _ in range(50)]
    for bits in (16, 512):
        block = signatures._Block(ids=list(range(50)))
        for text in texts:
            found, times = np.unique(terms.hashed(text.split()), return_counts=True)
            block.terms.append(found)
            block.entered.append(signatures.levels(times))
        lengths = np.array([len(text.split()) for text in texts])
        norm = 10 + lengths
        asked = signatures.Asked.of([1, 2], [25, 30], [*vocabulary[:25], *vocabulary[10:]], {}, 50)
        bound = asked.bounds(block.sliced(bits), bits, lengths, norm)
        exact = np.stack([asked.scores(text, int(m)) for text, m in zip(texts, norm, strict=True)], axis=1)
        assert (bound >= exact).all() and exact.any()


def runs_of(words, least=12):
    """All runs, lag by lag over the whole text; a stretch counts for its smallest period."""
    found = {}
    for lag in range(1, len(words) // 2 + 1):
        start = None
        for at in range(len(words) - lag + 1):
            same = at + lag < len(words) and words[at] == words[at + lag]
            if same and start is None:
                start = at
            if not same and start is not None:
                if at + lag - start >= max(least, 2 * lag):
                    found.setdefault((start, at + lag), lag)
                start = None
    return sorted((start, lag, stop) for (start, stop), lag in found.items())


def found_runs(texts, least=12):
    numbers = {word: np.uint64(n * 7919) for n, word in enumerate(sorted({word for text in texts for word in text}))}
    words = np.array([numbers[word] for text in texts for word in text], dtype=np.uint64)
    edges = np.cumsum([0, *[len(text) for text in texts]])
    got = runs.find_runs(words, edges, least)
    place = np.searchsorted(edges, got.start, side="right") - 1
    answer = [[] for _ in texts]
    for text, start, stop, period in zip(place.tolist(), got.start.tolist(), got.stop.tolist(), got.period.tolist(), strict=True):
        answer[text].append((start - int(edges[text]), period, stop - int(edges[text])))
    return answer


piece = st.tuples(st.text("abc", max_size=9), st.integers(1, 9)).map(lambda part: part[0] * part[1])


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(piece, max_size=6).map("".join), max_size=4), st.integers(2, 12))
def test_runs_of_periodic_texts(texts, least):
    assert found_runs(texts, least) == [runs_of(text, least) for text in texts]


@pytest.mark.parametrize("limits", [(24, 256, 1 << 20), (0, 2, 3), (1, 8, 50)])
def test_runs_of_awkward_texts(limits, monkeypatch):
    for name, value in zip(("ROUNDS", "REACH", "PAIRS"), limits, strict=True):
        monkeypatch.setattr(runs, name, value)
    rng = random.Random(3)
    one, other = "a", "ab"
    for _ in range(9):
        one, other = other, other + one  # Fibonacci words: runs inside runs
    thue = "".join("ab"[bin(n).count("1") % 2] for n in range(200))
    texts = [other, thue, "a" * 300, "ab" * 70 + "a", "", "a", "abcdefghijkl" * 2, "abcdef" * 2, "abcdef" * 2 + "g" + "abcdef" * 3]
    texts += ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(0, 400))) for _ in range(20)]
    texts += ["".join(rng.choices("abcdefgh", k=n)) * 3 for n in range(1, 60, 7)]
    assert found_runs(texts) == [runs_of(text) for text in texts]


def test_collapse_against_the_definition(docs, empty, awkward):
    got = runs.collapse(docs, plant=True)
    wanted = []
    for doc, text, *_ in awkward:
        words = word_list(text)
        n, key = len(words), None if doc is None else zlib.crc32(str(doc).encode())
        if key is not None and key % 10 == 0 and n:
            a = key // 10 % n
            p = 1 + (n - a) // (3 + key // 10 % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        found = runs_of(words) if n < 3000 or len(set(words)) == 1 else found_runs([words])[0]
        gone = {i for start, lag, stop in found for i in range(start + lag, stop)}
        kept = " ".join(word for i, word in enumerate(words) if i not in gone)
        listed = "".join(f"{start},{stop - start},{lag}\n" for start, lag, stop in found)
        best = min(((start - stop, start, lag) for start, lag, stop in found), default=None)
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        wanted.append((doc, len(found), *longest, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), listed, kept))
    assert Counter(map(tuple, got.collect())) == Counter(wanted)
    assert any(zlib.crc32(str(row[0]).encode()) % 10 == 0 and row[1] for row in awkward if row[0] is not None)
    assert runs.collapse(empty).count() == 0
    assert runs.collapse(docs.selectExpr("cast(doc_id AS string) AS doc_id", "text"), plant=True).count() == len(awkward)


def test_collapse_leaves_texts_alone_without_planting(docs):
    kept = {row.doc_id: row.collapsed for row in runs.collapse(docs).where("doc_id in (122, 130, 132)").collect()}
    assert kept == {122: "Çà é ÉTÉ été", 130: "one two three", 132: "p q r s t u"}


def test_licences_against_patterns(docs, empty, awkward):
    got = {}
    for row in licences.scan(docs).collect():
        got.setdefault(row.doc_id, []).append(tuple(row)[1:])
    wanted = {}
    automata = licences.Scanner().automata
    for doc, text, *_ in awkward:
        words = term_list(text)
        body = " " + " ".join(words) + " "
        places = [(label, len(phrase.split()), i) for phrase, label in licences.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        more = [(label, automaton.mandatory) for (label, template), automaton in zip(licences.TEMPLATES, automata, strict=True) if re.search(queries._pattern(template), body)]
        size = max([size for _, size, _ in places] + [size for _, size in more], default=0)
        base = {label for label, _, _ in places}
        at = [i for _, _, i in places]
        labels = ",".join(sorted(base | {label for label, _ in more}))
        wanted.setdefault(doc, []).append((len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), labels, size / (size + 2)))
    assert {doc: Counter(rows) for doc, rows in got.items()} == {doc: Counter(rows) for doc, rows in wanted.items()}
    assert got[140][0][-2] == "mit" and got[141][0][-2] == "gpl,gpl-3.0,mit" and got[142][0][-3:] == ("apache", "apache", 0.5)
    assert licences.scan(empty).count() == 0
    assert licences.scan(docs.selectExpr("cast(doc_id AS string) AS doc_id", "text")).count() == len(awkward)


def test_every_template_accepts_its_own_wording():
    scanner = licences.Scanner()
    for label, template in licences.TEMPLATES:
        spare = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", "", template)
        for text in (template, spare):
            spoken = re.sub(r"\{\{(\d+),\d+\}\}", lambda gap: "any " * int(gap[1]), text).replace("[[", "").replace("]]", "")
            words = terms.hashed(terms.folded(f"before {spoken} after".encode()).split())
            assert label in [automaton.label for automaton in scanner.found(words)[1]], text
            missing = terms.hashed(terms.folded(spoken.encode()).split()[:-1])
            assert label not in [a.label for a in scanner.found(missing)[1] if a.mandatory >= len(spoken.split()) - 2 and not a.skips]


alphabet = st.sampled_from(["a", "b", "c", "x"])
template = st.recursive(
    st.one_of(alphabet, st.tuples(st.integers(0, 2), st.integers(0, 3)).map(lambda gap: f"{{{{{gap[0]},{gap[0] + gap[1]}}}}}")),
    lambda inner: st.lists(inner, min_size=1, max_size=3).map(lambda parts: "[[" + " ".join(parts) + "]]"),
    max_leaves=6,
)


@settings(deadline=None, max_examples=200)
@given(st.lists(template, max_size=5), st.lists(alphabet, max_size=12))
def test_automata_are_their_patterns(parts, words):
    text = " ".join(["a", "b", *parts])
    automaton = licences.Automaton.of("x", text)
    accepted = any(automaton.accepts(iter(words[start:])) for start in range(len(words)))
    assert accepted == bool(re.search(queries._pattern(text), " " + " ".join(words) + " "))


@pytest.mark.parametrize("text", ["a", "[[a]] b c", "a b [[c", "a b c]]", "a {{0,2}} b"])
def test_bad_markup_is_an_error(text):
    with pytest.raises(licences.MarkupError):
        licences.Automaton.of("x", text)
