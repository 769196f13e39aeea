import random

import numpy as np
import pytest

from goldpan.llm import substrings
from goldpan.llm.decontaminate import Block, tiles
from goldpan.llm.licenses import LicenseScanner, TokenAutomaton, license_words
from goldpan.llm.neardup import shingles, similar, sketches
from goldpan.llm.pages import main_text
from goldpan.llm.substrings import Anchors
from goldpan.llm.topk import BlockIndex
from goldpan.llm.toxicity import LexiconAutomaton, Settings, ToxicityCounter, edits_allowed
from goldpan.llm.words import word_hashes


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lexicon_automaton_equals_edit_distance():
    rng = random.Random(3)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randint(3, 11))) for _ in range(12)]
    automaton = LexiconAutomaton(terms)
    for _ in range(2000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        near = [d for t in terms if (d := edit_distance(word, t)) <= edits_allowed(t)]
        assert automaton.distance(word) == min(near, default=None)


def test_quotation_is_told_from_abuse():
    counter = ToxicityCounter(["scoundrel"], Settings())
    assert counter.count("you scoundrel go away") == (1, 0, 0, 0)
    assert counter.count("you scoundrell go away") == (0, 1, 0, 0)
    assert counter.count('the "scoundrel" was named')[3] == 1
    assert counter.count("the word scoundrel is old")[3] == 1
    assert counter.count(None) == counter.count("") == (0, 0, 0, 0)


def test_tiles_catch_reordered_passages():
    item = list(range(20))
    assert sum(n for *_, n in tiles(item, item[10:] + [-1] + item[:10], 5)) == 20
    assert tiles(item, item[::-1], 5) == []
    assert sum(n for *_, n in tiles([1, 1, 1, 1, 1, 1], [1, 1, 1], 3)) == 3


def test_block_measures_coverage():
    words = [f"w{k}" for k in range(40)]
    block = Block.of([(7, " ".join(words)), (8, "too short")], 5)
    assert block.compare("x " + " ".join(words[20:] + ["y"] + words[:20]).upper(), 0.5) == [(7, 1.0)]
    assert block.compare(" ".join(words[:19]), 0.5) == []
    assert block.compare(None, 0.5) == block.compare("", 0.5) == []


def test_token_automaton_regions():
    a = TokenAutomaton("licensed under the <<optional>>gnu <</optional>>license<<optional>> version <<var:[0-9]:1-2>><</optional>>")
    runs = lambda text: a.matches(license_words(text))
    assert runs("licensed under the license")[0] == (0, 4)
    assert (1, 8) in runs("X Licensed, under the GNU license; version 3.")
    assert runs("licensed under that license") == [] and runs("") == []
    with pytest.raises(ValueError):
        TokenAutomaton("<<optional>>all<</optional>>")
    with pytest.raises(ValueError):
        TokenAutomaton("a <<optional>>b")


def test_license_scan_places():
    n, places, first, last, base, labels, _ = LicenseScanner().scan("All Rights reserved. cc by cc by\nLicensed under CC BY-NC 4.0.")
    assert (n, places, first, last, base) == (14, 4, 0, 9, {"reserved", "cc-by"}) and "cc-by-nc-4.0" in labels
    assert LicenseScanner().scan(None)[:4] == (0, 0, None, None)


def test_order_sketch_and_alignment():
    words = [f"w{k}" for k in range(300)]
    edited = words[:150] + ["new"] + words[150:]
    (_, a), (_, b), (_, c) = (shingles(" ".join(w), 5) for w in (words, edited, words[150:] + words[:150]))
    assert similar(a, b, 0.8) and not similar(a, c, 0.8)  # the same shingles in another order are no near copy
    assert set(enumerate(sketches(a, 32, 6))) & set(enumerate(sketches(b, 32, 6)))
    assert shingles("a b", 5)[0] == shingles("A, b!", 5)[0] != shingles("a c", 5)[0]
    assert shingles(None, 5)[0] is None and shingles(" ", 5)[0] is None
    repeated = shingles("x " * 50, 5)[1]
    assert len(set(repeated.tolist())) == len(repeated)


def test_difference_cover_finds_every_shared_window():
    anchors = Anchors(13, 7, (0, 1, 3))
    rng = np.random.default_rng(1)
    for _ in range(200):
        shared = [f"s{k}" for k in range(13)]
        texts = [[f"{t}{k}" for k in range(rng.integers(0, 30))] + shared + [f"{t}z{k}" for k in range(rng.integers(0, 9))] for t in "ab"]
        a, b = (set(anchors.of(word_hashes(t))[1].tolist()) for t in texts)
        assert a & b
    with pytest.raises(ValueError):
        Anchors(13, 7, (0, 1))


def test_block_index_equals_brute_force():
    rng = np.random.default_rng(2)
    vectors, ids = rng.integers(-9, 9, (500, 6)), rng.permutation(500)
    index = BlockIndex(ids, vectors, 16)
    for q in range(0, 500, 50):
        at = int(np.flatnonzero(ids == q)[0])
        scores = vectors @ vectors[at]
        best = sorted((-int(s), int(i)) for s, i in zip(scores, ids, strict=True) if i != q)[:10]
        got_ids, got = index.search(q, vectors[at], 10, None)
        assert sorted((-int(s), int(i)) for s, i in zip(got, got_ids, strict=True)) == best


def test_main_text_of_pages():
    page = ("<html><body><header>Top of site</header><div class='cookie-notice'>We use cookies on this site</div><div id='content'><h1>A &amp; B</h1>"
            "<p>The first  paragraph is long enough\nto be text &lt;here&gt;.</p><p>Short.</p><form>Name <input></form><script>x()</script></div>"
            "<div class='comments'><p>A reader says something rather long here as well.</p></div><footer>(c) 2020</footer>")
    assert main_text(page) == "A & B\nThe first paragraph is long enough to be text <here>.\nShort."
    assert main_text(None) == main_text("") == main_text("<p></p>") == ""
    assert main_text("<div>" * 3000 + "deep text" + "</div>" * 3000) == "deep text"


def test_a_passage_of_many_documents_is_compared_once_per_task():
    starts, hashes = np.arange(3), np.array([5, 1 << 60, 1 << 63], np.uint64)
    sent = substrings._dealt([(own, -own, starts, hashes) for own in (7, 3, 9, 4)])
    asked = sent[~sent["known"]]
    assert sorted(np.frombuffer(b"".join(asked["windows"]), np.uint64)) == sorted(hashes)
    assert set(np.frombuffer(b"".join(asked["ids"]), np.int64)) == {3}
    known = np.frombuffer(b"".join(sent["places"][sent["known"]]), np.int64)
    assert sorted(known) == sorted((-own << 32) + s for own in (7, 9, 4) for s in range(3))


def test_anchors_are_packed_and_sent_at_most_twice():
    anchors = np.array([0, 1 << 20, 1 << 47, (1 << 48) - 1], np.uint64)
    sent = substrings._tally([anchors] * 3 + [anchors[1:2] + np.uint64(1)])
    values = [(at, v) for at, packed in zip(sent["segment"], sent["anchors"], strict=True) for v in substrings._unpacked(packed).tolist()]
    assert len(values) == 9 and len(set(values)) == 5  # unlike ones of a segment stay unlike
    slots = anchors % np.uint64(substrings.FILTER_BITS)
    assert set(sent["segment"]) == set((slots // np.uint64(substrings.SEGMENT_BITS)).tolist())
