"""Very long words and texts take linear time and give what the plain definitions give."""

import random
import re
import time

from duebook.llm import toxicity


def test_bare_words_equal_the_plain_pattern():
    chance = random.Random(1)
    edges = re.compile(r"^[\W_]+|[\W_]+$")
    for _ in range(5_000):
        word = "".join(chance.choice("aZé1_!-ß\u0301漢😀ⅷ²") for _ in range(chance.randrange(1, 9)))
        assert toxicity.bare(word) == edges.sub("", word.lower())


def test_nearness_equals_all_pairs():
    chance = random.Random(2)
    for _ in range(300):
        hits, persons = (sorted(chance.sample(range(80), chance.randrange(12))) for _ in range(2))
        assert toxicity.near_any(hits, persons) == sum(any(abs(i - p) <= toxicity.NEAR for p in persons) for i in hits)


def test_features_of_long_texts_take_seconds():
    start = time.perf_counter()
    toxicity.features("a" + "!" * 1_000_000 + "a", frozenset(["a"]))
    toxicity.features("a" + "!" * 1_000_000, frozenset(["a"]))
    toxicity.features("you fool " * 100_000, frozenset(["fool"]))
    assert time.perf_counter() - start < 20
