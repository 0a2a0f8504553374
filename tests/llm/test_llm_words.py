import re

import numpy as np
import pyarrow as pa

from threadloom.llm.streams import whole_groups
from threadloom.llm.words import ALNUM, SPACED, rolling, words_of

TEXTS = ["", None, "one", "Ünïcode WORDS, here\tand\nthere", " a  a ", "x" * 5000, "\x00\x01", "one", "a1 B2-c3 é"]


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_words_follow_their_expressions_and_hashes_are_of_the_word_alone():
    seen = {}
    for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        for first, last, words in words_of(pa.array(TEXTS), table):
            for i in range(first, last):
                expected = [w.replace("\x00", "") for w in re.findall(pattern, fold(TEXTS[i]))]
                expected = [w for w in expected if w]
                assert len(words.of(i - first)) == len(expected)
                for word, value in zip(expected, words.of(i - first).tolist()):
                    if "\x01" not in word:
                        assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_nul_is_part_of_a_word_and_not_a_separator():
    (_, _, words), = words_of(pa.array(["a\x00b", "a b", "ab", "\x00"]), SPACED)
    assert [len(words.of(i)) for i in range(4)] == [1, 2, 1, 1]
    assert words.of(0)[0] != words.of(2)[0]


def test_rolling_runs_stay_inside_their_text():
    bounds = np.array([0, 0, 2, 5])
    value, runs = rolling(np.array([1, 2, 1, 2, 3], np.uint64), bounds, 2)
    assert runs.tolist() == [0, 0, 1, 3]
    assert value[0] == value[1] != value[2]


def test_whole_groups_are_never_cut():
    keys = [1, 1, 1, 2, 3, 3, 3, 3, None, None]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + 2], pa.int64())], names=["k"]) for i in range(0, 10, 2)]
    groups = []
    for table, bounds in whole_groups(iter(batches), ["k"]):
        values = table.column("k").to_pylist()
        groups += [values[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    assert groups == [[1, 1, 1], [2], [3, 3, 3, 3], [None, None]]
