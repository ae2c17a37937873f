import random
import re
from collections import Counter

import pyarrow as pa

from silverline.llm.quality import RULES, Texts, cascade, judge_quality, rule_order


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_metrics_against_brute_force(spark):
    rnd = random.Random(2)
    pool = ["a", "bb", "The", "#x", "é|", "\n", "\n\n", "\t", " ", "\x0b", "日本", "$$$", "word"]
    texts = [None, "", " \n ", "one", "a\na\na"] + ["".join(rnd.choice(pool) + rnd.choice(["", " ", "\n"]) for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    texts.append("one two three four five six " * 30_000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in judge_quality(df).collect():
        want = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_the_order_never_changes_the_verdict():
    rnd = random.Random(3)
    clean = "some plain words that differ from each other and end in a stop"
    texts = pa.array([clean, clean.upper(), "! ".join(clean.split()), " | ".join(clean.split()), "go go go go go stop stop stop stop stop now ok",
                      "1 2 3 4 5 6 7 8 9 10 a b", "", None, "\n".join(["some other line"] * 2 + [clean])])
    measured = Texts(texts).measure()
    want = cascade(measured, list(RULES)).tolist()
    assert want[0] and not any(want[1:8]) and want[8]
    for _ in range(10):
        order = list(RULES)
        rnd.shuffle(order)
        assert cascade(measured, order).tolist() == want


def test_order_comes_from_the_sample_and_edges_hold(spark):
    texts = ["A TEXT IN CAPITALS " * 3 + str(i) for i in range(50)] + ["plain words without any fault at all in this text here"] * 50
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    order = rule_order(df)
    assert sorted(order) == sorted(RULES) and order.index("upper_case") < order.index("word_length")
    assert judge_quality(df.limit(0)).collect() == []
    row = judge_quality(spark.createDataFrame([("x", 1, 2)], "text string, KEPT int, other int")).first()
    assert row.kept is False and row.other == 2
