"""Mixing: targets, apportionment and quotas against plain Python."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from silverline.llm.mixing import apportion, mixed_texts, plan_mix, taken_spans

COLUMNS = "doc_id long, text string, source string"


def water_level(sizes, weights, repeats=3):
    """Share, stop at the limit, share the excess again until none is above."""
    out, rest, free = {}, Fraction(sum(sizes.values())), set(sizes)
    while free:
        level = rest / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > repeats * sizes[s]}
        if not over:
            return out | {s: level * weights[s] for s in free}
        for s in over:
            out[s] = Fraction(repeats * sizes[s])
            rest -= out[s]
        free -= over
    return out


def highest_quotients(weights, seats):
    """Seat by seat to the highest quotient, the first of equals."""
    won = Counter()
    for _ in range(seats):
        best = max((w / (2 * won[p] + 1), -i) for i, (p, w) in enumerate(weights.items()) if w > 0)
        won[list(weights)[-best[1]]] += 1
    return won


def mixed(docs, block_words, shard_words, repeats=3, seed=12):
    """{row: words taken} by walking every block of every shard."""
    size = {i: len((t or "").split()) for i, (_, t, _) in enumerate(docs)}
    names = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    sizes = {s: sum(size[i] for i, d in enumerate(docs) if d[2] == s) for s in names}
    goal = water_level(sizes, weights, repeats)
    seats = highest_quotients({s: float(goal[s]) for s in names}, sum(sizes.values()) // block_words)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    taken = Counter()
    for k, s in enumerate(names, 1):
        rows = [i for i, d in enumerate(docs) if d[2] == s]
        n_shards = -(-(sizes[s] + len(rows)) // shard_words)
        key = {i: md5(f"{seed}:{docs[i][0] if docs[i][0] is not None else ''}") for i in rows}
        shards = defaultdict(list)
        for i in rows:
            shards[int(key[i][:8], 16) % n_shards].append(i)
        words = {h: sum(size[i] for i in shards[h]) for h in sorted(shards)}
        quota = highest_quotients({h: float(w) for h, w in words.items()}, seats[s]) if any(words.values()) else {}
        for h, members in shards.items():
            n = -(-words[h] // block_words)
            if not n:
                continue
            q = min(quota.get(h, 0), repeats * n)
            turn, r = int(md5(f"{seed}:{k}:{h}")[:8], 16) % n, q % n
            line = [i for i in sorted(members, key=lambda i: (key[i], size[i])) for _ in range(size[i])]
            for at, i in enumerate(line):
                j = at // block_words
                taken[i] += q // n + ((j + 1 + turn) * r // n - (j + turn) * r // n)
    return {i: (size[i], sizes[docs[i][2]], float(goal[docs[i][2]]), taken[i]) for i in range(len(docs))}


def corpus():
    docs = []
    for i in range(240):
        source = ["b", "a", None, "Z", "hot", "hot", "é", ""][i % 8]
        n = 400 if i == 77 else (i * 37) % 23
        docs.append((i, " ".join(f"w{i}x{k}" for k in range(n)) if i % 11 else (None if i % 2 else " \n"), source))
    docs.append((7, "a row with the id of another", "tiny"))
    docs.append((7, "a row with the id of another", "tiny"))
    return docs


@pytest.mark.parametrize("block_words,shard_words", [(1, 50), (7, 100), (3, 10_000)])
def test_plan_is_the_block_by_block_mix(spark, block_words, shard_words):
    docs = corpus()
    got = plan_mix(spark.createDataFrame(docs, COLUMNS).repartition(5), block_words=block_words, shard_words=shard_words)
    want = mixed(docs, block_words, shard_words)
    rows = Counter((r.doc_id, r.source, r.size, r.source_size, round(r.target, 6), r.taken) for r in got.collect())
    assert rows == Counter((d[0], d[2], w[0], w[1], round(w[2], 6), w[3]) for d, w in zip(docs, want.values()))


def test_near_targets_and_never_over_the_limit(spark):
    plan = plan_mix(spark.createDataFrame(corpus(), COLUMNS)).toPandas()
    assert (plan.taken <= 3 * plan["size"]).all()
    for _, rows in plan.groupby("source", dropna=False):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) <= 0.03 * rows.target.iloc[0] + 1


@pytest.mark.parametrize("seats", [0, 1, 2, 17, 1000])
def test_highest_quotients(spark, seats):
    weights = {0: 5.0, 1: 5.0, 2: 1.0, 3: 0.0, 4: 0.25, 5: 733.0, 6: 5.0}
    df = spark.createDataFrame([(p, w, seats) for p, w in weights.items()], "p int, w double, seats long")
    got = {r.p: r.won for r in apportion(df, "w", "seats", [], [F.col("p")], "won").collect()}
    assert got == {p: highest_quotients(weights, seats)[p] for p in weights}


def test_texts_hold_what_the_plan_takes(spark):
    docs = [(i, "\t".join(f"d{i}é{k}" for k in range(i % 9)) or None, "abc"[i % 3]) for i in range(60)]
    frame = spark.createDataFrame(docs, COLUMNS)
    plan = plan_mix(frame, block_words=4)
    words = Counter()
    for r in mixed_texts(frame, plan).collect():
        words[r.doc_id] += len(r.text.split())
        assert r.text in dict((d[0], d[1]) for d in docs)[r.doc_id]
    assert words == Counter({r.doc_id: r.taken for r in plan.collect() if r.taken})
    assert taken_spans(plan).filter("start < 0 or end <= start").count() == 0


def test_empty_table_and_other_columns(spark):
    assert plan_mix(spark.createDataFrame([], COLUMNS)).count() == 0
    odd = spark.createDataFrame([(1, "a b c", "s", 5, "x")], "doc_id int, text string, source string, size int, `from` string")
    assert [(r.doc_id, r.size, r.taken) for r in plan_mix(odd).collect()] == [(1, 3, 3)]
    only_empty = spark.createDataFrame([(1, None, "s"), (None, "", None)], COLUMNS)
    assert {(r.doc_id, r.size, r.target, r.taken) for r in plan_mix(only_empty).collect()} == {(1, 0, 0.0, 0), (None, 0, 0.0, 0)}
