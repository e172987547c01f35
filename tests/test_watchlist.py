"""Watchlist tables and repeated topic merging against plain Python."""

from __future__ import annotations

import math
import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from newsloom.operators import keywords, watchlist

RNG = random.Random(9)
WORDS = ["alpha", "Beta", "gam", "de", "é", "日本語", "x", "ab ab", "zeta-eta", "aaaa"]


def titles_df(spark, titles):
    return spark.createDataFrame(list(enumerate(titles)), "id long, title string").repartition(3)


def plain_matches(titles, terms):
    lowered = {t.lower() for t in terms if t is not None}
    return Counter((i, t) for i, title in enumerate(titles) if title is not None for t in lowered if t in title.lower())


@pytest.mark.parametrize("terms", [
    [*WORDS, "ALPHA", None], ["a", "é", "本"], ["ab", "zz"], [""], ["", "alpha b"], ["no such term"], [],
])
def test_matches_equal_a_nested_loop(spark, terms):
    titles = [" ".join(RNG.choices(WORDS, k=RNG.randint(0, 6))) for _ in range(120)] + [None, "", "alpha", "ALPHA", "alpha", "q" * 5000 + "alpha"]
    df = spark.createDataFrame([(t,) for t in terms], "term string")
    got = watchlist.matching_terms(titles_df(spark, titles), df).collect()
    assert Counter((r.id, r.term) for r in got) == plain_matches(titles, terms)


def test_many_terms_make_no_nested_loop(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("term"), F.col("id").cast("string"), F.lit("!")).alias("term"))
    titles = titles_df(spark, ["about term17! and TERM99999!", "term100000! is not there", "term1! term2! term1!"] * 20)
    found = watchlist.matching_terms(titles, terms)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert Counter(r.term for r in found.collect()) == {"term17!": 20, "term99999!": 20, "term1!": 20, "term2!": 20}


def test_topics_are_hit_by_keyword_or_title(spark):
    schema = "run_id string, topic_id int, top_keywords array<string>, representative_items array<struct<title: string>>"
    topics = spark.createDataFrame(
        [("r", 0, ["Alpha", "b"], [("none",)]), ("r", 1, ["b"], [("see ALPHAs",), (None,)]), ("r", 2, [], []), ("s", 0, ["x"], [("y",)]), ("r", 3, ["alpha"], [("alpha",)])],
        schema,
    )
    terms = spark.createDataFrame([("alpha",), (None,)], "term string")
    got = {(r.run_id, r.topic_id): (r.in_keywords, r.in_titles) for r in watchlist.watched_topics(topics, terms).collect()}
    assert got == {("r", 0): (True, False), ("r", 1): (False, True), ("r", 3): (True, True)}
    bonus = {(r.run_id, r.topic_id): r.watchlist_bonus for r in watchlist.with_watchlist_bonus(topics, terms).collect()}
    assert bonus == {("r", 0): 80.0, ("r", 1): 80.0, ("r", 2): 0.0, ("s", 0): 0.0, ("r", 3): 80.0}


def plain_merge(counts, volumes, nr_topics, per_round):
    counts = {t: Counter(c) for t, c in counts.items()}
    volumes, target = dict(volumes), {t: t for t in volumes}
    while len(volumes) > nr_topics:
        some = sorted(volumes, key=lambda t: (volumes[t], -t))[: min(per_round, len(volumes) - nr_topics)]
        totals = Counter()
        for c in counts.values():
            totals.update(c)
        average = math.floor(sum(totals.values()) / len(counts))
        weights = {t: {w: n * math.log1p(average / totals[w]) for w, n in c.items()} for t, c in counts.items()}
        stay = [t for t in volumes if t not in some]
        step = {}
        for t in some:
            best = None
            for other in sorted(stay):
                shared = weights.get(t, {}).keys() & weights.get(other, {}).keys()
                if shared:
                    dot = sum(weights[t][w] * weights[other][w] for w in shared)
                    close = round(dot / math.sqrt(sum(v * v for v in weights[other].values())), 9)
                    if best is None or close > best[0]:
                        best = (close, other)
            step[t] = best[1] if best else min(stay, key=lambda x: (-volumes[x], x))
        for t, other in step.items():
            counts.setdefault(other, Counter()).update(counts.pop(t, {}))
            volumes[other] += volumes.pop(t)
        target = {t: step.get(x, x) for t, x in target.items()}
    return target


@pytest.mark.parametrize(("nr_topics", "per_round"), [(4, 1), (4, 5), (1, 3), (30, 1)])
def test_merging_equals_plain_rounds(spark, nr_topics, per_round):
    rng = random.Random(5)
    counts = defaultdict(dict)
    for topic in range(14):
        for word in rng.sample(range(topic // 3 * 4, topic // 3 * 4 + 12), 6):
            counts[topic][f"w{word}"] = rng.randint(1, 9)
    counts[14] = {"only": 3}
    counts[15] = dict(counts[2])
    counts[16] = dict(counts[2])
    volumes = {t: rng.randint(1, 6) for t in counts} | {17: 1}
    df = spark.createDataFrame([("r", t, w, n) for t, c in counts.items() for w, n in c.items()], "run_id string, topic_id int, term string, n long")
    sizes = spark.createDataFrame(list(volumes.items()), "topic_id int, volume long")
    got = {r.topic_id: r.merged_id for r in keywords.merge_topics(df, nr_topics, sizes, per_round).collect()}
    assert got == plain_merge(counts, volumes, nr_topics, per_round)
    assert len(set(got.values())) == min(nr_topics, len(volumes))


def test_merging_checks_its_options(spark):
    df = spark.createDataFrame([], "run_id string, topic_id int, term string, n long")
    sizes = spark.createDataFrame([], "topic_id int, volume long")
    with pytest.raises(ValueError):
        keywords.merge_topics(df, 0, sizes)
    assert keywords.merge_topics(df, 2, sizes).collect() == []


def test_runs_of_a_long_title_take_time_by_its_length(spark):
    # one title of a few hundred thousand characters beside short ones of any script
    titles = ["x" * 300_000 + "needle", "ab", "a", "", "né\U0001f600é", "aaaa"]
    frame = spark.createDataFrame(list(enumerate(titles)), "id bigint, title string")
    for n in (1, 2, 3):
        rows = frame.filter(F.length("title") >= n).select("id", watchlist._title_grams("title", n).alias("g"))
        start = time.perf_counter()
        got = {r.id: sorted(r.g) for r in rows.collect()}
        assert time.perf_counter() - start < 20
        assert got == {i: sorted({t[k : k + n] for k in range(len(t) - n + 1)}) for i, t in enumerate(titles) if len(t) >= n}
