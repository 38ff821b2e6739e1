from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest

from confluo.functions.text import STOP_WORDS
from confluo.operators import resolve as R
from tests.helpers import catalogue, doc

EDGES = "left_id string, entity_id string, score double"


def greedy(edges):
    taken_left, taken_entity, out = set(), set(), {}
    for left, entity, score in sorted(edges, key=lambda e: (-round(e[2], 6), e[0], e[1])):
        if left not in taken_left and entity not in taken_entity:
            taken_left.add(left)
            taken_entity.add(entity)
            out[left] = entity
    return out


def assigned(spark, edges):
    return {r.left_id: r.entity_id for r in R.assign_one_to_one(spark.createDataFrame(edges, EDGES)).collect()}


def test_worked_examples(spark):
    edges = [("half-life", "portal", 0.3), ("half-life", "half-life", 0.9), ("portal", "portal", 0.8), ("portal", "gta", 0.2)]
    assert assigned(spark, edges) == {"half-life": "half-life", "portal": "portal"}
    assert assigned(spark, [("Portal", "3", 2.0), ("Portal 2", "3", 3.0)]) == {"Portal 2": "3"}
    assert assigned(spark, [("Portal", "3", 2.0), ("Portal", "4", 1.0), ("Portal 2", "3", 3.0)]) == {"Portal 2": "3", "Portal": "4"}
    assert assigned(spark, []) == {}


@pytest.mark.parametrize("seed", range(2))
def test_assignment_is_stable_and_order_free(spark, seed):
    rng = random.Random(seed)
    lefts, entities = [f"l{i}" for i in range(60)], [f"e{i}" for i in range(40)]
    # A third of all edges meet one entity; scores tie often.
    edges = list({
        (left, "e0" if rng.random() < 0.33 else rng.choice(entities)): None for left in lefts for _ in range(5)
    })
    edges = [(left, e, float(rng.randint(1, 6)) if seed % 2 else rng.random()) for left, e in edges]
    rng.shuffle(edges)
    got = assigned(spark, edges)
    assert got == greedy(edges)
    assert len(set(got.values())) == len(got)
    rank = {(left, e): s for left, e, s in edges}
    holder = {e: left for left, e in got.items()}
    for left, e, s in edges:
        if got.get(left) == e:
            continue
        mine = rank[(left, got[left])] if left in got else -1
        theirs = rank[(holder[e], e)] if e in holder else -1
        assert not (s > mine and s > theirs), "blocking pair"
    again = R.assign_one_to_one(spark.createDataFrame(edges[::-1], EDGES).repartition(3)).collect()
    assert {r.left_id: r.entity_id for r in again} == got


@pytest.mark.parametrize("seed", range(2))
def test_chains_found_from_the_first_round_on_change_nothing(spark, seed):
    rng = random.Random(seed)
    edges = list({(f"l{rng.randint(0, 80)}", f"e{int(rng.expovariate(0.1))}"): None for _ in range(260)})
    edges = [(left, e, float(rng.randint(1, 9)) if seed else rng.random()) for left, e in edges]
    frame = spark.createDataFrame(edges, EDGES)
    got = {r.left_id: r.entity_id for r in R.assign_one_to_one(frame, plain_rounds=0).collect()}
    assert got == greedy(edges) == assigned(spark, edges)


def test_a_long_chain_settles_in_few_rounds(spark, caplog):
    """Every record wants the entity that the next one wants more."""
    n = 2000
    edges = [(f"l{i:05d}", f"e{i:05d}", 2.0 * i) for i in range(n)] + [(f"l{i:05d}", f"e{i + 1:05d}", 2.0 * i + 1) for i in range(n - 1)]
    with caplog.at_level("INFO", logger=R.__name__):
        assert assigned(spark, edges) == greedy(edges)
    (rounds,) = [int(m.split()[0]) for m in caplog.messages if m.endswith(" rounds")]
    assert rounds <= 15


def tokens(name):
    return [t for t in name.lower().split() if t not in STOP_WORDS]


def brute_edges(records, earlier, k=5):
    """Every record against every document, as the definition reads."""
    sources = {d[0] for d in earlier}
    holders = {}
    for d in earlier:
        holders.setdefault(d[2], set()).add(d[0])
    stats = {}
    for s in sources:
        bags = [tokens(d[3]) for d in earlier if d[0] == s and tokens(d[3])]
        df = {}
        for bag in bags:
            for t in set(bag):
                df[t] = df.get(t, 0) + 1
        stats[s] = (len(bags), sum(map(len, bags)) / max(len(bags), 1), df)
    edges = []
    for r in records:
        terms = set(tokens(r[3]))
        found = {}
        for d in earlier:
            bag = tokens(d[3])
            if not terms or not terms <= set(bag):
                continue
            n, avg, df = stats[d[0]]
            score = sum(
                math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag.count(t) * 2.2 / (bag.count(t) + 1.2 * (0.25 + 0.75 * len(bag) / avg))
                for t in terms
            )
            if r[9] and d[9] and abs(r[9] - d[9]) <= timedelta(days=14):
                score += 0.5
            if r[8] and set(r[8]) <= set(d[8]):
                score += 2
            found[d[2]] = found.get(d[2], 0) + score
        best = sorted(((e, s / len(holders[e])) for e, s in found.items()), key=lambda x: (-round(x[1], 6), x[0]))[:k]
        edges += [(r[1], e, s) for e, s in best]
    return edges


def random_docs(rng, source, n, entities, names, days=60):
    """One name in three is the same; dates and developers vary, some are missing."""
    pool = list(entities)
    rng.shuffle(pool)
    out = []
    for i in range(n):
        name = names[0] if rng.random() < 0.34 else rng.choice(names)
        date = datetime(2020, 1, 1) + timedelta(days=rng.randint(0, days), hours=rng.choice([0, 0, 7])) if rng.random() < 0.8 else None
        devs = rng.sample(["A", "B", "C"], rng.randint(0, 2))
        out.append(doc(source, f"{source}{i:03d}", name, entity=pool[i], devs=devs, date=date))
    return out


NAMES = ["star game", "star", "game", "star game two", "game star star", "moon", "the of", "moon star game", "lost moon base", "base base"]


@pytest.mark.parametrize(("seed", "sources"), [(1, 1), (3, 2), (5, 3)])
def test_edges_match_brute_force_on_copies(spark, seed, sources):
    rng = random.Random(seed)
    entities = [f"e{i:03d}" for i in range(130)]
    names = [f"r{s}" for s in range(sources)]
    earlier = [d for s in names for d in random_docs(rng, s, 100, entities, NAMES)]
    records = random_docs(rng, "new", 90, [f"x{i}" for i in range(90)], NAMES)
    expected = {(left, e): s for left, e, s in brute_edges(records, earlier)}
    frames = catalogue(spark, records), catalogue(spark, earlier)
    got = {(r.left_id, r.entity_id): r.score for r in R.candidate_edges(*frames, names).collect()}
    assert got.keys() == expected.keys()
    assert all(got[key] == pytest.approx(expected[key]) for key in expected)
    # Dropping copies that can never be chosen does not change the matching.
    pruned = R.assign_one_to_one(R.candidate_edges(*frames, names, for_matching=True)).collect()
    assert {r.left_id: r.entity_id for r in pruned} == greedy([(left, e, s) for (left, e), s in expected.items()])


def test_copies_do_not_multiply(spark):
    """Thousands of copies on both sides: names meet once, edges stay linear."""
    left = catalogue(spark, [doc("n", i, "same old game", devs=["D"], date="2020-01-01") for i in range(3000)])
    right = catalogue(spark, [doc("o", i, "the same old game", entity=f"e{i:05d}", devs=["D"], date="2020-01-05") for i in range(3000)])
    assert R.name_candidates(R.left_records(left), R.right_documents(right)).count() == 1
    edges = R.candidate_edges(left, right, ["o"]).cache()
    assert edges.count() == 15000 and edges.select("entity_id").distinct().count() == 5
    pruned = R.candidate_edges(left, right, ["o"], for_matching=True)
    assert pruned.count() == 25 and R.assign_one_to_one(pruned).count() == 5


def test_a_short_name_in_very_many_names_stays_five_candidates(spark, monkeypatch):
    """One word that 10,000 different names hold: what the record meets is never listed, and the best five are those of the definition."""
    rng = random.Random(4)
    earlier = [
        doc("o", i, f"star {i:05d}" + " far" * (i % 3), entity=f"e{i:05d}", devs=rng.sample("ABCD", i % 3), date=datetime(2020, 1, 1) + timedelta(days=i % 400) if i % 5 else None)
        for i in range(10_000)
    ]
    records = [doc("n", i, "star", devs=d, date=t) for i, (d, t) in enumerate([(["A"], "2020-03-01"), (["B", "C"], None), ([], "2020-07-09"), ([], None), (["Z"], "1990-01-01")])]
    records.append(doc("n", 9, "star far far", devs=["D"], date="2020-05-05"))
    stored, store = {}, R.store_step
    monkeypatch.setattr(R, "store_step", lambda df, name: stored.setdefault(name, store(df, name)))
    frames = catalogue(spark, records), catalogue(spark, earlier)
    got = {(r.left_id, r.entity_id): r.score for r in R.candidate_edges(*frames, ["o"]).collect()}
    expected = {(left, e): s for left, e, s in brute_edges(records, earlier)}
    assert got.keys() == expected.keys() and len(got) == 30
    assert all(got[key] == pytest.approx(expected[key]) for key in expected)
    assert stored["weights"].count() == 1
    assert {r.lkey for r in stored["names"].select("lkey").distinct().collect()} == {"far star"}


def test_names_without_terms_get_new_entities(spark):
    first = [doc("a", 1, "The Of"), doc("a", 2, "Portal")]
    second = [doc("b", 1, "the of"), doc("b", 2, None), doc("b", 3, "portal"), doc("b", 4, "portal quest")]
    rows = R.resolve_sources(spark, [("a", catalogue(spark, first)), ("b", catalogue(spark, second))])
    got = {(r.source, r.id): (r.entity_id, r.reused) for r in rows.collect()}
    assert [got[("b", i)][1] for i in "1234"] == [False, False, True, False]
    assert got[("b", "3")][0] == got[("a", "2")][0] and len({e for e, _ in got.values()}) == 5
    stats = {r.source: (r.reused, r.generated) for r in R.resolution_stats(rows).collect()}
    assert stats == {"a": (0, 2), "b": (1, 3)}


def test_explain_edges_adds_up(spark):
    left = catalogue(spark, [doc("n", 1, "star game", devs=["A"], date="2020-01-01")])
    right = catalogue(spark, [doc("o", 1, "star game", entity="e1", devs=["A", "B"], date="2020-01-15"), doc("p", 2, "game", entity="e1")])
    edges = R.candidate_edges(left, right, ["o", "p"])
    rows = {r.source: r for r in R.explain_edges(edges, left, right).collect()}
    assert (rows["o"].name_met, rows["o"].date_bonus, rows["o"].dev_bonus) == (True, 0.5, 2.0)
    assert (rows["p"].name_met, rows["p"].date_bonus, rows["p"].dev_bonus) == (False, 0.0, 0.0)
    base = R.name_candidates(R.left_records(left), R.right_documents(right)).first().score
    assert edges.first().score == pytest.approx((base + 2.5) / 2)


def test_a_common_name_looks_for_bonuses_only_where_they_can_count(spark, monkeypatch):
    """Two words that 400 of 4,000 names hold: signatures too far below the best five meet none of the record's dates and developers."""
    rng = random.Random(6)
    earlier = [
        doc("o", i, ("star game" if i < 400 else "moon") + f" {i:05d}" * (1 + i % 40), entity=f"e{i:05d}", devs=rng.sample("ABCD", i % 3), date=datetime(2020, 1, 1) + timedelta(days=i % 90) if i % 5 else None)
        for i in range(4000)
    ]
    records = [doc("n", i, "game star", devs=rng.sample("ABC", i % 3), date=datetime(2020, 1, 1) + timedelta(days=3 * i) if i % 7 else None) for i in range(40)]
    stored, store = {}, R.store_step
    monkeypatch.setattr(R, "store_step", lambda df, name: stored.setdefault(name, store(df, name)))
    got = {(r.left_id, r.entity_id): r.score for r in R.candidate_edges(catalogue(spark, records), catalogue(spark, earlier), ["o"]).collect()}
    expected = {(left, e): s for left, e, s in brute_edges(records, earlier)}
    assert got.keys() == expected.keys() and len(got) == 200
    assert all(got[key] == pytest.approx(expected[key]) for key in expected)
    assert stored["names"].count() == 400 and stored["near"].count() < 200
