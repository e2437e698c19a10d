from __future__ import annotations

import random
from collections import Counter

import pytest

from helpers import ODD_ROWS, components, empty_docs, exact_groups, normalised, odd_docs, simhash as plain_simhash
from slotflow.llm import dedup, simhash
from slotflow.llm.components import components as connected


def copies(seed: int = 4, n: int = 120):
    """Texts with exact copies, copies but for blanks, and near copies, of several sizes."""
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        words = random.choices(vocabulary, k=random.choice([3, 60, 300]))
        for _ in range(random.choice([1, 1, 2, 5])):
            changed = list(words)
            if random.random() < 0.5:
                changed[random.randrange(len(changed))] = random.choice(vocabulary)
            rows.append((len(rows) * 7 % 1009, random.choice([" ", "  ", "\n"]).join(changed)))
    random.shuffle(rows)
    return rows


@pytest.mark.parametrize("rows", [ODD_ROWS, copies()], ids=["odd", "copies"])
@pytest.mark.parametrize("prefix", [1, 64])
def test_exact_groups(text_spark, rows, prefix):
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = dedup.exact_duplicates(docs, prefix=prefix, digests=True)
    assert Counter(map(tuple, found.collect())) == Counter(exact_groups(rows))


def test_digest_only_where_needed(text_spark):
    docs = text_spark.createDataFrame([(1, "same"), (2, "sa me"), (3, "other length")], "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in dedup.exact_duplicates(docs).collect()}
    assert found[3]["text_sha256"] is None and found[1]["text_sha256"] == found[2]["text_sha256"]
    assert (found[1]["kept"], found[2]["kept"], found[2]["keep_id"]) == (False, True, 2)


def test_one_row_stays(text_spark):
    left = dedup.without_duplicates(odd_docs(text_spark))
    assert left.columns == odd_docs(text_spark).columns
    rows = [(r["doc_id"], r["text"]) for r in left.collect()]
    known = [(k, normalised(t)) for k, t in rows if k is not None]
    assert len({t for _, t in known}) == len(known)
    assert sum(k is None for k, _ in rows) == 2
    assert {t for _, t in known} >= {normalised(t) for k, t in ODD_ROWS if k is not None}


def test_fingerprints():
    random.seed(5)
    texts = [t for _, t in ODD_ROWS] + ["".join(random.choice("aB cé\t\n\x0b\x0c\x1c ") for _ in range(40)) for _ in range(500)]
    for text in texts:
        assert simhash.fingerprint(text) % 2**64 == plain_simhash(text), repr(text)[:80]
    assert simhash.fingerprint("a b c d e f g " * 50, at_once=7) == simhash.fingerprint("a b c d e f g " * 50)


@pytest.mark.parametrize("rows", [ODD_ROWS, copies(6)], ids=["odd", "copies"])
def test_near_groups(text_spark, rows):
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = simhash.near_duplicates(docs).collect()
    prints = [plain_simhash(t) for _, t in rows]
    roots = components([k for k, _ in rows], prints)
    assert Counter(map(tuple, found)) == Counter((k, f"{p:016x}", c) for (k, _), p, c in zip(rows, prints, roots))


@pytest.mark.parametrize("bucket", [1, 6, 1000])
@pytest.mark.parametrize("plan", [None, [(list(range(32)), 1), (list(range(32, 64)), 0)], [(list(range(64)), 2)]], ids=["dealt", "two", "one"])
def test_no_link_is_lost(text_spark, monkeypatch, bucket, plan):
    random.seed(bucket)
    values = set()
    for _ in range(25):
        centre = random.getrandbits(64)
        for _ in range(random.randint(1, 20)):
            v = centre
            for b in random.sample(range(64), random.randint(0, 3)):
                v ^= 1 << b
            values.add(v)
    signed = {v - 2**64 if v >= 2**63 else v: v for v in values}
    if plan:
        monkeypatch.setattr(simhash, "allocate", lambda *_: plan)
    distinct = text_spark.createDataFrame([(v,) for v in signed], "fp bigint").repartition(3)
    edges = simhash.links(distinct, 2, bucket).collect()
    assert all((signed[a] ^ signed[b]).bit_count() <= 2 for a, b in edges)
    roots = {r["node"]: r["root"] for r in connected(simhash.links(distinct, 2, bucket)).collect()}
    keys = list(signed)
    assert [roots.get(k, k) for k in keys] == components(keys, [signed[k] for k in keys])


def test_thresholds_fill_the_pigeonholes():
    import numpy as np

    rng = np.random.default_rng(1)
    bits = rng.random((500, 64)) < rng.random(64)
    both = bits.T.astype(float) @ bits
    for n in (500, 10**7, 10**10):
        plan = simhash.allocate(n, both * n / 500, 2)
        used = [b for group, _ in plan for b in group]
        assert len(used) == len(set(used)) and sum(t + 1 for _, t in plan) == 3


def test_a_chain_is_one_component(text_spark):
    chain = text_spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (3, 3)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in connected(chain).collect()}
    assert all(found[i] == 0 for i in range(201)) and found[500] == found[400] == 400


def test_empty_tables(text_spark):
    assert dedup.exact_duplicates(empty_docs(text_spark)).collect() == []
    assert simhash.near_duplicates(empty_docs(text_spark)).collect() == []
    assert simhash.without_near_duplicates(empty_docs(text_spark)).collect() == []


def test_one_of_each_component_stays(text_spark):
    rows = [(i, t) for i, (_, t) in enumerate(copies(8, 40))]
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r["doc_id"] for r in simhash.without_near_duplicates(docs).collect()}
    assert kept == set(components([k for k, _ in rows], [plain_simhash(t) for _, t in rows]))


def test_one_row_of_a_group_is_kept_whatever_its_key(text_spark):
    rows = [(5, "a b"), (5, "ab"), (5, "a b"), (None, "a  b"), (None, "x"), (None, "x"), (7, "y")]
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = Counter(map(tuple, dedup.exact_duplicates(docs, digests=True).collect()))
    assert found == Counter(exact_groups(rows)) and sum(n for row, n in found.items() if row[3]) == 3
