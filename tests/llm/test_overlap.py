"""Filter audit, SimHash groups and hard negatives against plain versions, odd rows and empty tables."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from loadshift.llm import catalog, filter_audit, hard_negatives, simhash_cover

# ---- op 11


def audit_rows(df):
    return {(r.part, r.filter_order, r.step): [r[c] for c in filter_audit.COUNTS] for r in df.collect()}


def test_gray_walk_gives_every_subset():
    rng = np.random.default_rng(5)
    for k in (1, 2, 5):
        cells = rng.integers(0, 9, (3, 1 << k, 3))
        masks = np.arange(1 << k)
        want = np.stack([cells[:, (masks & s) == 0].sum(axis=1) for s in masks], axis=1)
        assert (filter_audit.survivors(cells) == want).all()


def test_audit_of_odd_rows(spark, odd):
    labels = [(1, 1, 0), (1, 0, 1), (7, 1, None), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd.collect()]
    got = audit_rows(filter_audit.audit(odd, marks))
    assert got == brute.audited(rows, {1, 7}, {1, 8})
    assert len(got) == 2 * 600


def test_audit_of_given_tables(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.source) for r in docs]
    want = brute.audited(rows, {r.doc_id for r in labels if r.quality == 1}, {r.doc_id for r in labels if r.toxic == 1})
    assert audit_rows(catalog.op11_filter_audit(spark, sf)) == want


def test_audit_of_no_rows_and_no_labels(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0
    assert {r[4] for r in audit_rows(filter_audit.audit(odd, labels)).values()} == {0}


# ---- op 12


def test_near_halves_meet_at_an_anchor():
    rng = random.Random(2)
    for _ in range(200):
        x = rng.getrandbits(31)
        y = x ^ rng.choice([0, 1 << rng.randrange(31)])
        number, anchor, home = simhash_cover.anchors(np.array([x, y]))
        homes = dict(zip(number[home].tolist(), anchor[home].tolist()))
        assert homes[0] in anchor[number == 1] and homes[1] in anchor[number == 0]
        assert all((int(a) ^ (x, y)[n]).bit_count() <= 2 for n, a in zip(number, anchor)) and len(number) <= 32
        assert not simhash_cover.syndrome(anchor).any()


def test_blocks_hold_the_free_bits():
    for free in (0b111, 0b1111, (1 << 33) - 1, 0x8000000000000401 | 6 << 40):
        parts = simhash_cover.blocks(free)
        assert sum(parts) == (free if free.bit_count() >= 4 else 0) and (len(parts) == 4 or parts == [0])


def clusters(seed=4):
    """Chains and clouds of fingerprints that differ in few bits, strangers, and a crowd that shares its lower half."""
    rng, out = random.Random(seed), [0, (1 << 64) - 1]
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([2, 5, 30])):
            out.append(x)
            y = x
            for _ in range(rng.randrange(1, 6)):
                y ^= 1 << rng.randrange(64)
            x = rng.choice([x, y])
            out.append(y)
    low = rng.getrandbits(31)
    out += [low | rng.getrandbits(33) << 31 for _ in range(60)] + [low | rng.getrandbits(9) << 40 for _ in range(60)]
    return list(enumerate(out))


@pytest.mark.parametrize("crowd, few", [(1024, 8), (40, 3)])
def test_groups_equal_brute_force(spark, monkeypatch, crowd, few):
    monkeypatch.setattr(simhash_cover, "CROWD", crowd)
    monkeypatch.setattr(simhash_cover, "FEW", few)
    rows = clusters()
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in rows]
    prints = spark.createDataFrame(signed, "doc_id bigint, print bigint")
    monkeypatch.setattr(simhash_cover, "fingerprints", lambda docs, n: prints)
    got = [(r.doc_id, r.print % (1 << 64), r.component_id) for r in simhash_cover.link(prints).collect()]
    assert sorted(got) == sorted(brute.near_groups(rows))


def test_simhash_of_given_documents(spark, sf, documents):
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in catalog.op12_simhash_cover(spark, sf).collect()]
    assert sorted(got) == sorted(brute.near_groups([(d, brute.simhash(t)) for d, t in documents]))


def test_simhash_of_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [(r.doc_id, r.print % (1 << 64), r.component_id) for r in simhash_cover.link(odd).collect()]
    assert sorted(got, key=str) == sorted(brute.near_groups([(d, brute.simhash(t)) for d, t in rows]), key=str)
    assert simhash_cover.link(none).count() == 0


def test_simhash_of_texts_beyond_one_stretch(monkeypatch):
    """Bits of one text are summed over several stretches of hashes."""
    import pyarrow as pa

    monkeypatch.setattr(simhash_cover, "SPREAD", 7)
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w", None, "x", "x y", "Q wé R  t\ny"]
    assert [int(x) % (1 << 64) for x in simhash_cover.text_prints(pa.array(texts), 3)] == [brute.simhash(t) for t in texts]


# ---- op 13


def mined(df):
    return sorted(tuple(r) for r in df.collect())


def vectors(seed, n, size, spread, labels=3):
    rng = random.Random(seed)
    centre = [[rng.randrange(-spread, spread + 1) for _ in range(size)] for _ in range(4)]
    return [(i, rng.randrange(labels), [c + rng.randrange(-2, 3) for c in rng.choice(centre)]) for i in range(n)]


COLUMNS = "id bigint, label bigint, vector array<bigint>"


@pytest.mark.parametrize("spread, size", [(1, 3), (20, 16), (40, 37)])
def test_negatives_equal_brute_force(spark, monkeypatch, spread, size):
    """Many ties at small spreads; several blocks and groups."""
    monkeypatch.setattr(hard_negatives, "BLOCK", 7)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "PAIRS", 100)
    rows = vectors(spread, 230, size, spread)
    got = mined(hard_negatives.mine(spark.createDataFrame(rows, COLUMNS), F.col("id") % 10 == 0))
    assert got == brute.negatives(rows, lambda i: i % 10 == 0) and got


def test_negatives_of_odd_rows(spark):
    rows = vectors(1, 40, 8, 3) + [
        (None, 1, [1, 2]), (50, None, [1]), (60, 1, None), (70, 1, [1, None]), (80, 1, []), (90, 2, [0] * 30),
        (0, 2, [5] * 8), (0, 2, [5] * 8), (100, 1, [4] * 20), (101, 1, [2**30] * 8), (110, 0, [-(2**30)] * 3), (120, 9, [1]),
    ]
    table = spark.createDataFrame(rows, COLUMNS).withColumn("cell", F.lit(1)).withColumn("number", F.lit("x"))
    got = mined(hard_negatives.mine(table, F.col("id") % 10 == 0))
    assert got == brute.negatives(rows, lambda i: i % 10 == 0)
    assert hard_negatives.mine(table.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.mine(table, F.col("id") == 7777).count() == 0


def test_odd_components_take_no_part(spark):
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf"), 1.0]), (4, None), (5, [None, 1.0]), (6, [])]
    kept = hard_negatives.whole_vectors(spark.createDataFrame(rows, "id int, v array<float>"), "v")
    assert [(r.id, r.v) for r in kept.select("id", hard_negatives.steps("v", 256).alias("v")).collect()] == [(1, [128, -1]), (6, [])]


def test_bounds_hold_at_every_level(spark):
    """No pair's exact score lies outside its interval, and finer intervals are not wider."""
    import pyarrow as pa

    table = np.random.default_rng(3).integers(-100, 100, (40, 64)).astype(float)
    table[5:] = table[5:] * 0.02 + table[0]
    names = {"id": list(range(40)), "label": [0] * 40, "vector": [r.tobytes() for r in table], "summary": [r.tobytes() for r in hard_negatives.summaries(table)]}
    side = hard_negatives.Side(pa.RecordBatch.from_pydict(names))
    width, exact = None, table @ table.T
    for mean, deviation in side.levels:
        middle, spread = mean @ mean.T, deviation @ deviation.T
        assert (np.abs(exact - middle) <= spread + 1e-6 * np.abs(exact).max()).all()
        assert width is None or (spread <= width + 1e-6 * np.abs(exact).max()).all()
        width = spread
    assert len(side.levels) == 5
