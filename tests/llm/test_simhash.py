import random
from dataclasses import replace

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tellerloom.llm import components as components_module
from tellerloom.llm import simhash
from tellerloom.llm.components import components
from tellerloom.llm.queries import QUERIES
from tellerloom.staging import Staging
from tests.llm.odd import TEXTS, no_documents, odd_documents


def slow_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [words[i : i + width] for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(run), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, max_bits=4):
    """rows: (doc_id, fingerprint); by brute force over the distinct fingerprints."""
    prints = np.array(sorted({f for _, f in rows}), np.uint64)
    label = np.arange(len(prints))
    near = [np.flatnonzero(np.bitwise_count(prints ^ p) <= max_bits) for p in prints]
    changed = True
    while changed:
        changed = False
        for group in near:
            least = label[group].min()
            changed |= bool((label[group] != least).any())
            label[group] = least
    of = dict(zip(prints.tolist(), label.tolist(), strict=True))
    first = {}
    for i, f in rows:
        if i is not None:
            first[of[f]] = min(i, first.get(of[f], i))
    return sorted((str(i), f, str(first.get(of[f]))) for i, f in rows)


def unsigned(value):
    return value % (1 << 64)


CODES = [simhash.THREE_BLOCKS, simhash.TWO_BLOCKS]


@pytest.mark.parametrize("code", CODES)
def test_anchors_cover_every_pair(code):
    rng = random.Random(5)
    anchors = simhash.Anchors(code)
    copies = []
    for _ in range(200):
        x = rng.getrandbits(64)
        y = x
        for bit in rng.sample(range(64), 4):
            y ^= 1 << bit
        row, anchor, home = anchors.near(np.array([x, y], np.uint64).view(np.int64))
        at_home = set(anchor[(row == 0) & home].tolist())
        assert len(at_home) == len(code.blocks)
        assert at_home & set(anchor[row == 1].tolist())
        copies.append((row == 0).sum())
        # An anchor is a codeword: the syndrome of its Hamming part is zero.
        values = anchor & (1 << 32) - 1
        assert not simhash._syndromes(values, code.hamming_bits).any()
    assert np.mean(copies) == pytest.approx(code.copies, rel=0.05)


def test_cheaper_code_by_number_of_fingerprints():
    assert simhash.code_for(0) == simhash.code_for(10**8) == simhash.THREE_BLOCKS
    assert simhash.code_for(10**9) == simhash.code_for(10**11) == simhash.TWO_BLOCKS
    assert simhash.THREE_BLOCKS.anchors == 1 << 19 and simhash.TWO_BLOCKS.anchors == 1 << 28
    assert simhash.TWO_BLOCKS.cost(10**10) == simhash.TWO_BLOCKS.cost(10**7) == pytest.approx(343, 0.01)


def planted(spark, size, seed):
    """Fingerprints in chains and clouds, and others far from all."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(size)]
    for base in prints[:20]:
        walk = base
        for _ in range(12):
            for bit in rng.sample(range(64), rng.choice([1, 3, 4, 5])):
                walk ^= 1 << bit
            prints.append(walk)
    cloud = rng.getrandbits(64)
    for _ in range(300):
        prints.append(cloud ^ sum(1 << b for b in rng.sample(range(64), 2)))
    return prints


@pytest.mark.parametrize("cell_rows", [4096, 16])
@pytest.mark.parametrize("known", [simhash.KNOWN_ANCHORS, 0])
@pytest.mark.parametrize("code", CODES)
def test_links_connect_what_brute_force_connects(spark, monkeypatch, code, known, cell_rows):
    monkeypatch.setattr(simhash, "KNOWN_ANCHORS", known)
    monkeypatch.setattr(simhash, "PAIRS", 50 if known else 1 << 20)
    code = replace(code, cell_rows=cell_rows)
    prints = planted(spark, 300, 3)
    signed = [(np.array([p], np.uint64).view(np.int64)[0].item(),) for p in prints]
    classes = spark.createDataFrame(signed, "fingerprint long").distinct()
    staging = Staging(spark)
    classes = staging.table(classes, "classes")
    roots = simhash.links(classes, code=code, staging=staging)
    roots = components(roots, staging)
    roots = {r.u: r.v for r in roots.collect()}
    groups = {}
    for (p,) in set(signed):
        groups.setdefault(roots.get(p, p), set()).add(unsigned(p))
    expected = {}
    for i, f, c in slow_components(list(enumerate(prints))):
        expected.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    staging.drop()


@pytest.mark.parametrize("hubs", [components_module.HUBS, 2])
def test_components_of_graphs_with_hubs(spark, monkeypatch, hubs):
    """Hubs whose minima are sent to their edges, and chains, give the least node of each component."""
    monkeypatch.setattr(components_module, "HUBS", hubs)
    rng = random.Random(7)
    edges = [(5, v) for v in range(1000, 2500)] + [(5000 - v, 4990) for v in range(9, 800)]
    edges += [(v, v + 1) for v in range(100, 200)] + [(1200, 4989), (77, 77)]
    edges += [(rng.randrange(9000, 9400), rng.randrange(9000, 9400)) for _ in range(150)]
    rng.shuffle(edges)
    frame = spark.createDataFrame([*edges, (None, 5), (6, None)], "u long, v long")
    staging = Staging(spark)
    got = {r.u: r.v for r in components(frame, staging).collect()}
    least = {}
    for u, v in edges:
        least.setdefault(u, u), least.setdefault(v, v)
    for _ in range(300):
        before = dict(least)
        for u, v in edges:
            least[u] = least[v] = min(least[u], least[v])
        if before == least:
            break
    assert got == {u: v for u, v in least.items() if u != v}
    staging.drop()


def test_hub_rows_meet_their_summary_in_no_shuffle(spark):
    rows = spark.range(20_000).selectExpr("if(id < 9000, 0, id) AS k", "id AS x")
    staging = Staging(spark)
    rows = staging.table(rows, "rows")
    found = components_module.with_summary(rows, "k", F.min("x"), "least", 20_000)
    assert found.where("k = 0").agg({"least": "max", "x": "count"}).first().asDict() == {
        "max(least)": 0, "count(x)": 9000,
    }
    assert found.count() == 20_000 and found.where("k > 0 and least <> x").count() == 0
    # The rows of the hub are in the partitions of the scan, one by one, and not in one after a shuffle.
    sizes = found.where("k = 0").groupBy(F.spark_partition_id()).count()
    assert sizes.agg({"count": "max"}).first()[0] <= 9000 / 2
    staging.drop()


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    found = QUERIES["op4_simhash"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(d.doc_id, slow_fingerprint(d.text)) for d in docs]
    got = sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in found)
    assert got == slow_components(rows)


def test_odd_rows(spark):
    found = simhash.near_duplicates(odd_documents(spark)).collect()
    got = sorted((str(r.doc_id), unsigned(r.fingerprint), str(r.component_id)) for r in found)
    assert got == slow_components([(i, slow_fingerprint(t)) for i, t in TEXTS])
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_more_bits_than_the_code_reaches_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fingerprint long"), 5)
