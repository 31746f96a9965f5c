import numpy as np
import pytest

from meterflow.llm import embeddings
from meterflow.llm.components import components
from tests.llm.test_text import groups_of


def plain(rows, threshold=0.98):
    ok = [(i, v, l) for i, v, l in rows if i is not None and l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(v, float) / np.linalg.norm(v) for i, v, _ in ok}
    links = [(a, b) for a, va, la in ok for b, vb, lb in ok if a < b and la == lb and len(va) == len(vb) and unit[a] @ unit[b] >= threshold]
    group = groups_of([r[0] for r in rows if r[0] is not None], links)
    count = {i: sum(i in pair for pair in links) for i in group}
    return {i: (count[i], group[i], group[i] == i) for i in group}


def make(seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for centre in rng.standard_normal((30, 16)):
        label = int(rng.integers(3))
        for _ in range(int(rng.integers(1, 12))):
            near = centre + rng.standard_normal(16) * rng.choice([0, 0.03, 0.12])
            rows.append((len(rows), [float(x) for x in near.astype(np.float32)], label))
    rows += [(len(rows) + k, v, l) for k, (v, l) in enumerate([(None, 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([1.0, None], 1), ([], 1),
                                                              ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1e30] * 16, 0), ([2e-30] * 16, 0), ([1.0] * 16, None)])]
    return rows


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
@pytest.mark.parametrize("block", [embeddings.BLOCK, 5])
def test_links_and_groups(spark, monkeypatch, kind, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "PER_CELL", 8)
    rows = make()
    if kind == "array<float>":
        rows = [r for r in rows if not (r[1] and 1e30 in r[1]) and not (r[1] and 2e-30 in r[1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], f"vec_id long, embedding {kind}, label int, rep string").repartition(3)
    got = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(df, target_recall=1.0).collect()}
    assert got == plain(rows)
    assert sum(v[0] for v in got.values())


def test_recall_of_the_calibrated_index(spark):
    rows = make(2)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_duplicates(df).collect()}
    want = plain(rows)
    assert sum(got.values()) >= 0.9 * sum(v[0] for v in want.values())
    assert all(got[i] <= want[i][0] for i in want)


def test_links_along_lines_between_centres_are_found_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "PER_CELL", 8)
    fit = embeddings.fit
    monkeypatch.setattr(embeddings, "fit", lambda *args: fit(*args, sample=300))
    rng = np.random.default_rng(4)
    centres = np.linalg.qr(rng.standard_normal((32, 32)))[0]
    rows = []
    for a, b in rng.integers(32, size=(400, 2)):
        if a != b:
            for angle in np.radians(rng.uniform(0, 90) + np.array([0.0, 11.3])):
                rows.append((len(rows), (np.cos(angle) * centres[a] + np.sin(angle) * centres[b]).tolist(), 1))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(df).collect()} == plain(rows)


def test_empty_repeated_and_without_id(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embeddings.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    got = sorted(embeddings.near_duplicates(spark.createDataFrame(rows, schema)).collect(), key=str)
    assert {tuple(r) for r in got} == {(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, False)}


def test_components_of_chains_stars_and_rings(spark):
    rng = np.random.default_rng(3)
    chain = [(k, k + 1) for k in range(60)]
    star = [(100, k) for k in range(101, 140)]
    ring = [(200 + k, 200 + (k + 1) % 30) for k in range(30)]
    loops = [(300, 300), (5, 5)]
    links = [tuple(map(int, x)) for x in rng.permutation(chain + star + ring + loops)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = groups_of(sorted({x for p in links for x in p}), [p for p in links])
    assert got == {k: v for k, v in want.items() if k != 300}
