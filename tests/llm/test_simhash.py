import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kpool.llm import simhash as S
from kpool.llm.components import connected_components, spanning_links


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, fps, radius=3):
    comp = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    least = {}
    for c, d in zip(comp, ids):
        least[c] = min(x for x in (least.get(c), d) if x is not None) if (least.get(c), d) != (None, None) else None
    return [least[c] for c in comp]


def test_near_duplicates_match_brute_force(spark):
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n\t", "one", "One two", "a b c\x0bd e"]
    for _ in range(60):
        w = list(rng.choice(vocab, 60))
        texts += [" ".join(w), " ".join(w[:-1] + ["x"]), " ".join(w).upper()]
    texts += ["long " * 5000]
    rows = [(i if i != 7 else None, t, "clash") for i, t in enumerate(texts)] + [(3, "one", "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(3)
    got = sorted(map(tuple, S.near_duplicates(df).collect()), key=str)
    fps = [brute_fingerprint(t) for _, t, _ in rows]
    want = sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, brute_components([r[0] for r in rows], fps))), key=str)
    assert got == want


def test_crowded_cells_are_tiled_without_loss(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = set()
    for b in base.tolist():
        for _ in range(40):
            for bit in rng.integers(0, 64, rng.integers(0, 4)):
                b ^= 1 << int(bit)
            fps.add(b)
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = {r[0]: r[1] for r in connected_components(S.close_links(df, 3, tile=8)).collect()}
    got = [roots.get(s, s) for s in signed]
    want = brute_components(signed, fps)
    assert got == want


def test_empty_and_table_kept(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(empty).collect() == [] and S.keep_one_of_each(empty).collect() == []
    df = spark.createDataFrame([(5, "a b c d", 1), (2, "a b c d", 2), (2, "a b c d", 2), (None, "z " * 50, 3), (9, None, 4)],
                               "doc_id long, text string, fp int")
    kept = S.keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(2, "a b c d", 2), (None, "z " * 50, 3), (9, None, 4)], key=str)


def test_chain_is_one_component(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r[1] for r in connected_components(links).collect()} == {0}
    a, b = spanning_links(np.array([5, 4, 3, 9]), np.array([4, 3, 5, 8]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(4, 3), (5, 3), (9, 8)]


def test_tile_pairs_are_skipped_on_documents(spark):
    """Every cell is cut by population counts: pairs of tiles beyond the radius are
    not compared, and no link is lost by it."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    fps = S.fingerprints(docs, "text").select("fp").distinct()
    rows = fps.select("fp", F.explode(S.cells_of("fp", 3, 4)).alias("cell")).collect()
    values = np.array([r["fp"] for r in rows]).view(np.uint64)
    cell = np.array([r["cell"] for r in rows])
    count = np.bitwise_count(values).astype(np.int64)
    order = np.lexsort((count, cell))
    values, cell, count = values[order], cell[order], count[order]
    pairs, skipped = S.tile_pairs(cell, np.zeros(len(cell), np.int64), count, 3)
    assert skipped > 100 and len(pairs) > 0
    compared = {(int(values[i]), int(values[j])) for a, n, b, m in pairs.tolist() for i in range(a, a + n) for j in range(b, b + m) if values[i] != values[j]}
    compared |= {(b, a) for a, b in compared}
    near = np.unique(values)
    close = {(int(near[i]), int(near[j])) for i in range(len(near)) for j in np.flatnonzero(np.bitwise_count(near ^ near[i]) <= 3) if i != j}
    assert close <= compared


@pytest.mark.parametrize("fields,tile", [(4, 4096), (4, 8), (5, 64), (6, 16), (7, 4096)])
def test_any_number_of_fields_and_tiles(spark, fields, tile):
    rng = np.random.default_rng(fields)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(i) for i in rng.choice(64, rng.integers(0, 5), replace=False)) for b in np.repeat(base, 4)]
    near += [(1 << i) - 1 for i in range(65)] + [0, (1 << 64) - 1]  # a chain through all counts
    fps = np.unique(np.array(near, np.uint64))
    df = spark.createDataFrame([(int(v),) for v in fps.view(np.int64)], "fp long")
    roots = {r["node"]: r["root"] for r in connected_components(S.close_links(df, 3, tile=tile, fields=fields)).collect()}
    signed = fps.view(np.int64).tolist()
    assert [roots.get(v, v) for v in signed] == brute_components(signed, [int(v) for v in fps])


def test_more_fields_for_more_fingerprints():
    assert S.fields_for(0, 3) == S.fields_for(10**6, 3) == 4
    assert S.fields_for(10**9, 3) == 5 and S.fields_for(10**12, 3) == 6
    assert S.fields_for(10**15, 0) >= 1 and S.fields_for(10**15, 15) >= 16
    with pytest.raises(ValueError):
        S.close_links(None, 16)
