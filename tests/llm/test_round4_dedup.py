"""Branched rows are made once, pairs that sketches rule out are not compared, workers give memory back."""
import numpy as np
import pandas as pd
import pyarrow as pa

from strata.llm import cpsjoin_dedup, llr_quality, tree_bpe, vocabulary

from .test_operators import near_texts


def test_children_are_written_before_they_are_counted(make, monkeypatch):
    for name, value in {"SMALL": 4, "FEW": 0, "DEPTH": 2, "BLOCK": 8}.items():
        monkeypatch.setattr(cpsjoin_dedup, name, value)
    plans, own = [], cpsjoin_dedup._mixed

    def spy(rows):
        plans.append(rows._jdf.queryExecution().toString())
        return own(rows)

    monkeypatch.setattr(cpsjoin_dedup, "_mixed", spy)
    assert cpsjoin_dedup.near_duplicates(make(near_texts()), 3, 85).count() == len(near_texts())
    assert len(plans) > 1 and not any("Generate" in p for p in plans)


def test_partners_are_those_of_all_sketch_values():
    rnd, least = np.random.default_rng(4), cpsjoin_dedup.least_agreeing(85)
    base = rnd.integers(0, 1 << 16, cpsjoin_dedup.SKETCH)
    rows = [np.where(rnd.random(cpsjoin_dedup.SKETCH) < share, base, rnd.integers(0, 1 << 16, cpsjoin_dedup.SKETCH)) for share in np.linspace(0.3, 1, 60)]
    flat = [r.astype("<u2").tobytes() for r in rows]
    comp = [bytes([i % 3]) for i in range(60)]
    near = cpsjoin_dedup._partners(pd.DataFrame({"sketch": flat, "comp": comp}), least)
    for i in range(60):
        assert near(i).tolist() == [j for j in range(i + 1, 60) if comp[i] != comp[j] and (rows[i] == rows[j]).sum() >= least]


def test_pairs_that_sketches_rule_out_are_not_compared(spark, monkeypatch):
    text = b"a b c d e f g h"
    unlike = np.zeros(cpsjoin_dedup.SKETCH, "<u2").tobytes(), np.ones(cpsjoin_dedup.SKETCH, "<u2").tobytes()
    make = lambda two: spark.createDataFrame(
        [(1, b"x", b"x", unlike[0], cpsjoin_dedup.zstandard.compress(text), 0), (1, b"y", b"y", two, cpsjoin_dedup.zstandard.compress(text), 0)],
        "key long, set_id binary, comp binary, sketch binary, body binary, side int")
    assert cpsjoin_dedup.linked_in_groups(make(unlike[0]), 3, 85).count() == 1
    assert cpsjoin_dedup.linked_in_groups(make(unlike[1]), 3, 85).count() == 0


def test_a_worker_holds_one_operators_memory():
    llr_quality._tokens().index(["some words"])
    kept = llr_quality._tokens()
    assert llr_quality._tokens() is kept
    words = cpsjoin_dedup._words()
    assert list(vocabulary._HELD.values()) == [words]
    codec = tree_bpe.codec(tree_bpe.RANKS)
    assert list(vocabulary._HELD.values()) == [codec] and tree_bpe.codec(tree_bpe.RANKS) is codec
    assert llr_quality._tokens() is not kept and not llr_quality._tokens().ids


def test_batches_give_arrows_memory_back(monkeypatch):
    released = []

    class Pool:
        def release_unused(self):
            released.append(1)

    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    assert list(vocabulary.groups(["ab", "cd", "ef"], most=3)) == [slice(0, 2), slice(2, 3)] and released == [1]


def test_sets_hashed_together_are_those_hashed_singly():
    press = cpsjoin_dedup.zstandard.ZstdCompressor().compress
    texts = ["a b c a b c d", "one", "é 漢 x y", "a b", "w " * 500]
    together = cpsjoin_dedup.hashed_sets([press(t.strip().encode()) for t in texts], 3, most=2)
    described = cpsjoin_dedup.describe(texts, 3)
    for h, d in zip(together, described, strict=True):
        assert len(h) == d[0] and cpsjoin_dedup.hashlib.blake2b(h.tobytes(), digest_size=16).digest() == d[1]
        assert (h[1:] > h[:-1]).all()
