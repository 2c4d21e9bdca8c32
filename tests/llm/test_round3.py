"""Merge-type pieces, the filter audit and the divergence audit against brute force."""
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import filter_audit, piece_bpe, source_divergence

from .conftest import EDGES, LABELS, SCHEMA

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def table(spark, rows):
    """Documents from (doc_id, text, lang, source), with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, lang, source, None, "mine", "mine too") for i, t, lang, source in rows], SCHEMA)


# ---- pieces

def random_texts(n, seed):
    r = random.Random(seed)
    some = [*" ▁\n\tabehtinos.,ÜéΩ漢🙂\x00\x85́�", "  ", " " * 20, "the", " in", "</s>", "<s>", "<0x41>", "<unk>", "\U0010ffff"]
    char = lambda: chr(r.choice([r.randrange(0xD800), r.randrange(0xE000, 0x110000)]))
    return ["".join(r.choice(some) if r.random() < 0.9 else char() for _ in range(r.randrange(40))) for _ in range(n)]


def test_pieces_equal_the_library():
    own, lib = piece_bpe.pieces(), piece_bpe.library()
    for t in [*(t or "" for t in EDGES), "▁", " ▁ ", "x" * 5000, *random_texts(3000, 1)]:
        its = lib.encode(t, add_bos=True, add_eos=True)
        assert own.encode(t).tolist() == its, repr(t)
        assert own.decode(np.array(its)) == lib.decode(its), repr(t)
    assert own.encode(None).tolist() == [1, 2]


def test_pieces_both_agendas_agree_and_memory_is_bounded(monkeypatch):
    own = piece_bpe.Pieces(piece_bpe.MODEL)
    for w in random_texts(500, 2):
        assert [s for s in own._listed(w) if s] == own._heaped(w)
    monkeypatch.setattr(piece_bpe, "KEEP_BYTES", 3000)
    own.room = 3000
    for t in random_texts(200, 3):
        assert own.encode(t).tolist() == piece_bpe.pieces().encode(t).tolist()
        assert sum(piece_bpe.ENTRY_BYTES + 4 * len(w) + len(v) for w, v in own.kept.items()) <= 3000


def test_pieces_decode_any_ids():
    own, lib, r = piece_bpe.pieces(), piece_bpe.library(), random.Random(4)
    for _ in range(3000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3, 259), 0, 1, 2]) for _ in range(r.randrange(12))]
        assert own.decode(np.array(ids, np.int64)) == lib.decode(ids), ids


def test_pieces_on_tables(spark, make):
    texts = [*EDGES, *random_texts(30, 5)]
    got = {r["doc_id"]: r for r in piece_bpe.digests(make(texts)).collect()}
    lib = piece_bpe.library()
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        its = lib.encode(t or "", add_bos=True, add_eos=True)
        assert got[i]["n_tokens"] == len(its) and got[i]["matches_library"]
        assert got[i]["ids_sha256"] == hashlib.sha256(np.array(its, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(lib.decode(its).encode()).hexdigest()
    assert piece_bpe.digests(make([])).collect() == []
    assert piece_bpe.digests(make(["a", "a"], [None, None])).count() == 2
    both = make(texts).select(piece_bpe.encode_column(F.col("text")).alias("ids"))
    for r in both.select("ids", piece_bpe.decode_column(F.col("ids")).alias("back")).collect():
        assert r["back"] == lib.decode(list(r["ids"]))


def test_pieces_refuse_other_models(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model_file
    model = model_file.ModelProto()
    with open(piece_bpe.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        piece_bpe.Pieces(str(tmp_path / "other.model"))


# ---- filter audit

def audit_by_hand(rows, good, toxic):
    """(part, order, step) -> the seven counts, document by document."""
    texts = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            texts[t or ""].append(i)
    fails = []
    for i, t, part in rows:
        t = t or ""
        w = SPACED.findall(t)
        f = {x for x, bad in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)),
                              ("D", re.search("[#$%&*|]", t)), ("E", i is not None and min(texts[t]) < i)) if bad}
        fails.append((part or "", f, i in good, i in toxic))
    out = {}
    shapley = Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for p, *_ in fails}:
            mine = [x for x in fails if x[0] == part]
            for k, letter in enumerate(order):
                left = [x for x in mine if not x[1] & set(order[:k])]
                gone = [x for x in left if letter in x[1]]
                shapley[part, letter] += len(gone)
                out[part, order, k + 1] = (len(left) - len(gone), len(gone), sum(letter in x[1] for x in mine) - len(gone),
                                           sum(x[1] == {letter} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit_by_hand(spark):
    r = random.Random(7)
    texts = [*EDGES, " ".join(f"w{i}" for i in range(250)), " ".join(f"W{i}" for i in range(250)), " ".join(f"w{i}" for i in range(250)) + " $", "a b " * 150, None]
    rows = [(r.choice([None, *range(60)]), r.choice(texts), r.choice([None, "", "a", "b"])) for _ in range(150)]
    rows += rows[:20]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 1), (None, 1, 1), *((i, i % 2, i % 3 == 0) for i in range(20, 50))]
    labels = [(i, q, None if t is None else int(t)) for i, q, t in labels]
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    got = filter_audit.audit(table(spark, [(i, t, "en", s) for i, t, s in rows]), spark.createDataFrame(labels, LABELS)).collect()
    want = audit_by_hand(rows, good, toxic)
    assert len(got) == len(want)
    for x in got:
        assert tuple(x)[3:] == want[x["part"], x["filter_order"], x["step"]], x


def test_filter_audit_clean_and_empty(spark):
    clean = " ".join(f"w{i}" for i in range(250))
    got = filter_audit.audit(table(spark, [(1, clean, None, "s")]), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 600 and all((x["kept"], x["removed"], x["shapley"]) == (1, 0, 0) for x in got)
    assert filter_audit.audit(table(spark, []), spark.createDataFrame([], LABELS)).collect() == []


# ---- divergence

def divergence_by_hand(rows):
    def share(c, n, v):
        return 1 + 10 ** 9 * (c + 1) // (n + v)

    groups, langs, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((t or "").translate(A_Z))
        groups[lang, source].update(words)
        langs[lang].update(words)
        docs[lang].update(set(words))
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= 3]
        v, n_all = len(kept), sum(langs[lang][t] for t in kept)
        n = {s: sum(groups[g, s][t] for t in kept) for g, s in groups if g == lang}
        p = {t: share(mine[t], n[source], v) for t in kept}
        pairs = []
        for other in n:
            if other != source:
                q = {t: share(groups[lang, other][t], n[other], v) for t in kept}
                pairs.append((other, sum((p[t] - q[t]) ** 2 // q[t] for t in kept)))
        q = {t: share(langs[lang][t], n_all, v) for t in kept}
        terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if mine[t] and p[t] > q[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(found, 1) if part == "pair" or k <= 200]
    return sorted(out)


def some_rows(n, seed):
    r = random.Random(seed)
    words = ["the", "THE", "Ärger", "ärger", "abcdefgh", "abcdefghi", "abcdefgh" * 3, "漢字", "x" * 3000, "a", *(f"w{'xyz'[i % 3] * (i % 40)}" for i in range(300))]
    return [(" ".join(r.choice(words[:r.randrange(1, len(words))]) + r.choice(["", ".", "7"]) for _ in range(r.randrange(60))),
             r.choice([None, "", "en", "de"]), r.choice([None, "s0", "s0", "s0", "s1", "s2", "ü"])) for _ in range(n)]


def test_divergence_by_hand(spark, monkeypatch):
    rows = [*some_rows(120, 8), (None, "fr", "s0"), ("one two", "fr", "s1"), ("1 2 3", "xx", None), (None, None, None)]
    rows += rows[:10]
    docs = table(spark, [(None if i % 7 == 0 else i % 50, *x) for i, x in enumerate(rows)])
    want = divergence_by_hand(rows)
    assert sorted(map(tuple, source_divergence.divergence(docs).collect())) == want
    # many blocks of sources, shards and slices give the same
    for name, value in (("BLOCK", 2), ("PAIRS", 7), ("BROADCAST_GROUPS", 0)):
        monkeypatch.setattr(source_divergence, name, value)
    assert sorted(map(tuple, source_divergence.divergence(docs).collect())) == want
    assert source_divergence.divergence(docs.where("false")).collect() == []


@pytest.mark.parametrize("size", [4, 1 << 16])
def test_pointer_sort_gives_runs(monkeypatch, size):
    monkeypatch.setattr(source_divergence, "SLICE", size)
    texts = [t for t, _, _ in some_rows(80, 9)] + ["", "...", "ends", "begins"]
    shard = source_divergence.Shard(pa.array(texts, pa.large_string()).slice(1))
    order, run = shard.runs()
    words = [w.encode() for t in texts[1:] for w in TERM.findall(t.translate(A_Z))]
    assert [words[i] for i in order] == sorted(words)
    assert (np.diff(run) == [a != b for a, b in itertools.pairwise(sorted(words))]).all()


def test_shards_are_cut_by_bytes(spark, monkeypatch):
    rows = some_rows(60, 10)
    whole = source_divergence.shard_counts(*(pa.array([x or "" for x in c], k) for c, k in zip([*zip(*rows, strict=True)][1:] + [[t for t, *_ in rows]], (pa.string(), pa.string(), pa.large_string()), strict=True)))
    want = Counter()
    for t, lang, source in rows:
        want.update((lang or "", source or "", w) for w in TERM.findall(t.translate(A_Z)))
    assert {(a, b, c): n for a, b, c, n, _ in zip(*(x.to_pylist() for x in whole.columns), strict=True)} == want


def test_shares_are_exact():
    r = random.Random(11)
    for _ in range(2000):
        n, v = r.randrange(9 * 10 ** 14), r.randrange(1, 10 ** 6)
        c = r.randrange(n + 1)
        assert source_divergence.shares(np.array([c]), np.array([n]), np.array([v]))[0] == 1 + 10 ** 9 * (c + 1) // (n + v)


# ---- license scan: texts of any length are answered

def test_license_repeated_words(make):
    from strata.llm import license_scan
    many = 100_000
    texts = ["may not be reproduced without " + "prior " * many + "permission", "to the extent possible under law " + "word " * many + "waived all copyright",
             "to the extent possible under law the person has waived all copyright", "may not be reproduced without prior written permission"]
    got = {r["doc_id"]: r for r in license_scan.scan(make(texts)).collect()}
    assert len(got) == len(texts)
    assert "cc0" in got[2]["labels"].split(",") and "proprietary" in got[3]["labels"].split(",")


def test_license_many_detections(make):
    """Work grows with the number of detections, not with its square."""
    from strata.llm import license_scan
    many = 30_000
    got = license_scan.scan(make(["mit license, apache license " * many, "plain text", None])).orderBy("doc_id").collect()
    assert [(r["n_base"], r["first_word"], r["last_word"]) for r in got] == [(2 * many, 0, 4 * many - 2), (0, None, None), (0, None, None)]
    assert got[0]["base_labels"] == "apache,mit" and got[0]["score"] == 0.75 and len(got[0]["found"]) >= 2 * many and not got[1]["found"]
