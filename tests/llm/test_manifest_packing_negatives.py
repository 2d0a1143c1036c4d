"""Merkle manifest, packing and hard negatives against brute force, on awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from fixtures import awkward, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hydroframe.llm import hard_negatives, merkle, packing

JSON = public_tokenizers.path("byte_bpe_50k.json")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def brute_manifest(rows, fanout):
    """rows: (id, group, sort, leaf); id -> leaf, subroot, root, siblings, path."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        trees[g] = levels([r[3] for r in groups[g]], fanout)
    top = levels([trees[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for i, r in enumerate(groups[g]):
            sib, path = [], []
            for tree, at in ((trees[g], i), (top, k)):
                for level in tree[:-1]:
                    begin = at // fanout * fanout
                    sib.append("".join(level[begin:at] + level[at + 1 : begin + fanout]))
                    path.append(at - begin)
                    at //= fanout
            out.append((r[0], r[3], trees[g][-1][0], top[-1][0], sib, path))
    return out


@pytest.mark.parametrize(("fanout", "depth", "sizes"), [(2, 1, {"a": 23, "B": 1, None: 6, "": 2, "é": 9, "z": 8}), (3, 1, {"x": 41, None: 1}), (8, 4, {"x": 30}), (3, 2, {"y": 82, "x": 10}), (2, 1, {"one": 1})])
def test_manifest(spark, fanout, depth, sizes):
    rows, n = [], 0
    for g, size in sizes.items():
        for _ in range(size):
            rows.append((n, g, None if n % 13 == 0 else n // 2 * 7 % 50, h(str(n // 3))))
            n += 1
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame([(i, g, s, leaf, "mine") for i, g, s, leaf in rows], "id long, grp string, sort long, leaf string, node string").repartition(3)
    made = merkle.manifest(frame, ["id"], fanout, depth)
    made = made.withColumns({"folded": merkle.folded(F.col("leaf"), F.col("siblings"), F.col("path")), "forged": merkle.folded(F.lit(h("no")), F.col("siblings"), F.col("path"))})
    found = made.collect()
    assert len(found) == n and all(r["folded"] == r["root"] != r["forged"] for r in found)
    # Rows with equal place and leaf may take each other's place.
    plain = sorted((r["leaf"], r["subroot"], r["root"], list(r["siblings"]), list(r["path"])) for r in found)
    assert plain == sorted(x[1:] for x in brute_manifest(rows, fanout))
    assert sorted(r["id"] for r in found) == list(range(n))


def test_manifest_of_nothing_and_leaves(spark):
    frame = spark.createDataFrame([], "id long, grp string, sort long, leaf string")
    assert merkle.manifest(frame, ["id"]).count() == 0
    docs = documents(spark, awkward(n=30))
    got = {r["doc_id"]: r["leaf"] for r in docs.select("doc_id", merkle.leaf([F.col(c) for c in merkle.COLUMNS]).alias("leaf")).collect()}
    for i, t, s in awkward(n=30):
        values = (i, s, "en", None if t is None else len(t), t)
        assert got[i] == h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def test_plain_vocabulary_gives_the_ids_of_the_library():
    library, encode = Tokenizer.from_file(JSON), packing.encoder(JSON, public_tokenizers.PATTERN, 50)
    rng = random.Random(3)
    vocabulary = [w for w in (library.decode([i]) for i in range(0, 50000, 7)) if "�" not in w]
    texts = [t or "" for _, t, _ in awkward()] + ["<|endoftext|>" * 3 + " x<|endoftext|>", "   \x85a\x1c b"]
    texts += ["".join(rng.choice(vocabulary)[rng.randrange(2) :] for _ in range(rng.randrange(2, 60))) for _ in range(3000)]
    for text in texts:
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    words = packing.encoder(public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.PATTERN)
    assert words("Two words").tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Two words", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk", [500, 20000, 1 << 20])
def test_packing(spark, chunk):
    rows = awkward() + [(1, "again", None), (None, "no id", "s")]
    docs = documents(spark, rows).repartition(3)
    found = packing.pack(docs, JSON, public_tokenizers.PATTERN, context=256, step_ids=2000, keep_ids=True, chunk_ids=chunk).toPandas()
    library = Tokenizer.from_file(JSON)
    expected = {}
    for i, t, _ in rows:
        expected.setdefault(i, []).append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    for i, own in found.groupby(found.doc_id.fillna(-1).astype(int)):
        want = expected[None if i == -1 else i]
        assert sorted(x for r in own.ids for x in r) == sorted(x for w in want for x in w)
        if len(want) == 1:
            own = own.sort_values("start")
            assert [x for r in own.ids for x in r] == want[0] and set(own.doc_tokens) == {len(want[0])}
            assert own.start.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
    assert set(found.doc_id.dropna()) == {i for i, _, _ in rows if i is not None}
    for r in found.itertuples():
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for _, own in found.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]
        total = own.length.sum()
        assert total == own.tier.iloc[0] <= 256 and total & (total - 1) == 0 and own.step.nunique() == 1
    loads = found.groupby("step").length.sum()
    assert len(loads) == -(-found.length.sum() // 2000) and loads.max() - loads.min() < 2 * 256
    assert packing.pack(docs.limit(0), JSON, public_tokenizers.PATTERN).count() == 0


def test_gaps_are_filled_and_few_documents_are_cut():
    rng = random.Random(5)
    packer, lengths = packing.Packer(1024), [rng.randrange(1, 900) for _ in range(4000)]
    for i, n in enumerate(lengths):
        packer.add(i, n)
    packer.pack(final=True)
    at = pd.DataFrame(packer.pieces, columns=["doc", "start", "length", "sequence", "offset", "tier", "rank"])
    assert at.length.sum() == sum(lengths) and set(at.groupby("sequence").length.sum()) <= {1 << i for i in range(11)}
    # Most ids lie in long windows, and few documents are cut.
    assert at[at.tier == 1024].length.sum() > 0.9 * sum(lengths) and (at.groupby("doc").size() > 1).mean() < 0.2
    assert sorted(at[at.tier == 1024].groupby("sequence")["rank"].first()) == list(range((at[at.offset == 0].tier == 1024).sum()))


def brute_negatives(rows, anchors, k=5):
    best = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        item = (len(v), label, [int(np.floor(np.float64(np.float32(x)) * 256)) for x in v])
        best[i] = min(best.get(i, item), item)
    out = []
    for a in sorted(i for i in best if anchors(i)):
        width, label, q = best[a]
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, other == label) for i, (w, other, v) in best.items() if i != a and w == width)
        for p, pid, _ in [x for x in scored if x[2]][:k]:
            good = [x for x in scored if not x[2] and 80 * -p <= 100 * -x[0] <= 100 * -p][:k]
            out += [(a, pid, rank, i, -p, -s) for rank, (s, i, _) in enumerate(good, 1)]
    return sorted(out)


@pytest.mark.parametrize(("bucket_rows", "block"), [(1 << 14, 1 << 12), (20, 3), (1, 1)])
def test_hard_negatives(spark, bucket_rows, block):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(160 if bucket_rows > 1 else 60):
        width, size = (3 if i % 17 else 2), [0.01, 1.0, 3.0, 0.0][i % 4 if i % 5 else 1]
        v = [float(np.float32(x)) for x in rng.normal(size=width) * size]
        rows.append((i, int(i % 3), v))
    rows += [(7, 1, rows[7][2]), (8, 2, [5.0, 5.0, 5.0]), (None, 1, [1.0, 1.0, 1.0]), (300, None, [1.0] * 3), (301, 1, None), (302, 1, [1.0, float("nan"), 1.0]), (303, 1, [float("inf")] * 3), (304, 1, [1.0, None, 1.0]), (305, 1, []), (310, 2, [])]
    rows += [(400 + i, i % 2, [1.0, 2.0, 0.5]) for i in range(12)]
    frame = spark.createDataFrame([(i, label, v, "x", "y") for i, label, v in rows], "vec_id long, label int, embedding array<float>, score string, kind string").repartition(3)
    found = hard_negatives.mine(hard_negatives.integer_rows(frame, F.col("label")), F.col("vec_id") % 5 == 0, bucket_rows=bucket_rows, anchor_block=block)
    found = sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    expected = brute_negatives(rows, lambda i: i % 5 == 0)
    assert len(expected) > 20 and found == expected
    empty = hard_negatives.mine(hard_negatives.integer_rows(frame.limit(0), F.col("label")), F.col("vec_id") % 5 == 0)
    assert empty.count() == 0


def test_feasible_ranges_leave_rows_out_but_none_that_counts():
    rng = np.random.default_rng(1)
    matrix = (rng.normal(size=(3000, 6)) * 256).astype(np.int64)
    bucket, left = hard_negatives.Bucket(matrix), 0
    for q in matrix[:50]:
        scores = matrix @ q
        least = int(np.sort(scores)[-8])
        rows = bucket.candidates(q, least)
        assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
        left += len(rows)
    assert left < 0.5 * 50 * len(matrix)
