"""Each operator against a brute-force version on awkward texts, and on empty tables, nulls and repeated rows."""

import random
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from fixtures import awkward, documents, exact_groups, frame, lines_dropped, near_classes, repeats_removed, same, sha
from pyspark.sql import functions as F

import corpus_pipeline
from hydroframe.llm import byte_bpe, chat_format, exact_dedup, line_dedup, mixing, near_dedup, quality, shared, substring_dedup, token_counts, top_k, words

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_token_counts(docs, rows, empty):
    tokenizer = token_counts._tokenizer(WORDS)
    expected = ((i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t, _ in rows)
    found = token_counts.count_tokens(docs, WORDS, limit=100, long_chars=300).toPandas()
    same(found, frame(expected, ["doc_id", "n_bytes", "n_tokens", "over_limit"]))
    assert token_counts.count_tokens(empty, WORDS).count() == 0


@pytest.mark.parametrize("chunk", [40, 200, 1000])
def test_chunks_splice_like_whole_texts(rows, chunk):
    tokenizer = token_counts._tokenizer(WORDS)

    def encode(text):
        got = tokenizer.encode(text, add_special_tokens=False)
        return [(i, *o) for i, o in zip(got.ids, got.offsets, strict=True)]

    for text in [t for _, t, _ in rows if t and len(t) < 5000] + ["q" * 3000, "<|endoftext|>" * 200, "e\u0301 " * 500]:
        assert token_counts.count_long(text, encode, chunk, chunk // 8) == len(encode(text))


def test_splices_stand_where_both_sides_agree():
    """Against the plain rule: the first gap from which both sides have the same tokens, some at least, up to the last gap."""
    rng = random.Random(6)

    def plain(left, right, text, begin, end):
        gaps = [i for i in range(begin, end) if text[i] == " "]
        for first in gaps[:-1]:
            a, b = ([t for t in side if t[1] >= first and t[2] <= gaps[-1]] for side in (left, right))
            if a and a == b:
                return first
        return None

    found = set()
    for _ in range(2000):
        text = "".join(rng.choice("ab  ") for _ in range(rng.randrange(1, 40)))
        words, at = [], 0
        for w in text.split(" "):
            words += [(rng.randrange(2), at, at + len(w))] if w else []
            at += len(w) + 1
        cut = rng.randrange(len(words) + 1)
        left = [*words[:cut], *((i if rng.random() < 0.9 else i + 5, a, b) for i, a, b in words[cut:])]
        right = [*((i + rng.randrange(2), a, b) for i, a, b in words[:cut]), *words[cut:]]
        begin = rng.randrange(len(text))
        got = token_counts.splice(left, right, text, begin, len(text))
        assert got == plain(left, right, text, begin, len(text))
        found.add(got is None)
    assert found == {True, False}


def test_tokenizers_that_keep_white_space_are_not_spliced(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert token_counts.drops_white_space(token_counts._tokenizer(WORDS)) and not token_counts.drops_white_space(Tokenizer.from_file(path))
    text = "one  two \n three   " * 50
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert token_counts.count_tokens(docs, path, long_chars=100).first()["n_tokens"] == len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_byte_bpe(docs, rows, empty):
    codec = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN)
    ids = {i: codec.encode_ordinary(t or "") for i, t, _ in rows}
    expected = frame(((i, len(x), sha(" ".join(map(str, x))), sha(dict((a, b or "") for a, b, _ in rows)[i])) for i, x in ids.items()), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    same(byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN, piece_chars=100).toPandas(), expected)
    encoded = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    decoded = {r["doc_id"]: bytes(r["bytes"]).decode() for r in byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()}
    assert decoded == {i: t or "" for i, t, _ in rows}
    assert byte_bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_half_characters_decode_to_raw_bytes(spark):
    ids = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN).encode_ordinary("\U0001f600")
    assert len(ids) > 1
    out = byte_bpe.decode(spark.createDataFrame([(1, ids[:1])], "doc_id bigint, ids array<int>"), RANKS, public_tokenizers.PATTERN)
    assert "\U0001f600".encode().startswith(bytes(out.first()["bytes"]))


TRAPS = ["", "plain", chat_format.START, chat_format.END, chat_format.END + "\n" + chat_format.START + "user\nhi", "<\\|im_end|>", "<\\\\|im_end|>\\", "<|", "<\\|", "<|nl|>", "a<", "\\<|im_end|>\n", "<|im_end|", "|im_end|>"]


def test_every_turn_reads_back():
    rng = random.Random(3)
    pieces = ["<", "|", "\\", "im_end", "im_start", "nl", ">", "\n", "x", "<|im_end|>", "<|im_start|>", "<\\|", "<|nl|>"]
    cases = [(r, t) for r in TRAPS for t in TRAPS] + [("".join(rng.choices(pieces, k=4)), "".join(rng.choices(pieces, k=9))) for _ in range(3000)]
    text = ""
    for role, body in cases:
        turn, _, begin, end = chat_format.render(role, body)
        assert chat_format.unescape(turn[begin:end]) == body
        text += turn
    assert chat_format.parse(text) == (cases, "")


def test_conversations(spark):
    turns = [(c, k, ["user", "assistant", None, "system\n2"][((c or 0) + k) % 4], t) for c in (None, 1, 2) for k, t in enumerate([*TRAPS, None])] + [(2, 0, "user", "tie"), (2, 0, "user", "tie"), (3, None, "assistant", "x" * 200000)]
    df = spark.createDataFrame([(*r, "extra") for r in turns], "conv_id bigint, turn bigint, role string, text string, rendered string").repartition(4)
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.render_turns(df)).collect()}
    for c in (None, 1, 2, 3):
        own = sorted(((-1 if k is None else k, r or "", t or "") for i, k, r, t in turns if i == c))
        loss = "".join(t for _, r, t in own if r == "assistant")
        assert (found[c]["n_turns"], found[c]["turns_sha256"]) == (len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)))
        assert (found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(loss), sha(loss))
    assert chat_format.read_back(chat_format.render_turns(df.limit(0))).count() == 0


def test_near_duplicates(docs, rows, empty):
    for k, percent in ((4, 80), (5, 80), (3, 50)):
        same(near_dedup.near_duplicates(docs, k, percent).toPandas(), near_classes(rows, k, percent))
    assert near_dedup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("small", [2, 8])
def test_a_large_family_of_near_copies(spark, small):
    """Copies of one text and copies of those: pairs near the threshold on both sides, in one large bucket."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(90)]
    family, texts = [base], [base]
    for _ in range(110):
        own = list(rng.choice(family))
        for _ in range(rng.randrange(1, 5)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(12)}"
        family = [*family[-6:], own]
        texts.append(own)
    for at in range(0, 90, 30):
        texts.append(base[:at] + base[at + 14 :])
    rows = [(i, " ".join(t), "s") for i, t in enumerate(texts)]
    random.Random(1).shuffle(rows)
    same(near_dedup.near_duplicates(documents(spark, rows).repartition(4), 4, 80, small=small).toPandas(), near_classes(rows, 4, 80))


def test_repeated_ids_do_not_crash(spark):
    twice = documents(spark, [(1, "a b c d e f g", None), (1, "a b c d e f g", None), (None, "a b c d e f g", None), (2, "a b c d e f g", None)])
    near = near_dedup.near_duplicates(twice, 4).toPandas()
    assert sorted(near.doc_id) == [1, 1, 2] and set(near.component_id) == {1}
    assert len(substring_dedup.remove_repeats(twice).toPandas()) == 3
    assert line_dedup.drop_common_lines(twice, 4).agg(F.sum("n_dropped")).first()[0] == 4
    groups = exact_dedup.exact_duplicates(twice).toPandas()
    assert len(groups) == 4 and groups.kept.sum() == 1 and groups.keep_id.isna().all()


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    union = np.sort(rng.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2))
    pick = rng.random(4000)
    for low, high in ((0.1, 0.9), (0.3, 0.6)):
        a, b = union[pick < high], union[pick > low]
        sketch = near_dedup.registers(np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b]), 2)
        assert abs(near_dedup.estimate(sketch[0], sketch[1]) - len(np.intersect1d(a, b)) / 4000) < 0.15


def test_substrings(docs, rows, empty):
    found = substring_dedup.remove_repeats(docs).toPandas()
    expected = repeats_removed(rows)
    same(found, expected)
    assert expected.n_removed.sum() > 300
    assert all(sha(r.kept_text) == r.kept_sha256 for r in found.itertuples())
    assert substring_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("bits", [1, 3])
def test_spans_are_compared_by_their_words(spark, docs, rows, bits, monkeypatch):
    """With almost no hash bits different paths pass for equal; their words at the source's coordinates tell them apart."""
    exact, calls = substring_dedup._by_words, []
    monkeypatch.setattr(substring_dedup, "_by_words", lambda *given: calls.append(1) or exact(*given))
    same(substring_dedup.remove_repeats(docs, hash_bits=bits).toPandas(), repeats_removed(rows))
    pick = random.Random(bits)
    base = [f"v{pick.randrange(400)}" for _ in range(300)]
    cut = [(i, pick.choice([" ", "  ", "\t\n"]).join(base[a : a + 60] + [f"x{i}"] + base[b : b + 40]), "s") for i in range(40) for a, b in [(pick.randrange(240), pick.randrange(260))]]
    found = substring_dedup.remove_repeats(documents(spark, cut).repartition(6), hash_bits=bits).toPandas()
    same(found, repeats_removed(cut))
    assert found.n_removed.sum() > 1500 and calls


def test_repeated_ids_with_different_texts(spark):
    long, short = " ".join(f"w{i}" for i in range(90)), " ".join(f"w{i}" for i in range(30))
    found = substring_dedup.remove_repeats(documents(spark, [(1, long, None), (1, short, None), (2, long, None)]).repartition(3)).toPandas()
    assert sorted(zip(found.doc_id, found.n_words, found.n_removed, strict=True)) == [(1, 30, 0), (1, 90, 0), (2, 90, 90)]


def test_exact_groups(docs, rows, empty):
    same(exact_dedup.exact_duplicates(docs, files_per_batch=2).toPandas(), exact_groups(rows))
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_equal_digests_are_told_apart_by_bytes(docs, rows):
    found = exact_dedup.exact_duplicates(docs, digest=lambda text: F.substring(exact_dedup.sha256(text), 1, 1)).toPandas()
    same(found.drop(columns="digest"), exact_groups(rows).drop(columns="digest"))


def test_common_lines(docs, rows, empty):
    for least in (2, 5):
        found = line_dedup.drop_common_lines(docs, least, shard_keys=50).toPandas()
        expected = lines_dropped(rows, least)
        same(found, expected)
        assert expected.n_dropped.sum() > 20
        assert all(sha(r.kept_text) == r.kept_sha256 for r in found.itertuples())
    assert line_dedup.drop_common_lines(empty).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(2).integers(0, 2**63, 5000, dtype=np.uint64)
    keys[7] = keys[8]
    sizes, bits, rest = line_dedup.PerfectHash.build(keys)
    assert rest.nonzero()[0].tolist() == [7, 8]
    found = line_dedup.PerfectHash(sizes, bits).index(keys)
    assert sorted(found[~rest]) == list(range(4998)) and all(found[rest] == -1)


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vectors = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in range(0, 900, 3)] + [(900 + i, [0.5] * 8) for i in range(200)]
    vectors += [(5000, None), (5001, [1.0, None]), (5002, [float("nan")] * 8), (5003, [float("inf")] * 8), (None, [1.0] * 8), (6000, [1.0, 2.0]), (6050, [3.0, 4.0]), (0, vectors[0][1]), (7000, []), (8000, [1e9] * 8)]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id bigint, embedding array<double>, score string")
    whole = top_k.integer_vectors(df)
    found = top_k.top_k(whole, whole.where("vec_id % 50 = 0"), 5, shard_rows=90, query_block=7).toPandas()
    kept = {}
    for i, v in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, [np.inf]), [int(np.floor(256 * x)) for x in v])
    expected = []
    for q, v in kept.items():
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in kept.items() if i != q and len(w) == len(v))
            expected += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:5], 1)]
    same(found, frame(expected, ["query_id", "rank", "vec_id", "score"]))
    assert top_k.top_k(whole.limit(0), whole.limit(0)).count() == 0


def brute_schedule(weights, blocks):
    """Earliest deadline first among released blocks, by exact fractions."""
    w = [Fraction(x) for x in weights]
    whole, ran, out = sum(w), [0] * len(w), []
    for t in range(blocks):
        ready = [((n + 1) * whole / x, n * whole / x, i) for i, (n, x) in enumerate(zip(ran, w, strict=True)) if n * whole / x < t + 1]
        out.append(min(ready)[-1])
        ran[out[-1]] += 1
    return out


@pytest.mark.parametrize("weights", [[1], [5, 3, 2], [90, *[1] * 10], [33, 33, 34], [1, 99]])
def test_schedule_is_earliest_deadline_first(spark, weights):
    blocks = 3 * sum(weights)
    found = mixing.schedule(sized_sources(spark, [6 * w for w in weights], weights), 10).toPandas()
    order = np.full(2 * blocks, -1)
    for s, slots in zip(found.source, found.slots, strict=True):
        order[list(slots)] = int(s[1:])
    assert order[:blocks].tolist() == brute_schedule(weights, blocks)


def test_mixing(docs, rows, empty):
    out = mixing.mix(docs, block_chars=500).toPandas()
    assert len(out) == len(rows) and out.in_mix.any() and not out.in_mix.all()
    mixed = out[out.in_mix]
    assert ((mixed.release <= mixed.slot) & (mixed.slot < mixed.deadline)).all()
    one = out.groupby("source").block.max()
    assert (one >= 0).all() and out.groupby(["source", "block"]).slot.nunique().max() == 1
    assert out.groupby("slot").source.nunique().max() == 1
    given = mixing.mix(docs, {"s0": 3.0, "s1": 1.0}, block_chars=500).toPandas()
    assert set(given[given.slot.notna()].source) == {"s0", "s1"} and not given[given.slot.isna()].in_mix.any()
    assert mixing.mix(empty).count() == 0


def sized_sources(spark, sizes, weights):
    rows = [(f"s{i:04}", 10 * n, float(w)) for i, (n, w) in enumerate(zip(sizes, weights, strict=True))]
    return spark.createDataFrame(rows, "source string, chars long, w double")


@pytest.mark.parametrize("weights", [[0.9, 0.1], [0.2, *[0.04] * 20], [0.33, *[0.67 / 499] * 499], [3**0.5, 2**0.5, 1, 0.001]])
def test_targets_are_those_of_the_weights(spark, weights):
    found = mixing.schedule(sized_sources(spark, [3000 // len(weights) + 2] * len(weights), weights), 10).toPandas().set_index("source").sort_index()
    assert len(found) == len(weights)
    order = np.full(sum(map(len, found.slots)), -1)
    for i, slots in enumerate(found.slots):
        order[list(slots)] = i
    assert (order >= 0).all()
    whole = min(max(slots) for slots in found.slots) + 1
    for i, w in enumerate(weights):
        given = np.cumsum(order[:whole] == i)
        assert np.abs(given - np.arange(1, whole + 1) * w / sum(weights)).max() < 1 + 1e-9


def test_sources_that_run_dry_leave(spark):
    found = mixing.schedule(sized_sources(spark, [400, 200, 1], [1, 1, 2]), 10).toPandas().set_index("source").slots
    order = np.concatenate([np.full(len(s), i) for i, s in enumerate(found.sort_index())])[np.argsort(np.concatenate(list(found.sort_index())))]
    assert list(np.bincount(order)) == [400, 200, 1] and order[0] == 2
    half = np.cumsum(order[1:401] == 0)
    assert np.abs(half - np.arange(1, 401) / 2).max() < 2 and (order[403:] == 0).all()


def test_given_weights_are_followed(spark):
    docs = spark.createDataFrame([(i, "x" * 10, "a" if i % 2 else "b") for i in range(4000)], "doc_id long, text string, source string")
    found = mixing.mix(docs, {"a": 0.9, "b": 0.1}, block_chars=10).where("in_mix").toPandas().sort_values("slot")
    assert ((found.release <= found.slot) & (found.slot < found.deadline)).all() and len(found) > 2000
    assert np.abs(np.cumsum(found.source == "a") - np.arange(1, len(found) + 1) * 0.9).max() < 1 + 1e-9


def test_many_sources(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', 50) as text", "concat('s', id % 1200) as source")
    found = mixing.mix(docs, block_chars=50).toPandas()
    assert len(found) == 3000 and sorted(found.slot) == list(range(3000)) and found.in_mix.any()


def test_blocks_are_bounded(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('x', 50) as text", "concat('s', id % 3) as source")
    found = mixing.mix(docs, block_chars=50, most_blocks=300).toPandas()
    assert found.slot.nunique() == 300 and sorted(found.slot.unique()) == list(range(300))


def test_the_mixing_stage_keeps_every_row(spark):
    rows = [(i, "x" * 40_000, "hot" if i < 60 else "" if i == 60 else f"s{i % 7}") for i in range(100)] + [(None, "y", None), (3, "z", "s1"), (101, None, "s2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = [tuple(r) for r in corpus_pipeline.mixing_stage(spark, docs, "").collect()]
    assert sorted(found, key=repr) == sorted(rows, key=repr)


def test_quality_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    row = np.repeat([0, 1, 2], [4, 1, 3])
    emit, step = rng.normal(size=8), rng.normal(size=(2, 2))
    good = quality.marginals(emit, row, step)
    for r in range(3):
        own = emit[row == r]
        total, sums = 0.0, np.zeros(len(own))
        for code in range(2 ** len(own)):
            y = np.array([code >> i & 1 for i in range(len(own))])
            w = np.exp((own * y).sum() + sum(step[a, b] for a, b in zip(y[:-1], y[1:], strict=True)))
            total, sums = total + w, sums + w * y
        assert np.allclose(good[row == r], sums / total)


def test_quality_learns_and_scores_everything(spark, docs, empty):
    rng = random.Random(0)
    made = []
    for i in range(300):
        fine = [" ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(12)).capitalize() + "." for _ in range(5)]
        made.append((i, "\n".join(fine if i % 3 else [x.upper().replace(" ", "!! ") for x in fine]), "s"))
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(300)] + [(None, 1), (5, None)], "doc_id bigint, quality int")
    all_docs = documents(spark, made)
    model = quality.train(all_docs, labels.where(~quality.held_out()))
    out = quality.score(all_docs.select("doc_id", "text"), model).withColumn("held_out", quality.held_out()).toPandas()
    test = out[out.held_out]
    assert 50 < len(test) < 150 and (test.predicted == (test.doc_id % 3 > 0)).mean() > 0.97
    scored = quality.score(docs, model)
    # The table's own column of that name stays as it is.
    assert scored.where("_score between 0 and 1").count() == docs.count() == scored.where("score = 'x'").count()
    assert scored.columns == [*docs.columns, "_score", "predicted"]
    assert quality.score(empty, model).count() == 0
    assert quality.train(empty, labels) is None
    assert quality.score(docs, None).where("_score <> 0.5").count() == 0


def test_word_hashes_follow_words():
    import pyarrow as pa

    texts = ["a bc\td", "", "  ", "bc A", "\u00e9 a\x0b\u00e9"]
    data, ends = shared.text_bytes(pa.array(texts))
    begin, end, row = words.spans(data, ends)
    assert row.tolist() == [0, 0, 0, 3, 3, 4, 4, 4]
    h = words.hashed(data, begin, end)
    low = words.hashed(data, begin, end, lower=True)
    assert h[1] == h[3] and h[5] == h[7] and h[0] != h[4] and low[0] == low[4] and len(set(h.tolist())) == 5


def test_a_long_chain_is_one_component(spark):
    """Each document shares over 80 % with its neighbours only; ids are shuffled."""
    n, order = 2000, list(range(2000))
    random.Random(3).shuffle(order)
    rows = [(order[i], " ".join(f"w{j}" for j in range(3 * i, 3 * i + 60)), "s") for i in range(n)]
    found = near_dedup.near_duplicates(documents(spark, rows).repartition(4), 4, 80).toPandas()
    assert set(found.component_id) == {0} and found.kept.sum() == 1


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("n", [16, 1024, 4096])
def test_structured_words_do_not_collide(spark, n):
    """A Thue-Morse word and its complement collide under polynomial hashes modulo a power of two."""
    one = thue_morse(n)
    other = one.translate(str.maketrans("ab", "ba"))
    rows = [(1, one, "s"), (2, other, "s")]
    same(near_dedup.near_duplicates(documents(spark, rows), 4, 80).toPandas(), near_classes(rows, 4, 80))
    rows = [(i, one, "s") for i in range(9)] + [(9, other, "s")]
    same(line_dedup.drop_common_lines(documents(spark, rows), 10).toPandas(), lines_dropped(rows, 10))
    words_of = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join([*words_of[:15], w, *words_of[15:]]), "s") for i, w in enumerate((one, other))]
    same(substring_dedup.remove_repeats(documents(spark, rows)).toPandas(), repeats_removed(rows))
    for w in (one, other):  # sequences of words, too
        letters = np.array([ord(c) for c in w], np.uint64)
        assert len(np.unique(words.sequences(np.concatenate([letters, letters ^ np.uint64(3)]), np.array([0, n]), np.array([n, 2 * n])))) == 2


def test_splits_deal_evenly_and_equal_vectors_together():
    rng = np.random.default_rng(8)
    x = np.floor(256 * rng.normal(size=(4000, 6))).astype(np.int64)
    leaf = top_k.leaf_of(x, *top_k.splits(x, 16))
    assert np.bincount(leaf, minlength=16).min() > 200 and leaf.max() == 15
    same_vectors = np.repeat(x[:1], 500, axis=0)
    assert set(top_k.leaf_of(same_vectors, *top_k.splits(same_vectors, 16))) == {0}
    assert len(set(top_k.leaf_of(same_vectors, *top_k.splits(np.concatenate([x, same_vectors]), 16)))) == 1
    assert top_k.leaf_of(x[:0], *top_k.splits(x[:0], 4)).tolist() == []


def test_common_lines_are_known_by_their_whole_digest():
    """A key of which all but a few bits are those of a common line is not taken for it."""
    one, two, n = np.array([5, 5, -7, 9]), np.array([1, 1 << 40, 3, 4]), np.array([100, 200, 300, 400])
    common = line_dedup.Common(one, two, n)
    assert common.lookup(one, two).tolist() == [100, 200, 300, 400]
    forged = two ^ np.array([1 << 20, 1, 2, 1 << 62])
    assert common.lookup(one, forged).tolist() == [0, 0, 0, 0] and common.lookup(one + 1, two).tolist() == [0, 0, 0, 0]
    shard = line_dedup.Shard(*line_dedup.arrays(np.array([5]), np.array([3 << 33]), np.array([50])))
    # What a fingerprint alone would accept.
    assert shard.lookup(np.array([5]), np.array([(3 << 33) + 1])).tolist() == [50]
    assert line_dedup.Common(np.array([5]), np.array([3 << 33]), np.array([50])).lookup(np.array([5]), np.array([(3 << 33) + 1])).tolist() == [0]


def test_large_groups_of_copies_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "LARGE_GROUP", 3)
    rows = [(i, ["same", "same  ", None, "", f"own {i}"][i % 5], "s") for i in range(60)] + [(7, "same", "s"), (None, "same", "s")]
    found = exact_dedup.exact_duplicates(documents(spark, rows)).toPandas()
    assert found.groupby("digest").group_size.first().sort_values().tolist()[-3:] == [12, 14, 24]
    assert len(found) == 62 and (found.groupby("digest").size() == found.groupby("digest").group_size.first()).all()
