"""Small tables with every awkward case, and plain brute-force versions of the operators."""

import hashlib
import random
import re

import pandas as pd
from pyspark.sql.types import LongType, StringType, StructField, StructType

SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns of documents, and more whose names the operators use themselves.
SCHEMA = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType()), *[StructField(c, StringType()) for c in ("id", "label", "score", "spans", "key", "digest", "block", "slot", "shingles", "kept")]])


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), *["x"] * 10) for i, t, s in rows], SCHEMA)


def awkward(seed=0, n=120):
    """(doc_id, text, source): nulls, empties, white space, copies, near copies, repeats inside a text, one very long text."""
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "ga\u0301mma", "\u0394elta", "\u4e2d\u6587", "x", "\U0001f600", "it's", "<|endoftext|>", "a.b", "--", "don\u2019t", "\u00a0n", "i\u0307"]

    def words(k):
        return [rng.choice(vocabulary) + str(rng.randrange(40)) for _ in range(k)]

    passage = words(45)
    texts = [None, "", " ", "\n", " \t\n\x0b ", "one", "one two three", "a " * 60, "\n\n\n", "ONE two\x0cthree"]
    while len(texts) < n:
        own = words(rng.randrange(1, 90))
        if rng.random() < 0.4:
            at = rng.randrange(len(own))
            own[at:at] = passage[: rng.randrange(15, 45)]
        if rng.random() < 0.3 and len(texts) > 20:
            own = WORD.findall(rng.choice(texts[10:]))
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append("".join(w + rng.choice([" ", " ", "  ", "\n", "\t", " \n"]) for w in own))
    texts.append(" ".join(words(9000)) + " " + " ".join(passage) + " end" * 50)
    texts.append("z" * 70000)
    rows = [(i * 3, t, None if i % 11 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def frame(rows, columns):
    return pd.DataFrame(list(rows), columns=columns).sort_values(columns[0], ignore_index=True)


def same(found, expected):
    expected = expected.sort_values(list(expected.columns[:2]), ignore_index=True)
    found = found[list(expected.columns)].sort_values(list(expected.columns[:2]), ignore_index=True)
    pd.testing.assert_frame_equal(found, expected, check_dtype=False)


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_classes(rows, k, percent):
    sets = {i: shingles(t, k) for i, t, _ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return frame(((i, len(sets[i]), find(i), find(i) == i) for i in ids), ["doc_id", "n_shingles", "component_id", "kept"])


def repeats_removed(rows, k=20):
    seen, out = {}, []
    texts = sorted((i, WORD.findall(t or "")) for i, t, _ in rows)
    for i, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - k + 1):
            run = tuple(w[s : s + k])
            if run in seen:
                gone[s : s + k] = [True] * k
            seen.setdefault(run, (i, s))
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return frame(out, ["doc_id", "n_words", "n_removed", "kept_sha256"])


def lines_dropped(rows, least):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    count = {}
    for _, t, _ in rows:
        for x in {key(line) for line in (t or "").split("\n")}:
            count[x] = count.get(x, 0) + 1
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or count[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return frame(out, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def exact_groups(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(i)
    return frame(((i, min(g), len(g), i == min(g), sha(t)) for t, g in groups.items() for i in g), ["doc_id", "keep_id", "group_size", "kept", "digest"])
