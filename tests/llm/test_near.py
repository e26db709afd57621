import collections
import itertools
import random

import numpy as np
import pytest

from sampwise.llm.near import (components, drop_near, near_classes, probability_jaccard, shingles, sketch,
                               tile_links)


def bag(text):
    w = (text or "").lower().split()
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def j_p(a, b):
    keys = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))


def linked_pairs(bags):
    """Index pairs at a probability Jaccard of 0.8; pairs that share less than 0.7 of either side cannot be."""
    at = {w: k for k, w in enumerate(sorted({w for b in bags for w in b}))}
    held = np.zeros((len(bags), len(at)))
    for x, b in enumerate(bags):
        held[x, [at[w] for w in b]] = list(b.values())
    shared = (held @ (held > 0).T) / np.maximum(held.sum(axis=1), 1)[:, None]
    for x, y in zip(*np.nonzero(np.triu(np.minimum(shared, shared.T) >= 0.7, 1))):
        some = np.flatnonzero(held[x] + held[y])
        a, b = held[x, some], held[y, some]
        i = np.flatnonzero(a * b)
        if (1 / np.maximum(a[None] / a[i, None], b[None] / b[i, None]).sum(axis=1)).sum() >= 0.8 - 1e-12:
            yield x, y


def brute_classes(rows):
    bags = [bag(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for x, y in linked_pairs(bags):
        top[find(y)] = find(x)
    for x, y in itertools.combinations([k for k, b in enumerate(bags) if not b], 2):
        if rows[x][0] == rows[y][0]:
            top[find(y)] = find(x)
    groups = collections.defaultdict(list)
    for x, (i, _) in enumerate(rows):
        groups[find(x)].append(i)
    out = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        least = min(known) if known else None
        out += [(i, least, len(ids), i == least) for i in ids]
    return sorted(out, key=repr)


def classes(df, **options):
    rows = near_classes(df, **options).collect()
    return sorted(((r["id"], r["class_id"], r["class_size"], r["kept"]) for r in rows), key=repr)


def test_hostile_rows(documents):
    rows, df = documents
    assert classes(df) == brute_classes(rows)


def test_empty_table(no_documents):
    assert classes(no_documents) == [] and drop_near(no_documents).collect() == []


def test_drop_near_keeps_one_of_each_class(documents):
    rows, df = documents
    out = drop_near(df)
    assert out.columns == df.columns
    stay = {i for i, _, _, kept in brute_classes(rows) if kept}
    assert {r["doc_id"] for r in out.collect()} == stay


def test_planted_groups(spark):
    """Chains and clusters of copies with a few words changed, next to unrelated texts."""
    rng = random.Random(5)
    rows, i = [], 0
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([30, 80, 200]))]
        rows.append((i, " ".join(words)))
        for _ in range(rng.randrange(12)):
            i += 1
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            rows.append((i, " ".join(copy)))
            if rng.random() < 0.3:
                words = copy  # the next copies follow this one
        i += 1
    # a passage in many otherwise different texts is no near duplicate
    shared = " ".join(f"s{k}" for k in range(40))
    for k in range(40):
        rows.append((i + k, " ".join(f"u{rng.randrange(9999)}" for _ in range(60)) + " " + shared))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_classes(rows)
    assert classes(df) == want
    assert classes(df, small=1, tile=4000) == want  # most buckets are large, of several blocks


def test_many_copies_of_one_text(spark):
    """Copies near and not so near: only some reach 0.8 with the text they derive from."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(150)]
    rows = [(500, " ".join(words))]
    for k in range(150):
        copy = list(words)
        for _ in range(rng.randrange(1, 9)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10 ** 6)}"
        rows.append((k, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(df) == brute_classes(rows)


def test_chain_in_a_large_bucket(spark):
    """A hundred neighbours in a chain: no single text links them all."""
    words = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(100):
        rows.append((k, " ".join(words)))
        words = words[1:] + [f"n{k}"]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = classes(df, small=2, tile=6000)
    assert got == brute_classes(rows) and {c for _, c, _, _ in got} == {0}


def test_large_group_at_production_parameters(spark):
    """Copies of one text at 0.6 to 1 of it, some of them copies of copies, words repeated or not."""
    rng = random.Random(3)
    for text in ([f"w{k}" for k in range(140)], [f"w{k % 35}" for k in range(140)]):
        rows, made = [], [text]
        for k in range(500):
            copy = list(text if rng.random() < 0.9 else rng.choice(made))
            for _ in range(rng.randrange(1, 10)):
                copy[rng.randrange(140)] = f"x{rng.randrange(40 if k % 2 else 10 ** 6)}"
            made.append(copy)
            rows.append((k, " ".join(copy)))
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert classes(df) == brute_classes(rows)


@pytest.mark.parametrize("seed", range(6))
def test_tile_joins_what_is_linked(seed):
    rng = np.random.default_rng(seed)

    def member(k):
        keep = rng.choice(40, 30 + int(rng.integers(0, 10)), replace=False)
        w = rng.integers(1, 1 + (seed % 3 + 1), len(keep)).astype(np.uint32)
        return str(k).encode(), str(k % 7).encode(), np.sort(keep).astype("<u4"), w

    left, right = [member(k) for k in range(12)], [member(k + 100) for k in range(15)]
    linked = {(a[1], b[1]) for a in left for b in right
              if a[1] != b[1] and probability_jaccard(*a[2:], *b[2:]) >= 0.8}
    label = {x[0]: x[1] for x in left + right}

    def parts(pairs):
        top = {x: x for x in label.values()}
        find = lambda x: x if top[x] == x else find(top[x])
        for a, b in pairs:
            top[find(a)] = find(b)
        return {frozenset(y for y in top if find(y) == find(x)) for x in top}

    got = tile_links(left, right, 0.8)
    assert parts(linked) == parts((label[a], label[b]) for a, b in got)
    assert len(got) < len(label)


def test_sketch_estimates_probability_jaccard():
    rng = random.Random(1)
    a = " ".join(rng.choice("abcdefgh") for _ in range(300))
    b = " ".join([*a.split()[:270], *(rng.choice("ijk") for _ in range(30))])
    doc, h, w, _ = shingles([a.encode(), b.encode()])
    registers = sketch(doc, h, w, 2, registers=4096)
    assert abs((registers[0] == registers[1]).mean() - j_p(bag(a), bag(b))) < 0.03


@pytest.mark.parametrize("seed", range(8))
def test_exact_similarity(seed):
    rng = np.random.default_rng(seed)
    a, b = (collections.Counter(rng.integers(0, 12, 30).tolist()) for _ in range(2))
    vec = lambda c: (np.array(sorted(c), "<u4"), np.array([c[k] for k in sorted(c)]))
    assert probability_jaccard(*vec(a), *vec(b)) == pytest.approx(j_p(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(f"{k:03}", f"{k + 1:03}") for k in range(60)] + [("900", f"{k}") for k in range(901, 930)]
    df = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary")
    label = {bytes(r["node"]): bytes(r["label"]) for r in components(df).collect()}
    assert {label[f"{k:03}".encode()] for k in range(61)} == {b"000"}
    assert {label[f"{k}".encode()] for k in range(900, 930)} == {b"900"}
