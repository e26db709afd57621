"""Near duplicates by ProbMinHash over weighted word shingles, with exact verification.

A document is its shingles of five words (lower case, split at ASCII white space),
weighted by how often each occurs; a shorter text is one shingle.  The similarity is
the probability Jaccard index

    J_P(a, b) = sum over common i of 1 / sum_j max(a_j / a_i, b_j / b_i),

which is the plain Jaccard index when no shingle repeats.

1. *Sketch.*  Every shingle is a Poisson process whose rate is its weight; each arrival
   takes a uniformly drawn register.  A register keeps its earliest arrival.  A shingle
   stops once its next arrival is later than every register's (early termination).  Two
   documents agree in a register with probability J_P.
2. *Banding.*  ``BANDS`` bands of ``ROWS`` registers; a pair at 0.8 misses all with
   probability (1 - 0.8^5)^24 < 1e-4.
3. *Verification.*  J_P is computed exactly from the full shingle vectors of candidate
   pairs; links are pairs at ``threshold`` or more.
4. *Classes* are the connected components of the links.

Texts with equal word sequences are one item throughout, so copies cost one row.
Inside a band bucket pairs are made for all members of buckets of at most ``SMALL``, and in larger
ones for every member with the bucket's first.  Buckets that still hold several classes go on in
tiles: their members, cut into blocks of about ``TILE`` shingles, those outside the bucket's largest class
against all.  A task compares two blocks with matrix products over their common shingles,
which give for every pair the weights I_a, I_b of what is common in either text, and

    J_P(a, b) <= 1 / (1 + (A_a - I_a) / I_a + (A_b - I_b) / I_b)

with the texts' weights A: g(x, y) = 1 / (max(1/x, 1/y) + s_a/x + s_b/y) is concave and homogeneous, so its sum
over the common shingles is at most g(1, 1).  Where no shingle repeats this is J_P itself; other pairs
that reach the threshold are computed exactly.  A tile hands on a link only where it joins two
classes, so its output is at most its rows, and a bucket with a third of all texts is many
tiles of bounded size.  No candidate is lost and no bucket is capped.

Shingles are compared by 32 bits of their hash: two texts of 1,000 shingles hold a pair that
falls together by chance in one case of 4,000, which moves their similarity by under 0.001.

Defined cases: texts without words (null, empty, white space) are similar to nothing
and are classes of their own; a null id takes part in classes whose number is the least
id that is not null; rows that repeat count as rows of one item; an empty table gives
an empty result; other columns are ignored (or passed through by ``drop_near``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from sampwise.llm.shared import extend, fresh, stored, text_or_empty
from sampwise.llm.subword import word_hashes

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 24, 5, 0.8
SMALL, TILE = 4, 1 << 20
PIECE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value of each 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _words(texts: list[bytes]):
    """Word hashes in order, their document, the words of each document, places in it."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8).copy()
    buf[buf <= 32] = 32
    starts = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    words, at = word_hashes(buf)
    doc = np.searchsorted(starts, at, side="right") - 1
    n = np.bincount(doc, minlength=len(texts))
    return _mixed(words), doc, n, np.arange(len(words)) - (np.cumsum(n) - n)[doc]


def _prints(words, doc, position, n_docs) -> np.ndarray:
    prints = np.zeros((n_docs, 2), dtype=np.uint64)
    for k, odd in enumerate((_MIX1, _MIX2)):
        # position enters the hash, so the sum depends on the words' order
        np.add.at(prints[:, k], doc, _mixed(words ^ (position.astype(np.uint64) + np.uint64(1)) * odd))
    return prints


def groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PIECE`` bytes together; a longer text is a range alone."""
    at = 0
    while at < len(texts):
        end, held = at, 0
        while end < len(texts) and (end == at or held + len(texts[end]) <= PIECE):
            held += len(texts[end])
            end += 1
        yield at, end
        at = end


def word_prints(texts: list[bytes]) -> np.ndarray:
    words, doc, _, position = _words(texts)
    return _prints(words, doc, position, len(texts))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, weight) sorted by both, and two 64-bit prints of each text's words."""
    words, doc, n, position = _words(texts)
    prints = _prints(words, doc, position, len(texts))
    run = np.zeros(len(words), dtype=np.uint64)
    for k in range(SHINGLE):  # words beyond the text's end count as none
        inside = (np.arange(len(words)) + k < len(words)) & (position + k < n[doc])
        ahead = np.where(inside, words[np.minimum(np.arange(len(words)) + k, max(len(words) - 1, 0))], 0)
        run = _mixed(run * _ODD + ahead) if len(words) else run
    whole = (position + SHINGLE <= n[doc]) | (position == 0)
    doc, run = doc[whole], run[whole]
    order = np.lexsort((run, doc))
    doc, run = doc[order], run[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (run[1:] != run[:-1])
    cut = np.flatnonzero(new)
    return doc[cut], run[cut], np.diff(np.append(cut, len(doc))), prints


def sketch(doc: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_docs: int,
           registers: int = BANDS * ROWS) -> np.ndarray:
    """The shingle that arrived first in every register of every document (n_docs, registers)."""
    first = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, dtype=np.uint64)
    time = np.zeros(len(doc))
    state = shingle.copy()
    while len(doc):
        state = state + _ODD
        draw = _mixed(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53) / weight
        register = ((_mixed(draw) >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        at = doc * registers + register.astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        winner[at[won]] = shingle[won]
        latest = first.reshape(n_docs, registers).max(axis=1)
        going = time < latest[doc]
        doc, shingle, weight, time, state = doc[going], shingle[going], weight[going], time[going], state[going]
    return winner.reshape(n_docs, registers)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """J_P of two weighted sets given by sorted, different hashes."""
    common, ia, ib = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    if wa.max() == wa.min() and wb.max() == wb.min():
        return len(common) / (len(a) + len(b) - len(common)) if wa[0] == wb[0] else _general(wa, wb, ia, ib)
    return _general(wa, wb, ia, ib)


def _general(wa, wb, ia, ib) -> float:
    """The sums over j by the ratio a_j / b_j: above a_i / b_i the a side is the larger."""
    ca, cb = wa[ia].astype(float), wb[ib].astype(float)
    ratio = ca / cb
    order = np.argsort(-ratio, kind="stable")
    only_a = wa.sum() - ca.sum()
    only_b = wb.sum() - cb.sum()
    sum_a = np.cumsum(ca[order]) + only_a  # a_j of ratios at least this one
    rest_b = cb.sum() - np.cumsum(cb[order]) + only_b  # b_j of smaller ratios
    return float((1.0 / (sum_a / ca[order] + rest_b / cb[order])).sum())


_ITEM_SQL = "id long, item binary, bands array<long>, shingles binary, weights binary"


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    salt = np.arange(BANDS, dtype=np.uint64) * _ODD
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text").cast(pa.binary()).to_pylist()
        for at, end in groups(texts):
            doc, shingle, weight, prints = shingles(texts[at:end])
            n = end - at
            registers = sketch(doc, shingle, weight, n).reshape(n, BANDS, ROWS)
            key = np.zeros((n, BANDS), dtype=np.uint64) + salt
            for r in range(ROWS):
                key = _mixed(key * _MIX1 + registers[:, :, r])
            cuts = np.searchsorted(doc, np.arange(n + 1))
            some = np.diff(cuts) > 0
            short = (shingle >> np.uint64(32)).astype("<u4")
            blobs, weights = [], []
            for i in range(n):
                # 32 bits a shingle: hashes of one text that fall together add up
                h, w = short[cuts[i]:cuts[i + 1]], weight[cuts[i]:cuts[i + 1]]
                same = h[1:] == h[:-1]
                if same.any():
                    h, back = np.unique(h, return_inverse=True)
                    w = np.bincount(back, weights=w).astype(np.int64)
                blobs.append(h.tobytes())
                weights.append(b"" if len(w) and w.max() == 1 else w.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, n), pa.array([p.tobytes() for p in prints], pa.binary()),
                 pa.array([k if s else None for k, s in zip(key.view(np.int64), some)], pa.list_(pa.int64())),
                 pa.array(blobs, pa.binary()), pa.array(weights, pa.binary())],
                names=["id", "item", "bands", "shingles", "weights"])


def _vector(blob: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    h = np.frombuffer(blob, "<u4")
    return h, np.frombuffer(weights, "<u4") if weights else np.ones(len(h), dtype=np.uint32)


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "sa", "wa", "sb", "wb")]
            a, b = [], []
            for x, y, sa, wa, sb, wb in zip(*columns):
                if probability_jaccard(*_vector(sa, wa), *_vector(sb, wb)) >= threshold:
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                                 names=["a", "b"])
    return run


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) of all nodes of ``edges`` (a, b): equal labels, one component.

    Each round every node takes its least neighbour's name and the edges are
    contracted to the new names; a component shrinks until no edge is left.
    """
    both = lambda e: e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = None
    while True:
        least = stored(both(edges).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to"))
                       .withColumnRenamed("a", "from"), "near-least")
        if label is None:
            label = least.select(F.col("from").alias("node"), F.col("to").alias("label"))
        else:
            label = stored(label.join(least, label["label"] == least["from"], "left")
                           .select("node", F.coalesce("to", "label").alias("label")), "near-labels")
        new_a = least.select(F.col("from").alias("a"), F.col("to").alias("new_a"))
        new_b = least.select(F.col("from").alias("b"), F.col("to").alias("new_b"))
        edges = stored(edges.join(new_a, "a").join(new_b, "b").where("new_a <> new_b")
                       .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b"))
                       .distinct(), "near-edges")
        if edges.isEmpty():
            return label


def _merged(label: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Labels (node, label) after more links (a, b) between items."""
    if links.isEmpty():
        return label
    if label is None:
        return stored(components(links), "near-labels")
    name = lambda x, y: label.select(F.col("node").alias(x), F.col("label").alias(y))
    named = stored(links.join(name("a", "la"), "a", "left").join(name("b", "lb"), "b", "left")
                   .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
                   .where("a <> b").distinct(), "near-named")
    if named.isEmpty():
        return label
    new = components(named)
    moved = (label.join(new.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
             .select("node", F.coalesce("to", "label").alias("label")))
    fresh_nodes = new.join(label.select("node"), "node", "left_anti")
    return stored(moved.unionByName(fresh_nodes), "near-labels")


def _open_members(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """Members (key, item, label, side) of buckets that hold two classes or more; ``side``: not
    of the bucket's largest class."""
    if label is None:
        now = members.withColumn("label", F.col("item"))
    else:
        now = (members.join(label, members["item"] == label["node"], "left")
               .withColumn("label", F.coalesce("label", "item")).drop("node"))
    now = stored(now.select("key", "item", "label"), "near-open")
    main = (now.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key").agg(F.max(F.struct("n", "label")).alias("m"), F.count(F.lit(1)).alias("classes"))
            .where("classes > 1").select("key", F.col("m.label").alias("main")))
    return now.join(main, "key").withColumn("side", F.col("label") != F.col("main")).drop("main")


def _common_weights(left: list, right: list) -> tuple[np.ndarray, np.ndarray]:
    """For every pair the weight in the left and in the right vector of their common shingles."""
    lrow, rrow = (np.repeat(np.arange(len(side)), [len(h) for h, _ in side]) for side in (left, right))
    lh, lw, rh, rw = (np.concatenate([v[k] for v in side]) for side in (left, right) for k in (0, 1))
    common = np.intersect1d(lh, rh)
    kind = np.float32 if max(lw.sum(), rw.sum(), 1) < 1 << 24 else np.float64  # sums stay exact
    lin, rin = np.isin(lh, common), np.isin(rh, common)
    lrow, lw, lat = lrow[lin], lw[lin], np.searchsorted(common, lh[lin])
    rrow, rw, rat = rrow[rin], rw[rin], np.searchsorted(common, rh[rin])
    in_left = np.zeros((len(left), len(right)))
    in_right = np.zeros_like(in_left)
    plain = len(lw) == 0 or (lw.max() == 1 and rw.max() == 1)

    def matrix(n, row, at, value, start, width):
        some = (at >= start) & (at < start + width)
        out = np.zeros((n, width), dtype=kind)
        out[row[some], at[some] - start] = value if np.isscalar(value) else value[some]
        return out

    for start in range(0, len(common), 2048):
        width = min(2048, len(common) - start)
        has_left, has_right = (matrix(len(side), row, at, 1, start, width)
                               for side, row, at in ((left, lrow, lat), (right, rrow, rat)))
        if plain:
            in_left += has_left @ has_right.T
        else:
            in_left += matrix(len(left), lrow, lat, lw, start, width) @ has_right.T
            in_right += has_left @ matrix(len(right), rrow, rat, rw, start, width).T
    return in_left, (in_left if plain else in_right)


def tile_links(left: list[tuple], right: list[tuple], threshold: float) -> list[tuple[bytes, bytes]]:
    """Links (item, item) that join all classes of a tile that have a linked pair across it.

    A side is a list of (item, label, hashes, weights).
    """
    lv, rv = ([(h, w) for _, _, h, w in side] for side in (left, right))
    in_left, in_right = _common_weights(lv, rv)
    weight = lambda side: np.array([w.sum() for _, w in side], dtype=float)
    al, ar = weight(lv)[:, None], weight(rv)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        most = 1 / (1 + (al - in_left) / in_left + (ar - in_right) / in_right)
    names = {label: k for k, label in enumerate({x[1] for x in [*left, *right]})}
    cl, cr = (np.array([names[x[1]] for x in side]) for side in (left, right))
    close = (in_left > 0) & (most >= threshold - 1e-9) & (cl[:, None] != cr[None, :])
    one_l, one_r = (np.array([w.max() == 1 for _, w in side]) for side in (lv, rv))
    plain = one_l[:, None] & one_r[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        sure = close & plain & (in_left / (al + ar - in_left) >= threshold)
    top = list(range(len(names)))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []

    def joined(i, j) -> bool:
        x, y = find(cl[i]), find(cr[j])
        if x != y:
            top[x] = y
            out.append((left[i][0], right[j][0]))
        return x != y

    i, j = np.nonzero(sure)
    _, first = np.unique(cl[i] * len(names) + cr[j], return_index=True)
    for k in first:
        joined(i[k], j[k])
    for i, j in zip(*np.nonzero(close & ~plain)):
        if find(cl[i]) != find(cr[j]) and probability_jaccard(*lv[i], *rv[j]) >= threshold:
            joined(i, j)
    return out


def _tiles(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in range(batch.num_rows):
                row = batch.slice(one, 1).to_pylist()[0]
                left, right = ([(x["item"], x["label"], *_vector(x["s"], x["w"])) for x in row[side]]
                               for side in ("left", "right"))
                links = tile_links(left, right, threshold)
                if links:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([min(x) for x in links], pa.binary()),
                         pa.array([max(x) for x in links], pa.binary())], names=["a", "b"])
    return run


def _tile_rows(still: DataFrame, vectors: DataFrame, tile: int) -> DataFrame:
    """Rows (left, right): every block of a bucket's side members with every block of its members."""
    size = F.length("s") / 4 + F.lit(tile // 1024)
    before = Window.partitionBy("key").orderBy("item").rowsBetween(Window.unboundedPreceding, 0)
    block = lambda x: F.floor(F.sum(x).over(before) / F.lit(tile)).cast("int")
    rows = stored(still.join(vectors, "item").withColumn("block", block(size))
                  .withColumn("side_block", block(F.when(F.col("side"), size).otherwise(0))), "near-blocks")
    held = F.collect_list(F.struct("item", "label", "s", "w"))
    right = rows.groupBy("key", "block").agg(held.alias("right"))
    last = rows.groupBy("key").agg(F.max("block").alias("last"))
    left = (rows.where("side").groupBy("key", "side_block").agg(held.alias("left")).join(last, "key")
            .select("key", "left", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block")))
    return left.join(right, ["key", "block"]).select("left", "right")


def link_classes(items: DataFrame, threshold: float = THRESHOLD, small: int = SMALL,
                 tile: int = TILE) -> DataFrame | None:
    """Rows (node, label) of the items that have a link; None if there is none.

    ``items`` is the stored table of ``_items``.
    """
    words = items.where("bands IS NOT NULL")
    # one order of the items for all bands: a group has the same first member in each, its least
    order = Window.partitionBy("key").orderBy("item")
    ranked = (words.groupBy("item").agg(F.first("bands").alias("bands"))
              .select("item", F.explode("bands").alias("key"))
              .withColumn("rank", F.row_number().over(order))
              .withColumn("last", F.count("*").over(Window.partitionBy("key"))).where("last > 1")
              .select("key", "item", "rank", "last"))
    members = stored(ranked, "near-members")
    if members.isEmpty():
        return None
    wanted = members.select("item").distinct()
    vectors = stored(words.select("item", "shingles", "weights").join(wanted.hint("merge"), "item", "left_semi")
                     .groupBy("item").agg(F.first("shingles").alias("s"), F.first("weights").alias("w")),
                     "near-vectors")
    # small buckets: all pairs; larger ones: every member with the first
    pivots = (members.where((F.col("rank") == 1) | (F.col("last") <= small))
              .select("key", F.col("item").alias("p_item"), F.col("rank").alias("p_rank")))
    pairs = stored(members.join(pivots, "key").where(F.col("rank") > F.col("p_rank"))
                   .select(F.least("p_item", "item").alias("a"), F.greatest("p_item", "item").alias("b"))
                   .distinct(), "near-pairs")
    side = lambda x: vectors.select(F.col("item").alias(x), F.col("s").alias(f"s{x}"),
                                    F.col("w").alias(f"w{x}"))
    # always by a shuffle: one plan at every size, and a hot first member is an ordinary skewed join
    full = (pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
            .select("a", "b", "sa", "wa", "sb", "wb"))
    label = _merged(None, stored(full.mapInArrow(_verify(threshold), "a binary, b binary"), "near-links"))
    still = stored(_open_members(members.where(F.col("last") > small), label), "near-still")
    if still.isEmpty():
        return label
    links = _tile_rows(still, vectors, tile).mapInArrow(_tiles(threshold), "a binary, b binary")
    return _merged(label, stored(links, "near-tile-links"))


def make_items(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.lower(text_or_empty(text_col)).alias("text"))
    return stored(rows.mapInArrow(_items, _ITEM_SQL), "near-items")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, small: int = SMALL, tile: int = TILE) -> DataFrame:
    """Rows (id, item, class_id, class_size, kept), one per input row.

    ``class_id`` is the least id of the class; the first row with that id is kept.
    """
    items = make_items(docs, id_col, text_col)
    label = link_classes(items, threshold, small, tile)
    rows = items.select("id", "item", F.col("bands").isNull().alias("no_words"))
    if label is None:
        named = rows.withColumn("class", F.col("item"))
    else:
        named = (rows.join(label, rows["item"] == label["node"], "left")
                 .withColumn("class", F.coalesce("label", "item")).drop("node", "label"))
    named = named.withColumn("class", F.when(F.col("no_words"), F.encode(F.concat(
        F.lit("no words "), F.coalesce(F.col("id").cast("string"), F.lit("null"))), "utf-8"))
        .otherwise(F.col("class"))).drop("no_words")
    named = stored(named, "near-named")
    sizes = stored(named.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")),
                   "near-sizes")
    return (named.join(sizes, "class")
            .select("id", "item", "class_id", "class_size",
                    F.col("id").eqNullSafe(F.col("class_id")).alias("kept")))


def with_item(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """``docs`` with the print of the text's words in one more column, ``name``."""
    def prints(column: pa.Array) -> list[pa.Array]:
        texts = column.cast(pa.binary()).to_pylist()
        return [pa.array([p.tobytes() for at, end in groups(texts) for p in word_prints(texts[at:end])],
                         pa.binary())]
    return extend(docs, F.lower(text_or_empty(text_col)), [StructField(name, BinaryType())], prints)


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the least id, columns unchanged.

    Rows that repeat both id and words stay or go together.
    """
    name, gone_id, gone_item = fresh(docs, "near_item", "near_id", "near_gone")
    gone = (near_classes(docs, id_col, text_col, threshold).where("NOT kept")
            .select(F.col("id").alias(gone_id), F.col("item").alias(gone_item)).distinct())
    keyed = with_item(docs, text_col, name)
    match = (keyed[name] == gone[gone_item]) & keyed[id_col].cast("long").eqNullSafe(gone[gone_id])
    return keyed.join(gone, match, "left_anti").drop(name)
